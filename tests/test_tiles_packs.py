"""Packs read back as they were written."""

import numpy as np
import pandas as pd
import pytest

from affinity.operators import tiles


@pytest.mark.parametrize("few,rows", [(True, 40), (False, 40), (True, 70_000), (True, 0)])
def test_pack_reads_back(few, rows):
    rng = np.random.default_rng(rows)
    ids = np.arange(rows) * 3 + 5
    n = 20 * rows if rows < 1000 else 3 * rows
    r, c = rng.integers(0, max(rows // 2, 1), n), rng.integers(0, 50 * rows + 1, n)
    v = (rng.choice([-0.5, 0.0, -0.0, 1 / 3, 2.0], n) if few else rng.normal(size=n)) * (1 + r) / 7
    ent = pd.DataFrame({"pack": 3, "kind": tiles.ENTRY, "row_id": ids[r] if rows else r, "col_id": c, "value": v, "info0": 0.0})
    info = pd.DataFrame({"pack": 3, "kind": tiles.INFO, "row_id": ids, "col_id": 0, "value": 0.0, "info0": ids * 0.25})
    if rows == 0:
        info = pd.DataFrame({"pack": [3], "kind": tiles.INFO, "row_id": [5], "col_id": 0, "value": 0.0, "info0": 1.25})
    made = tiles._pack(pd.concat([info, ent]), 1)
    p = tiles.Pack(next(made.itertuples()), 1)
    o = np.lexsort((r, c))
    assert (p.rows == r[o]).all() and (p.cols == c[o]).all()
    both = sorted(zip(p.cols.tolist(), p.rows.tolist(), p.vals.view(np.int64).tolist()))
    assert both == sorted(zip(c.tolist(), r.tolist(), v.view(np.int64).tolist()))
    if few and rows == 40:                                   # a row has few distinct values: they are written once
        assert len(made["vals"][0]) + len(made["codes"][0]) < 8 * n / 2
