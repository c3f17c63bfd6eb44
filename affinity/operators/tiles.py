"""Exact top-k cosine neighbours without materialising pairs.

Similarity between rows u, v of a sparse matrix X (long form
``(row_id, col_id, value)``) with an optional rank-one term:

    sim(u, v) = (alpha_u * alpha_v + sum_c x_uc * x_vc) / (norm_u * norm_v)

(TF-IDF cosine: alpha = 0, norm = 1; user cosine on mean-imputed ratings:
alpha = sqrt(M) * mean_u, see ``collab``).

Rows are hashed into packs of some thousand rows; a pack is one row of packed
and compressed arrays.  Packs are dealt to G groups, and every
pair of groups (i <= j) is a tile: a pack is copied to the G tiles of its
group.  G follows from the memory of a task (``GROUP_ENTRIES``) and the number
of cores, not from the pack size, so that few copies are shuffled: 16 of a
hundred million entries.  They do not lie on disk at the same time: tiles are
taken in rounds of diagonals (group i with group i + d), a round copies a pack
twice a diagonal, and its copies are deleted when its best are written.  So disk grows
with the entries, not with their copies.  One ``applyInPandas`` task works through its
tile pack by pack: BLAS for columns dense in both packs, scatter-add
of the co-occurring entries for the rest.  It keeps the k best of every row so
far, and only cells that reach the k-th are looked at.  Only those leave the
task; a final ``row_number() <= k`` per row (planned as a partial + final
WindowGroupLimit) merges the tiles.

Work is the inherent pairwise cost, spread over G(G+1)/2 tasks; memory per
task is bounded by two groups and one pair of packs, so a
popular column (a term in every document, an item everybody rated) never
lands in one task, and no pair list is ever written out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.session import materialize, release

SCORE_PLACES = 9
HALF_PLACE = 1e-9             # more than a rounded score differs from the exact one
ENTRY, INFO = 0, 1
TASKS_PER_CORE = 8
GROUP_ENTRIES = 8_000_000     # entries of a group of packs (some 100 MB)
GROUP_ROWS = 1_000_000
OUT_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()),
                           T.StructField("other_id", T.LongType()),
                           T.StructField("sim", T.DoubleType())])
ROUND_ENTRIES = 64_000_000    # copies of entries that one round of tiles may shuffle (some 5 bytes each)
PACK_SCHEMA = ("pack int, side int, n_rows int, n_entries int, ids binary, info binary, rows binary, cols binary, counts binary, "
               "vals binary, codes binary, kind int")
BY_ROW, BY_COLUMN, WIDE = 1, 2, 4     # kinds of coded values
SEEDS, OTHERS = 0, 1
CHUNK_ENTRIES = 1_000_000     # entries of a task that are dealt to packs at once
PAIR_CHUNK = 4_000_000        # co-occurrences scattered per numpy step
DENSE_COL_CHUNK = 512         # columns per BLAS step
DENSE_RATIO = 512             # column goes dense when n_left*n_right > ni*nj/512


def round_half_up(x: np.ndarray) -> np.ndarray:
    """SCORE_PLACES decimals, halves away from zero as in the SQL ``round``."""
    scale = 10.0 ** SCORE_PLACES
    return np.sign(x) * np.floor(np.abs(x) * scale + 0.5) / scale


def _topk(keys: np.ndarray, k: int):
    """Per row of ``keys`` the k largest (ties: lower column index first)."""
    if keys.size == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    b = keys.shape[1]
    if b > k:
        thr = -np.partition(-keys, k - 1, axis=1)[:, k - 1]
        mask = keys >= thr[:, None]
    else:
        mask = np.ones(keys.shape, dtype=bool)
    mask &= np.isfinite(keys)
    r, c = np.nonzero(mask)
    kv = keys[r, c]
    order = np.lexsort((c, -kv, r))
    r, c = r[order], c[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r, side="left")
    keep = rank < k
    return r[keep], c[keep]


# ------------------------------------------------------------------ packs --

def _squeezed(a: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(a).tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _read(data: bytes, kind) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(data[8:], n, asbytes=True), kind) if n else np.empty(0, kind)


def _written(pack: int, side: int, ids: np.ndarray, info: np.ndarray, rows: np.ndarray, cols: np.ndarray, vals: np.ndarray) -> tuple:
    """A row of PACK_SCHEMA.  ids ascending; entries in the order of columns, then rows (positions
    in ids).  Every distinct column is written once, with how many entries it has."""
    first = np.ones(len(cols), dtype=bool)
    first[1:] = cols[1:] != cols[:-1]
    start = np.flatnonzero(first)
    col, count = cols[start], np.diff(np.append(start, len(cols)))
    at = np.cumsum(first) - 1
    # Values of few kinds a row (ratings) or a column (counts times the weight of a term) are written once.
    plain, by_row, by_col = (vals, np.empty(0, np.uint8), 0), _coded(rows, vals, len(ids)), _coded(at, vals, len(col))
    some = [x for x in ((*by_row, BY_ROW), (*by_col, BY_COLUMN)) if len(x[1])]
    vals, codes, kind = min([plain, *some], key=lambda x: x[0].nbytes + x[1].nbytes)
    small = len(cols) == 0 or (col[0] >= 0 and col[-1] < 2 ** 31)
    return (pack, side, len(ids), len(cols), _squeezed(ids.astype(np.int64)), _squeezed(info),
            _squeezed(rows.astype(np.uint16 if len(ids) <= 1 << 16 else np.int32)), _squeezed(col.astype(np.int32 if small else np.int64)),
            _squeezed(count.astype(np.int32)), _squeezed(vals), _squeezed(codes), kind | (WIDE if codes.dtype == np.uint16 else 0))


PACK_COLUMNS = [x.split()[0] for x in PACK_SCHEMA.split(", ")]
PACK_ARROW = pa.schema([(x.split()[0], pa.int32() if x.endswith("int") else pa.binary()) for x in PACK_SCHEMA.split(", ")])


def _pack(pdf: pd.DataFrame, n_info: int) -> pd.DataFrame:
    """The rows of one pack as arrays: ids ascending, their info, entries by column."""
    is_info = pdf["kind"].to_numpy() == INFO
    inf, ent = pdf[is_info].sort_values("row_id"), pdf[~is_info]
    ids = inf["row_id"].to_numpy(np.int64)
    info = np.stack([inf[f"info{i}"].to_numpy(np.float64) for i in range(n_info)]) if n_info else np.zeros((0, len(ids)))
    rows, cols = np.searchsorted(ids, ent["row_id"].to_numpy(np.int64)), ent["col_id"].to_numpy(np.int64)
    o = np.lexsort((rows, cols))
    vals = ent["value"].to_numpy(np.float64)[o]
    return pd.DataFrame([_written(int(pdf["pack"].iat[0]), SEEDS, ids, info, rows[o], cols[o], vals)], columns=PACK_COLUMNS)


def _coded(groups: np.ndarray, vals: np.ndarray, n: int):
    """Values as the distinct ones of each group (row or column) and, per entry, a number that
    tells which; the values themselves and no numbers where that takes more room."""
    bits = vals.view(np.int64)                               # the very floats
    o = np.lexsort((bits, groups))
    r, b = groups[o], bits[o]
    new = np.ones(len(o), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (b[1:] != b[:-1])
    sizes = np.bincount(r[new], minlength=n)
    most = int(sizes.max()) if len(o) else 0
    kind = np.uint8 if most <= 256 else np.uint16
    width = np.dtype(kind).itemsize
    if len(o) == 0 or most > 1 << 16 or 8 * int(new.sum()) + width * (len(o) + n) >= 8 * len(o):
        return vals, np.empty(0, np.uint8)
    codes = np.empty(len(o), dtype=kind)
    codes[o] = np.cumsum(new) - 1 - (np.cumsum(sizes) - sizes)[r]
    return vals[o[new]], np.append(codes, (sizes - 1).astype(np.int64).astype(kind))


def _decoded(vals: np.ndarray, codes: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    if len(codes) == 0:
        return vals
    sizes = np.bincount(groups, minlength=n) > 0             # groups without entries have no values
    sizes = np.where(sizes, codes[len(groups):].astype(np.int64) + 1, 0)
    return vals[(np.cumsum(sizes) - sizes)[groups] + codes[:len(groups)]]


class Pack:
    """A pack read back: ``ids``, ``info`` (one array per info column), entries
    ``rows``, ``cols``, ``vals`` in the order of columns, and per distinct column
    ``col`` where its entries ``start`` and how many there are (``count``)."""

    def __init__(self, row, n_info: int):
        self.number = int(row.pack)
        self.ids = _read(row.ids, np.int64)
        self.info = _read(row.info, np.float64).reshape(n_info, len(self.ids))
        self.rows = _read(row.rows, np.uint16 if len(self.ids) <= 1 << 16 else np.int32).astype(np.int32)
        self.count = _read(row.counts, np.int32).astype(np.int64)
        col = _read(row.cols, np.uint8)
        self.col = col.view(np.int32 if len(col) == 4 * len(self.count) else np.int64)
        self.start = np.cumsum(self.count) - self.count
        self.cols = np.repeat(self.col, self.count)
        kind = int(row.kind)
        by = self.rows if kind & BY_ROW else np.repeat(np.arange(len(self.col)), self.count) if kind & BY_COLUMN else None
        vals, codes = _read(row.vals, np.float64), _read(row.codes, np.uint16 if kind & WIDE else np.uint8)
        self.vals = vals if by is None else _decoded(vals, codes, by, len(self.ids) if kind & BY_ROW else len(self.col))

    def __len__(self):
        return len(self.ids)


def packed(entries: DataFrame, info: DataFrame, packs: int, name: str) -> DataFrame:
    """Packs of (row_id, col_id, value) with info (row_id, further columns), written once."""
    extra = [c for c in info.columns if c != "row_id"]
    zero = F.lit(0.0)
    rows = (entries.select(F.lit(ENTRY).alias("kind"), "row_id", "col_id", "value",
                           *[zero.alias(f"info{i}") for i in range(len(extra))])
            .unionByName(info.select(F.lit(INFO).alias("kind"), "row_id", F.lit(0).cast("long").alias("col_id"),
                                     zero.alias("value"), *[F.col(c).alias(f"info{i}") for i, c in enumerate(extra)])))
    rows = rows.withColumn("pack", F.pmod(F.xxhash64("row_id"), F.lit(packs)).cast("int"))
    n = len(extra)
    return materialize(rows.groupBy("pack").applyInPandas(lambda pdf: _pack(pdf, n), PACK_SCHEMA), name)


def _chunks(packs: int):
    """Entries (pack, row_id, col_id, value) of a task as small packs without info, one a pack
    for some CHUNK_ENTRIES entries at a time."""
    def made(held):
        t = pa.Table.from_batches(held)
        pack, row, col, val = (t.column(c).to_numpy() for c in ("pack", "row_id", "col_id", "value"))
        o = np.lexsort((row, col, pack))
        pack, row, col, val = pack[o], row[o], col[o], val[o]
        cuts = np.append(np.flatnonzero(np.diff(pack, prepend=-1)), len(pack))
        out = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            ids, at = np.unique(row[lo:hi], return_inverse=True)
            out.append(_written(int(pack[lo]), SEEDS, ids, np.zeros((0, len(ids))), at, col[lo:hi], val[lo:hi]))
        return pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=PACK_COLUMNS), schema=PACK_ARROW, preserve_index=False)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CHUNK_ENTRIES:
                yield made(held)
                held, n = [], 0
        if n:
            yield made(held)
    return run


def _joined(packs: list[Pack]):
    """(ids, rows, cols, vals) of several packs as one, ids ascending, entries by column and row."""
    ids = np.unique(np.concatenate([p.ids for p in packs]))
    rows = np.concatenate([np.searchsorted(ids, p.ids)[p.rows] for p in packs])
    cols, vals = np.concatenate([p.cols.astype(np.int64) for p in packs]), np.concatenate([p.vals for p in packs])
    o = np.lexsort((rows, cols))
    return ids, rows[o], cols[o], vals[o]


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """The chunks of one pack as one pack a side: the rows that a chunk without entries names
    are seeds.  A row has alpha 0 and its own length for a norm."""
    named = pdf["n_entries"].to_numpy() == 0
    seeds = np.concatenate([_read(b, np.int64) for b in pdf.loc[named, "ids"]]) if named.any() else np.empty(0, np.int64)
    chunks = [Pack(r, 0) for r in pdf[~named].itertuples()]
    out = []
    if chunks:
        ids, rows, cols, vals = _joined(chunks)
        norm = np.sqrt(np.bincount(rows, weights=vals * vals, minlength=len(ids)))
        mine = np.isin(ids, seeds)
        for side, which in ((SEEDS, mine), (OTHERS, ~mine)):
            if which.any():
                e = which[rows]
                info = np.stack([np.zeros(int(which.sum())), norm[which]])
                out.append(_written(int(pdf["pack"].iat[0]), side, ids[which], info, (np.cumsum(which) - 1)[rows[e]], cols[e], vals[e]))
    return pd.DataFrame(out, columns=PACK_COLUMNS)


def packed_by_length(entries: DataFrame, packs: int, name: str, seeds: DataFrame | None = None) -> DataFrame:
    """Packs of (row_id, col_id, value), written once; info: alpha 0 and the length of the row.

    Entries are dealt as arrays, not as rows.  With ``seeds`` (row_id) a pack is written as two,
    that of its seed rows (side SEEDS) and that of all others; else all rows are seeds."""
    deal = lambda df: df.where("row_id IS NOT NULL").withColumn("pack", F.pmod(F.xxhash64("row_id"), F.lit(packs)).cast("int"))
    chunks = deal(entries).select("pack", "row_id", "col_id", "value").mapInArrow(_chunks(packs), PACK_SCHEMA)
    if seeds is None:
        merge = lambda pdf: _merge(pdf).assign(side=SEEDS)
    else:
        merge = _merge
        chunks = chunks.unionByName(deal(seeds.select("row_id")).select("pack", "row_id").mapInArrow(_named, PACK_SCHEMA))
    return materialize(chunks.groupBy("pack").applyInPandas(merge, PACK_SCHEMA), name)


def _named(batches):
    """Seeds (pack, row_id) as chunks without entries."""
    for batch in batches:
        pack, row = batch.column("pack").to_numpy(), batch.column("row_id").to_numpy()
        none = np.empty(0, np.int64)
        out = [_written(int(n), SEEDS, np.unique(row[pack == n]), np.zeros((0, 0)), none, none, np.empty(0)) for n in np.unique(pack)]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=PACK_COLUMNS), schema=PACK_ARROW, preserve_index=False)


def groups_for(spark, packs: int, n_rows: int, n_entries: int, most: int = GROUP_ENTRIES) -> int:
    """Groups that a task can hold two of, and enough tiles for all cores."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(packs, max(blocks_for(n_rows, n_entries, GROUP_ROWS, most), math.ceil(math.sqrt(4 * cores)))))


def pair_tiles(left: DataFrame, gl: int, fn, schema, right: DataFrame | None = None, gr: int = 0,
               diagonals: list[int] | None = None) -> DataFrame:
    """``fn(left packs, right packs)`` for every pair of groups; without ``right``
    for the unordered pairs of the groups of ``left`` (a group with itself: one list
    given twice).  ``diagonals``: only the pairs (i, i + d modulo the groups) of these d."""
    alone, around = right is None, gl if right is None else max(gl, gr)

    def dealt(df, side, own, others):
        if diagonals is None:
            other = F.sequence(F.lit(0), F.lit(others - 1))
        else:
            ways = [d for d in diagonals] * (alone or side == 0) + [-d for d in diagonals] * (alone or side == 1)
            other = F.array_distinct(F.array(*[F.pmod(F.col("own") + F.lit(d), F.lit(around)) for d in ways]))
            other = F.filter(other, lambda x: x < others)
        d = (df.select(F.lit(side).alias("_side"), (F.col("pack") % own).alias("own"), "*").withColumn("other", F.explode(other)))
        ti, tj = ("own", "other") if side == 0 else ("other", "own")
        if right is None:
            return d.withColumns({"tile_i": F.least("own", "other"), "tile_j": F.greatest("own", "other")})
        return d.withColumns({"tile_i": F.col(ti), "tile_j": F.col(tj)})

    both = dealt(left, 0, gl, gl if right is None else gr)
    tiles = gl * (gl + 1) // 2
    if right is not None:
        both, tiles = both.unionByName(dealt(right, 1, gr, gl)), gl * gr
    if diagonals is not None:
        tiles = min(tiles, around * len(diagonals))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pack")
        if alone:
            a = pdf[pdf["own"] == pdf["tile_i"]]
            b = a if (pdf["tile_i"] == pdf["tile_j"]).all() else pdf[pdf["own"] == pdf["tile_j"]]
        else:
            a, b = pdf[pdf["_side"] == 0], pdf[pdf["_side"] == 1]
        return fn(a, b)

    n = tile_partitions(left.sparkSession, tiles)
    return both.repartition(n, "tile_i", "tile_j").groupBy("tile_i", "tile_j").applyInPandas(run, schema)


def shared_columns(left: Pack, right: Pack):
    """Positions of the columns that both packs hold, in the column lists of each."""
    at = np.searchsorted(right.col, left.col)
    at[at == len(right.col)] = 0
    hit = np.flatnonzero(right.col[at] == left.col) if len(right.col) else np.empty(0, np.int64)
    return hit, at[hit]


def cooccurrences(left: Pack, right: Pack, i: np.ndarray, j: np.ndarray, chunk: int = PAIR_CHUNK, rows=None):
    """Row of the left, row of the right, product: for all pairs of entries in the columns
    left.col[i] = right.col[j], some ``chunk`` at a time (a whole entry at least).  ``rows``:
    only for the left rows from the first up to before the second."""
    n = left.count[i]
    at = np.repeat(left.start[i], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)     # left entries
    start, cnt = np.repeat(right.start[j], n), np.repeat(right.count[j], n)
    if rows is not None:
        mine = (left.rows[at] >= rows[0]) & (left.rows[at] < rows[1])
        at, start, cnt = at[mine], start[mine], cnt[mine]
    cum = np.cumsum(cnt)
    pos = 0
    while pos < len(at):
        end = max(int(np.searchsorted(cum, (cum[pos - 1] if pos else 0) + chunk, side="right")), pos + 1)
        c = cnt[pos:end]
        li = np.repeat(at[pos:end], c)
        ri = np.arange(int(c.sum())) + np.repeat(start[pos:end] - (np.cumsum(c) - c), c)
        yield left.rows[li], right.rows[ri], left.vals[li] * right.vals[ri]
        pos = end


def _columns(pack: Pack, which: np.ndarray) -> np.ndarray:
    """The given columns (positions in ``pack.col``) as a dense (rows, columns) block."""
    out = np.zeros((len(pack), len(which)))
    n = pack.count[which]
    at = np.repeat(pack.start[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    np.add.at(out, (pack.rows[at], np.repeat(np.arange(len(which)), n)), pack.vals[at])
    return out


def _products(left: Pack, right: Pack) -> np.ndarray:
    """S = X_left @ X_right.T as a dense block."""
    ni, nj = len(left), len(right)
    S = np.zeros((ni, nj), dtype=np.float64)
    i, j = shared_columns(left, right)
    if len(i) == 0:
        return S
    dense = left.count[i].astype(np.float64) * right.count[j] * DENSE_RATIO > float(ni) * nj
    di, dj = i[dense], j[dense]
    for s in range(0, len(di), DENSE_COL_CHUNK):
        S += _columns(left, di[s:s + DENSE_COL_CHUNK]) @ _columns(right, dj[s:s + DENSE_COL_CHUNK]).T
    flat = S.reshape(-1)
    for r, c, p in cooccurrences(left, right, i[~dense], j[~dense]):
        flat += np.bincount(r.astype(np.int64) * nj + c, weights=p, minlength=ni * nj)
    return S


# ------------------------------------------------------------------- best --

class _Best:
    """The k best others of the rows of a pack so far."""

    def __init__(self, pack: Pack, k: int, exclude_zero: bool):
        self.ids, self.k, self.exclude_zero = pack.ids, k, exclude_zero
        self.row, self.other = np.empty(0, np.int64), np.empty(0, np.int64)
        self.sim, self.key = np.empty(0), np.empty(0)
        self.floor = np.full(len(pack), HALF_PLACE / 4 if exclude_zero else -np.inf)

    def offer(self, sim: np.ndarray, ids: np.ndarray) -> None:
        """Similarities (rows of the pack, others); -inf where there is none."""
        reached = sim >= self.floor[:, None]
        if np.count_nonzero(reached) > 4 * self.k * len(self.ids):
            key = np.where(reached, round_half_up(sim), -np.inf)
            if self.exclude_zero:
                key[key <= 0] = -np.inf
            r, c = _topk(key, self.k)
        else:
            r, c = np.nonzero(reached)
        if len(r) == 0:
            return
        s = sim[r, c]
        key = round_half_up(s)
        ok = np.isfinite(s) & ((key > 0) | (not self.exclude_zero))
        row, other = np.append(self.row, r[ok]), np.append(self.other, ids[c[ok]])
        s, key = np.append(self.sim, s[ok]), np.append(self.key, key[ok])
        o = np.lexsort((other, -key, row))
        row = row[o]
        rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        o, row, rank = o[rank < self.k], row[rank < self.k], rank[rank < self.k]
        self.row, self.other, self.sim, self.key = row, other[o], s[o], key[o]
        full = rank == self.k - 1
        self.floor[row[full]] = np.maximum(self.floor[row[full]], self.key[full] - HALF_PLACE)

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame({"row_id": self.ids[self.row], "other_id": self.other, "sim": self.sim})


def _similarities(left: Pack, right: Pack) -> np.ndarray:
    S = _products(left, right)
    (al, nl), (ar, nr) = left.info, right.info
    if al.any() and ar.any():
        S += np.outer(al, ar)
    if (nl != 1).any() or (nr != 1).any():
        den = np.outer(nl, nr)
        S = np.divide(S, den, out=np.zeros_like(S), where=den > 0)
    _, i, j = np.intersect1d(left.ids, right.ids, return_indices=True)
    S[i, j] = -np.inf                                                       # self
    return S


def _full(packs: list[Pack], max_rows: int, max_entries: int) -> list[Pack]:
    """Small packs put together as long as they hold no more than a whole one."""
    out, run = [], []
    for p in [*packs, None]:
        if run and (p is None or sum(map(len, run)) + len(p) > max_rows or sum(len(x.rows) for x in run) + len(p.rows) > max_entries):
            out.append(run[0] if len(run) == 1 else Joined(run))
            run = []
        run.append(p)
    return out


class Joined(Pack):
    """Several packs as one."""

    def __init__(self, packs: list[Pack]):
        self.number = packs[0].number
        self.ids, self.rows, self.cols, self.vals = _joined(packs)
        ids = np.concatenate([p.ids for p in packs])
        self.info = np.concatenate([p.info for p in packs], axis=1)[:, np.argsort(ids, kind="stable")]
        first = np.ones(len(self.cols), dtype=bool)
        first[1:] = self.cols[1:] != self.cols[:-1]
        self.start = np.flatnonzero(first)
        self.col = self.cols[self.start]
        self.count = np.diff(np.append(self.start, len(self.cols)))


def _tile_fn(k: int, exclude_zero: bool, both_ways: bool, whole: tuple[int, int]):
    """k best of all rows of a tile (``both_ways``) or of those of its left side.  ``whole``:
    rows and entries of a whole pack."""
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        one = a is b
        left = _full([Pack(r, 2) for r in a.itertuples()], *whole)
        right = left if one else _full([Pack(r, 2) for r in b.itertuples()], *whole)
        best = [_Best(p, k, exclude_zero) for p in left]
        back = best if one else [_Best(p, k, exclude_zero) for p in right] if both_ways else []
        for x, p in enumerate(left):
            for y, q in enumerate(right):
                if one and y < x:
                    continue
                S = _similarities(p, q)
                best[x].offer(S, q.ids)
                if both_ways and not (one and x == y):
                    back[y].offer(S.T, p.ids)
        out = [t.frame() for t in (best if one else best + back)]
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"row_id": [], "other_id": [], "sim": []})
    return run


def blocks_for(n_rows: int, n_entries: int, max_rows: int, max_entries: int) -> int:
    return max(1, math.ceil(n_rows / max_rows), math.ceil(n_entries / max_entries))


def tile_partitions(spark, n_tiles: int) -> int:
    """Partitions for ``n_tiles`` tiles: two per tile for few tiles (hashing then
    puts about one in a task), a fixed number per core for many; a task works
    through its tiles one at a time, so memory does not depend on this."""
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return max(1, min(2 * n_tiles, most))


def _typed(entries: DataFrame, info: DataFrame):
    e = entries.select(F.col("row_id").cast("long"), F.col("col_id").cast("long"), F.col("value").cast("double"))
    return e, info.select(F.col("row_id").cast("long"), F.col("alpha").cast("double"), F.col("norm").cast("double"))


def _ranked(cand: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("row_id").orderBy(F.desc(F.round("sim", SCORE_PLACES)), F.asc("other_id"))
    return (cand.withColumn("rank", F.row_number().over(w).cast("long"))
                .where(F.col("rank") <= k))


def _rounds(jobs: list[tuple], k: int, entries: int) -> DataFrame:
    """The k best of several jobs (left packs, groups, tile function, right packs or None, groups).

    A job whose copies are more than ROUND_ENTRIES takes its tiles in rounds of diagonals; the
    best so far are written after each round, so that its copies can go."""
    spark = jobs[0][0].sparkSession
    cores, steps = spark.sparkContext.defaultParallelism, []
    for left, gl, fn, right, gr in jobs:
        around = gl if right is None else max(gl, gr)
        if around * entries <= ROUND_ENTRIES:
            steps.append((left, gl, fn, OUT_SCHEMA, right, gr))
            continue
        a_round = max(1, ROUND_ENTRIES // (2 * entries))
        if around * a_round < 2 * cores:                      # tiles for all cores in every round
            more = math.ceil(2 * cores / a_round)
            gl, gr = (more, 0) if right is None else (more if gl == around else gl, more if gr == around else gr)
            around = more
        each = range(around // 2 + 1 if right is None else around)
        steps += [(left, gl, fn, OUT_SCHEMA, right, gr, list(each[i:i + a_round])) for i in range(0, len(each), a_round)]
    best = None
    for n, step in enumerate(steps):
        found = pair_tiles(*step)
        if best is not None:
            found = found.unionByName(best)
        if n == len(steps) - 1:
            return _ranked(found, k)
        last, best = best, materialize(_ranked(found, k).drop("rank"), "tile-best")
        release(last)


def _size(packs: DataFrame, side: int) -> tuple[int, int, int]:
    """Packs, rows and entries of one side."""
    n = packs.where(F.col("side") == side).agg(F.count(F.lit(1)), F.sum("n_rows"), F.sum("n_entries")).first()
    return n[0], n[1] or 0, n[2] or 0


def cosine_topk(entries: DataFrame, info: DataFrame | None, k: int, exclude_zero: bool = False,
                max_rows_per_block: int = 2048, max_entries_per_block: int = 1_000_000,
                blocks: int | None = None, size: tuple[int, int] | None = None) -> DataFrame:
    """Top-k most similar other rows per row: (row_id, other_id, sim, rank).

    entries: (row_id long, col_id long, value double), one row per cell.
    info: (row_id long, alpha double, norm double), one row per row id;
    rows without entries still take part through alpha.  Without ``info`` the rows are those of
    the entries, each with alpha 0 and its own length.  ``blocks``: number of packs; ``size``: rows
    and entries where the caller knows them.
    """
    spark, whole = entries.sparkSession, (max_rows_per_block, max_entries_per_block)
    if info is None:
        n, m, e = _sized(entries, size)
        p = packed_by_length(e, int(blocks or blocks_for(n, m, *whole)), "tile-packs")
    else:
        e, inf = _typed(entries, info)
        # Entries are written once (checkpoint folder), so that sizing and packing
        # do not recompute them; callers materialise the frame that row info derives from.
        e = materialize(e, "tile-entries")
        n, m = inf.count(), e.count()
        p = packed(e, inf, int(blocks or blocks_for(n, m, *whole)), "tile-packs")
    if size is None:
        release(e)
    packs, n, m = _size(p, SEEDS)
    fn = _tile_fn(k, exclude_zero, True, (1, 1) if blocks else whole)
    return _rounds([(p, groups_for(spark, packs, n, m), fn, None, 0)], k, max(1, m))


def _sized(entries: DataFrame, size: tuple[int, int] | None):
    """Rows, entries and the typed frame, written to be counted where ``size`` is not given."""
    e = entries.select(F.col("row_id").cast("long"), F.col("col_id").cast("long"), F.col("value").cast("double"))
    if size is None:
        e = materialize(e, "tile-entries")
        size = e.select("row_id").distinct().count(), e.count()
    return *size, e


def cosine_topk_seeded(entries: DataFrame, info: DataFrame | None, seeds: DataFrame, k: int,
                       exclude_zero: bool = False, max_rows_per_block: int = 2048,
                       max_entries_per_block: int = 1_000_000, size: tuple[int, int] | None = None) -> DataFrame:
    """Top-k most similar other rows for the seed rows only.

    The work is |seeds| x |rows| instead of
    |rows|^2, for callers that need neighbours of a few rows (a user's best
    rated items, one probe title).  Same kernel, arguments and output as ``cosine_topk``.
    Without ``info`` every row is packed once, seeds apart from all others: pairs of seeds
    are looked at once for both, and seeds meet the others.
    """
    spark, whole = entries.sparkSession, (max_rows_per_block, max_entries_per_block)
    sd = seeds.select(F.col("row_id").cast("long")).distinct()
    if info is None:
        n, m, e = _sized(entries, size)
        p = packed_by_length(e, blocks_for(n, m, *whole), "tile-packs", sd)
        if size is None:
            release(e)
        (pl, nl, ml), (pr, nr, mr) = _size(p, SEEDS), _size(p, OTHERS)
        left, gl = p.where(F.col("side") == SEEDS), groups_for(spark, max(1, pl), nl, ml)
        right, gr = p.where(F.col("side") == OTHERS), groups_for(spark, max(1, pr), nr, mr)
        return _rounds([(left, gl, _tile_fn(k, exclude_zero, True, whole), None, 0),
                        (left, gl, _tile_fn(k, exclude_zero, False, whole), right, gr)], k, max(1, ml + mr))
    e, inf = _typed(entries, info)
    e = materialize(e, "tile-entries")
    se = materialize(e.join(sd, "row_id", "left_semi"), "tile-seed-entries")
    si = inf.join(sd, "row_id", "left_semi")

    def side(ent, inf_, name):
        n, m = inf_.count(), ent.count()
        packs = blocks_for(n, m, max_rows_per_block, max_entries_per_block)
        return packed(ent, inf_, packs, name), groups_for(spark, packs, n, m), m

    (left, gl, ml), (right, gr, mr) = side(se, si, "tile-seed-packs"), side(e, inf, "tile-packs")
    release(se)
    release(e)
    return _rounds([(left, gl, _tile_fn(k, exclude_zero, False, whole), right, gr)], k, max(1, ml + mr))
