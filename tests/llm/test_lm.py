import math
import zlib
from collections import Counter

import numpy as np
import pytest

from affinity.llm import lm as L

SF = "/root/testdata/sf0.001"


def brute(docs):
    tokens = {k: (t or "").encode().lower().split() + [b"<end>\n"] for k, (_, t) in enumerate(docs)}
    c = Counter()
    for k, (i, _) in enumerate(docs):
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            c.update(tokens[k])
    n, d = sum(c.values()), sum(c.values()) + 0.1 * (len(c) + 1)
    return n, [(i, len(tokens[k]), sum(c[w] > 0 for w in tokens[k]), sum(math.log10((c[w] + 0.1) / d) for w in tokens[k]))
               for k, (i, _) in enumerate(docs)]


@pytest.mark.parametrize("head", [7, 3000, L.HEAD])
def test_counts_and_base_equal_brute_force(spark, head):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    n, want = brute(docs)
    got = {r["doc_id"]: r for r in L.score_documents(df, head=head, rounds=1).collect()}
    assert len(got) == len(docs)
    for i, tokens, known, base in want:
        r = got[i]
        assert (r["train_tokens"], r["n_tokens"], r["n_known"]) == (n, tokens, known)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isfinite(r["score"])
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (3, "\x0b A\tb a\r\n", "c"), (None, "Zz", "d"), (4, "w " * 50_000, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token string")
    n, want = brute([r[:2] for r in rows])
    got = sorted(L.score_documents(df, rounds=1).collect(), key=lambda r: (r["doc_id"] or 0, r["n_tokens"]))
    want.sort(key=lambda r: (r[0] or 0, r[1]))
    for g, (i, tokens, known, base) in zip(got, want, strict=True):
        assert (g["doc_id"], g["n_tokens"], g["n_known"], g["train_tokens"]) == (i, tokens, known, n)
        assert math.isclose(g["base_score"], base, rel_tol=1e-9)
    assert L.score_documents(df.limit(0)).collect() == []


def test_probabilities_sum_to_one():
    words = [f"w{i}".encode() for i in range(700)]
    t = L.Tokens([b" ".join(words)])
    c = np.arange(len(t.words), 0, -1)
    tail = L.tail_class(t.words)
    v = L.Vocabulary(t.hash, c, tail, c.sum(), len(c), np.bincount(tail, weights=c, minlength=L.TAIL_CLASSES),
                     np.bincount(tail, minlength=L.TAIL_CLASSES))
    w = L.new_weights()
    g = np.random.default_rng(0)
    for k in w:
        w[k] += g.normal(size=w[k].shape).astype(np.float32)
    count, cls, slot, _ = v.look_up(t)
    p1, p2 = np.full(len(cls), 5, np.uint64), np.full(len(cls), 9, np.uint64)
    p = np.exp(L.log_probs(w, v, p1, p2, cls, slot))
    k = np.maximum(cls - L.HEAD_CLASSES, 0)
    p *= np.where(slot < 0, (count + 0.1) / (v.tail_n[k] + 0.1 * (v.tail_v[k] + 1)), 1.0)
    # Each tail class also holds 0.1 for an unseen token; unused classes hold the rest.
    unseen = np.exp(L.log_probs(w, v, p1[:16], p2[:16], L.HEAD_CLASSES + np.arange(16), np.full(16, -1))) \
        * 0.1 / (v.tail_n + 0.1 * (v.tail_v + 1))
    used = set(cls.tolist())
    empty = [x for x in range(L.HEAD_CLASSES) if x not in used]
    rest = np.exp(L.log_probs(w, v, p1[:len(empty)], p2[:len(empty)], np.array(empty, int), np.full(len(empty), -1))).sum() \
        if empty else 0.0
    assert math.isclose(p.sum() + unseen.sum() + rest, 1.0, rel_tol=1e-4)


def test_hash_equals_sparks(spark):
    words = [b"", b"a", "çã".encode(), b"x" * 100]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w binary").selectExpr("xxhash64(w)").collect()]
    assert L.hashes(words).view(np.int64).tolist() == got


def test_a_head_token_is_chosen_by_the_skip_token():
    """Words c and d follow the same word; only the word before that tells which."""
    t = L.Tokens([b"a x c\nb x d\n" * 500])
    count = np.bincount(t.ids, minlength=len(t.words))
    tail = L.tail_class(t.words)
    v = L.Vocabulary(t.hash, count, tail, count.sum(), len(count), np.bincount(tail, weights=count, minlength=L.TAIL_CLASSES),
                     np.bincount(tail, minlength=L.TAIL_CLASSES))
    _, cls, slot, _ = v.look_up(t)
    p1, p2 = t.history()
    w = L.new_weights()
    seen = {k: np.zeros(L.ROWS) for k in w}
    energy = {k: np.zeros(L.ROWS, np.float32) for k in w}
    for _ in range(30):
        L.train_tokens(w, seen, energy, v, p1, p2, cls[t.ids], slot[t.ids])
    c, d = t.words.index(b"c"), t.words.index(b"d")
    assert cls[c] == cls[d] and min(slot[c], slot[d]) >= 0
    at = np.flatnonzero(np.isin(t.ids, [c, d]))
    right = L.log_probs(w, v, p1[at], p2[at], cls[t.ids[at]], slot[t.ids[at]])
    other = np.where(t.ids[at] == c, d, c)
    wrong = L.log_probs(w, v, p1[at], p2[at], cls[other], slot[other])
    assert (right > wrong + 1).all()


def test_size_of_the_head():
    words = [b"w%d" % i for i in range(2000)]
    t = L.Tokens([b" ".join(words)])
    c = np.arange(len(t.words), 0, -1)
    tail = L.tail_class(t.words)
    v = L.Vocabulary(t.hash, c, tail, c.sum(), len(c), np.bincount(tail, weights=c, minlength=L.TAIL_CLASSES),
                     np.bincount(tail, minlength=L.TAIL_CLASSES))
    _, _, slot, _ = v.look_up(t)
    assert (slot[:1024] >= 0).all() and (slot[1024:] < 0).all()


def test_scores_do_not_follow_the_partitioning(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    first = None
    for n in (1, 3, 16):
        got = {r["doc_id"]: r["score"] for r in L.score_documents(df.repartition(n)).collect()}
        first = first or got
        assert got.keys() == first.keys() and all(math.isclose(got[i], first[i], rel_tol=1e-6) for i in got)


def test_weight_rows_follow_the_trainers_not_the_partitions(spark, monkeypatch):
    """Where a cluster deals the texts to more partitions, no more weight rows are made."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    made, weights = [], []
    real, dealt = L._trainer, type(df).repartitionByRange
    voc = spark.sparkContext.broadcast(L.vocabulary(L.count_tokens(df)))
    for least in (1, 80):
        rows = spark.sparkContext.accumulator(0)

        def counted(*a, rows=rows):
            run = real(*a)

            def counting(batches):
                for b in run(batches):
                    rows.add(b.num_rows)
                    yield b
            return counting

        monkeypatch.setattr(L, "_trainer", counted)
        monkeypatch.setattr(type(df), "repartitionByRange", lambda d, n, *c, least=least: dealt(d, max(n, least), *c))
        monkeypatch.setattr(type(df), "repartition", lambda d, n, *c, least=least, keep=type(df).repartition: keep(d, max(n, least), *c))
        weights.append(L.train(df, voc, rounds=1))
        made.append(rows.value)
        monkeypatch.undo()
    assert made[0] == made[1] <= L.LEAST_TRAINERS * 2 * L.ROWS // L.BLOCK_ROWS
    assert all((weights[0][k] == weights[1][k]).all() and weights[0][k].any() for k in weights[0])


@pytest.mark.parametrize("width", [32, 64])
def test_steps_keep_the_bits_of_the_plain_formulas(width):
    """Softmax in place with a greatest found by halves, and an update that sums two columns
    a pass: the same floats as row by row formulas."""
    rng = np.random.default_rng(width)
    z = rng.normal(size=(500, width)).astype(np.float32)
    low = z - z.max(axis=1, keepdims=True)
    got, e, total = L._softmax(z)
    assert got is z                                        # no further copy
    assert (got == low).all() and (e == np.exp(low)).all() and (total == np.exp(low).sum(axis=1, keepdims=True)).all()
    rows = [rng.integers(0, 90, 500) for _ in range(3)]
    d = rng.normal(size=(500, width)).astype(np.float32)
    w = rng.normal(size=(100, width)).astype(np.float32)
    seen, energy = np.zeros(100), rng.random(100).astype(np.float32)
    flat = np.concatenate(rows)
    order = np.argsort(flat, kind="stable")
    at, first, n = np.unique(flat[order], return_index=True, return_counts=True)
    run = np.cumsum(d[order % 500], axis=0)
    g = run[np.append(first[1:], len(flat)) - 1]
    g[1:] -= run[first[1:] - 1]
    want_e, want_w = energy.copy(), w.copy()
    want_e[at] += np.einsum("ij,ij->i", g, g) / width
    want_w[at] -= L.RATE * g / np.sqrt(want_e[at] + 1e-6)[:, None]
    L._update(w, seen, energy, rows, d)
    assert (w == want_w).all() and (energy == want_e).all() and (seen[at] == n).all()
