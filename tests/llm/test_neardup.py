import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from affinity.llm import neardup as N
from affinity.llm.components import components


def plain_classes(docs, threshold=0.8):
    """Components of all pairs by unweighted Jaccard similarity, through all pairs."""
    sets = {}
    for i, t in docs:
        w = N.words_of(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} if w else {("raw", t or "")}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def classes(docs):
    return {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs).collect()}


def test_equals_all_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert classes(df) == plain_classes([(r["doc_id"], r["text"]) for r in df.collect()])


def test_planted_copies_hot_group_and_strangers(spark):
    g = random.Random(4)
    word = lambda: "".join(g.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(200)]
    rows = []
    for i in range(150):                                       # near copies: two words changed
        w = list(base)
        for _ in range(2):
            w[g.randrange(200)] = word()
        rows.append((i, " ".join(w), "k"))
    rows += [(1000 + i, "Exact, Copy here of some words!", "k") for i in range(120)]
    rows += [(2000 + i, " ".join(word() for _ in range(80)), "k") for i in range(60)]
    got = classes(spark.createDataFrame(rows, "doc_id long, text string, key string"))
    assert {got[i] for i in range(150)} == {0} and {got[1000 + i] for i in range(120)} == {1000}
    assert all(got[2000 + i] == 2000 + i for i in range(60))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "one two"), (4, "ONE two."), (5, "one"), (6, "!!!"), (7, "!!!"), (8, "z " * 40_000),
            (8, "z " * 40_000), (9, "z " * 39_999), (None, "lonely text with a null id")]
    got = [(r["doc_id"], r["class_id"]) for r in
           N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6), (7, 6), (8, 8), (8, 8), (9, 8),
                                           (None, None)], key=str)
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_samples_agree_as_often_as_weighted_jaccard():
    g = np.random.default_rng(3)
    agree, want = [], []
    for _ in range(60):
        s = g.integers(1 << 62, size=300).astype(np.uint64)
        w = g.uniform(1, 8, size=300)
        keep, factor = g.random(300) < 0.8, np.where(g.random(300) < 0.2, 2.0, 1.0)
        a = N.sample(s, w, np.array([300]))[0]
        b = N.sample(s[keep], (w * factor)[keep], np.array([keep.sum()]))[0]
        w2 = np.where(keep, w * factor, 0)
        agree.append((a == b).mean())
        want.append(np.minimum(w, w2).sum() / np.maximum(w, w2).sum())
    assert abs(np.mean(agree) - np.mean(want)) < 0.03


def test_components(spark):
    g = random.Random(2)
    edges = [(f"{g.randrange(300):04d}", f"{g.randrange(300):04d}") for _ in range(200)]
    edges += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]           # a long chain
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u string, v string"), "t").collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[start] == min(seen)
    assert set(got) == set(near)


def test_sketches_keep_what_the_triangle_inequality_needs():
    """Probability that texts sharing two bands are not compared, by similarity."""
    rest = N.SAMPLES - 2 * N.BAND_ROWS
    lost = lambda agree, s: sum(math.comb(rest, k) * s ** k * (1 - s) ** (rest - k)
                                for k in range(agree - 2 * N.BAND_ROWS))
    assert lost(N.AGREE, 0.6) < 1e-4                             # leaders: grey pairs count
    assert lost(N.AGREE_EXTRA, 0.8) < 1e-3                       # only links count


def test_group_between_near_and_far_equals_all_pairs(spark):
    """Copies at similarities of some 0.55 to 0.85 to one another."""
    g = random.Random(11)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(3 + i % 12):
            w[g.randrange(300)] = f"x{g.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[k:k + 5]) for k in range(296)} for _, t in rows]
    sims = [len(a & b) / len(a | b) for k, a in enumerate(sets) for b in sets[:k]]
    assert min(sims) < 0.6 and max(sims) > 0.85
    got = classes(spark.createDataFrame(rows, "doc_id long, text string"))
    sh = N.Shingles([t for _, t in rows])
    idf = N._weights(np.bincount(N.idf_bucket(sh.s), minlength=N.IDF_BUCKETS))
    ends = np.cumsum(sh.n)
    texts = [dict(zip(sh.s[e - n:e].tolist(), (sh.c * idf[N.idf_bucket(sh.s)])[e - n:e].tolist())) for e, n in zip(ends, sh.n)]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = sum(min(w, texts[b][s]) for s, w in texts[a].items() if s in texts[b])
            if both >= 0.8 * (sum(texts[a].values()) + sum(texts[b].values()) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in range(len(rows))}


def test_near_copies_without_ids_are_linked(spark):
    long = [f"w{i}" for i in range(200)]
    rows = [(None, " ".join(long)), (None, " ".join(long[:-3])), (None, " ".join(f"z{i}" for i in range(50))), (7, "some other text here now")]
    got = N.classed_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in got) == [
        ("7", "7", 0), ("None", "None", 0), ("None", "None", 1), ("None", "None", 1)]
    assert len({r["root"] for r in got}) == 3
    rows.append((3, " ".join(long[3:])))
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in N.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()) == [
        ("3", "3"), ("7", "7"), ("None", "3"), ("None", "3"), ("None", "None")]


def test_texts_of_a_batch_are_cut_into_shingles_once(monkeypatch):
    """A leader's members share its shingles, and the texts of a batch are hashed together."""
    g = random.Random(5)
    texts = {i: " ".join(f"w{g.randrange(40)}" for _ in range(3 + 9 * i)) for i in range(30)}
    pairs = [(a, b) for a in (0, 7, 29) for b in range(30) if a != b]
    idf = type("B", (), {"value": np.linspace(1, 3, N.IDF_BUCKETS)})
    batch = pa.RecordBatch.from_pydict({
        "lead": pa.array([a for a, _ in pairs], pa.int64()), "other": pa.array([b for _, b in pairs], pa.int64()),
        "lead_text": [texts[a] for a, _ in pairs], "other_text": [texts[b] for _, b in pairs]})
    calls, real = [], N.Shingles
    monkeypatch.setattr(N, "Shingles", lambda t: calls.append(len(t)) or real(t))
    got = next(N._verifier(idf)([batch])).to_pylist()
    assert calls == [30]
    for r in got:
        x, y = (dict(zip(s.s.tolist(), (s.c * idf.value[N.idf_bucket(s.s)]).tolist())) for s in (
            real([texts[r["lead"]]]), real([texts[r["other"]]])))
        want = sum(min(x.get(k, 0), y.get(k, 0)) for k in {*x, *y}) / sum(max(x.get(k, 0), y.get(k, 0)) for k in {*x, *y})
        assert abs(r["sim"] - want) < 1e-12


def near_group(n, seed, least=3, kinds=9):
    """Copies of one text, ``least`` words of it changed or more; by default at similarities
    of some 0.6 to 0.9 to one another."""
    g = random.Random(seed)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(least + i % kinds):
            w[g.randrange(300)] = f"x{g.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    return rows


def test_links_are_all_similar_pairs_whatever_the_blocks(spark, monkeypatch):
    """Every text's number of links counts all texts similar to it; buckets dealt by a second
    band, small blocks and small packs meet the same pairs once."""
    rows = near_group(90, 12)
    sets = [{tuple(t.split()[k:k + 5]) for k in range(296)} for _, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sh = N.Shingles([t for _, t in rows])
    idf = N._weights(np.bincount(N.idf_bucket(sh.s), minlength=N.IDF_BUCKETS))
    i, j = np.triu_indices(len(rows), 1)
    sims = N.similarities([t for _, t in rows], i, j, idf)
    plain = np.array([len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in zip(i, j)])
    assert abs(sims - plain).max() < 0.1 and (sims < 0.75).sum() > 500
    want = np.bincount(np.append(i, j)[np.tile(sims >= 0.8, 2)], minlength=len(rows))
    first = None
    for large, side, pack in ((N.LARGE, N.SIDE, N.PACK), (1, 7, 11)):
        monkeypatch.setattr(N, "LARGE", large)
        monkeypatch.setattr(N, "SIDE", side)
        monkeypatch.setattr(N, "PACK", pack)
        got = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in N.near_duplicates(df).collect())
        first = first or got
        assert got == first
        assert [n for _, _, n in got] == want.tolist()


def test_pairs_of_a_group_never_become_rows(spark, monkeypatch):
    """The links written for a group grow with its texts, not with its pairs."""
    made, real = {}, N.materialize

    def counted(df, name="stage"):
        out = real(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(N, "materialize", counted)
    rows = near_group(200, 13, least=1, kinds=2)
    links = sum(r["n_links"] for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()) // 2
    assert links > 10 * len(rows)
    assert max(made.values()) <= 14 * len(rows) and made["op3-links"] <= 2 * len(rows)


def test_components_of_links_in_a_task():
    g = np.random.default_rng(7)
    a, b = g.integers(0, 400, size=(2, 260))
    a, b = np.append(a, np.arange(400, 499)), np.append(b, np.arange(401, 500))       # and a chain
    root = N._least_of(500, a, b)
    label = list(range(500))
    while any(label[x] != label[y] for x, y in zip(a, b)):
        for x, y in zip(a, b):
            label[x] = label[y] = min(label[x], label[y])
    assert root.tolist() == label
