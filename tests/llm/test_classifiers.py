import itertools

import numpy as np
import pytest

from affinity.llm import quality as Q
from affinity.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    g = np.random.default_rng(0)
    n = np.array([4, 1, 3])
    u, trans = g.normal(size=8), g.normal(size=(2, 2))
    a, b = Q.forward_backward(u, n, trans)
    at = 0
    for m in n:
        total, good = 0.0, np.zeros(m)
        for y in itertools.product((0, 1), repeat=int(m)):
            w = np.exp(sum(u[at + i] * y[i] for i in range(m)) + sum(trans[y[i], y[i + 1]] for i in range(m - 1)))
            total += w
            good += w * np.array(y)
        assert np.allclose(good / total, Q._sigmoid((a + b)[at:at + m]))
        at += m


def test_line_features_shape_and_neighbours():
    x, lens, n = Q.line_features([b"", b"one\nTWO!!\none"])
    assert x.shape == (4, Q.N_FEATURES) and n.tolist() == [1, 3] and lens.tolist() == [1, 3, 5, 3]
    assert np.allclose(x[2, :Q.N_OWN], x[1, 2 * Q.N_OWN:3 * Q.N_OWN])      # the next line's features
    assert x[3, 8] == 1 and x[1, 8] == 0                                   # a line seen before


def held_out_accuracy(spark, module, column, threshold):
    rows = module.query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold) for r in rows)
    held = [r for r in rows if r["held_out"]]
    return np.mean([r["predicted"] == r[column] for r in held])


def test_quality_held_out(spark):
    assert held_out_accuracy(spark, Q, "quality", 0.3) >= 0.95


def test_toxicity_held_out(spark):
    assert held_out_accuracy(spark, T, "toxic", 0.7) >= 0.93


@pytest.mark.parametrize("module,column", [(Q, "quality"), (T, "toxic")])
def test_edges(spark, module, column):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (2, "", "b"), (3, "x " * 60_000, "c"), (None, "y", "d")],
                                 "doc_id long, text string, _score string")
    none = spark.createDataFrame([], f"doc_id long, {column} int")
    model = module.fit(docs, none)
    out = module.score_column(docs, model).collect()
    assert len(out) == 5 and all(r["score"] == 0.5 and r["_score"] for r in out)
    one = spark.createDataFrame([(i, 1) for i in range(20)] + [(5, None), (None, 1)], f"doc_id long, {column} int")
    assert module.fit(docs.where("doc_id < 3"), one) == {"constant": 1.0}
    assert module.score_column(docs.limit(0), model).collect() == []


def test_quality_long_and_empty_texts_get_scores():
    x, lens, n = Q.line_features([b"good words here.", b"*** &&& $$$"] * 10)
    m = Q.fit_crf(x, lens, n, [1, 0] * 10, steps=30)
    s = Q.score_texts([b"", b"fine words here.\n" * 5000, b"*** &&&" * 20000], m)
    assert s.shape == (3,) and np.isfinite(s).all() and s[1] > s[2]


def test_network_gradient_is_exact():
    texts = [b"alpha beta gamma " * 4, b"delta", b"epsilon zeta " * 9]
    words, ids, lens = T.word_ids(texts)
    feats = T.word_features(words)
    doc, first, length = T.windows(lens)
    idx = ids[np.minimum(first[:, None] + np.arange(T.WINDOW), len(ids) - 1)]
    y = np.array([1, 0, 1])[doc]
    p = {k: v.astype(np.float64) for k, v in T._init().items()}

    def loss():
        z = T.window_logits(p, T.word_inputs(p, feats), ids, first, length)
        return np.mean(np.logaddexp(0, z) - y * z)

    g = T._gradient(p, feats, idx, length, y)
    for k in ("wf", "ub", "att", "out", "b", "bf"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        eps = 1e-2
        p[k][at] += eps
        up = loss()
        p[k][at] -= 2 * eps
        down = loss()
        p[k][at] += eps
        assert np.isclose((up - down) / (2 * eps), g[k][at], rtol=0.05, atol=1e-4), k


def test_windows_overlap_and_cover():
    lens = np.array([0, 1, 32, 33, 500])
    doc, first, length = T.windows(lens)
    for d, n in enumerate(lens):
        base = lens[:d].sum()
        spans = [(f - base, f - base + m) for f, m in zip(first[doc == d], length[doc == d])]
        assert set().union(*[range(a, b) for a, b in spans]) == set(range(n))
        assert all(b2 < e1 for (_, e1), (b2, _) in zip(spans, spans[1:]))


@pytest.mark.parametrize("module", [Q, T])
def test_rows_without_an_id_are_held_out(spark, module, tmp_path):
    spark.createDataFrame([(1, "a"), (None, "b"), (None, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = module.query(spark, str(tmp_path)).collect()
    assert len(rows) == 3 and all(r["held_out"] for r in rows if r["doc_id"] is None)


def test_features_do_not_follow_the_chunks(monkeypatch):
    words = [f"w{i % 7}x{i}".encode() for i in range(50)] + [b"", b"a"]
    whole, p = T.word_features(words), T._init()
    inputs = T.word_inputs(p, whole)
    monkeypatch.setattr(T, "WORDS", 3)
    assert all(np.array_equal(a, b) for a, b in zip(whole, T.word_features(words)))
    assert np.array_equal(inputs, T.word_inputs(p, whole))
