"""Toxicity score from a bidirectional gated recurrent network.

Words (lower-case A-Z, punctuation stripped at both ends) are the steps.  A step's
input joins a hashed word embedding and the mean of hashed embeddings of the
word's character 3- and 4-grams (ends marked).  Two gated recurrent layers read
each window in both directions, attention pools the steps, and the document score
is that of its most toxic window.  Windows of ``WINDOW`` words start every
``STRIDE`` words, so they overlap, and every window of the whole text is scored.

Learning (numpy, on the driver) uses at most ``sample`` labelled documents of each
class, the smallest hashes of their ids.  Only documents carry labels: one
embedding coordinate starts at the log-odds of the hashed feature; each round picks
the most toxic window of a toxic document and the two most toxic of a clean one
and trains on these.  A one-dimensional logistic fit maps the top window's logit to
the score.

Edge cases: a null text counts as the empty text, which has one window without
steps (its logit is the output bias); with no usable labels every score is 0.5,
with one class only that class's value; repeated rows are scored each; rows without an
id are never learnt from, so they count as held out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import byte_chunks, doc_bucket, table, word_ids
from affinity.llm.quality import _Adam, _logistic, _sigmoid, labelled_sample

WINDOW, STRIDE = 32, 24
BUCKETS, WORD_DIM, CHAR_DIM, HIDDEN = 1 << 15, 5, 7, 8
LEAST_DOCS = 3          # training documents that a word or a gram must occur in to have an embedding
DIM = WORD_DIM + CHAR_DIM
PUNCTUATION = b".,;:!?\"'()[]{}*$&%#|<>"
BLOCK = 2048
WORDS = 1 << 14         # words whose grams are made at a time


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64)


def word_features(words: list[bytes]):
    """(bucket per word, buckets of all character grams, grams per word)."""
    parts = [_some_features(words[s:s + WORDS]) for s in range(0, len(words), WORDS)] or [_some_features([])]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _some_features(words: list[bytes]):
    marked = [b"\x02" + w.strip(PUNCTUATION) + b"\x03" for w in words]
    lens = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    raw = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    ends = np.cumsum(lens)
    starts = ends - lens
    with np.errstate(over="ignore"):
        place = np.arange(len(raw)) - np.repeat(starts, lens)
        power = np.cumprod(np.full(int(lens.max(initial=1)) + 1, 0x100000001B3, dtype=np.uint64))
        word = _mix(np.add.reduceat((raw + np.uint64(1)) * power[place], starts) if len(words)
                    else np.zeros(0, np.uint64))
        grams, owner = [], []
        own = np.repeat(np.arange(len(marked)), lens)
        for n in (3, 4):
            if len(raw) < n:
                continue
            h = np.zeros(len(raw) - n + 1, dtype=np.uint64)
            for k in range(n):
                h = h * np.uint64(0x9E3779B1) + raw[k:len(raw) - n + 1 + k] + np.uint64(n)
            inside = own[:len(h)] == own[n - 1:]
            grams.append(_mix(h[inside] * np.uint64(0x9E3779B97F4A7C15)))
            owner.append(own[:len(h)][inside])
    if not grams:
        return word, np.zeros(0, np.int32), np.zeros(len(marked), np.int64)
    grams, owner = np.concatenate(grams).astype(np.int32), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return word, grams[order], np.bincount(owner, minlength=len(marked))


def _mean_rows(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), values.shape[1]), dtype=values.dtype)
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(values, starts, axis=0) / counts[full, None]
    return out


def word_inputs(p: dict, feats) -> np.ndarray:
    word, grams, counts = feats
    out = np.empty((len(word), DIM), dtype=p["word"].dtype)
    out[:, :WORD_DIM] = p["word"][word]
    ends = np.concatenate([[0], np.cumsum(counts)])
    for s in range(0, len(word), WORDS):
        e = min(s + WORDS, len(word))
        out[s:e, WORD_DIM:] = _mean_rows(p["char"][grams[ends[s]:ends[e]]], counts[s:e])
    return out


def windows(lens: np.ndarray):
    """(document, first word, length) of all overlapping windows of documents with
    ``lens`` words laid end to end."""
    n = np.where(lens <= WINDOW, 1, -(-(lens - WINDOW) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(lens)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    base = (np.cumsum(lens) - lens)[doc]
    return doc, base + k * STRIDE, np.minimum(WINDOW, lens[doc] - k * STRIDE)


def _sig(x):
    return 1.0 / (1.0 + np.exp(-x))


def _run(proj, idx, length, u, reverse, keep=None):
    """Hidden states per step of one direction; rows are windows."""
    m = len(idx)
    h = np.zeros((m, HIDDEN), dtype=np.float32)
    short = length < WINDOW
    some_short = short.any()
    order = range(WINDOW - 1, -1, -1) if reverse else range(WINDOW)
    for t in order:
        x = proj[idx[:, t]]
        hu = h @ u
        g = _sig(x[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
        z, r = g[:, :HIDDEN], g[:, HIDDEN:]
        n = np.tanh(x[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
        new = n + z * (h - n)
        if some_short:
            new = np.where((t < length)[:, None], new, 0.0).astype(np.float32)
        if keep is not None:
            keep.append((t, h, z, r, n, hu[:, 2 * HIDDEN:]))
        h = new
        yield t, h


def window_logits(p: dict, inputs: np.ndarray, ids: np.ndarray, first: np.ndarray, length: np.ndarray):
    """Logit of every window; ``inputs``: input row of every distinct word."""
    pf = (inputs @ p["wf"] + p["bf"]).astype(np.float32)
    pb = (inputs @ p["wb"] + p["bb"]).astype(np.float32)
    out = np.empty(len(first), dtype=np.float64)
    if len(ids) == 0:
        out[:] = p["b"]
        return out
    step = np.arange(WINDOW)
    av = p["att"].reshape(2, HIDDEN)
    ow = p["out"].reshape(2, HIDDEN)
    both = [np.stack([av[d], ow[d]], axis=1).astype(np.float32) for d in (0, 1)]
    for s in range(0, len(first), BLOCK):
        ln = length[s:s + BLOCK]
        at = np.minimum(first[s:s + BLOCK, None] + step, len(ids) - 1)
        idx = ids[at]
        att = np.zeros((len(ln), WINDOW), dtype=np.float32)
        val = np.zeros((len(ln), WINDOW), dtype=np.float32)
        for d, (proj, u, rev) in enumerate(((pf, p["uf"], False), (pb, p["ub"], True))):
            for t, h in _run(proj, idx, ln, u, rev):
                both_t = h @ both[d]
                att[:, t] += both_t[:, 0]
                val[:, t] += both_t[:, 1]
        mask = step < ln[:, None]
        att = np.where(mask, att, -1e9)
        e = np.exp(att - att.max(axis=1, keepdims=True)) * mask
        out[s:s + BLOCK] = (e * val).sum(axis=1) / np.maximum(e.sum(axis=1), 1e-9) + p["b"]
    return out


def _init(seed: int = 3) -> dict:
    g = np.random.default_rng(seed)
    r = lambda *s: (g.standard_normal(s) * 0.3).astype(np.float32)
    return {"word": r(BUCKETS, WORD_DIM) * 0.1, "char": r(BUCKETS, CHAR_DIM) * 0.1,
            "wf": r(DIM, 3 * HIDDEN), "wb": r(DIM, 3 * HIDDEN), "uf": r(HIDDEN, 3 * HIDDEN),
            "ub": r(HIDDEN, 3 * HIDDEN), "bf": np.zeros(3 * HIDDEN, np.float32),
            "bb": np.zeros(3 * HIDDEN, np.float32), "att": r(2 * HIDDEN), "out": r(2 * HIDDEN),
            "b": np.zeros(1, np.float32)}


def _gradient(p: dict, feats, idx, length, y):
    """Gradient of the mean logistic loss over windows (exact back-propagation)."""
    m = len(idx)
    words, inv = np.unique(idx, return_inverse=True)
    inv = inv.reshape(idx.shape)
    word, grams, counts = feats
    starts = np.cumsum(counts) - counts
    c = counts[words]
    flat = np.repeat(starts[words] - (np.cumsum(c) - c), c) + np.arange(c.sum())
    x = word_inputs(p, (word[words], grams[flat], c))
    kept = [[], []]
    states = np.zeros((m, WINDOW, 2 * HIDDEN), dtype=np.float32)
    for d, (w, bias, u, rev) in enumerate((("wf", "bf", "uf", False), ("wb", "bb", "ub", True))):
        proj = (x @ p[w] + p[bias]).astype(np.float32)
        for t, h in _run(proj, inv, length, p[u], rev, kept[d]):
            states[:, t, d * HIDDEN:(d + 1) * HIDDEN] = h
    mask = np.arange(WINDOW) < length[:, None]
    a = np.where(mask, states @ p["att"], -1e9)
    e = np.exp(a - a.max(axis=1, keepdims=True)) * mask
    alpha = e / np.maximum(e.sum(axis=1, keepdims=True), 1e-9)
    val = states @ p["out"]
    logit = (alpha * val).sum(axis=1) + p["b"][0]
    dl = ((_sigmoid(logit) - y) / m).astype(np.float32)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["b"][0] = dl.sum()
    dval = alpha * dl[:, None]
    datt = alpha * (val - (alpha * val).sum(axis=1, keepdims=True)) * dl[:, None]
    g["out"] = np.einsum("mt,mth->h", dval, states)
    g["att"] = np.einsum("mt,mth->h", datt, states)
    dstate = dval[:, :, None] * p["out"] + datt[:, :, None] * p["att"]
    dx = np.zeros_like(x)
    for d, (w, bias, u) in enumerate((("wf", "bf", "uf"), ("wb", "bb", "ub"))):
        dh = np.zeros((m, HIDDEN), dtype=np.float32)
        dproj = np.zeros((len(words), 3 * HIDDEN), dtype=np.float32)
        for t, h, z, r, n, hn in reversed(kept[d]):
            live = mask[:, t][:, None]
            dh = (dh + dstate[:, t, d * HIDDEN:(d + 1) * HIDDEN]) * live
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            dxt = np.concatenate([dz, dr, dn], axis=1)
            dhu = np.concatenate([dz, dr, dn * r], axis=1)
            g[u] += h.T @ dhu
            np.add.at(dproj, inv[:, t], dxt)
            dh = dh * z + dhu @ p[u].T
        g[bias] += dproj.sum(axis=0)
        g[w] += x.T @ dproj
        dx += dproj @ p[w].T
    np.add.at(g["word"], word[words], dx[:, :WORD_DIM])
    share = dx[:, WORD_DIM:] / np.maximum(c, 1)[:, None]
    np.add.at(g["char"], grams[flat], np.repeat(share, c, axis=0))
    return g


def _log_odds(buckets, doc, labels):
    """Log-odds of a hashed feature's presence in documents labelled 1 against 0."""
    pair = np.unique(doc * BUCKETS + buckets)
    b, y = pair % BUCKETS, labels[pair // BUCKETS]
    one = np.bincount(b[y == 1], minlength=BUCKETS)
    zero = np.bincount(b[y == 0], minlength=BUCKETS)
    n1, n0 = max(int((labels == 1).sum()), 1), max(int((labels == 0).sum()), 1)
    return np.log((one + 0.5) / (n1 + 1)) - np.log((zero + 0.5) / (n0 + 1))


def fit_network(texts: list[bytes], labels, rounds: int = 5, inner: int = 3, batch: int = 128,
                least_steps: int = 60) -> dict:
    labels = np.asarray(labels, dtype=np.int64)
    words, ids, lens = word_ids(texts)
    feats = word_features(words)
    doc_of = np.repeat(np.arange(len(texts)), lens)
    doc, first, length = windows(lens)
    p = _init()
    # Presence log-odds of words and of character grams start one coordinate each.
    pair = np.unique(doc_of * max(len(words), 1) + ids)
    pd_, pw = pair // max(len(words), 1), pair % max(len(words), 1)
    odds_w = _log_odds(feats[0][pw], pd_, labels)
    p["word"][:, 0] = np.clip(odds_w, -3, 3)
    counts = feats[2]
    starts = np.cumsum(counts) - counts
    cw = counts[pw]
    one = np.zeros(BUCKETS)
    zero = np.zeros(BUCKETS)
    for s in range(0, len(texts), 200):               # pairs of (document, gram), some documents at a time
        sel = (pd_ >= s) & (pd_ < s + 200)
        c = cw[sel]
        flat = np.repeat(starts[pw[sel]] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        u = np.unique(np.repeat(pd_[sel], c) * BUCKETS + feats[1][flat])
        y = labels[u // BUCKETS]
        one += np.bincount(u[y == 1] % BUCKETS, minlength=BUCKETS)
        zero += np.bincount(u[y == 0] % BUCKETS, minlength=BUCKETS)
    n1, n0 = max(int(labels.sum()), 1), max(int((1 - labels).sum()), 1)
    p["char"][:, 0] = np.clip(np.log((one + 0.5) / (n1 + 1)) - np.log((zero + 0.5) / (n0 + 1)), -3, 3)
    # Features of a few documents would only be learnt by heart.
    common = np.bincount(pw, minlength=len(words)) >= LEAST_DOCS
    known = {"word": np.zeros(BUCKETS, dtype=bool), "char": one + zero >= LEAST_DOCS}
    known["word"][feats[0][common]] = True
    for k, on in known.items():
        p[k][~on] = 0.0
    x = word_inputs(p, feats)
    logit = np.zeros(len(first))
    if len(ids):                                      # the first round picks windows by the log-odds alone
        per = (x[:, 0] + 2.0 * x[:, WORD_DIM])[ids]
        step = np.arange(WINDOW)
        for s in range(0, len(first), BLOCK):
            at = np.minimum(first[s:s + BLOCK, None] + step, len(ids) - 1)
            logit[s:s + BLOCK] = np.where(step < length[s:s + BLOCK, None], per[at], -9.0).max(axis=1)
    opts = {k: _Adam(v.size, 0.01) for k, v in p.items()}
    rng = np.random.default_rng(5)
    for _ in range(rounds):
        order = np.lexsort((-logit, doc))
        rank = np.arange(len(order)) - np.searchsorted(doc[order], doc[order], side="left")
        y_of = labels[doc[order]]
        pick = order[(rank < np.where(y_of == 1, 1, 2)) & (length[order] > 0)]
        for _ in range(max(inner, -(-least_steps // max(-(-len(pick) // batch), 1)))):
            rng.shuffle(pick)
            for s in range(0, len(pick), batch):
                b = pick[s:s + batch]
                at = np.minimum(first[b][:, None] + np.arange(WINDOW), max(len(ids) - 1, 0))
                g = _gradient(p, feats, ids[at], length[b], labels[doc[b]])
                for k, on in known.items():
                    g[k][~on] = 0.0
                for k in p:
                    p[k] = (p[k].ravel() + opts[k].step(g[k].ravel())).reshape(p[k].shape).astype(np.float32)
        logit = window_logits(p, word_inputs(p, feats), ids, first, length)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, doc, logit)
    top = np.clip(top, -8, 8)
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    p["map"] = _logistic(np.stack([top, np.ones_like(top)], axis=1), labels, weight, l2=1e-3, steps=400, rate=0.1)
    return p


def score_texts(texts: list[bytes], p: dict) -> np.ndarray:
    if "constant" in p:
        return np.full(len(texts), p["constant"])
    if not texts:
        return np.zeros(0)
    words, ids, lens = word_ids(texts)
    doc, first, length = windows(lens)
    inputs = word_inputs(p, word_features(words)) if words else np.zeros((0, DIM), np.float32)
    logit = window_logits(p, inputs, ids, first, length)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, doc, logit)
    return _sigmoid(p["map"][0] * np.clip(top, -8, 8) + p["map"][1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1500, keep=None) -> dict:
    """Model from at most ``sample`` labelled documents of each class (bounded
    rows reach the driver)."""
    keep = doc_bucket("doc_id", 3) != 1 if keep is None else keep
    picked = labelled_sample(labels, "toxic", keep, sample)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                .join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text").toArrow())
    rows = rows.set_column(2, "text", pc.fill_null(rows["text"], "")).sort_by([("doc_id", "ascending"), ("text", "ascending")])
    labels, texts = rows["label"].to_numpy(), rows["text"].cast(pa.binary()).to_pylist()
    del rows
    found = set(labels.tolist())
    if len(found) < 2:
        return {"constant": float(found.pop()) if found else 0.5}
    return fit_network(texts, labels)


def score_column(docs: DataFrame, model: dict, column: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` plus their score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # fixed size: hashed tables

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        texts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in text]
        parts = [score_texts(texts[s:e], shared.value) for s, e in byte_chunks(texts)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(column, score(F.col("text").cast("string")))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels)
    return (score_column(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(doc_bucket("doc_id", 3) == 1, F.lit(True)).alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted")))
