"""Document quality from a linear-chain CRF over lines.

Every line is labelled good or bad from its own features and those of the lines
before and after it; a transition matrix couples neighbouring labels.  The
document score is the length-weighted mean of the forward-backward marginals of
"good", mapped to a probability by a one-dimensional logistic fit.

Learning uses at most ``sample`` labelled documents of each class (the smallest
hashes of their ids).  Labels exist for documents only: a first logistic pass
over lines finds which lines of a low-quality document look bad; the CRF is then
trained on those line labels by gradient steps on the exact log-likelihood.

Edge cases: a null text counts as the empty text, which is one empty line; with no
usable labels every score is 0.5, with one class only it is that class's value;
null labels are ignored, of several labels of one id the smallest counts;
repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import zlib
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import byte_chunks, doc_bucket, table, text_bytes

N_OWN = 11
N_FEATURES = 3 * N_OWN + 3
UPPER, LOWER, DIGIT, SPACE, SYMBOL, MARK = 1, 2, 3, 4, 5, 6       # SYMBOL: sentence punctuation; MARK: other


def _classes() -> np.ndarray:
    lut = np.full(256, MARK, dtype=np.uint8)
    lut[[ord(c) for c in ".,;:'\"()?!-"]] = SYMBOL
    lut[ord("A"):ord("Z") + 1] = UPPER
    lut[ord("a"):ord("z") + 1] = LOWER
    lut[128:] = LOWER
    lut[ord("0"):ord("9") + 1] = DIGIT
    lut[[32, 9, 10, 11, 12, 13]] = SPACE
    return lut


CLASS_OF = _classes()


def line_features(texts: list[bytes]):
    """(features of all lines, bytes per line, lines per text)."""
    lines: list[bytes] = []
    n_lines = np.empty(len(texts), dtype=np.int64)
    repeated: list[bool] = []
    stutter: list[float] = []
    for i, t in enumerate(texts):
        ls = t.split(b"\n")
        n_lines[i] = len(ls)
        seen: set[bytes] = set()
        for x in ls:
            repeated.append(len(x) > 0 and x in seen)
            seen.add(x)
            w = x.split()
            stutter.append(sum(map(eq, w, w[1:])) / (len(w) + 2.0))
        lines += ls
    lens = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    kind = CLASS_OF[np.frombuffer(b"".join(lines), dtype=np.uint8)]
    ends = np.cumsum(lens)
    starts = ends - lens

    def count(mask: np.ndarray) -> np.ndarray:
        c = np.concatenate([np.zeros(1, np.int64), np.cumsum(mask, dtype=np.int64)])
        return c[ends] - c[starts]

    size = np.maximum(lens, 1)
    spaces = count(kind == SPACE)
    symbol = kind >= SYMBOL
    double = np.zeros(len(kind), dtype=bool)
    double[1:] = symbol[1:] & symbol[:-1]
    packed = np.fromiter((len(zlib.compress(x, 1)) / len(x) if len(x) >= 48 else 0.6 for x in lines),
                         dtype=np.float64, count=len(lines))
    own = np.stack([
        np.log1p(lens) / 8.0,
        count(kind == UPPER) / size,
        4.0 * count(symbol) / size,
        8.0 * count(double) / size,
        4.0 * count(kind == DIGIT) / size,
        4.0 * spaces / size,
        np.minimum((size - spaces) / (spaces + 1.0), 40.0) / 10.0,
        2.0 * packed,
        np.asarray(repeated, dtype=np.float64),
        np.minimum(40.0 * count(kind == MARK) / (size + 20.0), 2.0),
        np.minimum(4.0 * np.asarray(stutter), 2.0),
    ], axis=1)
    first = np.zeros(len(lines), dtype=bool)
    at = np.cumsum(n_lines)
    first[(at - n_lines)] = True
    last = np.zeros(len(lines), dtype=bool)
    last[at - 1] = True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    before[first] = 0.0
    after[:-1] = own[1:]
    after[last] = 0.0
    x = np.concatenate([own, before, after, first[:, None], last[:, None], np.ones((len(lines), 1))], axis=1)
    return x, np.maximum(lens, 1).astype(np.float64), n_lines


def _steps(n_lines: np.ndarray):
    """Documents by decreasing line count, and how many still run at each step."""
    order = np.argsort(-n_lines, kind="stable")
    s = n_lines[order]
    alive = np.searchsorted(-s, -np.arange(1, (s[0] if len(s) else 0) + 1), side="right")
    return order, alive


def forward_backward(u: np.ndarray, n_lines: np.ndarray, trans: np.ndarray):
    """Log-odds of "good" from the left (own line included) and from the right
    (own line excluded), for all documents step by step; trans[i, j]: bad 0, good 1."""
    a, b = u.copy(), np.zeros_like(u)
    starts = np.cumsum(n_lines) - n_lines
    order, alive = _steps(n_lines)
    starts = starts[order]
    stops = starts + n_lines[order] - 1
    for t in range(1, len(alive)):
        i = starts[:alive[t]] + t
        p = a[i - 1]
        a[i] += np.logaddexp(p + trans[1, 1], trans[0, 1]) - np.logaddexp(p + trans[1, 0], trans[0, 0])
        j = stops[:alive[t]] - t
        q = b[j + 1] + u[j + 1]
        b[j] = np.logaddexp(q + trans[1, 1], trans[1, 0]) - np.logaddexp(q + trans[0, 1], trans[0, 0])
    return a, b


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class _Adam:
    def __init__(self, n: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(n), np.zeros(n), 0, rate

    def step(self, g: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        return -self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)


def _logistic(x, y, weight, l2=1e-5, steps=400, rate=0.1):
    w, opt = np.zeros(x.shape[1]), _Adam(x.shape[1], rate)
    weight = weight / weight.sum()
    for _ in range(steps):
        w = w + opt.step(x.T @ ((_sigmoid(x @ w) - y) * weight) + l2 * w)
    return w


def _share(p_good, lens, n_lines):
    ends = np.cumsum(n_lines)
    num = np.concatenate([[0.0], np.cumsum(p_good * lens)])
    den = np.concatenate([[0.0], np.cumsum(lens)])
    return (num[ends] - num[ends - n_lines]) / (den[ends] - den[ends - n_lines])


def fit_crf(x, lens, n_lines, labels, steps: int = 300, l2: float = 1e-5):
    """Weights, transitions and the final logistic map from line features and
    document labels (1 good, 0 bad)."""
    labels = np.asarray(labels, dtype=np.float64)
    doc = np.repeat(np.arange(len(n_lines)), n_lines)
    y = labels[doc]
    per_doc = lens / np.bincount(doc, weights=lens)[doc]
    balance = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))[doc]
    w = _logistic(x, y, per_doc * balance)
    # Lines of bad documents that look good are good; the worst line stays bad.
    z = x @ w
    worst = np.full(len(n_lines), np.inf)
    np.minimum.at(worst, doc, z)
    y = np.where(y == 1, 1.0, ((z > 0) & (z > worst[doc])).astype(float))
    trans = np.zeros((2, 2))
    first = np.zeros(len(y), dtype=bool)
    first[np.cumsum(n_lines) - n_lines] = True
    edge = np.flatnonzero(~first)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[edge - 1].astype(int), y[edge].astype(int)), 1.0)
    opt, n = _Adam(len(w) + 4, 0.05), max(len(y), 1)
    for _ in range(steps):
        u = x @ w
        a, b = forward_backward(u, n_lines, trans)
        p = _sigmoid(a + b)
        left, right = a[edge - 1], u[edge] + b[edge]
        e = np.stack([np.full(len(edge), trans[0, 0]), right + trans[0, 1],
                      left + trans[1, 0], left + right + trans[1, 1]])
        e = np.exp(e - e.max(axis=0)) if len(edge) else e
        expected = (e / e.sum(axis=0)).sum(axis=1).reshape(2, 2) if len(edge) else np.zeros((2, 2))
        g = np.concatenate([x.T @ (p - y) / n + l2 * w, ((expected - seen) / n + l2 * trans).ravel()])
        d = opt.step(g)
        w, trans = w + d[:-4], trans + d[-4:].reshape(2, 2)
    a, b = forward_backward(x @ w, n_lines, trans)
    share = _share(_sigmoid(a + b), lens, n_lines)
    m = np.stack([share, np.ones_like(share)], axis=1)
    bal = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
    return {"w": w, "trans": trans, "map": _logistic(m, labels, bal, l2=1e-4, steps=400, rate=0.2)}


def score_texts(texts: list[bytes], model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    if not texts:
        return np.zeros(0)
    x, lens, n_lines = line_features(texts)
    a, b = forward_backward(x @ model["w"], n_lines, model["trans"])
    share = _share(_sigmoid(a + b), lens, n_lines)
    return _sigmoid(model["map"][0] * share + model["map"][1])


def labelled_sample(labels: DataFrame, column: str, keep, sample: int) -> DataFrame:
    """At most ``sample`` ids of each class, by the smallest hash of the id."""
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
                 .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).where(keep)
                 .groupBy("doc_id").agg(F.min("label").alias("label")))
    pick = lambda v: lab.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return pick(0).unionByName(pick(1))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1500, keep=None) -> dict:
    """Model from at most ``sample`` labelled documents of each class."""
    keep = doc_bucket("doc_id", 5) != 0 if keep is None else keep
    picked = labelled_sample(labels, "quality", keep, sample)

    def features(batches):
        for batch in batches:
            texts, ys = text_bytes(batch.column("text")), batch.column("label").to_pylist()
            for s, e in byte_chunks(texts):
                x, lens, n_lines = line_features(texts[s:e])
                at = np.concatenate([[0], np.cumsum(n_lines)])
                yield pa.RecordBatch.from_pydict({
                    "label": pa.array(ys[s:e], pa.int32()),
                    "lines": pa.array(n_lines, pa.int64()),
                    "x": pa.array([x[at[i]:at[i + 1]].astype("<f4").tobytes() for i in range(e - s)], pa.binary()),
                    "len": pa.array([lens[at[i]:at[i + 1]].astype("<f8").tobytes() for i in range(e - s)],
                                    pa.binary())})

    # Bounded: 2 * sample ids, then the line features of those documents.
    ids = F.broadcast(picked)
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                .join(ids, "doc_id").mapInArrow(features, "label int, lines long, x binary, len binary").collect())
    found = {r["label"] for r in rows}
    if len(found) < 2:
        return {"constant": float(found.pop()) if found else 0.5}
    rows.sort(key=lambda r: (r["label"], r["lines"], bytes(r["x"])))
    x = np.concatenate([np.frombuffer(r["x"], "<f4").reshape(-1, N_FEATURES) for r in rows]).astype(np.float64)
    lens = np.concatenate([np.frombuffer(r["len"], "<f8") for r in rows])
    return fit_crf(x, lens, np.array([r["lines"] for r in rows]), [r["label"] for r in rows])


def score_column(docs: DataFrame, model: dict, column: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` plus their score."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        texts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in text]
        parts = [score_texts(texts[s:e], model) for s, e in byte_chunks(texts)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(column, score(F.col("text").cast("string")))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels)
    return (score_column(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(doc_bucket("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "score",
                    (F.col("score") >= 0.3).cast("int").alias("predicted")))
