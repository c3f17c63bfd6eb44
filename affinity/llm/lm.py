"""Hashed maximum-entropy language model with a class-factored softmax.

A token is a lower-case (A-Z) word or the end mark that closes each text.  The
``HEAD_CLASSES * SLOTS`` most frequent training tokens form head classes of ``SLOTS``
tokens by frequency; all others (unseen ones too) fall into ``TAIL_CLASSES`` tail
classes by their last two bytes.

    P(w | h) = P(class | h) * P(w | class, h)

P(class | h) is a softmax over hashed features of the history: previous token
(bigram), previous two tokens (trigram), token before the previous one (skip).
Inside a head class a softmax over its slots uses the previous token and the skip
token, each joined with the class; inside a tail class the probability is the
smoothed share (c + 0.1) / (N_t + 0.1 (V_t + 1)) of the class.

Training: biases are the log shares of the exact corpus counts; feature weights
start at 0.  The training texts are dealt to ``rounds`` parts; in each round every
task runs gradient steps (row-wise AdaGrad) over its texts of that part from the
shared weights, and the weight rows are averaged over the tasks by how often each
saw the row.  Every training token is used once.  Texts are dealt to trainers by a
hash and read in its order; the number of trainers follows the training tokens alone, so
the same rows give the same weights in any partitioning and on any cluster.

Counts of all training tokens are one distributed aggregate.  Tokens with the
highest counts (at most ``HEAD`` of them) are broadcast as two arrays of fixed size;
rarer tokens get their counts through a shuffle join.

Edge cases: a null text counts as the empty text (one token, the end mark); with no
training text all counts are 0; repeated rows are scored each (and each counts in
training); other columns are ignored.
"""

from __future__ import annotations

from itertools import groupby, repeat
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import byte_chunks, doc_bucket, segment_sum, table, text_bytes, word_ids
from affinity.session import materialize

HEAD = 1 << 19
HEAD_CLASSES, SLOTS, TAIL_CLASSES = 16, 64, 16
CLASSES = HEAD_CLASSES + TAIL_CLASSES
ROWS = 1 << 14
BATCH = 2048
RATE = 0.1
END = b""
START = np.uint64(0x9E3779B97F4A7C15)
BLOCK_ROWS = 2048
LEAST_TRAINERS, TOKENS_A_TRAINER = 16, 1 << 22
SALTS = 32               # groups of trainers whose rows are added up first
LOG10 = np.log(10.0)


def tail_class(words: list[bytes]) -> np.ndarray:
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    letters = np.frombuffer(b"\0\0" + b"".join(words), dtype=np.uint8).astype(np.int64)
    ends = np.cumsum(lens) + 2
    return np.where(lens > 1, (letters[ends - 1] * 31 + letters[ends - 2]) % TAIL_CLASSES, 0)


def hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 with Spark's seed, so that values equal F.xxhash64 of the binary."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), dtype=np.uint64, count=len(words))


def _row(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(50)).astype(np.int64)


class Tokens:
    """Token sequence of some texts: word indices with end marks, and histories."""

    def __init__(self, texts: list[bytes]):
        words, ids, lens = word_ids(texts)
        self.words = [*words, END]
        self.ids = np.insert(ids, np.cumsum(lens), len(words))
        self.lens = lens + 1
        self.hash = hashes(self.words)

    def history(self):
        seq = self.hash[self.ids]
        first = np.cumsum(self.lens) - self.lens
        p1, p2 = np.empty_like(seq), np.empty_like(seq)
        p1[1:], p2[2:] = seq[:-1], seq[:-2]
        p1[first] = START
        p2[:2] = START
        p2[first] = START
        second = first + 1
        p2[second[second < len(seq)]] = START
        return p1, p2


def class_rows(p1, p2):
    a = p1 * np.uint64(0xD6E8FEB86659FD93)
    b = p2 * np.uint64(0xA0761D6478BD642F)
    return _row(a), _row(b + np.uint64(1)), _row(a ^ (b >> np.uint64(7)) ^ np.uint64(2))


def slot_rows(p1, p2, cls):
    c = (cls.astype(np.uint64) + np.uint64(1)) * np.uint64(0xE7037ED1A0B428DB)
    return (_row(p1 * np.uint64(0x8EBC6AF09C88C6E3) ^ c), _row(p2 * np.uint64(0x589965CC75374CC3) ^ c))


class Vocabulary:
    """Counts of the most frequent tokens, classes, and the counts' totals."""

    def __init__(self, head_hash, head_count, head_tail, total, distinct, tail_n, tail_v):
        order = np.lexsort((head_hash, -head_count))
        top = order[:HEAD_CLASSES * SLOTS]
        self.n, self.v = int(total), int(distinct)
        rank = np.full(len(head_hash), -1, dtype=np.int32)
        rank[top] = np.arange(len(top), dtype=np.int32)
        by = np.argsort(head_hash, kind="stable")
        self.hash, self.count, self.rank = head_hash[by], head_count[by].astype(np.int64), rank[by]
        self.tail_n = np.asarray(tail_n, dtype=np.float64) - np.bincount(
            head_tail[top], weights=head_count[top], minlength=TAIL_CLASSES)
        self.tail_v = np.asarray(tail_v, dtype=np.float64) - np.bincount(head_tail[top], minlength=TAIL_CLASSES)
        slots = np.zeros(HEAD_CLASSES * SLOTS)
        slots[:len(top)] = head_count[top]
        slots = slots.reshape(HEAD_CLASSES, SLOTS)
        used = np.arange(HEAD_CLASSES * SLOTS).reshape(HEAD_CLASSES, SLOTS) < len(top)
        n_class = np.concatenate([slots.sum(axis=1), self.tail_n]) + 0.1
        self.class_bias = np.log(n_class / n_class.sum()).astype(np.float32)
        self.slot_bias = np.where(used, np.log(slots + 0.1), -1e4).astype(np.float32)

    def look_up(self, t: Tokens):
        """(count, class, slot or -1, in head) of every distinct token."""
        at = np.minimum(np.searchsorted(self.hash, t.hash), max(len(self.hash) - 1, 0))
        known = self.hash[at] == t.hash if len(self.hash) else np.zeros(len(t.hash), dtype=bool)
        count = np.where(known, self.count[at], 0) if len(self.hash) else np.zeros(len(t.hash), np.int64)
        rank = np.where(known, self.rank[at], -1) if len(self.hash) else np.full(len(t.hash), -1)
        cls = np.where(rank >= 0, rank // SLOTS, HEAD_CLASSES + tail_class(t.words))
        return count, cls, np.where(rank >= 0, rank % SLOTS, -1), known


def _rows(bias, weights, features):
    """Sums of the bias and the weight rows of the features, in a new array."""
    z = bias + np.take(weights, features[0], axis=0)
    for f in features[1:]:
        z += np.take(weights, f, axis=0)
    return z


def _softmax(z):
    """z less its greatest of the row (in place), its exp, and the sum of that; the row length
    is a power of two."""
    top = z
    while top.shape[1] > 1:                               # halves at a time: short rows are slow to reduce
        half = top.shape[1] // 2
        top = np.maximum(top[:, :half], top[:, half:])
    z -= top
    e = np.exp(z)
    return z, e, e.sum(axis=1, keepdims=True)


def new_weights() -> dict:
    return {"class": np.zeros((ROWS, CLASSES), np.float32), "slot": np.zeros((ROWS, SLOTS), np.float32)}


def log_probs(w: dict, voc: Vocabulary, p1, p2, cls, slot) -> np.ndarray:
    """Natural log of P(class | h), and for head tokens of P(slot | class, h) too."""
    out = np.empty(len(cls), dtype=np.float64)
    for s in range(0, len(cls), BATCH):
        e = slice(s, s + BATCH)
        f1, f2, f3 = class_rows(p1[e], p2[e])
        z, _, total = _softmax(_rows(voc.class_bias, w["class"], (f1, f2, f3)))
        c = cls[e]
        r = np.arange(len(c))
        lp = z[r, c] - np.log(total[:, 0])
        head = np.flatnonzero(slot[e] >= 0)
        if len(head):
            g1, g2 = slot_rows(p1[e][head], p2[e][head], c[head])
            z, _, total = _softmax(_rows(np.take(voc.slot_bias, c[head], axis=0), w["slot"], (g1, g2)))
            lp[head] += z[np.arange(len(head)), slot[e][head]] - np.log(total[:, 0])
        out[e] = lp
    return out


def _update(weights, seen, energy, rows, d):
    """One AdaGrad step on the rows that fire; ``rows``: feature arrays of one batch."""
    n = len(d)
    flat = np.concatenate(rows)
    order = np.argsort(flat.astype(np.uint16), kind="stable")
    at = flat[order]
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    run = np.take(d, order % n, axis=0)
    pairs = run.view(np.complex64)                        # two columns a pass: adding waits for the sum before
    np.cumsum(pairs, axis=0, out=pairs)                   # sums of segments as differences
    ends = np.take(run, np.append(start[1:], len(at)) - 1, axis=0)
    g = ends.copy()
    g[1:] -= ends[:-1]
    touched = at[start]
    power = energy[touched] + np.einsum("ij,ij->i", g, g) / g.shape[1]
    energy[touched] = power
    g *= RATE
    g /= np.sqrt(power + 1e-6)[:, None]
    weights[touched] = np.subtract(np.take(weights, touched, axis=0), g, out=g)
    seen[touched] += np.diff(np.append(start, len(at)))


def train_tokens(w: dict, seen: dict, energy: dict, voc: Vocabulary, p1, p2, cls, slot) -> None:
    for s in range(0, len(cls), BATCH):
        e = slice(s, s + BATCH)
        rows = class_rows(p1[e], p2[e])
        c = cls[e]
        _, ex, total = _softmax(_rows(voc.class_bias, w["class"], rows))
        d = np.divide(ex, total, out=ex)
        d[np.arange(len(c)), c] -= 1.0
        _update(w["class"], seen["class"], energy["class"], rows, d)
        head = np.flatnonzero(slot[e] >= 0)
        if len(head):
            rows = slot_rows(p1[e][head], p2[e][head], c[head])
            _, ex, total = _softmax(_rows(np.take(voc.slot_bias, c[head], axis=0), w["slot"], rows))
            d = np.divide(ex, total, out=ex)
            d[np.arange(len(head)), slot[e][head]] -= 1.0
            _update(w["slot"], seen["slot"], energy["slot"], rows, d)


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token binary, tail, c) over all texts of ``docs``."""
    def partial(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for s, e in byte_chunks(texts, 8 << 20):
                words, ids, _ = word_ids(texts[s:e])
                words.append(END)
                c = np.append(np.bincount(ids, minlength=len(words) - 1), e - s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(tail_class(words), pa.int32()), pa.array(c, pa.int64())],
                    ["token", "tail", "n"])
    return (docs.select("text").mapInArrow(partial, "token binary, tail int, n long")
                .groupBy("token").agg(F.first("tail").alias("tail"), F.sum("n").alias("c")))


def vocabulary(counts: DataFrame, head: int = HEAD) -> Vocabulary:
    totals = {r["tail"]: r for r in counts.groupBy("tail").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    tail_n = [totals[t]["n"] if t in totals else 0 for t in range(TAIL_CLASSES)]
    tail_v = [totals[t]["v"] if t in totals else 0 for t in range(TAIL_CLASSES)]
    # The least count whose tokens number at most ``head``: the broadcast is bounded.
    room, least = head, None
    for r in (counts.groupBy(F.least("c", F.lit(100_000)).alias("c")).count().orderBy(F.desc("c")).collect()):
        if r["count"] > room:
            break
        room, least = room - r["count"], r["c"]
    rows = (counts.where(F.col("c") >= least).select(F.xxhash64("token").alias("h"), "c", "tail").toPandas()
            if least is not None else pd.DataFrame({"h": [], "c": [], "tail": []}))
    return Vocabulary(rows["h"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64),
                      rows["tail"].to_numpy(np.int64), sum(tail_n), sum(tail_v), tail_n, tail_v)


def _steady_chunks(batches, limit: int = 4 << 20):
    """Texts in chunks of about ``limit`` bytes that do not depend on the batches."""
    held, size = [], 0
    for batch in batches:
        for t in text_bytes(batch.column("text")):
            if size and size + len(t) > limit:
                yield held
                held, size = [], 0
            held.append(t)
            size += len(t) + 1
    if held:
        yield held


def _by_trainer(batches):
    """(trainer, its batches) of rows sorted by trainer."""
    def cut():
        for batch in batches:
            t = batch.column("trainer").to_numpy()
            ends = np.append(np.flatnonzero(t[1:] != t[:-1]) + 1, len(t))
            for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist()):
                if a < b:
                    yield int(t[a]), batch.slice(a, b - a)
    for trainer, rows in groupby(cut(), key=itemgetter(0)):
        yield trainer, (batch for _, batch in rows)


def _trainer(voc, weights):
    def run(batches):
        for trainer, rows in _by_trainer(batches):
            start, w = weights.value, {k: v.copy() for k, v in weights.value.items()}
            seen = {k: np.zeros(ROWS, np.float64) for k in w}
            energy = {k: np.zeros(ROWS, np.float32) for k in w}
            for texts in _steady_chunks(rows):
                t = Tokens(texts)
                p1, p2 = t.history()
                _, cls, slot, _ = voc.value.look_up(t)
                train_tokens(w, seen, energy, voc.value, p1, p2, cls[t.ids], slot[t.ids])
            for k in w:
                moved = (w[k] - start[k]) * seen[k][:, None].astype(np.float32)
                for b in range(0, ROWS, BLOCK_ROWS):
                    yield pa.RecordBatch.from_pydict({
                        "part": pa.array([k]), "block": pa.array([b], pa.int32()),
                        "salt": pa.array([trainer % SALTS], pa.int32()),
                        "moved": pa.array([moved[b:b + BLOCK_ROWS].tobytes()], pa.binary()),
                        "seen": pa.array([seen[k][b:b + BLOCK_ROWS].tobytes()], pa.binary())})
    return run


def _add_up(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["moved", "seen"])          # sums of floats follow one order
    moved = sum(np.frombuffer(x, np.float32) for x in pdf["moved"])
    seen = sum(np.frombuffer(x, np.float64) for x in pdf["seen"])
    return pd.DataFrame({"part": [pdf["part"].iat[0]], "block": [pdf["block"].iat[0]], "salt": [pdf["salt"].iat[0]],
                         "moved": [moved.tobytes()], "seen": [seen.tobytes()]})


def train(docs: DataFrame, voc, rounds: int = 2) -> dict:
    """Weights after ``rounds`` parts of the training texts (one pass in all)."""
    spark = docs.sparkSession
    schema = "part string, block int, salt int, moved binary, seen binary"
    trainers = max(LEAST_TRAINERS, -(-voc.value.n // TOKENS_A_TRAINER))
    weights = new_weights()
    for r in range(rounds):
        shared = spark.sparkContext.broadcast(weights)
        part = (docs.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(rounds)) == r)
                    .select(F.xxhash64("doc_id", "text").alias("h"), "text")
                    .withColumn("trainer", F.pmod(F.hash("h"), F.lit(trainers))))
        # A trainer is named by its rows, so more partitions make no more weight rows; twice
        # as many partitions as trainers part them all.
        sums = (part.repartitionByRange(2 * trainers, "trainer").sortWithinPartitions("trainer", "h", "text")
                    .select("trainer", "text").mapInArrow(_trainer(voc, shared), schema))
        if trainers > SALTS:
            sums = sums.groupBy("part", "block", "salt").applyInPandas(_add_up, schema)
        sums = sums.groupBy("part", "block").applyInPandas(_add_up, schema)
        weights = {k: v.copy() for k, v in weights.items()}
        for row in sums.toLocalIterator():
            width = weights[row["part"]].shape[1]
            seen = np.frombuffer(row["seen"], np.float64)
            moved = np.frombuffer(row["moved"], np.float32).reshape(-1, width)
            at = slice(row["block"], row["block"] + BLOCK_ROWS)
            weights[row["part"]][at] += moved / np.maximum(seen, 1.0)[:, None].astype(np.float32)
        shared.unpersist()
    return weights


def _scorer(voc, weights):
    def run(batches):
        for batch in batches:
            texts, ids = text_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            rid, held = batch.column("rid").to_pylist(), batch.column("held_out").to_pylist()
            for s, e in byte_chunks(texts):
                t, v = Tokens(texts[s:e]), voc.value
                p1, p2 = t.history()
                count, cls, slot, known = v.look_up(t)
                lp = log_probs(weights.value, v, p1, p2, cls[t.ids], slot[t.ids]) / LOG10
                base = np.where(known, np.log10((count + 0.1) / (v.n + 0.1 * (v.v + 1))), 0.0)
                tail = np.maximum(cls - HEAD_CLASSES, 0)
                share = np.where(known & (slot < 0), np.log10((count + 0.1) / (
                    v.tail_n[tail] + 0.1 * (v.tail_v[tail] + 1))), 0.0)
                n = len(t.lens)
                rare = ~known[t.ids]
                doc = np.repeat(np.arange(n), t.lens)[rare]
                key, tf = np.unique(doc * len(t.words) + t.ids[rare], return_counts=True)
                words = np.array(t.words, dtype=object)[key % len(t.words)] if len(key) else []
                m = len(key)
                yield pa.RecordBatch.from_pydict({
                    "rid": pa.array(rid[s:e] + [rid[s + d] for d in key // len(t.words)], pa.int64()),
                    "doc_id": pa.array(ids[s:e] + [None] * m, pa.int64()),
                    "held_out": pa.array(held[s:e] + [None] * m, pa.bool_()),
                    "n_tokens": pa.array(np.append(t.lens, np.zeros(m, np.int64)), pa.int64()),
                    "n_known": pa.array(np.append(segment_sum(known[t.ids], t.lens).round().astype(np.int64), np.zeros(m, np.int64)),
                                        pa.int64()),
                    "base": pa.array(np.append(segment_sum(base[t.ids], t.lens), np.zeros(m))),
                    "score": pa.array(np.append(segment_sum(lp + share[t.ids], t.lens), np.zeros(m))),
                    "token": pa.array([None] * n + list(words), pa.binary()),
                    "tail": pa.array(np.append(np.zeros(n, np.int64), tail[key % len(t.words)]), pa.int32()),
                    "tf": pa.array(np.append(np.zeros(n, np.int64), tf), pa.int64())})
    return run


def score_documents(docs: DataFrame, head: int = HEAD, rounds: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    held = doc_bucket("doc_id", 10) == 0
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learn = d.where(F.coalesce(~held, F.lit(False)))
    counts = materialize(count_tokens(learn), "op4-counts")
    v = vocabulary(counts, head)
    voc = spark.sparkContext.broadcast(v)                      # at most HEAD tokens
    weights = spark.sparkContext.broadcast(train(learn, voc, rounds))     # fixed size
    schema = ("rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double,"
              "token binary, tail int, tf long")
    parts = (d.withColumn("rid", F.monotonically_increasing_id()).withColumn("held_out", F.coalesce(held, F.lit(True)))
              .mapInArrow(_scorer(voc, weights), schema))
    parts = materialize(parts, "op4-parts")
    per_class = spark.createDataFrame(
        [(t, float(v.tail_n[t] + 0.1 * (v.tail_v[t] + 1))) for t in range(TAIL_CLASSES)], "tail int, mass double")
    rare = (parts.where("token IS NOT NULL").select("rid", "token", "tail", "tf")
                 .join(counts.select("token", "c"), "token", "left").join(F.broadcast(per_class), "tail")
                 .withColumn("c", F.coalesce("c", F.lit(0)))
                 .groupBy("rid").agg(
                     F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("r_known"),
                     F.sum(F.col("tf") * F.log10((F.col("c") + 0.1) / F.lit(v.n + 0.1 * (v.v + 1)))).alias("r_base"),
                     F.sum(F.col("tf") * F.log10((F.col("c") + 0.1) / F.col("mass"))).alias("r_score")))
    whole = parts.where("token IS NULL").join(rare, "rid", "left")
    add = lambda a, b, zero: (F.col(a) + F.coalesce(F.col(b), F.lit(zero)))
    return whole.select("doc_id", "held_out", "n_tokens", add("n_known", "r_known", 0).cast("long").alias("n_known"),
                        F.lit(v.n).cast("long").alias("train_tokens"), add("base", "r_base", 0.0).alias("base_score"),
                        add("score", "r_score", 0.0).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
