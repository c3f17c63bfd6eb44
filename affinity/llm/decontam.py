"""Benchmark decontamination: BM25 index of test items searched by every passage.

Test items are cut into index parts of at most ``PART`` words (steps of half of it).
A part's BM25 impacts are divided by the part's own total, so that a passage holding
the whole part scores 1 and the threshold means the same for short and long items.
Document frequencies are counted over all parts; the index is built in shards of
about ``SHARD_PARTS`` parts, and one shard at a time (bounded) is broadcast to the
tasks that scan the documents.

Every overlapping window of ``PASSAGE`` words of every document is a query.  The sums
of its distinct terms' maxima over super-blocks, then over blocks of ``BLOCK`` parts,
bound what any part can score; windows with a block at or above the threshold go
through block-max WAND, which returns all parts at or above it.  Each found item is verified in the document around
the window: at least ``overlap`` of the 3-grams of its question and of its answer (its
last line or sentence; none if it has only one) must occur there.  Of an item longer than
a part it is enough that this holds for the words of the found part; the answer counts
where the part holds more than half of it (of ``PART`` words, if it is longer).  The
overlaps given are those of the whole item.

Words are lower-case without ASCII punctuation.  Edge cases: null or empty texts and
items without words match nothing; items with a null id are ignored; equal items each
get their rows; repeated document rows give repeated results; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import byte_chunks, table, text_bytes, word_ids
from affinity.llm.neardup import PUNCTUATION, words_of
from affinity.session import materialize

PART, PASSAGE, STRIDE = 64, 128, 64
BLOCK, SUPER, SHARD_PARTS = 2, 4, 1000      # parts a block, blocks a super-block, parts a shard
K1, B = 1.2, 0.75
SCHEMA = ("doc_id long, item_id long, score double, question_overlap double, answer_overlap double,"
          "first_word long, n_passages long")


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer (the last line or sentence)."""
    text = (text or "").strip()
    cuts = [m.end() for m in re.finditer(r"\n+|(?<=[.?!])\s+", text)]
    while cuts:
        q, a = words_of(text[:cuts[-1]]), words_of(text[cuts[-1]:])
        if q and a:
            return q, a
        cuts.pop()
    return words_of(text), []


def part_of(q: list[bytes], a: list[bytes], part: int) -> tuple[list[bytes], list[bytes]]:
    """Words of the question and of the answer in an index part, without a lesser piece of the answer."""
    s = part * (PART // 2)
    e = s + PART
    answer = a[max(s - len(q), 0):max(e - len(q), 0)]
    return q[s:e], answer if 2 * len(answer) > min(len(a), PART) else []


def grams(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(3, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


class Index:
    """Impact-ordered inverted index of one shard."""

    def __init__(self, parts: list[tuple[int, dict[bytes, float]]], items: dict):
        self.item = [p[0] for p in parts]
        self.part = [p[2] if len(p) > 2 else 0 for p in parts]
        self.items = items
        post: dict[bytes, list[tuple[int, float]]] = {}
        for d, (_, impacts, *_) in enumerate(parts):
            for t, x in impacts.items():
                post.setdefault(t, []).append((d, x))
        self.terms = {t: i for i, t in enumerate(sorted(post))}
        self.docs: list[list[int]] = []
        self.impact: list[list[float]] = []
        n_blocks = -(-len(parts) // BLOCK)
        self.block_max = np.zeros((len(self.terms), max(n_blocks, 1)), dtype=np.float32)
        for t in self.terms:
            self.docs.append([x[0] for x in post[t]])
            self.impact.append([x[1] for x in post[t]])
            np.maximum.at(self.block_max[self.terms[t]], np.array(self.docs[-1]) // BLOCK,
                          np.array(self.impact[-1], dtype=np.float32))
        self.super_max = np.maximum.reduceat(self.block_max, np.arange(0, self.block_max.shape[1], SUPER), axis=1)
        self.term_max = np.array([max(w) for w in self.impact]) if self.impact else np.zeros(0)

    def search(self, terms: list[int], least: float) -> dict[int, float]:
        """Block-max WAND: all parts scoring at least ``least`` for the terms."""
        eps = 1e-9
        found: dict[int, float] = {}
        most = {t: float(self.term_max[t]) for t in terms}
        # A cursor is (document, position in the list, term): sorting needs no key.
        cursors = [(self.docs[t][0], 0, t) for t in terms]
        while cursors:
            cursors.sort()
            total, pivot = 0.0, None
            for i, c in enumerate(cursors):
                total += most[c[2]]
                if total >= least - eps:
                    pivot = i
                    break
            if pivot is None:
                break
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            ahead, block = cursors[:pivot + 1], doc // BLOCK
            bound = float(self.block_max[[c[2] for c in ahead], block].sum())
            if bound < least - 1e-5:                          # nothing in this block: skip it
                target = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    target = max(doc + 1, min(target, cursors[pivot + 1][0]))
            elif ahead[0][0] == doc:
                score = sum(self.impact[t][k] for _, k, t in ahead)
                if score >= least - eps:
                    found[doc] = score
                target = doc + 1
            else:
                target = doc
            moved = []
            for d, k, t in ahead:
                if d < target:
                    k = bisect_left(self.docs[t], target, k)
                    if k == len(self.docs[t]):
                        continue
                    d = self.docs[t][k]
                moved.append((d, k, t))
            cursors = moved + cursors[pivot + 1:]
        return found


def _parts(batches):
    """(item_id, part, term, tf, length) of all index parts."""
    for batch in batches:
        rows = {"item_id": [], "part": [], "term": [], "tf": [], "length": []}
        for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            words = words_of(text)
            starts = range(0, max(len(words) - PART // 2, 1), PART // 2)
            for k, s in enumerate(starts):
                cut = words[s:s + PART]
                for t in sorted(set(cut)):
                    rows["item_id"].append(item)
                    rows["part"].append(k)
                    rows["term"].append(t)
                    rows["tf"].append(cut.count(t))
                    rows["length"].append(len(cut))
        yield pa.RecordBatch.from_pydict({
            "item_id": pa.array(rows["item_id"], pa.int64()), "part": pa.array(rows["part"], pa.int32()),
            "term": pa.array(rows["term"], pa.binary()), "tf": pa.array(rows["tf"], pa.int32()),
            "length": pa.array(rows["length"], pa.int32())})


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["item_id", "copy", "part", "term"])
    parts, items = [], {}
    for (item, copy, part), g in pdf[pdf["term"].notna()].groupby(["item_id", "copy", "part"], sort=True):
        w = g["impact"].to_numpy(float)
        parts.append(((int(item), int(copy)), dict(zip(map(bytes, g["term"]), w / w.sum())), int(part)))
    for r in pdf[pdf["text"].notna()].itertuples():
        items[(int(r.item_id), int(r.copy))] = question_answer(r.text)
    return pd.DataFrame({"shard": [pdf["shard"].iat[0]], "index": [pickle.dumps((parts, items))]})


def index_shards(items: DataFrame) -> DataFrame:
    """(shard, index): pickled parts and item texts, about SHARD_PARTS parts a row."""
    it = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
               .where("item_id IS NOT NULL AND text IS NOT NULL")
               .withColumn("copy", F.monotonically_increasing_id()))
    it = materialize(it, "op1-items")
    parts = it.mapInArrow(_with_copy(_parts), "item_id long, part int, term binary, tf int, length int, copy long")
    parts = materialize(parts, "op1-parts")
    each = parts.select("item_id", "copy", "part", "length").distinct()
    total, mean = each.agg(F.count(F.lit(1)), F.avg("length")).first()
    if not total:
        return None
    n_shards = -(-total // SHARD_PARTS)
    df = parts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("length") / mean)
    rows = (parts.join(df, "term").withColumn("impact", idf * F.col("tf") * (K1 + 1) / norm)
                 .select("item_id", "copy", "part", "term", "impact", F.lit(None).cast("string").alias("text"))
                 .unionByName(it.select("item_id", "copy", F.lit(0).alias("part"), F.lit(None).cast("binary").alias("term"),
                                        F.lit(None).cast("double").alias("impact"), "text")))
    return (rows.withColumn("shard", F.pmod(F.xxhash64("copy"), F.lit(n_shards)).cast("int"))
                .groupBy("shard").applyInPandas(_shard, "shard int, index binary"))


def _with_copy(fn):
    """Run ``fn`` item by item and carry the item's row number along."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                for out in fn([one.select(["item_id", "text"])]):
                    yield pa.RecordBatch.from_arrays(
                        [*out.columns, pa.array([one.column("copy")[0].as_py()] * out.num_rows, pa.int64())],
                        [*out.schema.names, "copy"])
    return run


def search_texts(index: Index, texts: list[bytes], threshold: float, overlap: float):
    """(text number, item, score, question overlap, answer overlap, first word, passages)."""
    words, ids, lens = word_ids(texts)
    plain = [(w if w.isascii() else w.decode("utf-8", "surrogatepass").lower().encode("utf-8", "surrogatepass"))
             .translate(None, PUNCTUATION) for w in words]
    blank = np.array([not w for w in plain], dtype=bool)
    term = np.array([index.terms.get(w, -1) for w in plain], dtype=np.int64)
    doc = np.repeat(np.arange(len(texts)), lens)
    if len(ids):
        keep = ~blank[ids]                                    # marks without letters are no words
        ids, doc = ids[keep], doc[keep]
    lens = np.bincount(doc, minlength=len(texts))
    start_of = np.cumsum(lens) - lens
    pos = np.arange(len(ids)) - start_of[doc]
    t = term[ids] if len(ids) else np.zeros(0, np.int64)
    n_win = np.where(lens <= PASSAGE, 1, -(-(lens - PASSAGE) // STRIDE) + 1)
    win_of = np.cumsum(n_win) - n_win
    hit = np.flatnonzero(t >= 0)
    if not len(hit):
        return []
    # A word lies in window k when k * STRIDE <= position < k * STRIDE + PASSAGE.
    pairs = []
    last = pos[hit] // STRIDE
    for back in range(-(-PASSAGE // STRIDE)):
        k = last - back
        ok = (k >= 0) & (k < n_win[doc[hit]]) & (pos[hit] < k * STRIDE + PASSAGE)
        pairs.append((win_of[doc[hit][ok]] + k[ok]) * len(index.terms) + t[hit[ok]])
    pairs = np.sort(np.concatenate(pairs))
    pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]          # distinct terms of a window
    win, wt = pairs // len(index.terms), pairs % len(index.terms)
    start = np.flatnonzero(np.concatenate([[True], win[1:] != win[:-1]]))
    ends = np.append(start[1:], len(win))
    out: dict[tuple[int, tuple], list] = {}
    for i in _promising(index, wt, start, ends, threshold):
        sel = wt[start[i]:ends[i]]
        w = int(win[start[i]])
        d = int(np.searchsorted(win_of, w, side="right") - 1)
        for part, score in index.search(sel.tolist(), threshold).items():
            item = index.item[part]
            q, a = index.items[item]
            k = (w - int(win_of[d])) * STRIDE
            room = len(q) + len(a)
            lo, hi = max(0, k - room), min(int(lens[d]), k + PASSAGE + room)
            key = (d, item)
            if key in out and out[key][1] >= 1.0 and out[key][2] >= 1.0:
                out[key][0], out[key][4] = max(out[key][0], score), out[key][4] + 1
                continue
            near = [plain[x] for x in ids[start_of[d] + lo:start_of[d] + hi]]
            share = lambda x: (len(grams(x) & _all_grams(near, min(3, len(x)))) / len(grams(x))) if x else 1.0  # noqa: E731,B023
            sq, sa = share(q), share(a)
            found = sq >= overlap and sa >= overlap
            if not found and room > PART:
                found = all(share(x) >= overlap for x in part_of(q, a, index.part[part]))
            if found:
                old = out.get(key)
                out[key] = [max(score, old[0]), max(sq, old[1]), max(sa, old[2]), min(k, old[3]), old[4] + 1] if old \
                    else [score, sq, sa, k, 1]
    return [(d, item[0], *v) for (d, item), v in out.items()]


def _promising(index: Index, terms, start, ends, threshold: float) -> np.ndarray:
    """Windows (runs of ``terms``) whose bounds reach the threshold in some block."""
    left = np.arange(len(start))
    for bounds in (index.term_max[:, None], index.super_max, index.block_max):
        if not len(left):
            break
        size = (ends - start)[left]
        at = np.cumsum(size) - size
        flat = terms[np.repeat(start[left] - at, size) + np.arange(size.sum())]
        left = left[np.add.reduceat(bounds[flat], at, axis=0).max(axis=1) >= threshold - 1e-5]
    return left


def _all_grams(words, n):
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.5, overlap: float = 0.6) -> DataFrame:
    """One row per document row and test item that it holds."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = index_shards(items)
    results = []
    for row in shards.toLocalIterator() if shards is not None else ():   # one bounded shard at a time
        shared = spark.sparkContext.broadcast(bytes(row["index"]))
        results.append(d.mapInArrow(_searcher(shared, threshold, overlap), SCHEMA))
    return reduce(DataFrame.unionByName, results) if results else spark.createDataFrame([], SCHEMA)


def _searcher(shared, threshold, overlap):
    def run(batches):
        index = Index(*pickle.loads(shared.value))
        for batch in batches:
            texts, ids = text_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
            for s, e in byte_chunks(texts):
                rows = search_texts(index, texts[s:e], threshold, overlap)
                cols = list(zip(*rows)) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[s + x] for x in cols[0]], pa.int64()), pa.array(cols[1], pa.int64()),
                     *[pa.array(cols[k], pa.float64()) for k in (2, 3, 4)],
                     pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.int64())],
                    ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word", "n_passages"])
    return run


def query(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
