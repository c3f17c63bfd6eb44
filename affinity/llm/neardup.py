"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles.

Words are lower-case without ASCII punctuation; a shingle is five consecutive words
(all words of a shorter text).  The weight of a shingle in a text is its count there
times ln(1 + T / df) ** IDF_POWER, where df counts (text, shingle) incidences over ALL
texts in one of ``IDF_BUCKETS`` hash buckets and T is their total.  Bucketed counts
keep the table fixed in size.  The power damps the weights: the shingles that a large
group of near copies shares have a high df just because of the group, and undamped
weights would push the similarity of its members below that of a single pair.

1. Texts with equal words are one node (partial aggregates; copies are not expanded).
2. Improved consistent weighted sampling draws ``BANDS * BAND_ROWS`` samples a text.
   Texts that agree on all samples of two bands are candidates (at a similarity of
   0.8 two of 14 bands agree with probability 0.9993; texts that only share a common
   passage rarely agree on two).
3. Texts that share a band share a bucket; the members of a bucket of more than ``LARGE``
   share a bucket only with those that share another band too.  Buckets are packed into
   blocks of some ``SIDE`` sketches, and each pair of blocks is compared in numpy: of a pair
   of texts only in the bucket of the least band they share (and the next one), so once.
   Pairs whose sketches agree are written as arrays, never as rows.
4. Texts are dealt to packs of some ``PACK`` texts, alike ones to the same packs.  All
   pairs of two packs are verified in one task, which reads each of their texts once: exact
   weighted Jaccard similarity >= ``threshold``.  It gives every text's number of links and
   a star for each component of the links it found.
5. Texts are verified if ``AGREE_EXTRA`` of their samples agree (``AGREE`` for a threshold
   below 0.8).  Classes are the connected components of the verified links.

Edge cases: a null text counts as the empty text; texts without words are similar
only to texts equal to them; repeated rows are copies; an empty table gives an empty
result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import byte_chunks, table, word_ids
from affinity.llm.components import components
from affinity.llm.lm import hashes
from affinity.session import materialize, release

SHINGLE = 5
BANDS, BAND_ROWS = 14, 3
SAMPLES = BANDS * BAND_ROWS
AGREE, AGREE_EXTRA = 16, 20   # samples of 42 that must agree before texts are verified: of texts
                         # that share two bands fewer than 20 agree with probability 2e-8 at a similarity of
                         # 0.8, fewer than 16 with probability 2e-5 at 0.6
LARGE = 2048             # members of a bucket that one band makes
SIDE = 256               # sketches in a block
PACK, PACK_BYTES = 2048, 4 << 20     # texts of a pack and their bytes, as dealt by a hash
STEP = 1 << 18           # pairs of sketches in memory at once
SHINGLE_STEP = 1 << 22   # the same for shingles
IDF_BUCKETS = 1 << 16
IDF_POWER = 0.25
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SEED = np.random.default_rng(20240229)
DRAW_BITS = 14           # random draws of a shingle come from tables of this size
GAMMA = SEED.gamma(2.0, 1.0, 1 << DRAW_BITS).astype(np.float32)
LOG_C = np.log(SEED.gamma(2.0, 1.0, 1 << DRAW_BITS)).astype(np.float32)
BETA = SEED.random(1 << DRAW_BITS).astype(np.float32)
ABOVE_ZERO = np.float32(128.0)
ODD = SEED.integers(1 << 62, size=(SAMPLES, 2)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                                  0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def plain(text: str | None) -> bytes:
    """Lower case without ASCII punctuation."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(None, PUNCTUATION)


def words_of(text: str | None) -> list[bytes]:
    return plain(text).split()


class Shingles:
    """Distinct shingles ``s`` of some texts one after the other, their counts ``c``,
    shingles per text ``n``, and 16 bytes per text that stand for its words (for the
    raw text where there are none)."""

    def __init__(self, texts: list[str | None]):
        words, ids, lens = word_ids([plain(t) for t in texts])
        seq = hashes(words)[ids]
        ends = np.cumsum(lens)
        roll = np.zeros(len(seq), dtype=np.uint64)
        for k in range(SHINGLE):
            part = seq * FACTORS[k]
            roll[:max(len(seq) - k, 0)] += part[k:] ^ (part[k:] >> np.uint64(31))
        out, counts, self.keys = [], [], []
        self.n = np.zeros(len(texts), dtype=np.int64)
        for i, (end, m) in enumerate(zip(ends.tolist(), lens.tolist())):
            body = seq[end - m:end]
            self.keys.append(hashlib.blake2b(
                body.tobytes() if m else b"raw " + (texts[i] or "").encode("utf-8", "surrogatepass"),
                digest_size=16).hexdigest())
            if m == 0:
                continue
            if m < SHINGLE:
                mixed = (body + np.arange(m, dtype=np.uint64)) * FACTORS[0]
                s = np.array([np.bitwise_xor.reduce(mixed) + np.uint64(m)])
            else:
                s = np.sort(roll[end - m:end - SHINGLE + 1])
            first = np.ones(len(s), dtype=bool)
            first[1:] = s[1:] != s[:-1]
            at = np.flatnonzero(first)
            out.append(s[at])
            counts.append(np.diff(np.append(at, len(s))))
            self.n[i] = len(at)
        self.s = np.concatenate(out) if out else np.zeros(0, np.uint64)
        self.c = np.concatenate(counts) if out else np.zeros(0, np.int64)


def idf_bucket(s: np.ndarray) -> np.ndarray:
    return ((s * FACTORS[2]) >> np.uint64(48)).astype(np.int64)


def sample(s: np.ndarray, weight: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Improved consistent weighted sampling: one 32-bit value per text and sample."""
    out = np.zeros((len(n), SAMPLES), dtype=np.uint32)
    full = n > 0
    if not full.any():
        return out
    starts = (np.cumsum(n) - n)[full]
    log_w = np.log(weight).astype(np.float32)
    at = np.empty(len(s), dtype=np.intp)
    key = np.empty(len(s), dtype=np.uint64)
    r, beta, score, t = (np.empty(len(s), dtype=np.float32) for _ in range(4))
    for j in range(SAMPLES):
        h = s * ODD[j, 0]
        at[:] = h >> np.uint64(64 - DRAW_BITS)
        np.take(GAMMA, at, out=r, mode="clip")
        np.take(BETA, at, out=beta, mode="clip")
        np.take(LOG_C, at, out=score, mode="clip")
        np.divide(log_w, r, out=t)
        t += beta
        np.floor(t, out=t)
        # ln c - r (t - beta + 1), moved above zero: then its bits sort like its value.
        beta -= t
        beta -= np.float32(1.0)
        beta *= r
        score += beta
        score += ABOVE_ZERO
        who = h.astype(np.uint32)
        who ^= t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1)
        key[:] = score.view(np.uint32)
        key <<= np.uint64(32)
        key |= who
        out[full, j] = np.minimum.reduceat(key, starts).astype(np.uint32)
    return out


def _first_pass(batches):
    """Key of every text, and this task's incidence counts by bucket."""
    total = np.zeros(IDF_BUCKETS, dtype=np.int64)
    for batch in batches:
        texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
        for a, b in byte_chunks([t or "" for t in texts], 1 << 20):
            sh = Shingles(texts[a:b])
            total += np.bincount(idf_bucket(sh.s), minlength=IDF_BUCKETS)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(ids[a:b], pa.int64()), "text_hash": batch.column("text_hash")[a:b],
                "key": pa.array(sh.keys, pa.string()),
                "salt": pa.nulls(b - a, pa.int32()), "counts": pa.nulls(b - a, pa.binary())})
    if total.any():
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.nulls(1, pa.int64()), "text_hash": pa.nulls(1, pa.int64()), "key": pa.nulls(1, pa.string()),
            "salt": pa.array([TaskContext.get().partitionId() % 64], pa.int32()),
            "counts": pa.array([total.tobytes()], pa.binary())})


def _add_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(x, np.int64) for x in pdf["counts"])
    return pd.DataFrame({"salt": [0], "counts": [total.tobytes()]})


def _weights(counts: np.ndarray) -> np.ndarray:
    return np.log1p(max(int(counts.sum()), 1) / np.maximum(counts, 1.0)) ** IDF_POWER


def _sampler(idf):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in byte_chunks([t or "" for t in texts], 1 << 19):
                sh = Shingles(texts[a:b])
                got = sample(sh.s, sh.c * idf.value[idf_bucket(sh.s)], sh.n)
                keep = sh.n > 0
                band = got.reshape(b - a, BANDS, BAND_ROWS).astype(np.uint64)
                mixed = np.zeros(band.shape[:2], dtype=np.uint64)
                for k in range(BAND_ROWS):
                    mixed = (mixed ^ band[:, :, k]) * FACTORS[k]
                    mixed ^= mixed >> np.uint64(29)
                mixed = (mixed + np.arange(BANDS, dtype=np.uint64)) * FACTORS[3]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([x for x, k in zip(sh.keys, keep) if k], pa.string()),
                    "bands": pa.array([x.tolist() for x in mixed[keep].view(np.int64)], pa.list_(pa.int64())),
                    "sketch": pa.array([x.tobytes() for x in got[keep].astype(np.uint16)], pa.binary())})
    return run


def _own_text(batches):
    """Rows whose text has the row's key (an id may stand for several texts)."""
    for batch in batches:
        texts, keys = batch.column("text").to_pylist(), batch.column("key").to_pylist()
        yield batch.filter(pa.array([a == b for a, b in zip(Shingles(texts).keys, keys)], pa.bool_()))


def _keyed(batches):
    """(key, text) of every row."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in byte_chunks([t or "" for t in texts], 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(Shingles(texts[a:b]).keys, pa.string()), batch.column("text")[a:b]],
                                             ["key", "text"])


def _ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - count), count)


def _steps(count: np.ndarray, most: int):
    """Ranges of positions whose counts add up to ``most`` or so (one position at least)."""
    ends, lo = np.cumsum(count), 0
    while lo < len(count):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield lo, hi
        lo = hi


def similarities(texts: list[str], lead: np.ndarray, other: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of texts[lead] and texts[other]; no text without words."""
    sh = Shingles(texts)
    weight = sh.c * idf[idf_bucket(sh.s)]
    first = np.cumsum(sh.n) - sh.n
    total = np.add.reduceat(weight, first)
    code = np.unique(sh.s, return_inverse=True)[1]
    dense = np.zeros(len(code))                       # weights of one lead by shingle
    order = np.argsort(lead, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(lead[order]) != 0)) if len(lead) else np.zeros(0, np.int64)
    out = np.empty(len(lead))
    for a, b in zip(cuts, np.append(cuts[1:], len(lead))):
        i, rows = lead[order[a]], order[a:b]
        own = slice(first[i], first[i] + sh.n[i])
        dense[code[own]] = weight[own]
        n = sh.n[other[rows]]
        for lo, hi in _steps(n, SHINGLE_STEP):
            j = other[rows[lo:hi]]
            at = _ragged(first[j], n[lo:hi])
            both = np.add.reduceat(np.minimum(dense[code[at]], weight[at]), np.cumsum(n[lo:hi]) - n[lo:hi])
            out[rows[lo:hi]] = both / (total[i] + total[j] - both)
        dense[code[own]] = 0.0
    return out


def _verifier(idf):
    """Similarities of pairs that come with their texts."""
    def run(batches):
        for batch in batches:
            lead, other = batch.column("lead").to_pylist(), batch.column("other").to_pylist()
            texts = {**dict(zip(lead, batch.column("lead_text").to_pylist())),
                     **dict(zip(other, batch.column("other_text").to_pylist()))}
            place = {node: k for k, node in enumerate(texts)}
            sims = similarities(list(texts.values()), np.array([place[x] for x in lead], np.int64),
                                np.array([place[x] for x in other], np.int64), idf.value)
            yield pa.RecordBatch.from_pydict({"lead": pa.array(lead, pa.int64()),
                                              "other": pa.array(other, pa.int64()), "sim": pa.array(sims, pa.float64())})
    return run


def _candidates(agree: int):
    """Pairs of two blocks of a bucket that are to be verified, by the packs of their texts."""
    none = np.iinfo(np.int64).max

    def block(column):
        parts = column.flatten()
        sketch = np.frombuffer(b"".join(parts.field("sketch").to_pylist()), np.uint16).reshape(-1, SAMPLES)
        bands = parts.field("bands").flatten().to_numpy().reshape(-1, BANDS)
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        return parts.field("node").to_numpy(), parts.field("pack").to_numpy(), sketch, bands, np.append(0, ends)

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            node, pack, sketch, bands, at = block(batch.column("left"))
            node2, pack2, sketch2, bands2, at2 = block(batch.column("right"))
            x, y = batch.column("x").to_numpy(), batch.column("y").to_numpy()
            same = batch.column("same").to_numpy(zero_copy_only=False)
            tile = np.repeat(np.arange(len(x)), np.diff(at))
            # Of a block with itself each text meets those behind it.
            start = at2[tile] + np.where(same[tile], np.arange(len(node)) - at[tile] + 1, 0)
            count = at2[tile + 1] - start
            for lo, hi in _steps(count, STEP):
                i = np.repeat(np.arange(lo, hi), count[lo:hi])
                j = _ragged(start[lo:hi], count[lo:hi])
                near = np.flatnonzero((sketch[i] == sketch2[j]).sum(axis=1) >= agree)
                i, j = i[near], j[near]
                common = np.where(bands[i] == bands2[j], bands[i], none)
                common.sort(axis=1)
                t = tile[i]
                mine = (common[:, 0] == x[t]) & (common[:, 1] < none) & ((y[t] == x[t]) | (common[:, 1] == y[t]))
                i, j = i[mine], j[mine]
                if len(i) == 0:
                    continue
                turn = pack[i] > pack2[j]
                a, b = np.where(turn, pack2[j], pack[i]), np.where(turn, pack[i], pack2[j])
                pairs = np.stack([np.where(turn, node2[j], node[i]), np.where(turn, node[i], node2[j])], axis=1)
                o = np.lexsort((b, a))
                a, b, pairs = a[o], b[o], pairs[o]
                cuts = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[cuts], pa.int64()), pa.array(b[cuts], pa.int64()),
                     pa.array([pairs[u:v].tobytes() for u, v in zip(cuts, np.append(cuts[1:], len(a)))], pa.binary())],
                    ["pa", "pb", "pairs"])
    return run


def _nodes_of(batches):
    """(pa, pb, node) of the texts that the pairs of two packs need."""
    for batch in batches:
        for a, b, pairs in zip(*(batch.column(c).to_pylist() for c in ("pa", "pb", "pairs"))):
            node = np.unique(np.frombuffer(b"".join(pairs), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), a)), pa.array(np.full(len(node), b)),
                                              pa.array(node)], ["pa", "pb", "node"])


def _least_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each one's component, by the links (a, b)."""
    root = np.arange(n)
    while True:
        u, v = root[a], root[b]
        if (u == v).all():
            return root
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root[root] != root).any():
            root = root[root]


def _linker(idf, threshold: float):
    """Links of the pairs of two packs: (node, to, null) for stars of their components and
    (node, null, number of links)."""
    def run(texts: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        node = texts["node"].to_numpy()
        order = np.argsort(node)
        node = node[order]
        at = np.searchsorted(node, np.frombuffer(b"".join(pairs["pairs"]), np.int64).reshape(-1, 2))
        sims = similarities(texts["text"].iloc[order].tolist(), at[:, 0], at[:, 1], idf.value)
        a, b = at[sims >= threshold].T
        degree = np.bincount(np.append(a, b), minlength=len(node))
        root = _least_of(len(node), a, b)
        far, linked = np.flatnonzero(root != np.arange(len(node))), np.flatnonzero(degree)
        none = lambda n: pd.array([None] * n, dtype="Int64")
        return pd.concat([
            pd.DataFrame({"node": node[far], "to": pd.array(node[root[far]], dtype="Int64"), "n": none(len(far))}),
            pd.DataFrame({"node": node[linked], "to": none(len(linked)), "n": pd.array(degree[linked], dtype="Int64")})])
    return run


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, class_id, n_links): class_id is the least doc_id of the class (null where
    no row of it has an id), n_links the number of verified links of the document's text
    to other texts."""
    return classed_rows(docs, threshold).select("doc_id", "class_id", "n_links")


def classed_rows(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, root, class_id, n_links) of every row: ``root`` names the class
    also where ids are null, ``text_hash`` is the xxhash64 of the row's text."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = materialize(d.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _first_pass, "doc_id long, text_hash long, key string, salt int, counts binary"), "op3-first")
    tallies = (first.where("counts IS NOT NULL").select("salt", "counts")
                    .groupBy("salt").applyInPandas(_add_counts, "salt int, counts binary")
                    .groupBy("salt").applyInPandas(_add_counts, "salt int, counts binary").collect())
    counts = np.frombuffer(tallies[0]["counts"], np.int64) if tallies else np.zeros(IDF_BUCKETS, np.int64)
    idf = spark.sparkContext.broadcast(_weights(counts))            # fixed size
    keys = first.where("key IS NOT NULL").select("doc_id", "text_hash", "key")
    nodes = materialize(keys.groupBy("key").agg(F.min("doc_id").alias("doc_id")), "op3-nodes")

    bands = materialize(
        d.mapInArrow(_sampler(idf), "key string, bands array<long>, sketch binary")
         .groupBy("key").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
         .withColumn("node", F.monotonically_increasing_id()), "op3-sketches")      # short names, written once
    member = bands.select("node", F.explode("bands").alias("bucket"))
    shared = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Texts that share bands with others at all, two at least.
    member = materialize(member.join(shared, "bucket").groupBy("node")
                               .agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("b"))
                               .where(F.size("b") > 1), "op3-members")
    candidates = member.select("node").join(bands.select("node", "key"), "node")
    texts = (nodes.join(candidates, "key").join(d, "doc_id").select("node", "key", "text")
                  .mapInArrow(_own_text, "node long, key string, text string").select("node", "text"))
    # Rows without an id are joined by their key.
    texts = (texts.unionByName(d.where("doc_id IS NULL").select("text").mapInArrow(_keyed, "key string, text string")
                                .join(candidates, "key").select("node", "text")).dropDuplicates(["node"]))
    texts = materialize(texts, "op3-texts")

    # Packs: texts of one largest bucket go together, as many to a pack as it holds.
    home = materialize(
        member.select("node", F.array_max(F.transform("b", lambda e: F.struct(e["n"], e["bucket"])))["bucket"].alias("home"))
              .join(texts.select("node", F.octet_length("text").alias("size")), "node"), "op3-home")
    packs = lambda n, size: F.ceil(F.greatest(n / F.lit(PACK), size / F.lit(PACK_BYTES), F.lit(1.0)))
    parts = home.agg(packs(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0)))).first()[0]
    of_home = home.groupBy("home").agg(packs(F.count(F.lit(1)), F.sum("size")).alias("of_home"))
    pack = (F.shiftleft(F.pmod(F.xxhash64("home"), F.lit(parts)), 24)
            + F.pmod(F.xxhash64("node"), F.col("of_home")))
    sketches = home.join(of_home, "home").select("node", pack.cast("long").alias("pack")).join(
        bands.select("node", "sketch", "bands"), "node")

    # Blocks of each bucket: the texts of a band, or of two bands where many share one (y = x: of one).
    seats = F.expr(f"""flatten(transform(b, (e, i) -> if(e.n <= {LARGE}, array(struct(e.bucket as x, e.bucket as y)),
                       transform(slice(b, i + 2, size(b)), f -> struct(e.bucket as x, f.bucket as y)))))""")
    member = member.select("node", F.explode(seats).alias("seat")).select("node", "seat.x", "seat.y")
    number = member.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = materialize(
        member.join(number, ["x", "y"]).join(sketches, "node")
              .groupBy("x", "y", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / F.lit(SIDE))).alias("block"))
              .agg(F.collect_list(F.struct("node", "pack", "sketch", "bands")).alias("members")), "op3-blocks")
    right = blocks.select("x", "y", F.col("block").alias("block2"), F.col("members").alias("right"))
    tiles = (blocks.withColumnRenamed("members", "left").join(right, ["x", "y"]).where("block <= block2")
                   .select("x", "y", "left", "right", (F.col("block") == F.col("block2")).alias("same")))
    pairs = materialize(tiles.mapInArrow(_candidates(AGREE_EXTRA if threshold >= 0.8 else AGREE),
                                         "pa long, pb long, pairs binary"), "op3-pairs")
    release(blocks)
    need = (pairs.groupBy("pa", "pb").agg(F.collect_list("pairs").alias("pairs"))
                 .mapInArrow(_nodes_of, "pa long, pb long, node long").join(texts, "node"))
    links = materialize(need.groupBy("pa", "pb").cogroup(pairs.groupBy("pa", "pb")).applyInPandas(
        _linker(idf, threshold), "node long, to long, n long"), "op3-links")
    release(pairs)
    release(texts)

    edges = links.where("to IS NOT NULL").select(F.col("node").alias("u"), F.col("to").alias("v"))
    if not edges.isEmpty():
        root = components(edges, "op3-classes")
        degree = links.where("n IS NOT NULL").groupBy("node").agg(F.sum("n").alias("n_links"))
        named = (root.join(degree, "node", "left").join(bands.select("node", "key"), "node")
                     .select("key", F.col("root").cast("string").alias("root"), "n_links"))
        place = (nodes.join(named, "key", "left")
                      .select("key", F.coalesce("root", "key").alias("root"), "doc_id",
                              F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
        least = place.groupBy("root").agg(F.min("doc_id").alias("class_id"))
        place = place.join(least, "root").select("key", "root", "class_id", "n_links")
    else:
        place = nodes.select("key", F.col("key").alias("root"), F.col("doc_id").alias("class_id"),
                             F.lit(0).cast("long").alias("n_links"))
    return keys.join(place, "key").select("doc_id", "text_hash", "root", "class_id", "n_links")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
