"""SentencePiece encoding and decoding over a relational lattice.

Encoding finds the best-scored segmentation of a text into vocabulary pieces.  White
space follows the model (a space becomes the mark U+2581, one is put before the text;
nothing else is changed, so decoding gives back the text).

1. Texts are cut into segments where no piece of the vocabulary can span: between two
   characters that stand side by side in no piece.  Cutting there cannot change the
   best path, and it leaves few distinct segments.  They are counted over all texts.
2. The lattice is relational.  Substrings of at most the longest piece's length are
   exploded from every distinct segment and equi-joined with the piece table (bounded:
   the vocabulary); the edges are grouped by segment in the partition they were made in,
   and a higher-order ``aggregate`` folds Viterbi over them.  A character without a
   piece is one edge of score ``min - 10``, spelled as its UTF-8 byte pieces.  Of equal
   scores the longest last piece wins.
3. The ``HEAD`` most frequent segments (at most) are broadcast; each text gets the paths
   of its rarer segments by a join, and tasks put the piece ids of whole texts together.

The fold copies its states and takes time quadratic in a segment's length; segments are
a few characters except in unbroken strings of letters.  Segments of more than ``LONG``
characters leave the lattice: their path is found by the same rule in the task that
encodes the text, in time proportional to their length.

Edge cases: a null or empty text has no pieces; U+2581 in a text stands for a space and
is decoded as one (``round_trip`` is false there); repeated rows are encoded each; an
empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import byte_chunks, row_slices, table
from affinity.session import materialize

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
HEAD = 850_000          # segments broadcast, some 20 MB
HEAD_CHARS = 32
LONG = 1024             # characters of the longest segments in the lattice
MERGE = 1_000_000
BYTE_0 = 3


class Vocabulary:
    """Pieces, scores and the character pairs inside pieces of a model file."""

    def __init__(self, path: str = MODEL):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rows, self.text = [], []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            plain = not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
            if plain:
                self.rows.append((p, i, float(sp.get_score(i))))
            self.text.append(bytes([int(p[3:5], 16)]) if sp.is_byte(i)
                             else p.replace(MARK, " ").encode() if plain else b"")
        self.unknown = min(s for _, _, s in self.rows) - 10.0
        self.longest = max(len(p) for p, _, _ in self.rows)
        self.best = {}
        for p, i, x in sorted(self.rows, key=lambda r: (r[0], -r[2], r[1])):
            self.best.setdefault(p, (i, x))
        inner = sorted({(a, b) for p, _, _ in self.rows for a, b in zip(p, p[1:])})
        letters = sorted({x for pair in inner for x in pair})
        self.letter = np.zeros(0x110000, dtype=np.int32)         # 0: a character inside no pair
        self.letter[[ord(x) for x in letters]] = np.arange(1, len(letters) + 1)
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        self.joined[[self.letter[ord(a)] for a, _ in inner], [self.letter[ord(b)] for _, b in inner]] = True
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in self.text])])
        self.bytes = np.frombuffer(b"".join(self.text), dtype=np.uint8)


@lru_cache(maxsize=2)
def vocabulary(path: str = MODEL) -> Vocabulary:
    return Vocabulary(path)


def joined_runs(text: str) -> str:
    """The text with every space that follows a space (or begins the text, where a
    mark is put before it) written as the mark, so that splitting at the spaces left
    gives words with their white space."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " in text:
        text = re.sub("  +", lambda m: " " + MARK * (len(m.group()) - 1), text)
    return MARK + text[1:] if text[:1] == " " else text


def _cleaned(column: pa.Array) -> pa.Array:
    """The texts by ``joined_runs``; '' for null."""
    column = pc.fill_null(column, "")
    odd = pc.or_(pc.or_(pc.match_substring(column, "  "), pc.match_substring(column, MARK)), pc.starts_with(column, " "))
    if pc.any(odd).as_py():
        at = odd.to_numpy(zero_copy_only=False)
        column = pa.array([joined_runs(t) if o else t for t, o in zip(column.to_pylist(), at)], pa.string())
    return column


class Segments:
    """Segments of the words of some texts.

    ``ids``: distinct word of every word, ``lens``: words per text, ``seg_of``: distinct
    segment of every segment of the distinct words, ``n``: segments per distinct word,
    ``segs``: the distinct segments."""

    def __init__(self, texts: pa.Array, v: Vocabulary):
        texts = _cleaned(texts)
        lists = pc.split_pattern(texts, " ")
        self.lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        enc = lists.flatten().dictionary_encode()
        self.ids = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        empty = pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0      # the empty text has no word
        if empty.any():
            self.ids = self.ids[~np.repeat(empty, self.lens)]
            self.lens[empty] = 0
        marked = pc.binary_join_element_wise(pa.scalar(MARK), enc.dictionary, pa.scalar(""))
        size = pc.utf8_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
        raw = b"".join(marked.view(pa.binary()).to_numpy(zero_copy_only=False)) if len(marked) else b""
        cps = np.frombuffer(raw.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = v.letter[cps]
        cut = np.ones(len(cps), dtype=bool)
        cut[1:] = ~v.joined[letter[:-1], letter[1:]]
        first = np.cumsum(size) - size
        cut[first] = True
        width = np.where(cps < 0x80, 1, np.where(cps < 0x800, 2, np.where(cps < 0x10000, 3, 4)))
        starts = (np.cumsum(width) - width)[cut]
        offsets = np.append(starts, len(raw)).astype(np.int32)
        segs = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw))
        enc = segs.dictionary_encode()
        self.segs = enc.dictionary
        self.seg_of = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.n = np.add.reduceat(cut.astype(np.int64), first) if len(size) else size

    def hashes(self) -> np.ndarray:
        words = self.segs.view(pa.binary()).to_numpy(zero_copy_only=False)
        return np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in words), dtype=np.uint64, count=len(words))

    def sequence(self) -> tuple[np.ndarray, np.ndarray]:
        """Segment number of every segment of all texts in order, segments per text."""
        c = self.n[self.ids]
        first = (np.cumsum(self.n) - self.n)[self.ids]
        flat = self.seg_of[np.repeat(first - (np.cumsum(c) - c), c) + np.arange(c.sum())]
        ends = np.concatenate([[0], np.cumsum(c)])[np.cumsum(self.lens)]
        return flat, np.diff(np.concatenate([[0], ends]))


def long_ones(segs: pa.Array) -> np.ndarray:
    """Which segments are too long for the lattice."""
    return pc.utf8_length(segs).to_numpy(zero_copy_only=False) > LONG


def long_path(seg: str, v: Vocabulary) -> list[int]:
    """Piece ids of the best path of one segment, by the rule of ``viterbi``."""
    n = len(seg)
    back, piece = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int32)
    last = [0.0]                                      # scores of the last ends, as far as a piece reaches
    for end in range(1, n + 1):
        top = None
        for start in range(max(0, end - v.longest), end):        # the longest last piece first
            i, x = v.best.get(seg[start:end], (None, 0.0))
            if i is None:
                if end - start > 1:
                    continue
                i, x = -ord(seg[start]), v.unknown
            x += last[start - end]
            if top is None or x > top:
                top, back[end], piece[end] = x, start, i
        last.append(top)
        if len(last) > v.longest:
            del last[0]
    out, at = [], n
    while at:
        i = int(piece[at])
        out.extend([i] if i >= 0 else [BYTE_0 + b for b in reversed(chr(-i).encode("utf-8", "surrogatepass"))])
        at = int(back[at])
    return out[::-1]


def count_segments(docs: DataFrame, path: str = MODEL, partitions: int | None = None) -> DataFrame:
    """(seg, c) over all texts, partitioned by segment.

    Each task adds up its own counts (at most ``MERGE`` segments at a time)."""
    def partial(batches):
        v, kept = vocabulary(path), []

        def merged():
            t = pa.concat_tables(kept).group_by("seg").aggregate([("n", "sum")])
            return pa.table([t["seg"], t["n_sum"]], names=["seg", "n"]).combine_chunks()

        for batch in batches:
            texts = batch.column("text")
            for s, e in row_slices(texts):
                g = Segments(texts[s:e], v)
                words = np.bincount(g.ids, minlength=len(g.n))
                c = np.bincount(g.seg_of, weights=np.repeat(words, g.n), minlength=len(g.segs))
                kept.append(pa.table([g.segs, pa.array(c.astype(np.int64))], names=["seg", "n"]))
                far = long_ones(g.segs)
                if far.any():
                    kept[-1] = kept[-1].filter(pa.array(~far))
                if sum(t.num_rows for t in kept) > MERGE:
                    kept[:] = [merged()]
                    if kept[0].num_rows > MERGE // 2:
                        yield from kept.pop().to_batches(50_000)
        if kept:
            yield from merged().to_batches(50_000)

    n = partitions or max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (docs.select("text").mapInArrow(partial, "seg string, n long").repartition(n, "seg")
                .groupBy("seg").agg(F.sum("n").alias("c")))


def _utf8_pieces(code: str) -> str:
    """SQL array of the byte pieces of a code point."""
    tail = lambda shift: f"{BYTE_0 + 128} + (shiftright({code}, {shift}) & 63)"
    return (f"CASE WHEN {code} < 128 THEN array({BYTE_0} + {code}) "
            f"WHEN {code} < 2048 THEN array({BYTE_0 + 192} + shiftright({code}, 6), {tail(0)}) "
            f"WHEN {code} < 65536 THEN array({BYTE_0 + 224} + shiftright({code}, 12), {tail(6)}, {tail(0)}) "
            f"ELSE array({BYTE_0 + 240} + shiftright({code}, 18), {tail(12)}, {tail(6)}, {tail(0)}) END")


def viterbi(segs: DataFrame, path: str = MODEL) -> DataFrame:
    """(seg, c, ids) for a table of distinct segments.

    Exploding and the broadcast join keep the partitioning by segment, so grouping the
    edges needs no shuffle where ``segs`` comes partitioned by segment."""
    spark = segs.sparkSession
    v = vocabulary(path)
    pieces = spark.createDataFrame(pd.DataFrame(v.rows, columns=["piece", "id", "score"]),
                                   "piece string, id int, score double")
    length = F.char_length("seg")
    edges = (segs.select("seg", "c", F.posexplode(F.transform(
                     F.sequence(F.lit(1), length), lambda i: F.least(F.lit(v.longest), length - i + 1))))
                 .select("seg", "c", F.col("pos").alias("start"), F.explode(F.sequence(F.lit(1), "col")).alias("size"))
                 .withColumn("piece", F.expr("substring(seg, start + 1, size)"))
                 .join(F.broadcast(pieces), "piece", "left")
                 .where("id IS NOT NULL OR size = 1")
                 .select("seg", "c", F.struct((F.col("start") + F.col("size")).alias("end"), "start",
                                              F.coalesce("score", F.lit(v.unknown)).alias("score"),
                                              F.coalesce("id", -F.ascii("piece")).alias("id")).alias("edge")))
    grouped = edges.groupBy("seg").agg(F.first("c").alias("c"), F.sort_array(F.collect_list("edge")).alias("edges"))
    # back[end]: best score of a path to ``end`` and its last edge.
    fold = """aggregate(edges, array(named_struct('score', 0.0D, 'start', 0, 'id', 0)),
        (a, e) -> if(size(a) <= e.end,
            concat(a, array(named_struct('score', a[e.start].score + e.score, 'start', e.start, 'id', e.id))),
            if(a[e.start].score + e.score > a[e.end].score,
               concat(slice(a, 1, e.end),
                      array(named_struct('score', a[e.start].score + e.score, 'start', e.start, 'id', e.id))),
               a)))"""
    trace = """aggregate(sequence(2, size(back)),
        named_struct('at', size(back) - 1, 'ids', cast(array() as array<int>)),
        (a, i) -> if(a.at = 0, a, named_struct('at', back[a.at].start, 'ids', concat(array(back[a.at].id), a.ids))),
        a -> a.ids)"""
    plain = (grouped.select("seg", "c", F.expr(fold).alias("back")).select("seg", "c", F.expr(trace).alias("ids")))
    spelled = F.expr(f"flatten(transform(ids, i -> if(i >= 0, array(i), {_utf8_pieces('(-i)')})))")
    return plain.withColumn("ids", F.when(F.exists("ids", lambda i: i < 0), spelled).otherwise(F.col("ids")))


class Paths:
    """Piece ids of segments, by sorted segment hash."""

    def __init__(self, hash_: np.ndarray, ids: np.ndarray, size: np.ndarray):
        order = np.argsort(hash_, kind="stable")
        start = np.cumsum(size) - size
        self.hash, self.size = hash_[order], size[order].astype(np.int32)
        self.start = np.cumsum(self.size, dtype=np.int64) - self.size
        take = np.repeat(start[order] - self.start, self.size) + np.arange(len(ids))
        self.ids = ids[take].astype(np.uint16 if ids.max(initial=0) < 1 << 16 else np.int32)

    def look_up(self, hash_: np.ndarray) -> np.ndarray:
        """Position of every hash, -1 where it is missing."""
        if not len(self.hash):
            return np.full(len(hash_), -1)
        at = np.minimum(np.searchsorted(self.hash, hash_), len(self.hash) - 1)
        return np.where(self.hash[at] == hash_, at, -1)


def head_paths(encoded: DataFrame, head: int = HEAD) -> tuple[Paths, int]:
    """The most frequent segments, at most ``head`` of at most HEAD_CHARS characters, and
    their least count."""
    short = encoded.where("short")
    room, least = head, None
    for r in short.groupBy(F.least("c", F.lit(100_000)).alias("c")).count().orderBy(F.desc("c")).collect():
        if r["count"] > room:
            break
        room, least = room - r["count"], r["c"]
    if least is None:
        return Paths(np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64)), 2 ** 62
    rows = short.where(F.col("c") >= least).select("h", "ids").toArrow()
    return Paths(rows["h"].to_numpy().view(np.uint64), pc.list_flatten(rows["ids"]).to_numpy(),
                 pc.list_value_length(rows["ids"]).to_numpy().astype(np.int64)), least


def _rare(head, path):
    """Segments of each text that are not in the head: (doc_id, text_hash, h)."""
    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            texts, ids, th = batch.column("text"), batch.column("doc_id"), batch.column("text_hash")
            for s, e in row_slices(texts):
                g = Segments(texts[s:e], v)
                hash_ = g.hashes()
                missing = (head.value.look_up(hash_) < 0) & ~long_ones(g.segs)
                flat, n = g.sequence()
                doc = np.repeat(np.arange(e - s), n)[missing[flat]] if len(flat) else np.zeros(0, np.int64)
                key = np.unique(doc * max(len(g.segs), 1) + flat[missing[flat]]) if len(doc) else doc
                d, k = key // max(len(g.segs), 1), key % max(len(g.segs), 1)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(s + d)), th.take(pa.array(s + d)), pa.array(hash_[k].view(np.int64), pa.int64())], ["doc_id", "text_hash", "h"])
    return run


def decode(ids: np.ndarray, n: np.ndarray, v: Vocabulary) -> list[bytes]:
    """Texts of consecutive runs of ``n`` piece ids."""
    size = np.diff(v.offsets)[ids]
    ends = np.cumsum(size)
    raw = v.bytes[np.repeat(v.offsets[:-1][ids] - (ends - size), size) + np.arange(size.sum())].tobytes()
    at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n)])]
    return [raw[a + 1:b] if b > a else b"" for a, b in zip(at[:-1], at[1:])]


def _encoder(head, path):
    def run(batches):
        v, unpack = vocabulary(path), zstandard.ZstdDecompressor().decompress
        for batch in batches:
            packed, rare = batch.column("packed"), batch.column("rare")
            for s, e in row_slices(packed, 1 << 20):
                yield from encode_some([unpack(t.as_py()).decode("utf-8", "surrogatepass") for t in packed[s:e]],
                                       batch.column("doc_id")[s:e], rare[s:e].to_pylist(), head.value, v)
    return run


def encode_some(texts, doc_ids, rare, h: Paths, v: Vocabulary):
    for s, e in byte_chunks(texts):
        g = Segments(pa.array(texts[s:e], pa.string()), v)
        hash_ = g.hashes()
        own = {r["h"]: r["ids"] for x in rare[s:e] for r in x or ()}
        for k in np.flatnonzero(long_ones(g.segs)).tolist():
            own[int(hash_[k:k + 1].view(np.int64)[0])] = long_path(g.segs[k].as_py(), v)
        lists = list(own.values())
        tail = Paths(np.array(list(own), dtype=np.int64).view(np.uint64),
                     np.array([x for y in lists for x in y], dtype=np.int32),
                     np.array(list(map(len, lists)), dtype=np.int64))
        at, at2 = h.look_up(hash_), tail.look_up(hash_)
        size = np.where(at >= 0, h.size[at] if len(h.size) else 0, tail.size[at2] if len(tail.size) else 0)
        start = np.where(at >= 0, h.start[at] if len(h.start) else 0,
                         len(h.ids) + (tail.start[at2] if len(tail.start) else 0))
        flat, n = g.sequence()
        # Paths of this chunk's segments one after the other, then their sequence.
        own_start = np.cumsum(size) - size
        from_ = np.repeat(start - own_start, size) + np.arange(size.sum())
        every = np.where(from_ < len(h.ids), h.ids[np.minimum(from_, len(h.ids) - 1)] if len(h.ids) else 0,
                         tail.ids[np.maximum(from_ - len(h.ids), 0)] if len(tail.ids) else 0).astype(np.int32)
        c = size[flat]
        out = every[np.repeat(own_start[flat] - (np.cumsum(c) - c), c) + np.arange(c.sum())]
        ends = np.concatenate([[0], np.cumsum(c)])[np.concatenate([[0], np.cumsum(n)])]
        back = decode(out, np.diff(ends), v)
        same = [b == t.encode("utf-8", "surrogatepass") for b, t in zip(back, texts[s:e])]
        yield pa.RecordBatch.from_arrays(
            [doc_ids[s:e], pa.array(np.diff(ends), pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out, pa.int32())),
             pa.array(same, pa.bool_())], ["doc_id", "n_pieces", "ids", "round_trip"])


def _pack(batches):
    """Texts compressed for the shuffle that brings their rare segments."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        packed = [pack((t or "").encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(packed, pa.binary())],
                                         ["doc_id", "text_hash", "packed"])


def encode_documents(docs: DataFrame, path: str = MODEL, head: int = HEAD) -> DataFrame:
    """(doc_id, n_pieces, ids, round_trip): piece ids of every text, and whether
    decoding them gives the text back."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = materialize(viterbi(count_segments(d, path), path).select(
        F.xxhash64("seg").alias("h"), "c", (F.char_length("seg") <= HEAD_CHARS).alias("short"), "ids"), "op5-paths")
    paths, least = head_paths(encoded, head)
    shared = spark.sparkContext.broadcast(paths)                             # at most HEAD short segments
    keyed = d.withColumn("text_hash", F.xxhash64("text"))
    tail = encoded.where((F.col("c") < least) | ~F.col("short"))
    rare = (keyed.mapInArrow(_rare(shared, path), "doc_id long, text_hash long, h long")
                 .join(tail.select("h", "ids"), "h")
                 .groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"))
                 .agg(F.collect_set(F.struct("h", "ids")).alias("rare")))
    packed = keyed.mapInArrow(_pack, "doc_id long, text_hash long, packed binary")
    whole = (packed.join(rare, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")), "left")
                   .select("doc_id", "packed", "rare"))
    return whole.mapInArrow(_encoder(shared, path), "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def query(spark, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
