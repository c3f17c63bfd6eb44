"""Alignment of two tokenizations of the same bytes, as an Arrow pipeline.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (SentencePiece,
which adds the space) the text.  Both cut every text before a single space between two
characters that are not white space: A's pattern starts a new word there, and B has no
piece that holds a space after another character (checked when the model is read; else
texts stay whole).  So a text is a sequence of such words, and a worker encodes and aligns
a word once for as long as it keeps it.

For the distinct words: token lists are flattened with their parent indices, ends are
segmented cumulative sums of byte lengths, and a full outer Acero hash join on (word,
end) gives the ends of either side in order.  Each stretch between two consecutive ends
lies in one A and one B token, which is their link; ends of both sides close a group.

Pass 1 counts linked id pairs (Table.group_by per slice and task, merged by Spark).
Pass 2 aligns again and sums counts per document: pairs with a count of at least the
least threshold that leaves ``MAX_PAIRS`` pairs come from a broadcast table, all other
links go through a join with the pair table.  A text is read in slices of whole texts;
nothing about a document leaves its row.

Edge cases: null and empty texts, and texts that either tokenizer does not give back
byte by byte, have no tokens: zeros and an empty hash.  Every row gives one row, also
repeated ones and those with a null doc_id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import row_slices, segment_sum, table
from affinity.session import materialize

TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
MAX_PAIRS = 1 << 19              # id pairs in the broadcast table
SLICE_BYTES = 2 << 20            # text aligned at once
KEPT_WORDS = 400_000             # aligned words that a Python worker keeps; beyond that it starts anew
MERGE_ROWS = 1 << 20             # pair counts of a task merged in Arrow at once
WORD_START = re.compile(r"(?<=\S)(?= \S)")
# A space at an end or beside white space (all characters that re takes for such).
WHITE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD_SPACE = rf"^ | $| [{WHITE}]|[{WHITE}] "
SPACE = "▁"                 # fixed value: the space of SentencePiece
ROW_BITS = 40
# Fixed value: the published pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Characters whose class no Unicode version changes.
SETTLED = r"^[ \n!-~\x{a1}-\x{24f}]+$"

_LOADED: dict[str, "Pair"] = {}


def byte_level_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    ones for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(0x100 + i): b for i, b in enumerate(hidden)}}


class Pair:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # Spark runs one task a core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        plain = byte_level_bytes()
        vocab = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = pa.array([bytes(plain[c] for c in vocab[i]) if i in vocab and all(c in plain for c in vocab[i]) else b""
                                 for i in range(max(vocab) + 1)], pa.binary())
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                                 for i, p in enumerate(pieces)], pa.binary())
        self.kept = Kept(self)
        self.fast = self._by_rank(json.loads(a_json)["model"])
        pre = json.loads(a_json).get("pre_tokenizer") or {}
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                        and not any(SPACE in p.lstrip(SPACE) for p in pieces))

    def _by_rank(self, model: dict):
        """The same merges in a library that is three times faster on single words, where
        ids follow the order of the merges (else None)."""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        import tiktoken
        ranks = {raw: i for i, raw in enumerate(self.a_bytes[:256 + len(merges)].to_pylist())}
        return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if len(ranks) == 256 + len(merges) else None

    def words(self, text: str) -> list[str]:
        return WORD_START.split(" " + text) if self.by_word else [" " + text]

    def encode(self, words: list[str], column: pa.Array | None = None) -> tuple[pa.ListArray, pa.ListArray]:
        """Token ids of both sides; ``column`` holds the same words."""
        column = pa.array(words, pa.string()) if column is None else column
        if self.by_word and self.fast is not None:
            one = self.fast.encode_ordinary
            settled = pc.and_(pc.match_substring_regex(column, SETTLED), pc.less(pc.utf8_length(column), 100))
            ids = [one(w) if ok else None for w, ok in zip(words, settled.to_numpy(zero_copy_only=False).tolist())]
            left = [i for i, x in enumerate(ids) if x is None]
            for i, e in zip(left, self.a.encode_batch_fast([words[i] for i in left], add_special_tokens=False)):
                ids[i] = e.ids
        else:
            ids = [e.ids for e in self.a.encode_batch_fast(words, add_special_tokens=False)]
        return _lists(ids), _lists(self.b.encode([w[1:] for w in words], num_threads=1))


def _lists(ids: list[list[int]]) -> pa.ListArray:
    lens = np.fromiter(map(len, ids), np.int64, len(ids))
    offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(lens, dtype=np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.array(np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1]))))


def _pair(files) -> Pair:
    a_json, b_model = files.value
    key = hashlib.sha256(a_json.encode() + b_model).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Pair(a_json, b_model)
    return _LOADED[key]


def _side(ids: pa.ListArray, piece_bytes: pa.Array, words: pa.Array, name: str) -> tuple[pa.Table, pa.Array]:
    """Tokens with their word and end, and whether each word's bytes come back."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    pieces = piece_bytes.take(flat)
    back = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, pieces), pa.scalar(b"", pa.binary()))
    run = pc.cumulative_sum(pc.cast(pc.binary_length(pieces), pa.int64()))
    sums = np.concatenate([np.zeros(1, np.int64), run.to_numpy()])
    before = pa.array(sums[ids.offsets.to_numpy()[:-1]])
    ends = pc.subtract(run, before.take(parent))
    return pa.table({"word": pc.cast(parent, pa.int64()), "end": ends, name: flat}), pc.equal(back, words.cast(pa.binary()))


class Aligned:
    """Distinct words: ``valid``, tokens ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` of
    each, and all links (``word``, ``a``, ``b``) in order."""

    def __init__(self, words: list[str], pair: Pair):
        m = len(words)
        new, words = words, pa.array(words, pa.string())
        ids_a, ids_b = pair.encode(new, words)
        left, ok_a = _side(ids_a, pair.a_bytes, words, "a")
        right, ok_b = _side(ids_b, pair.b_bytes, words, "b")
        self.valid = pc.and_(ok_a, ok_b)
        left, right = (t.filter(self.valid.take(t["word"].combine_chunks())) for t in (left, right))
        both = left.join(right, keys=["word", "end"], join_type="full outer", use_threads=False)
        both = both.sort_by([("word", "ascending"), ("end", "ascending")]).combine_chunks()
        has_a, has_b = pc.is_valid(both["a"]), pc.is_valid(both["b"])
        shared = pc.and_(has_a, has_b)
        self.valid = self.valid.to_numpy(zero_copy_only=False)
        self.word = both["word"].to_numpy()
        # The end of a word is an end of both sides, so the next token never belongs to another word.
        self.a = pc.fill_null_backward(both["a"]).to_numpy().astype(np.int64)
        self.b = pc.fill_null_backward(both["b"]).to_numpy().astype(np.int64)
        count = lambda mask: np.bincount(self.word[mask.to_numpy(zero_copy_only=False)], minlength=m)
        self.n_a, self.n_b, self.n_groups = count(has_a), count(has_b), count(shared)
        self.n_links = np.bincount(self.word, minlength=m)
        closed = both.filter(shared)
        sides = []
        for name, has in (("a", has_a), ("b", has_b)):
            t = both.filter(has)
            last = np.flatnonzero(pc.is_valid(t["b" if name == "a" else "a"]).to_numpy()) + 1
            text = pc.cast(t[name].combine_chunks(), pa.string())
            offsets = pa.array(np.concatenate([[0], last]), pa.int32())
            sides.append(pc.binary_join(pa.ListArray.from_arrays(offsets, text), ","))
        parts = pc.binary_join_element_wise(*sides, "|")
        at = np.searchsorted(closed["word"].to_numpy(), np.arange(m + 1))
        self.groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(at, pa.int32()), parts), ";").to_pylist()


class Kept:
    """Words that a worker has aligned before, with all that ``Aligned`` gives of them."""

    NUMBERS = ("valid", "n_a", "n_b", "n_groups", "n_links")

    def __init__(self, pair: Pair):
        self.pair = pair
        self.clear()

    def clear(self):
        self.slot: dict[str, int] = {}
        self.groups: list[str] = []
        self.table = {c: np.zeros(0, np.int64) for c in (*self.NUMBERS, "start")}
        self.links = {c: np.zeros(0, np.int32) for c in ("a", "b")}
        self.rows = self.used = 0

    def _put(self, store: dict, at: int, values: dict):
        for c, v in values.items():
            if at + len(v) > len(store[c]):
                store[c] = np.concatenate([store[c][:at], np.zeros(at + 2 * len(v), store[c].dtype)])
            store[c][at:at + len(v)] = v

    def aligned(self, words: list[str]) -> "Kept":
        """The given distinct words, aligned, in their order."""
        new = [w for w in words if w not in self.slot]
        if len(self.slot) + len(new) > KEPT_WORDS and self.slot:
            self.clear()
            new = words
        if new:
            al = Aligned(new, self.pair)
            start = self.used + np.cumsum(al.n_links) - al.n_links
            self._put(self.table, self.rows, {**{c: getattr(al, c) for c in self.NUMBERS}, "start": start})
            self._put(self.links, self.used, {"a": al.a, "b": al.b})
            self.slot.update(zip(new, range(self.rows, self.rows + len(new))))
            self.groups += al.groups
            self.rows += len(new)
            self.used += len(al.a)
        out = Kept.__new__(Kept)
        at = np.fromiter((self.slot[w] for w in words), np.int64, len(words))
        for c in self.NUMBERS:
            setattr(out, c, self.table[c][at])
        out.valid = out.valid.astype(bool)
        out.word = np.repeat(np.arange(len(words)), out.n_links)
        first = np.cumsum(out.n_links) - out.n_links
        link = np.arange(len(out.word)) + np.repeat(self.table["start"][at] - first, out.n_links)
        out.a, out.b = (self.links[c][link].astype(np.int64) for c in ("a", "b"))
        out.groups = [self.groups[i] for i in at.tolist()]
        return out


def _words(texts: pa.Array, pair: Pair) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after the other, and how many each text has (null and empty: none).

    Where every space stands between two characters that are not white space, words are
    the parts between spaces, cut in Arrow; other texts are cut by ``Pair.words``."""
    texts = pc.fill_null(texts, "")
    plain = np.zeros(len(texts), bool)
    if pair.by_word:
        plain = ~pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
    plain &= pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
    easy = pc.split_pattern(texts.filter(pa.array(plain)), " ")
    flat = pc.binary_join_element_wise(pa.scalar(""), easy.flatten(), " ")
    rest = texts.filter(pa.array(~plain))
    lists = [pair.words(t) if t else [] for t in rest.to_pylist()]
    lens = np.zeros(len(texts), np.int64)
    lens[plain] = pc.list_value_length(easy).to_numpy(zero_copy_only=False)
    lens[~plain] = [len(x) for x in lists]
    if not lists:
        return flat, lens
    # Back into the order of the texts.
    both = pa.concat_arrays([flat, pa.array([w for x in lists for w in x], pa.string())])
    order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
    start = np.empty(len(texts), np.int64)
    start[order] = np.cumsum(lens[order]) - lens[order]
    at = np.arange(int(lens.sum())) + np.repeat(start - (np.cumsum(lens) - lens), lens)
    return both.take(pa.array(at)), lens


def _slices(batch, pair: Pair):
    """(first row, aligned distinct words, word of every word, words per row, rows that align)."""
    column = batch.column("text")
    for lo, hi in row_slices(column, SLICE_BYTES):
        words, lens = _words(column.slice(lo, hi - lo), pair)
        enc = words.dictionary_encode()
        ids = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if len(ids) == 0:
            yield lo, hi, None, ids, lens, np.zeros(hi - lo, bool)
            continue
        al = pair.kept.aligned(enc.dictionary.to_numpy(zero_copy_only=False).tolist())
        yield lo, hi, al, ids, lens, (lens > 0) & (segment_sum(~al.valid[ids], lens) == 0)


def _merged(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["a", "b", "n"])


def _count(files):
    def run(batches):
        pair, parts, rows = _pair(files), [], 0
        for batch in batches:
            for _, _, al, ids, lens, ok in _slices(batch, pair):
                if al is None:
                    continue
                used = np.bincount(ids[np.repeat(ok, lens)], minlength=len(al.valid))
                t = pa.table({"a": al.a, "b": al.b, "n": used[al.word]}).filter(pc.greater(pa.array(used[al.word]), 0))
                parts.append(_merged([t]))
                rows += len(parts[-1])
                if rows > MERGE_ROWS:
                    parts = [_merged(parts)]
                    rows = len(parts[0])
                    if rows > MERGE_ROWS // 2:
                        yield from parts[0].to_batches()
                        parts, rows = [], 0
        if parts:
            yield from _merged(parts).to_batches()
    return run


def _score(files, top):
    def run(batches):
        pair = _pair(files)
        keys, counts, best = top.value
        row = TaskContext.get().partitionId() << ROW_BITS
        for batch in batches:
            for lo, hi, al, ids, lens, ok in _slices(batch, pair):
                n = hi - lo
                rows = np.arange(row, row + n)
                row += n
                out = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}
                sha, rare = [""] * n, []
                if al is not None:
                    key = (al.a << 32) | al.b
                    at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
                    found = keys[at] == key if len(keys) else np.zeros(len(key), bool)
                    m = len(al.valid)
                    hits = np.bincount(al.word[found], weights=best[at[found]], minlength=m) if len(keys) else np.zeros(m)
                    # Whole numbers: sums of counts as integers, not as floats.
                    per = np.zeros(m, np.int64)
                    if len(keys):
                        np.add.at(per, al.word[found], counts[at[found]])
                    for c, v in (("n_a", al.n_a), ("n_b", al.n_b), ("n_groups", al.n_groups), ("n_links", al.n_links),
                                 ("n_best", hits.astype(np.int64)), ("count_sum", per)):
                        run_sum = np.concatenate([np.zeros(1, np.int64), np.cumsum(v[ids])])
                        ends = np.cumsum(lens)
                        out[c] = np.where(ok, run_sum[ends] - run_sum[ends - lens], 0)
                    starts = np.cumsum(lens) - lens
                    for i in np.flatnonzero(ok):
                        own = ids[starts[i]:starts[i] + lens[i]].tolist()
                        sha[i] = hashlib.sha256(";".join([al.groups[w] for w in own]).encode()).hexdigest()
                    rare = _rare_links(al, found, ids, lens, ok, rows)
                none = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(rows), "doc_id": batch.column("doc_id")[lo:hi], **{c: pa.array(v) for c, v in out.items()},
                    "groups_sha256": pa.array(sha, pa.string()), "a": none, "b": none, "n": none})
                for t in rare:
                    k = len(t)
                    yield pa.RecordBatch.from_pydict({
                        "row": t["row"].combine_chunks(), "doc_id": pa.nulls(k, pa.int64()),
                        **{c: pa.nulls(k, pa.int64()) for c in out}, "groups_sha256": pa.nulls(k, pa.string()),
                        **{c: t[c].combine_chunks() for c in ("a", "b", "n")}})
    return run


def _rare_links(al, found, ids, lens, ok, rows) -> list[pa.Table]:
    """(row, a, b, n) of the links whose pair is not in the broadcast table."""
    miss = ~found
    if not miss.any():
        return []
    holds = np.bincount(al.word[miss], minlength=len(al.valid)) > 0
    doc = np.repeat(np.arange(len(lens)), lens)
    take = holds[ids] & ok[doc]
    words = pa.table({"word": ids[take], "row": rows[doc[take]]})
    links = pa.table({"word": al.word[miss], "a": al.a[miss], "b": al.b[miss]})
    t = words.join(links, keys="word", join_type="inner", use_threads=False)
    t = t.group_by(["row", "a", "b"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["row", "a", "b", "n"])
    return [t.slice(i, 1 << 16) for i in range(0, len(t), 1 << 16)]


def pair_counts(docs: DataFrame, files) -> DataFrame:
    """(a, b, n, best): links of every id pair in the corpus, and whether that is the
    highest count of its B id."""
    parts = docs.mapInArrow(_count(files), "a long, b long, n long")
    n = materialize(parts.groupBy("a", "b").agg(F.sum("n").alias("n")), "op11-pairs")
    top = n.groupBy(F.col("b").alias("_b")).agg(F.max("n").alias("_top"))          # one row a B id
    return materialize(n.join(top, F.col("b") == F.col("_b")).select("a", "b", "n", (F.col("n") == F.col("_top")).alias("best")),
                       "op11-best")


def _frequent(pairs: DataFrame, most: int) -> int:
    """The least count that leaves at most ``most`` pairs."""
    size = F.floor(F.log2("n") * 64).cast("long")
    tally = pairs.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).collect()
    least, total = 1 << 62, 0
    for r in sorted(tally, key=lambda r: -r["size"]):               # at most 64 sizes a power of two
        total += r["k"]
        if total > most:
            break
        least = r["least"]
    return least


def align_documents(docs: DataFrame, folder: str = TOKENIZERS, file_a: str = FILE_A, file_b: str = FILE_B,
                    max_pairs: int = MAX_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    with open(os.path.join(folder, file_a), encoding="utf-8") as f, open(os.path.join(folder, file_b), "rb") as g:
        files = spark.sparkContext.broadcast((f.read(), g.read()))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pairs = pair_counts(d, files)
    least = _frequent(pairs, max_pairs)
    top = pairs.where(F.col("n") >= least).select(
        (F.shiftleft("a", 32).bitwiseOR(F.col("b"))).alias("key"), "n", "best").toArrow().sort_by("key")
    top = spark.sparkContext.broadcast((top["key"].to_numpy(), top["n"].to_numpy(),
                                        top["best"].to_numpy(zero_copy_only=False).astype(np.int64)))
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = materialize(d.mapInArrow(_score(files, top), "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                   "n_best long, count_sum long, groups_sha256 string, a long, b long, n long"), "op11-scored")
    top.destroy()
    files.destroy()
    rest = pairs.where(F.col("n") < least)
    scored = got.where("groups_sha256 IS NOT NULL")
    if rest.isEmpty():
        return scored.select(*out)
    more = (got.where("groups_sha256 IS NULL").select("row", "a", "b", F.col("n").alias("times")).join(rest, ["a", "b"])
               .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
                                   F.sum(F.col("times") * F.col("n")).alias("_sum")))
    return (scored.join(more, "row", "left")
                  .withColumns({"n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)),
                                "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0))}).select(*out))


def query(spark, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))
