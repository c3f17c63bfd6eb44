"""Removal of long byte strings that occur elsewhere, by merged Burrows-Wheeler transforms.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts at any other place
of any document.

1. *Runs.*  Every start of a full window belongs to a run of consecutive starts whose
   windows have the same least hash of ``GRAM`` bytes, their anchor (at most ``MAX_RUN``
   starts).  Equal windows have equal anchors, so only runs of one anchor can match.  A
   run's context is the text its windows cover; equal contexts of one anchor are one
   (places are packed per slice of texts before any shuffle, then counted in Spark).
2. *Settled contexts.*  One that occurs twice is repeated as a whole; an anchor that
   occurs once, and stands once in its run, is not repeated at all.  What is left are
   anchors with several contexts, and runs that may repeat themselves.
3. *Index.*  Contexts are dealt to buckets of bounded bytes by anchor and in a bucket to
   shards.  A shard sorts its suffixes by ``LENGTH`` bytes and keeps its transform over
   ``WORD``-byte symbols.  The transforms are merged by refining their interleave: round
   h + 1 deals the suffixes, in the order of round h, stably by the symbol before them,
   and suffixes stay in one interval while symbol and former interval agree.  After
   LENGTH / WORD rounds an interval holds the suffixes with LENGTH bytes in common; no
   suffix is sorted again and no text is read.  Intervals with two starts are repeated.
4. *Hot anchors* (more than ``MAX_CONTEXTS`` contexts, which one bucket should not hold):
   their windows are counted by 128-bit hashes, packed per batch before the shuffle.
5. Repeated starts go back to their documents, which drop the bytes they cover.

A document is one row; nothing else is gathered in one task beyond a bucket.  Runs and
contexts are told apart by 64-bit hashes each, that is by 128 bits together.

Edge cases: null is the empty text; texts shorter than LENGTH keep all bytes; repeated
rows are copies of each other; a null doc_id is a row like any other; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import row_slices, table, text_bytes
from affinity.session import materialize, release

LENGTH = 200                     # fixed by the contract
GRAM = 80                        # bytes of an anchor
WORD = 8                         # bytes of a symbol of the transform; LENGTH is a multiple
MAX_RUN = 256
MAX_CONTEXTS = 256
BUCKET_BYTES, SHARD_BYTES = 1 << 20, 1 << 18
SLICE_BYTES = 1 << 20
SALTS = 8
ROW_BITS = 40
SIZE_BITS = 9                    # a place: its start, 8 bits of the run's size less one, one bit ``own``

_RNG = np.random.default_rng(20240607)
BYTE_VALUE = _RNG.integers(1 << 62, size=256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_RNG.integers(1 << 62)) * 2 + 1
UNBASE = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        for name, b in (("up", BASE), ("down", UNBASE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def runs(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text, start, number of starts, anchor, context, own) of every run of the texts;
    ``own``: its anchor may stand in it twice, so that its own windows may be equal."""
    x = np.frombuffer(b"".join(texts), np.uint8)
    n = len(x)
    if n < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[x] * up[:n], out=sums[1:])
    gram = _mix((sums[GRAM:] - sums[:n + 1 - GRAM]) * down[:n + 1 - GRAM])
    grams = LENGTH - GRAM + 1
    low = _sliding(np.minimum, gram, grams)
    # Grams that are the least of a window; equal neighbours among them stand in one run.
    most = _sliding(np.maximum, np.concatenate([np.zeros(grams - 1, np.uint64), low, np.zeros(grams - 1, np.uint64)]), grams)
    least = np.flatnonzero(most == gram)
    twin = np.zeros(n + 1, np.int64)
    twin[least[:-1][(gram[least[1:]] == gram[least[:-1]]) & (np.diff(least) <= grams)] + 1] = 1
    twin = np.cumsum(twin)
    lens = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lens)
    at = np.arange(len(low))
    full = at + LENGTH <= np.repeat(ends, lens)[:len(low)]
    new = full.copy()
    new[1:] &= ~(full[:-1] & (low[1:] == low[:-1]))
    first = np.flatnonzero(new)
    size = np.diff(np.append(np.cumsum(full)[first] - 1, full.sum()))
    pieces = -(-size // MAX_RUN)
    piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(first, pieces) + piece * MAX_RUN
    size = np.minimum(np.repeat(size, pieces) - piece * MAX_RUN, MAX_RUN)
    end = start + size + LENGTH - 1
    context = _mix(((sums[end] - sums[start]) * down[start]) ^ size.astype(np.uint64))
    text = np.searchsorted(ends, start, side="right")
    own = twin[np.minimum(start + size + grams, n)] > twin[start]
    return text, start - (ends - lens)[text], size, low[start], context, own


def _sliding(pick, x: np.ndarray, width: int) -> np.ndarray:
    """Least or greatest value of every ``width`` neighbours, by doubling."""
    wide = 1
    while wide < width:
        step = min(wide, width - wide)
        x = pick(x[:len(x) - step], x[step:])
        wide += step
    return x


def _first_pass(batches):
    """Rows of the documents, and rows of their runs: the places of an (anchor, context) in
    a slice of texts are one row, all but the first packed in ``more``."""
    row = TaskContext.get().partitionId() << ROW_BITS
    for batch in batches:
        for lo, hi in row_slices(batch.column("text"), SLICE_BYTES):
            texts = text_bytes(batch.column("text").slice(lo, hi - lo))
            n = hi - lo
            rows = np.arange(row, row + n)
            row += n
            none = lambda k, t: pa.nulls(k, t)
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(rows), "doc_id": batch.column("doc_id")[lo:hi], "body": pa.array(texts, pa.binary()),
                "sha": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                "anchor": none(n, pa.int64()), "context": none(n, pa.int64()), "place": none(n, pa.int64()),
                "k": none(n, pa.int32()), "more": none(n, pa.binary())})
            text, start, size, anchor, context, own = runs(texts)
            if len(text) == 0:
                continue
            order = np.lexsort((context, anchor))
            text, start, size, anchor, context, own = (v[order] for v in (text, start, size, anchor, context, own))
            new = np.ones(len(text), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])
            head = np.flatnonzero(new)
            m = len(head)
            count = np.diff(np.append(head, len(text)))
            place = (start << SIZE_BITS) | ((size - 1) << 1) | own
            both = np.stack([rows[text], place], axis=1)
            more = [None] * m
            for i in np.flatnonzero(count > 1):
                more[i] = both[head[i] + 1:head[i] + count[i]].tobytes()
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(rows[text[head]]), "doc_id": none(m, pa.int64()), "body": none(m, pa.binary()),
                "sha": none(m, pa.string()), "anchor": pa.array(anchor[head].view(np.int64)),
                "context": pa.array(context[head].view(np.int64)), "place": pa.array(place[head]),
                "k": pa.array(count.astype(np.int32)), "more": pa.array(more, pa.binary())})


def _places(batches):
    """(row, start, size, cover) of every place of the repeated contexts."""
    for batch in batches:
        more = batch.column("more").to_pylist()
        packed = [np.frombuffer(m, np.int64).reshape(-1, 2) if m else np.zeros((0, 2), np.int64) for m in more]
        times = np.array([1 + len(p) for p in packed], np.int64)
        if not len(times):
            continue
        first = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "place")], axis=1)
        both = np.concatenate([first, *packed])
        who = np.concatenate([np.arange(len(times)), np.repeat(np.arange(len(times)), times - 1)])
        yield pa.RecordBatch.from_pydict({
            "row": pa.array(both[:, 0]), "start": pa.array(both[:, 1] >> SIZE_BITS),
            "size": pa.array(((both[:, 1] >> 1) & (MAX_RUN - 1)) + 1), "cover": batch.column("cover").take(pa.array(who))})


def _cut(batches):
    """Texts of the wanted contexts of every document."""
    for batch in batches:
        for body, want in zip(batch.column("body").to_pylist(), batch.column("want").to_pylist()):
            yield pa.RecordBatch.from_pydict({
                **{c: pa.array([w[c] for w in want], pa.int64()) for c in ("anchor", "context", "n", "m")},
                "size": pa.array([w["size"] for w in want], pa.int32()),
                "body": pa.array([body[w["start"]:w["start"] + w["size"] + LENGTH - 1] for w in want], pa.binary())})


# ------------------------------------------------------------------ transforms --

class Shard:
    """Sorted suffixes of some strings and their transform.

    An element is a position of a string or one of the ``WORD`` empty suffixes at its end;
    ``before`` is the word before an element (``has`` is False at the first positions),
    ``to`` the rank of the element that starts with that word, all in sorted order."""

    def __init__(self, strings: list[bytes]):
        pad = b"\0" * WORD
        text = np.frombuffer(pad.join(strings) + pad * 2, np.uint8)
        lens = np.array([len(s) for s in strings], np.int64)
        n = int((lens + WORD).sum())
        self.string = np.repeat(np.arange(len(strings)), lens + WORD)
        self.at = np.arange(n) - np.repeat(np.cumsum(lens + WORD) - (lens + WORD), lens + WORD)
        live = self.at < lens[self.string]
        word = np.zeros(n, np.uint64)
        for k in range(WORD):
            word = (word << np.uint64(8)) | text[k:k + n].astype(np.uint64)
        key, step = np.where(live, word, 0), WORD
        rank = _ranks(key, ~live)
        while step < LENGTH:
            jump = min(step, LENGTH - step)
            ahead = np.zeros(n, np.int64)
            near = np.flatnonzero(self.at + jump < lens[self.string])
            ahead[near] = rank[near + jump] + 1
            rank = _ranks((rank.astype(np.uint64) << np.uint64(32)) | ahead.astype(np.uint64), ~live)
            step += jump
        # Ties in LENGTH bytes: any order will do as long as it is kept by all.
        self.order = np.argsort(rank, kind="stable")
        at = self.order
        self.has = self.at[at] >= WORD
        self.before = np.where(self.has, word[np.maximum(at - WORD, 0)], 0)
        place = np.empty(n, np.int64)
        place[at] = np.arange(n)
        self.to = np.where(self.has, place[np.maximum(at - WORD, 0)], -1)
        self.ends = np.flatnonzero(~live[at])
        self.tail = (self.at[at] >= LENGTH) & (self.at[at] <= lens[self.string[at]])      # where a full window ends


def _ranks(key: np.ndarray, ended: np.ndarray) -> np.ndarray:
    """Dense ranks of the keys; the empty suffixes come first, as one rank."""
    order = np.argsort(key)
    new = np.zeros(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new) + 1
    rank[ended] = 0
    return rank


def merge(shards: list[Shard], only_repeated: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(elements of all shards in merged order, interval of each), elements numbered
    shard after shard in their own order.

    With ``only_repeated``, the rounds begin with the elements at which a full window ends,
    so that the last one has the windows' starts; elements alone in their interval leave
    after each round, as the suffixes that go on to them are alone from the next one on.

    Only transforms are read.  Round by round the interleave is ordered by one more word
    ahead; the elements of one shard never change their order among each other within an
    interval, so each round is one stable deal by symbol."""
    base = np.cumsum([0] + [len(s.order) for s in shards])
    has = np.concatenate([s.has for s in shards])
    to = np.concatenate([s.to + b for s, b in zip(shards, base)])
    ends = np.concatenate([s.ends + b for s, b in zip(shards, base)])
    symbols = np.unique(np.concatenate([s.before[s.has] for s in shards]))
    code = np.zeros(len(has), np.uint64)
    code[has] = np.searchsorted(symbols, np.concatenate([s.before for s in shards])[has])
    place = np.uint64(32)
    z = np.flatnonzero(np.concatenate([s.tail for s in shards])) if only_repeated else np.arange(len(has))
    interval = np.zeros(len(z), np.int64)
    for _ in range(LENGTH // WORD):
        moved = has[z]
        z, interval = z[moved], interval[moved]
        if len(z) == 0:
            break
        dealt = np.sort((code[z] << place) | np.arange(len(z), dtype=np.uint64))
        perm, sym = (dealt & np.uint64(0xFFFFFFFF)).astype(np.int64), dealt >> place
        former = interval[perm]
        new = np.ones(len(perm), bool)
        new[1:] = (sym[1:] != sym[:-1]) | (former[1:] != former[:-1])
        if only_repeated:
            alone = new.copy()
            alone[:-1] &= new[1:]
            z, interval = to[z[perm]][~alone], np.cumsum(new)[~alone]
            continue
        z = np.concatenate([ends, to[z[perm]]])
        interval = np.concatenate([np.zeros(len(ends), np.int64), np.cumsum(new)])
    return z, interval


def repeated_starts(strings: list[bytes]) -> list[np.ndarray]:
    """For each string a flag per start of a full window: does the window start at
    another place of the strings, too."""
    groups, size = [[]], 0
    for i, s in enumerate(strings):
        if size and size + len(s) > SHARD_BYTES:
            groups.append([])
            size = 0
        groups[-1].append(i)
        size += len(s)
    shards = [Shard([strings[i] for i in g]) for g in groups]
    z, interval = merge(shards, only_repeated=True)
    owner = np.concatenate([np.asarray(g)[s.string[s.order]] for g, s in zip(groups, shards)])[z]
    at = np.concatenate([s.at[s.order] for s in shards])[z]
    lens = np.array([len(s) for s in strings])
    full = np.flatnonzero(at + LENGTH <= lens[owner])
    owner, at, interval = owner[full], at[full], interval[full]
    twice = np.bincount(interval)[interval] > 1
    out = [np.zeros(max(len(s) - LENGTH + 1, 0), bool) for s in strings]
    first = np.cumsum([0] + [len(o) for o in out])
    flat = np.zeros(first[-1], bool)
    flat[first[owner[twice]] + at[twice]] = True
    return [flat[a:b] for a, b in zip(first[:-1], first[1:])]


def _bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Repeated starts of a bucket's contexts, as bits."""
    pdf = pdf.sort_values(["anchor", "context"])
    marks = repeated_starts(pdf["body"].tolist())
    keep = [bool(m.any()) and n == 1 for m, n in zip(marks, pdf["n"])]
    got = pdf.loc[keep, ["anchor", "context"]].reset_index(drop=True)
    got["cover"] = [np.packbits(m).tobytes() for m, k in zip(marks, keep) if k]
    return got


# -------------------------------------------------------------------- hot anchors --

def _windows(batches):
    """Places of every window of the contexts, packed by window."""
    for batch in batches:
        seen: dict[bytes, list] = {}
        for a, c, n, body in zip(*(batch.column(x).to_pylist() for x in ("anchor", "context", "n", "body"))):
            for i in range(len(body) - LENGTH + 1):
                seen.setdefault(hashlib.blake2b(body[i:i + LENGTH], digest_size=16).digest(), []).append((a, c, i, n))
        if seen:
            kind = pa.list_(pa.struct([("anchor", pa.int64()), ("context", pa.int64()), ("i", pa.int32()), ("n", pa.int64())]))
            yield pa.RecordBatch.from_pydict({
                "window": pa.array(list(seen), pa.binary()), "n": pa.array([sum(x[3] for x in v) for v in seen.values()], pa.int64()),
                "places": pa.array([[dict(zip(("anchor", "context", "i", "n"), x)) for x in v] for v in seen.values()], kind)})


def _bits(pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    for a, c, size, starts in zip(pdf["anchor"], pdf["context"], pdf["size"], pdf["starts"]):
        m = np.zeros(size, bool)
        m[np.asarray(starts)] = True
        out.append((a, c, np.packbits(m).tobytes()))
    return pd.DataFrame(out, columns=["anchor", "context", "cover"])


def _hot(contexts: DataFrame) -> DataFrame:
    rows = materialize(contexts.repartition("anchor", "context").mapInArrow(
        _windows, "window binary, n long, places array<struct<anchor:long,context:long,i:int,n:long>>"), "op12-windows")
    twice = rows.groupBy("window").agg(F.sum("n").alias("n")).where("n > 1").select("window")
    hits = (rows.drop("n").join(twice, "window").select(F.explode("places").alias("p")).select("p.*").where("n = 1")
                .groupBy("anchor", "context").agg(F.collect_list("i").alias("starts")))      # one context's starts
    return hits.join(contexts.select("anchor", "context", "size"), ["anchor", "context"]).select(
        "anchor", "context", "size", "starts").mapInPandas(lambda it: (_bits(p) for p in it), "anchor long, context long, cover binary")


# ------------------------------------------------------------------------ removal --

def _remove(batches):
    """Counts and the hash of what is left of every document."""
    for batch in batches:
        out = []
        for body, sha, spans in zip(*(batch.column(c).to_pylist() for c in ("body", "sha", "spans"))):
            if not spans:
                out.append((len(body), 0, 0, sha))
                continue
            n = len(body)
            edge = np.zeros(n + 1, np.int32)
            for s in spans:
                if s["cover"] is None:
                    first, last = np.array([s["start"]]), np.array([s["start"] + s["size"] - 1])
                else:
                    on = np.unpackbits(np.frombuffer(s["cover"], np.uint8), count=s["size"])
                    first = last = s["start"] + np.flatnonzero(on)
                np.add.at(edge, first, 1)
                np.add.at(edge, last + LENGTH, -1)
            gone = np.cumsum(edge[:n]) > 0
            starts = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
            out.append((n, n - len(kept), starts, hashlib.sha256(kept).hexdigest()))
        n, removed, spans, sha = zip(*out) if out else ((), (), (), ())
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})


def remove_repeats(docs: DataFrame, max_contexts: int = MAX_CONTEXTS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = materialize(d.mapInArrow(_first_pass, "row long, doc_id long, body binary, sha string, anchor long, context long, "
                                     "place long, k int, more binary"), "op12-runs")
    base = first.where("sha IS NOT NULL").select("row", "doc_id", "body", "sha")
    run = first.where("sha IS NULL").select("row", "anchor", "context", "place", "k", "more")
    # Anchors that occur twice (in one run or in several), once for every salt.
    again = (run.groupBy("anchor").agg(F.sum("k").alias("t"), F.max(F.col("place") % 2).alias("own")).where("t > 1 OR own = 1")
                .select("anchor", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salt = F.pmod(F.col("context"), F.lit(SALTS)).cast("int")
    run = materialize(run.withColumn("salt", salt).join(again, ["anchor", "salt"], "left_semi"), "op12-again")
    ctx = materialize(run.groupBy("anchor", "context", "salt").agg(
        F.sum("k").alias("n"), F.min(F.struct("row", "place")).alias("at")), "op12-contexts")
    # Contexts per anchor; the totals go back to at most SALTS rows an anchor.
    cell = ctx.groupBy("anchor", "salt").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("least"))
    whole = (cell.groupBy("anchor").agg(F.sum("c").alias("m"), F.min("least").alias("least")).where("least = 1").select("anchor", "m"))
    tag = cell.select("anchor", "salt").join(whole, "anchor")
    several = materialize(ctx.join(tag, ["anchor", "salt"]).select(
        "anchor", "context", "n", "m", F.col("at.row").alias("row"), (F.shiftright("at.place", 1).bitwiseAND(MAX_RUN - 1) + 1).alias("size"),
        F.shiftright("at.place", SIZE_BITS).alias("start")), "op12-several")

    # Sorted joins at every size: neither side of these has a size bound.
    want = several.groupBy("row").agg(F.collect_list(F.struct("anchor", "context", "n", "m", "size", "start")).alias("want"))
    bodies = base.select("row", "body")
    texts = materialize(bodies.join(want.hint("merge"), "row").select("body", "want").mapInArrow(
        _cut, "anchor long, context long, n long, m long, size int, body binary"), "op12-texts")
    cold = texts.where(F.col("m") <= max_contexts)
    total = cold.agg(F.sum(F.length("body"))).first()[0] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    marked = (cold.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
                  .select("bucket", "anchor", "context", "n", "body").groupBy("bucket")
                  .applyInPandas(_bucket, "anchor long, context long, cover binary"))
    hot = texts.where(F.col("m") > max_contexts)
    settled = ctx.where("n > 1").select("anchor", "context", F.lit(None).cast("binary").alias("cover"))
    marked = materialize(settled.unionByName(marked).unionByName(_hot(hot)) if not hot.isEmpty()
                         else settled.unionByName(marked), "op12-marked")
    for done in (texts, several, ctx):
        release(done)
    spans = materialize(run.join(marked, ["anchor", "context"]).select("row", "place", "more", "cover")
                           .mapInArrow(_places, "row long, start long, size long, cover binary")
                           .groupBy("row").agg(F.collect_list(F.struct("start", "size", "cover")).alias("spans")), "op12-spans")
    release(run)
    return base.join(spans.hint("merge"), "row", "left").select("doc_id", "body", "sha", "spans").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
