"""Prefix trie of conversations, built as a z-fast trie in batches.

A conversation c is rebuilt from the first h = crc32(c) % 9 turns of conversation
c - c % 5 and its own turns after its first h.  Turn sequences are named by signatures:
``sigs`` holds 16 bytes per prefix, the MD5 of the signature before it and of the turn,
so that two prefixes are compared without their texts.

Equal conversations are one entry (partial aggregates).  The compacted trie is a set of
chains: the least conversation of a branch owns the nodes from the depth ``e`` at which
it leaves an older chain (its owner) to its end, and the depths at which others leave
cut its chain into compacted nodes.  A compacted node over the depths (lo, hi] is hashed
at its handle, the 2-fattest number in that range.

1. Every conversation still outside finds its exit node by fat binary search: at most
   log2(longest) + 1 joins with the handle table, then one by the node's first depth;
   the exact exit depth comes from comparing signatures inside the row.
2. Of those that leave at one place by one turn, the least is inserted; the others
   search again, from where they left, against the grown trie.  A batch holds all such
   winners, so the number of batches is the nesting of branches, not of conversations.
3. Edges are expanded: one row per depth of a chain.  Counts go up chain by chain,
   from the last batch to the first, as sums by (owner, depth) and windows along chains.

Every join is on a key that is unique on one side; the side that may repeat a key (many
conversations probe one handle) is salted.  A conversation is one row of 16 bytes a turn.

Edge cases: rows with a null conv_id belong to no conversation and are left out; null
role or text is empty; equal turn numbers are ordered by role, then text; a conversation
rebuilt without turns is a member of the root only; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import table
from affinity.session import materialize

GROUP, MOST_SHARED = 5, 9          # fixed by the contract: c - c % 5 and crc32(c) % 9
SIG = 16                           # bytes of a signature
SALTS = 8                          # copies of a handle, so that one handle is probed by several tasks
PACK = 1 << 20                     # characters of ids in one packed row
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _gather(batches):
    """One row a conversation from rows sorted by conversation and turn."""
    now, hashes, sizes = None, [], []
    for batch in batches:
        out = []
        for conv, h, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "h", "n"))):
            if conv != now:
                if now is not None:
                    out.append((now, b"".join(hashes), sizes))
                now, hashes, sizes = conv, [], []
            hashes.append(h)
            sizes.append(n)
        if out:
            yield _conversation_batch(out)
    if now is not None:
        yield _conversation_batch([(now, b"".join(hashes), sizes)])


def _conversation_batch(rows):
    ids, turns, sizes = zip(*rows)
    return pa.RecordBatch.from_pydict({"conv_id": pa.array(ids, pa.int64()), "turns": pa.array(turns, pa.binary()),
                                       "sizes": pa.array(sizes, pa.list_(pa.int64()))})


def _sign(batches):
    """Signatures of all prefixes of every conversation."""
    for batch in batches:
        sigs = []
        for turns in batch.column("turns").to_pylist():
            last, out = b"", []
            for i in range(0, len(turns), SIG):
                last = hashlib.md5(last + turns[i:i + SIG]).digest()
                out.append(last)
            sigs.append(b"".join(out))
        yield pa.RecordBatch.from_pydict({
            "conv_id": batch.column("conv_id"), "len": pa.array([len(s) // SIG for s in sigs], pa.int32()),
            "sigs": pa.array(sigs, pa.binary()), "full": pa.array([s[-SIG:] for s in sigs], pa.binary()),
            "sizes": batch.column("sizes")})


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, len, sigs, full, sizes): every rebuilt conversation; ``full`` is the
    signature of the whole, ``sizes`` the UTF-8 bytes of its texts."""
    t = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                             F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    t = t.where("conv_id IS NOT NULL").withColumns({
        "h": F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))),
        "n": F.octet_length("text").cast("long")})
    own = materialize(t.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
                       .select("conv_id", "h", "n")
                       .mapInArrow(_gather, "conv_id long, turns binary, sizes array<long>"), "op13-own")
    head = own.select(F.col("conv_id").alias("_base"),
                      F.expr(f"substring(turns, 1, {SIG * (MOST_SHARED - 1)})").alias("_turns"),
                      F.slice("sizes", 1, MOST_SHARED - 1).alias("_sizes"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MOST_SHARED)).cast("int")
    both = (own.withColumn("_h", h).join(head, F.col("conv_id") - F.col("conv_id") % GROUP == F.col("_base"), "left")
               .select("conv_id",
                       F.expr(f"concat(coalesce(substring(_turns, 1, {SIG} * _h), X''), "
                              f"substring(turns, {SIG} * _h + 1, length(turns)))").alias("turns"),
                       F.expr("concat(coalesce(slice(_sizes, 1, _h), cast(array() as array<bigint>)), "
                              "slice(sizes, _h + 1, size(sizes)))").alias("sizes")))
    return both.mapInArrow(_sign, "conv_id long, len int, sigs binary, full binary, sizes array<long>")


def _sig(sigs: str, depth: str) -> str:
    return f"substring({sigs}, {SIG} * ({depth}) - {SIG - 1}, {SIG})"


def _fattest(a: str, b: str) -> str:
    """The number in (a, b] with the most trailing zero bits."""
    shift = f"(length(bin(({a}) ^ ({b}))) - 1)"
    return f"shiftleft(shiftright({b}, {shift}), {shift})"


def _handles(placed: DataFrame) -> DataFrame:
    """The compacted nodes of all chains."""
    cut = placed.groupBy("owner").agg(F.collect_set("e").alias("cut"))     # distinct depths of one chain
    chains = placed.where("e < len").select("conv", "e", "len", "sigs").join(
        cut.withColumnRenamed("owner", "conv"), "conv", "left")
    cuts = F.expr("array_sort(array_union(array(e, len), filter(coalesce(cut, cast(array() as array<int>)), "
                  "x -> x > e and x < len)))")
    parts = (chains.withColumn("cuts", cuts).select("conv", "sigs", F.explode(F.expr(
        "transform(sequence(1, size(cuts) - 1), i -> struct(cuts[i - 1] as lo, cuts[i] as hi))")).alias("x"))
        .select("conv", "sigs", "x.lo", "x.hi").withColumn("f", F.expr(_fattest("lo", "hi"))))
    return parts.select(F.col("conv").alias("h_conv"), "lo", "hi", "f", F.expr(_sig("sigs", "f")).alias("h_sig"),
                        F.expr(_sig("sigs", "lo + 1")).alias("name_sig"),
                        F.expr(f"substring(sigs, 1, {SIG} * hi)").alias("h_sigs"))


_COMMON = ("size(filter(sequence(1, least(len, hi)), i -> substring(sigs, 16 * i - 15, 16) = "
           "substring(h_sigs, 16 * i - 15, 16)))")


def _locate(rest: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """``rest`` with its exit depth ``e`` and the owner of the chain it leaves."""
    salted = nodes.withColumn("h_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    r = rest.withColumns({"a": F.col("e"), "b": F.col("len"), "salt": F.pmod(F.xxhash64("conv"), F.lit(SALTS)).cast("int")})

    def probe(r, depth, at, sig):
        # Rows that are done look up a depth that does not exist, spread by their own signature.
        r = r.withColumns({"p_depth": F.expr(f"if(a < b, {depth}, -1)"),
                           "p_sig": F.expr(f"if(a < b, {_sig('sigs', depth)}, full)")})
        n = salted.select("h_conv", "hi", "h_sigs", "h_salt", F.expr(at).alias("h_depth"), F.col(sig).alias("h_key"))
        j = r.join(n, (F.col("p_depth") == F.col("h_depth")) & (F.col("p_sig") == F.col("h_key"))
                   & (F.col("salt") == F.col("h_salt")), "left")
        return j.withColumn("m", F.expr(f"if(h_conv is null, null, {_COMMON})"))

    columns = ["conv", "len", "sigs", "full", "m_copies", "sizes", "salt"]
    for _ in range(longest.bit_length() + 1):
        j = probe(r, _fattest("a", "b"), "f", "h_sig")
        r = j.select(*columns, F.expr("if(m is null, owner, h_conv)").alias("owner"),
                     F.expr("case when m is null then a when m < hi or m = len then m else hi end").alias("a"),
                     F.expr("case when m is null then if(a < b, p_depth - 1, b) "
                            "when m < hi or m = len then m else b end").alias("b"),
                     F.expr("m is not null and (m < hi or m = len)").alias("ended") if _ == 0 else
                     F.expr("ended or (m is not null and (m < hi or m = len))").alias("ended"))
    # The exit edge whose handle lies beyond the common prefix: by its first depth.
    r = r.withColumn("b", F.expr("if(not ended and a < len, a + 1, a)"))
    j = probe(r, "a + 1", "lo + 1", "name_sig")
    return j.select("conv", "len", "sigs", "full", "m_copies", "sizes", F.expr("if(m is null, owner, h_conv)").alias("owner"),
                    F.expr("if(m is null, a, m)").alias("e"))


def _chains(entries: DataFrame, first: int) -> tuple[DataFrame, int]:
    """(conv, len, sigs, full, m_copies, sizes, owner, e, level) of every distinct
    conversation: the owner of the chain it leaves and the depth at which it does."""
    longest = entries.agg(F.max("len")).first()[0]
    rest = entries.select("conv", "len", "sigs", "full", "m_copies", "sizes",
                          F.lit(first).cast("long").alias("owner"), F.lit(0).alias("e"))
    placed, level = rest.where("len = 0").withColumn("level", F.lit(0)), 0
    rest = rest.where("len > 0")
    while True:
        win = rest.groupBy("e", F.expr(f"if(e = 0, X'', {_sig('sigs', 'e')})").alias("_at"),
                           F.expr(_sig("sigs", "e + 1")).alias("_by")).agg(F.min("conv").alias("_win"))
        marked = materialize(rest.join(win.select("_win"), F.col("conv") == F.col("_win"), "left"), f"op13-batch{level}")
        placed = placed.unionByName(marked.where("_win IS NOT NULL").drop("_win").withColumn("level", F.lit(level)))
        rest = marked.where("_win IS NULL").drop("_win")
        if rest.isEmpty():
            return placed, level
        level += 1
        found = materialize(_locate(rest, materialize(_handles(placed), f"op13-nodes{level}"), longest), f"op13-found{level}")
        placed = placed.unionByName(found.where("e = len").withColumn("level", F.lit(level)))
        rest = found.where("e < len")
        if rest.isEmpty():
            return placed, level


def _pack(batches):
    """Ids of one conversation text, joined: few rows for a text with very many copies."""
    for batch in batches:
        full, ids = batch.column("full").to_pylist(), batch.column("conv_id").to_pylist()
        cuts = [0] + [i for i in range(1, len(full)) if full[i] != full[i - 1]] + [len(full)]
        rows = [(full[a], ids[a], ",".join(map(str, ids[a:b]))) for a, b in zip(cuts, cuts[1:]) if a < b]
        if rows:
            f, i, t = zip(*rows)
            yield pa.RecordBatch.from_pydict({"full": pa.array(f, pa.binary()), "first": pa.array(i, pa.int64()),
                                              "ids": pa.array(t, pa.string())})


def _digest(batches):
    """SHA-256 of the joined ids, from packed rows sorted by text and first id."""
    now, sha = None, None
    for batch in batches:
        out = []
        for full, ids in zip(batch.column("full").to_pylist(), batch.column("ids").to_pylist()):
            if sha is None or full != now:
                if sha is not None:
                    out.append((now, sha.hexdigest()))
                now, sha = full, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_pydict({"end_sig": pa.array([x for x, _ in out], pa.binary()),
                                              "sha": pa.array([x for _, x in out], pa.string())})
    if sha is not None:
        yield pa.RecordBatch.from_pydict({"end_sig": pa.array([now], pa.binary()), "sha": pa.array([sha.hexdigest()], pa.string())})


def _ends(convs: DataFrame) -> DataFrame:
    """(end_sig, sha) of the ids that share each whole conversation."""
    n = int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = (convs.select("full", "conv_id").repartitionByRange(n, "full", "conv_id")
                   .sortWithinPartitions("full", "conv_id").mapInArrow(_pack, "full binary, first long, ids string"))
    return (packed.repartition("full").sortWithinPartitions("full", "first")
                  .mapInArrow(_digest, "end_sig binary, sha string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per trie node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    convs = materialize(rebuilt(conversations), "op13-rebuilt")
    first, total = convs.agg(F.min("conv_id"), F.count(F.lit(1))).first()
    if first is None:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                         "n_leaves long, saved_tokens long, ends_sha256 string")
    entries = materialize(convs.groupBy("full").agg(
        F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("m_copies"), F.first("len").alias("len"),
        F.first("sigs").alias("sigs"), F.first("sizes").alias("sizes")), "op13-entries")
    placed, levels = _chains(entries, first)
    placed = materialize(placed, "op13-placed")

    gone = (placed.where("e = len").select("owner", "e", F.col("m_copies").alias("members"), F.lit(0).cast("long").alias("leaves"),
                                           F.lit(0).cast("long").alias("saved"), F.lit(0).cast("long").alias("chains")))
    parts, nodes = [gone], None
    down = Window.partitionBy("conv").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    att = gone
    for level in range(levels, -1, -1):
        chain = placed.where((F.col("level") == level) & (F.col("e") < F.col("len"))).select(
            "conv", "owner", "e", "len", "m_copies", "sigs", "sizes", F.explode(F.expr("sequence(e + 1, len)")).alias("d"))
        chain = chain.select("conv", "owner", "e", "len", "m_copies", "d", F.expr(_sig("sigs", "d")).alias("sig"),
                             F.expr("sizes[d - 1]").alias("bytes"))
        below = (att.where("e > 0").groupBy(F.col("owner").alias("conv"), F.col("e").alias("d"))
                    .agg(*[F.sum(c).alias(c) for c in ("members", "leaves", "saved", "chains")]))
        x = chain.join(below, ["conv", "d"], "left").fillna(0, ["members", "leaves", "saved", "chains"])
        x = x.withColumn("n_convs", F.col("m_copies") + F.sum("members").over(down))
        x = x.withColumn("own", (F.col("n_convs") - 1) * F.col("bytes") + F.col("saved"))
        tip = F.when((F.col("d") == F.col("len")) & (F.col("chains") == 0), 1).otherwise(0)
        x = x.select("conv", "owner", "e", "d", "sig", "n_convs",
                     (F.col("chains") + (F.col("d") < F.col("len")).cast("long")).alias("n_children"),
                     F.sum(F.col("leaves") + tip).over(down).alias("n_leaves"),
                     F.sum("own").over(down).alias("saved_tokens"))
        x = materialize(x, f"op13-level{level}")
        nodes = x if nodes is None else nodes.unionByName(x)
        parts.append(x.where("d = e + 1").select("owner", "e", F.col("n_convs").alias("members"), F.col("n_leaves").alias("leaves"),
                                                 F.col("saved_tokens").alias("saved"), F.lit(1).cast("long").alias("chains")))
        att = att.unionByName(parts[-1])
    ends = materialize(_ends(convs), "op13-ends")
    parent = F.when(F.col("d") - 1 > F.col("e"), F.col("conv")).otherwise(F.col("owner"))
    body = nodes.join(ends, F.col("sig") == F.col("end_sig"), "left").select(
        F.col("conv").alias("conv_id"), F.col("d").cast("long").alias("depth"), parent.alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))
    top = att.where("e = 0").agg(F.coalesce(F.sum("chains"), F.lit(0)).alias("n_children"),
                                 F.coalesce(F.sum("leaves"), F.lit(0)).alias("leaves"),
                                 F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"))
    root_end = ends.where(F.expr("length(end_sig) = 0")).agg(F.max("sha")).scalar()
    root = top.select(F.lit(first).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
                      F.lit(None).cast("long").alias("parent_conv_id"), F.lit(total).cast("long").alias("n_convs"), "n_children",
                      F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
                      "saved_tokens", F.coalesce(root_end, F.lit(EMPTY_SHA)).alias("ends_sha256"))
    return body.unionByName(root)


def query(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


SQL = """
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: ord(s)::BIGINT)),
             lambda x, b: list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda z, k: CASE WHEN z % 2 = 1 THEN xor(z // 2, 3988292384::BIGINT) ELSE z // 2 END)),
             4294967295::BIGINT) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h),
p AS (
  SELECT conv_id, row_number() OVER w AS d, strlen(text) AS bytes,
         string_agg(md5(strlen(role) || ':' || role || text), '') OVER w AS k
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, i)),
path AS (SELECT conv_id, d, k, bytes FROM p UNION ALL SELECT conv_id, 0, '', 0 FROM c),
leng AS (SELECT conv_id, max(d) AS len FROM path GROUP BY conv_id),
node AS (
  SELECT d, k, min(path.conv_id) AS conv, count(*) AS n, max(bytes) AS bytes,
         string_agg(CAST(path.conv_id AS VARCHAR), ',' ORDER BY path.conv_id) FILTER (WHERE len = d) AS ends
  FROM path JOIN leng USING (conv_id) GROUP BY d, k),
up AS (SELECT a.d, a.k, b.conv AS parent FROM node a JOIN path q ON q.conv_id = a.conv AND q.d = a.d - 1
       JOIN node b ON b.d = q.d AND b.k = q.k),
kids AS (SELECT b.d, b.k, count(*) AS n_children FROM node a JOIN path b ON b.conv_id = a.conv AND b.d = a.d - 1 GROUP BY b.d, b.k),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (d, k)),
tot AS (
  SELECT q.d, q.k, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n - 1) * f.bytes) AS saved
  FROM full_node f JOIN path q ON q.conv_id = f.conv AND q.d <= f.d GROUP BY q.d, q.k)
SELECT CAST(conv AS BIGINT) AS conv_id, CAST(d AS BIGINT) AS depth, CAST(parent AS BIGINT) AS parent_conv_id,
       CAST(n AS BIGINT) AS n_convs, CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM full_node JOIN tot USING (d, k) LEFT JOIN up USING (d, k)
"""
