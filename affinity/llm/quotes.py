"""Quotation linking: conversations in reply order, without their quotes.

Only DataFrame expressions: no Python runs on the executors.

1. A message's lines get a quote level (the number of leading ``>``, also written
   ``&gt;``); lines of one level in a row form a passage.  Level-0 lines are the message's
   own content; a line that only announces a quote ("... wrote:") right before one is
   dropped with it.
2. Quoted passages and their lines are normalised (lower case, letters and digits only)
   and hashed.  So are every message's own passages and lines.  Of all messages of a
   conversation that hold a text themselves, the earliest is its original.
3. A message replies to the earlier message that its shallowest matched quotes stand
   for; of several the one with most characters matched, then the latest.  Messages
   without matched quotes begin a thread of their own.
4. The root of every reply chain comes from pointer jumping (each step doubles the
   distance).  Positions are numbered by (root, turn) within the conversation, so a reply
   always follows what it answers.

Every message stays a row of its own, so a conversation with a third of all rows is
spread over tasks.  Edge cases: rows that are equal in conv_id, turn, role and text are
one message; a null text is empty; null turns come last; null conv_ids form one
conversation; a quote without an original links nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import gapless, table
from affinity.session import materialize

LAST = 2 ** 63 - 1
MARKS = r"^(?:\\s*(?:>|&gt;))+"
ANNOUNCES = r"(?i)\\b(wrote|writes|schrieb|escribi\\u00f3|\\u00e9crit)\\s*:\\s*$"


def _normal(col: str) -> str:
    return rf"trim(regexp_replace(lower({col}), '[^\\p{{L}}\\p{{N}}]+', ' '))"


def parsed(rows: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, msg, at, own, passages, content, n_quotes."""
    m = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).distinct()
    m = (m.withColumn("at", F.coalesce("turn", F.lit(LAST)))
          .withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")))
          .withColumn("msg", F.expr("md5(concat(conv, '|', coalesce(cast(turn as string), '-'), '|', "
                                    "coalesce(role, '-'), '|', coalesce(text, '')))"))
          .withColumn("raw", F.expr(r"split(coalesce(text, ''), '\\r?\\n')"))
          .withColumn("level", F.expr(
              rf"transform(raw, x -> length(regexp_replace(replace(regexp_extract(x, '{MARKS}', 0), '&gt;', '>'), "
              r"'[^>]', '')))"))
          .withColumn("line", F.expr(rf"transform(raw, x -> trim(regexp_replace(x, '{MARKS}', '')))"))
          .withColumn("keep", F.expr(
              rf"transform(raw, (x, i) -> level[i] = 0 AND NOT (i + 1 < size(raw) AND level[i + 1] > 0 "
              rf"AND x rlike '{ANNOUNCES}'))"))
          .withColumn("begin", F.expr(
              "filter(sequence(0, size(raw) - 1), i -> i = 0 OR level[i] <> level[i - 1])"))
          .withColumn("passages", F.expr(
              "transform(begin, (b, k) -> named_struct('level', level[b], 'lines', slice(line, b + 1, "
              "(if(k + 1 < size(begin), begin[k + 1], size(raw))) - b)))"))
          .withColumn("content", F.expr(
              "trim(array_join(transform(filter(sequence(0, size(raw) - 1), i -> keep[i]), i -> raw[i]), '\n'))"))
          .withColumn("n_quotes", F.expr("cast(size(filter(passages, p -> p.level > 0)) as long)")))
    return m.select("conv_id", "conv", "turn", "role", "msg", "at", "passages", "content", "n_quotes")


def _units(messages: DataFrame, quoted: bool) -> DataFrame:
    """(conv, msg, at, level, unit, size): hashed passages and lines, each once a message."""
    p = (messages.select("conv", "msg", "at", F.explode("passages").alias("p"))
                 .where("p.level > 0" if quoted else "p.level = 0"))
    units = p.select("conv", "msg", "at", F.col("p.level").alias("level"), F.explode(F.expr(
        "array_union(p.lines, array(array_join(p.lines, ' ')))")).alias("text"))
    units = units.withColumn("text", F.expr(_normal("text"))).where("text <> ''")
    return units.select("conv", "msg", "at", "level", F.md5("text").alias("unit"),
                        F.char_length("text").cast("long").alias("size")).distinct()


def link_replies(messages: DataFrame) -> DataFrame:
    """(msg, parent, parent_at): the message that each linked message answers."""
    quotes = materialize(_units(messages, True), "op2-quotes")
    wanted = quotes.select("conv", "unit").distinct()
    first = (_units(messages, False).join(wanted, ["conv", "unit"], "left_semi")
             .groupBy("conv", "unit").agg(F.min(F.struct("at", "msg")).alias("origin")))
    hits = (quotes.join(first, ["conv", "unit"]).where("origin.at < at")
                  .groupBy("msg", "level", F.col("origin.msg").alias("parent"), F.col("origin.at").alias("parent_at"))
                  .agg(F.sum("size").alias("weight")))
    best = hits.groupBy("msg").agg(F.max(F.struct(
        (-F.col("level")).alias("l"), "weight", "parent_at", "parent")).alias("b"))
    return best.select("msg", F.col("b.parent").alias("parent"), F.col("b.parent_at").alias("parent_at"))


def reply_order(rows: DataFrame) -> DataFrame:
    """conv_id, position, turn, role, content, reply_to, thread_turn, n_quotes, formatted."""
    messages = materialize(parsed(rows), "op2-messages")
    links = materialize(link_replies(messages), "op2-links")
    jump = links.select("msg", F.col("parent").alias("root"), F.col("parent_at").alias("root_at"))
    step = 0
    while True:                                        # each step doubles the distance walked
        up = jump.select(F.col("msg").alias("_m"), F.col("root").alias("_r"), F.col("root_at").alias("_a"))
        more = jump.join(up, F.col("root") == F.col("_m"), "left")
        moved = materialize(more.select("msg", F.coalesce("_r", "root").alias("root"),
                                        F.coalesce("_a", "root_at").alias("root_at"),
                                        F.col("_r").isNotNull().alias("moved")), f"op2-jump{step}")
        jump, step = moved.drop("moved"), step + 1
        if moved.where("moved").isEmpty():
            break
    whole = (messages.join(links, "msg", "left").join(jump, "msg", "left")
             .select("conv_id", "turn", "role", "content", "n_quotes", "at", "msg",
                     F.nullif(F.col("parent_at"), F.lit(LAST)).alias("reply_to"),
                     F.coalesce("root_at", "at").alias("root_at"), F.coalesce("root", "msg").alias("root")))
    placed = gapless(whole, ["conv_id"], ["root_at", "root", "at", "msg"], "position", "op2-order")
    return placed.select(
        "conv_id", "position", "turn", "role", "content", "reply_to", F.nullif(F.col("root_at"), F.lit(LAST)).alias("thread_turn"),
        "n_quotes", F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "content", F.lit("<|end|>")).alias("formatted"))


def query(spark, sf_dir: str) -> DataFrame:
    return reply_order(table(spark, sf_dir, "conversations"))


_LEVEL = r"length(regexp_replace(replace(regexp_extract(raw[i], '^(?:\s*(?:>|&gt;))+'), '&gt;', '>'), '[^>]', '', 'g'))"
_NORMAL = r"trim(regexp_replace(lower(x), '[^\p{L}\p{N}]+', ' ', 'g'))"
SQL = rf"""
WITH RECURSIVE m0 AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
m AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), '-') AS conv, coalesce(turn, {LAST}) AS ord,
         md5(coalesce(CAST(conv_id AS VARCHAR), '-') || '|' || coalesce(CAST(turn AS VARCHAR), '-') || '|' ||
             coalesce(role, '-') || '|' || coalesce(text, '')) AS msg,
         string_split_regex(coalesce(text, ''), '\r?\n') AS raw FROM m0),
l0 AS (SELECT conv, msg, ord, raw, unnest(range(1, len(raw) + 1)) AS i FROM m),
l1 AS (SELECT conv, msg, ord, i, raw[i] AS raw_line, {_LEVEL} AS level,
              trim(regexp_replace(raw[i], '^(?:\s*(?:>|&gt;))+', '')) AS line FROM l0),
l2 AS (SELECT *, lag(level) OVER w AS before, lead(level) OVER w AS after FROM l1
       WINDOW w AS (PARTITION BY msg ORDER BY i)),
l3 AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> level THEN 1 ELSE 0 END) OVER (PARTITION BY msg ORDER BY i) AS p FROM l2),
body AS (
  SELECT msg, trim(coalesce(string_agg(raw_line, chr(10) ORDER BY i) FILTER (
           level = 0 AND NOT (coalesce(after, 0) > 0 AND
             regexp_matches(raw_line, '(?i)\b(wrote|writes|schrieb|escribió|écrit)\s*:\s*$'))), '')) AS content,
         count(DISTINCT p) FILTER (level > 0) AS n_quotes
  FROM l3 GROUP BY msg),
pass AS (SELECT conv, msg, ord, level, p, string_agg(line, ' ' ORDER BY i) AS x FROM l3 GROUP BY ALL),
units AS (
  SELECT DISTINCT conv, msg, ord, level, md5({_NORMAL}) AS unit, length({_NORMAL}) AS size
  FROM (SELECT conv, msg, ord, level, x FROM pass UNION ALL SELECT conv, msg, ord, level, line FROM l3) WHERE {_NORMAL} <> ''),
origin AS (SELECT conv, unit, min(ord) AS o_ord, arg_min(msg, (ord, msg)) AS o_msg FROM units WHERE level = 0 GROUP BY ALL),
hits AS (SELECT q.msg, q.level, o.o_msg AS parent, o.o_ord AS parent_at, sum(q.size) AS weight
         FROM units q JOIN origin o USING (conv, unit) WHERE q.level > 0 AND o.o_ord < q.ord GROUP BY ALL),
link AS (SELECT msg, parent, parent_at FROM (SELECT *, row_number() OVER (
           PARTITION BY msg ORDER BY level, weight DESC, parent_at DESC, parent DESC) AS k FROM hits) WHERE k = 1),
walk AS (
  SELECT msg, parent AS root, parent_at AS root_at, 1 AS n FROM link
  UNION ALL SELECT w.msg, l.parent, l.parent_at, n + 1 FROM walk w JOIN link l ON l.msg = w.root),
root AS (SELECT msg, arg_max(root, n) AS root, arg_max(root_at, n) AS root_at FROM walk GROUP BY msg)
SELECT m.conv_id, row_number() OVER (PARTITION BY m.conv ORDER BY coalesce(r.root_at, m.ord), coalesce(r.root, m.msg), m.ord, m.msg) - 1 AS position,
       m.turn, m.role, b.content, nullif(l.parent_at, {LAST}) AS reply_to, nullif(coalesce(r.root_at, m.ord), {LAST}) AS thread_turn,
       b.n_quotes, '<|' || coalesce(m.role, '') || '|>' || chr(10) || b.content || '<|end|>' AS formatted
FROM m JOIN body b USING (msg) LEFT JOIN link l USING (msg) LEFT JOIN root r USING (msg)
"""
