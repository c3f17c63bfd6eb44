"""Keys, references, value rules and text rules of many tables in one pass.

``integrity`` checks one rule at a time.  Here every table is read once: a row gives one
entry for each unique key it holds, one for each value it refers to and one for each
row rule it breaks.  All entries of all tables go through one grouped count, so that a
parent key and the values that refer to it meet in one shuffle; a value that a third of all rows
hold is one partial count a task.  A load counts broken row rules while it writes
(``metrics``) and is published only if nothing is broken (``enforce``).

SQL semantics: a check passes when its condition is NULL, a reference when its value is.
NULL keys equal each other in a unique rule.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.operators.integrity import (VARCHAR_MAX, birthday_in_range, gender_in_range,
                                          grade_in_range)
from affinity.session import materialize, release

REPORT = "kind string, tbl string, rule string, key string, n long"
UNIQUE, REFERENCE, CHECK, NOT_NULL, TOO_LONG = "unique", "reference", "check", "not_null", "too_long"
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NEVER = 2 ** 62


@dataclass(frozen=True)
class Rules:
    """What the rows of one table must obey.

    ``key`` names a row in the report.  ``unique``: rule name to columns.  ``refs``: (column, parent
    table, parent column).  ``checks``: rule name to a function that gives the condition.
    ``texts`` hold at most 255 characters, ``not_null`` no NULL."""
    key: tuple[str, ...]
    unique: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    refs: tuple[tuple[str, str, str], ...] = ()
    checks: Mapping[str, Callable[[], F.Column]] = field(default_factory=dict)
    texts: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()

    def row_rules(self) -> list[tuple[str, str, F.Column]]:
        """(kind, rule, whether a row breaks it), never NULL."""
        return ([(CHECK, name, ~F.coalesce(cond(), F.lit(True))) for name, cond in self.checks.items()]
                + [(NOT_NULL, c, F.col(c).isNull()) for c in self.not_null]
                + [(TOO_LONG, c, F.coalesce(F.length(c) > VARCHAR_MAX, F.lit(False))) for c in self.texts])


def _key(*cols: str) -> dict:
    return {"key": cols, "unique": {"primary key": cols}, "not_null": cols}


# The constraints that the eleven loaded tables declare.
LOAD_RULES = {
    "website": Rules(**_key("web_id"), texts=("web_id",)),
    "movie": Rules(**_key("mov_id"), texts=("name",)),
    "link": Rules(**_key("mov_id", "web_id"), texts=("web_id",),
                  refs=(("mov_id", "movie", "mov_id"), ("web_id", "website", "web_id"))),
    "genre": Rules(**_key("genre_id"), texts=("name",)),
    "user_most_like": Rules(key=("user_id",), unique={"primary key": ("user_id",), "username": ("username",)},
                            not_null=("user_id", "username"), texts=("name",),
                            refs=(("genre_id", "genre", "genre_id"),), checks={"birthday_range": birthday_in_range}),
    "rate": Rules(**_key("mov_id", "user_id"), checks={"grade_range": grade_in_range},
                  refs=(("mov_id", "movie", "mov_id"), ("user_id", "user_most_like", "user_id"))),
    "belong_to": Rules(**_key("mov_id", "genre_id"),
                       refs=(("mov_id", "movie", "mov_id"), ("genre_id", "genre", "genre_id"))),
    "director": Rules(**_key("director_id"), texts=("name",), checks={"gender_range": gender_in_range}),
    "mov_cast": Rules(**_key("cast_id"), texts=("name",)),
    "direct": Rules(**_key("mov_id", "director_id"),
                    refs=(("mov_id", "movie", "mov_id"), ("director_id", "director", "director_id"))),
    "act": Rules(**_key("mov_id", "cast_id"),
                 refs=(("mov_id", "movie", "mov_id"), ("cast_id", "mov_cast", "cast_id"))),
}


@dataclass
class _Group:
    """One kind of entries that are counted together: a key with all that refers to it, or a row rule."""
    kind: str
    tbl: str
    rule: str
    most: int                                   # a value held by more of its own rows breaks the rule
    refs: list[tuple[str, str]] = field(default_factory=list)        # (child table, column)


def _entry(group: int, slot: int, df: DataFrame, cols) -> F.Column:
    """Integers travel as one long, all other keys as the texts of their columns."""
    whole = len(cols) == 1 and isinstance(df.schema[cols[0]].dataType, INTEGRAL)
    number = F.col(cols[0]).cast("long") if whole else F.lit(None).cast("long")
    text = F.lit(None).cast("array<string>") if whole else F.array(*[F.col(c).cast("string") for c in cols])
    return F.struct(F.lit(group).alias("g"), F.lit(slot).alias("s"), number.alias("k"), text.alias("t"))


def _same_type(child: T.DataType, parent: T.DataType) -> bool:
    return child == parent or (isinstance(child, INTEGRAL) and isinstance(parent, INTEGRAL))


def audit(spark: SparkSession, tables: Mapping[str, DataFrame], rules: Mapping[str, Rules],
          row_rules: set[str] | None = None) -> DataFrame:
    """Every broken rule: (kind, tbl, rule, key, n).

    ``n`` counts rows: those that share a unique key, that hold a value without a parent, or
    that break a row rule under the same row key.  ``row_rules`` names the tables whose row
    rules are looked at (all, if not given).  A parent table must be among ``tables`` and the
    types on both sides of a reference must agree."""
    groups: list[_Group] = []
    parents: dict[tuple, int] = {}
    entries: dict[str, list[F.Column]] = {t: [] for t in tables}

    def add(group: _Group) -> int:
        groups.append(group)
        return len(groups) - 1

    for t, df in tables.items():
        if t not in rules:
            continue
        for name, cols in rules[t].unique.items():
            g = parents[t, tuple(cols)] = add(_Group(UNIQUE, t, name, 1))
            entries[t].append(_entry(g, 0, df, cols))
        if row_rules is None or t in row_rules:
            for kind, name, broken in rules[t].row_rules():
                g = add(_Group(kind, t, name, 0))
                entries[t].append(F.when(broken, _entry(g, 0, df, rules[t].key)))
    for t, df in tables.items():
        for col, parent, pcol in rules[t].refs if t in rules else ():
            if not _same_type(df.schema[col].dataType, tables[parent].schema[pcol].dataType):
                raise TypeError(f"{t}.{col} and {parent}.{pcol} have different types")
            if (parent, (pcol,)) not in parents:
                g = parents[parent, (pcol,)] = add(_Group(UNIQUE, parent, pcol, NEVER))
                entries[parent].append(_entry(g, 0, tables[parent], (pcol,)))
            g = parents[parent, (pcol,)]
            groups[g].refs.append((t, col))
            entries[t].append(F.when(F.col(col).isNotNull(), _entry(g, len(groups[g].refs), df, (col,))))
    rows = None
    for t, parts in entries.items():
        if parts:
            # Outer: no size filter is inferred below it, which would compute the entries twice.
            e = tables[t].select(F.explode_outer(F.array(*parts)).alias("e")).where("e is not null").select("e.*")
            rows = e if rows is None else rows.unionByName(e)
    if rows is None:
        return spark.createDataFrame([], REPORT)
    slots = max(len(g.refs) for g in groups)
    counts = rows.groupBy("g", "k", "t").agg(*[F.count_if(F.col("s") == i).alias(f"n{i}") for i in range(slots + 1)])

    def of(values, kind="string"):
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("g"))

    found = [F.when(F.col("n0") > of([g.most for g in groups], "long"),
                    F.struct(of([g.kind for g in groups]).alias("kind"), of([g.tbl for g in groups]).alias("tbl"),
                             of([g.rule for g in groups]).alias("rule"), F.col("n0").alias("n")))]
    for i in range(slots):
        ref = [g.refs[i] if i < len(g.refs) else (None, None) for g in groups]
        found.append(F.when((F.col("n0") == 0) & (F.col(f"n{i + 1}") > 0),
                            F.struct(F.lit(REFERENCE).alias("kind"), of([r[0] for r in ref]).alias("tbl"),
                                     of([r[1] for r in ref]).alias("rule"), F.col(f"n{i + 1}").alias("n"))))
    key = F.coalesce(F.col("k").cast("string"), F.concat_ws("|", "t"))
    return (counts.select(key.alias("key"), F.explode_outer(F.array(*found)).alias("f")).where("f is not null")
                  .select("f.kind", "f.tbl", "f.rule", "key", "f.n"))


# Loads --------------------------------------------------------------------

def metrics(rules: Rules) -> list[F.Column]:
    """Aggregates for ``Load.write``: how many rows break each row rule, counted as they are written."""
    return [F.count_if(broken).alias(f"{kind} {name}") for kind, name, broken in rules.row_rules()]


class BrokenRules(ValueError):
    """A load that was not published; ``counts`` is {(kind, table, rule): rows}."""

    def __init__(self, counts: dict[tuple[str, str, str], int]):
        self.counts = counts
        super().__init__("; ".join(f"{t}: {k} {r} broken by {n} rows" for (k, t, r), n in sorted(counts.items())))


def load_report(load, rules: Mapping[str, Rules] = LOAD_RULES) -> DataFrame:
    """Rules that a staged load would break, with the tables it does not replace.

    Only tables whose counts while written were not zero (or are not known) have their row
    rules looked at again; for the others the scan reads key columns only."""
    kept = load.catalog.manifest(load.based_on)
    tables = {t: load.read(t) for t in rules if t in load.staged or t in kept}
    known = {t: Rules(r.key, r.unique, tuple(x for x in r.refs if x[1] in tables), r.checks, r.texts, r.not_null)
             for t, r in rules.items() if t in tables}
    again = {t for t in load.staged if t in known and (not load.metrics.get(t) or any(load.metrics[t].values()))}
    return audit(load.catalog.spark, tables, known, again)


def enforce(load, rules: Mapping[str, Rules] = LOAD_RULES) -> None:
    """Raise ``BrokenRules`` if the staged load breaks a rule: within ``with catalog.load()`` it is undone."""
    report = materialize(load_report(load, rules), "audit")
    # One row a rule.
    counts = {(r["kind"], r["tbl"], r["rule"]): r["n"] for r in report.groupBy("kind", "tbl", "rule").agg(F.sum("n").alias("n")).collect()}
    release(report)
    if counts:
        raise BrokenRules(counts)
