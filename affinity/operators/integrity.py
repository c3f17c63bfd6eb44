"""Integrity checks re-aimed from the relational constraints.

Each check returns the violating rows (never raises), tagged with table and
rule.  SQL semantics are kept: a CHECK passes when its condition is NULL, a
foreign key passes when the referencing value is NULL.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.session import materialize

VARCHAR_MAX = 255                              # fixed value: varchar(255)
BIRTHDAY_MIN = _dt.date(1900, 1, 1)            # fixed value: CHECK birthday > 1900-01-01


def _key_text(cols) -> F.Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in cols])


def pk_violations(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Keys that occur more than once: (tbl, key, n)."""
    out = None
    for name, (df, keys) in tables.items():
        v = (df.groupBy(*keys).count().where(F.col("count") > 1)
               .select(F.lit(name).alias("tbl"), _key_text(keys).alias("key"), F.col("count").alias("n")))
        out = v if out is None else out.unionByName(v)
    return out


def fk_violations(refs: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Referencing values with no parent: (tbl, col, value, n).

    refs: (child name, child df, child column, parent df, parent column).  A frame that
    several references use is computed once, for all columns they need of it.
    """
    needed: dict[int, list] = {}
    for _, child, col, parent, pcol in refs:
        needed.setdefault(id(child), [child, []])[1].append(col)
        needed.setdefault(id(parent), [parent, []])[1].append(pcol)
    once = {key: materialize(df.select(*dict.fromkeys(cols)), "fk-input") if len(cols) > 1 else df
            for key, (df, cols) in needed.items()}
    out = None
    for name, child, col, parent, pcol in refs:
        child, parent = once[id(child)], once[id(parent)]
        # Distinct child values first: a hot value is one row per map task in the join.
        c = child.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).count()
        p = parent.select(F.col(pcol).alias("_v"))
        v = (c.join(p, "_v", "left_anti")
              .select(F.lit(name).alias("tbl"), F.lit(col).alias("col"),
                      F.col("_v").cast("string").alias("value"), F.col("count").alias("n")))
        out = v if out is None else out.unionByName(v)
    return out


def check_violations(checks: list[tuple[str, str, DataFrame, list[str], F.Column]]) -> DataFrame:
    """Rows whose CHECK condition is FALSE (NULL passes): (tbl, rule, key)."""
    out = None
    for name, rule, df, keys, cond in checks:
        v = df.where(~F.coalesce(cond, F.lit(True))).select(
            F.lit(name).alias("tbl"), F.lit(rule).alias("rule"), _key_text(keys).alias("key"))
        out = v if out is None else out.unionByName(v)
    return out


def domain_violations(columns: list[tuple[str, DataFrame, list[str], str, bool]]) -> DataFrame:
    """C4: NOT NULL and varchar(255) length violations: (tbl, col, rule, key)."""
    out = None
    for name, df, keys, col, not_null in columns:
        rule = (F.when(F.col(col).isNull() & F.lit(not_null), "not_null")
                 .when(F.length(F.col(col)) > VARCHAR_MAX, "too_long"))
        v = (df.withColumn("_rule", rule).where(F.col("_rule").isNotNull())
               .select(F.lit(name).alias("tbl"), F.lit(col).alias("col"), F.col("_rule").alias("rule"),
                       _key_text(keys).alias("key")))
        out = v if out is None else out.unionByName(v)
    return out


def grade_in_range(col: str = "grade") -> F.Column:
    return (F.col(col) >= 0) & (F.col(col) <= 5)


def gender_in_range(col: str = "gender") -> F.Column:
    return F.col(col).isin(0, 1, 2)


def birthday_in_range(col: str = "birthday") -> F.Column:
    return (F.col(col) > F.lit(BIRTHDAY_MIN)) & (F.col(col) < F.current_date())
