"""Corpus pipeline over ``documents``: quality, toxicity, near copies, test leaks, pieces.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; ``run`` writes each result as Parquet in the shared checkpoint
folder and rereads it.  Stages 1 to 4 keep the columns of ``documents`` and drop rows;
the last returns the piece ids of what is left.

SQL cannot express the stages (trained scores, consistent sampling), so there is no
oracle; the tests compare the decisions with brute force on small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm import decontam, neardup, pieces, quality, toxicity
from affinity.llm.common import table
from affinity.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_QUALITY, MAX_TOXIC = 0.3, 0.7


def keep_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier does not reject (score >= MIN_QUALITY)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_column(docs.select(*COLUMNS), model, "_score")
    return scored.where(F.col("_score") >= MIN_QUALITY).select(*COLUMNS)


def keep_civil(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not reject (score < MAX_TOXIC)."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_column(docs.select(*COLUMNS), model, "_score")
    return scored.where(F.col("_score") < MAX_TOXIC).select(*COLUMNS)


def keep_one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the least id (a null id
    comes last), of several texts of that id the one with the least hash.

    Repeated rows of it collapse to one."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    best = (neardup.classed_rows(docs).groupBy("root").agg(F.min(row).alias("r"))
                   .select(F.col("r.doc_id").alias("_id"), F.col("r.text_hash").alias("_hash")))
    kept = docs.select(*COLUMNS).withColumn("_text", F.xxhash64("text")).join(
        best, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_text"]).drop("_text")


def keep_clean(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item: each row goes by its own text, also where
    rows share an id or have none."""
    rows = docs.select(*COLUMNS).withColumn("_row", F.xxhash64("text"))
    leaks = (decontam.find_leaks(rows.select(F.col("_row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
                     .select(F.col("doc_id").alias("_row")).distinct())
    return rows.join(leaks, "_row", "left_anti").select(*COLUMNS)


def encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids and round_trip of every document left."""
    return pieces.encode_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", keep_civil),
    ("near duplicates", keep_one_of_each),
    ("benchmark decontamination", keep_clean),
    ("sentencepiece", encode),
]
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
