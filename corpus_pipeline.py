"""The training-data pipeline over ``documents``: five stages, each on what its predecessor kept.

Every stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is stored as Parquet and read again as the next stage's ``docs``.  All
but the last return the columns of ``docs``.  Extra columns of ``docs`` pass through;
null ids and texts, repeated rows and empty tables are treated as each operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civic_mart.llm import packing, quality, secret_scan, simhash
from civic_mart.llm import toxicity as tox
from civic_mart.llm.common import materialize, table

# no SQL: network training, near-duplicate components and tokenizers have none
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = tox.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(tox.score(F.col("text"), model) < tox.THRESHOLD)


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Column names that ``docs`` does not have, whatever its extra columns are called."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name = "_" + name
        out.append(name)
    return out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their boilerplate lines.  Rows are told
    apart by id, text and host; only rows with something to drop are looked up."""
    i, t, h, gone, keep = fresh(docs, "_id", "_text", "_host", "_gone", "_keep")
    told = quality.quality_rules(docs).where(~F.col("kept") | (F.size("boilerplate") > 0)).select(
        F.col("doc_id").alias(i), F.col("text_key").alias(t), F.col("host").alias(h),
        F.col("kept").alias(keep), F.array_sort("boilerplate").alias(gone)).distinct()
    j = docs.join(told, F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(t))
                  & (F.coalesce(F.col("source").cast("string"), F.lit("")) == F.col(h)), "left").where(
        F.coalesce(F.col(keep), F.lit(True)))
    return sized(docs, j.withColumn("text", quality.without_lines(F.col("text"), F.col(gone))))


def sized(docs: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of ``docs`` from rows with a changed text, ``n_chars`` (if there) counted anew."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id (full repeats of it once)."""
    i, t, n = fresh(docs, "_id", "_text", "_rows")
    keepers = simhash.simhash_near_dups(docs).where("keeper").groupBy(
        F.col("doc_id").alias(i), F.col("text_key").alias(t)).agg(F.count(F.lit(1)).alias(n))
    kept = docs.join(keepers, F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(t)))
    # only keys that repeat are dealt again
    once, repeated = kept.where(F.col(n) == 1), kept.where(F.col(n) > 1).dropDuplicates([i, t])
    return once.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind in brackets."""
    return sized(docs, docs.withColumn("text", secret_scan.redact(F.col("text"))))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxicity), ("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup),
          ("secret_scans", secrets), ("best_fit_packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
