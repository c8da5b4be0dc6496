"""Five stages from raw documents to packed training batches.

Each stage takes the documents that the one before has kept and returns a
DataFrame; ``run`` writes it as Parquet into the shared folder and reads it again
as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import line_chunks, packing, quality_rules, setsketch, toxicity
from footfall.llm.tables import packed, run_folder, stored, table, unpacked


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"), run_folder(spark, "quality"))
    return quality_rules.keep_good(docs, rules)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), run_folder(spark, "toxic"))
    scored = toxicity.score(packed(docs), model)
    return unpacked(scored, docs.schema, F.col("score") < 0.5)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages of lines; those of which nothing is left go.
    n_chars follows the text."""
    out = line_chunks.without_repeats(docs, run_folder(spark, "lines"))
    columns = [F.col("text") if c == "text" else
               F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
               F.col("row")[c].alias(c) for c in docs.columns]
    return out.where("removed = 0 or trim(text) <> ''").select(*columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one of smallest doc_id. Rows are
    numbered, so that those that share a doc_id are told apart; without one, all stay."""
    folder = run_folder(spark, "near")
    rows = stored(packed(docs, no=F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())),
                  f"{folder}/rows")
    groups = setsketch.near_duplicates(
        rows.select(F.col("no").alias("doc_id"), F.col("row.text").alias("text")), folder, width=5)
    kept = (groups.where("doc_id is not null").select(F.col("doc_id").alias("no"), "component_id")
            .join(rows.select("no", F.col("row.doc_id").alias("id")), "no")
            .groupBy("component_id").agg(F.min(F.struct("id", "no")).alias("best")).select("best.no"))
    return rows.join(kept, "no", "left_semi").unionByName(rows.where("no is null").select("no", "row")) \
        .select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of each document."""
    return packing.pack(docs, run_folder(spark, "pack"))


STAGES = [("quality", quality), ("toxicity", toxic), ("lines", lines), ("near", near), ("packing", pack)]

# learned rules, trained weights and dynamic programming are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = run_folder(spark, "pipeline")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
