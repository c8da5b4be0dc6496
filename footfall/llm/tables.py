"""Reading the given tables and cutting lineage through the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from footfall.session import new_run_dir

# word and separator classes shared by several operators
WORD = r"[^\x20\x09-\x0D]"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# rows that Spark hands to Python at once; its default of 10,000 whole texts, held in the
# JVM and in every worker, is most of an executor's memory
BATCH_ROWS = 1_000


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` for one run's tables. Larger Arrow batches
    of the session are set to ``BATCH_ROWS``."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
    return new_run_dir(spark, name)


def stored(df: DataFrame, path: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: later
    steps start from files that survive the loss of any executor. ``codec`` replaces the
    session's compression."""
    schema = df.schema
    df.write.mode("overwrite").parquet(path, compression=codec)
    return df.sparkSession.read.schema(schema).parquet(path)


def packed(df: DataFrame, **columns) -> DataFrame:
    """``df`` as one struct column ``row`` beside computed columns, so that no
    column of the input can clash with a computed one."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, schema, keep) -> DataFrame:
    """The rows of a packed table for which ``keep`` holds. ``inline`` is a
    generator, so the condition is not pushed below the columns it is computed
    from (where each of them would be computed again)."""
    out = df.select(F.inline(F.when(keep, F.array("row"))))
    return out.toDF(*schema.names)


def extended(schema: StructType, name: str, kind: str) -> StructType:
    """A copy of ``schema`` with one more column."""
    return StructType([*schema.fields]).add(name, kind)
