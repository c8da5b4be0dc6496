"""Wide-column cell export (J3).

The reference writes ``(rowkey, family:qualifier, value)`` cells to a
wide-column store: rowkey = UTF-8 bytes of the key, value = the count as an
8-byte big-endian long. Here the cells are a DataFrame
``(row_key BINARY, family STRING, qualifier STRING, value BINARY)`` written
as parquet, range-partitioned and sorted by row key - the layout a bulk
loader for such a store expects, produced without any driver collect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELL_COLUMNS = ["row_key", "family", "qualifier", "value"]


def long_be_bytes(c) -> Column:
    """8-byte big-endian two's complement of a BIGINT (15 -> 00..0F, -1 -> FF..FF)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unhex(F.lpad(F.hex(c.cast("bigint")), 16, "0"))


def be_bytes_long(c) -> Column:
    """Inverse of ``long_be_bytes``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.conv(F.hex(c), 16, -10).cast("bigint")   # negative base: signed


def to_cells(df: DataFrame, key_col: str, value_col: str,
             family: str = "info", qualifier: str = "count") -> DataFrame:
    return df.select(F.encode(F.col(key_col).cast("string"), "UTF-8").alias("row_key"),
                     F.lit(family).alias("family"), F.lit(qualifier).alias("qualifier"),
                     long_be_bytes(value_col).alias("value"))


def write_cells(cells: DataFrame, path: str, num_partitions: int | None = None) -> None:
    """Range-partition by row key and sort inside each file (region-ordered).

    Without ``num_partitions`` AQE sizes the ranges from the data (a column
    repartition may be coalesced), so the file count follows the volume.
    """
    ranged = (cells.repartitionByRange(num_partitions, "row_key") if num_partitions
              else cells.repartitionByRange("row_key"))
    ranged.sortWithinPartitions("row_key").write.mode("overwrite").parquet(path)


def word_counts(df: DataFrame, word_col: str) -> DataFrame:
    return df.groupBy(F.col(word_col).alias("word")).agg(F.count(F.lit(1)).alias("count"))


def prefix_end(prefix: bytes) -> bytes | None:
    """The smallest key above every key that begins with the prefix; None if there is none."""
    cut = prefix.rstrip(b"\xff")
    return cut[:-1] + bytes([cut[-1] + 1]) if cut else None


def scan_cells(cells: DataFrame, start: bytes | None = None, stop: bytes | None = None,
               prefix: bytes | None = None) -> DataFrame:
    """Cells with start <= row key < stop that begin with the prefix, as a key-ordered store
    would scan them; an absent bound is open. All are plain comparisons on the row key, so
    they reach the parquet reader: of files in row-key order it opens the row groups whose
    key range overlaps. Null row keys are in no scan with a bound."""
    key = F.col("row_key")
    if prefix is not None:
        cells = scan_cells(cells, prefix or None, prefix_end(prefix))
    if start is not None:
        cells = cells.where(key >= F.lit(bytearray(start)))
    if stop is not None:
        cells = cells.where(key < F.lit(bytearray(stop)))
    return cells


def get_cells(cells: DataFrame, row_key: bytes) -> DataFrame:
    """The cells of one row."""
    return cells.where(F.col("row_key") == F.lit(bytearray(row_key)))
