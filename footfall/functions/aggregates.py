"""Aggregate helpers.

``group_concat_distinct`` replaces the reference's UDAF: an exact set of
distinct strings, sorted ascending and joined with a separator. It is a
native ``collect_set`` so Spark keeps the partial (map-side) / final split;
the per-group buffer is bounded by the number of distinct values (cities),
not by the number of rows, so a hot group does not grow it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def group_concat_distinct(col, sep: str = ",") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def count_if(cond: Column) -> Column:
    """Number of rows where ``cond`` holds (NULL counts as false)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))
