"""Packing: length buckets of least padding, token-budget batches inside them.

The global histogram of document lengths (in words) is gathered in Spark on a
bounded grid: every length up to ``EXACT`` has a bin of its own, longer ones
share bins of 1/256 relative width. A bin counts with the longest document that it
has, so no bucket is padded beyond its longest document. Dynamic programming over
the bins finds the ``buckets`` boundaries that make padded tokens fewest, of those
that part no bin. Inside a bucket of
padded length L, a batch holds ``max(1, budget // L)`` documents.

Positions inside a bucket are counted without bringing a bucket into one task:
a bucket is cut into slices by a hash of doc_id, each slice of about
``SLICE`` rows numbers its rows, and offsets of the slices come from their counts.

Defined results: null or empty text has length 0 and goes to the first bucket;
repeated doc_ids each take a place of their own; an empty table gives no rows.
A text longer than the budget is a batch of its own.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.tables import SPACES, stored

EXACT = 4096               # lengths up to here have exact bins
BUCKETS = 16
TOKEN_BUDGET = 65_536
SLICE = 20_000


def lengths(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens (words of the whole text), bin (largest length of its bin)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n = docs.select("doc_id", F.size(F.array_remove(F.split(text, SPACES), "")).alias("n_tokens"))
    width = F.pow(F.lit(2), F.floor(F.log2(F.greatest("n_tokens", F.lit(1)))) - 8)
    up = (F.ceil(F.col("n_tokens") / width) * width).cast("int")
    return n.withColumn("bin", F.when(F.col("n_tokens") <= EXACT, F.col("n_tokens")).otherwise(up))


def boundaries(bins: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Upper lengths of the buckets that minimise ``sum(count * (upper - bin))``
    for ``(bin, count)`` rows; ties go to the smaller boundaries."""
    bins = sorted(bins)
    if not bins:
        return []
    size = np.array([b for b, _ in bins], dtype=np.float64)
    count = np.array([c for _, c in bins], dtype=np.float64)
    n, k = len(bins), min(buckets, len(bins))
    ahead = np.concatenate([[0.0], np.cumsum(count)])       # documents before bin i
    best = size * ahead[1:]                                # one bucket: bins 0..j
    cut = np.zeros((k, n), dtype=np.int64)
    for b in range(1, k):
        after = np.full(n, np.inf)
        for j in range(b, n):
            # the last bucket holds bins i..j and is padded to size[j]
            cost = best[b - 1:j] + size[j] * (ahead[j + 1] - ahead[b:j + 1])
            i = int(np.argmin(cost))
            after[j], cut[b, j] = cost[i], i + b
        best = after
    out, j = [], n - 1
    for b in range(k - 1, -1, -1):
        out.append(int(size[j]))
        j = int(cut[b, j]) - 1
    return out[::-1]


def pack(docs: DataFrame, folder: str, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET,
         slice_rows: int = SLICE) -> DataFrame:
    """One row for each document: doc_id, n_tokens, bucket, padded_length,
    batch (number inside the bucket), place (inside the batch)."""
    seen = stored(lengths(docs).withColumn("u", F.monotonically_increasing_id()),
                  f"{folder}/lengths")
    bins = [(r.longest, r.n) for r in seen.groupBy("bin").agg(
        F.max("n_tokens").alias("longest"), F.count("*").alias("n")).collect()]
    upper = boundaries(bins, buckets)
    bucket, padded = F.lit(0), F.lit(upper[0] if upper else 0)
    for i, low in enumerate(upper[:-1]):
        bucket = F.when(F.col("n_tokens") > low, i + 1).otherwise(bucket)
        padded = F.when(F.col("n_tokens") > low, upper[i + 1]).otherwise(padded)
    rows = sum(n for _, n in bins)
    slices = max(1, -(-rows // slice_rows))
    # dealt by the stored row number as well, so that rows of one doc_id, or without one, part
    dealt = seen.select(
        "doc_id", "n_tokens", bucket.alias("bucket"), padded.alias("padded_length"), "u",
        F.xxhash64("doc_id", "u").alias("h")).withColumn(
        "slice", F.pmod(F.xxhash64(F.lit("slice"), "h"), F.lit(slices)))
    inside = Window.partitionBy("bucket", "slice").orderBy("h", "doc_id", "n_tokens", "u")
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("bucket", "slice").agg(F.count("*").alias("n"))
               .select("bucket", "slice",
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    at = F.col("start") + F.col("rn") - 1
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("padded_length", F.lit(1))))
    return (dealt.withColumn("rn", F.row_number().over(inside))
            .join(offsets, ["bucket", "slice"])
            .select("doc_id", "n_tokens", "bucket", "padded_length",
                    F.floor(at / room).cast("long").alias("batch"),
                    F.pmod(at, room).cast("int").alias("place")))
