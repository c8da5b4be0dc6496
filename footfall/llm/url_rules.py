"""URL rules by a sort-merge range join.

A rule is (host, path, verdict); it fits its host and all subdomains if the
url's path starts with the rule's. The canonical key of a host and a path is the
host's labels reversed, a separator, and the path, so a rule is the interval of
keys that start with its own key, and intervals nest or are disjoint. A url
stands at one key for each of its parent hosts (no more than the longest rule
host has labels). Rules and keys are range-partitioned by split keys; a rule goes
to each range that its interval meets; a sorted sweep keeps the stack of rules
that are open at a key. The longest rule text wins; between equally long ones
the one with the longer host, then block.

Distinct (host, path) pairs go through the sweep, so repeated urls do not make a
hot range; equal keys of different hosts are dealt by a hash. Split keys are
drawn from a bounded sample and decide balance only, never results.

Defined results: a null url, or one without ``://``, has empty host and path and
no rule; an empty host or path is legal; without rules every row gets the
default; repeated rules count once; rows keep their number.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import extended

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "/"                    # between reversed host and path; no host holds it
SAMPLE_PER_RANGE = 40         # sampled keys for each range


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path, empty where there is no ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return pages.withColumn("host", F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)) \
        .withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def _key(labels, path):
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit(MARK), path)


def _place(splits: list[tuple[bytes, int]]):
    """The range numbers of rows: one for a key, all that it meets for a rule."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = 1 << 63
        for b in batches:
            key, tie, rule = b["key"].to_pylist(), b["tie"].to_pylist(), b["is_rule"].to_pylist()
            index, part = [], []
            for i, k in enumerate(key):
                k = k.encode()
                if rule[i]:
                    lo, hi = bisect_right(splits, (k, -top)), bisect_right(splits, (k + b"\xff", top))
                else:
                    lo = hi = bisect_right(splits, (k, tie[i]))
                index.extend([i] * (hi - lo + 1))
                part.extend(range(lo, hi + 1))
            out = b.take(pa.array(index, pa.int32()))
            yield out.append_column("part", pa.array(part, pa.int32()))
    return run


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, key, rules first): the innermost open rule of each key."""
    stack: list[tuple[str, str, str]] = []
    here = None
    for b in batches:
        out = {"host": [], "path": [], "rule": [], "verdict": [],
               "rank": [], "host_chars": []}
        for r in b.to_pylist():
            if r["part"] != here:
                here, stack = r["part"], []
            while stack and not r["key"].startswith(stack[-1][0]):
                stack.pop()
            if r["is_rule"]:
                if not stack or stack[-1][0] != r["key"]:      # else: the same rule, a lower verdict
                    stack.append((r["key"], r["rule"], r["verdict"]))
            elif stack:
                key, rule, verdict = stack[-1]
                found = (r["host"], r["path"], rule, verdict, len(rule), key.index(MARK))
                for c, v in zip(out, found, strict=True):
                    out[c].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=_SWEPT)


_SWEPT = pa.schema([("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
                    ("verdict", pa.string()), ("rank", pa.int32()), ("host_chars", pa.int32())])


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
          default: str = "allow", ranges: int | None = None) -> DataFrame:
    """One row for each row of ``pages``: key, host, path, rule, verdict.

    ``rules`` has host, path, verdict ('allow' or 'block')."""
    spark = pages.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen = parsed(pages.select(key, F.col(url).alias("url")))
    rules = rules.where("host is not null and path is not null and verdict is not null").select(
        F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").distinct()
    depth = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    points = (seen.where("host <> ''").select("host", "path").distinct()
              .withColumn("labels", labels)
              .withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(depth, 1))))))
              .select("host", "path", F.lit(None).cast("string").alias("rule"),
                      F.lit(None).cast("string").alias("verdict"),
                      _key(F.slice("labels", -F.col("n"), F.col("n")), F.col("path")).alias("key"),
                      F.xxhash64("host", "path").alias("tie"), F.lit(False).alias("is_rule")))
    marks = rules.select("host", "path", F.concat("host", "path").alias("rule"), "verdict",
                         _key(labels, F.col("path")).alias("key"), F.lit(0).cast("long").alias("tie"),
                         F.lit(True).alias("is_rule"))
    n = points.count()
    want = SAMPLE_PER_RANGE * ranges
    share = min(1.0, want / max(n, 1))
    drawn = sorted((r.key.encode(), r.tie) for r in points.where(
        F.pmod(F.xxhash64(F.lit("split"), "key", "tie"), F.lit(1 << 30)) < int(share * (1 << 30)))
        .select("key", "tie").limit(2 * want).collect())
    splits = [drawn[i * len(drawn) // ranges] for i in range(1, ranges)] if drawn else []
    both = points.unionByName(marks)
    schema = extended(both.schema, "part", "integer")
    dealt = both.mapInArrow(_place(splits), schema)
    swept = (dealt.repartition(ranges, "part")
             .sortWithinPartitions("part", "key", F.desc("is_rule"), F.desc("verdict"))
             .mapInArrow(_sweep, "host string, path string, rule string, "
                                 "verdict string, rank int, host_chars int"))
    won = swept.groupBy("host", "path").agg(F.max(F.struct(
        "rank", "host_chars", "verdict", "rule")).alias("w"))
    won = won.select("host", "path", F.col("w.rule").alias("rule"), F.col("w.verdict").alias("verdict"))
    return seen.select(key, "host", "path").join(won, ["host", "path"], "left").select(
        key, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
