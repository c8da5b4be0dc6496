"""MinHash near-dedup with SetSketch registers.

A document's set holds the 64-bit hashes of its distinct word shingles. A
SetSketch register keeps the smallest of exponential variates drawn for the
elements, truncated to an exponentially spaced scale of base ``BASE``: registers
of two sets merge by maximum, and are equal with a probability close to the
sets' Jaccard similarity. Groups of ``BAND`` registers are band keys; at a
similarity of 0.8 two sets miss all 32 bands with a probability of 5e-8. Pairs
that meet in a band are first judged by the maximum-likelihood estimate of their
similarity from register comparisons and set sizes, with six standard errors of
room, then on their full sets.

Equal sets collapse into one class before banding. Inside a band bucket not all
pairs are formed. First, each member is compared with the bucket's smallest one;
buckets whose members are then connected are done. In other buckets of up to
``SMALL`` members, members of different components are compared, so a member meets
at most that many. Larger buckets that share members form one group: the members
outside its largest component meet all members in blocks of ``BLOCK``, each pair of
blocks in a task of its own that returns a forest of the links it finds, never the
pairs. A pair is passed over only when both sides are in one component already, so
components are those of all links. What is dealt out grows with the members times the
blocks outside the largest component; no bucket is gathered in one task.

Defined results: null or empty text has an empty set and is linked with nothing;
fewer words than a shingle form one shingle; rows that share a doc_id but not a
text are documents of their own; a null doc_id takes no part (component null,
kept).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import stored
from footfall.llm.wordhash import FOLD, chunks, find_words, mix, span_hashes, windows

REGISTERS, BAND = 128, 4
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2       # b, a and q of the sketch
SMALL, BLOCK = 32, 512                              # members of a small bucket, of a block
TASK_EDGES = 250_000                                # links that one task joins into a forest
BROADCAST_SETS = 500_000                            # names of wanted sets that are broadcast, 32 bytes each
_rng = np.random.default_rng(20)
_A = _rng.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_SALTS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, hashes, offsets): each text's sorted distinct shingles."""
    for lo, hi, data, at in chunks(column):
        words = find_words(data, at)
        h = span_hashes(FOLD[data], words.start, words.end)
        first, offsets = windows(words, width)
        s = np.zeros(len(first), np.uint64)
        for j in range(width):
            s += h[first + j] * _SALTS[j]
        s = mix(s)
        counts, n = words.counts(), np.diff(offsets)
        short = np.flatnonzero((counts > 0) & (n == 0))
        if len(short):            # the whole sequence is one shingle; its length is part of the hash
            row = words.row
            whole = [mix((h[row[i]:row[i + 1]] * _SALTS[:counts[i]]).sum(keepdims=True)
                         + np.uint64(counts[i]))[0] for i in short]
            s = np.insert(s, offsets[short], np.array(whole, np.uint64))
            n = n.copy()
            n[short] = 1
            offsets = np.concatenate([[0], np.cumsum(n)])
        for i in range(hi - lo):
            s[offsets[i]:offsets[i + 1]].sort()
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        new[offsets[:-1][n > 0]] = True
        kept = np.concatenate([[0], np.cumsum(new)])
        yield lo, hi, s[new], kept[offsets]


def registers(elements: np.ndarray) -> np.ndarray:
    """The registers of one non-empty set."""
    x = (elements >> np.uint64(32)).astype(np.uint32)
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        y = x[i:i + 4096, None] * _A
        y += _B
        np.minimum(low, y.min(axis=0), out=low)
    least = -np.log1p(-(low + 0.5) / 2.0 ** 32) / RATE
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    s = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return (s[at[1:]] - s[at[:-1]]).view(np.int64)


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, s, at in shingle_sets(b["text"], width):
                regs = [registers(s[at[i]:at[i + 1]]).tobytes() if at[i + 1] > at[i] else None
                        for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"].slice(lo, hi - lo), pa.array(np.diff(at)),
                     pa.array(_sums(mix(s + _SALTS[60]), at)), pa.array(_sums(mix(s ^ _SALTS[61]), at)),
                     pa.array(regs, pa.binary())], names=["doc_id", "n", "f1", "f2", "regs"])
    return run


def _sets(width: int):
    """The sets of texts whose fingerprint is the expected one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f1, f2 = b["f1"].to_numpy(), b["f2"].to_numpy()
            for lo, hi, s, at in shingle_sets(b["text"], width):
                same = np.flatnonzero((_sums(mix(s + _SALTS[60]), at) == f1[lo:hi])
                                      & (_sums(mix(s ^ _SALTS[61]), at) == f2[lo:hi]))
                yield pa.RecordBatch.from_arrays(
                    [b["sid"].take(pa.array(same + lo)),
                     pa.array([s[at[i]:at[i + 1]].tobytes() for i in same], pa.binary())],
                    names=["sid", "elements"])
    return run


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarities of pairs, from registers (rows of
    ``a`` and ``b``) and set sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)
    step = (BASE - 1) / BASE

    def share(x):                   # probability that a register is greater
        return -np.log1p(-np.clip(x, 1e-12, 1) * step) / np.log(BASE)

    def fit(j):
        p, q = share(u - v * j), share(v - u * j)
        return more * np.log(p) + less * np.log(q) + equal * np.log(np.clip(1 - p - q, 1e-12, 1))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(50):              # the likelihood is concave
        m1, m2 = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = fit(m1) > fit(m2)
        lo, hi = np.where(left, lo, m1), np.where(left, m2, hi)
    return (lo + hi) / 2


def _likely(percent: int):
    least = percent / 100 - 6 * np.sqrt(percent / 100 * (1 - percent / 100) / REGISTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, REGISTERS)
                    for c in ("regs_a", "regs_b"))
            near = estimate(a, b, batch["n_a"].to_numpy(), batch["n_b"].to_numpy()) >= least
            yield batch.select(["a", "b"]).filter(pa.array(near))
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch["set_a"], batch["set_b"], strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``x`` with all of ``y``."""
    every = np.concatenate([*x, *y])
    values, column, n = np.unique(every, return_inverse=True, return_counts=True)
    shared = np.cumsum(n > 1) - 1                     # elements of one set intersect nothing
    row = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in [*x, *y]])
    keep = n[column] > 1
    row, column = row[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(x), len(y)), np.float32)
    step = 4096
    cuts = np.searchsorted(column, np.arange(0, len(values) + step, step))
    for i in range(len(cuts) - 1):
        r, c = row[cuts[i]:cuts[i + 1]], column[cuts[i]:cuts[i + 1]] - i * step
        if len(r):
            part = np.zeros((len(x) + len(y), int(c.max()) + 1), np.float32)
            part[r, c] = 1
            out += part[:len(x)] @ part[len(x):].T
    return out


def _block_links(percent: int):
    """A forest of the links between two blocks of members (side 0 and side 1)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = [pdf[pdf["side"] == k] for k in (0, 1)]
        ids = [p["sid"].to_numpy() for p in sides]
        sets = [[np.frombuffer(e, np.uint64) for e in p["elements"]] for p in sides]
        found: list[tuple[int, int]] = []
        if len(ids[0]) and len(ids[1]):
            size = [np.array([len(s) for s in x], np.float64) for x in sets]
            both = _overlaps(*sets)
            linked = 100 * both >= percent * (size[0][:, None] + size[1][None, :] - both)
            linked &= ids[0][:, None] != ids[1][None, :]
            root: dict[int, int] = {}

            def top(n):
                while root.setdefault(n, n) != n:
                    root[n] = root[root[n]]
                    n = root[n]
                return n

            for i, j in zip(*np.nonzero(linked), strict=True):
                p, q = top(int(ids[0][i])), top(int(ids[1][j]))
                if p != q:
                    root[max(p, q)] = min(p, q)
                    found.append((int(ids[0][i]), int(ids[1][j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return run


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of the components of a task's edges: each node but the smallest, and that one."""
    root: dict[int, int] = {}

    def top(n: int) -> int:
        while root.setdefault(n, n) != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for batch in batches:
        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
            p, q = top(a), top(b)
            if p != q:
                root[max(p, q)] = min(p, q)
    nodes = [n for n in root if root[n] != n]
    for i in range(0, len(nodes), 100_000):
        some = nodes[i:i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([top(n) for n in some], pa.int64())],
                                         names=["a", "b"])


def connected(edges: DataFrame, folder: str, task_edges: int = TASK_EDGES) -> DataFrame:
    """node, comp (smallest node reachable) for all nodes of the edges (a, b).

    Tasks of up to ``task_edges`` edges first make them a spanning forest, without a shuffle.
    If there was more than one task, large and small stars follow in turn until
    nothing changes: each node hands its larger neighbours, then its smaller ones, over to
    the smallest node it knows, so edges never grow in number and end as stars."""
    edges = stored(edges.select("a", "b").where("a <> b"), f"{folder}/edges")
    tasks = max(1, -(-edges.count() // task_edges))
    # fewer, larger tasks; a table of fewer files is read as it is
    stars = stored(edges.coalesce(tasks).mapInArrow(_forest, "a long, b long"), f"{folder}/stars-0")
    mark, n = None, 0

    def state(pairs: DataFrame):
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    while tasks > 1 and (now := state(stars)) != mark:
        mark, n = now, n + 1
        both = stars.union(stars.select("b", "a")).toDF("a", "b")
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = stored(both.join(low, "a").where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                       .distinct(), f"{folder}/large-{n}")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        stars = stored(small.union(low.toDF("a", "b")).distinct(), f"{folder}/stars-{n}")
    return stars.toDF("node", "comp").union(stars.select("b", "b").distinct().toDF("node", "comp"))


def near_duplicates(docs: DataFrame, folder: str, width: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``.

    Documents are linked if ``100 * intersection >= percent * union`` of their
    sets of ``width``-word shingles."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = stored(docs.mapInArrow(
        _sketches(width), "doc_id long, n long, f1 long, f2 long, regs binary"), f"{folder}/sketches")
    mark = ["n", "f1", "f2"]
    classes = stored(seen.where("n > 0 and doc_id is not null").groupBy(*mark)
                     .agg(F.min("doc_id").alias("rep"), F.first("regs").alias("regs"))
                     .withColumn("sid", F.monotonically_increasing_id()), f"{folder}/classes")

    size = 2 * BAND
    keys = classes.select("sid", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.substring("regs", 1 + i * size, size))
        for i in range(REGISTERS // BAND)])).alias("key"))
    shared = keys.groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo < hi")
    members = stored(keys.join(shared.select("key", "lo"), "key"), f"{folder}/members-0")

    wanted = stored(members.select("sid").distinct().join(classes.select("sid", "rep", "f1", "f2"), "sid"),
                    f"{folder}/wanted")
    # texts stay where they are while the names of the wanted sets are few
    named = F.broadcast(wanted) if wanted.count() <= BROADCAST_SETS else wanted
    found = docs.join(named, docs["doc_id"] == named["rep"]).select("text", "sid", "f1", "f2") \
        .mapInArrow(_sets(width), "sid long, elements binary")
    # rows that repeat a doc_id and its text are one set
    sets = stored(found.groupBy("sid").agg(F.first("elements").alias("elements")), f"{folder}/sets")

    def confirmed(pairs: DataFrame, n: int) -> DataFrame:
        """The pairs (a, b) that are links."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for c in "ab":
            pairs = pairs.join(classes.select(F.col("sid").alias(c), F.col("n").alias(f"n_{c}"),
                                              F.col("regs").alias(f"regs_{c}")), c)
        likely = pairs.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) \
            .mapInArrow(_likely(percent), "a long, b long")
        likely = stored(likely, f"{folder}/likely-{n}")
        for c in "ab":
            likely = likely.join(sets.select(F.col("sid").alias(c), F.col("elements").alias(f"set_{c}")), c)
        return stored(likely.mapInArrow(_linked(percent), "a long, b long"), f"{folder}/links-{n}")

    links = confirmed(members.where("sid <> lo").select(F.col("lo").alias("a"), F.col("sid").alias("b")), 0)
    comps = connected(links, f"{folder}/comps-0")
    here = members.join(comps.select(F.col("node").alias("sid"), "comp"), "sid", "left") \
        .select("key", "sid", "lo", F.coalesce("comp", "sid").alias("comp"))
    split = here.groupBy("key").agg(F.min("comp").alias("p"), F.max("comp").alias("q"),
                                    F.count("*").alias("m")).where("p < q").select("key", "m")
    open_ = stored(here.join(split, "key"), f"{folder}/open")

    few = open_.where(F.col("m") <= SMALL).select("key", "sid", "comp")
    pairs = few.join(few.select("key", F.col("sid").alias("b"), F.col("comp").alias("other")), "key") \
        .where("sid < b and comp <> other")
    links = confirmed(pairs.select(F.col("sid").alias("a"), "b"), 1)

    many = open_.where(F.col("m") > SMALL)
    if not many.isEmpty():
        group = connected(many.select(F.col("sid").alias("a"), F.col("lo").alias("b")), f"{folder}/groups")
        group = group.select(F.col("node").alias("sid"), F.col("comp").alias("g"))
        grouped = stored(many.select("sid", "comp").distinct().join(group, "sid"), f"{folder}/grouped")
        sizes = grouped.groupBy("g", "comp").agg(F.count("*").alias("n")).groupBy("g").agg(
            F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top"))
        left, right = (F.ceil(n / BLOCK).cast("int") for n in (F.col("n") - F.col("top.n"), F.col("n")))
        dealt = grouped.join(sizes.select("g", F.col("top.comp").alias("largest"), left.alias("i_n"),
                                          right.alias("j_n")), "g").where("i_n > 0")
        own = F.xxhash64(F.lit("block"), "sid")
        each = [dealt.where("comp <> largest").select(
                    "sid", "g", F.pmod(own, F.col("i_n")).cast("int").alias("i"),
                    F.explode(F.sequence(F.lit(0), F.col("j_n") - 1)).alias("j"), F.lit(0).alias("side")),
                dealt.select(
                    "sid", "g", F.explode(F.sequence(F.lit(0), F.col("i_n") - 1)).alias("i"),
                    F.pmod(own, F.col("j_n")).cast("int").alias("j"), F.lit(1).alias("side"))]
        blocks = each[0].unionByName(each[1]).join(sets, "sid").groupBy("g", "i", "j") \
            .applyInPandas(_block_links(percent), "a long, b long")
        links = links.union(stored(blocks, f"{folder}/block-links"))
    if not links.isEmpty():
        comps = connected(links.union(comps.where("node <> comp").select("node", "comp")), f"{folder}/comps-1")

    joined = classes.select("sid", "rep", *mark).join(
        comps.select(F.col("node").alias("sid"), "comp"), "sid", "left")
    least = joined.where("comp is not null").groupBy("comp").agg(F.min("rep").alias("least"))
    group = joined.join(least, "comp", "left").select(
        *mark, F.coalesce("least", "rep").alias("component"))
    out = seen.select("doc_id", *mark).join(group, mark, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
