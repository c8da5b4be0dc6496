"""Exact top-k inner products by best-first search in M-trees.

Vectors (integer components) are dealt to cells of about ``CELL_ROWS`` rows: the
nearest of a bounded number of sampled pivots, and a hash of the row where a pivot
has more rows than a cell. Each cell becomes one M-tree of pages; an entry of a
page has its vector (of a row, or a routing object), a covering radius, the
largest norm below it, and its distance to the page's routing object. A query
visits pages in order of an upper bound of the inner product, which follows from
``2 q.x = |q|^2 + |x|^2 - d(q, x)^2`` and a lower bound of the distance: first by
the stored parent distance and the triangle inequality, which costs no
distance, then, for entries that this does not exclude, by the distance
itself less the radius. Pages whose bound is below the k-th best score are never
opened.

Queries go over the trees in blocks of ``BLOCK`` rows, each block broadcast. A query
starts with the k-th best score among ``SEEDS`` sampled rows as its lower bound.
Cells are bounded by salting, so a vector or an id that a third of the rows share is
many cells. What a block returns is at most k rows for each query row and cell, and k
copies of each.

Defined results: rows whose id is null, or whose vector is null, empty, or holds a
null or non-finite component, take no part; vectors of different lengths do not
meet; a query is not its own candidate, nor are other rows of its id; ties go to the
smaller id. Every pair of a query row and a candidate row counts: a candidate id stored
five times may take five ranks, and a query id stored twice meets each candidate twice,
its ranks being those of all its pairs (as in a join of the table with itself). Scores are exact while components stay below 2**22 in magnitude.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.tables import stored

CELL_ROWS = 16_384
PAGE = 512                 # entries of a page, at most
FAN = 16
PIVOTS = 128
SEEDS = 2_048
BLOCK = 4_096

_TREE = ("dim int, pages array<struct<leaf: boolean, ids: binary, vectors: binary, radii: binary, "
         "norms: binary, apart: binary>>, root: binary")


def integers(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id, dim, v: floor(256 * x) of the components of usable rows."""
    x = F.col(vector)
    usable = F.col(id_column).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(c.cast("double")))
    return table.where(usable).select(
        F.col(id_column).cast("long").alias("id"), F.size(x).alias("dim"),
        F.transform(x, lambda c: F.floor(256 * c.cast("double")).cast("long")).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two integer matrices."""
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0))


def _nearest(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, n = held.value, TaskContext.get().partitionId() << 33
        for b in batches:
            dims, cell = b["dim"].to_numpy(), np.zeros(b.num_rows, np.int32)
            for d in np.unique(dims):
                if int(d) in pivots:
                    at = np.flatnonzero(dims == d)
                    x = _matrix(b["v"].take(pa.array(at)), int(d))
                    cell[at] = _distances(x, pivots[int(d)]).argmin(axis=1)
            yield (b.append_column("pivot", pa.array(cell))
                   .append_column("no", pa.array(np.arange(n, n + b.num_rows))))
            n += b.num_rows
    return run


def build(ids: np.ndarray, x: np.ndarray) -> list[dict]:
    """The pages of a tree over the rows of ``x``; page 0 is the root. Entries of inner
    pages refer to pages by number."""
    norms = (x * x).sum(axis=1)
    pages: list[dict] = []

    def page(rows: np.ndarray, center: np.ndarray) -> int:
        me = len(pages)
        pages.append({})
        if len(rows) <= PAGE:
            pages[me] = {"leaf": True, "ids": ids[rows], "vectors": x[rows], "radii": np.zeros(len(rows)),
                         "norms": norms[rows], "apart": _distances(x[rows], center[None])[:, 0]}
            return me
        seeds = rows[np.linspace(0, len(rows) - 1, FAN).astype(int)]
        near = _distances(x[rows], x[seeds]).argmin(axis=1)
        groups = [(s, rows[near == i]) for i, s in enumerate(seeds) if (near == i).any()]
        if max(len(g) for _, g in groups) > 0.9 * len(rows):      # rows that distances do not part
            groups = [(g[0], g) for g in np.array_split(rows, FAN)]
        children = [page(g, x[s]) for s, g in groups]
        objects = x[[s for s, _ in groups]]
        pages[me] = {
            "leaf": False, "ids": np.array(children, np.int64), "vectors": objects,
            "radii": np.array([_distances(x[g], x[s][None]).max() for s, g in groups]),
            "norms": np.array([norms[g].max() for _, g in groups]),
            "apart": _distances(objects, center[None])[:, 0]}
        return me

    page(np.arange(len(x)), x[0])
    return pages


def _trees(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("id", kind="stable")
    dim = int(pdf["dim"].iloc[0])
    x = np.array(pdf["v"].tolist(), dtype=np.float64).reshape(-1, dim)
    pages = [{k: bool(v) if k == "leaf" else v.astype(np.int64 if k in ("ids", "vectors") else np.float64).tobytes()
              for k, v in p.items()} for p in build(pdf["id"].to_numpy(np.int64), x)]
    return pd.DataFrame({"dim": [dim], "pages": [pages], "root": [x[0].astype(np.int64).tobytes()]})


def index(vectors: DataFrame, folder: str, cell_rows: int = CELL_ROWS, pivots: int = PIVOTS) -> DataFrame:
    """One row for each tree: dim, pages, root (the root page's routing object)."""
    spark = vectors.sparkSession
    order = F.xxhash64(F.lit("pivot"), "id")
    drawn = vectors.orderBy(order, "id").limit(pivots).collect()
    held = spark.sparkContext.broadcast({
        d: np.unique(np.array([r.v for r in drawn if r.dim == d], np.float64), axis=0)
        for d in {r.dim for r in drawn}})
    near = stored(vectors.mapInArrow(_nearest(held), "id long, dim int, v array<long>, pivot int, no long"),
                  f"{folder}/cells")
    sizes = near.groupBy("dim", "pivot").agg(F.count("*").alias("n"))
    salts = F.ceil(F.col("n") / cell_rows).cast("int")
    # a cell with fewer rows than it may have shares no tree with another; rows have numbers,
    # so that those of one id are dealt out too
    dealt = near.join(sizes, ["dim", "pivot"]).withColumn(
        "salt", F.pmod(F.xxhash64(F.lit("salt"), "id", "no"), salts))
    return stored(dealt.groupBy("dim", "pivot", "salt").applyInPandas(
        lambda pdf: _trees(pdf), _TREE), f"{folder}/trees")


class Tree:
    """A tree with its arrays at hand."""

    def __init__(self, row: dict):
        self.dim = d = row["dim"]
        self.root = np.frombuffer(row["root"], np.int64).astype(np.float64)
        self.pages = [(p["leaf"], np.frombuffer(p["ids"], np.int64),
                       np.frombuffer(p["vectors"], np.int64).astype(np.float64).reshape(-1, d),
                       *(np.frombuffer(p[c], np.float64) for c in ("radii", "norms", "apart")))
                      for p in row["pages"]]

    def search(self, q: np.ndarray, own: int, k: int, least: float) -> tuple[list[tuple[int, int]], int]:
        """Up to k (score, id) with a score of ``least`` or more, best first, ties by id,
        and the number of distances and products computed."""
        square = float(q @ q)
        size = square ** 0.5
        slack = 1e-9 * (square + 1) + 1e-6             # for rounding in bounds
        best: list[tuple[int, int]] = []                # heap of (score, -id): the worst first
        away = float(np.sqrt(max(0.0, square + self.root @ self.root - 2 * (q @ self.root))))
        heap, made = [(-np.inf, 0, away)], 1
        while heap:
            bound, number, away = heapq.heappop(heap)
            floor = best[0][0] if len(best) == k else least
            if -bound < floor:
                break
            leaf, ids, vectors, radii, norms, apart = self.pages[number]
            closest = np.maximum(np.abs(away - apart) - radii, 0)
            open_ = np.flatnonzero((square + norms - closest * closest) / 2 + slack * (1 + norms) >= floor)
            if not len(open_):
                continue
            dots = vectors[open_] @ q
            made += len(open_)
            if leaf:
                keep = (dots >= floor) & (ids[open_] != own)
                found, dots = ids[open_[keep]], dots[keep]
                if len(dots) > 4 * k:                 # only the k best
                    order = np.lexsort((found, -dots))[:k]
                    found, dots = found[order], dots[order]
                for score, i in zip(dots.tolist(), found.tolist(), strict=True):
                    entry = (int(score), -i)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            else:
                objects = vectors[open_]
                far = np.sqrt(np.maximum(square + (objects * objects).sum(axis=1) - 2 * dots, 0))
                near = np.maximum(far - radii[open_], 0)
                top = np.minimum((square + norms[open_] - near * near) / 2, dots + size * radii[open_])
                top += slack * (1 + norms[open_])
                for j in np.flatnonzero(top >= floor).tolist():
                    heapq.heappush(heap, (-float(top[j]), int(ids[open_[j]]), float(far[j])))
        return sorted(((s, -i) for s, i in best), key=lambda e: (-e[0], e[1])), made


def _searcher(held, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = held.value
        for b in batches:
            for row in range(b.num_rows):
                tree = Tree(b.slice(row, 1).to_pylist()[0])
                ids, vectors, least, copies = queries.get(tree.dim, ((), (), (), ()))
                out: tuple[list, list, list] = ([], [], [])
                for query, v, floor, n in zip(ids, vectors, least, copies, strict=True):
                    for score, i in tree.search(v, int(query), k, floor)[0]:
                        for column, value in zip(out, (int(query), i, score), strict=True):
                            column.extend([value] * n)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                                 names=["query_id", "vec_id", "score"])
    return run


def search(trees: DataFrame, queries: DataFrame, vectors: DataFrame, folder: str, k: int = 5,
           block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each query row (id, dim, v)."""
    spark = trees.sparkSession
    # rows of one id count once, so that k seeds are k candidates
    drawn = vectors.orderBy(F.xxhash64(F.lit("pivot"), "id"), "id").limit(SEEDS).dropDuplicates(["id"]).collect()
    seeds = {d: (np.array([r.id for r in drawn if r.dim == d]),
                 np.array([r.v for r in drawn if r.dim == d], np.float64)) for d in {r.dim for r in drawn}}
    # equal rows are searched once; of what they find, no more than k copies can have a rank
    queries = stored(queries.groupBy("id", "dim", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("n")),
                     f"{folder}/queries")
    blocks = -(-queries.count() // block)
    parts = []
    for n in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64(F.lit("block"), "id", "v"), F.lit(blocks)) == n).collect()
        ready = {}
        for d in {r.dim for r in rows}:
            mine = [r for r in rows if r.dim == d]
            q = np.array([r.v for r in mine], np.float64)
            least = np.full(len(mine), -np.inf)
            if d in seeds:
                scores = q @ seeds[d][1].T
                scores[np.array([r.id for r in mine])[:, None] == seeds[d][0][None, :]] = -np.inf
                if scores.shape[1] >= k:
                    least = np.sort(scores, axis=1)[:, -k]
            ready[d] = ([r.id for r in mine], q, least, [r.n for r in mine])
        held = spark.sparkContext.broadcast(ready)
        parts.append(stored(trees.mapInArrow(_searcher(held, k), "query_id long, vec_id long, score long"),
                            f"{folder}/hits-{n}"))
        held.unpersist()
    hits = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for part in parts:
        hits = hits.union(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
