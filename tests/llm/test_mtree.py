import math

import duckdb
import numpy as np
import pytest

from footfall.llm import mtree
from footfall.llm.queries import OP5_SQL, op5_mtree
from footfall.llm.tables import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import folder

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=50, k=5):
    usable = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
              if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for q, a in sorted(dict(usable).items()):
        if q % every == 0:
            found = sorted({(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable
                            if i != q and len(a) == len(b)})[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return out


def check(spark, rows, **sizes):
    data = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    vectors = mtree.integers(data.selectExpr("*", "1 as id", "2 as dim", "3 as v"))
    where = folder(spark)
    found = mtree.search(mtree.index(vectors, where, **sizes), vectors.where("id % 50 = 0"), vectors, where)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF_SMALL, "embeddings").collect()]
    assert sorted(map(tuple, op5_mtree(spark, SF_SMALL).collect())) == brute(rows)


def test_ties_repeats_nulls_and_small_cells(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(900)]
    rows += [(i, [1.0, 0.0, 1.0, 0.5]) for i in range(900, 2300)]          # one vector of most rows
    rows += [(None, [1.0] * 4), (5000, None), (5050, []), (5100, [None, 1.0, 1.0, 1.0]), (5150, [math.nan] * 4),
             (5200, [math.inf] * 4), (5250, [9.0, 9.0]), (5251, [1.0, -1.0]), (5300, [0.1, 0.2, 0.3])]
    check(spark, rows, cell_rows=150, pivots=6)


def test_few_rows(spark):
    check(spark, [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (3, [0.0, 0.0])])
    check(spark, [(0, [1.0, 2.0])])
    check(spark, [])


def test_search_leaves_entries_out():
    """On grouped vectors most entries are excluded by stored bounds."""
    rng = np.random.default_rng(0)
    centers = rng.integers(-300, 300, (40, 8)).astype(float)
    x = np.round(centers[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 8)) * 2)
    tree = mtree.Tree.__new__(mtree.Tree)
    pages = mtree.build(np.arange(6000), x)
    tree.dim, tree.root = 8, x[0]
    tree.pages = [(p["leaf"], p["ids"], p["vectors"], p["radii"], p["norms"], p["apart"]) for p in pages]
    for q in range(0, 6000, 500):
        found, made = tree.search(x[q], q, 5, -np.inf)
        scores = x @ x[q]
        scores[q] = -np.inf
        order = np.lexsort((np.arange(6000), -scores))[:5]
        assert [i for _, i in found] == order.tolist()
        assert made < 3000


@pytest.mark.parametrize("copies", [2, 5, 10])
def test_repeated_rows_of_an_id_against_sql(spark, tmp_path, copies):
    """Best matches, queries and vectors of one id repeated, with equal and other vectors."""
    rng = np.random.default_rng(copies)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(700)]
    rows += [(7, [4.0, 4.0, 4.0, 4.0])] * copies + [(8, [-4.0, 4.0, -4.0, 4.0])] * copies
    rows += [(50, [3.0, 3.0, 2.0, 3.0])] * copies + [(9, [5.0, float(c), 0.0, 1.0]) for c in range(copies)]
    rows += [(100, [float(c), 5.0, 5.0, 1.0]) for c in range(copies)] + [(11, [1.0, 1.0, 1.0, 1.0])] * (40 * copies)
    data = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    data.repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    expected = sorted(con.execute(OP5_SQL).fetchall())
    assert sorted(map(tuple, op5_mtree(spark, str(tmp_path)).collect())) == expected
    vectors, where = mtree.integers(data), folder(spark)
    found = mtree.search(mtree.index(vectors, where, cell_rows=60, pivots=4), vectors.where("id % 50 = 0"), vectors,
                         where, block=5)
    assert sorted(map(tuple, found.collect())) == expected
