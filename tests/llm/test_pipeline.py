import os
import sys

import corpus_pipeline
from footfall.llm.tables import table
from tests.conftest import SF_SMALL


def test_stages_in_order(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name != "packing":
            assert out.dtypes == docs.dtypes, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert 0 < docs.count() <= n
        n = docs.count()
    assert n < 200


def test_entry_has_the_queries(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(__file__))))
    import __spark_entry__
    names = __spark_entry__.queries()
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)


def test_near_keeps_one_row_of_each_group_and_all_others(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (4, ""), (5, None), (None, a), (2, b + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as no", "2 as row")
    out = corpus_pipeline.near(spark, docs, SF_SMALL)
    assert out.dtypes == docs.dtypes
    got = sorted((r.doc_id or 0, (r.text or "")[:1]) for r in out.collect())
    assert got == [(0, "a"), (1, "a"), (2, "b"), (3, "c"), (4, ""), (5, "")]
