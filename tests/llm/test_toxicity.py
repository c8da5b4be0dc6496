from footfall.llm import toxicity
from footfall.llm.queries import op10_toxicity
from footfall.llm.tables import table
from tests.conftest import SF_ORACLE
from tests.llm.helpers import ODD_TEXTS, documents, folder


def test_held_out_accuracy(spark):
    out = op10_toxicity(spark, "/root/testdata/sf0.1")
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = out.join(table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").where("held_out").collect()
    hit = [r.predicted == r.toxic for r in rows]
    bad = [r.predicted == 1 for r in rows if r.toxic == 1]
    print("accuracy", sum(hit) / len(hit), "recall", sum(bad) / len(bad))
    assert sum(hit) / len(hit) > 0.97 and sum(bad) / len(bad) > 0.8


def test_held_out_labels_are_not_read(spark):
    docs, labels = (table(spark, SF_ORACLE, t) for t in ("documents", "labels"))
    other = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic) as toxic")
    a, b = (toxicity.fit(docs, x, folder(spark)) for x in (labels, other))
    assert (a.at == b.at).all() and (a.w == b.w).all() and a.bias == b.bias


def test_edge_tables(spark):
    docs = documents(spark, ODD_TEXTS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none, folder(spark))
    got = toxicity.score(docs.selectExpr("doc_id", "text", "1 as slots", "2 as shard"), model).collect()
    assert len(got) == len(ODD_TEXTS) and all(abs(r.score - 0.5) < 1e-9 for r in got)
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0), (3, 0), (4, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs.limit(0), odd, folder(spark))
    assert toxicity.score(docs.select("doc_id", "text").limit(0), model).count() == 0
