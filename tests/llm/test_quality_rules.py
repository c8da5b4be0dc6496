from collections import Counter

from footfall.llm import quality_rules as qr
from footfall.llm.tables import table
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import ODD_TEXTS, WORD, documents, folder


def counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    n, repeat = len(words), len(hit)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), repeat, n < 50 or 100 * repeat > 50 * n)


def test_counts_against_plain_python(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").union(
        documents(spark, [*ODD_TEXTS, "a b a b a b a", "x y z x y z", "q q q q"], first=10**6)
        .select("doc_id", "text"))
    out = qr.assess(docs, qr.DecisionList()).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(out) == len(texts)
    for r in out:
        assert (*[r[c] for c in qr.COUNTS], r.base_failed) == counts(texts[r.doc_id])
        assert r.kept == (not r.base_failed)


def test_learned_list_separates_the_labels(spark):
    docs, labels = (table(spark, SF_ORACLE, t) for t in ("documents", "labels"))
    rules = qr.fit(docs, labels, folder(spark))
    assert rules.rules
    out = qr.assess(docs, rules).join(labels, "doc_id").selectExpr(
        "avg(if(quality = 1 and not base_failed, int(kept), null)) good",
        "avg(if(quality = 0, int(kept), null)) bad").first()
    assert out.good > 0.97 and out.bad < 0.35


def test_cover_and_cuts_on_a_known_case():
    assert qr.choose_cuts([(0, 5, 0), (1, 5, 0), (2, 0, 5), (3, 0, 5)], 1) == [1]
    assert qr.choose_cuts([(0, 5, 0), (1, 5, 0)], 3) == []
    cells = [((a, b), *((30, 0, 10, 0) if not (a > 1 and b > 2) else (0, 30, 0, 10)))
             for a in range(4) for b in range(5)]
    tests = [qr.Test(f, up, c) for f, m in (("x", 3), ("y", 4)) for c in range(m) for up in (True, False)]
    got = qr.cover(cells, tests, ["x", "y"])
    assert [sorted((t.feature, t.above, t.cut) for t in r) for r in got.rules] == [[("x", True, 1), ("y", True, 2)]]


def test_edge_tables(spark):
    docs = documents(spark, [None, "", "a b"]).selectExpr("*", "1 as row", "2 as words", "true as kept")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1), (0, None), (1, 1), (1, 0)], "doc_id long, quality int")
    for labels in (none, odd):
        rules = qr.fit(docs, labels, folder(spark))
        assert not rules.rules
        assert qr.assess(docs, rules).count() == 3
        assert qr.keep_good(docs, rules).count() == 0
    long = documents(spark, [" ".join(f"w{i}" for i in range(60))]).selectExpr("*", "1 as row", "2 as words")
    assert [r.asDict() for r in qr.keep_good(long, qr.DecisionList()).collect()] == \
        [r.asDict() for r in long.collect()]
    assert qr.assess(docs.limit(0), qr.DecisionList()).count() == 0


def test_main_path_runs_no_python(spark):
    docs = table(spark, SF_SMALL, "documents")
    plan = qr.assess(docs, qr.DecisionList(((qr.Test("f_upper", True, 3),),)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
