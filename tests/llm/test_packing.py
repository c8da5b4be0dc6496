import itertools
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import packing
from footfall.llm.tables import table
from tests.conftest import SF_ORACLE
from tests.llm.helpers import ODD_TEXTS, WORD, documents, folder


def padding(bins, uppers):
    return sum(c * (min(u for u in uppers if u >= b) - b) for b, c in bins)


@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1, max_size=8), st.integers(1, 4))
@settings(max_examples=60, deadline=None)
def test_boundaries_are_optimal(bins, k):
    bins = sorted(bins.items())
    sizes = [b for b, _ in bins]
    best = min(padding(bins, [*c, sizes[-1]])
               for n in range(min(k, len(sizes))) for c in itertools.combinations(sizes[:-1], n))
    got = packing.boundaries(bins, k)
    assert len(got) <= k and got == sorted(set(got)) and padding(bins, got) == best


def test_batches(spark):
    docs = table(spark, SF_ORACLE, "documents").select("doc_id", "text").union(
        documents(spark, ODD_TEXTS, first=10**6).select("doc_id", "text"))
    out = packing.pack(docs, folder(spark), buckets=5, budget=3000, slice_rows=90).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in out) == sorted(texts)
    lengths = {i: len(WORD.findall(t or "")) for i, t in texts.items()}
    uppers = packing.boundaries(list(itertools.starmap(
        lambda k, v: (k, len(list(v))), itertools.groupby(sorted(lengths.values())))), 5)
    batches = defaultdict(list)
    for r in out:
        assert r.n_tokens == lengths[r.doc_id]
        assert r.padded_length == min(u for u in uppers if u >= r.n_tokens) == uppers[r.bucket]
        batches[r.bucket, r.batch].append(r)
    sizes = defaultdict(list)
    for (bucket, _), rows in sorted(batches.items()):
        room = max(1, 3000 // max(uppers[bucket], 1))
        assert sorted(r.place for r in rows) == list(range(len(rows))) and len(rows) <= room
        sizes[bucket].append(len(rows) == room)
    assert all(s[:-1] == [True] * (len(s) - 1) for s in sizes.values())


def test_edge_tables(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None), (1, "x")], "doc_id long, text string")
    out = packing.pack(docs.selectExpr("*", "1 as bucket", "2 as bin"), folder(spark)).collect()
    assert len(out) == 4 and len({(r.bucket, r.batch, r.place) for r in out}) == 4
    assert packing.pack(docs.limit(0), folder(spark)).count() == 0


def test_long_texts_share_bounded_bins(spark):
    docs = documents(spark, ["w " * n for n in (4096, 4097, 9001, 70_001)])
    got = {r.n_tokens: r.bin for r in packing.lengths(docs).collect()}
    assert got == {4096: 4096, 4097: 4112, 9001: 9024, 70_001: 70_144}


def test_padding_ends_at_the_longest_document_of_a_bucket(spark):
    lengths = [3, 5000, 5001, 9001, 9003, 20_011, 70_001]
    docs = documents(spark, ["w " * n for n in lengths])
    for buckets, uppers in ((16, [3, 5001, 9003, 20_011, 70_001]), (1, [70_001])):
        out = packing.pack(docs, folder(spark), buckets=buckets).collect()
        assert {r.n_tokens: r.padded_length for r in out} == {n: min(u for u in uppers if u >= n) for n in lengths}
