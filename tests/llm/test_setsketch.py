import random

import numpy as np

from footfall.llm import setsketch
from footfall.llm.tables import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD_TEXTS, components, documents, folder


def check(spark, docs, width=4, percent=80):
    got = {r.doc_id: r for r in setsketch.near_duplicates(docs, folder(spark), width, percent).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    want, sizes = components(texts, width, percent)
    assert {i: (r.component_id, r.n_shingles, r.kept) for i, r in got.items()} == \
        {i: (want[i], sizes[i], want[i] == i) for i in texts}


def test_whole_table_against_brute_force(spark):
    check(spark, table(spark, SF_SMALL, "documents"))


def test_odd_texts(spark):
    check(spark, documents(spark, ODD_TEXTS + ODD_TEXTS, first=5))


def test_chains_stars_and_bucket_neighbours(spark):
    """Groups whose members are linked through others only, near the threshold."""
    rnd = random.Random(3)
    texts = []
    for _ in range(6):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
        for _ in range(25):                      # a drifting chain
            texts.append(" ".join(words))
            words = list(words)
            words[rnd.randrange(120)] = f"w{rnd.randrange(10**6)}"
            words[rnd.randrange(120)] = f"w{rnd.randrange(10**6)}"
    base = [f"b{i}" for i in range(100)]
    for _ in range(60):                          # a star: each near the base, few near each other
        words = list(base)
        for _ in range(3):
            words[rnd.randrange(100)] = f"w{rnd.randrange(10**6)}"
        texts.append(" ".join(words))
    rnd.shuffle(texts)
    check(spark, documents(spark, texts))


def test_null_ids_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (7, "a b c d e")],
                                 "doc_id long, text string")
    out = setsketch.near_duplicates(docs.selectExpr("*", "1 as n", "2 as sid", "3 as regs"), folder(spark))
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in out.collect())
    assert got == [(-1, None, True), (3, 3, True), (3, 3, True), (7, 3, False)]
    assert setsketch.near_duplicates(docs.limit(0), folder(spark)).count() == 0


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    for j in (0.2, 0.5, 0.8, 0.95):
        a, b, na = [], [], 600
        both = round(2 * na * j / (1 + j))
        for _ in range(60):
            x = rng.integers(0, 1 << 63, 2 * na - both, dtype=np.uint64)
            a.append(setsketch.registers(x[:na]))
            b.append(setsketch.registers(x[na - both:]))
        n = np.full(60, na)
        got = setsketch.estimate(np.array(a), np.array(b), n, n)
        assert abs(got.mean() - j) < 0.02 and got.std() < 0.08


def test_registers_merge():
    x = np.arange(1, 900, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = setsketch.registers(x)
    assert (np.maximum(setsketch.registers(x[:300]), setsketch.registers(x[200:])) == whole).all()


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Same components when every bucket counts as large and blocks are small."""
    monkeypatch.setattr(setsketch, "SMALL", 2)
    monkeypatch.setattr(setsketch, "BLOCK", 8)
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for n in (2, 3, 4, 5, 6) * 14:                # edits that leave pairs on both sides of 0.8
        words = list(base)
        for _ in range(n):
            words[rnd.randrange(150)] = f"w{rnd.randrange(10**6)}"
        texts.append(" ".join(words))
    check(spark, documents(spark, texts))


def test_overlaps_of_blocks():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in rng.integers(1, 4000, 23)]
    got = setsketch._overlaps(sets[:9], sets[9:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[9:]] for a in sets[:9]]


def test_repeated_rows_of_two_near_texts_are_one_link(spark):
    words = [f"w{i}" for i in range(300)]
    near = words[:150] + ["other"] + words[151:]
    docs = documents(spark, [" ".join(words), " ".join(near)])
    repeated = docs.selectExpr("*", "explode(sequence(1, 500))").drop("col")
    where = folder(spark)
    got = setsketch.near_duplicates(repeated, where).groupBy("doc_id", "component_id", "kept").count().collect()
    assert sorted(map(tuple, got)) == [(0, 0, True, 500), (1, 0, False, 500)]
    assert spark.read.parquet(f"{where}/sets").count() == 2
    assert spark.read.parquet(f"{where}/links-0").count() == 1


def test_components_over_many_tasks(spark):
    import random
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, x) for x in range(1001, 1200)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    rng.shuffle(edges)
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        root[max(top(a), top(b))] = min(top(a), top(b))
    table = spark.createDataFrame([e if rng.random() < 0.5 else e[::-1] for e in edges], "a long, b long").repartition(7)
    for size in (10, 1_000_000):
        got = {r.node: r.comp for r in setsketch.connected(table, folder(spark), size).collect()}
        assert got == {x: top(x) for e in edges if e[0] != e[1] for x in e}
