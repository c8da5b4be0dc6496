"""Positional index against a search over lists of words."""

import random
import re

import pytest

from footfall.llm import phrase_index as pi
from tests.llm.helpers import ASCII_LOWER, ODD_TEXTS, documents, folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def windows(items, width):
    return {(str(i) if i is not None else "", tuple(w[k:k + width]))
            for i, t in items if (w := words(t)) for k in range(max(1, len(w) - width + 1))}


def brute(docs, items, width, slop=None):
    found, every = [], windows(items, width)
    for doc_id, text in docs:
        w, hit, names = words(text), set(), set()
        for name, p in every:
            for s in range(len(w)):
                if slop is None:
                    last = s + len(p) - 1 if tuple(w[s:s + len(p)]) == p else None
                else:
                    last = s if w[s] == p[0] else None
                    for term in p[1:]:
                        last = None if last is None else next((x for x in range(last + 1, len(w)) if w[x] == term), None)
                    if last is not None and last - s >= len(p) + slop:
                        last = None
                if last is not None:
                    hit.update(range(s, last + 1))
                    names.add(name)
        found.append((doc_id, len(w), len(hit), sorted(names)))
    return sorted(found, key=str)


def run(spark, docs, items, width=pi.WIDTH, slop=None, block_rows=pi.BLOCK_ROWS):
    f = folder(spark)
    segments = pi.index(docs, f)
    queries = pi.phrases(spark.createDataFrame(items, ITEMS), f, width)
    found = pi.matches(segments, queries, f, block_rows) if slop is None else \
        pi.proximity(segments, queries, f, slop, block_rows)
    return sorted((tuple(r) for r in pi.contamination(segments, found).collect()), key=str)


@pytest.mark.parametrize(("width", "slop", "segment", "block_rows"), [
    (3, None, 1 << 18, 200_000), (4, None, 200, 40), (2, 0, 200, 200_000), (3, 2, 1 << 18, 30), (2, 3, 300, 200_000)])
def test_random_texts(spark, monkeypatch, width, slop, segment, block_rows):
    monkeypatch.setattr(pi, "SEGMENT", segment)
    rng = random.Random(width)
    vocab = ["a", "b", "C", "dé", "中", "x1", "the", "THE"]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, k=rng.choice([0, 1, 3, 30, 60])))) for i in range(120)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 1, 2, 3, 6])))) for i in range(40)]
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    assert run(spark, table, items, width, slop, block_rows) == brute(docs, items, width, slop)


def test_small_candidate_portions(spark, monkeypatch):
    monkeypatch.setattr(pi, "CANDIDATES", 5)
    docs = [(0, "a " * 50 + "b"), (1, "b a a a b")]
    items = [(0, "a a a"), (1, "a b"), (2, "b a")]
    segment = pi.Segment(next(iter(pi.index(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), folder(spark))
                                   .toPandas().to_dict("records"))))
    block = pi.Phrases([(b"a a a", "0"), (b"a b", "1"), (b"b a", "2")])
    got = sorted(zip(*(x.tolist() for x in pi.exact(segment, block)), strict=True))
    flat = ["a"] * 50 + ["b", "", "b", "a", "a", "a", "b"]
    wanted = sorted((k, s, s + len(p) - 1) for k, (_, t) in enumerate(items) for p in [t.split()]
                    for s in range(len(flat)) if flat[s:s + len(p)] == p)
    assert got == wanted


def test_odd_texts_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i % 97}" for i in range(5000))
    texts = [*ODD_TEXTS, long, long, "one two three four five six one two three four five six", "Don't STOP"]
    items = [(1, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"), (None, "don t stop"), (1, "éTÉ"), (7, None), (8, "..."),
             (9, "six one two three four five six one two three"), (9, "z" * 50_000), (10, "İstanbul")]
    docs = documents(spark, texts)
    repeated = docs.union(docs).union(docs.selectExpr("cast(null as long)", "text", "lang", "source", "n_chars"))
    given = [(r.doc_id, r.text) for r in repeated.collect()]
    assert run(spark, repeated, items) == brute(given, items, pi.WIDTH)


def test_empty_tables(spark):
    docs = documents(spark, ["a b", None])
    assert run(spark, docs, []) == [(0, 2, 0, []), (1, 0, 0, [])]
    assert run(spark, docs.limit(0), [(1, "a b")]) == []


def test_a_word_with_the_hash_of_another_is_no_match(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(pi, "span_hashes", lambda data, s, e: np.zeros(len(s), np.uint64))
    block = pi.Phrases([(b"a b", "0"), (b"b c", "1")])
    text = [b"a", b"b", b"x", b"b", b"c"]
    row = {"n_words": [5], "words": b"abxc", "sizes": np.ones(4, "<u4").tobytes(),
           "counts": np.array([1, 2, 1, 1], "<u4").tobytes(), "places": np.array([0, 1, 3, 2, 4], "<u2").tobytes(), "wide": False}
    got = sorted(zip(*(x.tolist() for x in pi.exact(pi.Segment(row), block)), strict=True))
    assert got == [(0, 0, 1), (1, 3, 4)] and text[1] == b"b"
