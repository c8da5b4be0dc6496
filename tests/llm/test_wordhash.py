"""Hashes of spans, and that equal hashes never stand for equal bytes."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from footfall.llm import setsketch, token_blocks, word_bpe, wordhash
from tests.llm.helpers import documents, folder

FLIP = str.maketrans("ab", "ba")


def thue_morse(n):
    """A word and its complement that polynomials modulo 2**64 can't tell apart."""
    x = "a"
    while len(x) < n:
        x += x.translate(FLIP)
    return x, x.translate(FLIP)


@pytest.mark.parametrize("n", [8, 64, 512, 1024, 2048, 4096])
def test_thue_morse_words_differ(n):
    data = np.frombuffer("".join(thue_morse(n)).encode(), np.uint8)
    h = wordhash.span_hashes(data, np.array([0, n]), np.array([n, 2 * n]))
    assert h[0] != h[1]


@pytest.mark.parametrize("classes", [1, 3, 1 << 62])
def test_distinct_spans_compares_bytes(classes):
    text = b" ".join([b"the", b"cat", b"", b"dog", b"z" * 600, b"z" * 600, b"z" * 601, b"catalogue", b"catalogues"] * 20)
    data = np.frombuffer(text, np.uint8)
    words = wordhash.find_words(data, np.array([0, len(data)]))
    h = wordhash.span_hashes(data, words.start, words.end) % np.uint64(classes)
    first, back = wordhash.distinct_spans(data, words.start, words.end, h)
    each = [data[s:e].tobytes() for s, e in zip(words.start, words.end, strict=True)]
    assert [each[first[i]] for i in back] == each
    assert len(first) == len(set(each)) and (np.diff(h[first].astype(object)) >= 0).all()


@pytest.mark.parametrize("n", [1024, 2048])
@pytest.mark.parametrize("parts", [1, 2])
def test_operators_tell_thue_morse_words_apart(spark, n, parts):
    a, b = thue_morse(n)
    texts = [f"{a} {b}", b, a, f"{b} {a} {b}"]
    docs = documents(spark, texts).repartition(parts).cache()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: bytes(r.ids) for r in word_bpe.encode(
        docs, public_tokenizers.path("word_bpe_49k.json"), folder(spark)).collect()}
    for i, t in enumerate(texts):
        assert ids[i] == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    read = {r.doc_id: bytes(r.ids) for r in token_blocks.read(
        token_blocks.write(docs, path, folder(spark)), path).collect()}
    for i, t in enumerate(texts):
        assert read[i] == np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes()
    groups = {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs, folder(spark)).collect()}
    assert groups == {0: 0, 1: 1, 2: 2, 3: 3}


def test_repeated_rows_on_the_patched_path(spark):
    texts = ["rareword one two", "rareword one two", "another unseen thing"] * 30
    docs = documents(spark, texts).selectExpr("cast(1 as long) as doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    got = word_bpe.encode(docs, path, folder(spark), head_bytes=1).collect()
    wanted = sorted(hashlib.sha256(np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()
                    for t in texts)
    assert sorted(hashlib.sha256(bytes(r.ids)).hexdigest() for r in got) == wanted


def test_rows_of_one_doc_id_are_dealt_to_many_tasks(spark):
    rows = documents(spark, [f"text number {i}" for i in range(2000)]).selectExpr(
        "case when doc_id < 1000 then 7 else doc_id end as doc_id", "text")
    key = "spark.sql.adaptive.coalescePartitions.enabled"     # else these few rows become one task
    spark.conf.set(key, "false")
    try:
        blocks = token_blocks.write(rows, public_tokenizers.path("byte_bpe_50k.json"), folder(spark))
    finally:
        spark.conf.set(key, "true")
    n = {}
    for r in blocks.select("part", "docs").collect():
        n[r.part] = n.get(r.part, 0) + sum(d.doc_id == 7 for d in r.docs)
    assert max(n.values()) < 600
