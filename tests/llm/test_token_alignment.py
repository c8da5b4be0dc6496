"""Alignments against the tokenizers' own encodings of whole texts."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from footfall.llm import token_alignment as ta
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD_TEXTS, documents, folder

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
POOL = ["a", "é", "中", "😀", " ", "  ", "\n", "\t", " ", " ", "　", "▁", "x1", "'s", "<s>", "</s>", "<|endoftext|>",
        "<unk>", "\r\n", "\x00", "ﬁ", "\x85", "\x1c", "<0x41>", "don", "​", "﻿", "..", " the"]


@cache
def plain():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in printable]
    names = {chr(x): x for x in printable} | {chr(0x100 + i): x for i, x in enumerate(others)}
    a_bytes = {i: bytes(names[c] for c in p) for p, i in a.get_vocab().items()}
    b_bytes = {}
    for i in range(b.get_piece_size()):
        p = b.id_to_piece(i)
        m = re.fullmatch("<0x(..)>", p)
        b_bytes[i] = bytes.fromhex(m[1]) if m else p.replace("▁", " ").encode()
    return a, b, a_bytes, b_bytes


def overlaps(x, y):
    """Places of overlapping ranges, and groups between common ends."""
    start_x, start_y = [0, *x[:-1]], [0, *y[:-1]]
    links, j = [], 0
    for i in range(len(x)):
        while y[j] <= start_x[i]:
            j += 1
        k = j
        while k < len(y) and start_y[k] < x[i]:
            links.append((i, k))
            k += 1
    return links


def brute(texts):
    a, b, a_bytes, b_bytes = plain()
    rows = []
    for t in texts:
        rows.append(None)
        if t:
            x, y, raw = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t), (" " + t).encode()
            if b"".join(a_bytes[i] for i in x) == raw == b"".join(b_bytes[i] for i in y):
                ends = [np.cumsum([len(a_bytes[i]) for i in x]).tolist(), np.cumsum([len(b_bytes[i]) for i in y]).tolist()]
                place = [{e: i + 1 for i, e in enumerate(z)} for z in ends]
                groups, i, j = [], 0, 0
                for e in sorted(set(ends[0]) & set(ends[1])):
                    groups.append((x[i:place[0][e]], y[j:place[1][e]]))
                    i, j = place[0][e], place[1][e]
                rows[-1] = len(x), len(y), groups, [(x[i], y[k]) for i, k in overlaps(*ends)]
    held = Counter(p for r in rows if r for p in set(r[3]))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = {}
    for i, r in enumerate(rows):
        out[i] = (0, 0, 0, 0, 0, 0, "")
        if r:
            text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in r[2])
            out[i] = (r[0], r[1], len(r[2]), len(r[3]), sum(held[p] == best[p[0]] for p in r[3]),
                      sum(held[p] for p in r[3]), hashlib.sha256(text.encode()).hexdigest())
    return out


def digests(spark, docs, head=ta.HEAD):
    f = folder(spark)
    aligned = ta.align(docs, A, B, f)
    return ta.digests(aligned, ta.link_counts(aligned, f), f, head)


@pytest.mark.parametrize("share", [0.02, 0.2, 0.6, 1.0])
def test_cells_are_the_common_refinement(share):
    rng = random.Random(7)
    for n in [1, 2, 3, 10, 200] * 40:
        base = sorted(rng.sample(range(1, 4 * n + 1), n))
        a, b = (sorted({x for x in base if rng.random() > share / 2} | {base[-1]}) for _ in "ab")
        cells = ta.aligned_cells(np.array(a), np.array(b)).tolist()
        assert cells == [(e in a) + 2 * (e in b) for e in sorted({*a, *b})]
        common = sorted(set(rng.sample(sorted({*a} & {*b}), k=1)) | {0, a[-1]})        # walked along in stretches
        cuts = [np.array([0, *(x.index(e) + 1 for e in common[1:])]) for x in (a, b)]
        assert ta.aligned_cells(np.array(a), np.array(b), tuple(cuts)).tolist() == cells
    assert len(ta.aligned_cells(np.zeros(0, int), np.zeros(0, int))) == 0


@pytest.mark.parametrize("head", [ta.HEAD, 200])
def test_against_whole_encodings(spark, head):
    rng = random.Random(3)
    own = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts = [*own, *ODD_TEXTS, "a ", " ", "  ", " a", " a ", "▁", "a▁ b", "x x  y"]
    texts += ["".join(rng.choices(POOL, k=rng.choice([1, 2, 3, 8, 30]))) for _ in range(800)]
    wanted = brute(texts)
    got = {r.doc_id: tuple(r)[1:] for r in digests(spark, documents(spark, texts), head).collect()}
    assert got == wanted
    assert 20 < sum(v[0] == 0 for v in wanted.values()) < len(texts) / 2


def test_repeated_rows_null_ids_and_empty_tables(spark):
    docs = documents(spark, ["one two", "one two", None]).selectExpr("cast(null as long) as doc_id", "text", "lang as row")
    rows = digests(spark, docs).collect()
    assert len(rows) == 3 and {r.doc_id for r in rows} == {None}
    assert sorted((r.n_links, r.count_sum) for r in rows) == [(0, 0), (2, 4), (2, 4)]
    assert digests(spark, docs.limit(0)).count() == 0


def test_forgetting_units_changes_nothing(spark, monkeypatch):
    texts = [f"word{i} and more {i}" for i in range(50)] + ["a▁b c", "plain text"]
    both = ta.Tokenizers(A, B)
    raws = [(" " + t).encode() for t in texts]
    wanted = both.tokens(raws, list(range(len(raws))))
    monkeypatch.setattr(ta, "UNITS", 3)
    for i, r in enumerate(raws):
        rows, (a, b) = both.tokens([r], [i])
        if len(rows):
            k = wanted[0].tolist().index(i)
            for one, every in ((a, wanted[1][0]), (b, wanted[1][1])):
                assert one[0].tolist() == every[0][every[1][k]:every[1][k + 1]].tolist()
        else:
            assert i not in wanted[0]
