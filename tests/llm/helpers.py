"""Fixtures and plain-Python versions of the operators' contracts."""

from __future__ import annotations

import re
import uuid

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

ODD_TEXTS = [None, "", " ", "\n\n", "a", "a b c", "a b c d", "A B C D", "a b c d", "\x0b\x0c x\ty\r\n",
             "don't (stop) 12.5% — \u00c9t\u00e9 \u00df\u00d7 e\u0301 \u4e2d\u6587 \U0001f600 \u00a0x\u2003y\x85z\x1cw",
             "x<|endoftext|> y <|startoftext|>z <| q", "\u0130stanbul \u03a3\u039f\u03a3 \ufb01n",
             "word " * 3000, "z" * 50_000, ("one two three four five six\n" * 40)]


def documents(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def folder(spark):
    from footfall.session import shared_dir
    return shared_dir(spark, "tests", uuid.uuid4().hex[:12])


def shingles(text, width):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}


def components(texts: dict, width=4, percent=80):
    """Smallest reachable doc_id of each document, by comparing all pairs that share a shingle."""
    sets = {i: shingles(t, width) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders: dict = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    seen = set()
    for group in holders.values():
        for a in group:
            for b in group:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    x, y = sets[a], sets[b]
                    if 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                        both = len(x & y)
                        if 100 * both >= percent * (len(x) + len(y) - both):
                            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in texts}, {i: len(s) for i, s in sets.items()}
