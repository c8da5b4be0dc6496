"""Fill-in-middle against lists of units."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from footfall.llm import fill_middle as fim
from footfall.llm.wordhash import chunks
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD_TEXTS, documents

MARKED = ["a <P> b", "<S>", "x<M", "<P><S><M>", "<", "ab<cd", "<<<<", "P><S", "x>" * 900]


def plain(doc_id, text):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "")
    n = len(units)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text or ""
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_every_unit(seed):
    rng = random.Random(seed)
    for size in [0, 1, 2, 7, 8, 9, 255, 256, 257, 1000]:
        text = "".join(rng.choice(["abc XYZ", "é中😀\n ", "aA", "é"][seed % 4]) for _ in range(size))
        for _, _, data, at in chunks(pa.array([text])):
            tree = fim.BlockTree(*fim.unit_starts(data, at), block=8)
            units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
            assert (tree.total(), tree.total(1)) == (len(units), len(text))
            for k in range(len(units) + 1):
                before = "".join(units[:k])
                assert tree.place(k) == (len(before.encode()), len(before))


def check(docs):
    out = fim.transform(docs)
    rows = out.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
                      fim.restored(F.col("output"), F.col("form")).alias("restored")).collect()
    given = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(str, ((d, *plain(d, t), t or "") for d, t in given))) == sorted(map(str, map(tuple, rows)))
    return rows


def test_against_lists_of_units(spark):
    rng = random.Random(1)
    texts = [*ODD_TEXTS, *MARKED] * 6 + ["".join(rng.choice("ab <>PSM\né中😀") for _ in range(rng.choice([3, 40, 900])))
                                         for _ in range(300)]
    rows = check(documents(spark, texts))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_whole_table_and_its_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    check(docs.union(docs.limit(20)))


def test_null_ids_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "one two three", 1, "x"), (5, None, 2, None), (5, "a b", None, "y")],
                                 "doc_id long, text string, n long, form string")
    check(docs)
    out = fim.transform(docs)
    assert sorted(r.row.form or "" for r in out.collect()) == ["", "x", "y"]
    assert fim.transform(docs.limit(0)).count() == 0


def test_draws_are_those_of_the_seed():
    assert fim.draws(3) == fim.draws("3") != fim.draws(3, seed=2)
    assert np.array(fim.draws(None)).max() < 1 << 32
