import public_tokenizers
import pytest

from footfall.llm import word_bpe
from footfall.llm.tables import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD_TEXTS, documents, folder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("head_bytes", [1 << 26, 1 << 14, 0])
def test_ids_and_text_equal_the_library(spark, head_bytes):
    tokenizer = word_bpe.load(PATH)
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").union(
        documents(spark, ODD_TEXTS + ODD_TEXTS, first=10**6).select("doc_id", "text"))
    out = word_bpe.decode(word_bpe.encode(docs, PATH, folder(spark), head_bytes), PATH)
    got = {r.doc_id: (r.ids, r.decoded) for r in out.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert [int.from_bytes(got[i][0][k:k + 4], "little") for k in range(0, len(got[i][0]), 4)] == ids, text
        assert got[i][1] == tokenizer.decode(ids, skip_special_tokens=False)


def test_decoding_in_the_same_pass(spark):
    docs = documents(spark, ODD_TEXTS)
    two = word_bpe.decode(word_bpe.encode(docs, PATH, folder(spark)), PATH)
    one = word_bpe.encode(docs, PATH, folder(spark), decoded=True)
    assert one.columns == two.columns and sorted(one.collect()) == sorted(two.collect())


def test_empty_table_and_repeated_ids(spark):
    docs = documents(spark, ["a b", "c"]).selectExpr("1L as doc_id", "text", "5 as ids", "6 as word")
    assert word_bpe.encode(docs.limit(0), PATH, folder(spark)).count() == 0
    for head in (0, 1 << 20):
        out = word_bpe.decode(word_bpe.encode(docs, PATH, folder(spark), head), PATH)
        assert sorted(r.decoded for r in out.collect()) == ["a</w> b</w>", "c</w>"]
