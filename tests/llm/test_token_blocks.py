import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import token_blocks as tb
from footfall.llm.tables import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD_TEXTS, documents, folder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def round_trip(blocks, bits):
    coded = tb.encode_blocks(blocks, bits)
    found = tb.decode_blocks(coded, [len(b) for b in blocks], bits)
    for a, b in zip(blocks, found, strict=True):
        assert (a == b).all()
    return sum(map(len, coded))


@given(st.lists(st.lists(st.integers(0, 70) | st.integers(0, (1 << 16) - 1), min_size=1, max_size=60),
                min_size=1, max_size=9))
@settings(max_examples=60, deadline=None)
def test_round_trip_of_any_ids(blocks):
    round_trip([np.array(b) for b in blocks], 16)


def test_round_trip_of_long_blocks_and_their_size():
    rng = np.random.default_rng(2)
    zipf = [np.minimum(rng.zipf(1.4, n), 50_000) for n in (tb.BLOCK, tb.BLOCK, 700, 1)]
    flat = [rng.integers(0, 1 << 24, tb.BLOCK), np.zeros(tb.BLOCK, np.int64), np.arange(tb.BLOCK) % 9]
    assert round_trip(zipf, 16) < 0.7 * 2 * sum(map(len, zipf))
    round_trip(flat, 24)
    assert round_trip([flat[1]], 24) < 100 and round_trip([flat[2]], 24) < 300


TRICKY = ["a  b", " a", "a ", "\n a \n\nb", "x\n<|endoftext|> y", "a<|endoftext|>b", "don't,'s 'll", "café, Ã !",
          "a  b", "  x", "a\r\nb", "a\tb c", "1a2 b3", "×a÷.", "é. x", "中文, ok\nnew été\nÉ"]


def want(docs, end=0):
    tokenizer = tb.load(PATH)
    start, out = 0, {}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, end]
        out[r.doc_id] = (start, ids)
        start += len(ids)
    return out


def test_files_hold_the_library_s_ids(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").union(
        documents(spark, ODD_TEXTS + TRICKY, first=10**6).select("doc_id", "text")).repartition(5)
    blocks = tb.write(docs, PATH, folder(spark))
    got = {r.doc_id: (r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in tb.read(blocks, PATH).collect()}
    assert got == want(docs)
    sizes = blocks.selectExpr("sum(length(payload)) coded", "2 * sum(n_ids) plain", "max(n_ids) most").first()
    assert sizes.most <= tb.BLOCK and sizes.coded < sizes.plain


def test_query_columns(spark):
    from footfall.llm.queries import op3_token_blocks
    rows = op3_token_blocks(spark, SF_SMALL).collect()
    full = want(table(spark, SF_SMALL, "documents"))
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == \
        {i: (s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, (s, x) in full.items()}


def test_edges(spark):
    docs = spark.createDataFrame([(None, "a"), (2, None), (2, "b"), (2, "b")], "doc_id long, text string")
    blocks = tb.write(docs.selectExpr("*", "1 as part", "2 as ids"), PATH, folder(spark))
    got = sorted((r.start, r.doc_id, len(r.ids) // 4) for r in tb.read(blocks, PATH).collect())
    assert got == [(0, None, 2), (2, 2, 1), (3, 2, 2), (5, 2, 2)]
    assert tb.read(tb.write(docs.limit(0), PATH, folder(spark)), PATH).count() == 0


def test_damage_is_noticed(spark):
    blocks = tb.write(documents(spark, ["some words here " * 40]), PATH, folder(spark))
    bad = blocks.selectExpr("part", "block", "start", "n_ids", "docs",
                            "unhex(concat('ffff', substring(hex(payload), 5))) as payload", "crc")
    with pytest.raises(Exception, match="checksum|PythonException|out of bounds"):
        tb.read(bad, PATH).collect()


def test_payloads_stay_as_they_were_written():
    """Checksums of payloads coded before places were 64-bit: files written then can be read."""
    rng = np.random.default_rng(5)
    blocks = [np.arange(tb.BLOCK) % 9, np.minimum(rng.zipf(1.4, 900), 50_000), rng.integers(0, 50_000, 300), [7]]
    coded = tb.encode_blocks([np.array(b) for b in blocks], 16)
    assert [zlib.crc32(c) for c in coded] == [4226344463, 690133023, 1664357858, 604861660]


def test_reader_gathers_batches_before_it_decodes(monkeypatch):
    import pyarrow as pa
    calls = []
    decode = tb.decode_blocks
    monkeypatch.setattr(tb, "decode_blocks", lambda p, n, bits: calls.append(len(p)) or decode(p, n, bits))
    monkeypatch.setattr(tb, "TOGETHER", 5)
    ids = [np.arange(i, i + 4) for i in range(12)]
    rows = [{"part": 0, "block": i, "start": 4 * i, "n_ids": 4,
             "docs": [{"no": i, "doc_id": i, "n": 4, "whole": True}], "payload": p,
             "crc": zlib.crc32(x.astype("<u4").tobytes())}
            for i, (x, p) in enumerate(zip(ids, tb.encode_blocks(ids, 16), strict=True))]
    batches = pa.Table.from_pylist(rows).to_batches(max_chunksize=2)
    out = pa.Table.from_batches(tb._reader(16, {0: 100})(iter(batches))).to_pylist()
    assert calls == [5, 5, 2]
    assert [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in out] == \
        [(i, 100 + 4 * i, x.tolist()) for i, x in enumerate(ids)]


def through_files(monkeypatch, docs, together=4_096, batch=1_000):
    """Documents through one task of the writer and of the reader, without Spark."""
    from types import SimpleNamespace

    import pyarrow as pa
    monkeypatch.setattr(tb, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    monkeypatch.setattr(tb, "TOGETHER", together)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    rows = pa.Table.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs], pa.string())],
                                schema=schema)
    blocks = pa.Table.from_batches(tb._writer(PATH, 0, tb.id_bits(PATH))(iter(rows.to_batches(max_chunksize=batch))))
    read = tb._reader(tb.id_bits(PATH), {0: 0})(iter(blocks.combine_chunks().to_batches(max_chunksize=3)))
    return blocks, pa.Table.from_batches(read)


def test_blocks_coded_in_the_middle_of_a_batch(monkeypatch):
    tokenizer = tb.load(PATH)
    docs = [(None if i == 3 else i, None if i == 5 else f"document {i} " * (1 + 7919 * i % 1500)) for i in range(40)]
    blocks, read = through_files(monkeypatch, docs, together=2, batch=11)
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, t in docs]
    starts = np.cumsum([0, *map(len, ids)])
    pieces = [(i, docs[i][0], int(starts[i]) + j, x[j:j + tb.BLOCK])
              for i, x in enumerate(ids) for j in range(0, len(x), tb.BLOCK)]
    assert any(len(x) > tb.BLOCK for x in ids) and blocks.num_rows > 10
    assert blocks["block"].to_pylist() == list(range(blocks.num_rows))
    assert [(r["no"], r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist())
            for r in read.to_pylist()] == pieces


def test_tasks_hold_no_object_for_each_document(monkeypatch):
    """Short rows, as in check_h: 60,000 documents took 50 MB and more as dictionaries."""
    import tracemalloc
    docs = [(i, "so") for i in range(60_000)]
    through_files(monkeypatch, docs[:10])
    most = []
    for name in ("_writer", "_reader"):
        plain = getattr(tb, name)

        def measured(*args, plain=plain):
            def run(batches):
                held = list(batches)
                tracemalloc.start()
                out = list(plain(*args)(iter(held)))
                most.append(tracemalloc.get_traced_memory()[1])
                tracemalloc.stop()
                return iter(out)
            return run
        monkeypatch.setattr(tb, name, measured)
    _, read = through_files(monkeypatch, docs)
    assert read.num_rows == len(docs) and max(most) < 20 << 20, most


def test_a_worker_keeps_known_pieces(monkeypatch):
    docs = [(i, f"keptpiece{chr(97 + i)} again") for i in range(20)]
    through_files(monkeypatch, docs)
    monkeypatch.setattr(tb._Encoder, "pieces", lambda self, raw: pytest.fail(f"encoded again: {raw}"))
    through_files(monkeypatch, docs)


def test_end_id_beyond_the_tokenizer_s_bits(spark):
    with pytest.raises(ValueError, match="end id"):
        tb.write(documents(spark, ["a"]), PATH, folder(spark), end_id=1 << 20)


def test_new_pieces_are_encoded_in_bulk():
    """Pieces of letters go to the model, others to the whole encoder, and come back in their order."""
    raw = [p.encode() for p in ("é", " é", " ", "a", " a", "ªb", " µ", "ŉo", " ſtraße", "×", " ÷a", "don't", " 'll", "ƀa",
                                " Ångström", "\n", "  ", "x1", "<|endoftext|>", " wordword", "中文", "aé×", " Žižek")]
    raw *= 400
    ids, sizes = tb._Encoder(PATH).pieces(raw)
    whole = [tb.load(PATH).encode(p.decode(), add_special_tokens=False).ids for p in raw]
    assert sizes.tolist() == [len(x) for x in whole] and ids.tolist() == [i for x in whole for i in x]


def test_a_worker_s_known_pieces_outlast_many_tasks():
    """Of 600,000 pieces of three ids none is forgotten: a task of 17 MB brings 70,000 to 290,000 new ones."""
    known, n = tb._Known(), 600_000
    h = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    raw = [b"%07d" % i for i in range(n)]
    known.add(h, raw, np.zeros(3 * n, np.uint32), np.full(n, 3))
    assert not known.full()
    data = np.frombuffer(b"".join(raw), np.uint8)
    at = 7 * np.arange(n)
    assert (known.find(h, data, at, at + 7) == np.arange(n)).mean() > 0.999


def test_reader_keeps_no_places_of_ids():
    import tracemalloc
    blocks = [np.array([i, 7, i]) for i in range(1_024)]
    coded = tb.encode_blocks(blocks, 16)
    tracemalloc.start()
    found = tb.decode_blocks(coded, [3] * len(blocks), 16)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all((a == b).all() for a, b in zip(blocks, found, strict=True))
    assert most < 20 << 20, most
