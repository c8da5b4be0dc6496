"""BPE encoding and decoding through a distinct-word table.

Texts are split into words in Spark, the distinct words are counted, and each
distinct word is encoded once by the tokenizers library. Ids come back to
the words by position. The most frequent words' ids, up to ``HEAD_BYTES`` of
hashes and ids, are broadcast; words beyond are joined by the word itself, with
(document, position) beside it, so hot words are never shuffled and rare ones
are never broadcast. Decoding joins ids with the vocabulary's pieces, whose
number bounds what each task holds.

A word here is a run without white space (U+0020, U+0009 to U+000D), cut once more where
an ASCII or Latin-1 letter is followed by an ASCII sign or digit. Both cuts are
token boundaries of the tokenizer's pattern (it has no token with a letter
before a sign, and drops white space), except inside special tokens: words that
hold ``<|`` are not cut. Words are lower-cased for A-Z and U+00C0 to U+00DE, as
the tokenizer's normalizer does with the whole text.

Defined results: null or empty text has no ids and decodes to empty text;
repeated rows are encoded each; extra columns are not needed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import extended, stored
from footfall.llm.toxicity import folded
from footfall.llm.wordhash import SPACE, chunks, distinct_spans, find_words, ragged, span_hashes

HEAD_BYTES = 64 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[0x21:0x7F] = True
_SIGN[_LETTER] = False


def words_of(column: pa.Array):
    """(first row, last row, lower-cased bytes, words, hashes) of chunks of texts."""
    for lo, hi, data, at in chunks(column):
        cut = np.zeros(len(data), dtype=bool)
        if len(data) > 1:
            ends = _LETTER[data[:-1]]
            second = np.flatnonzero(data[:-1] == 0xC3) + 1
            b = data[second]
            latin = second[(b != 0x97) & (b != 0xB7)]
            ends[latin[latin < len(ends)]] = True
            cut[1:] = ends & _SIGN[data[1:]]
            special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
            if len(special):
                whole = find_words(data, at)
                for i in np.unique(np.searchsorted(whole.start, special, side="right") - 1):
                    cut[whole.start[i]:whole.end[i]] = False
        words = find_words(data, at, SPACE, cut)
        low = folded(data)
        yield lo, hi, low, words, span_hashes(low, words.start, words.end)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, _, data, words, h in words_of(b["text"]):
            first, back = distinct_spans(data, words.start, words.end, h)
            n = np.bincount(back, minlength=len(first))
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[first].view(np.int64)),
                 pa.array([raw[s:e].decode() for s, e in zip(words.start[first].tolist(),
                                                              words.end[first].tolist(), strict=True)]),
                 pa.array(n)], names=["h", "word", "n"])


@cache
def load(path: str):
    """The tokenizer in the file, without truncation and padding; once for each process."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encode_words(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for b in batches:
            words = b["word"].to_pylist()
            ids = []
            for i in range(0, len(words), 2000):
                ids += [np.array(e.ids, "<u4").tobytes()
                        for e in tokenizer.encode_batch(words[i:i + 2000], add_special_tokens=False)]
            yield b.append_column("ids", pa.array(ids, pa.binary()))
    return run


def word_table(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """h, word, n (occurrences in all texts), ids: each distinct word once."""
    counted = (docs.select("text").mapInArrow(_distinct, "h long, word string, n long")
               .groupBy("h", "word").agg(F.sum("n").alias("n")))
    return stored(counted.mapInArrow(_encode_words(path), "h long, word string, n long, ids binary"),
                  f"{folder}/words")


class Head:
    """Hashes of frequent words, sorted, and their ids, in 16 bits where those suffice."""

    def __init__(self, h: np.ndarray, at: np.ndarray, ids: np.ndarray):
        self.h, self.at = h, at.astype(np.uint32)          # n + 1 offsets of ids
        self.ids = ids.astype(np.uint16) if not len(ids) or ids.max() < 1 << 16 else ids

    def sizes(self, places: np.ndarray) -> np.ndarray:
        return (self.at[places + 1] - self.at[places]).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes, -1 for those that are not here."""
        if not len(self.h):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return np.where(self.h[at] == h, at, -1)


def choose_head(words: DataFrame, head_bytes: int = HEAD_BYTES) -> tuple[Head, bool]:
    """The most frequent words that fit into ``head_bytes``, and whether those are all."""
    # counts in at most 64 + 8 * 58 classes, so what is collected is bounded
    rank = F.when(F.col("n") <= 64, F.col("n")).otherwise(F.floor(8 * F.log2("n")) + 64)
    clash = words.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    ranked = words.withColumn("rank", rank)
    per_rank = ranked.groupBy("rank").agg(F.sum(F.length("ids") / 2 + 12).alias("bytes")).collect()
    total, least = 0, None
    for r in sorted(per_rank, key=lambda r: -r["rank"]):
        total += r["bytes"]
        if total > head_bytes:
            break
        least = r["rank"]
    whole = total <= head_bytes
    if least is None:
        return Head(np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint32)), not per_rank
    clashing = [r.h for r in clash.limit(10_000).collect()]    # two words of one hash: practically none
    if len(clashing) == 10_000:
        raise ValueError("word hashes clash; the head cannot be keyed by them")
    got = ranked.where(F.col("rank") >= least).select("h", "ids").toArrow()
    h = got["h"].to_numpy().view(np.uint64)
    keep = ~np.isin(h, np.array(clashing, np.int64).view(np.uint64))
    order = np.flatnonzero(keep)[np.argsort(h[keep], kind="stable")]
    ids = got["ids"].combine_chunks().cast(pa.large_binary()).take(pa.array(order))
    at = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
    flat = np.frombuffer(ids.buffers()[2].slice(int(at[0]), int(at[-1] - at[0])).to_pybytes(), np.uint32)
    return Head(h[order], (at - at[0]) // 4, flat), whole and not clashing


@cache
def _pieces(path: str) -> dict[int, str] | list[str]:
    """The vocabulary's pieces by id, which bounds what a task holds."""
    tokenizer = load(path)
    if json.loads(tokenizer.to_str()).get("decoder"):
        raise ValueError("only tokenizers without a decoder of their own are decoded here")
    pieces = {i: p for p, i in tokenizer.get_vocab(with_added_tokens=True).items()}
    return [pieces[i] for i in range(len(pieces))] if sorted(pieces) == list(range(len(pieces))) else pieces


def _joined(path: str, ids: list[bytes | None]) -> pa.Array:
    """The texts of ids, by a join with the pieces."""
    pieces = _pieces(path)
    return pa.array([" ".join([pieces[x] for x in np.frombuffer(i or b"", "<u4").tolist()]) for i in ids], pa.string())


def _encoder(held, patched: bool, decode_by: str | None):
    """Ids of texts from the head and, where given, from patches by position; with
    ``decode_by``, their texts as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = held.value
        for b in batches:
            for lo, hi, _, words, h in words_of(b["text"]):
                u, back = np.unique(h, return_inverse=True)
                place = head.find(u)[back]
                known = np.flatnonzero(place >= 0)
                sizes = np.zeros(len(place), np.int64)
                sizes[known] = head.sizes(place[known])
                extra: dict[int, np.ndarray] = {}
                if patched:
                    for i in range(hi - lo):
                        for p in b["patch"][lo + i].as_py() or ():
                            extra[int(words.row[i]) + p["pos"]] = np.frombuffer(p["ids"], np.uint32)
                    for w, x in extra.items():
                        sizes[w] = len(x)
                elif (place < 0).any():
                    raise ValueError("a word is missing in the distinct-word table")
                ids = np.zeros(int(sizes.sum()), np.uint32)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                spread = ragged(ends[known], sizes[known]) if extra else slice(None)
                ids[spread] = head.ids[ragged(head.at[place[known]].astype(np.int64), sizes[known])] if len(known) else 0
                for w, x in extra.items():
                    ids[ends[w]:ends[w + 1]] = x
                at = ends[words.row].tolist()
                raw = ids.astype("<u4").tobytes()
                parts = [raw[4 * at[i]:4 * at[i + 1]] for i in range(hi - lo)]
                out = pa.RecordBatch.from_arrays([b["doc_id"].slice(lo, hi - lo), pa.array(parts, pa.binary())],
                                                 names=["doc_id", "ids"])
                yield out.append_column("decoded", _joined(decode_by, parts)) if decode_by else out
    return run


def _beyond(held):
    """(key of the text, position, word) of words that are not in the head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = held.value
        for b in batches:
            for lo, _, data, words, h in words_of(b["text"]):
                u, back = np.unique(h, return_inverse=True)
                at = np.flatnonzero((head.find(u) < 0)[back])
                row = np.searchsorted(words.row, at, side="right") - 1
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b["k1"].take(pa.array(row + lo)), b["k2"].take(pa.array(row + lo)),
                     pa.array((at - words.row[row]).astype(np.int32)),
                     pa.array([raw[s:e].decode() for s, e in zip(words.start[at].tolist(),
                                                                  words.end[at].tolist(), strict=True)],
                              pa.string())], names=["k1", "k2", "pos", "word"])
    return run


def encode(docs: DataFrame, path: str, folder: str, head_bytes: int = HEAD_BYTES,
           decoded: bool = False) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), one row for each row; with
    ``decoded``, also what ``decode`` adds, in the same pass (one Python worker a task)."""
    docs = docs.select("doc_id", "text")
    words = word_table(docs, path, folder)
    head, whole = choose_head(words, head_bytes)
    held = docs.sparkSession.sparkContext.broadcast(head)
    schema = extended(docs.select("doc_id").schema, "ids", "binary")
    schema, decode_by = (extended(schema, "decoded", "string"), path) if decoded else (schema, None)
    if whole:
        return docs.mapInArrow(_encoder(held, False, decode_by), schema)
    # rows are told apart by their text as well, should a doc_id repeat
    k1 = F.xxhash64("doc_id", "text").alias("k1")
    k2 = F.xxhash64(F.lit(1), "text", "doc_id").alias("k2")
    rare = docs.select("text", k1, k2).mapInArrow(
        _beyond(held), "k1 long, k2 long, pos int, word string").dropDuplicates(["k1", "k2", "pos"])
    patches = (rare.join(words.select("word", "ids"), "word").groupBy("k1", "k2")
               .agg(F.collect_list(F.struct("pos", "ids")).alias("patch")))
    return docs.select("doc_id", "text", k1, k2).join(patches, ["k1", "k2"], "left") \
        .select("doc_id", "text", "patch").mapInArrow(_encoder(held, True, decode_by), schema)


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                yield part.append_column("decoded", _joined(path, part["ids"].to_pylist()))
    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds the column decoded to a table with the column ids."""
    return encoded.mapInArrow(_decoder(path), extended(encoded.schema, "decoded", "string"))
