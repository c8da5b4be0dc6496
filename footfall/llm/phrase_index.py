"""Benchmark decontamination by a distributed positional inverted index.

``index`` writes the training documents' index: a row for each segment of whole
documents (about ``SEGMENT`` bytes of text; a longer document is a segment of its
own) with the segment's distinct words, each word's posting list of positions,
and its documents. A segment is built inside one task from texts that are
together anyway, so nothing is shuffled, a word as frequent as one likes is
spread over all segments, and a lost executor costs its segments alone.

``phrases`` lists a test set's windows of ``WIDTH`` consecutive words (an item of
fewer is one window). They are dealt to blocks of at most ``BLOCK_ROWS`` rows, and each
block is sent to every segment. There each window's terms are looked up in the
dictionary of the segment, byte for byte; windows with a term that the segment lacks are
done with. The others start from the postings of their rarest term, shifted by its offset in the
window, and intersect them with the shifted list of the next rarer term and so on, all
windows of a segment together and ``CANDIDATES`` positions at a time. What is left are
the places of exact phrases (``matches``). ``proximity`` finds, for each place of a
window's first term, the shortest span in which the others follow it in order, with
at most ``slop`` foreign words in between; only first terms with the window's rarest term near
them are followed.

Words are runs of ASCII letters and digits and of code points beyond ASCII, with A-Z
lower-cased. Positions of documents of one segment have a gap between them, so no
phrase lies across two documents.

Defined results: null and empty texts have no words; an item without words has no
windows; items that share an item_id count as one, a null item_id as the empty
name; each row of the documents is one of its own, also where a doc_id repeats or is
null; other columns are not read; empty tables give no rows or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import stored
from footfall.llm.wordhash import FOLD, chunks, distinct_spans, find_words, ragged, same_spans, span_hashes

WIDTH = 10
SEGMENT = 1 << 18              # bytes of text
BLOCK_ROWS = 200_000           # (window, item) rows that are sent to the segments at once
CANDIDATES = 1 << 20           # places that are intersected at once
SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_SEGMENTS = ("segment long, doc_ids array<long>, n_words array<int>, words binary, sizes binary, "
             "counts binary, places binary, wide boolean")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for b in batches:
        for lo, hi, data, at in chunks(b["text"], SEGMENT):
            data = FOLD[data]
            words = find_words(data, at, SEPARATOR)
            h = span_hashes(data, words.start, words.end)
            first, back = distinct_spans(data, words.start, words.end, h)
            n = words.counts()
            place = np.arange(len(h)) + np.repeat(np.arange(len(n)), n)     # a gap before each document
            order = np.argsort(back, kind="stable")
            size = words.end[first] - words.start[first]
            wide = len(h) + len(n) >= 1 << 16
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([b["doc_id"].slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                 pa.array([n.tolist()], pa.list_(pa.int32())),
                 pa.array([data[ragged(words.start[first], size)].tobytes()], pa.binary()),
                 pa.array([size.astype("<u4").tobytes()], pa.binary()),
                 pa.array([np.bincount(back, minlength=len(first)).astype("<u4").tobytes()], pa.binary()),
                 pa.array([place[order].astype("<u4" if wide else "<u2").tobytes()], pa.binary()),
                 pa.array([wide])],
                names=["segment", "doc_ids", "n_words", "words", "sizes", "counts", "places", "wide"])
            number += 1


def index(docs: DataFrame, folder: str) -> DataFrame:
    """The stored index of the documents (columns doc_id and text)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(source.mapInArrow(_segments, _SEGMENTS), f"{folder}/index")


def _edges(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


class Segment:
    """A segment's dictionary and posting lists."""

    def __init__(self, row: dict):
        self.n_words = np.array(row["n_words"], np.int64)
        self.data = np.frombuffer(row["words"], np.uint8)
        edges = _edges(np.frombuffer(row["sizes"], "<u4"))
        self.start, self.end = edges[:-1], edges[1:]
        self.h = span_hashes(self.data, self.start, self.end)             # ascending, as written
        self.list = _edges(np.frombuffer(row["counts"], "<u4"))
        self.places = np.frombuffer(row["places"], "<u4" if row["wide"] else "<u2").astype(np.int64)
        self.doc_start = _edges(self.n_words + 1)[:-1]                    # place of each document's first word
        self.room = int(self.n_words.sum()) + len(self.n_words) + 1
        # every posting as (term, place) in one ascending array
        self.keys = np.repeat(np.arange(len(self.h)), np.diff(self.list)) * self.room + self.places

    def find(self, terms: "Terms") -> np.ndarray:
        """Numbers of the terms in this dictionary, -1 for those it lacks."""
        out = np.full(len(terms.h), -1)
        low = np.searchsorted(self.h, terms.h)
        live = np.arange(len(terms.h))
        while len(live):                     # words of one hash are neighbours
            live = live[low[live] < len(self.h)]
            live = live[self.h[low[live]] == terms.h[live]]
            at = low[live]
            same = same_spans(self.data, self.start[at], self.end[at], terms.data, terms.start[live], terms.end[live])
            out[live[same]] = at[same]
            live = live[~same]
            low[live] += 1
        return out

    def count(self, term: np.ndarray) -> np.ndarray:
        return self.list[term + 1] - self.list[term]

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether the term stands at the place, for each pair."""
        key = term * self.room + place
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (place >= 0) & (place < self.room) & (self.keys[at] == key)

    def following(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The first place of the term behind each place, -1 if there is none."""
        at = np.searchsorted(self.keys, term * self.room + place, side="right")
        inside = at < self.list[term + 1]
        return np.where(inside, self.keys[np.minimum(at, len(self.keys) - 1)] - term * self.room, -1)

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_start, place, side="right") - 1


class Terms:
    """Distinct words: their bytes and hashes."""

    def __init__(self, words: list[bytes]):
        self.data = np.frombuffer(b"".join(words), np.uint8)
        edges = _edges(np.array([len(w) for w in words], np.int64))
        self.start, self.end = edges[:-1], edges[1:]
        self.h = span_hashes(self.data, self.start, self.end)


class Phrases:
    """A block of windows: their terms by number (-1 behind the last), and their items."""

    def __init__(self, rows: list[tuple[bytes, str]]):
        windows: dict[bytes, list[int]] = {}
        items: dict[str, int] = {}
        for phrase, item in rows:
            windows.setdefault(phrase, []).append(items.setdefault(item, len(items)))
        words: dict[bytes, int] = {}
        split = [[words.setdefault(w, len(words)) for w in p.split(b" ")] for p in windows]
        self.width = np.array([len(s) for s in split], np.int64)
        self.terms = np.full((len(split), max(map(len, split), default=1)), -1)
        for i, s in enumerate(split):
            self.terms[i, :len(s)] = s
        self.item_names = list(items)
        self.items = np.array([i for x in windows.values() for i in x], np.int64)
        self.item_at = _edges(np.array([len(x) for x in windows.values()], np.int64))
        self.words = Terms(list(words))

    def items_of(self, windows: np.ndarray) -> list[str]:
        """Names of the items that have any of the windows."""
        at = self.item_at[windows]
        return [self.item_names[i] for i in np.unique(self.items[ragged(at, self.item_at[windows + 1] - at)])]

    def present(self, segment: Segment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of whose terms the segment lacks none, their terms by its numbers, and
        the offsets from the rarest term to the most frequent one."""
        number = segment.find(self.words)
        live = np.flatnonzero(((number[self.terms] >= 0) | (self.terms < 0)).all(axis=1))
        own = np.where(self.terms[live] >= 0, number[self.terms[live]], -1)
        frequency = np.where(own >= 0, segment.count(own), np.iinfo(np.int64).max)
        return live, own, np.argsort(frequency, axis=1, kind="stable")


def _portions(n: np.ndarray) -> Iterator[slice]:
    """Slices of neighbours with about ``CANDIDATES`` in sum, one at least."""
    ends, low = np.cumsum(n), 0
    while low < len(n):
        high = int(np.searchsorted(ends, (ends[low - 1] if low else 0) + CANDIDATES, side="right"))
        yield slice(low, max(high, low + 1))
        low = max(high, low + 1)


def exact(segment: Segment, block: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, first place, last place) of each occurrence of a window."""
    live, own, order = block.present(segment)
    rows = np.arange(len(live))
    n = segment.count(own[rows, order[:, 0]])
    found = []
    for some in _portions(n):
        row, offset = rows[some], order[some, 0]
        term = own[row, offset]
        which = np.repeat(row, n[some])
        start = segment.places[ragged(segment.list[term], n[some])] - np.repeat(offset, n[some])
        for k in range(1, own.shape[1]):
            offset = order[which, k]
            term = own[which, offset]
            keep = (term < 0) | segment.has(np.maximum(term, 0), start + offset)
            which, start = which[keep], start[keep]
        found.append((which, start))
    which, start = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (rows, rows)
    keep = start >= 0
    window = live[which[keep]]
    return window, start[keep], start[keep] + block.width[window] - 1


def ordered(segment: Segment, block: Phrases, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, first place, last place) of the shortest span from each place of a window's
    first term in which its terms follow each other, with at most ``slop`` others."""
    live, own, order = block.present(segment)
    rows = np.arange(len(live))
    n = segment.count(own[:, 0]) if len(live) else rows
    found = []
    for some in _portions(n):
        which = np.repeat(rows[some], n[some])
        start = segment.places[ragged(segment.list[own[some, 0]], n[some])]
        reach = block.width[live[which]] + slop - 1
        rare = own[which, order[which, 0]]
        near = segment.following(rare, start - 1)
        keep = (near >= 0) & (near - start <= reach)
        which, start, reach = which[keep], start[keep], reach[keep]
        last = start.copy()
        for k in range(1, own.shape[1]):
            term = own[which, k]
            step = np.where(term < 0, last, segment.following(np.maximum(term, 0), last))
            keep = (step >= 0) & (step - start <= reach)
            which, start, reach, last = which[keep], start[keep], reach[keep], step[keep]
        keep = segment.doc_of(start) == segment.doc_of(last)
        found.append((live[which[keep]], start[keep], last[keep]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (rows, rows, rows)


_MATCHES = "segment long, no int, doc_id long, spans array<struct<first: int, last: int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _merged(first: np.ndarray, last: np.ndarray) -> list[dict]:
    """The union of spans as spans that neither overlap nor touch."""
    out: list[dict] = []
    for a, b in sorted(zip(first.tolist(), last.tolist(), strict=True)):
        if out and a <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], b)
        else:
            out.append({"first": a, "last": b})
    return out


def _searcher(held, slop: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                segment = Segment(row)
                if not len(segment.keys):
                    continue
                window, first, last = exact(segment, block) if slop is None else ordered(segment, block, slop)
                if not len(window):
                    continue
                doc = segment.doc_of(first)
                order = np.argsort(doc, kind="stable")
                docs, at = np.unique(doc[order], return_index=True)
                parts = [order[s:e] for s, e in zip(at, [*at[1:], len(order)], strict=True)]
                begins = segment.doc_start[docs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["segment"]] * len(docs), pa.int64()), pa.array(docs, pa.int32()),
                     pa.array([row["doc_ids"][d] for d in docs], pa.int64()),
                     pa.array([_merged(first[p] - s, last[p] - s) for p, s in zip(parts, begins, strict=True)], _SPANS),
                     pa.array([block.items_of(np.unique(window[p])) for p in parts], pa.list_(pa.string()))],
                    names=["segment", "no", "doc_id", "spans", "items"])
    return run


def _windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, at in chunks(b["text"], SEGMENT):
                data = FOLD[data]
                words, raw = find_words(data, at, SEPARATOR), data.tobytes()
                names = b["item"].slice(lo, hi - lo).to_pylist()
                items, found = [], []
                for i, name in enumerate(names):
                    own = [raw[s:e] for s, e in zip(words.start[words.row[i]:words.row[i + 1]].tolist(),
                                                    words.end[words.row[i]:words.row[i + 1]].tolist(), strict=True)]
                    for k in range(max(1, len(own) - width + 1) if own else 0):
                        items.append(name)
                        found.append(b" ".join(own[k:k + width]))
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(found, pa.binary())],
                                                 names=["item", "phrase"])
    return run


def phrases(items: DataFrame, folder: str, width: int = WIDTH) -> DataFrame:
    """item, phrase: the stored distinct windows of a test set (columns item_id and text)."""
    source = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return stored(source.mapInArrow(_windows(width), "item string, phrase binary").distinct(), f"{folder}/phrases")


def _search(segments: DataFrame, queries: DataFrame, folder: str, slop: int | None, block_rows: int) -> DataFrame:
    spark = segments.sparkSession
    n_blocks = max(1, -(-queries.count() // block_rows))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("phrase", "item"), F.lit(n_blocks)))
    found = None
    for k in range(n_blocks):
        got = dealt.where(F.col("block") == k).select("phrase", "item").toArrow()
        held = spark.sparkContext.broadcast(
            Phrases(list(zip(got["phrase"].to_pylist(), got["item"].to_pylist(), strict=True))))
        part = stored(segments.mapInArrow(_searcher(held, slop), _MATCHES), f"{folder}/matches-{k}")
        held.destroy()
        found = part if found is None else found.unionByName(part)
    return found.groupBy("segment", "no").agg(
        F.first("doc_id").alias("doc_id"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def matches(segments: DataFrame, queries: DataFrame, folder: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """segment, no, doc_id, spans (first and last word), items of each document in which
    a phrase of ``queries`` occurs."""
    return _search(segments, queries, folder, None, block_rows)


def proximity(segments: DataFrame, queries: DataFrame, folder: str, slop: int,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """As ``matches``, for phrases whose terms follow each other in order with at most
    ``slop`` other words between the first and the last."""
    return _search(segments, queries, folder, slop, block_rows)


def hit_words(spans: Column) -> Column:
    """The number of words in the union of sorted spans."""
    def step(acc: Column, span: Column) -> Column:
        low = F.greatest(span["first"].cast("long"), acc["end"] + 1)
        return F.struct((acc["n"] + F.greatest(span["last"].cast("long") - low + 1, F.lit(0).cast("long"))).alias("n"),
                        F.greatest(acc["end"], span["last"].cast("long")).alias("end"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end"))
    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def contamination(segments: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each document of the index: doc_id, n_words, n_hit (words inside
    occurrences), items (sorted names)."""
    docs = segments.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("no", "doc")) \
        .select("segment", "no", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.n_words").cast("long").alias("n_words"))
    hits = found.select("segment", "no", hit_words(F.col("spans")).alias("n_hit"), "items")
    return docs.join(hits, ["segment", "no"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
