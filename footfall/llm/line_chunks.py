"""Line dedup by content-defined chunks of lines.

A line of at least ``LONG`` words is a chunk of its own. Among the shorter lines between
such ones, a hash rolls over each two neighbouring lines, and every shortest window of at
least ``SPAN`` words ends a chunk at its least value. So a boundary depends on the window
around it alone, an insertion moves no later one, and every window has one.

A piece is a chunk with its next lines, or with those before it, until there are ``MIN_WORDS``
words: the shortest run of lines that begins where a chunk begins, or ends where one ends.
Pieces that occur in more than one place are found by 64-bit hashes (narrow rows).
A passage's edges share chunks with the text around it, so pieces found are then
grown by the short lines on either side, up to ``REACH`` words, and grown pieces that
repeat are found the same way. The texts of found pieces alone are grouped by their
bytes, so a hash collision removes nothing. Pieces are removed everywhere but at the
smallest place; places may overlap. A line goes if a piece over it goes, so one copy
of each line stays at a smaller place.

What is found: a repeated passage of ``SPAN + LONG`` words or more goes whole, whatever surrounds
it. In it, each long line is a piece; a stretch of short lines of that many words holds a
whole window, so a boundary, with ``MIN_WORDS`` words of the stretch on one side of it; and lines
between pieces are within reach of one. Shorter passages, of at least ``MIN_WORDS`` words, go
if a boundary lies so in them.

A piece that many documents share is counted by partial aggregation and joined by a join
that adaptive execution splits; no group is gathered in one task, and what is
gathered for a row is about one text.

Defined results: null text stays null and empty text stays empty; rows of equal
doc_id and text count as one document, so a repeated row loses no more than the first; other
rows, those without an id too, are told apart; places are ordered by doc_id (null
last), a hash of the text, and lines; a text whose lines all go becomes empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import extended, packed, stored

LISTED = 1_000_000        # pieces whose lists are broadcast, at 32 bytes each
LONG = 20
MIN_WORDS = 20
SPAN = 25
REACH = SPAN + LONG
_M = (1 << 64) - 1


class _Lines:
    """The lines of a text that have words: their numbers, and the words before each."""

    def __init__(self, text: str):
        self.all = text.split("\n")
        counted = [(i, n) for i, x in enumerate(self.all) if (n := len(x.split()))]
        self.at = [i for i, _ in counted]
        self.size = [n for _, n in counted]
        self.before = [0]
        for n in self.size:
            self.before.append(self.before[-1] + n)

    def starts(self) -> list[int]:
        """Places in ``at`` where chunks begin."""
        out, first, n = {0}, 0, len(self.at)
        for i in range(n + 1):
            if i == n or self.size[i] >= LONG:
                out |= {i, i + 1}
                if self.before[i] - self.before[first] >= SPAN:
                    out.update(self._cuts(first, i))
                first = i + 1
        return sorted(x for x in out if x < n)

    def _cuts(self, first: int, end: int) -> Iterator[int]:
        """Boundaries in the short lines from ``first`` to before ``end``."""
        h = [xxhash.xxh64_intdigest(self.all[i]) for i in self.at[first:end]]
        # of two neighbours; the xor spreads the sum over its high bits
        rolled = [(r ^ (r >> 29)) * 0xBF58476D1CE4E5B9 & _M
                  for a, b in zip(h, h[1:], strict=False) for r in ((a * 0x9E3779B97F4A7C15 + b) & _M,)]
        least: list[int] = []              # places of rising values, in the window's pairs
        head, last = 0, 0
        for w in range(first, end):
            v = bisect_left(self.before, self.before[w] + SPAN) - 1      # last line of the window
            if v >= end:
                return
            for j in range(last, v - first):
                while len(least) > head and rolled[least[-1]] >= rolled[j]:
                    least.pop()
                least.append(j)
            last = max(last, v - first)
            while least[head] < w - first:
                head += 1
            yield first + least[head] + 1

    def forward(self, i: int) -> int | None:
        """Last place of the shortest run of ``MIN_WORDS`` words that begins at place i."""
        e = bisect_left(self.before, self.before[i] + MIN_WORDS)
        return e - 1 if e < len(self.before) else None

    def backward(self, i: int) -> int | None:
        """First place of the shortest such run that ends at place i."""
        if self.before[i + 1] < MIN_WORDS:
            return None
        return bisect_right(self.before, self.before[i + 1] - MIN_WORDS) - 1

    def piece(self, first: int, last: int) -> str:
        return "\n".join(self.all[first:last + 1])


def chunks(text: str) -> list[tuple[int, int]]:
    """First and last line of each chunk; lines without words are in none at its edges."""
    x = _Lines(text)
    starts = x.starts()
    return [(x.at[s], x.at[e - 1]) for s, e in zip(starts, [*starts[1:], len(x.at)], strict=True)] if x.at else []


Spans = list[tuple[int, int]]


def pieces(x: _Lines) -> Spans:
    """First and last line of the runs that begin or end with a chunk."""
    out, starts = set(), x.starts() if x.at else []
    for s in starts:
        if (e := x.forward(s)) is not None:
            out.add((x.at[s], x.at[e]))
        if s and (b := x.backward(s - 1)) is not None:
            out.add((x.at[b], x.at[s - 1]))
    if x.at and (b := x.backward(len(x.at) - 1)) is not None:
        out.add((x.at[b], x.at[-1]))
    return sorted(out)


def grown(x: _Lines, found: Spans) -> Spans:
    """The runs of ``found`` with short lines before them, or behind them."""
    out = set()
    for first, last in found:
        i, j = bisect_left(x.at, first), bisect_left(x.at, last)
        b, e = i - 1, j + 1
        while b >= 0 and x.size[b] < LONG and x.before[i] - x.before[b] < REACH:
            out.add((x.at[b], last))
            b -= 1
        while e < len(x.at) and x.size[e] < LONG and x.before[e + 1] - x.before[j + 1] < REACH:
            out.add((first, x.at[e]))
            e += 1
    return sorted(out - set(found))


def _hash(piece: str) -> int:
    return xxhash.xxh64_intdigest(piece, 7) - (1 << 63)


_PLACE = "doc_id long, key long, first int, last int, h long"
_TYPES = [("doc_id", pa.int64()), ("key", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("h", pa.int64())]
_WIDE = [*_TYPES, ("piece", pa.string())]


def _emit(make: Callable[[_Lines, Spans], Iterator[tuple]], types: list) -> Callable:
    """An Arrow step from texts (and the runs listed for each) to rows of places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            listed = b["listed"] if "listed" in b.schema.names else [None] * b.num_rows
            for doc_id, key, text, runs in zip(b["doc_id"].to_pylist(), b["key"].to_pylist(), b["text"], listed, strict=True):
                if text := text.as_py():
                    rows += [(doc_id, key, *row) for row in make(_Lines(text), _spans(runs))]
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)],
                                             names=[n for n, _ in types])
    return run


def _spans(listed: pa.Scalar | None) -> Spans:
    return [(g["first"], g["last"]) for g in (listed.as_py() if listed is not None else None) or ()]


def _all_pieces(x: _Lines, _: Spans) -> Iterator[tuple]:
    return ((f, e, _hash(x.piece(f, e))) for f, e in pieces(x))


def _grown_pieces(x: _Lines, found: Spans) -> Iterator[tuple]:
    return ((f, e, _hash(x.piece(f, e))) for f, e in grown(x, found))


def _texts(x: _Lines, found: Spans) -> Iterator[tuple]:
    return ((f, e, _hash(t), t) for f, e in found for t in (x.piece(f, e),))


def _key() -> Column:
    """Rows of equal doc_id and text are one document."""
    return F.xxhash64("text")


_ORDER = ["doc_id", "key", "first", "last"]


def _by_document(places: DataFrame) -> DataFrame:
    """The runs of each document; up to ``LISTED`` runs are broadcast, so that texts stay
    where they are, and more are joined by document."""
    lists = (places.groupBy(F.col("doc_id").alias("of"), F.col("key").alias("of_key"))
             .agg(F.collect_set(F.struct("first", "last")).alias("listed")))
    return F.broadcast(lists) if places.count() <= LISTED else lists


def _listed(source: DataFrame, places: DataFrame) -> DataFrame:
    lists = _by_document(places)
    same = source["doc_id"].eqNullSafe(lists["of"]) & (source["key"] == lists["of_key"])
    return source.join(lists, same).select("doc_id", "key", "text", "listed")


def repeated(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, key, first, last of each run of lines that goes."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key().alias("key"), "text")
    place = F.struct(F.col("doc_id").isNull().alias("none"), *_ORDER)

    def twice(places: DataFrame) -> DataFrame:
        hashes = (places.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                  .where("a <> b").select("h"))
        return places.join(hashes, "h", "left_semi").select(*_ORDER, "h")

    narrow = stored(source.mapInArrow(_emit(_all_pieces, _TYPES), _PLACE), f"{folder}/pieces")
    found = stored(twice(narrow), f"{folder}/found")
    wider = stored(_listed(source, found).mapInArrow(_emit(_grown_pieces, _TYPES), _PLACE), f"{folder}/grown")
    both = stored(found.union(twice(wider)), f"{folder}/both")
    seen = stored(_listed(source, both).mapInArrow(_emit(_texts, _WIDE), f"{_PLACE}, piece string"),
                  f"{folder}/candidates")
    kept = seen.groupBy("h", "piece").agg(F.min(place).alias("kept"), F.max(place).alias("end")) \
        .where("kept <> end").drop("end")
    gone = seen.join(kept, ["h", "piece"]).where(place != F.col("kept"))
    return stored(gone.select(*_ORDER).distinct(), f"{folder}/gone")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, removed, runs = [], [], []
        for text, listed in zip(b["text"], b["listed"], strict=True):
            text, gone = text.as_py(), set()
            for first, last in _spans(listed):
                gone.update(range(first, last + 1))
            if gone:
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
            texts.append(text)
            removed.append(len(gone))
            runs.append(sum(i - 1 not in gone for i in gone))
        yield pa.RecordBatch.from_arrays(
            [b["row"], pa.array(texts, pa.string()), pa.array(removed, pa.int32()), pa.array(runs, pa.int32())],
            names=["row", "text", "removed", "runs"])


def without_repeats(docs: DataFrame, folder: str) -> DataFrame:
    """Columns row (all columns of ``docs`` but text), text (what stays), removed
    (number of lines that went), runs (of neighbouring ones); one row for each row of ``docs``."""
    lists = _by_document(repeated(docs, folder))
    rest = docs.drop("text")
    rows = packed(docs, text=F.col("text"), id=F.col("doc_id").cast("long"), key=_key()).select(
        F.struct(*[F.col("row")[c].alias(c) for c in rest.columns]).alias("row"), "text", "id", "key")
    same = rows["id"].eqNullSafe(lists["of"]) & (rows["key"] == lists["of_key"])
    joined = rows.join(lists, same, "left").select("row", "text", "listed")
    return joined.mapInArrow(_without, extended(extended(joined.drop("listed").schema, "removed", "integer"),
                                                "runs", "integer"))
