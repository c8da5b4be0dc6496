"""Vectorised splitting and hashing of words over Arrow string columns.

Texts are taken as UTF-8 bytes in chunks of whole documents of about
``CHUNK`` bytes, so memory does not grow with the batch (a longer document is a
chunk of its own). Words are hashed eight bytes at a time, all words of a chunk in
one numpy pass; the hash is no polynomial, so no family of texts collides by
construction, and ``distinct_spans`` compares bytes where a result must be exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

CHUNK = 1 << 20
LONG_SPAN = 512
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)              # A-Z to a-z
FOLD[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_START, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
_PART = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def lanes(values: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one integer, zeros behind the end."""
    padded = np.concatenate([values, np.zeros(8, np.uint8)])
    return np.ndarray(len(values) + 1, "<u8", buffer=padded, strides=(1,))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end] for each span of a uint8 array: the length and then
    eight bytes at a time go through ``mix``; spans above ``LONG_SPAN`` bytes through xxhash."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * _STEP + _START)
    long = np.flatnonzero(size > LONG_SPAN)
    for i in long:
        h[i] ^= np.uint64(xxhash.xxh64_intdigest(values[starts[i]:ends[i]], 17))
    eight, live, done = lanes(values), np.flatnonzero((size > 0) & (size <= LONG_SPAN)), 0
    while len(live):
        left = size[live] - done
        lane = eight[starts[live] + done] & _PART[np.minimum(left, 8)]
        h[live] = mix((h[live] ^ lane) * _STEP)
        live, done = live[left > 8], done + 8
    return h


def same_spans(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray,
               b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether a[a_start:a_end] and b[b_start:b_end] are the same bytes, for each pair of spans."""
    size = a_end - a_start
    same = size == b_end - b_start
    for i in np.flatnonzero(same & (size > LONG_SPAN)):
        same[i] = np.array_equal(a[a_start[i]:a_end[i]], b[b_start[i]:b_end[i]])
    left, right = lanes(a), lanes(b)
    live, done = np.flatnonzero(same & (size > 0) & (size <= LONG_SPAN)), 0
    while len(live):
        rest = size[live] - done
        part = _PART[np.minimum(rest, 8)]
        same[live] = (left[a_start[live] + done] & part) == (right[b_start[live] + done] & part)
        live, done = live[same[live] & (rest > 8)], done + 8
    return same


def distinct_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                   h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first span of each distinct byte string, in the order of their hashes ``h``, and
    the number of each span's string among them. Bytes are compared, so spans of one hash
    that differ are told apart."""
    _, first, back = np.unique(h, return_index=True, return_inverse=True)
    same = same_spans(values, starts, ends, values, starts[first[back]], ends[first[back]])
    if same.all():
        return first, back
    groups: dict[tuple[int, bytes], int] = {}
    for i in np.flatnonzero(np.isin(h, h[~same])):
        groups.setdefault((int(h[i]), values[starts[i]:ends[i]].tobytes()), int(i))
    plain = first[~np.isin(h[first], h[~same])]
    first = np.concatenate([plain, np.array(sorted(groups.values()), np.int64)])
    first = first[np.argsort(h[first], kind="stable")]
    number = {int(f): n for n, f in enumerate(first)}
    back = np.searchsorted(h[first], h)
    for i in np.flatnonzero(np.isin(h, h[~same])):
        back[i] = number[groups[int(h[i]), values[starts[i]:ends[i]].tobytes()]]
    return first, back


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), at


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, row offsets from 0) of whole rows."""
    data, at = text_bytes(column)
    row, n = 0, len(at) - 1
    while row < n:
        last = int(np.searchsorted(at, at[row] + size, side="right")) - 1
        last = min(max(last, row + 1), n)
        yield row, last, data[at[row]:at[last]], at[row:last + 1] - at[row]
        row = last


@dataclass
class Words:
    """Words of a chunk in order; row[i] .. row[i + 1] are those of its i-th text."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.row)


def find_words(data: np.ndarray, at: np.ndarray, separator: np.ndarray = SPACE,
               cut: np.ndarray | None = None) -> Words:
    """Maximal runs without separators; ``cut[i]`` also ends a word before byte i."""
    inside = ~separator[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = at[:-1][at[:-1] < len(data)]
    first[edge] = inside[edge]
    if cut is not None:
        first |= cut & inside
    start = np.flatnonzero(first)
    # a word ends where the next one starts or at the first separator or row end
    stop = ~inside
    stop[edge] = True
    stop[start] = True
    stops = np.append(np.flatnonzero(stop), len(data))
    end = stops[np.searchsorted(stops, start, side="right")]
    return Words(start, end, np.searchsorted(start, at))


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word of each window of ``width`` words inside one text,
    and the n + 1 offsets of the texts in it."""
    n = np.maximum(words.counts() - width + 1, 0)
    at = np.concatenate([[0], np.cumsum(n)])
    first = np.arange(at[-1]) + np.repeat(words.row[:-1] - at[:-1], n)
    return first, at


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + lengths[0] - 1, then those of the next, and so on."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
