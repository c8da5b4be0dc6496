"""Token-id files in adaptively range-coded, independently reset blocks.

Texts are encoded with the tokenizers library, an end id follows each document,
and ids are written in ascending doc_id order. A table of blocks is written
(Parquet rows, so commits are atomic and any store that Spark reads will do):

  part, block    place in the order of ids
  start, n_ids   ids of the part before the block, and in it
  docs           no (in the part), doc_id, n (ids in this block), whole (if all are here)
  payload, crc   the coded ids and their crc32, checked when read

Documents share a block while they fit; one of more than ``BLOCK`` ids has
blocks of its own. Each block is coded from an empty state, so blocks are read alone.

Coding an id is one or two steps of a 64-bit range coder. The first tells apart
the id that followed the last two ids before (order 2), the one that followed the
last id (order 1), an id that is new to the block, and another one. The
probability of the order-2 id mixes adaptive estimates of order 0, of the record
of the order-1 prediction and of that of order 2, with weights that follow how
well each did. The second step codes a new id itself, or the place of an old one in a
list that moves ids forward as they come again (order 0): the place's bit length, in
a distribution around a running mean, then its other bits. All arithmetic is in
integers, so the reader repeats it exactly. Numpy codes many blocks in step.

Defined results: null or empty text is the end id alone; null doc_ids come first;
rows of one doc_id follow each other, ordered by text; an empty table gives no
block. Ids must be below 2**24.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import BATCH_ROWS, stored
from footfall.llm.word_bpe import _LETTER, _SIGN, load
from footfall.llm.wordhash import chunks, distinct_spans, find_words, ragged, same_spans, span_hashes

BLOCK = 2_048              # ids of a block, at most
TOGETHER = 4_096           # blocks coded in step
PIECE = 256                # blocks whose ids the reader hands on at once

ONE, TWO, PLACES = 10, 11, 12      # bits of the prediction tables and of the place table
_K1, _K2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)
_U32 = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)
#: probabilities and weights are of 2**15, so products and their sums fit 31 bits
ALL, LEAST, MOST = 1 << 15, 32, (1 << 15) - 256
_LENGTH = np.array([int(i).bit_length() for i in range(BLOCK + 1)], np.int32)


def _small(id_bits: int) -> type:
    """The type that ids are held in; numpy counts with wider ones."""
    return np.uint16 if id_bits <= 16 else np.int32


def _length_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each state: lower bounds of the 13 lengths in 4096, their widths, and the
    length at each value."""
    lower, wide, at = (np.zeros((13, n), np.int32) for n in (13, 13, 4096))
    for state in range(13):
        # integers only: three quarters for each step away from the state
        share = [4 ** 12 * 3 ** abs(k - state) // 4 ** abs(k - state) for k in range(13)]
        total = sum(share)
        wide[state] = [16 + x * (4096 - 13 * 16) // total for x in share]
        wide[state, state] += 4096 - wide[state].sum()
        lower[state, 1:] = np.cumsum(wide[state])[:-1]
        at[state] = np.repeat(np.arange(13), wide[state])
    return lower.ravel(), wide.ravel(), at.ravel()


_LOWER, _WIDE, _AT = _length_tables()
#: the entry of an id new to the block, which has all of the range, behind those of states and lengths
_NEW = 13 * 13
_FIRST = np.append(_LOWER, 0).astype(np.uint64)
_SHARE = np.append(_WIDE, 4096).astype(np.uint64)
_BASE = np.append(np.tile((1 << np.arange(13)) >> 1, 13), 0)
_REST = np.append(np.tile(np.maximum(np.arange(13) - 1, 0), 13), 0)


def _rest_bits(id_bits: int) -> np.ndarray:
    """Of each entry: the bits that follow it."""
    bits = _REST.copy()
    bits[_NEW] = id_bits
    return bits


class _Model:
    """The state of many blocks, a row each; all arithmetic is in integers. A step costs its
    numpy calls, so what is done alike to several estimates is done to them at once, and
    products with 0 or 1 stand for choices, which numpy makes more slowly. Places in the
    tables are 64-bit, as numpy converts any other index first."""

    def __init__(self, rows: int, id_bits: int, writes: bool):
        # order-1 and then order-2 predictions; one is 4 * id + confidence (0: none)
        self.guess = np.zeros((rows << ONE) + (rows << TWO), np.int32)
        # places of ids by hash; the reader is told them
        self.place = np.zeros(rows << PLACES if writes else 0, np.int16)
        self.ids = np.zeros(rows * BLOCK, _small(id_bits))     # of each row, ``size`` are set
        self.size = np.zeros(rows, np.int64)
        self.state = np.full(rows, 5 * 16, np.int64)           # mean length of places, in sixteenths
        # of each row: 8 estimates of order 1, 4 of order 2, 4 that the order-1 id is right
        self.some = np.repeat([ALL >> 1, ALL >> 1, ALL >> 1, ALL >> 2], 4)[None].repeat(rows, 0).ravel().astype(np.int32)
        self.a0, self.new = np.full(rows, ALL >> 1, np.int32), np.full(rows, ALL >> 1, np.int32)
        self.weights = np.array([[ALL >> 2], [ALL >> 1]], np.int32).repeat(rows, 1)
        self.mixed, self.before = np.zeros(rows, np.uint32), np.zeros(rows, np.uint32)
        self.last = np.zeros(rows, np.uint32)
        row = np.arange(rows)
        self.row = np.stack([row, (rows << ONE) + row])
        self.row16 = np.stack([row << 4, (row << 4) + 8, (row << 4) + 12])
        # bounds of what is coded: order-2 id, order-1 id, new id, other id
        self.bounds = np.zeros((5, rows), np.int64)
        self.bounds[4] = ALL
        self.across = row
        self.rows = rows

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Upper bounds in ALL of: the order-2 id, the order-1 id, an id new to the block."""
        slot = np.empty((2, n), np.uint32)
        mixed = self.mixed[:n]
        np.right_shift(mixed, np.uint32(32 - ONE), out=slot[0])
        np.right_shift(mixed + self.before[:n], np.uint32(32 - TWO), out=slot[1])
        self.at = at = slot.astype(np.int64)
        at *= self.rows
        at += self.row[:, :n]
        self.entry = entry = self.guess[at]
        self.sure = sure = entry & 3
        self.any = known = sure > 0
        same = (entry[0] ^ entry[1]) < 4
        self.has = has = np.empty((2, n), bool)            # of order 2, of order 1
        has[0] = known[1]
        np.greater(known[0], same & known[1], out=has[1])
        self.set = sets = has.astype(np.int32)
        self.index = index = np.empty((3, n), np.int64)
        index[:2] = sure
        index[2] = index[0]
        index += self.row16[:, :n]
        index[0] += same.view(np.int8) << 2
        self.q = q = np.empty((4, n), np.int32)
        np.take(self.some, index, out=q[:3], mode="clip")
        q[3] = q0 = self.a0[:n]
        part = q[:2] - q0
        part *= self.weights[:, :n]
        mix = part[0]
        mix += part[1]
        mix >>= 15
        mix += q0
        self.mix = mix
        chance = np.empty((3, n), np.int32)
        chance[0], chance[1], chance[2] = mix, q[2], self.new[:n]
        np.maximum(chance, LEAST, out=chance)
        np.minimum(chance, MOST, out=chance)
        chance[:2] *= sets
        up2, up1, up0 = chance
        rest = ALL - up2
        up1 *= rest
        up1 >>= 15
        rest -= up1
        up1 += up2
        up0 *= rest
        up0 >>= 15
        np.maximum(up0, 1, out=up0)
        up0 += up1
        self.bounds[1:4, :n] = chance
        return up2, up1, up0

    def narrow(self, n: int, hit1: np.ndarray, missed: np.ndarray, new: np.ndarray, low: np.ndarray,
               width: np.ndarray, unit: np.ndarray) -> None:
        """The ranges after the first step; ``new`` is 1 for ids new to the block, of the missed rows."""
        at = hit1.astype(np.int64)
        at[missed] = 3 - new
        at *= self.rows
        at += self.across[:n]
        bounds = self.bounds.ravel()
        lower = bounds[at]
        at += self.rows
        upper = bounds[at]
        upper -= lower
        lower = lower.view(np.uint64)
        lower *= unit
        low[:n] += lower
        np.multiply(unit, upper.view(np.uint64), out=width[:n])

    def learn(self, n: int, ids: np.ndarray, mixed: np.ndarray, right: np.ndarray, hit1: np.ndarray) -> None:
        """After ``ids`` in the first n rows, of which ``right`` were those predicted by order 1 and 2."""
        hit2 = right[1]
        aim, set2 = np.empty((4, n), np.int32), self.set[0]
        np.left_shift(hit2, 15, out=aim[0], dtype=np.int32)
        aim[1] = aim[3] = aim[0]
        np.left_shift(hit1, 15, out=aim[2], dtype=np.int32)
        sign = aim[0] >> 14
        sign -= set2
        step = self.q[:2] - self.mix
        step *= sign
        step >>= 6
        weights = self.weights[:, :n]
        weights += step
        np.maximum(weights, 1024, out=weights)
        np.minimum(weights, 15000, out=weights)
        aim -= self.q
        aim[:2] *= set2
        aim[2] *= np.greater(self.has[1], hit2).view(np.int8)
        aim[3] *= set2
        aim >>= 5
        aim += self.q
        self.some[self.index] = aim[:3]
        self.a0[:n] = aim[3]
        # a right one gains confidence, up to 3; a wrong one of confidence 1 is replaced
        entry, sure = self.entry, self.sure
        fresh = ids << 2
        fresh |= 1
        wrong = np.logical_not(right)
        entry += np.less(sure, 3).view(np.int8) * right.view(np.int8)
        entry -= wrong.view(np.int8)
        wrong &= sure < 2
        step = fresh - entry
        step *= wrong.view(np.int8)
        entry += step
        self.guess[self.at] = entry
        np.multiply(self.last[:n], _K2, out=self.before[:n])
        self.last[:n] = ids
        self.mixed[:n] = mixed

    def move(self, missed: np.ndarray, mine: np.ndarray, slots: np.ndarray | None, new: np.ndarray,
             size: np.ndarray, at: np.ndarray, state: np.ndarray, length: np.ndarray) -> None:
        """After ids of the missed rows: those that are new (1) go to the end ``at`` of their
        lists, others halve their place ``at``, of which ``length`` is the bit length."""
        seen = self.new[missed]
        step = new.astype(np.int32)
        step <<= 15
        step -= seen
        step >>= 5
        seen += step
        self.new[missed] = seen
        old = 1 - new
        length = length << 4
        length -= state
        length >>= 3
        length *= old
        length += state
        self.state[missed] = length
        base = missed << (BLOCK.bit_length() - 1)
        to = at >> old
        moved = np.flatnonzero(to != at)
        back, place = base[moved], at[moved]
        other = self.ids[back + to[moved]]
        back += place
        self.ids[back] = other
        base += to
        self.ids[base] = mine
        if slots is not None:
            found = (other.astype(np.uint32) * _K1) >> np.uint32(32 - PLACES)
            slot = found.astype(np.int64)
            slot *= self.rows
            slot += missed[moved]
            self.place[slot] = place
            self.place[slots] = to
        size += new
        self.size[missed] = size


def _shrink(low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Rows whose range is below 2**32, after cutting it at a 32-bit border if it spans one."""
    need = np.flatnonzero(width < np.uint64(1 << 32))
    if len(need):
        lo, wide = low[need], width[need]
        span = ((lo ^ (lo + (wide - np.uint64(1)))) >> _U32) != 0
        if span.any():
            width[need[span]] = (np.uint64(0) - lo[span]) & _LOW
    return need


def encode_blocks(blocks: list[np.ndarray], id_bits: int) -> list[bytes]:
    """Code many blocks of 1 to BLOCK ids in step."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order])
    longest = int(sizes[0])
    ids = np.zeros((longest, len(order)), _small(id_bits))
    for j, i in enumerate(order):
        ids[:sizes[j], j] = blocks[i]
    model, rest_bits = _Model(len(order), id_bits, True), _rest_bits(id_bits).astype(np.uint64)
    low = np.zeros(len(order), np.uint64)
    width = np.full(len(order), 0xFFFFFFFFFFFFFFFF, np.uint64)
    # an id takes two words at most, mostly less than half a one; two follow at the end
    out = np.zeros((len(order), longest // 2 + 4), np.uint32)
    end = np.zeros(len(order), np.int64)

    def put(low, width, rows=None):
        need = _shrink(low, width)
        lo, row = low[need], need if rows is None else rows[need]
        at = end[row]
        out[row, at] = lo >> _U32
        end[row] = at + 1
        low[need] = lo << _U32
        width[need] <<= _U32

    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    for t in range(longest):
        if t % 64 == 0 and int(end.max()) + 2 * 64 + 2 > out.shape[1]:
            out = np.concatenate([out, np.zeros((len(order), longest // 4 + 2 * 64), np.uint32)], axis=1)
        n = int(active[t])
        x = ids[t, :n].astype(np.int32)
        mixed = x.view(np.uint32) * _K1
        model.predict(n)
        # 4 * id + confidence, of which the id is the same and the confidence 1 to 3
        differs = model.entry ^ (x << 2)
        differs -= 1
        right = differs.view(np.uint32) < 3
        hit1 = right[0] & model.has[1]
        missed = np.flatnonzero(hit1 == right[1])          # never both
        mine = x[missed]
        slots = (mixed[missed] >> np.uint32(32 - PLACES)).astype(np.int64)
        slots *= len(order)
        slots += missed
        place, size = model.place[slots].astype(np.int64), model.size[missed]
        found = (missed << (BLOCK.bit_length() - 1)) + place
        new = ((place >= size) | (model.ids[found] != mine)).astype(np.int64)
        model.narrow(n, hit1, missed, new, low, width, width[:n] >> np.uint64(15))
        put(low[:n], width[:n])
        if len(missed):
            at = size - place
            at *= new
            at += place
            length, state = _LENGTH[at], model.state[missed]
            entry = (state >> 4) * 13
            entry += length
            entry += (_NEW - entry) * new
            rest = at - _BASE[entry]
            rest += (mine - rest) * new
            part = width[missed]
            part >>= np.uint64(12)
            lo = part * _FIRST[entry]
            part *= _SHARE[entry]
            part >>= rest_bits[entry]
            lo += part * rest.view(np.uint64)
            lo += low[missed]
            put(lo, part, missed)
            low[missed], width[missed] = lo, part
            model.move(missed, mine, slots, new, size, at, state, length)
        model.learn(n, x, mixed, right, hit1)
    rows = np.arange(len(order))
    for word in (low >> _U32, low & _LOW):
        out[rows, end] = word
        end += 1
    coded: list[bytes] = [b""] * len(blocks)
    for j, i in enumerate(order):
        coded[i] = out[j, :end[j]].astype("<u4").tobytes()
    return coded


def decode_blocks(payloads: list[bytes], sizes: list[int], id_bits: int) -> list[np.ndarray]:
    """The ids of many blocks, decoded in step."""
    order = sorted(range(len(payloads)), key=lambda i: -sizes[i])
    count = np.array([sizes[i] for i in order])
    longest = int(count[0])
    words = np.frombuffer(b"".join([*(payloads[i] for i in order), bytes(8)]), "<u4")
    held = np.array([len(payloads[i]) >> 2 for i in order], np.int64)
    at = np.cumsum(held) - held
    code = (words[at].astype(np.uint64) << _U32) | words[at + 1]
    at += 2
    ids = np.zeros((longest, len(order)), _small(id_bits))
    model, rest_bits = _Model(len(order), id_bits, False), _rest_bits(id_bits)
    most = (1 << rest_bits) - 1
    low = np.zeros(len(order), np.uint64)
    width = np.full(len(order), 0xFFFFFFFFFFFFFFFF, np.uint64)

    def take(low, width, rows=None):
        need = _shrink(low, width)
        row = need if rows is None else rows[need]
        place = at[row]
        code[row] = (code[row] << _U32) | words[place]
        at[row] = place + 1
        low[need] <<= _U32
        width[need] <<= _U32

    active = np.searchsorted(-count, -np.arange(longest), side="left")
    for t in range(longest):
        n = int(active[t])
        up2, up1, up0 = model.predict(n)
        unit = width[:n] >> np.uint64(15)
        value = np.minimum((code[:n] - low[:n]) // unit, np.uint64(ALL - 1)).astype(np.int32)
        hit2 = value < up2
        under = value < up1
        hit1 = under > hit2
        missed = np.flatnonzero(~under)
        new = (value[missed] < up0[missed]).astype(np.int64)
        model.narrow(n, hit1, missed, new, low, width, unit)
        take(low[:n], width[:n])
        x = model.entry[1] - model.entry[0]
        x *= hit2.view(np.int8)
        x += model.entry[0]
        x >>= 2
        if len(missed):
            part = width[missed] >> np.uint64(12)
            lo = low[missed]
            gone = code[missed] - lo
            state = model.state[missed]
            entry = np.minimum(gone // part, np.uint64(4095)).view(np.int64)
            entry += (state >> 4) << 12
            length = _AT[entry]
            entry = (state >> 4) * 13
            entry += length
            entry += (_NEW - entry) * new
            first = part * _FIRST[entry]
            part *= _SHARE[entry]
            part >>= rest_bits[entry].view(np.uint64)
            gone -= first
            rest = np.minimum(gone // part, _LOW).astype(np.int64)
            np.minimum(rest, most[entry], out=rest)
            lo += first
            lo += part * rest.view(np.uint64)
            take(lo, part, missed)
            low[missed], width[missed] = lo, part
            size = model.size[missed]
            place = rest + _BASE[entry]
            place += (size - place) * new
            mine = model.ids[(missed << (BLOCK.bit_length() - 1)) + np.minimum(place, BLOCK - 1)].astype(np.int64)
            mine += (rest - mine) * new
            mine = mine.astype(np.int32)
            x[missed] = mine
            model.move(missed, mine, None, new, size, place, state, length)
        ids[t, :n] = x
        right = np.empty((2, n), bool)
        differs = model.entry[0] ^ (x << 2)
        differs -= 1
        np.less(differs.view(np.uint32), 3, out=right[0])
        right[1] = hit2
        model.learn(n, x, x.view(np.uint32) * _K1, right, hit1)
    del model
    rows = np.ascontiguousarray(ids.T)
    found: list[np.ndarray] = [rows[0]] * len(payloads)
    for j, i in enumerate(order):
        found[i] = rows[j, :count[j]]
    return found


def _pieces(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of pieces that the tokenizer's pattern never joins, and the
    n + 1 offsets of the texts in them.

    Cuts are token boundaries of the pattern, which looks at what follows but never at
    what came before: before a space or newline that follows a sign or letter, after
    such a newline if a sign or letter follows, and between a letter and a sign.
    Bytes of letters beyond Latin-1 count as neither."""
    n = len(data)
    first = np.zeros(n + 1, dtype=bool)
    if n > 1:
        solid = _LETTER[data] | _SIGN[data]
        letter = _LETTER[data].copy()
        second = np.flatnonzero(data[:-1] == 0xC3) + 1
        solid[second] = True
        letter[second[(data[second] != 0x97) & (data[second] != 0xB7)]] = True
        sign = _SIGN[data[1:]] & letter[:-1]
        special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
        if len(special):           # special tokens hold a letter before a sign
            whole = find_words(data, at)
            for i in np.unique(np.searchsorted(whole.start, special, side="right") - 1):
                sign[max(whole.start[i] - 1, 0):whole.end[i]] = False
        first[1:n] = (solid[:-1] & ((data[1:] == 0x20) | (data[1:] == 0x0A))) | sign
        if n > 2:
            opens = _LETTER[data[2:]] | _SIGN[data[2:]] | (data[2:] == 0xC3)
            first[2:n] |= solid[:-2] & (data[1:-1] == 0x0A) & opens
            # a text that ends or starts between those three bytes has no such newline
            for edge in (at[1:-1], at[1:-1] + 1):
                inside = edge[(edge > 0) & (edge < n)]
                first[inside] &= np.isin(inside, at)
    first[at[:-1]] = True
    first[n] = False
    start = np.flatnonzero(first[:n])
    return start, np.append(start[1:], n), np.searchsorted(start, at)


class _Known:
    """Ids of pieces by hash: an open-addressing table, searched for many pieces at once.
    Each piece's bytes are kept and compared, so a piece is never taken for another."""

    BITS, PROBES = 21, 12

    def __init__(self):
        self.keys = np.zeros(1 << self.BITS, np.uint64)
        self.values = np.zeros(1 << self.BITS, np.int32)
        self.sizes, self.at = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.bytes, self.ends = np.zeros(0, np.uint8), np.zeros(1, np.int32)

    def find(self, h: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the pieces data[start:end] of hashes h, -1 for those not here."""
        out = self._by_hash(h)
        hit = np.flatnonzero(out >= 0)
        at = out[hit]
        same = same_spans(data, start[hit], end[hit], self.bytes, self.ends[at], self.ends[at + 1])
        out[hit[~same]] = -1
        return out

    def _by_hash(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1)
        slot = (h >> np.uint64(64 - self.BITS)).astype(np.int64)
        rest = np.arange(len(h))
        for _ in range(self.PROBES):
            key = self.keys[slot]
            hit = key == h[rest]
            out[rest[hit]] = self.values[slot[hit]]
            on = ~hit & (key != 0)
            if not on.any():
                break
            rest, slot = rest[on], (slot[on] + 1) & ((1 << self.BITS) - 1)
        return out

    def add(self, h: np.ndarray, raw: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers of new, distinct pieces: their hashes, bytes, ids and numbers of ids. What
        is added before ``full`` is one chunk's, so 32-bit places are wide enough."""
        self.bytes = np.append(self.bytes, np.frombuffer(b"".join(raw), np.uint8))
        ends = self.ends[-1] + np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        self.ends = np.append(self.ends, ends.astype(np.int32))
        number = len(self.sizes) + np.arange(len(h))
        self.at = np.append(self.at, (len(self.ids) + np.cumsum(sizes) - sizes).astype(np.int32))
        self.sizes = np.append(self.sizes, sizes.astype(np.int32))
        self.ids = np.append(self.ids, ids)
        slot, rest = (h >> np.uint64(64 - self.BITS)).astype(np.int64), np.arange(len(h))
        for _ in range(self.PROBES):             # those that find no slot are looked up in vain next time
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[rest[free]]
            won = free & (self.keys[slot] == h[rest])
            self.values[slot[won]] = number[rest[won]]
            rest, slot = rest[~won], (slot[~won] + 1) & ((1 << self.BITS) - 1)
            if not len(rest):
                break
        return number

    def full(self) -> bool:
        return len(self.sizes) > 1 << (self.BITS - 1) or len(self.ids) > 1 << 22 or len(self.bytes) > 1 << 24


#: byte-level pieces name bytes by characters: printable ones stand for themselves, the
#: other bytes follow from U+0100
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_NAMES = np.zeros(256, "<u2")
_NAMES[_SHOWN] = _SHOWN
_NAMES[sorted(set(range(256)) - set(_SHOWN))] = 0x100 + np.arange(256 - len(_SHOWN))


def _words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether pieces, which follow each other in ``data``, are letters up to U+017F after at
    most one space. (Letters of U+00AA to U+00BA are not looked for.)"""
    letter = _LETTER[data].copy()
    second = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5)) + 1
    second = second[(data[second - 1] != 0xC3) | ((data[second] != 0x97) & (data[second] != 0xB7))]
    letter[second - 1] = letter[second] = True
    space = data[start] == 0x20
    letter[start[space]] = True
    return np.logical_and.reduceat(letter, start) & (end - start > space)


_ID = attrgetter("id")


class _Encoder:
    """Ids of texts, remembering those of pieces."""

    def __init__(self, path: str):
        self.tokenizer, self.known = load(path), _Known()
        self.model = self.tokenizer.model

    def pieces(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, and how many each has. One of letters after at most one space is a single
        word of the pattern, so the model takes it as it is; others go through the whole encoder."""
        data = np.frombuffer(b"".join(raw), np.uint8)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        end = np.cumsum(size)
        start = end - size
        plain = _words(data, start, end)
        named = _NAMES[data].tobytes().decode("utf-16-le")
        n = np.zeros(len(raw), np.int64)
        parts = []
        for some in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            found = [np.zeros(0, np.uint32)]
            for i in range(0, len(some), 4000):
                few = some[i:i + 4000]
                if plain[few[0]]:
                    words = [named[s:e] for s, e in zip(start[few].tolist(), end[few].tolist(), strict=True)]
                    tokens = list(map(self.model.tokenize, words))
                    ids = map(_ID, chain.from_iterable(tokens))
                else:
                    tokens = [e.ids for e in self.tokenizer.encode_batch(
                        [raw[j].decode() for j in few.tolist()], add_special_tokens=False)]
                    ids = chain.from_iterable(tokens)
                n[few] = np.fromiter(map(len, tokens), np.int64, len(few))
                found.append(np.fromiter(ids, np.uint32, int(n[few].sum())))
            parts.append((some, np.concatenate(found)))
        at, out = np.cumsum(n) - n, np.zeros(int(n.sum()), np.uint32)
        for some, ids in parts:
            out[ragged(at[some], n[some])] = ids
        return out, n

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, offsets of the rows in them)"""
        for lo, _, data, at in chunks(column):
            start, end, row = _pieces(data, at)
            h = np.maximum(span_hashes(data, start, end), np.uint64(1))
            if self.known.full():
                self.known = _Known()
            number = self.known.find(h, data, start, end)
            miss = np.flatnonzero(number < 0)
            if len(miss):
                first, back = distinct_spans(data, start[miss], end[miss], h[miss])
                raw, first = data.tobytes(), miss[first]
                new = [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist(), strict=True)]
                number[miss] = self.known.add(h[first], new, *self.pieces(new))[back]
            n = self.known.sizes[number]
            ends = np.concatenate([[0], np.cumsum(n)])
            ids = self.known.ids[ragged(self.known.at[number], n)]
            yield lo, ids, ends[row]


@cache
def _encoder(path: str) -> _Encoder:
    """Kept by a worker from task to task, with the pieces it knows (``full`` bounds them)."""
    return _Encoder(path)


_BLOCKS = ("part int, block int, start long, n_ids int, "
           "docs array<struct<no: int, doc_id: long, n: int, whole: boolean>>, payload binary, crc long")
_DOCS = pa.list_(pa.struct([("no", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int32()),
                            ("whole", pa.bool_())]))


class _Docs:
    """The documents of blocks, in columns: an object for each would be most of a task's memory."""

    def __init__(self):
        self.no, self.doc_id, self.n = array("q"), array("q"), array("q")
        self.unnamed, self.whole = array("b"), array("b")
        self.at = array("i", [0])                  # of blocks, one more than there are

    def add(self, no: int, doc_id: int | None, n: int, whole: bool) -> None:
        self.no.append(no)
        self.doc_id.append(0 if doc_id is None else doc_id)
        self.unnamed.append(doc_id is None)
        self.n.append(n)
        self.whole.append(whole)

    def column(self) -> pa.Array:
        columns = [pa.array(np.array(self.no), pa.int32()),
                   pa.array(np.array(self.doc_id), mask=np.array(self.unnamed, bool)),
                   pa.array(np.array(self.n), pa.int32()), pa.array(np.array(self.whole, bool))]
        docs = pa.StructArray.from_arrays(columns, fields=list(_DOCS.value_type))
        return pa.ListArray.from_arrays(np.array(self.at), docs, type=_DOCS)


def _writer(path: str, end_id: int, id_bits: int):
    """Blocks of a partition's texts, which come in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path), TaskContext.get().partitionId()
        ready: list[np.ndarray] = []
        held: list[np.ndarray] = []
        docs = _Docs()
        filled = number = no = total = 0

        def close():
            nonlocal filled
            if held:
                ready.append(np.concatenate(held).astype(_small(id_bits)))
                docs.at.append(len(docs.no))
                held.clear()
                filled = 0

        def coded():
            nonlocal ready, docs, number, total
            # documents of the block that is still open go on to the next batch
            blocks, done, docs = ready, docs, _Docs()
            ready = []
            for i in range(done.at[-1], len(done.no)):
                docs.add(done.no[i], None if done.unnamed[i] else done.doc_id[i], done.n[i], bool(done.whole[i]))
            sizes = np.array([len(x) for x in blocks], np.int64)
            crc = [zlib.crc32(x.astype("<u4")) for x in blocks]
            payloads = encode_blocks(blocks, id_bits) if blocks else []
            out = pa.RecordBatch.from_arrays(
                [pa.array([part] * len(blocks), pa.int32()),
                 pa.array(range(number, number + len(blocks)), pa.int32()),
                 pa.array(total + np.cumsum(sizes) - sizes, pa.int64()), pa.array(sizes, pa.int32()),
                 done.column(), pa.array(payloads, pa.binary()), pa.array(crc, pa.int64())],
                names=["part", "block", "start", "n_ids", "docs", "payload", "crc"])
            number += len(blocks)
            total += int(sizes.sum())
            return out

        for b in batches:
            names = b["doc_id"].to_pylist()
            for lo, ids, at in encoder.texts(b["text"]):
                ids = np.insert(ids, at[1:], np.uint32(end_id))
                for i, (s, e) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                    s, e = s + i, e + i + 1
                    whole = e - s <= BLOCK
                    if filled + e - s > BLOCK:
                        close()
                    for j in range(s, e, BLOCK):
                        held.append(ids[j:min(j + BLOCK, e)])
                        docs.add(no, names[lo + i], len(held[-1]), whole)
                        filled += len(held[-1])
                        if not whole:
                            close()
                    no += 1
                    if len(ready) >= TOGETHER:
                        yield coded()
        close()
        yield coded()
    return run


def id_bits(path: str) -> int:
    return max(load(path).get_vocab_size(with_added_tokens=True) - 1, 1).bit_length()


def write(docs: DataFrame, path: str, folder: str, end_id: int = 0) -> DataFrame:
    """Write the block table below ``folder`` and return it."""
    bits = id_bits(path)
    if end_id >> bits:
        raise ValueError(f"end id {end_id} takes more than the {bits} bits of the tokenizer's ids")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # ranges over both, so rows that share a doc_id are dealt to many tasks
    ordered = rows.repartitionByRange("doc_id", "text").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(_writer(path, end_id, bits), _BLOCKS), f"{folder}/blocks")


_PIECES = pa.schema([("part", pa.int32()), ("no", pa.int32()), ("doc_id", pa.int64()),
                     ("start", pa.int64()), ("ids", pa.binary())])


def _reader(bits: int, before: dict[int, int]):
    def decoded(some: pa.Table) -> Iterator[pa.RecordBatch]:
        found = decode_blocks(some["payload"].to_pylist(), some["n_ids"].to_pylist(), bits)
        for i in range(0, len(found), PIECE):
            rows = some.slice(i, PIECE).combine_chunks()
            ids = np.concatenate(found[i:i + PIECE]).astype("<u4")
            size = rows["n_ids"].to_numpy().astype(np.int64)
            ends = np.cumsum(size)
            part, block = rows["part"].to_numpy(), rows["block"].to_numpy()
            for j, crc in enumerate(rows["crc"].to_pylist()):
                if zlib.crc32(ids[ends[j] - size[j]:ends[j]]) != crc:
                    raise ValueError(f"block {block[j]} of part {part[j]} does not match its checksum")
            lists = rows["docs"].combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            of, docs = np.repeat(np.arange(len(rows)), lists.value_lengths().to_numpy()), lists.flatten()
            n = docs.field("n").to_numpy().astype(np.int64)
            # documents fill their blocks, so they follow each other in ``ids``
            at = np.concatenate([[0], np.cumsum(n)])
            shift = np.array([before[p] for p in part.tolist()], np.int64) + rows["start"].to_numpy() - (ends - size)
            taken = pa.BinaryArray.from_buffers(
                pa.binary(), len(n), [None, pa.py_buffer((4 * at).astype(np.int32)), pa.py_buffer(ids)])
            out = pa.RecordBatch.from_arrays(
                [pa.array(part[of]), docs.field("no"), docs.field("doc_id"), pa.array(shift[of] + at[:-1]), taken],
                schema=_PIECES)
            for j in range(0, len(n), BATCH_ROWS):
                yield out.slice(j, BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a step costs its numpy calls whatever the number of blocks, so batches are gathered
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            held.append(b)
            rows += len(b)
            while rows >= TOGETHER:
                some = pa.Table.from_batches(held)
                held, rows = some.slice(TOGETHER).to_batches(), rows - TOGETHER
                yield from decoded(some.slice(0, TOGETHER))
        if rows:
            yield from decoded(pa.Table.from_batches(held))
    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = [b"".join(p["ids"] for p in sorted(x.as_py(), key=lambda p: p["start"])) for x in b["pieces"]]
        yield b.drop_columns(["pieces"]).append_column("ids", pa.array(ids, pa.binary()))


def read(blocks: DataFrame, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (binary, little-endian
    unsigned 32-bit): one row for each document, from the block table."""
    # a number for each part, so as many as the writer had tasks
    sizes = {r.part: r.n for r in blocks.groupBy("part").agg(F.sum("n_ids").cast("long").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    decode, schema = _reader(id_bits(path), before), "part int, no int, doc_id long, start long, ids binary"
    # a block holds whole documents or a piece of one; only such pieces are shuffled
    is_piece = F.exists("docs", lambda d: ~d["whole"])
    whole = blocks.where(~is_piece).mapInArrow(decode, schema).select("doc_id", "start", "ids")
    long = (blocks.where(is_piece).mapInArrow(decode, schema).groupBy("part", "no").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"),
        F.collect_list(F.struct("start", "ids")).alias("pieces"))
        .select("doc_id", "start", "pieces").mapInArrow(_joined, "doc_id long, start long, ids binary"))
    return whole.union(long)
