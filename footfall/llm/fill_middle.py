"""Fill-in-middle transformation with a Fenwick tree over text blocks.

A text is a row of units: a run of ASCII letters, or any other code point. Two
numbers of units, drawn by a hash of the doc_id, cut it into prefix, middle and
suffix. To find the byte where unit k begins, a text is seen as blocks of ``BLOCK``
bytes, and a Fenwick tree holds the number of units and of code points that begin
in each block. Binary lifting goes down the tree to the block in which unit k
begins, with the units and code points before it; only that block is then
searched. A cut costs the logarithm of the number of blocks and one block, and a
text is neither split into a list of units nor decoded.

Outputs are ``<P>prefix<S>suffix<M>middle`` (psm), ``<S>suffix<P>prefix<M>middle``
(spm) or the text itself (plain). A text that is cut holds none of the three marks, and
no mark can arise across a cut (none has a proper prefix that is also its end), so
``restored`` rebuilds the exact text.

Defined results: null and empty texts are empty and plain; a text with a mark
is plain; equal cuts give an empty middle; a null doc_id draws as an empty one;
rows that share a doc_id have the same draws, each on its own text; extra columns are
left alone in ``row``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import packed
from footfall.llm.wordhash import chunks

BLOCK = 256
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED, FIM_PERCENT, SPM_PERCENT = 1, 90, 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def unit_starts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a unit begins at each byte, and whether a code point does; ``at`` has the
    offsets of the texts, whose edges end units."""
    letter = _LETTER[data]
    points = (data & 0xC0) != 0x80
    units = points.copy()
    units[1:] &= ~(letter[1:] & letter[:-1])
    edges = at[:-1][at[:-1] < len(data)]
    units[edges] = True
    return units, points


class BlockTree:
    """Fenwick tree of the units and code points that begin in each block of a text."""

    def __init__(self, units: np.ndarray, points: np.ndarray, block: int = BLOCK):
        self.units, self.points, self.block = units, points, block
        edges = np.arange(0, len(units), block)
        self.tree = [self._built(np.add.reduceat(x, edges, dtype=np.int64) if len(edges) else np.zeros(0, np.int64))
                     for x in (units, points)]
        self.n_blocks = len(edges)

    @staticmethod
    def _built(counts: np.ndarray) -> list[int]:
        """Node i holds the sum of the blocks i - lowest set bit of i up to i - 1."""
        sums = np.concatenate([[0], np.cumsum(counts)])
        i = np.arange(len(sums))
        return (sums - sums[i - (i & -i)]).tolist()

    def total(self, which: int = 0) -> int:
        """Units (0) or code points (1) of the text."""
        node, out = self.n_blocks, 0
        while node:
            out += self.tree[which][node]
            node &= node - 1
        return out

    def place(self, k: int) -> tuple[int, int]:
        """The byte where unit ``k`` begins and the code points before it; the end of the
        text for the number of its units."""
        units, points = self.tree
        node = before = chars = 0
        step = 1 << self.n_blocks.bit_length()
        while step := step >> 1:              # the most blocks with no more than k units
            if node + step <= self.n_blocks and before + units[node + step] <= k:
                node += step
                before += units[node]
                chars += points[node]
        if node == self.n_blocks:
            return len(self.units), chars
        low = node * self.block
        inside = int(np.flatnonzero(self.units[low:low + self.block])[k - before])
        return low + inside, chars + int(np.count_nonzero(self.points[low:low + inside]))


def draws(doc_id: int | str | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 from the hash of a doc_id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4))


def transformed_text(doc_id: int | str | None, raw: bytes, units: np.ndarray, points: np.ndarray,
                     seed: int = SEED) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    tree = BlockTree(units, points)
    n = tree.total()
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or h3 % 100 >= FIM_PERCENT or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, raw
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, chars_a), (b, chars_b) = tree.place(first), tree.place(second)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    if h4 % 100 < SPM_PERCENT:
        form, out = "spm", SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    else:
        form, out = "psm", PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return n, form, chars_a, chars_b - chars_a, out


def _transformer(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b["id"].to_pylist()
            for lo, hi, data, at in chunks(b["text"]):
                units, points = unit_starts(data, at)
                raw = data.tobytes()
                cuts = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
                rows = [transformed_text(names[lo + i], raw[s:e], units[s:e], points[s:e], seed)
                        for i, (s, e) in enumerate(cuts)]
                n, form, before, middle, out = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b["row"].slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(form), pa.array(before, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
                    names=["row", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """One row for each document: row (its columns but text), n (units), form,
    prefix_chars, middle_chars (code points, null if plain), output."""
    rest = [c for c in docs.columns if c != "text"]
    named = packed(docs.select(*[f"`{c}`" for c in rest], F.col("text")),
                   id=F.col("doc_id").cast("string"), text=F.col("text"))
    named = named.select(F.struct(*[F.col("row")[c].alias(c) for c in rest]).alias("row"), "id", "text")
    schema = named.select("row").schema
    for name, kind in (("n", "long"), ("form", "string"), ("prefix_chars", "long"), ("middle_chars", "long"),
                       ("output", "string")):
        schema = schema.add(name, kind)
    return named.mapInArrow(_transformer(seed), schema)


def restored(output: Column, form: Column) -> Column:
    """The text of an output, rebuilt from it and its form alone."""
    p, s, m = (F.lit(x.decode()) for x in (PREFIX, SUFFIX, MIDDLE))

    def head(x: Column) -> Column:
        """x without its first mark."""
        return F.substring(x, 4, 2 ** 31 - 1)

    def before(x: Column, mark: Column) -> Column:
        return F.call_function("substring_index", x, mark, F.lit(1))

    def after(x: Column, mark: Column) -> Column:
        return F.call_function("substring_index", x, mark, F.lit(-1))

    middle = after(output, m)
    psm = F.concat(head(before(output, s)), middle, before(after(output, s), m))
    spm = F.concat(before(after(output, p), m), middle, head(before(output, p)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
