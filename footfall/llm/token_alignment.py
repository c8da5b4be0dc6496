"""Alignment of two tokenizers' tokens over the same texts, by diagonal run skipping.

Tokenizer A (byte-level BPE, tokenizers library) encodes a space and the text,
tokenizer B (sentencepiece, which adds that space itself) the text, so both cover the same
bytes. ``aligned_cells`` walks along the two arrays of token ends. While both go one to
one, their difference in index stays the same: at the current shift, growing slices
of both arrays are compared whole, 8, 16, 32, ... tokens at once, and equal ones are jumped.
Where a slice differs an irregular group begins: its few tokens are merged one by one
up to the next common end, which gives the new shift. Numpy does this for many stretches of
the texts in step, each with its own shift.

An alignment is kept as its cells: a cell is a longest byte range that lies in one token
of A and one of B, so cells are the links, in order. A cell's value says what ends with
it: 1 a token of A, 2 one of B, 3 both, which also ends a group.

Tokens come from a table of the distinct units of a text, each encoded once in a worker. A
unit begins at a space behind something that is no white space: there both tokenizers
have a token boundary whatever surrounds it (A's pattern joins no space to what stands
before it, and no piece of B holds U+2581 behind another character, which is checked).
If a unit's tokens do not give back its bytes, the whole text is encoded at once and
compared.

``link_counts`` says for each pair of ids how many documents link it, and ``digests``
sums these over a document's links. Pairs up to ``HEAD`` are broadcast, the most frequent ones
if there are more; the others are joined by the pair.

Defined results: texts that are null, empty or not covered exactly by both tokenizers
have no tokens; each row is a document of its own, also where a doc_id repeats or is
null; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.tables import stored
from footfall.llm.wordhash import chunks, ragged

UNITS, UNIT_BYTES = 1_000_000, 1 << 25    # units that a worker remembers, and their bytes
PROBED = 1 << 18                          # tokens that are compared at once
LANES = 4_096                             # stretches that are walked along in step
TOGETHER = 2_000                          # new units that are encoded at once
HEAD = 1_500_000                          # id pairs that are broadcast, 17 bytes each

#: byte-level pieces name bytes by characters: printable ones stand for themselves, the
#: other bytes follow from U+0100
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_OF = {b: b for b in _SHOWN} | {0x100 + i: b for i, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}


def aligned_cells(a: np.ndarray, b: np.ndarray, cuts: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """The cells of two ascending arrays of token ends whose last values are equal. ``cuts``
    are places in both, from 0 to their lengths, before which ends are equal; the stretches
    between them are walked along in step."""
    cut_a, cut_b = cuts or (np.array([0, len(a)]), np.array([0, len(b)]))
    keep = np.append(np.diff(cut_a) > 0, True)
    cut_a, cut_b = cut_a[keep], cut_b[keep]
    if len(cut_a) < 2:
        return np.zeros(0, np.uint8)
    i, j, stop_i, stop_j = cut_a[:-1].copy(), cut_b[:-1].copy(), cut_a[1:], cut_b[1:]
    first = i + j                                # room for the cells of each stretch
    o = first.copy()
    out = np.full(len(a) + len(b), 3, np.uint8)
    live = np.arange(len(i))
    while len(live):
        probing, step = live, 8
        while len(probing):                      # probes of growing length, i and j at one shift
            ahead = np.arange(step)
            x, y = i[probing, None] + ahead, j[probing, None] + ahead
            fits = (x < stop_i[probing, None]) & (y < stop_j[probing, None])
            same = (a[np.minimum(x, len(a) - 1)] == b[np.minimum(y, len(b) - 1)]) & fits
            run = np.where(same.all(axis=1), step, same.argmin(axis=1))
            i[probing] += run
            j[probing] += run
            o[probing] += run
            probing, step = probing[run == step], step * 2
            if len(probing) * step > PROBED:     # keep the probed slices of all stretches small
                step = max(8, PROBED // len(probing))
        live = live[i[live] < stop_i[live]]
        group = live                             # irregular groups, up to their next common ends
        while len(group):
            x, y = a[i[group]], b[j[group]]
            less = x < y
            out[o[group]] = np.where(less, 1, np.where(x > y, 2, 3))
            i[group] += x <= y
            j[group] += x >= y
            o[group] += 1
            group = group[x != y]
        live = live[i[live] < stop_i[live]]
    return out[ragged(first, o - first)]


def unit_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where units begin: at each text, and at spaces behind a byte that can't end a white
    space, unless the text ends with that space."""
    n = len(data)
    first = np.zeros(n + 1, dtype=bool)
    if n > 1:
        solid = (data > 0x20) & (data != 0x7F)
        solid[1:] &= ~((data[1:] >= 0x80) & (data[:-1] == 0xC2))          # U+0085, U+00A0
        solid[2:] &= ~((data[2:] >= 0x80) & (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3))   # U+1680 to U+3000
        first[1:n] = solid[:-1] & (data[1:] == 0x20)
        ends = at[1:][at[1:] > 0] - 1
        first[ends] = False
    first[at[:-1]] = True
    return np.flatnonzero(first[:n])


class Tokenizers:
    """Both tokenizers, and the tokens of the units seen so far."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True      # their names in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.a_bytes[i] = bytes(_BYTE_OF[ord(c)] for c in piece)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        named = re.compile("<0x([0-9A-Fa-f]{2})>")
        self.b_bytes = [bytes.fromhex(m[1]) if (m := named.fullmatch(p)) else p.replace("▁", " ").encode()
                        for p in pieces]
        self.whole_only = any(re.search("[^▁]▁", p) for p in pieces)
        self.sizes = [np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes)]
        self.kinds = [np.dtype("<u2" if len(t) <= 1 << 16 else "<u4") for t in (self.a_bytes, self.b_bytes)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.good = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.at = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def encode(self, raws: list[bytes]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of A, ids of B and whether both give back the bytes, for texts behind a space."""
        texts = [r.decode() for r in raws]
        a = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        good = [b"".join([self.a_bytes[i] for i in x]) == r == b"".join([self.b_bytes[i] for i in y])
                for r, x, y in zip(raws, a, b, strict=True)]
        return a, b, good

    def _separate(self, raws: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """For A and B: ids and numbers of ids of units, each encoded by itself, and which are good."""
        a, b, good = self.encode(raws)
        return ([np.array([i for ids in x for i in ids], np.int32) for x in (a, b)],
                [np.array([len(ids) for ids in x], np.int64) for x in (a, b)], np.array(good, bool))

    def _together(self, raws: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """The same for units that end where another may begin, encoded as one text."""
        joined = b"".join(raws)
        text = joined.decode()
        ends = np.cumsum([len(r) for r in raws])
        ids = [self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:], num_threads=1)]
        counts = []
        for k, table in enumerate((self.a_bytes, self.b_bytes)):
            token_ends = np.cumsum(self.sizes[k][ids[k]])
            at = np.searchsorted(token_ends, ends)
            if b"".join([table[i] for i in ids[k]]) != joined or (token_ends[at] != ends).any():
                return self._separate(raws)
            counts.append(np.diff(at + 1, prepend=0))
        return [np.array(x, np.int32) for x in ids], counts, np.ones(len(raws), bool)

    def _learn(self, raws: list[bytes]) -> None:
        """Encode new units: those behind which another unit may begin in one text of
        ``TOGETHER`` units, the others (white space at their end) by themselves."""
        data = np.frombuffer(b"".join(raws) + b" .", np.uint8)
        edges = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
        tight = np.isin(edges[1:], unit_starts(data, np.array([0, len(data)])))
        order = [*np.flatnonzero(tight).tolist(), *np.flatnonzero(~tight).tolist()]
        n_tight = int(np.count_nonzero(tight))
        parts = []
        for low in range(0, n_tight, TOGETHER):
            parts.append(self._together([raws[i] for i in order[low:min(low + TOGETHER, n_tight)]]))
        for low in range(n_tight, len(order), TOGETHER):
            parts.append(self._separate([raws[i] for i in order[low:low + TOGETHER]]))
        for k in (0, 1):
            self.ids[k] = np.concatenate([self.ids[k], *(p[0][k] for p in parts)])
            self.at[k] = np.concatenate([self.at[k], self.at[k][-1] + np.cumsum(np.concatenate([p[1][k] for p in parts]))])
        self.good = np.concatenate([self.good, *(p[2] for p in parts)])
        first = len(self.known)
        self.known.update((raws[i], first + n) for n, i in enumerate(order))
        self.held += int(edges[-1])

    def units(self, raws: list[bytes]) -> np.ndarray:
        """Numbers of units; new ones are encoded."""
        if len(self.known) > UNITS or self.held > UNIT_BYTES:
            self.forget()
        found = list(map(self.known.get, raws))
        new = list(dict.fromkeys(r for r, k in zip(raws, found, strict=True) if k is None))
        if new:
            self._learn(new)
            found = list(map(self.known.__getitem__, raws))
        return np.array(found, np.int64)

    def tokens(self, raws: list[bytes], which: list[int]) -> tuple[np.ndarray, list]:
        """Of the texts ``raws``, those that both tokenizers cover: their places in ``which``, and
        for A and B (ids, offsets of the texts in them, places at which both have a common end)."""
        data = np.frombuffer(b"".join(raws), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
        start = np.flatnonzero(np.isin(np.arange(len(data)), at[:-1])) if self.whole_only else unit_starts(data, at)
        joined = data.tobytes()
        number = self.units([joined[s:e] for s, e in zip(start.tolist(), [*start[1:].tolist(), len(data)], strict=True)])
        row = np.searchsorted(start, at)
        good = np.add.reduceat(~self.good[number], row[:-1]) == 0
        out = []
        whole = {int(i): None for i in np.flatnonzero(~good)}
        for i in whole:                            # by the whole text
            a, b, fits = self.encode([raws[i]])
            whole[i] = (a[0], b[0]) if fits[0] else None
        covered = [i for i in range(len(raws)) if i not in whole or whole[i]]
        for k in (0, 1):
            n = self.at[k][number + 1] - self.at[k][number]
            ids = self.ids[k][ragged(self.at[k][number], n)]
            cuts = np.concatenate([[0], np.cumsum(n)])
            edges = cuts[row]
            cuts = np.append(cuts[:-1:max(1, len(n) // LANES)], cuts[-1])
            if whole:
                parts = [np.array(whole[i][k], np.int32) if i in whole else ids[edges[i]:edges[i + 1]] for i in covered]
                ids = np.concatenate([np.zeros(0, np.int32), *parts])
                cuts = edges = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
            out.append((ids, edges, cuts))
        return np.array([which[i] for i in covered], np.int64), out


@cache
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """One for each process."""
    return Tokenizers(a_path, b_path)


_ALIGNED = "row long, doc_id long, a_ids binary, b_ids binary, cells binary"


def _aligner(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(a_path, b_path)
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, at in chunks(batch["text"]):
                raw, n = data.tobytes(), hi - lo
                which = np.flatnonzero(np.diff(at)).tolist()
                columns = [[b""] * n for _ in range(3)]
                if which:
                    rows, tokens = both.tokens([b" " + raw[at[i]:at[i + 1]] for i in which], which)
                    ends = [np.cumsum(both.sizes[k][tokens[k][0]]) for k in (0, 1)]
                    cells = aligned_cells(*ends, (tokens[0][2], tokens[1][2]))
                    last = np.concatenate([[-1], np.flatnonzero(cells & 1)])[tokens[0][1]] + 1
                    for k in (0, 1):
                        ids, edges, _ = tokens[k]
                        coded, size = ids.astype(both.kinds[k]).tobytes(), both.kinds[k].itemsize
                        for i, s, e in zip(rows.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                            columns[k][i] = coded[size * s:size * e]
                    coded = cells.tobytes()
                    for i, s, e in zip(rows.tolist(), last[:-1].tolist(), last[1:].tolist(), strict=True):
                        columns[2][i] = coded[s:e]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(number, number + n), pa.int64()), batch["doc_id"].slice(lo, n),
                     *[pa.array(c, pa.binary()) for c in columns]],
                    names=["row", "doc_id", "a_ids", "b_ids", "cells"])
                number += n
    return run


def align(docs: DataFrame, a_path: str, b_path: str, folder: str) -> DataFrame:
    """The stored alignments: row (a number of its own), doc_id, a_ids and b_ids (little-endian,
    2 bytes each, 4 for a vocabulary above 65,536), cells (a byte each)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(source.mapInArrow(_aligner(a_path, b_path), _ALIGNED), f"{folder}/aligned", "zstd")


class Links:
    """The links of one alignment: ids of A and B, by cell."""

    def __init__(self, a_ids: bytes, b_ids: bytes, cells: bytes):
        self.cells = np.frombuffer(cells, np.uint8)
        ends_a, ends_b = (self.cells & 1).astype(bool), self.cells >= 2
        self.n_a, self.n_b = int(np.count_nonzero(ends_a)), int(np.count_nonzero(ends_b))
        self.a, self.b = (np.frombuffer(ids, f"<u{len(ids) // max(n, 1) or 2}").astype(np.int64)
                          for ids, n in ((a_ids, self.n_a), (b_ids, self.n_b)))
        self.at_a, self.at_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        self.group = np.cumsum(self.cells == 3) - (self.cells == 3)
        self.n_groups = int(self.group[-1]) + 1 if len(self.cells) else 0
        self.ends_a, self.ends_b = ends_a, ends_b

    def pairs(self) -> np.ndarray:
        """id of A << 32 | id of B for each link."""
        return self.a[self.at_a] << 32 | self.b[self.at_b]

    def text(self, table: np.ndarray) -> bytes:
        """The groups as text: ``a1,a2|b1;a3|b2,b3``. ``table`` is that of ``numerals``."""
        if not len(self.cells):
            return b""
        v = len(table) // 3
        whole = self.cells == 3
        group_a, group_b = self.group[self.ends_a], self.group[self.ends_b]
        a_of = np.bincount(group_a, minlength=self.n_groups)
        b_of = np.bincount(group_b, minlength=self.n_groups)
        codes = np.empty(self.n_a + self.n_b, np.int64)
        before_b = np.cumsum(b_of) - b_of
        through_a = np.cumsum(a_of)
        codes[np.arange(self.n_a) + before_b[group_a]] = self.a + v * whole[self.ends_a]
        codes[np.arange(self.n_b) + through_a[group_b]] = self.b + 2 * v * whole[self.ends_b]
        padded = table[codes].view(np.uint8)
        return padded[padded != 0].tobytes()[:-1]


def numerals(n: int) -> np.ndarray:
    """The numbers below ``n`` as text before a comma, a bar and a semicolon, padded by zero bytes."""
    return np.array([b"%d%s" % (i, end) for end in (b",", b"|", b";") for i in range(n)])


def _links_of(batch: pa.RecordBatch) -> Iterator[Links]:
    for row in zip(*(batch[c].to_pylist() for c in ("a_ids", "b_ids", "cells")), strict=True):
        yield Links(*row)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        each = [np.unique(links.pairs()) for links in _links_of(batch) if len(links.cells)]
        pair, n = np.unique(np.concatenate([np.zeros(0, np.int64), *each]), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n, pa.int64())], names=["pair", "n"])


def link_counts(aligned: DataFrame, folder: str) -> DataFrame:
    """pair (id of A << 32 | id of B), n (documents that link it), best (no pair of this id of
    A has more). The pairs of an id of A are no more than B has ids."""
    counted = aligned.select("a_ids", "b_ids", "cells").mapInArrow(_counter, "pair long, n long") \
        .groupBy("pair").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return stored(counted.withColumn("best", F.col("n") == most), f"{folder}/pairs")


class Counts:
    """Pairs in ascending order with their counts, and whether they are best."""

    def __init__(self, pair: np.ndarray, n: np.ndarray, best: np.ndarray):
        order = np.argsort(pair)
        self.pair, self.n, self.best = pair[order], n[order], best[order]

    def find(self, pair: np.ndarray) -> np.ndarray:
        """Places of pairs, -1 for those that are not here."""
        if not len(self.pair):
            return np.full(len(pair), -1)
        at = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        return np.where(self.pair[at] == pair, at, -1)


def _head(counts: DataFrame, head: int) -> tuple[Counts, bool]:
    """The most frequent pairs, at most ``head``, and whether those are all."""
    level = F.floor(8 * F.log2("n")).cast("int")                 # a few hundred levels at most
    per_level = counts.groupBy(level.alias("level")).agg(F.count("*").alias("c")).collect()
    total, least = 0, None
    for r in sorted(per_level, key=lambda r: -r.level):
        total += r.c
        if total > head:
            break
        least = r.level
    some = counts.where(level >= least) if least is not None else counts.where("false")
    got = some.select("pair", "n", "best").toArrow()
    return Counts(*(got[c].to_numpy() for c in ("pair", "n", "best"))), total <= head


_DIGEST = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups string, rest array<struct<pair: long, links: long>>")
_REST = pa.list_(pa.struct([("pair", pa.int64()), ("links", pa.int64())]))


def _digester(held):
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, table = held.value
        for batch in batches:
            rows = []
            for links in _links_of(batch):
                if not len(links.cells):
                    rows.append((0,) * 6 + ("", []))
                    continue
                pair = links.pairs()
                at = counts.find(pair)
                known = at[at >= 0]
                rest, n = np.unique(pair[at < 0], return_counts=True)
                rows.append((links.n_a, links.n_b, links.n_groups, len(pair), int(np.count_nonzero(counts.best[known])),
                             int(counts.n[known].sum()), hashlib.sha256(links.text(table)).hexdigest(),
                             [{"pair": p, "links": c} for p, c in zip(rest.tolist(), n.tolist(), strict=True)]))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], *[pa.array(c, pa.int64()) for c in columns[:6]],
                 pa.array(columns[6], pa.string()), pa.array(columns[7], _REST)],
                names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "rest"])
    return run


def digests(aligned: DataFrame, counts: DataFrame, folder: str, head: int = HEAD) -> DataFrame:
    """One row for each document: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links
    whose pair is best), count_sum (of the links' counts), groups_sha256 (of ``Links.text``, ''
    without tokens)."""
    held, whole = _head(counts, head)
    largest = counts.agg(F.max(F.shiftright("pair", 32)), F.max(F.col("pair").bitwiseAND(0xFFFFFFFF))).first()
    table = numerals(1 + max(x or 0 for x in largest))
    out = aligned.mapInArrow(_digester(aligned.sparkSession.sparkContext.broadcast((held, table))), _DIGEST)
    if not whole:
        out = stored(out, f"{folder}/digests")
        rest = (out.select("row", F.inline("rest")).join(counts, "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
            F.sum(F.col("links") * F.col("n")).alias("more")))
        out = out.join(rest, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0))})
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      F.col("groups").alias("groups_sha256"))
