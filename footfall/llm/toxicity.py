"""Toxicity: FTRL-proximal logistic regression over hashed word features.

Features of a text are its distinct word unigrams, bigrams and skip-grams (two
words with one between them), lower-cased and hashed to ``DIM`` slots; words are
runs of letters. Training rows, at most about ``FIT_ROWS`` labelled documents
dealt by a hash, are spread over ``SHARDS`` groups. In each round every group
runs FTRL-proximal over its rows from the same state, leaving out features that
fewer than one row in a thousand has, and the changes are averaged (each has at
most ``DIM`` entries, so what meets in the driver is bounded by SHARDS * DIM). L1
keeps few weights, which are broadcast to score all documents.

Defined results: null or empty text has no feature and scores by the intercept
alone; without training rows of both classes the score is the (smoothed) share
of toxic rows; a document labelled more than once counts as toxic if any label
says so; null labels are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import extended, stored
from footfall.llm.wordhash import FOLD, chunks, find_words, span_hashes, windows

DIM = 1 << 22
FIT_ROWS = 15_000
SHARDS, SHARD_ROWS = 6, 2_500      # of the sample, and rows that are worth one more
ROUNDS = 8
ALPHA, BETA, L1, L2 = 3.0, 1.0, 6.0, 0.1
TOXIC_WEIGHT = 4.0         # of a toxic row's gradient

_NOT_LETTER = np.ones(256, dtype=bool)
_NOT_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def folded(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes: A-Z, and the upper-case letters of U+00C0 to U+00DE."""
    out = FOLD[data]
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    upper = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    out[upper] += 0x20
    return out


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, slots, offsets): the hashed features of texts, with repeats."""
    for lo, hi, data, at in chunks(column):
        words = find_words(data, at, _NOT_LETTER)
        h = span_hashes(folded(data), words.start, words.end)
        parts, owner = [h], [np.repeat(np.arange(hi - lo), words.counts())]
        for gap, salt in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
            first, offsets = windows(words, gap + 1)
            pair = h[first] * np.uint64(salt) + h[first + gap]
            parts.append(pair ^ (pair >> np.uint64(29)))
            owner.append(np.repeat(np.arange(hi - lo), np.diff(offsets)))
        slot = (np.concatenate(parts) % np.uint64(DIM)).astype(np.int32)
        owner = np.concatenate(owner)
        yield lo, hi, slot, owner


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows: list[np.ndarray] = []
        for lo, hi, slot, owner in features(b["text"]):
            both = np.unique(owner.astype(np.int64) * DIM + slot)
            cut = np.searchsorted(both, np.arange(hi - lo + 1) * DIM)
            slots = (both % DIM).astype(np.int32)
            rows.extend(slots[cut[i]:cut[i + 1]] for i in range(hi - lo))
        yield pa.RecordBatch.from_arrays(
            [b["shard"], b["order"], b["toxic"], pa.array([r.tobytes() for r in rows], pa.binary())],
            names=["shard", "order", "toxic", "slots"])


def _weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    w = np.sign(z) * l1 - z
    w /= (BETA + np.sqrt(n)) / ALPHA + L2
    w[np.abs(z) <= l1] = 0
    return w


_SHARD = "toxic binary, sizes binary, slots binary"


def _shard(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows of a shard as one, in training order."""
    pdf = pdf.sort_values("order")
    return pd.DataFrame({"toxic": [pdf.toxic.to_numpy(np.int8).tobytes()],
                         "sizes": [(pdf.slots.str.len() // 4).to_numpy(np.int32).tobytes()],
                         "slots": [b"".join(pdf.slots)]})


def _trainer(held, bias):
    """One pass over each shard: the changes of the state."""
    def train(shard: dict) -> dict:
        sizes = np.frombuffer(shard["sizes"], np.int32)
        rows = np.split(np.frombuffer(shard["slots"], np.int32), np.cumsum(sizes)[:-1])
        at = np.flatnonzero(np.bincount(np.concatenate(rows), minlength=DIM) > len(rows) // 1000).astype(np.int32)
        z0, n0 = np.zeros(len(at)), np.zeros(len(at))
        if held is not None:
            known, z, n = held.value
            both, here, there = np.intersect1d(at, known, assume_unique=True, return_indices=True)
            z0[here], n0[here] = z[there], n[there]
        place = np.full(DIM, -1, np.int32)
        place[at] = np.arange(len(at))
        z, n, (zb, nb) = z0.copy(), n0.copy(), bias
        for slots, y in zip(rows, np.frombuffer(shard["toxic"], np.int8).tolist(), strict=True):
            i = place[slots]
            i = i[i >= 0]
            zi, ni = z[i], n[i]
            w = _weights(zi, ni, L1)
            wb = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + wb, -35, 35)))
            g = (p - y) * (TOXIC_WEIGHT if y else 1.0)
            z[i] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[i] = ni + g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / ALPHA * wb
            nb += g * g
        moved = np.flatnonzero(n > n0)
        return {"at": at[moved].tobytes(), "z": (z - z0)[moved].astype("f4").tobytes(),
                "n": (n - n0)[moved].astype("f4").tobytes(),
                "zb": float(zb - bias[0]), "nb": float(nb - bias[1]), "rows": len(rows)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield pa.RecordBatch.from_pylist([train(b.slice(i, 1).to_pylist()[0])], schema=_CHANGES)
    return run


_CHANGES = pa.schema([("at", pa.binary()), ("z", pa.binary()), ("n", pa.binary()),
                      ("zb", pa.float64()), ("nb", pa.float64()), ("rows", pa.int64())])


class Model:
    """Sparse weights and an intercept."""

    def __init__(self, at: np.ndarray, weights: np.ndarray, bias: float):
        self.at, self.w, self.bias = at[weights != 0], weights[weights != 0], float(bias)

    def dense(self) -> np.ndarray:
        w = np.zeros(DIM, np.float32)
        w[self.at] = self.w
        return w


def fit(docs: DataFrame, labels: DataFrame, folder: str, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from ``labels.toxic`` of rows whose crc32(doc_id as text) mod 5 is not 0."""
    spark = docs.sparkSession
    marked = labels.where("doc_id is not null and toxic is not null and "
                          "crc32(cast(doc_id as string)) % 5 <> 0")
    n = marked.count()
    share = min(1.0, fit_rows / max(n, 1))
    mark = (marked.where(F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 30))
                         < int(share * (1 << 30)))
            .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    n_shards = max(1, min(SHARDS, -(-min(n, fit_rows) // SHARD_ROWS)))
    rows = (docs.select("doc_id", "text").join(F.broadcast(mark), "doc_id")      # size bound: fit_rows
            .select(F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(n_shards)).cast("int").alias("shard"),
                    F.xxhash64(F.lit("order"), "doc_id").alias("order"), "toxic", "text")
            .mapInArrow(_hashed, "shard int, order long, toxic int, slots binary"))
    # a row for each shard (FIT_ROWS bounds it), so that rounds shuffle nothing
    shards = stored(rows.groupBy("shard").applyInPandas(_shard, _SHARD), f"{folder}/toxic-shards")
    marks = np.concatenate([np.zeros(0, np.int8), *(np.frombuffer(r.toxic, np.int8)
                                                    for r in shards.select("toxic").collect())])
    bad = int(marks.sum())
    good = len(marks) - bad
    if not good or not bad:
        share = (bad + 1) / (good + bad + 2)
        return Model(np.zeros(0, np.int32), np.zeros(0), np.log(share / (1 - share)))
    state, bias = None, (0.0, 0.0)
    for _ in range(ROUNDS):
        held = spark.sparkContext.broadcast(state) if state is not None else None
        parts = shards.mapInArrow(
            _trainer(held, bias), "at binary, z binary, n binary, zb double, nb double, rows long").collect()
        if held is not None:
            held.destroy()
        total = sum(p.rows for p in parts)
        # the changes of all shards, weighted by their rows, added to the state slot by slot
        found = [state] if state is not None else []
        for p in sorted(parts, key=lambda p: (p.rows, p.zb)):
            share = p.rows / total
            found.append((np.frombuffer(p.at, np.int32), np.frombuffer(p.z, "f4") * share, np.frombuffer(p.n, "f4") * share))
            bias = (bias[0] + p.zb * share, bias[1] + p.nb * share)
        at, place = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        z, n = (np.bincount(place, weights=np.concatenate([f[k] for f in found]), minlength=len(at)) for k in (1, 2))
        state = (at[n != 0], z[n != 0], n[n != 0])
    return Model(state[0], _weights(*state[1:], L1), -bias[0] / ((BETA + np.sqrt(bias[1])) / ALPHA))


def _scorer(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        dense = model.dense()
        known = dense != 0
        for b in batches:
            total = np.full(b.num_rows, model.bias)
            texts = b["text"] if "text" in b.schema.names else b["row"].field("text")
            for lo, hi, slot, owner in features(texts):
                hit = known[slot]
                both = np.unique(owner[hit].astype(np.int64) * DIM + slot[hit])
                total[lo:hi] += np.bincount(both // DIM, weights=dense[both % DIM], minlength=hi - lo)
            score = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            rest = b.drop_columns(["text"]) if "text" in b.schema.names else b
            yield rest.append_column("score", pa.array(score))
    return run


def score(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` has a column text, which score (between 0 and 1) replaces, or a struct
    ``row`` that holds it (see ``tables.packed``), beside which score is put."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scorer(held), extended(rows.drop("text").schema, "score", "double"))
