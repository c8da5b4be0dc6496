"""LM scoring: masked pseudo-likelihood of a bidirectional window network.

Every word of a text is predicted from the two words on either side; the sum of
the conditional log-probabilities scores the text.

Vocabulary: the ``COMMON`` most frequent words of all documents (exact counts)
have ids of their own, other words share ``IDS - COMMON`` hashed ids. A word of a
shared id has the part of its probability that it has of the id's counts, so every word
of the corpus counts by itself: the counts of the most frequent ones are broadcast
(``HEAD_BYTES`` at most), those of the rest are joined by word. A word that no
document of the corpus has counts as one seen once. An id is a pair (group, member) of 64 groups and 64 members:
P(id) = P(group | context) P(member | group, context).

Network (numpy): embeddings of the four neighbours by position, a tanh layer,
a softmax over groups, and one over members that also sees the group. Training
is data-parallel: in each round every partition starts from the broadcast
weights, takes Adagrad steps over one of ``ROUNDS`` shares of its windows, so that
every window is trained on once, and returns its weights; they are averaged in a tree of groups of
``ARITY``, so neither a task nor the driver receives what grows with the input.

Defined results: null or empty text has n_tokens 0, sum 0 and a null mean; an empty
corpus leaves the network untrained; repeated rows are scored each; two words of one
64-bit hash are one word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from footfall.llm.tables import extended, stored
from footfall.llm.wordhash import FOLD, chunks, find_words, span_hashes

GROUPS = MEMBERS = 64
IDS = GROUPS * MEMBERS
COMMON = 2_048
HEAD_BYTES = 16 << 20      # of broadcast counts, at 12 bytes a word
SIDE = 2                   # words on either side
WIDTH, HIDDEN = 12, 24
ROUNDS = 2
BATCH = 1_024
RATE = 0.08
ARITY = 32

_SHAPES = {"e": (IDS + 1, WIDTH), "w1": (2 * SIDE * WIDTH, HIDDEN), "b1": (HIDDEN,),
           "wg": (HIDDEN, GROUPS), "bg": (GROUPS,), "s": (GROUPS, HIDDEN),
           "wm": (HIDDEN, MEMBERS), "bm": (GROUPS, MEMBERS)}
_PLACES = np.arange((IDS + 1) * WIDTH).reshape(IDS + 1, WIDTH)     # of the numbers of an embedding


def _hashes(column: pa.Array):
    for lo, hi, data, at in chunks(column):
        words = find_words(data, at)
        yield lo, hi, words, span_hashes(FOLD[data], words.start, words.end).view(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for _, _, _, h in _hashes(b["text"]):
            u, n = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(n)], names=["h", "n"])


class _Sorted:
    """Sorted hashes, with the place of the first one of each value of the upper bits: to
    find a hash takes as many comparisons as the largest group of one value has members."""

    def __init__(self, keys: np.ndarray):
        self.shift = 64 - max(16, min(20, 4 + len(keys).bit_length()))
        half = 1 << (63 - self.shift)
        self.first = np.searchsorted(keys >> self.shift, np.arange(-half, half)).astype(np.int32)
        self.half, self.most = half, int(np.diff(self.first, append=len(keys)).max())
        self.keys = np.append(keys, keys[-1:].repeat(self.most))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes, -1 for those not here."""
        out, first = np.full(len(h), -1), self.first[(h >> self.shift) + self.half].astype(np.int64)
        for i in reversed(range(self.most)):               # behind the last key it is repeated
            out = np.where(self.keys[first + i] == h, first + i, out)
        return out


class Vocabulary:
    """Ids of words by hash, log-counts of shared ids and of their more frequent words, and
    frequencies to start from. ``rest`` is the folder of the counts of all words if words
    that were seen twice or more are not in the head."""

    def __init__(self, common: np.ndarray, counts: np.ndarray, shared: np.ndarray,
                 head: np.ndarray, times: np.ndarray, rest: str | None):
        order = np.argsort(common)
        self.known, self.rank = _Sorted(common[order]), order.astype(np.int32)
        self.log_size = np.zeros(IDS)
        self.log_size[COMMON:] = np.log(np.maximum(shared, 1))
        self.seen = np.concatenate([counts, np.zeros(COMMON - len(counts)), shared]) + 1.0
        order = np.argsort(head)
        self.head, self.log_times, self.rest = _Sorted(head[order]), np.log(times[order]).astype(np.float32), rest

    def log_counts(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-counts of words of shared ids, 0 for those not in the head, and which are in it."""
        if not len(self.log_times):
            return np.zeros(len(h), np.float32), np.zeros(len(h), bool)
        at = self.head.find(h)
        found = at >= 0
        return np.where(found, self.log_times[at], np.float32(0)), found

    def ids(self, h: np.ndarray) -> np.ndarray:
        out = (COMMON + (h.view(np.uint64) >> np.uint64(20)) % np.uint64(IDS - COMMON)).astype(np.int32)
        if len(self.rank):
            at = self.known.find(h)
            out = np.where(at >= 0, self.rank[at], out)
        return out


def vocabulary(docs: DataFrame, folder: str) -> Vocabulary:
    """Counts over all documents; what reaches the driver is bounded by IDS and HEAD_BYTES."""
    words = stored(docs.select("text").mapInArrow(_counted, "h long, n long")
                   .groupBy("h").agg(F.sum("n").alias("n")), f"{folder}/counts")
    top = words.orderBy(F.desc("n"), "h").limit(COMMON).collect()
    common = np.array([r.h for r in top], np.int64)
    slot = F.pmod(F.shiftrightunsigned("h", 20), F.lit(IDS - COMMON))
    rest = words.join(F.broadcast(words.sparkSession.createDataFrame([(r.h,) for r in top], "h long")),
                      "h", "left_anti")
    shared = np.zeros(IDS - COMMON)
    for r in rest.groupBy(slot.alias("slot")).agg(F.sum("n").alias("n")).collect():
        shared[r.slot] = r.n
    # counts in at most 64 + 8 * 58 classes; words seen once need no place, their log is 0
    ranked = rest.where("n > 1").withColumn(
        "rank", F.when(F.col("n") <= 64, F.col("n")).otherwise(F.floor(8 * F.log2("n")) + 64))
    total, least, whole = 0, None, True
    for r in ranked.groupBy("rank").agg(F.count("*").alias("words")).orderBy(F.desc("rank")).collect():
        total += 12 * r["words"]
        if total > HEAD_BYTES:
            whole = False
            break
        least = r["rank"]
    head = ranked.where(F.lit(False) if least is None else F.col("rank") >= least).select("h", "n").toArrow()
    return Vocabulary(common, np.array([r.n for r in top], np.float64), shared, head["h"].to_numpy(),
                      head["n"].to_numpy(), None if whole else folder)


def windows(vocabulary: Vocabulary, column: pa.Array):
    """(first row, word counts of rows, ids, contexts as a function of positions)."""
    offsets = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])
    for lo, _, words, h in _hashes(column):
        counts = words.counts()
        ids = vocabulary.ids(h)
        # SIDE places of padding between texts: no window crosses from one to the next
        place = np.arange(len(ids)) + SIDE * (np.repeat(np.arange(len(counts)), counts) + 1)
        padded = np.full(len(ids) + SIDE * (len(counts) + 1), IDS, np.int32)
        padded[place] = ids
        yield lo, counts, ids, h, lambda at, p=padded, q=place: p[q[at][:, None] + offsets]


def start(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Small random weights; biases give the corpus frequencies."""
    rng = np.random.default_rng(4)
    net = {k: (rng.normal(size=s) * 0.1).astype(np.float32) for k, s in _SHAPES.items()}
    seen = vocabulary.seen.reshape(GROUPS, MEMBERS)
    net["b1"][:] = 0
    net["bg"] = np.log(seen.sum(axis=1) / seen.sum()).astype(np.float32)
    net["bm"] = np.log(seen / seen.sum(axis=1, keepdims=True)).astype(np.float32)
    return net


def _below_top(logits: np.ndarray) -> np.ndarray:
    """Less the largest of each row; numpy finds its place several times faster than its value."""
    logits -= logits[np.arange(len(logits)), logits.argmax(axis=1)][:, None]
    return logits


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = _below_top(logits)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def _log_chosen(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The columns ``at`` of the rows of ``_log_softmax``."""
    chosen = _below_top(logits)[np.arange(len(at)), at]
    return chosen - np.log(np.exp(logits, out=logits).sum(axis=1))


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits = _below_top(logits)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def forward(net: dict, context: np.ndarray, group: np.ndarray, softmax=_log_softmax):
    x = net["e"].take(context, axis=0).reshape(len(context), -1)
    h = np.tanh(x @ net["w1"] + net["b1"])
    h2 = h + net["s"][group]
    return x, h, h2, softmax(h @ net["wg"] + net["bg"]), softmax(h2 @ net["wm"] + net["bm"][group])


def step(net: dict, sums: dict, context: np.ndarray, ids: np.ndarray) -> None:
    """One Adagrad step on a batch of windows."""
    group, member = ids // MEMBERS, ids % MEMBERS
    rows = np.arange(len(ids))
    x, h, h2, dg, dm = forward(net, context, group, _softmax)
    dg[rows, group] -= 1
    dm[rows, member] -= 1
    dg /= len(ids)
    dm /= len(ids)
    dh2 = dm @ net["wm"].T
    dh = (dg @ net["wg"].T + dh2) * (1 - h * h)
    # sums by group as a product, sums by neighbour as one count with weights
    of = np.zeros((GROUPS, len(ids)), np.float32)
    of[group, rows] = 1
    places = _PLACES.take(context, axis=0).ravel()
    e = np.bincount(places, (dh @ net["w1"].T).ravel(), (IDS + 1) * WIDTH)
    grad = {"wg": h.T @ dg, "bg": dg.sum(axis=0), "wm": h2.T @ dm, "w1": x.T @ dh, "b1": dh.sum(axis=0),
            "s": of @ dh2, "bm": of @ dm, "e": e.reshape(_SHAPES["e"]).astype(np.float32)}
    for k, g in grad.items():
        sums[k] += g * g
        net[k] -= RATE * g / np.sqrt(sums[k])


def _flat(net: dict) -> bytes:
    return np.concatenate([net[k].ravel() for k in _SHAPES]).astype(np.float32).tobytes()


def _unflat(raw: bytes) -> dict:
    flat, out, at = np.frombuffer(raw, np.float32), {}, 0
    for k, s in _SHAPES.items():
        n = int(np.prod(s))
        out[k] = flat[at:at + n].reshape(s).copy()
        at += n
    return out


def _trainer(held, turn: int):
    """One pass of a partition over the round's share of its windows: part, windows used, weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, raw = held.value
        net = _unflat(raw)
        sums = {k: np.full(s, 1e-4, np.float32) for k, s in _SHAPES.items()}
        n, context, ids = 0, [], []
        for b in batches:
            for _, _, words, h, around in windows(vocabulary, b["text"]):
                # positions by a hash of word and place: each in one of the rounds
                mixed = (h.view(np.uint64) >> np.uint64(7)) + np.arange(len(h), dtype=np.uint64)
                at = np.flatnonzero(mixed % np.uint64(ROUNDS) == turn)
                context.append(around(at))
                ids.append(words[at])
                if sum(map(len, ids)) >= 64 * BATCH:
                    n += _pass(net, sums, context, ids)
                    context, ids = [], []
        if ids:
            n += _pass(net, sums, context, ids)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([_flat(net)], pa.binary())], names=["part", "n", "net"])
    return run


def _pass(net: dict, sums: dict, context: list, ids: list) -> int:
    context, ids = np.concatenate(context), np.concatenate(ids)
    order = np.random.default_rng(len(ids)).permutation(len(ids))
    for i in range(0, len(ids), BATCH):
        step(net, sums, context[order[i:i + BATCH]], ids[order[i:i + BATCH]])
    return len(ids)


def _average(pdf: pd.DataFrame) -> pd.DataFrame:
    n = pdf["n"].to_numpy()
    nets = np.array([np.frombuffer(x, np.float32) for x in pdf.sort_values("part")["net"]], np.float64)
    share = (pdf.sort_values("part")["n"].to_numpy() / n.sum())[:, None]
    return pd.DataFrame({"part": [int(pdf["part"].min()) // ARITY], "n": [int(n.sum())],
                         "net": [(nets * share).sum(axis=0).astype(np.float32).tobytes()]})


def fit(docs: DataFrame, folder: str) -> tuple[Vocabulary, dict]:
    """The vocabulary and the trained network, from all documents."""
    known = vocabulary(docs, folder)
    net = _flat(start(known))
    schema = "part long, n long, net binary"
    for turn in range(ROUNDS):
        held = docs.sparkSession.sparkContext.broadcast((known, net))
        level = 0
        nets = stored(docs.select("text").mapInArrow(_trainer(held, turn), schema), f"{folder}/nets-{turn}-0")
        while nets.limit(2).count() > 1:
            level += 1
            nets = stored(nets.withColumn("g", F.floor(F.col("part") / ARITY)).groupBy("g")
                          .applyInPandas(_average, schema), f"{folder}/nets-{turn}-{level}")
        row = nets.first()
        net = row.net if row else net
    return known, _unflat(net)


def _scorer(held):
    """Rows with n_tokens, sum_log_prob and, where counts are to be joined, a number and the
    words whose counts are not in the head."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, net = held.value
        no = TaskContext.get().partitionId() << 33
        for b in batches:
            n, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            missing, sizes = [np.zeros(0, np.int64)], np.zeros(b.num_rows, np.int64)
            for lo, counts, ids, h, around in windows(vocabulary, b["text"]):
                logs = np.zeros(len(ids))
                for i in range(0, len(ids), BATCH):
                    at = np.arange(i, min(i + BATCH, len(ids)))
                    some = ids[at]
                    group, member = some // MEMBERS, some % MEMBERS
                    *_, lg, lm = forward(net, around(at), group, lambda logits: logits)
                    logs[at] = _log_chosen(lg, group) + _log_chosen(lm, member)
                shared = np.flatnonzero(ids >= COMMON)
                times, found = vocabulary.log_counts(h[shared])
                logs -= vocabulary.log_size[ids]
                logs[shared] += times
                hi, row = lo + len(counts), np.repeat(np.arange(len(counts)), counts)
                n[lo:hi] = counts
                total[lo:hi] = np.bincount(row, logs, len(counts))
                if vocabulary.rest:
                    missing.append(h[shared[~found]])
                    sizes[lo:hi] = np.bincount(row[shared[~found]], minlength=len(counts))
            out = (b.drop_columns(["text"]).append_column("n_tokens", pa.array(n))
                   .append_column("sum_log_prob", pa.array(total)))
            if vocabulary.rest:
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(missing)))
                out = pa.RecordBatch.from_arrays(
                    [pa.StructArray.from_arrays(out.columns, names=out.schema.names),
                     pa.array(np.arange(no, no + b.num_rows)), words], names=["row", "no", "words"])
                no += b.num_rows
            yield out
    return run


def _with_rest(scored: DataFrame, folder: str) -> DataFrame:
    """The rows of ``scored`` (row, no, words), with the log-counts of ``words`` added."""
    counts = scored.sparkSession.read.schema("h long, n long").parquet(f"{folder}/counts")
    words = scored.select("no", F.explode("words").alias("h"))
    more = words.join(counts, "h").groupBy("no").agg(F.sum(F.ln(F.col("n").cast("double"))).alias("more"))
    return scored.drop("words").join(more, "no", "left").select(F.col("row").withField(
        "sum_log_prob", F.col("row")["sum_log_prob"] + F.coalesce("more", F.lit(0.0))).alias("row")).select("row.*")


def score(rows: DataFrame, vocabulary: Vocabulary, net: dict) -> DataFrame:
    """``rows`` with n_tokens, sum_log_prob and mean_log_prob in place of text."""
    held = rows.sparkSession.sparkContext.broadcast((vocabulary, net))
    schema = extended(extended(rows.drop("text").schema, "n_tokens", "long"), "sum_log_prob", "double")
    if vocabulary.rest:
        wide = StructType().add("row", schema, False).add("no", "long").add("words", ArrayType(LongType()))
        # stored, so that numbers of rows stay what they are
        out = _with_rest(stored(rows.mapInArrow(_scorer(held), wide),
                                f"{vocabulary.rest}/scored-{uuid.uuid4().hex[:12]}"), vocabulary.rest)
    else:
        out = rows.mapInArrow(_scorer(held), schema)
    return out.withColumn(
        "mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("sum_log_prob") / F.col("n_tokens")))
