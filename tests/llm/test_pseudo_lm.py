import numpy as np
from pyspark.sql import functions as F

from footfall.llm import pseudo_lm as lm
from footfall.llm.tables import table
from tests.conftest import SF_ORACLE
from tests.llm.helpers import ODD_TEXTS, WORD, documents, folder


def test_training_beats_frequencies_and_order_matters(spark):
    docs = table(spark, SF_ORACLE, "documents").select("doc_id", "text")
    known, net = lm.fit(docs, folder(spark))

    def mean(d, n):
        r = lm.score(d, known, n).agg(F.sum("sum_log_prob"), F.sum("n_tokens")).first()
        return r[0] / r[1]

    trained, plain = mean(docs, net), mean(docs, lm.start(known))
    assert trained > plain + 0.05
    # the same words of each document in another order: counts are equal, only the order differs
    moved = docs.select("doc_id", F.array_join(F.transform(F.array_sort(F.transform(
        F.split("text", " "), lambda w, i: F.struct(F.xxhash64(F.col("doc_id"), i).alias("h"), w.alias("w")))),
        lambda x: x["w"]), " ").alias("text"))
    assert mean(moved, net) < trained - 0.1


def test_scores_are_sums_of_a_distribution(spark):
    texts = ["the cat sat on the mat", "a b", "x"]
    known, net = lm.fit(documents(spark, texts * 30), folder(spark))
    context = np.full((1, 4), lm.IDS, np.int32)
    total = 0.0
    for g in range(lm.GROUPS):
        *_, lg, lm_ = lm.forward(net, context, np.array([g]))
        total += float(np.exp(lg[0, g]) * np.exp(lm_[0]).sum())
    assert abs(total - 1) < 1e-4
    one = lm.score(documents(spark, ["x"]), known, net).first()
    i = int(known.ids(next(lm._hashes(__import__("pyarrow").array(["x"])))[3])[0])
    *_, lg, lm_ = lm.forward(net, context, np.array([i // 64]))
    assert abs(one.sum_log_prob - float(lg[0, i // 64] + lm_[0, i % 64] - known.log_size[i])) < 1e-4


def test_odd_texts_and_empty_tables(spark):
    docs = documents(spark, ODD_TEXTS).selectExpr("doc_id", "text", "1 as h", "2 as n", "3 as part")
    known, net = lm.fit(docs, folder(spark))
    out = lm.score(docs, known, net).collect()
    assert len(out) == len(ODD_TEXTS)
    for r in out:
        n = len(WORD.findall(ODD_TEXTS[r.doc_id] or ""))
        assert r.n_tokens == n and (r.sum_log_prob < 0 if n else r.sum_log_prob == 0)
        assert (r.mean_log_prob is None) == (n == 0)
    known, net = lm.fit(docs.limit(0), folder(spark))
    assert lm.score(docs.limit(0), known, net).count() == 0


def test_weights_are_averaged_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(lm, "ARITY", 2)
    docs = table(spark, SF_ORACLE, "documents").select("doc_id", "text").repartition(7)
    known, net = lm.fit(docs, folder(spark))
    assert all(np.isfinite(w).all() for w in net.values())


def test_every_window_is_trained_on_once(spark):
    docs = table(spark, SF_ORACLE, "documents").select("doc_id", "text").limit(200).union(
        documents(spark, ["a b c", "d", "e f"] * 20).select("doc_id", "text"))
    where = folder(spark)
    known, net = lm.fit(docs, where)
    words = lm.score(docs, known, net).agg(F.sum("n_tokens")).first()[0]
    used = [spark.read.parquet(f"{where}/nets-{t}-0").agg(F.sum("n")).first()[0] for t in range(lm.ROUNDS)]
    assert sum(used) == words and min(used) > 0.4 * words


def test_step_follows_the_gradient():
    rng = np.random.default_rng(1)
    known = lm.Vocabulary(np.zeros(0, np.int64), np.zeros(0), np.ones(lm.IDS - lm.COMMON),
                          np.zeros(0, np.int64), np.zeros(0), None)
    context, ids = rng.integers(0, 40, (64, 4)), rng.integers(0, 4096, 64)
    net = lm.start(known)
    group, member, rows = ids // 64, ids % 64, np.arange(64)

    def loss(n):
        *_, lg, lm_ = lm.forward({k: v.astype(np.float64) for k, v in n.items()}, context, group)
        return -(lg[rows, group] + lm_[rows, member]).mean()

    sums = {k: np.zeros(v.shape) + 1e6 for k, v in net.items()}
    moved = {k: v.astype(np.float64) for k, v in net.items()}
    lm.step(moved, sums, context, ids)
    for k, at in (("e", (int(context[0, 0]), 3)), ("s", (int(group[0]), 2)), ("bm", (int(group[0]), 5)), ("w1", (4, 4))):
        up, down = ({n: v.astype(np.float64) for n, v in net.items()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        slope = (loss(up) - loss(down)) / 2e-5
        assert abs((net[k][at] - moved[k][at]) / lm.RATE * 1e3 - slope) < 0.02 * abs(slope) + 1e-5


def test_words_of_a_shared_id_have_their_own_counts(spark, monkeypatch):
    common = [" ".join(f"c{i}" for i in range(lm.COMMON))] * 31
    times = {f"r{i}": 1 + i * i % 29 for i in range(3000)}
    docs = documents(spark, common + [" ".join(w for w, n in times.items() if n > k) for k in range(30)])
    queries = documents(spark, [*times, "never seen", "c0", "r5 c1 r7"])

    def scores(head_bytes):
        monkeypatch.setattr(lm, "HEAD_BYTES", head_bytes)
        known = lm.vocabulary(docs, folder(spark))
        net = lm.start(known)
        assert (known.rest is None) == (head_bytes > 40_000)
        return known, {r.doc_id: r.sum_log_prob for r in lm.score(queries, known, net).collect()}

    known, all_in_head = scores(1 << 20)
    _, some_in_head = scores(20_000)
    _, none_in_head = scores(0)
    assert len(all_in_head) == len(times) + 3
    for other in (some_in_head, none_in_head):
        assert all(abs(all_in_head[i] - other[i]) < 1e-5 for i in all_in_head)
    ids = known.ids(np.concatenate([h for *_, h in lm._hashes(__import__("pyarrow").array(list(times)))]))
    assert (ids >= lm.COMMON).all()
    # in one context, the words of a shared id have probabilities in the proportion of their counts
    first, pairs = {}, 0
    for d, (i, n) in enumerate(zip(ids.tolist(), times.values(), strict=True)):
        e, m = first.setdefault(i, (d, n))
        pairs += n != m
        assert abs(all_in_head[d] - all_in_head[e] - np.log(n / m)) < 1e-5
    assert pairs > 500


def test_chosen_columns_are_those_of_the_whole_distribution():
    rng = np.random.default_rng(3)
    for rows in (0, 1, 7, lm.BATCH):
        logits = (rng.normal(size=(rows, lm.GROUPS)) * 9).astype(np.float32)
        logits[::3] = np.round(logits[::3])                # the largest may be there twice
        at = rng.integers(0, lm.GROUPS, rows)
        top = logits - logits.max(axis=1, keepdims=True)
        plain = top - np.log(np.exp(top).sum(axis=1, keepdims=True))
        assert (lm._below_top(logits.copy()) == top).all()
        assert (lm._log_softmax(logits.copy()) == plain).all()
        assert (lm._log_chosen(logits.copy(), at) == plain[np.arange(rows), at]).all()


def test_scores_do_not_make_whole_distributions(spark, monkeypatch):
    docs = documents(spark, ["the cat sat on the mat", "", None])
    known, net = lm.fit(docs, folder(spark))
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["the cat sat on the mat", "", None])})
    want = [r.sum_log_prob for r in lm.score(docs, known, net).orderBy("doc_id").collect()]
    real = lm.forward
    monkeypatch.setattr(lm, "forward", lambda n, c, g, softmax: real(n, c, g, softmax))
    monkeypatch.setattr(lm, "TaskContext", type("T", (), {"get": lambda: type("P", (), {"partitionId": lambda: 0})}))
    held = type("H", (), {"value": (known, net)})
    assert [x for b in lm._scorer(held)(iter([batch])) for x in b["sum_log_prob"].to_pylist()] == want


def test_hashes_are_found_by_their_upper_bits():
    rng = np.random.default_rng(6)
    most = np.iinfo(np.int64).max
    for keys in ([], [7], [-most - 1, -1, 0, most], range(3000), rng.integers(-most, most, 5000), range(most - 50, most)):
        keys = np.unique(np.array(keys, np.int64))
        asked = np.concatenate([keys, keys - 1, rng.integers(-most, most, 2000)])
        want = [dict(zip(keys.tolist(), range(len(keys)), strict=True)).get(h, -1) for h in asked.tolist()] \
            if len(keys) < 60 else np.where(np.isin(asked, keys), np.searchsorted(keys, asked), -1).tolist()
        assert lm._Sorted(keys).find(asked).tolist() == want
