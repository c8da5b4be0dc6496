"""Quality rules: a decision list learned by sequential covering.

Per-document statistics are DataFrame expressions inside one row (no shuffle of
text). The list is grown and pruned over *labelled statistics*: every statistic
is put on an integer grid, thresholds are chosen from its class histogram, and
the joint histogram of the resulting bins (at most ``(MAX_CUTS + 1) ** features``
cells for each fold, whatever the number of labelled rows) is all that rule
growth needs. One rule is a conjunction of threshold tests; rules are emitted
as an ordered ``when(...).when(...).otherwise(...)`` expression.

Defined results: null or empty text has all counts 0 and fails the base rule;
labels that are null are not used; a document labelled more than once counts
with its lowest quality; without labelled rows of both classes the list is
empty and keeps everything that passes the base rule. Rows with a null doc_id
are assessed like others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import SPACES, WORD, packed, stored, unpacked

FIT_ROWS = 20_000          # expected bound of the labelled rows used to fit
MAX_CUTS = 4               # thresholds of one statistic
MAX_RULES = 8
MAX_TESTS = 4              # tests in one conjunction
MIN_PRECISION = 0.9        # of a rule, on the pruning fold
MIN_COVER = 0.002          # share of the labelled rows that a rule must cover
GRID = 256

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["f_words", "f_word_length", "f_symbols", "f_dup_lines", "f_repeats", "f_upper"]


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts and the gridded features to a table that has the columns
    ``row`` and ``text`` (see ``tables.packed``)."""
    t = F.coalesce(F.col(text), F.lit(""))
    step = df.select(
        "row",
        F.array_remove(F.split(t, SPACES), "").alias("words"),
        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        (F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]+", ""))).alias("n_symbols"),
        (F.length(t) - F.length(F.regexp_replace(t, "[A-Z]+", ""))).alias("n_upper"),
        F.length(F.regexp_replace(t, SPACES, "")).alias("word_chars"))
    step = step.select(
        "row", "n_symbols", "n_upper", "word_chars",
        F.size("words").alias("n_words"), F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        # words hold no space, so joined windows are equal exactly if their words are
        F.when(F.size("words") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.concat_ws(" ", F.col("words")[i], F.col("words")[i + 1],
                                  F.col("words")[i + 2])))
        .otherwise(F.array().cast("array<string>")).alias("windows"))
    # documents without a repeated window need no sorting
    step = step.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
        .otherwise(F.array().cast("array<struct<w:string,i:int>>"))).drop("windows")
    step = step.withColumn("twice", F.filter("sorted", lambda e, j: (
        ((j > 0) & (F.get("sorted", j - 1)["w"] == e["w"]))
        | F.coalesce(F.get("sorted", j + 1)["w"] == e["w"], F.lit(False)))))
    step = step.withColumn("at", F.sort_array(F.col("twice.i"))).drop("sorted", "twice")
    # a window covers three words; take off what it shares with the window before
    shared = F.aggregate(
        F.transform("at", lambda x, j: F.when(
            j > 0, F.greatest(F.lit(0), 3 - (x - F.get("at", j - 1)))).otherwise(0)),
        F.lit(0), lambda a, x: a + x)
    step = step.withColumn("n_repeat_words", 3 * F.size("at") - shared).drop("at")

    def grid(c: Column) -> Column:
        return F.least(F.lit(GRID - 1), F.floor(c)).cast("int")

    def share(a: str, b: str) -> Column:
        return GRID * F.col(a) / F.greatest(F.col(b), F.lit(1))

    return step.select(
        "row", *[F.col(c).cast("long").alias(c) for c in COUNTS],
        ((F.col("n_words") < 50)
         | (100 * F.col("n_repeat_words").cast("long") > 50 * F.col("n_words").cast("long")))
        .alias("base_failed"),
        grid(8 * F.log2(1 + F.col("n_words"))).alias("f_words"),
        grid(8 * F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))).alias("f_word_length"),
        grid(share("n_symbols", "word_chars")).alias("f_symbols"),
        grid(share("n_dup_lines", "n_lines")).alias("f_dup_lines"),
        grid(share("n_repeat_words", "n_words")).alias("f_repeats"),
        grid(share("n_upper", "word_chars")).alias("f_upper"))


@dataclass(frozen=True)
class Test:
    """``feature > cut`` or ``feature <= cut`` on the integer grid."""

    feature: str
    above: bool
    cut: int

    def holds(self, value: int) -> bool:
        return (value > self.cut) == self.above

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > self.cut if self.above else c <= self.cut


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that fits rejects, else the document is kept."""

    rules: tuple[tuple[Test, ...], ...] = ()

    def kept(self) -> Column:
        verdict = None
        for rule in self.rules:
            fits = F.lit(True)
            for test in rule:
                fits = fits & test.column()
            verdict = (F if verdict is None else verdict).when(fits, F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))


def _entropy(good: float, bad: float) -> float:
    n = good + bad
    return -sum(x / n * math.log2(x / n) for x in (good, bad) if x) * n if n else 0.0


def choose_cuts(histogram: list[tuple[int, int, int]], limit: int = MAX_CUTS) -> list[int]:
    """Up to ``limit`` thresholds of one statistic, best class split first, from
    its ``(value, good, bad)`` rows; ties go to the smaller value."""
    rows = sorted(histogram)
    spans, cuts = [(0, len(rows))], []
    while len(cuts) < limit:
        best = None
        for s, (lo, hi) in enumerate(spans):
            good, bad = sum(r[1] for r in rows[lo:hi]), sum(r[2] for r in rows[lo:hi])
            whole, g, b = _entropy(good, bad), 0, 0
            for k in range(lo, hi - 1):
                g, b = g + rows[k][1], b + rows[k][2]
                gain = whole - _entropy(g, b) - _entropy(good - g, bad - b)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, s, k)
        if best is None:
            break
        _, s, k = best
        lo, hi = spans[s]
        spans[s:s + 1] = [(lo, k + 1), (k + 1, hi)]
        cuts.append(rows[k][0])
    return sorted(cuts)


def cover(cells: list[tuple[tuple[int, ...], int, int, int, int]], tests: list[Test],
          order: list[str] = FEATURES) -> DecisionList:
    """Sequential covering over ``(values, good and bad to grow on, good and bad
    to prune on)`` cells; a rule aims at bad documents."""
    place = {f: i for i, f in enumerate(order)}
    total = sum(sum(c[1:]) for c in cells)
    rules: list[tuple[Test, ...]] = []

    def of(cs, rule):
        return [c for c in cs if all(t.holds(c[0][place[t.feature]]) for t in rule)]

    def sums(cs, k):
        return sum(c[k] for c in cs), sum(c[k + 1] for c in cs)

    while len(rules) < MAX_RULES:
        rule: tuple[Test, ...] = ()
        inside = cells
        while len(rule) < MAX_TESTS:
            good, bad = sums(inside, 1)
            if not good or not bad:
                break
            before = math.log2(bad / (bad + good))
            best = None
            for t in tests:
                if t in rule:
                    continue
                g, b = sums(of(inside, (t,)), 1)
                if b and (gain := b * (math.log2(b / (b + g)) - before)) > 1e-9 and (
                        best is None or gain > best[0] + 1e-9):
                    best = (gain, t)
            if best is None:
                break
            rule += (best[1],)
            inside = of(inside, (best[1],))

        def worth(r):
            g, b = sums(of(cells, r), 3)
            return (b - g) / (b + g) if b + g else -1.0

        # drop final tests as long as the pruning fold likes the shorter rule better
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())
        fits = of(cells, rule) if rule else []
        good, bad = sums(fits, 3)
        if not rule or not bad or bad < MIN_PRECISION * (good + bad) \
                or sum(sum(c[1:]) for c in fits) < MIN_COVER * total:
            break
        rules.append(rule)
        chosen = {c[0] for c in fits}
        cells = [c for c in cells if c[0] not in chosen]
    return DecisionList(tuple(rules))


def fit(docs: DataFrame, labels: DataFrame, folder: str, fit_rows: int = FIT_ROWS) -> DecisionList:
    """Learn the list from the documents that ``labels.quality`` marks. At most
    about ``fit_rows`` labelled rows, dealt by a hash of doc_id, are used."""
    marked = labels.where("doc_id is not null and quality is not null")
    n = marked.count()
    share = min(1.0, fit_rows / max(n, 1))
    mark = (marked.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30))
                         < int(share * (1 << 30)))
            .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    part = docs.select("doc_id", "text").join(F.broadcast(mark), "doc_id")   # size bound: fit_rows
    seen = statistics(packed(part, text=F.col("text")))
    seen = stored(seen.select(
        *FEATURES, F.col("row.quality").alias("quality"),
        F.pmod(F.xxhash64(F.lit("fold"), "row.doc_id"), F.lit(3)).alias("fold")),
        f"{folder}/labelled")
    good = F.sum(F.when(F.col("quality") > 0, 1).otherwise(0))
    bad = F.sum(F.when(F.col("quality") > 0, 0).otherwise(1))
    # at most GRID rows for each statistic
    grown = seen.where("fold > 0").unpivot("quality", FEATURES, "feature", "value") \
        .groupBy("feature", "value").agg(good.alias("good"), bad.alias("bad")).collect()
    cuts = {f: choose_cuts([(r.value, r.good, r.bad) for r in grown if r.feature == f])
            for f in FEATURES}

    def binned(f):            # the largest cut below the value, or the first
        c = F.lit(-1)
        for cut in cuts[f]:
            c = F.when(F.col(f) > cut, F.lit(cut + 1)).otherwise(c)
        return c.alias(f)

    # proven bound: (MAX_CUTS + 1) ** len(FEATURES) cells
    cells = seen.select(*[binned(f) for f in FEATURES], "quality", "fold").groupBy(*FEATURES).agg(
        *[F.sum(F.when((F.col("quality") > 0) == is_good, 1).otherwise(0)
                * F.when((F.col("fold") > 0) == grow, 1).otherwise(0)).alias(f"{grow}_{is_good}")
          for grow in (True, False) for is_good in (True, False)]).collect()
    tests = [Test(f, above, c) for f in FEATURES for c in cuts[f] for above in (True, False)]
    return cover(sorted((tuple(r[:len(FEATURES)]), *r[len(FEATURES):]) for r in cells), tests)


def assess(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """doc_id, the five counts, base_failed, kept, and the gridded features."""
    seen = statistics(packed(docs.select("doc_id", "text"), text=F.col("text")))
    return seen.select(F.col("row.doc_id").alias("doc_id"), *COUNTS, "base_failed",
                       (~F.col("base_failed") & rules.kept()).alias("kept"), *FEATURES)


def keep_good(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    seen = statistics(packed(docs, text=F.col("text")))
    return unpacked(seen, docs.schema, ~F.col("base_failed") & rules.kept())
