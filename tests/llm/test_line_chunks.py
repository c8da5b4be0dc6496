import random
from collections import defaultdict

from footfall.llm import line_chunks as lc
from footfall.llm.tables import table
from tests.conftest import SF_ORACLE
from tests.llm.helpers import ODD_TEXTS, documents, folder

PASSAGE = "\n".join(" ".join(f"p{i}x{j}" for j in range(22)) for i in range(3))


def got(spark, docs):
    return {r.doc_id: r.text for r in lc.without_repeats(docs, folder(spark)).select("row.doc_id", "text").collect()}


def gone(spark, docs):
    """(doc_id, line) of the lines with words that go."""
    texts = {r.doc_id: (r.text or "").split("\n") for r in docs.select("doc_id", "text").collect()}
    return {(r.doc_id, n) for r in lc.repeated(docs, folder(spark)).collect()
            for n in range(r["first"], r["last"] + 1) if texts[r.doc_id][n].split()}


def by_line(texts):
    """Words of the longest run of equal lines over each line with words that any other place has,
    smaller and of any order, by growing every pair of equal lines; chunks take no part."""
    lines = {d: (t or "").split("\n") for d, t in texts.items()}
    places = defaultdict(list)
    for d, x in sorted(lines.items()):
        for n, line in enumerate(x):
            if line.split():
                places[line].append((d, n))
    longest = defaultdict(int)
    for at in places.values():
        for i, (d, n) in enumerate(at):
            for e, m in at[:i]:
                a, b, k = lines[d], lines[e], 1
                if n and m and a[n - 1] == b[m - 1]:
                    continue                     # begins at an earlier line
                while n + k < len(a) and m + k < len(b) and a[n + k] == b[m + k]:
                    k += 1
                lo = 0
                while not a[n + lo].split():
                    lo += 1
                words = sum(len(x.split()) for x in a[n:n + k])
                for j in range(lo, k):
                    if a[n + j].split():
                        longest[d, n + j] = max(longest[d, n + j], words)
    return longest


def agrees(removed, longest):
    """Nothing goes but repeats of enough words, and all those go that the method promises."""
    assert removed <= {p for p, w in longest.items() if w >= lc.MIN_WORDS}
    assert removed >= {p for p, w in longest.items() if w >= lc.REACH}


def test_whole_table_against_line_runs(spark):
    docs = table(spark, SF_ORACLE, "documents")
    removed, longest = gone(spark, docs), by_line({r.doc_id: r.text for r in docs.collect()})
    agrees(removed, longest)
    shorter = [p for p, w in longest.items() if lc.MIN_WORDS <= w < lc.REACH]
    assert len(removed) > 100 and len(removed & set(shorter)) >= 0.9 * len(shorter)


def test_passages_go_and_clean_texts_stay(spark):
    clean = ["\n".join(" ".join(f"c{d}l{i}w{j}" for j in range(5 + i)) for i in range(30)) for d in range(4)]
    texts = [*ODD_TEXTS, clean[0], clean[1] + "\n" + PASSAGE + "\n" + clean[2], clean[3],
             "new line\n" + PASSAGE, PASSAGE]
    n = len(ODD_TEXTS)
    docs = documents(spark, texts)
    out = got(spark, docs)
    agrees(gone(spark, docs), by_line(dict(enumerate(texts))))
    assert [out[n], out[n + 1], out[n + 2]] == texts[n:n + 3]
    assert out[n + 3] == "new line" and out[n + 4] == ""
    assert [out[i] for i in range(n - 1)] == ODD_TEXTS[:-1]


def test_insertions_move_no_other_boundary():
    lines = [" ".join(f"w{i}x{j}" for j in range(4)) for i in range(200)]
    text, other = "\n".join(lines), "\n".join([*lines[:50], "an inserted line", *lines[50:]])
    cuts = [{t.split("\n")[f] for f, _ in lc.chunks(t)} for t in (text, other)]
    far = set(lines[:40] + lines[62:])
    assert cuts[0] & far == cuts[1] & far
    assert 20 < len(cuts[0]) < 120


def test_chunks_partition_and_every_window_has_a_boundary():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 3, 8, 12, 19, 20, 30]) for _ in range(rng.randrange(1, 40))]
        text = "\n".join(" ".join(f"{rng.randrange(3)}" for _ in range(n)) for n in sizes)
        x, parts = lc._Lines(text), lc.chunks(text)
        words = [n for n, size in enumerate(sizes) if size]
        assert [n for f, e in parts for n in range(f, e + 1) if sizes[n]] == words
        assert all(f <= e < g for (f, e), (g, _) in zip(parts, parts[1:], strict=False))
        starts = set(x.starts()) if words else set()
        for i in range(len(x.at)):
            j = i
            while j < len(x.at) and x.size[j] < lc.LONG and x.before[j + 1] - x.before[i] < lc.SPAN:
                j += 1
            if j < len(x.at) and x.size[j] < lc.LONG:
                assert starts & set(range(i + 1, j + 1))


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, PASSAGE), (None, PASSAGE), (5, PASSAGE), (5, PASSAGE), (9, PASSAGE), (10, None),
            (5, "x\n" + PASSAGE), (None, "y\n" + PASSAGE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as row", "2 as gone", "3 as removed", "4 as h", "5 as listed", "6 as key", "7 as of", "8 as runs")
    out = lc.without_repeats(docs, folder(spark)).selectExpr(
        "row.doc_id", "removed", "runs", "coalesce(text, '-') text", "row.listed").collect()
    found = sorted((r.doc_id or -1, r.removed, r.runs, r.text) for r in out)
    # of the two texts of doc 5, the one whose hash is smaller keeps the passage
    assert [f for f in found if f[0] != 5] == [(-1, 3, 1, ""), (-1, 3, 1, ""), (-1, 3, 1, "y"), (9, 3, 1, ""), (10, 0, 0, "-")]
    five = [f for f in found if f[0] == 5]
    assert five in ([(5, 0, 0, PASSAGE), (5, 0, 0, PASSAGE), (5, 3, 1, "x")],
                    [(5, 0, 0, "x\n" + PASSAGE), (5, 3, 1, ""), (5, 3, 1, "")])
    assert {r.listed for r in out} == {5}
    assert lc.without_repeats(docs.limit(0), folder(spark)).count() == 0


def test_passages_of_short_lines_go_whatever_surrounds_them(spark):
    rng = random.Random(5)

    def lines(words, name):
        out, n = [], 0
        while n < words:
            out.append(" ".join(f"{name}x{n + j}" for j in range(rng.randint(1, 19))))
            n += len(out[-1].split())
        return out

    planted = [lines(rng.randint(50, 100), f"p{i}") for i in range(30)]
    planted[3].insert(2, "")
    planted[4].insert(2, " ".join(f"long{i}" for i in range(30)))
    texts, rest = {}, {}
    for i in range(120):
        before, after = lines(40, f"b{i}"), lines(40, f"a{i}")
        texts[i] = "\n".join(before + planted[i % 30] + after)
        rest[i] = texts[i] if i < 30 else "\n".join(before + after)
    assert got(spark, documents(spark, list(texts.values()))) == rest


def test_joined_lists_give_the_broadcast_result(spark, monkeypatch):
    docs = table(spark, SF_ORACLE, "documents").limit(300).union(table(spark, SF_ORACLE, "documents").limit(20))
    both = []
    for most in (lc.LISTED, 0):
        monkeypatch.setattr(lc, "LISTED", most)
        out = lc.without_repeats(docs, folder(spark)).selectExpr("row.doc_id", "removed", "text")
        both.append(sorted(map(str, map(tuple, out.collect()))))
    assert both[0] == both[1]
