"""Line dedup against brute force over all pairs of lines."""

import random

import pytest
from pyspark.sql import functions as F

from amity.llm import lines as L

KIND = "doc_id bigint, text string, D string, _l_gone int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def threshold(a, b, bands):
    return max((e for least, e in bands if min(len(a), len(b)) >= least), default=0)


def places(rows):
    """Each line with a word and where it stands: {line: [(doc, line number)]}."""
    seen = {}
    for i, t, *_ in {(r[0], r[1]) for r in rows}:
        for n, line in enumerate((t or "").split("\n") if t is not None else []):
            if line.strip(" \t\n\x0b\f\r"):
                seen.setdefault(line, []).append((L.LAST if i is None else i, n))
    return {line: sorted(at) for line, at in seen.items()}


def brute(rows, least, bands=L.BANDS):
    """(doc, line, class doc, class line, near, dropped, kept doc, kept line)
    of every line with a twin: classes by all pairs within their threshold; in
    the order of their first places, a line stays unless an earlier one that
    stays is within its threshold."""
    seen = places(rows)
    texts = sorted(seen, key=lambda x: seen[x][0])
    root, links = {x: x for x in texts}, {x: [] for x in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[i + 1:]:
            e = threshold(a, b, bands)
            if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= e and distance(a, b) <= e:
                links[b].append(a)  # a is the earlier one
                if find(a) != find(b):
                    root[find(b)] = find(a)
    by, out, groups = {}, [], {}
    for x in texts:
        by[x] = next((a for a in links[x] if by[a] == a), x)
        groups.setdefault(find(x), []).append(x)
    for members in groups.values():
        rep = min(seen[m][0] for m in members)
        if sum(len(seen[m]) for m in members) > 1:
            for m in members:
                stand = seen[by[m]][0]
                out += [(*p, *rep, seen[m][0] != rep, len(m) >= least and p != stand, *(stand if len(m) >= least else p)) for p in seen[m]]
    return sorted(out)


def rows_of(classes):
    return sorted({(r.d, r.n, r.rep_d, r.rep_n, r.near, r.dropped, r.by_d, r.by_n) for r in classes.collect()})


def sound(rows, got, bands=L.BANDS):
    """Every dropped line is a copy of the kept line that stands for it, or
    within its threshold of it."""
    at = {p: line for line, where in places(rows).items() for p in where}
    dropped = {(r[0], r[1]) for r in got if r[5]}
    for r in got:
        a, b = at[r[0], r[1]], at[r[6], r[7]]
        assert (r[6], r[7]) not in dropped
        assert a == b or distance(a, b) <= threshold(a, b, bands)


def documents():
    rnd = random.Random(4)
    words = ["alpha", "bêta", "gamma", "delta", "日本", "zeta", "eta", "theta"]
    base = [" ".join(rnd.choices(words, k=rnd.randint(2, 12))) for _ in range(60)]

    def edit(s):
        p = rnd.randrange(len(s))
        return rnd.choice([s[:p] + s[p + 1:], s[:p] + "#" + s[p:], s[:p] + "é" + s[p + 1:], s])

    rows = []
    for k in range(120):
        lines = [rnd.choice([s, edit(s), edit(edit(s))]) for s in rnd.choices(base, k=rnd.randint(0, 6))]
        rows.append((300 - k, "\n".join([*lines, "", "  "][:rnd.randint(0, 8)]), "x", 1))
    # many lines that share almost everything, and chains of single edits
    rows += [(1000 + k, f"serial number {k:04d} of the very same boilerplate line", "x", 1) for k in range(0, 400, 7)]
    rows += [(2000, None, "x", 1), (2001, "", None, None), (None, base[0] + "\n" + base[1], "x", 1),
             (2002, base[0] + "\nunique line number one here", "x", 1), (2002, base[0] + "\nunique line number one here", "x", 1),
             (2003, ("long " * 300) + "\n" + ("long " * 299) + "lung ", "x", 1)]
    return rows


@pytest.mark.parametrize("group", [500, 3])
def test_classes_equal_brute_force(spark, group):
    rows = documents()
    df = spark.createDataFrame(rows, KIND).repartition(3)
    got, want = rows_of(L.line_classes(df, group=group, listed=group)), brute(rows, L.MIN_CHARS)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    if group == 500:  # every link is listed
        assert got == want
    sound(rows, got)


def test_texts_lose_exactly_the_repeated_lines(spark):
    rows = [r for r in documents() if r[0] is None or not 1000 <= r[0] < 1400]
    df = spark.createDataFrame(rows, KIND)
    out = L.drop_repeated_lines(df)
    assert out.columns == df.columns
    gone = {(r[0], r[1]) for r in brute(rows, L.MIN_CHARS) if r[5]}
    want = sorted((str(i), str(None if t is None else "\n".join(
        x for n, x in enumerate(t.split("\n")) if (L.LAST if i is None else i, n) not in gone))) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), str(r.text)) for r in out.collect()) == want


def test_numbered_lines_stay(spark):
    rows = [(k, f"serial number {k:04d} of the very same boilerplate line", "x", 1) for k in range(300)]
    got = rows_of(L.line_classes(spark.createDataFrame(rows, KIND)))
    assert {r[2:4] for r in got} == {(0, 0)}  # one class
    sound(rows, got)
    kept = [rows[r[0]][1] for r in got if not r[5]]
    beyond = [r for r in got if all(distance(rows[r[0]][1], k) > 1 for k in kept if k != rows[r[0]][1])]
    assert len(kept) >= 30 and not any(r[5] for r in beyond)


@pytest.mark.parametrize("orderly", [0, 1, 12])
def test_what_stays_is_settled_in_rounds(spark, orderly):
    rnd = random.Random(orderly)
    links = {tuple(rnd.sample(range(60), 2)) for _ in range(120)} | {(k, k + 1) for k in range(100, 140)}
    out = {r.node: r.stand for r in L.settled(spark.createDataFrame(sorted(links), "a long, b long"), orderly).collect()}
    near = {frozenset(x) for x in links}
    nodes = {x for pair in links for x in pair}
    assert all(s not in out and frozenset((n, s)) in near for n, s in out.items())
    stay = nodes - set(out)
    assert not any(a in stay and b in stay for a, b in links)
    if orderly == 12:
        want = set()
        for n in sorted(x for x in nodes if x < 60):
            if not any(frozenset((n, s)) in near for s in want):
                want.add(n)
        assert {s for s in stay if s < 60} == want


def test_short_lines_are_grouped_but_not_dropped(spark):
    rows = [(1, "Yes.\nNo.\n }", "x", 1), (2, "Yes.\n }\nMaybe", "x", 1), (None, "No.", "x", 1)]
    got = rows_of(L.line_classes(spark.createDataFrame(rows, KIND)))
    assert got == brute(rows, L.MIN_CHARS) and len(got) == 6 and not any(r[5] for r in got)


def test_one_start_for_many_lines_lists_few_pairs(spark, monkeypatch):
    rnd = random.Random(2)
    start = "many different lines begin with exactly these words and "
    seen = {start + "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=len(start))) for _ in range(5000)}
    rows = [(k, line, "x", 1) for k, line in enumerate(sorted(seen))]
    rows += [(9000, rows[17][1][:-9] + "#" + rows[17][1][-8:], "x", 1)]
    pairs, verified = [], L._verified
    monkeypatch.setattr(L, "_verified", lambda p, *rest: (pairs.append(p.count()), verified(p, *rest))[1])
    got = rows_of(L.line_classes(spark.createDataFrame(rows, KIND)))
    assert got == [(17, 0, 17, 0, False, False, 17, 0), (9000, 0, 17, 0, True, True, 17, 0)]
    assert sum(pairs) < 100_000  # of 12.5 million


def test_copies_add_nothing_to_a_key(spark):
    base = "a line that stands in very many documents of the corpus"
    rows = [(k, base, "x", 1) for k in range(3000)] + [(5000, base.replace("very", "vary"), "x", 1)]
    df = spark.createDataFrame(rows, KIND)
    lines = L._lines(df, "doc_id", "text", 20)
    exact = lines.groupBy("h1", "h2").agg(F.min(F.struct("d", "t", "n")).alias("first"), F.count(F.lit(1)).alias("copies"))
    assert L._different(lines, exact).count() == 2
    assert [r[:6] for r in rows_of(L.line_classes(df))][-1] == (5000, 0, 0, 0, True, True)


def test_very_long_lines(spark):
    long = "".join(random.Random(1).choices("abcdefgh ", k=5_000_000))
    other = long[:1_000_000] + "#" + long[1_000_001:4_000_000] + long[4_000_001:]
    rows = [(1, long, "x", 1), (2, other, "x", 1), (3, long[::-1], "x", 1)]
    got = rows_of(L.line_classes(spark.createDataFrame(rows, KIND)))
    assert got == [(1, 0, 1, 0, False, False, 1, 0), (2, 0, 1, 0, True, True, 1, 0)]


@pytest.mark.parametrize("edits", [0, 1, 2, 3, 4])
def test_banded_automaton(spark, edits):
    rnd = random.Random(edits)
    pairs = [("".join(rnd.choices("abé", k=rnd.randint(0, 9))), "".join(rnd.choices("abé", k=rnd.randint(0, 9)))) for _ in range(600)]
    df = spark.createDataFrame(pairs, "a string, b string")
    chars, sizes = [F.array_remove(F.split(c, ""), "") for c in "ab"], tuple(F.char_length(c) for c in "ab")
    got = df.select("a", "b", L.within_edits(*chars, edits).alias("w"),
                    L._common(F.col("a"), F.col("b"), sizes, False).alias("p"), L._common(F.col("a"), F.col("b"), sizes, True).alias("s")).collect()
    for r in got:
        assert r.w == (distance(r.a, r.b) <= edits)
        p = next((i for i, (x, y) in enumerate(zip(r.a, r.b)) if x != y), min(len(r.a), len(r.b)))
        s = next((i for i, (x, y) in enumerate(zip(r.a[::-1], r.b[::-1])) if x != y), min(len(r.a), len(r.b)))
        assert (r.p, r.s) == (p, s)


BANDS = ((0, 1), (24, 2), (40, 3), (60, 4))


def edited(rnd, s, times):
    for _ in range(times):
        p = rnd.randrange(len(s))
        s = rnd.choice([s[:p] + s[p + 1:], s[:p] + rnd.choice("xé#") + s[p:], s[:p] + rnd.choice("yß ") + s[p + 1:]])
    return s


def test_threshold_grows_with_the_length(spark):
    rnd = random.Random(7)
    letters = "abcdefghijklmnop "
    base = ["".join(rnd.choices(letters, k=k)) for k in range(21, 90, 2)]
    # one start for many lines: groups that are not near copies
    base += ["the same opening words of " + "".join(rnd.choices(letters, k=k)) for k in rnd.choices(range(12, 15), k=25)]
    seen = sorted({edited(rnd, s, rnd.randint(0, 5)) for s in base for _ in range(4)} | {s for s in base})
    rows = [(i, s, "x", 1) for i, s in enumerate(seen)]
    df = spark.createDataFrame(rows, KIND).repartition(3)
    # every group is compared pair by pair, so all links are listed (large groups: test_classes_equal_brute_force)
    got = rows_of(L.line_classes(df, group=500, bands=BANDS))
    assert got == brute(rows, L.MIN_CHARS, BANDS)
    sound(rows, got, BANDS)


def test_long_lines_with_two_typos_and_a_changed_number_meet(spark):
    a = "this is a fairly long line of plain text that two documents share, but for some typos, printed on page 100 of the book"
    b = a.replace("fairly", "farly").replace("typos", "typoz")
    c = " ".join(f"word{k}" for k in range(120))
    rows = [(1, a, "x", 1), (2, b, "x", 1), (3, c + " item 417", "x", 1), (4, c + " item 952", "x", 1)]
    got = {(r.d, r.rep_d) for r in L.line_classes(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 3)}


def test_more_edits_than_a_word_holds(spark):
    with pytest.raises(ValueError):
        L.line_classes(spark.createDataFrame([], KIND), bands=((0, 5),))


def test_empty(spark):
    assert L.line_classes(spark.createDataFrame([], KIND)).count() == 0
    assert L.drop_repeated_lines(spark.createDataFrame([], KIND)).count() == 0


def test_marks_tell_lines_apart_but_no_near_ones(spark):
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyzäß日", k=rnd.randint(2, 9))) for _ in range(300)]
    texts = [" ".join(rnd.choices(words, k=rnd.choice([5, 20, 70, 200]))) for _ in range(12)]
    near = [(t, edited(rnd, t, threshold(t[4:], t[4:], L.BANDS))) for t in texts for _ in range(8)]
    near = [(a, b) for a, b in near if distance(a, b) <= threshold(a, b, L.BANDS)]
    changed = []
    for _ in range(60):  # variants of one text, four words apart each
        mine = texts[0].split() + words[:60]
        for at in rnd.sample(range(len(mine)), 4):
            mine[at] = rnd.choice(words)
        changed.append(" ".join(mine))
    far = list(zip(changed[::2], changed[1::2], strict=True))

    def alike(pairs):
        seen = sorted({t for p in pairs for t in p})
        marked = L._marked(spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(seen)], "node long, line string, size int"))
        by = spark.createDataFrame([(seen.index(a), seen.index(b)) for a, b in pairs], "node long, other long")
        names = ("size", *L.MARKS)
        other = marked.select(F.col("node").alias("other"), *[F.col(c).alias(f"other_{c}") for c in names])
        met = by.join(marked, "node").join(other, "other")
        return [r[0] for r in met.select(L._alike(names, tuple(f"other_{c}" for c in names), L.BANDS)).collect()]

    assert len(near) >= 40 and all(alike(near))
    assert sum(alike(far)) <= len(far) // 5


def test_a_line_left_over_asks_three_cells_at_most_and_misses_no_pair(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 7)  # several blocks a cell
    rnd, reach, rows = random.Random(5), L.HEAD + L.MOST_EDITS, []
    for key, c in ((1, 90), (2, 60), (3, 20)):
        for node in range(c):
            kind = "tied" if not node or rnd.random() < 0.2 or key == 3 else rnd.choice(["lost", "lost", "stays"])
            p, s = rnd.randrange(600), rnd.randrange(600)
            rows.append((key, c, 50, node, rnd.random() < 0.7, 0, 1200, 0, 0, kind == "tied", kind == "lost", kind != "tied" and rnd.random() < 0.5,
                         p if node else L.LONGEST, s if node else L.LONGEST, p // 40 if node else L.WINDOWS))
    state = spark.createDataFrame(rows, "key long, c long, left int, node long, index boolean, leader long, size int, odd long, odd_twos long, "
                                        "tied boolean, lost boolean, lost_end boolean, p int, s int, b int")
    by = {(r.key, r.node): r for r in state.collect()}
    left = [r for r in by.values() if not r.tied]
    assert len(left) < L._cells(state).count() <= 3 * len(left)

    def near(x, y):
        follows = all(not a.lost or b.p < a.p + reach for a, b in ((x, y), (y, x)))
        return follows and all(not a.lost_end or b.s < a.s + reach for a, b in ((x, y), (y, x))) and (x["index"] or y["index"])

    want = sorted((k, x.node, y.node) for (k, _), x in by.items() for y in (by.get((k, n)) for n in range(x.node + 1, x.c))
                  if x.node and not (x.tied and y.tied) and near(x, y))
    counted = L._counted(state)
    got = []
    for key in (1, 2, 3):  # the pairs are of nodes only
        own = state.where(F.col("key") == key)
        got += [(key, r.a, r.b) for r in L._left_over(own, counted, L.BANDS).collect()]
    assert len(want) > 500 and sorted(got) == want  # each once

    def windows(x, y):
        return not y.lost or y.b >= x.b - 1 and (not x.lost or y.b <= x.b + 1)

    met = {k: sum(windows(x, y) for x in left if x.key == k for y in by.values() if y.key == k) for k in (1, 2)}
    assert {r.key: r.met for r in L._met(counted).collect()} == met  # 3: all tied
