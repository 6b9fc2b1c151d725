"""Line dedup: exact copies and lines a few edits apart (native expressions only).

*Exact copies* are lines with two equal independent 64-bit hashes, counted
map-side: a line in a third of all documents is one row a task.

*Lines a few edits apart* (substitution, insertion or deletion of a character)
are found by a segment-partition join. The threshold of a pair follows the
length of its shorter line (``BANDS``). A line of n characters with threshold
t is split into t + 1 segments; t edits leave one of them whole. The index
holds (n, segment number, segment text); a line probes it with the substrings
of its own that a line of n, n-1, ... n-t characters could have there: a
segment can only have moved by the edits before it, and by the gap less the
edits after it. Keys are hashes, with the length in them; they are counted
map-side first, so copies of a line add nothing to a key, and only keys that
two different lines share are made a second time with the lines that hold them.

*Groups* of up to ``GROUP`` different lines are compared pair by pair. In a
larger one every line is compared with the group's most copied one, its
leader. A line that cannot be read on along the leader from where it leaves it
can only be near lines that leave it there too: that parts the variants of one
text by the places they were changed at. If few pairs are left they are
listed; otherwise the group is *refined*: the segment its lines share is cut
out, and the rest is split into segments and probes again, so that a subgroup
shares ever more text. What is listed is linear in a group's size at each
step, and a group whose lines share all but a few characters needs no further
one.

*Marks.* Of each line two words tell which characters, and which neighbouring
two, it has an odd number of. An edit changes few of their bits, so lines that
differ in more are not listed as a pair: that loses no link.

*Verification.* Common ends are cut off the two texts, and a banded
bit-parallel automaton reads the rest: one bit a diagonal, one lane an error
count, all lanes in one machine word.

*Classes and what goes.* Links meet in ``components``; a class goes by its
earliest line (by doc_id, then line number). A line is dropped only if it is
linked to a line that is kept: going through the lines in their order, a line
is kept unless an earlier kept one is linked to it. That is settled for many
lines at once, in rounds: lines without an earlier undecided link are kept and
their links dropped. (After ``ORDERLY`` rounds, which only long runs of
numbered lines reach, hashes decide who is earlier: that ends in a few more.)
Lines of a large group that are linked to its leader are not compared with
each other, so two of them may both stay where the leader itself goes.

Defined results: every line with a word takes part in the exact grouping,
lines of ``MIN_CHARS`` characters or more also in the edit join; dropping
leaves shorter lines where they are, as "Yes." or "}" repeats by right; a
blank line always stays; a NULL or empty text has no lines; a NULL doc_id
comes after all others; rows repeated with the same doc_id and text count as
one document, so they keep the same lines; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amity.functions.membership import in_words, may_contain, membership_words
from amity.llm.components import components
from amity.llm.tables import col_ref, free_name, read_table, written

BANDS = ((0, 1), (100, 2), (400, 3), (1000, 4))  # (from so many characters, edits); 4 edits at most
MIN_CHARS = 20
GROUP = 16            # lines of a key that are compared pair by pair
LISTED = 256          # pairs a line of a larger group that may be looked at at once
SPARE = 16            # or, for a level as a whole, pairs a row of the first groups
HEAD = 24             # characters after the common beginning that most other pairs fail in
WINDOWS = 32          # parts of a line, at most, that the place where it leaves its leader is told by
TOGETHER = 200_000    # rows of a table of links or group members that one task may handle
BLOCK = 4096          # lines of a group that meet those left over in one task
ORDERLY = 12          # rounds in which the earlier line goes first
MOST_EDITS = 4        # an automaton of more does not fit a machine word
LONGEST = 1 << 30     # no line has as many characters
LAST = (1 << 63) - 1  # stands for a NULL doc_id in the order
SPACE = " \t\n\x0b\f\r"
MARKS = ("odd", "odd_twos")
TEXT = {"compression": "zstd"}  # of written tables that hold texts
Bands = tuple[tuple[int, int], ...]


def _chars(c: Column, start: Column, size: Column) -> Column:
    """``size`` characters from position ``start`` (from 1)."""
    return F.substring(c, start, F.greatest(size, F.lit(0)))


def _common(a: Column, b: Column, sizes: tuple[Column, Column], ends: bool) -> Column:
    """Length of the common beginning (or, ``ends``, the common ending) of two
    texts of ``sizes`` characters, by halving steps: comparisons of substrings."""
    steps = F.array(*[F.lit(1 << k) for k in range(22, -1, -1)])

    def part(c: Column, size: Column, k: Column, step: Column) -> Column:
        return _chars(c, size - k - step + 1, step) if ends else _chars(c, k + 1, step)

    def longer(k: Column, step: Column) -> Column:
        fits = (k + step <= F.least(*sizes)) & (part(a, sizes[0], k, step) == part(b, sizes[1], k, step))
        return F.when(fits, k + step).otherwise(k)

    return F.aggregate(steps, F.lit(0), longer)


def _automaton(a: Column, b: Column, edits: int) -> Column:
    """The state after reading the character array ``a`` along ``b``.

    Bit d + edits of lane e is set while what was read of ``a`` can be at
    diagonal d of ``b`` with e errors. The lanes stand side by side in one
    word, so a character of ``a`` moves all of them at once; the word is 0
    when ``a`` and ``b`` cannot be continued to within ``edits`` edits."""
    if not 0 <= edits <= MOST_EDITS:
        raise ValueError(f"0 to {MOST_EDITS} edits")
    size, lanes = 2 * edits + 1, range(edits + 1)

    def word(lane: int) -> int:
        """``lane``'s bits in every lane."""
        return sum(lane << (e * size) for e in lanes)

    full = (1 << size) - 1
    every, upper, lower = word(full), word(full & ~1), word(full >> 1)
    start = sum(sum(1 << (d + edits) for d in range(e + 1)) << (e * size) for e in lanes)

    def hits(char: Column, i: Column) -> Column:
        """The diagonals on which ``b`` has this character."""
        out = F.lit(0).cast("bigint")
        for d in range(-edits, edits + 1):
            out = out + F.when(F.get(b, i + d) == char, F.lit(1 << (d + edits)).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        return out

    def number(n: int) -> Column:
        return F.lit(n).cast("bigint")

    def one_more(c: Column) -> Column:
        """Every lane's bits as those of the lane with an error more."""
        return F.shiftleft(c, size).bitwiseAND(number(every))

    def step(state: Column, hit: Column) -> Column:
        same = state.bitwiseAND(hit * number(word(1)))
        moved = state.bitwiseOR(F.shiftright(state, 1).bitwiseAND(number(lower)))  # substituted, or left out of b
        found = same.bitwiseOR(one_more(moved))
        if not edits:
            return found
        # put into b: along the lanes, an error each
        return F.aggregate(F.sequence(F.lit(1), F.lit(edits)), found,
                           lambda s, _: s.bitwiseOR(one_more(F.shiftleft(s, 1).bitwiseAND(number(upper)))))

    return F.aggregate(F.transform(a, hits), number(start), step)


def within_edits(a: Column, b: Column, edits: int = 1) -> Column:
    """Whether the character arrays ``a`` and ``b`` are at most ``edits``
    edits apart: the last lane holds the diagonal both end on."""
    size, gap = 2 * edits + 1, F.size(b) - F.size(a)
    ends = F.array(*[F.lit(1 << (edits * size + k)).cast("bigint") for k in range(size)])
    return F.when(F.abs(gap) <= edits, _automaton(a, b, edits).bitwiseAND(F.get(ends, gap + edits)) != 0).otherwise(F.lit(False))


def _by_edits(e: Column, bands: Bands, test) -> Column:
    """``test(edits)`` for the edits that ``e`` says."""
    out = F.lit(False)
    for edits in sorted({x for _, x in bands}):
        out = F.when(e == edits, test(edits)).otherwise(out)
    return out


# ------------------------------------------------------------ lines, copies

def _lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """``(d, t, n, line, h1, h2)`` of the lines with a word; ``line`` is NULL
    where it is too short for the edit join."""
    value = F.col(col_ref(text)).cast("string")
    rows = docs.select(F.coalesce(F.col(col_ref(doc_id)).cast("bigint"), F.lit(LAST)).alias("d"), F.xxhash64(value).alias("t"),
                       F.posexplode(F.split(value, "\n", -1)).alias("n", "line"))
    rows = rows.where(F.ltrim(F.col("line"), F.lit(SPACE)) != "")
    return rows.select("d", "t", "n", F.when(F.char_length("line") >= min_chars, F.col("line")).alias("line"),
                       F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _different(lines: DataFrame, exact: DataFrame) -> DataFrame:
    """``(h1, h2, line)``: every text of the edit join once. Only texts that
    may have copies are brought together; the others stay where they are."""
    long = lines.where(F.col("line").isNotNull()).select("h1", "h2", "line")
    may_have = _words(exact.where("copies > 1"), "h1")
    copied = written(long.where(may_have(F.col("h1"))).dropDuplicates(["h1", "h2"]), "line-copied", **TEXT)
    return long.where(~may_have(F.col("h1"))).unionByName(copied)


# --------------------------------------------------------- segments, probes

def _edits(size: Column, bands: Bands) -> Column:
    """The threshold of a pair whose shorter line has ``size`` characters."""
    out = F.lit(0)
    for least, edits in sorted(bands):
        out = F.when(size >= least, F.lit(edits)).otherwise(out)
    return out


def _moves(edits: int, gap: int) -> list[tuple[int, int]]:
    """(segment, how far it may have moved) of a probe for texts ``gap``
    characters shorter."""
    return [(k, move) for k in range(edits + 1)
            for move in range(max(-k, gap - (edits - k)), min(k, gap + edits - k) + 1)]


def _table(rows: list[tuple[int, ...]], names: tuple[str, ...]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(r, names, strict=True)]) for r in rows])


def _measured(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the length of ``text`` and, where it is ASCII, its bytes,
    of which a piece is found without counting characters."""
    n = F.char_length(text)
    return rows.withColumns({"n": n, "raw": F.when(F.octet_length(text) == n, F.col(text).cast("binary"))})


def _probes(lines: DataFrame, bands: Bands) -> DataFrame:
    """``lines`` (with ``line``) times the segments each is indexed and probed
    by: the columns of ``lines`` less ``line``, and ``prefix, rest, n, raw,
    edits, gap, k, move, index``. Only a line's own bands are unfolded."""
    n, steps = F.col("n"), sorted(bands)
    parts = []
    for (least, edits), after in zip(steps, [*[s[0] for s in steps[1:]], None], strict=True):
        own = _table([(edits, gap, k, move) for gap in range(edits + 1) for k, move in _moves(edits, gap)], ("edits", "gap", "k", "move"))
        met = (n >= least) if after is None else (n >= least) & (n - edits < after)
        parts.append(F.when(met, own).otherwise(F.slice(own, 1, 0)))
    rest = [c for c in lines.columns if c != "line"]
    rows = _measured(lines, "line").select(*rest, "line", "n", "raw", F.explode(F.concat(*parts)).alias("p"))
    rows = rows.where(_edits(n - F.col("p.gap"), bands) == F.col("p.edits"))
    return rows.select(*rest, F.lit(0).cast("bigint").alias("prefix"), F.col("line").alias("rest"), "n", "raw", "p.edits", "p.gap", "p.k", "p.move",
                       ((F.col("p.gap") == 0) & (F.col("p.move") == 0)).alias("index"))


def _deeper(rows: DataFrame, bands: Bands) -> DataFrame:
    """The same for rows that share a key: what is left of them is split
    anew, at the threshold and the gap they met at."""
    table = F.array().cast("array<struct<k:int,move:int>>")
    for edits in sorted({e for _, e in bands}):
        for gap in range(edits + 1):
            table = F.when((F.col("edits") == edits) & (F.col("gap") == gap), _table(_moves(edits, gap), ("k", "move"))).otherwise(table)
    keep = [c for c in rows.columns if c not in ("key", "left", "index")]
    out = _measured(rows, "rest").select(*keep, "n", "raw", F.col("key").alias("prefix"), F.col("index").alias("was"), F.explode(table).alias("p"))
    return out.select(*keep, "n", "raw", "prefix", "p.k", "p.move", (F.col("was") & (F.col("p.move") == 0)).alias("index"))


def _keyed(probes: DataFrame, with_rest: bool = False) -> DataFrame:
    """``key`` of each probe's segment, in place of what it is made from;
    ``left``: how long the index's texts are without it; ``with_rest``: also
    each row's own text without it."""
    size = F.col("n") - F.col("gap")  # of the texts probed for
    start, end = [F.floor(size * (F.col("k") + d) / (F.col("edits") + 1)).cast("int") for d in (0, 1)]

    def segment(text: Column) -> Column:
        return F.xxhash64("prefix", "k", size, _chars(text, start + 1 + F.col("move"), end - start))  # of bytes, the same for both

    key = F.when(F.col("raw").isNotNull(), segment(F.col("raw"))).otherwise(segment(F.col("rest"))).alias("key")
    keep = [F.col(c) for c in probes.columns if c not in ("prefix", "rest", "n", "raw", "edits", "gap", "k", "move")]
    if not with_rest:
        return probes.select(*keep, key, (size - (end - start)).alias("left"))
    cut = F.concat(_chars(F.col("rest"), F.lit(1), start + F.col("move")), _chars(F.col("rest"), end + F.col("move") + 1, F.col("n")))
    return probes.select(*keep, key, (size - (end - start)).alias("left"), cut.alias("rest"), "edits", "gap")


# ------------------------------------------------------------ verification

def _letters(text: Column) -> Column:
    return F.array_remove(F.split(text, ""), "")  # splitting an empty text gives one empty string


def _where(df: DataFrame, condition: Column) -> DataFrame:
    """``where`` that stays above the projections of ``df``: pushed below
    them, it would compute their columns anew for every mention. A column that
    is not deterministic holds it back."""
    return df.select("*", (condition & (F.spark_partition_id() >= 0)).alias("_holds")).where("_holds").drop("_holds")


def _marked(texts: DataFrame) -> DataFrame:
    """``texts`` with ``odd`` and ``odd_twos``: the characters, and the
    neighbouring two, that a line has an odd number of, as bits of their
    hashes. An edit changes two bits of the one at most and four of the other."""
    one = F.lit(1).cast("bigint")

    def odd(codes: Column) -> Column:
        return F.aggregate(codes, F.lit(0).cast("bigint"), lambda s, c: s.bitwiseXOR(F.call_function("shiftleft", one, F.pmod(c, F.lit(64)))))

    codes = F.col("codes")
    after = F.slice(codes, F.lit(2), F.size(codes))
    # the last character has none after it: 0
    twos = F.zip_with(codes, after, lambda a, b: a * 31 + F.coalesce(b, F.lit(0)) * 17)
    return texts.withColumn("codes", F.transform(_letters(F.col("line")), F.ascii)).select(*texts.columns, odd(codes).alias("odd"), odd(twos).alias("odd_twos"))


def _alike(one: tuple[str, str, str], other: tuple[str, str, str], bands: Bands) -> Column:
    """False for lines that cannot be within their threshold, by the names of
    their ``size`` and ``MARKS``."""
    e = _edits(F.least(one[0], other[0]), bands)
    changed = [F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(one[1:], other[1:], strict=True)]
    return (F.abs(F.col(one[0]) - F.col(other[0])) <= e) & (changed[0] <= 2 * e) & (changed[1] <= 4 * e)


def _verified(pairs: DataFrame, texts: DataFrame, bands: Bands) -> DataFrame:
    """The pairs ``(a, b)`` of nodes that are within their threshold. Most
    others are told by their marks or fail in the first characters that
    differ, and are read no further."""
    side = texts.select("node", "line", "size", *MARKS)
    both = pairs.join(side.toDF("a", "x", "nx", "ox", "tx"), "a").join(side.toDF("b", "y", "ny", "oy", "ty"), "b")
    e = F.col("e")
    sizes = (F.col("nx"), F.col("ny"))

    pre = both.where(_alike(("nx", "ox", "tx"), ("ny", "oy", "ty"), bands)).drop("ox", "tx", "oy", "ty") \
        .withColumn("e", _edits(F.least(*sizes), bands)).withColumn("p", _common(F.col("x"), F.col("y"), sizes, False))
    heads = pre.withColumns({"hx": _letters(_chars(F.col("x"), F.col("p") + 1, F.lit(HEAD))),
                             "hy": _letters(_chars(F.col("y"), F.col("p") + 1, F.lit(HEAD + MOST_EDITS)))})
    alive = _where(heads, _by_edits(e, bands, lambda k: _automaton(F.col("hx"), F.col("hy"), k) != 0))
    left = [(n - F.col("p")).alias(c) for n, c in zip(sizes, ("nx", "ny"), strict=True)]
    rest = alive.select("a", "b", "e", *[_chars(F.col(c), F.col("p") + 1, n).alias(c) for c, n in zip("xy", sizes, strict=True)], *left)
    rest = rest.withColumn("s", _common(F.col("x"), F.col("y"), sizes, True))
    cut = rest.select("a", "b", "e", *[_letters(_chars(F.col(c), F.lit(1), n - F.col("s"))).alias(c) for c, n in zip("xy", sizes, strict=True)])
    return _where(cut, _by_edits(e, bands, lambda k: within_edits(F.col("x"), F.col("y"), k))).select("a", "b")


# ------------------------------------------------------------------ groups

def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _together(df: DataFrame, rows: int) -> DataFrame:
    """A small table as one partition: what is joined and grouped by then needs
    no exchange. Larger ones stay as they are."""
    return df.coalesce(1) if rows <= TOGETHER else df


def _few(groups: DataFrame) -> DataFrame:
    """All pairs of each group, at least one of a pair indexed."""
    x, y = groups.alias("x"), groups.alias("y")
    met = x.join(y, F.expr("x.key = y.key AND x.node < y.node AND (x.index OR y.index)"))
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _led(large: DataFrame, texts: DataFrame, bands: Bands) -> DataFrame:
    """Every line of a large group against its leader: ``(node, leader, tied,
    lost, lost_end, p, s, b)`` and the line's ``size`` and marks.
    ``tied``: within the threshold. ``lost``: the characters from where they
    differ, after ``p``, cannot be read along the leader within the line's own
    threshold; ``b``: that place in windows no shorter than what is read.
    ``lost_end`` and ``s``: the same from the end."""
    side, e = texts.select("node", "line", "size"), F.col("e")
    pairs = large.where("node != leader").select("node", "leader").distinct()
    both = pairs.join(texts.select("node", F.col("line").alias("x"), F.col("size").alias("nx"), *MARKS), "node") \
        .join(side.toDF("leader", "y", "ny"), "leader")
    sizes, at = (F.col("nx"), F.col("ny")), {c: (F.col(c), F.col(f"n{c}")) for c in "xy"}
    ends = both.select("*", _common(F.col("x"), F.col("y"), sizes, False).alias("p"), _common(F.col("x"), F.col("y"), sizes, True).alias("s"),
                       _edits(F.col("nx"), bands).alias("e"))

    def tail(c: str, most: int) -> Column:
        text, n = at[c]
        size = F.least(n - F.col("s"), F.lit(most))
        return F.reverse(_letters(_chars(text, n - F.col("s") - size + 1, size)))

    read = ends.withColumns({"hx": _letters(_chars(F.col("x"), F.col("p") + 1, F.lit(HEAD))), "tx": tail("x", HEAD),
                             "hy": _letters(_chars(F.col("y"), F.col("p") + 1, F.lit(HEAD + MOST_EDITS))), "ty": tail("y", HEAD + MOST_EDITS)})
    lost = [_by_edits(e, bands, lambda k, i=i: _automaton(F.col(f"{i}x"), F.col(f"{i}y"), k) == 0) for i in "ht"]
    window = F.greatest(F.lit(HEAD + MOST_EDITS), F.ceil(F.col("ny") / WINDOWS).cast("int"))
    seen = read.select("node", "leader", "x", "y", "nx", "ny", *MARKS, "p", "s", lost[0].alias("lost"), lost[1].alias("lost_end"),
                       F.floor(F.col("p") / window).cast("int").alias("b"))
    alive, cut = ~F.col("lost") & ~F.col("lost_end"), F.least("s", F.col("nx") - F.col("p"), F.col("ny") - F.col("p"))
    rest = [F.when(alive, _letters(_chars(text, F.col("p") + 1, n - F.col("p") - cut))).alias(f"r{c}") for c, (text, n) in at.items()]
    own = ["node", "leader", "lost", "lost_end", "p", "s", "b", F.col("nx").alias("size"), *MARKS]
    rest = seen.select(*own, _edits(F.least(*sizes), bands).alias("e"), *rest)
    tied = _by_edits(e, bands, lambda k: within_edits(F.col("rx"), F.col("ry"), k))
    return rest.select("node", "leader", "lost", "lost_end", "p", "s", "b", "size", *MARKS, F.coalesce(F.col("rx").isNotNull() & tied, F.lit(False)).alias("tied"))


def _cell() -> Column:
    """The cell a line of a large group is found in: the window it leaves its
    leader in, if it is lost there; all others share one."""
    return F.when(F.col("lost"), F.col("b")).otherwise(-1).alias("at")


def _cells(state: DataFrame) -> DataFrame:
    """Each line that is left over with the cells, three at most, that it asks.
    If a line is lost against the leader, whoever follows the leader past that
    place is as far from the line; so a near copy that is lost as well leaves
    the leader at most a window before or after it. Of two lines in different
    cells one asks: the lost one whoever is not lost, the one that leaves
    first the one that leaves a window later. ``own``: the line's own cell,
    where both ask."""
    b = F.col("b")
    asked = F.when(F.col("lost"), F.array(F.lit(-1), b, b + 1)).otherwise(F.array(F.lit(-1)))
    return state.where("NOT tied").withColumn("own_at", _cell()).withColumn("at", F.explode(asked)) \
        .withColumn("own", F.col("at") == F.col("own_at")).drop("own_at")


def _counted(state: DataFrame) -> DataFrame:
    """``(key, c, left, lost, b, held, asked)``: the lines of each group by the
    window they leave their leader in, and those of them that are left over."""
    return state.groupBy("key", "c", "left", "lost", "b").agg(F.count(F.lit(1)).alias("held"), F.count_if(~F.col("tied")).alias("asked"))


def _met(counted: DataFrame) -> DataFrame:
    """``(key, c, left, met)`` of the groups with lines left over: how many
    lines may be near each of these by their windows, in all (two that are
    left over count from either side)."""
    whole = Window.partitionBy("key")
    at = whole.orderBy("b")
    gone = F.when(F.col("lost"), F.col("held")).otherwise(0)
    # a lost line's near copies that are lost are a window off at most, those of others no more than one before
    near = F.when(F.col("lost"), F.sum(gone).over(at.rangeBetween(-1, 1))).otherwise(F.sum(gone).over(at.rangeBetween(-1, Window.unboundedFollowing)))
    seen = counted.withColumn("near", near + F.sum(F.col("held") - gone).over(whole))
    return seen.groupBy("key", "c", "left").agg(F.sum(F.col("asked") * F.col("near")).alias("met")).where("met > 0")


def _left_over(state: DataFrame, counted: DataFrame, bands: Bands) -> DataFrame:
    """The pairs of lines that a group's leader does not join: of each line
    left over, those in its cells, in blocks, that it may be near by their
    marks. The leader itself is near none of them."""
    # as many blocks as the cell's lines fill: a group's other cells add none
    blocks = counted.groupBy("key", _cell()).agg(F.ceil(F.sum("held") / BLOCK).cast("int").alias("blocks"))
    whole = state.where("node != leader").select("key", "node", "index", "tied", "lost_end", "p", "s", "size", *MARKS, F.col("lost").alias("with_lost"), _cell())
    whole = whole.join(blocks, ["key", "at"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).drop("blocks")
    names = {"node": "other", "index": "indexed", "lost": "other_lost", "lost_end": "other_lost_end", "p": "other_p", "s": "other_s",
             **{c: f"other_{c}" for c in ("size", *MARKS)}}
    few = _cells(state).join(blocks, ["key", "at"]) \
        .select("key", "at", "own", *[F.col(k).alias(v) for k, v in names.items()], F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    # the cells' condition to the character, and the same from the end
    near = [f"(NOT {lost} OR {other} < {own} + {HEAD + MOST_EDITS})" for lost, own, other in
            (("with_lost", "p", "other_p"), ("other_lost", "other_p", "p"), ("lost_end", "s", "other_s"), ("other_lost_end", "other_s", "s"))]
    met = whole.join(few, ["key", "at", "block"]) \
        .where(" AND ".join(["node != other", "(index OR indexed)", "(tied OR NOT own OR node < other)", *near])) \
        .where(_alike(("size", *MARKS), ("other_size", *[f"other_{c}" for c in MARKS]), bands))
    return met.select(*_pair("node", "other"))


def _links(members: DataFrame, texts: DataFrame, bands: Bands, group: int, listed: int) -> DataFrame:
    """Links ``(a, b)`` that connect whatever is within its threshold, from
    the members ``(key, node, copies, index, left)`` of the first keys."""
    found, rows, spare = [], None, None
    while True:
        m = members.count()
        spare = SPARE * m if spare is None else spare
        members = _together(members, m)
        # a group's leader is its most copied line, of these the earliest
        lead = members.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max("index").alias("i"), F.max("left").alias("left"),
                                          F.max(F.struct("copies", (-F.col("node")).alias("minus"))).alias("most")).where("c > 1 AND i")
        lead = lead.select("key", "c", "left", (-F.col("most.minus")).alias("leader"))
        crowd = _together(written(members.select("key", "node", "index").join(lead, "key"), "line-groups"), m)
        large = crowd.where(F.col("c") > group)
        pairs = _few(crowd.where(F.col("c") <= group).select("key", "node", "index"))
        links = written(_verified(pairs.distinct(), texts, bands), "line-links")
        found.append(links)
        if not large.head(1):
            break
        led = written(_led(large, texts, bands), "line-led")
        found.append(led.where("tied").select(*_pair("node", "leader")))
        state = large.select("key", "c", "left", "node", "index", "leader").join(_together(led, m), ["node", "leader"], "left")
        # the leader itself is tied, and leaves itself nowhere
        state = state.select("key", "c", "left", "node", "index", "leader", "size", *MARKS, *[F.coalesce(c, F.lit(v)).alias(c) for c, v in
                                                                  (("tied", True), ("lost", False), ("lost_end", False), ("p", LONGEST), ("s", LONGEST), ("b", WINDOWS))])
        state = _together(written(state, "line-state"), m)
        counted = _together(written(_counted(state), "line-windows"), m)
        open_ = _together(written(_met(counted), "line-met"), m)
        total = open_.agg(F.sum("met")).head()[0]
        if total is None:
            break
        # listed at once: what is little for the group or for the level, and where nothing is left to split:
        # what a group's lines do not share is as short as their threshold
        now = F.lit(True) if total <= spare else (F.col("met") <= listed * F.col("c")) | (F.col("left") <= max(e for _, e in bands))
        state = state.join(open_.select("key", now.alias("now")), "key")
        found.append(written(_verified(_left_over(state.where("now"), counted, bands).distinct(), texts, bands), "line-links"))
        split = _together(written(state.where("NOT now").select("key").distinct(), "line-split"), m)
        if not split.head(1):
            break
        probes = _probes(texts.select("node", "copies", "line"), bands) if rows is None else _deeper(rows, bands)
        rows = written(_keyed(probes, with_rest=True).join(split, "key").distinct(), "line-rest", **TEXT)
        members = _keyed(_deeper(rows, bands)).groupBy("key", "node", "copies").agg(F.max("index").alias("index"), F.max("left").alias("left"))
        members = written(members, "line-members")
    out = found[0]
    for links in found[1:]:
        out = out.unionByName(links)
    return out


def _words(values: DataFrame, column: str):
    """A membership test whose words are written once, for several queries."""
    return in_words(written(membership_words(values, column), "line-filter"))


def _near(lines: DataFrame, exact: DataFrame, bands: Bands, group: int, listed: int) -> tuple[DataFrame, DataFrame]:
    """(nodes ``node, h1, h2, first`` of the texts that share a key with
    another, numbered in the order of their first lines; their links)."""
    keys = _keyed(_probes(_different(lines, exact).select(F.col("h1").alias("id"), "line"), bands))
    # a key matters if two texts hold it and one of them is in the index; the texts are different
    # ones, so counting will do (a text that holds a key twice is seen through when groups are counted)
    shared = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max("index").alias("i")).where("c > 1 AND i").select("key"), "line-shared")
    # tested where it is made, so that no key is made twice
    held = _where(keys, _words(shared, "key")(F.col("key")))
    held = written(held.join(shared, "key").groupBy("key", "id").agg(F.max("index").alias("index"), F.max("left").alias("left")), "line-held")
    order = [F.col(f"first.{c}") for c in "dtn"]
    nodes = written(exact.join(held, exact["h1"] == held["id"], "left_semi").repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("node", F.monotonically_increasing_id()), "line-nodes")
    long = lines.where(F.col("line").isNotNull() & _words(nodes, "h1")(F.col("h1"))).select("h1", "h2", "line")
    texts = long.dropDuplicates(["h1", "h2"]).join(nodes.select("h1", "h2", "node", "copies"), ["h1", "h2"])
    texts = written(_marked(texts.select("node", "copies", "line", F.char_length("line").alias("size"))), "line-texts", **TEXT)
    members = held.join(nodes.select(F.col("h1").alias("id"), "node", "copies"), "id").select("key", "node", "copies", "index", "left")
    return nodes, _links(written(members, "line-members"), texts, bands, group, listed)


# ------------------------------------------------------- classes, what goes

def settled(links: DataFrame, orderly: int = ORDERLY) -> DataFrame:
    """``(node, stand)``: the nodes that go and the linked node that stands
    for each, from links ``(a, b)``. No two nodes that stay are linked; every
    other one is linked to one that stays. Smaller nodes stay first."""
    now = written(links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).where("u != v").distinct(), "line-open")
    gone, turn = [], 0
    while n := now.count():
        now = _together(now, n)
        if turn == orderly:
            first = F.struct(F.xxhash64("u"), "u") < F.struct(F.xxhash64("v"), "v")
            now = now.select(F.when(first, F.col("u")).otherwise(F.col("v")).alias("u"), F.when(first, F.col("v")).otherwise(F.col("u")).alias("v"))
        stay = now.join(now.select(F.col("v").alias("u")), "u", "left_anti")
        goes = _together(written(stay.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("stand")), "line-goes"), n)
        gone.append(goes)
        left = now.join(goes.select(F.col("node").alias("u")), "u", "left_anti").join(goes.select(F.col("node").alias("v")), "v", "left_anti")
        now = written(left.select("u", "v"), "line-open")
        turn += 1
    out = now.select(F.col("u").alias("node"), F.col("v").alias("stand"))
    for goes in gone:
        out = out.unionByName(goes)
    return out


def line_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                 group: int = GROUP, bands: Bands = BANDS, listed: int = LISTED) -> DataFrame:
    """``(d, t, n, rep_d, rep_t, rep_n, near, dropped, by_d, by_t, by_n)`` for
    every line that has a twin: its document key (doc_id and text hash) and
    line number, and those of the line its class goes by. ``near``: no exact
    copy of that line. ``dropped``: a kept line stands for it; ``by_*``: that
    line (a kept line stands for itself). ``bands``: the edits allowed from so
    many characters of the shorter line."""
    if max(e for _, e in bands) > MOST_EDITS:
        raise ValueError(f"at most {MOST_EDITS} edits")
    # read several times below: texts are split and hashed once
    lines = written(_lines(docs, doc_id, text, min_chars), "lines")
    own = F.struct("d", "t", "n")
    exact = written(lines.groupBy("h1", "h2").agg(F.min(own).alias("first"), F.max(own).alias("last"), F.count(F.lit(1)).alias("copies")), "line-exact")
    nodes, links = _near(lines, exact, bands, group, listed)
    place = nodes.select("node", "first")
    links = written(links, "line-links")
    linked = components(links, together=TOGETHER).join(settled(links), "node", "left")
    linked = linked.join(place.toDF("root", "rep"), "root").join(place.toDF("stand", "by"), "stand", "left")
    linked = linked.join(nodes.select("node", "h1", "h2"), "node").select("h1", "h2", "rep", "by")
    classes = exact.join(linked, ["h1", "h2"], "left").where("first != last OR rep IS NOT NULL")
    classes = written(classes.select("h1", "h2", "first", F.coalesce("rep", "first").alias("rep"), F.coalesce("by", "first").alias("by")), "line-classes")
    seen = lines.where(may_contain(classes, "h1")(F.col("h1"))).select("d", "t", "n", "h1", "h2", F.col("line").isNotNull().alias("long"))
    return seen.join(classes, ["h1", "h2"]).select(
        "d", "t", "n", *[F.col(f"rep.{c}").alias(f"rep_{c}") for c in "dtn"], (F.col("rep") != F.col("first")).alias("near"),
        (F.col("long") & (own != F.col("by"))).alias("dropped"),
        *[F.when(F.col("long"), F.col(f"by.{c}")).otherwise(F.col(c)).alias(f"by_{c}") for c in "dtn"])


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                        bands: Bands = BANDS) -> DataFrame:
    """``docs`` with every line gone that a kept line stands for. All
    documents stay, if need be with an empty text."""
    gone = line_classes(docs, doc_id, text, min_chars, bands=bands).where("dropped")
    # of one document's lines only: bounded by the text itself
    per_doc = written(gone.groupBy("d", "t").agg(F.collect_set("n").alias("gone")), "line-gone")
    names = {c: free_name(docs, f"_l_{c}") for c in ("d", "t", "gone")}
    per_doc = per_doc.select(*[F.col(c).alias(n) for c, n in names.items()])
    value = F.col(col_ref(text)).cast("string")
    number = F.coalesce(F.col(col_ref(doc_id)).cast("bigint"), F.lit(LAST))
    same = (number == F.col(names["d"])) & (F.xxhash64(value) == F.col(names["t"]))
    # a column of its own with two mentions: inlined, it would be split once a line
    parts = F.col(names["t"] + "_parts")
    joined = docs.join(per_doc, same, "left").withColumn(
        names["t"] + "_parts", F.when(F.col(names["gone"]).isNotNull(), F.split(value, "\n", -1)))
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(names["gone"]))
    kept = F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n")
    out = F.when(F.col(names["gone"]).isNull(), F.col(col_ref(text))).otherwise(kept)
    return joined.select(*[out.alias(c) if c == text else F.col(col_ref(c)) for c in docs.columns])


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of ``documents`` that has a twin, the line its class goes
    by, and the kept line that stands for it."""
    def number(c: str, name: str) -> Column:
        return F.when(F.col(c) != LAST, F.col(c)).alias(name)

    found = line_classes(read_table(spark, sf_dir, "documents"))
    return found.select(number("d", "doc_id"), F.col("n").alias("line"), number("rep_d", "class_doc_id"), F.col("rep_n").alias("class_line"),
                        "near", "dropped", number("by_d", "kept_doc_id"), F.col("by_n").alias("kept_line"))


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated lines go; ``n_chars`` follows the text."""
    out = drop_repeated_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


QUERIES = {"op7_line_dedup": op7_line_dedup}
SQL: dict[str, str] = {}
