"""Quality rules as a short-circuit cascade (native expressions only).

A rule rejects a document by a Boolean expression over *features* (word
count, repeated windows, ...). ``plan_cascade`` times every rule on a sample
spread over the whole input and counts what it rejects there, and orders the
rules by rejections per second. ``quality_cascade`` then evaluates them in that order: a feature is
computed right before the first rule that needs it and only for documents no
earlier rule has rejected, so the costly rules see few rows. The order
changes the cost only; the verdict is the same for every order.

Everything is a projection over the scan: no shuffle, no join, no Python.
A document with a third of all rows' copies or a very long text is one row
like any other.

Defined results: a NULL or empty text has no words and zero of everything (so
``too_few_words`` rejects it); repeated rows each get their own verdict; an
empty table gives an empty table; other columns pass through unchanged, and a
column that already has the name of an output is replaced by it. Window
equality is taken on 64-bit hashes of three words, compared only within one
document.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, free_name, read_table, written

# Fixed values of the contract: the six ASCII white-space characters that part
# words, and the characters counted as symbols.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 3
SAMPLE_ROWS = 2048  # rows, about, that each rule is timed on


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def _chars(c: Column) -> Column:
    return F.char_length(c).cast("long")


class Feature(NamedTuple):
    needs: tuple[str, ...]
    build: Callable[[dict[str, Column]], Column]
    hidden: bool = False  # a working array, not a metric


def _words(f: dict[str, Column]) -> Column:
    # all white space to one character, then a plain (regex-free) split
    return F.array_remove(F.split(F.translate(f["text"], SPACE, " " * len(SPACE)), " "), "")


def _word_lines(f: dict[str, Column]) -> Column:
    return F.filter(F.split(f["text"], "\n"), lambda x: F.length(_without(x, SPACE)) > 0)


def _windows(f: dict[str, Column]) -> Column:
    w, last = f["words"], F.size(f["words"]) - WINDOW
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    return F.when(last >= 0, hashes).otherwise(F.array().cast("array<bigint>"))


def _sorted_windows(f: dict[str, Column]) -> Column:
    """(hash, position) sorted; NULL where no window repeats, so the sort is
    skipped for such documents."""
    w = f["windows"]
    pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(w)) < F.size(w), pairs)


def _repeat_words(f: dict[str, Column]) -> Column:
    s = f["sorted_windows"]
    n = F.size(s)

    def twin(x: Column, j: Column) -> Column:
        def same(k: Column) -> Column:
            return F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return ((j > 0) & same(j - 1)) | ((j < n - 1) & same(j + 1))

    positions = F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))
    # each repeated window covers WINDOW words less those the one before it covers
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))

    def add(acc: Column, p: Column) -> Column:
        return F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last"))

    return F.coalesce(F.aggregate(positions, start, add, lambda acc: acc["n"]), F.lit(0)).cast("long")


FEATURES: dict[str, Feature] = {
    "words": Feature(("text",), _words, hidden=True),
    "n_words": Feature(("words",), lambda f: F.size(f["words"]).cast("long")),
    "word_chars": Feature(("text",), lambda f: _chars(_without(f["text"], SPACE))),
    "n_symbols": Feature(("text",), lambda f: _chars(f["text"]) - _chars(_without(f["text"], SYMBOLS))),
    "n_upper": Feature(("text",), lambda f: _chars(f["text"]) - _chars(_without(f["text"], UPPER))),
    "word_lines": Feature(("text",), _word_lines, hidden=True),
    "n_lines": Feature(("word_lines",), lambda f: F.size(f["word_lines"]).cast("long")),
    "n_dup_lines": Feature(("word_lines",), lambda f: (F.size(f["word_lines"])
                                                        - F.size(F.array_distinct(f["word_lines"]))).cast("long")),
    "windows": Feature(("words",), _windows, hidden=True),
    "sorted_windows": Feature(("windows",), _sorted_windows, hidden=True),
    "n_repeat_words": Feature(("sorted_windows",), _repeat_words),
}


class Rule(NamedTuple):
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[dict[str, Column]], Column]


BASE_RULES = (
    Rule("too_few_words", ("n_words",), lambda f: f["n_words"] < 50),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda f: f["n_repeat_words"] * 100 > f["n_words"] * 50),
)
RULES = BASE_RULES + (
    Rule("symbols", ("n_words", "n_symbols"), lambda f: f["n_symbols"] * 10 > f["n_words"]),
    Rule("shouting", ("word_chars", "n_upper"), lambda f: f["n_upper"] * 2 > f["word_chars"]),
    Rule("word_length", ("n_words", "word_chars"),
         lambda f: (f["word_chars"] < f["n_words"] * 2) | (f["word_chars"] > f["n_words"] * 15)),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda f: f["n_dup_lines"] * 100 > f["n_lines"] * 50),
)


def _needed(names: tuple[str, ...]) -> list[str]:
    """The features ``names`` rest on, each after what it needs itself."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name != "text" and name not in out:
            for n in FEATURES[name].needs:
                visit(n)
            out.append(name)

    for n in names:
        visit(n)
    return out


class _Work:
    """A DataFrame with its feature columns under names no input column has."""

    def __init__(self, df: DataFrame, text: str) -> None:
        self.names = {"text": free_name(df, "_q_text")}
        self.input = df.columns
        # later projections stack up: every feature is a plain column above its own
        self.df = df.withColumn(self.names["text"], F.coalesce(F.col(col_ref(text)).cast("string"), F.lit("")))

    def cols(self) -> dict[str, Column]:
        return {k: F.col(col_ref(v)) for k, v in self.names.items()}

    def add(self, wanted: tuple[str, ...], alive: Column | None) -> None:
        for name in _needed(wanted):
            if name not in self.names:
                value = FEATURES[name].build(self.cols())
                self.names[name] = free_name(self.df, f"_q_{name}")
                self.df = self.df.withColumn(self.names[name], value if alive is None else F.when(alive, value))


def add_features(df: DataFrame, features: tuple[str, ...], text: str = "text") -> DataFrame:
    """``df`` with the named features of every whole text as columns."""
    w = _Work(df, text)
    w.add(features, None)
    keep = [F.col(col_ref(c)) for c in w.input if c.lower() not in features]
    return w.df.select(*keep, *[F.col(col_ref(w.names[n])).alias(n) for n in features])


def spread_sample(df: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of ``df`` by a hash of their place, so from all of
    its partitions, written once."""
    n = df.count()
    place = free_name(df, "_q_place")
    spread = df.withColumn(place, F.monotonically_increasing_id())
    return written(spread.where(F.pmod(F.xxhash64(place), F.lit(max(1, n // max(1, rows)))) == 0).drop(place), "quality-sample")


def plan_cascade(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
                 sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """``rules`` by rejections per second on a sample, the best first.

    Only the number of rejected rows reaches the driver. A rule's cost is its
    time less that of a rule that does nothing, the better of two runs each."""
    sample = spread_sample(df.select(text), sample_rows)

    def run(rule: Rule | None) -> tuple[float, int]:
        best, hits = float("inf"), 0
        for _ in range(2):
            w = _Work(sample, text)
            if rule is not None:
                w.add(rule.needs, None)
            out = rule.rejects(w.cols()) if rule is not None else F.length(w.cols()["text"]) < 0
            t0 = time.perf_counter()
            hits = w.df.select(out.alias("r")).agg(F.count_if("r")).head()[0]
            best = min(best, time.perf_counter() - t0)
        return best, hits

    nothing = run(None)[0]
    scored = []
    for k, rule in enumerate(rules):
        seconds, hits = run(rule)
        scored.append((-hits / max(seconds - nothing, 1e-3), seconds, k))
    return [rules[k] for _, _, k in sorted(scored)]


def quality_cascade(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
                    sample_rows: int = SAMPLE_ROWS, ordered: bool = False,
                    kept: str = "kept", reason: str | None = None, first: tuple[Rule, ...] = (),
                    features: tuple[str, ...] = ()) -> DataFrame:
    """``df`` plus a Boolean ``kept`` (and, if ``reason`` is given, the name of
    the rule that rejected the row first in cascade order, else NULL).

    ``ordered=True`` takes ``rules`` in the given order without a sample.
    ``first`` are rules that decide before all others, in the given order;
    ``features`` are put out for every row, kept or not."""
    plan = [*first, *(rules if ordered else plan_cascade(df, rules, text, sample_rows))]
    w = _Work(df, text)
    w.add(features, None)
    failed = free_name(w.df, "_q_failed")
    w.df = w.df.withColumn(failed, F.lit(None).cast("string"))
    for rule in plan:
        w.add(rule.needs, F.col(col_ref(failed)).isNull())
        # a feature skipped for a rejected row is NULL there, and no rule needs it any more
        w.df = w.df.withColumn(failed, F.coalesce(F.col(col_ref(failed)),
                                                  F.when(rule.rejects(w.cols()), F.lit(rule.name))))
    # a filter on the verdict must not be pushed below the projections: there
    # it would be inlined and the features computed once per mention
    stay = F.spark_partition_id() >= 0
    outputs = [F.col(col_ref(w.names[n])).alias(n) for n in features]
    outputs += [(F.col(col_ref(failed)).isNull() & stay).alias(kept)]
    outputs += [F.col(col_ref(failed)).alias(reason)] if reason else []
    names = {kept.lower(), (reason or kept).lower(), *features}
    return w.df.select(*[F.col(col_ref(c)) for c in w.input if c.lower() not in names], *outputs)


METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's metrics of every document, and the cascade's verdict on
    it. The base rules decide first, as the contract has it; the others
    follow in sampled order, on documents that passed the base."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality_cascade(docs, RULES[len(BASE_RULES):], reason="_reason", first=BASE_RULES, features=METRICS)
    base = F.coalesce(F.col("_reason").isin(*[r.name for r in BASE_RULES]), F.lit(False))
    return found.select("doc_id", *METRICS, base.alias("base_failed"), "kept")


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents the cascade keeps."""
    return quality_cascade(docs, kept="_q_kept").where("_q_kept").select(*docs.columns)


OP1_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
u AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o AS gram
      FROM u WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g WHERE gram IS NOT NULL),
n AS (SELECT rid, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r WHERE c > 1) GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
             length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
             CAST(coalesce(n.n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN n USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_upper > word_chars OR word_chars < 2 * n_words
            OR word_chars > 15 * n_words OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM b"""

QUERIES = {"op1_quality_rules": op1_quality_rules}
SQL = {"op1_quality_rules": OP1_SQL}
