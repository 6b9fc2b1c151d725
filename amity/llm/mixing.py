"""Mixing sources to target weights by temperature (native expressions only).

Source s with t_s tokens gets weight t_s**alpha / sum. ``alpha`` = 1 keeps the
corpus' own shares, 0 makes all sources equal. It is found by bisection: the
smallest alpha in [0, 1] whose weights' entropy does not exceed the target and
at which no source is repeated more often than ``max_epochs`` times as often
as the least repeated one. Both only move one way with alpha.

The budget is the number of tokens at which the least repeated source is read
once in full, so no document is lost; a budget of one's own may be given.
Weights become quotas of whole tokens, and quotas become *block permutations*:
a keyed hash of the document permutes each source, and the high bits of the
hash cut the permutation into blocks. A source's whole epochs take every
document; its last, partial epoch takes whole blocks in order while they fit,
then documents of the next block while those fit. Only one row a block is
summed along a source, and only the documents of one block in order, so a
source with a third of all rows is no single task's work. What a document gets
follows from a few numbers a source, a table with one row a source. Up to
``MAX_SOURCES`` of them it is planned on the driver and broadcast; where there
are more, the same numbers come from aggregates of the table (the exponent
from its sums at several candidates a pass) and it is joined like any table.

Defined results: a NULL source is a source of its own; a document without a
word has no tokens and goes with every whole epoch, and with the partial one
if its place in the permutation is reached; rows repeated with the same
doc_id, source and token count share one place; an empty table gives none.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, free_name, read_table, written

SEED = 2024
MAX_SOURCES = 100_000  # sources whose weights are planned on the driver and broadcast
CANDIDATES = 32        # parts the interval of exponents is cut into by one pass over more sources
BLOCK_ROWS = 4096      # expected documents of a block
KEY_BITS = 60          # of the permutation key, which is a positive bigint
ENTROPY_GAIN = 0.5     # default target: this far from the corpus' entropy to the largest
MAX_EPOCHS = 2.0
STEPS = 60
SPACE = " \t\n\x0b\f\r"
PLAN = ("source", "weight", "whole", "rest", "width")
PLAN_TYPES = "source:string,weight:double,whole:bigint,rest:bigint,width:bigint"


def word_count(text: Column) -> Column:
    """Words of a whole text, as its tokens."""
    flat = F.translate(F.coalesce(text.cast("string"), F.lit("")), SPACE, " " * len(SPACE))
    return F.size(F.array_remove(F.split(flat, " "), "")).cast("bigint")


def permutation_key(doc_id: Column, seed: int = SEED) -> Column:
    """Place of a document in its source's permutation: 60 bits of an MD5."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("bigint")


def weights(tokens: list[int], alpha: float) -> list[float]:
    powers = [t ** alpha if t else 0.0 for t in tokens]
    total = sum(powers)
    return [p / total if total else 0.0 for p in powers]


def entropy(shares: list[float]) -> float:
    return -sum(w * math.log(w) for w in shares if w > 0)


def find_alpha(tokens: list[int], target_entropy: float | None = None, max_epochs: float | None = MAX_EPOCHS) -> float:
    """The exponent, by bisection; a target out of reach gives the nearest end."""
    some = [t for t in tokens if t]
    if len(some) < 2:
        return 1.0
    if target_entropy is None:
        own = entropy(weights(some, 1.0))
        target_entropy = own + ENTROPY_GAIN * (math.log(len(some)) - own)

    def fits(alpha: float) -> bool:
        repeated = (max(some) / min(some)) ** (1 - alpha)
        return entropy(weights(some, alpha)) <= target_entropy and (max_epochs is None or repeated <= max_epochs)

    lo, hi = 0.0, 1.0
    if fits(lo):
        return lo
    for _ in range(STEPS):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if fits(mid) else (mid, hi)
    return hi


def quotas(tokens: list[int], alpha: float, budget: int | None = None) -> tuple[list[float], list[int]]:
    """(weights, whole tokens to take) a source; without a budget, enough that
    the least repeated source is taken once."""
    w = weights(tokens, alpha)
    if budget is None:
        once = max(((t / x) for t, x in zip(tokens, w, strict=True) if t), default=0.0)
        return w, [max(t, round(x * once)) for t, x in zip(tokens, w, strict=True)]
    return w, [math.floor(x * budget) for x in w]


def mix_sources(docs: DataFrame, target_entropy: float | None = None, max_epochs: float | None = MAX_EPOCHS,
                budget: int | None = None, doc_id: str = "doc_id", source: str = "source", tokens: Column | None = None,
                text: str = "text", seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` plus ``tokens``, ``weight`` (of its source), ``copies`` (how
    often the mix holds the document; 0 only with a budget of one's own),
    ``block`` and ``place``: copies are read by epoch, block and place."""
    spark = docs.sparkSession
    made = ("tokens", "weight", "copies", "block", "place")
    n = {c: free_name(docs, f"_m_{c}") for c in ("source", "id", *made)}
    at = {c: F.col(v) for c, v in n.items()}
    count = word_count(F.col(col_ref(text))) if tokens is None else tokens.cast("bigint")
    rows = docs.withColumns({n["source"]: F.col(col_ref(source)).cast("string"), n["tokens"]: count,
                             n["place"]: permutation_key(F.col(col_ref(doc_id)), seed),
                             n["id"]: F.coalesce(F.col(col_ref(doc_id)).cast("string"), F.lit(""))})
    narrow = written(rows.select(*[at[c].alias(c) for c in ("source", "id", "tokens", "place")]), "mix-documents")
    totals = written(narrow.groupBy("source").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("c")), "mix-totals")
    few = totals.head(MAX_SOURCES + 1)
    if len(few) <= MAX_SOURCES:
        sources = _planned_here(spark, few, target_entropy, max_epochs, budget, block_rows)
        hint = F.broadcast
    else:
        sources = written(_planned_there(totals, target_entropy, max_epochs, budget, block_rows), "mix-plan")

        def hint(df: DataFrame) -> DataFrame:
            return df
    blocked = _with_plan(narrow, sources, "source", hint).select(
        "source", "id", "tokens", "place", "rest", F.floor(F.col("place") / F.col("width")).alias("block"))
    # whole blocks that fit, in the order of the permutation: one row a block
    sums = written(blocked.groupBy("source", "block", "rest").agg(F.sum("tokens").alias("t")), "mix-blocks")
    run = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("t").over(run))
    cut = sums.groupBy("source").agg(F.min(F.when(F.col("upto") > F.col("rest"), F.col("block"))).alias("block"),
                                     F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto"))).alias("used"))
    cut = written(cut, "mix-cuts")  # one row a source
    # in the block that does not fit as a whole, documents while they fit
    edge = blocked.join(hint(cut.withColumnRenamed("block", "b")),
                        blocked["source"].eqNullSafe(cut["source"]) & (F.col("block") == F.col("b"))) \
        .select(blocked["source"], "place", "id", "tokens", (F.col("rest") - F.coalesce("used", F.lit(0))).alias("room"))
    run = Window.partitionBy("source").orderBy("place", "id", "tokens")
    edge = edge.groupBy("source", "place", "id", "tokens", "room").agg(F.sum("tokens").alias("t")) \
        .withColumn("upto", F.sum("t").over(run))
    last = edge.where("upto <= room").groupBy("source").agg(F.max(F.struct("place", "id", "tokens")).alias("last"))
    limits = written(_with_plan(sources, cut.select("source", F.col("block").alias("cut")), "source", hint, "left")
                     .join(last.withColumnRenamed("source", "ls"), F.expr("source <=> ls"), "left").drop("ls"), "mix-limits")
    own = {c: free_name(rows, f"_m_of_{c}") for c in limits.columns}  # no input column's names
    of = {c: F.col(v) for c, v in own.items()}
    rows = rows.join(hint(limits.select(*[F.col(c).alias(v) for c, v in own.items()])),
                     at["source"].eqNullSafe(of["source"]))
    block = F.floor(at["place"] / of["width"])
    here = F.struct(at["place"].alias("place"), at["id"].alias("id"), at["tokens"].alias("tokens"))
    partial = (of["rest"] > 0) & (of["cut"].isNull() | (block < of["cut"])
                                  | ((block == of["cut"]) & F.coalesce(here <= of["last"], F.lit(False))))
    keep = [F.col(col_ref(c)) for c in docs.columns if c.lower() not in made]
    return rows.select(*keep, at["tokens"].alias("tokens"), of["weight"].alias("weight"),
                       (of["whole"] + partial.cast("bigint")).alias("copies"), block.alias("block"), at["place"].alias("place"))


def _planned_here(spark: SparkSession, totals: list, target_entropy: float | None, max_epochs: float | None,
                  budget: int | None, block_rows: int) -> DataFrame:
    """``PLAN`` of at most ``MAX_SOURCES`` sources, as short rows of one JSON text."""
    totals = sorted(totals, key=lambda r: (r.source is None, r.source or ""))
    alpha = find_alpha([r.t for r in totals], target_entropy, max_epochs)
    share, quota = quotas([r.t for r in totals], alpha, budget)
    plan = []
    for r, w, q in zip(totals, share, quota, strict=True):
        whole, rest = divmod(q, r.t) if r.t else (1, 0)
        bits = max(0, math.ceil(math.log2(max(1, r.c / block_rows))))
        plan.append((r.source, w, whole, rest, 1 << (KEY_BITS - bits)))
    table = F.from_json(F.lit(json.dumps([dict(zip(PLAN, p, strict=True)) for p in plan])), f"array<struct<{PLAN_TYPES}>>")
    return spark.range(1).select(F.inline(table))


def _alpha_of(totals: DataFrame, target_entropy: float | None, max_epochs: float | None) -> float:
    """``find_alpha`` over a table of any size: each pass sums the powers at
    the inner ends of ``CANDIDATES`` parts of the interval, which settles as
    many bisections as their number has bits."""
    some = totals.where("t > 0").select(F.col("t").cast("double").alias("t"))
    n, least, most = some.agg(F.count(F.lit(1)), F.min("t"), F.max("t")).head()
    if n < 2:
        return 1.0

    def entropies(alphas: list[float]) -> list[float]:
        power = [F.pow("t", F.lit(a)) for a in alphas]
        row = some.agg(*[F.sum(p) for p in power], *[F.sum(p * F.log(p)) for p in power]).head()
        return [math.log(x) - y / x for x, y in zip(row[:len(alphas)], row[len(alphas):], strict=True)]

    if target_entropy is None:
        own = entropies([1.0])[0]
        target_entropy = own + ENTROPY_GAIN * (math.log(n) - own)

    def first_fit(alphas: list[float]) -> int:
        """Index of the first exponent that fits; past the end if none does."""
        for k, (a, h) in enumerate(zip(alphas, entropies(alphas), strict=True)):
            if h <= target_entropy and (max_epochs is None or (most / least) ** (1 - a) <= max_epochs):
                return k
        return len(alphas)

    lo, hi = 0.0, 1.0
    if first_fit([lo]) == 0:
        return lo
    for _ in range(STEPS // (CANDIDATES.bit_length() - 1)):
        ends = [lo + (hi - lo) * k / CANDIDATES for k in range(1, CANDIDATES)]
        k = first_fit(ends)
        lo, hi = ends[k - 1] if k else lo, ends[k] if k < len(ends) else hi
    return hi


def _planned_there(totals: DataFrame, target_entropy: float | None, max_epochs: float | None, budget: int | None,
                   block_rows: int) -> DataFrame:
    """``PLAN`` of any number of sources, as a table."""
    alpha = _alpha_of(totals, target_entropy, max_epochs)
    t = F.col("t")
    power = F.when(t > 0, F.pow(t.cast("double"), F.lit(alpha))).otherwise(0.0)
    total = totals.agg(F.sum(power)).head()[0] or 0.0
    rows = totals.withColumn("weight", power / F.lit(total) if total else F.lit(0.0))
    if budget is None:
        once = rows.where("t > 0").agg(F.max(t / F.col("weight"))).head()[0] or 0.0
        quota = F.greatest(t, F.bround(F.col("weight") * F.lit(once), 0).cast("bigint"))
    else:
        quota = F.floor(F.col("weight") * F.lit(budget)).cast("bigint")
    rows = rows.withColumn("quota", quota)
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("c") / F.lit(block_rows)))).cast("int"))
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(KEY_BITS) - bits)
    return rows.select("source", "weight", F.when(t > 0, F.floor(F.col("quota") / t)).otherwise(1).cast("bigint").alias("whole"),
                       F.when(t > 0, F.col("quota") % t).otherwise(0).cast("bigint").alias("rest"), width.alias("width"))


def _with_plan(df: DataFrame, plan: DataFrame, key: str, hint, how: str = "inner") -> DataFrame:
    """``df`` with the columns of the per-source table ``plan``."""
    other = free_name(df, "_m_key")
    return df.join(hint(plan.withColumnRenamed(key, other)), F.col(key).eqNullSafe(F.col(other)), how).drop(other)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's source weight and number of copies in the mix."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "source", "tokens", F.round("weight", 9).alias("weight"), "copies")


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix holds it."""
    out = mix_sources(docs)
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return out.where("copies > 0").withColumn(free_name(out, "_m_epoch"), times).select(*docs.columns)


OP9_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens,
         CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS place FROM documents),
s AS (SELECT source, CAST(sum(tokens) AS BIGINT) AS t FROM d GROUP BY source),
own AS (SELECT -sum(p * ln(p)) AS h, ln(count(*)) AS top, max(t) / min(t) AS spread
        FROM (SELECT t, t / sum(t) OVER () AS p FROM s WHERE t > 0)),
bisect AS (
  SELECT 0 AS step, CAST(0 AS DOUBLE) AS lo, CAST(1 AS DOUBLE) AS hi
  UNION ALL
  SELECT step + 1, CASE WHEN fits THEN lo ELSE mid END, CASE WHEN fits THEN mid ELSE hi END
  FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid,
               (SELECT ln(sum(t ** ((lo + hi) / 2))) - sum(t ** ((lo + hi) / 2) * ln(t ** ((lo + hi) / 2))) / sum(t ** ((lo + hi) / 2))
                FROM s WHERE t > 0) <= h + {ENTROPY_GAIN} * (top - h) AND spread ** (1 - (lo + hi) / 2) <= {MAX_EPOCHS} AS fits
        FROM bisect, own WHERE step < {STEPS})),
a AS (SELECT hi AS alpha FROM bisect WHERE step = {STEPS}),
w AS (SELECT source, t, t ** alpha / sum(t ** alpha) OVER () AS weight FROM s, a),
q AS (SELECT *, greatest(t, CAST(round_even(weight * max(t / weight) OVER (), 0) AS BIGINT)) AS quota FROM w),
r AS (SELECT d.*, weight, quota // t AS whole, quota % t AS rest,
             sum(d.tokens) OVER (PARTITION BY d.source ORDER BY place, CAST(doc_id AS VARCHAR)) AS upto
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, source, tokens, round(weight, 9) AS weight,
       CAST(whole + (CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END) AS BIGINT) AS copies FROM r"""

QUERIES = {"op9_mixing": op9_mixing}
SQL = {"op9_mixing": OP9_SQL}
