"""A membership filter in plain expressions: which values may be in a table?

Spark's own runtime filters appear only where the optimizer sees fit. This one
is explicit: one bit a value, in an array of ``bits / 64`` words that a scalar
subquery of the same plan computes, whatever the table's size; rows that
cannot match go before they are shuffled. It never loses a row: where the
table holds many more values than bits, it merely lets more rows through, so an
exact join always follows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24  # 2 MB in a plan that uses the filter


def membership_words(values: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """One row, ``words``: the array of ``bits / 64`` bigints."""
    if bits < 64 or bits & (bits - 1):
        raise ValueError("bits must be a power of two, 64 or more")
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    set_bits = (values.where(F.col(column).isNotNull()).select(place.alias("p"))
                .groupBy(F.shiftright("p", 6).alias("word"))
                .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(63).cast("int"))).alias("bits")))
    # a fixed number of words, so a fixed size in the one task that puts them in order
    found = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    groups = set_bits.groupBy(F.shiftright("word", 8).alias("page")).agg(found.alias("m"))
    page = F.transform(F.sequence(F.lit(0), F.lit(min(256, bits // 64) - 1)),
                       lambda i: F.coalesce(F.element_at("m", F.col("page") * 256 + i), F.lit(0).cast("bigint")))
    pages = values.sparkSession.range(max(1, bits // 64 // 256)).withColumnRenamed("id", "page")
    none = F.transform(F.sequence(F.lit(0), F.lit(min(256, bits // 64) - 1)), lambda i: F.lit(0).cast("bigint"))
    filled = pages.join(groups.select("page", page.alias("ws")), "page", "left").select("page", F.coalesce("ws", none).alias("ws"))
    return filled.agg(F.array_sort(F.collect_list(F.struct("page", "ws"))).alias("all")).select(F.flatten("all.ws").alias("words"))


def in_words(words: DataFrame, bits: int = BITS) -> Callable[[Column], Column]:
    """A test for ``where`` from the one row of ``membership_words``: False
    only for values that were not in the table, and for NULL."""
    array = words.select("words").scalar()

    def test(value: Column) -> Column:
        p = F.pmod(F.xxhash64(value), F.lit(bits))
        word = F.get(array, F.shiftright(p, 6).cast("int"))
        hit = F.call_function("shiftright", word, p.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1
        return value.isNotNull() & hit

    return test


def may_contain(values: DataFrame, column: str, bits: int = BITS) -> Callable[[Column], Column]:
    """``in_words`` of ``values``: the filter is computed when a query that
    uses it runs. Queries that share a filter may write its words first."""
    return in_words(membership_words(values, column, bits), bits)
