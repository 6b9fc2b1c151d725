"""Membership filter: no row lost, few too many."""

import pytest

from amity.functions.membership import may_contain
from pyspark.sql import functions as F


@pytest.mark.parametrize("bits,most", [(64, 20000), (1 << 12, 6000), (1 << 20, 1100)])
def test_never_loses_a_row(spark, bits, most):
    values = spark.createDataFrame([(k * 13,) for k in range(1000)] + [(None,)], "v long")
    rows = spark.range(20000).union(spark.createDataFrame([(None,)], "id long"))
    kept = {r.id for r in rows.where(may_contain(values, "v", bits)(F.col("id"))).collect()}
    assert {k * 13 for k in range(1000)} <= kept | set(range(20000, 20000 + 13000)) and None not in kept and len(kept) <= most


def test_text_values_empty_tables_and_bad_sizes(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    assert [r.t for r in rows.where(may_contain(rows.where("t = 'a'"), "t")(F.col("t"))).collect()] == ["a"]
    assert rows.where(may_contain(rows.limit(0), "t", 128)(F.col("t"))).count() == 0
    for bits in (0, 32, 100):
        with pytest.raises(ValueError):
            may_contain(rows, "t", bits)
