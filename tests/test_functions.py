"""Column helpers."""

from pyspark.sql import functions as F

from amity.functions.columns import id_list_text, parse_dob, printed_list, row_text, to_id


def test_ids_and_lists(spark):
    df = spark.createDataFrame([(" 007 ", [10, 9, 100]), ("x", [])], "s string, ids array<long>")
    rows = df.select(to_id("s").alias("i"), id_list_text("ids").alias("t")).collect()
    assert [(r.i, r.t) for r in rows] == [(7, "9,10,100"), (None, "")]   # numeric, not text order


def test_printed_list_and_row(spark):
    df = spark.createDataFrame([(["Cy:1/2/1990", "Ann:3/4/1950"], "a", None)], "xs array<string>, a string, b double")
    r = df.select(printed_list("xs").alias("p"), row_text("a", "b").alias("r")).first()
    assert r.p == "[Cy:1/2/1990, Ann:3/4/1950]" and r.r == "[a,null]"


def test_parse_dob(spark):
    df = spark.createDataFrame([("8/27/1970",), ("12/31/1930",), ("2/30/2001",), ("",)], "d string")
    got = [r.x for r in df.select(parse_dob("d").alias("x")).collect()]
    assert [str(g) if g else None for g in got] == ["1970-08-27", "1930-12-31", None, None]
    assert df.select(F.lit(1)).count() == 4
