"""Business / review operators on the hand fixture."""

import pytest

from amity import ratings_by_address, read_business, read_reviews, top_rated_businesses, top_rated_businesses_sql


@pytest.fixture
def business(spark, business_path):
    return read_business(spark, business_path).rows


@pytest.fixture
def reviews(spark, reviews_path):
    return read_reviews(spark, reviews_path).rows


def test_readers(business, reviews):
    b = business.collect()
    assert len(b) == 5 and b[1].full_address == "1 First St: Stanford, CA"
    assert b[0].categories == "List(Food, Bars)"
    stars = {r.review_id: r.stars for r in reviews.collect()}
    assert stars["r3"] == 4.0 and stars["r5"] is None


def test_ratings_by_address(business, reviews):
    got = sorted(ratings_by_address(business, reviews, "Stanford").collect(), key=lambda r: r.user_id)
    assert [(r.user_id, r.stars) for r in got] == [("u1", 5.0), ("u2", 4.0), ("u3", None)]


def _check_e7(rows):
    assert [(r.business_id, list(r.categories), r.full_address) for r in rows] == [
        ("b1", ["List(Food, Bars)"], "12 Main St Stanford, CA"),
        ("b2", ["List(Parks)"], "1 First St: Stanford, CA"),
        ("b3", ["List(X)"], "9 Elm St stanford, CA"),
    ]
    assert [round(r.avg_stars, 6) for r in rows] == [4.666667, 4.0, 3.0]


def test_top_rated(business, reviews):
    _check_e7(top_rated_businesses(business, reviews, 10).collect())


def test_top_rated_sql(spark, business, reviews):
    _check_e7(top_rated_businesses_sql(spark, business, reviews, 10).collect())


def test_top_rated_k_is_prefix(business, reviews):
    assert [r.business_id for r in top_rated_businesses(business, reviews, 2).collect()] == ["b1", "b2"]


def test_multiple_addresses_per_business(spark):
    business = spark.createDataFrame([("b1", "A", "c1"), ("b1", "B", "c2"), ("b1", "B", "c3"), ("b2", "C", "c4")],
                                     "business_id string, full_address string, categories string")
    reviews = spark.createDataFrame([("r1", "u", "b1", 2.0), ("r2", "u", "b1", 4.0), ("r3", "u", "b2", 5.0)],
                                    "review_id string, user_id string, business_id string, stars double")
    df_rows = [tuple(r) for r in top_rated_businesses(business, reviews, 2).collect()]
    sql_rows = [tuple(r) for r in top_rated_businesses_sql(spark, business, reviews, 2).collect()]
    assert df_rows == sql_rows == [("b2", ["c4"], "C", 5.0), ("b1", ["c1"], "A", 3.0)]


def test_rating_rejects(spark, tmp_path):
    from tests.conftest import write_lines
    lines = ["b1::A::List(X)", "b2::a::b::List(Y)", '"The Place" Stanford::List(B)', 'b3::"The Place" Stanford::List(B)', "b4::A"]
    parsed = read_business(spark, write_lines(tmp_path, "b.txt", lines))
    kept, lost = [r.business_id for r in parsed.rows.collect()], [r.line for r in parsed.rejects.collect()]
    assert "b1" in kept and len(kept) + len(lost) == 5 and {lines[1], lines[2], lines[4]} <= set(lost)
    parsed = read_reviews(spark, write_lines(tmp_path, "r.txt", ["r1::u::b::4", "r2::u::b::bad", "r3::u::b", "r4::u::b::1::2"]))
    assert {(r.review_id, r.stars) for r in parsed.rows.collect()} == {("r1", 4.0), ("r2", None)}
    got = {(r.line, r.reason, tuple(r.bad)) for r in parsed.rejects.collect()}
    assert got == {("r2::u::b::bad", "stars", ("bad",)), ("r3::u::b", "arity", ()), ("r4::u::b::1::2", "arity", ())}


def test_sql_form_keeps_the_callers_views(spark, business, reviews):
    spark.range(3).createOrReplaceTempView("business_table")
    assert len(top_rated_businesses_sql(spark, business, reviews, 2).collect()) == 2
    assert spark.table("business_table").columns == ["id"]
    spark.catalog.dropTempView("business_table")


def test_prefilter_shuffles_fewer_reviews(spark):
    from amity import ratings_by_address
    business = spark.range(5000).selectExpr("'b' || id AS business_id", "if(id % 50 = 0, 'Stanford', 'Reno') AS full_address")
    reviews = spark.range(60000).selectExpr("'b' || id % 6000 AS business_id", "id % 900 AS user_id", "double(id % 5) AS stars")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = {}
        for prefilter in (False, True):
            df = ratings_by_address(business, reviews, prefilter=prefilter, bits=1 << 16)
            moved[prefilter] = sorted(map(tuple, df.collect())), rows_into_exchanges(df)
        assert moved[True][0] == moved[False][0]
        assert moved[False][1] >= 60000 and moved[True][1] < 12000  # reviews, businesses and the distinct rows
        plan = ratings_by_address(business, reviews, prefilter=True)._jdf.queryExecution().executedPlan().toString()
        assert "Subquery" in plan and "bit_or" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_into_exchanges(df):
    """Shuffled rows of the plan that ran, subqueries left out."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "ShuffleExchangeExec":
            total += node.metrics().get("shuffleRecordsWritten").get().value()
        for i in range(node.children().size()):
            todo.append(node.children().apply(i))
    return total


def test_top_rated_beyond_the_broadcast_bound(spark, business_path, reviews_path, monkeypatch):
    from amity import read_business, read_reviews, top_rated_businesses
    from amity.operators import ratings
    b, r = read_business(spark, business_path).rows, read_reviews(spark, reviews_path).rows
    want = top_rated_businesses(b, r, 10).collect()
    monkeypatch.setattr(ratings, "MAX_TOP_K", 1)
    assert top_rated_businesses(b, r, 10).collect() == want
