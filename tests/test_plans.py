"""Plan assertions: top-k as TakeOrderedAndProject, no Python in any plan,
filters and column pruning reach the parquet scan."""

import pytest

import __spark_entry__ as entry
from amity import ratings_by_address
from amity.plans import catalog

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["top_mutual_pairs", "oldest_friend_top", "top_mutual_pairs_named",
                                  "top_rated_businesses"])
def test_topk_plans(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_nodes(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_pushdown_and_pruning(spark, tmp_path):
    b = spark.createDataFrame([("b1", "x Stanford", "c", 1)], "business_id string, full_address string, "
                                                              "categories string, extra int")
    r = spark.createDataFrame([("r1", "u1", "b1", 4.0, "zzz")], "review_id string, user_id string, "
                                                                "business_id string, stars double, text string")
    b.write.parquet(str(tmp_path / "b"))
    r.write.parquet(str(tmp_path / "r"))
    df = ratings_by_address(spark.read.parquet(str(tmp_path / "b")), spark.read.parquet(str(tmp_path / "r")),
                            "Stanford")
    plan = plan_of(df)
    assert "StringContains(full_address,Stanford)" in plan
    assert "ReadSchema: struct<business_id:string,full_address:string>" in plan
    assert "ReadSchema: struct<user_id:string,business_id:string,stars:double>" in plan
