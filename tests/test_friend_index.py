"""The stored friend index: equal answers, bounded rows, pruned top pairs."""

import random

import pytest
from pyspark.sql import functions as F

from amity import (max_friend_age, mutual_friend_counts, mutual_friend_lists, mutual_friend_profiles, mutual_friend_rows,
                   mutual_friends, read_friend_index, read_friends, top_mutual_pairs, top_mutual_pairs_named, write_friend_index)
from amity.operators import friend_index as X
from amity.session import scratch_path
from tests.test_graph import E1, brute_force, lists_of


def index_of(spark, edges, **options):
    return write_friend_index(edges, scratch_path(spark, "index"), **options)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fixture(spark, friends_path):
    path = scratch_path(spark, "index")
    write_friend_index(read_friends(spark, friends_path).edges, path)
    index = read_friend_index(spark, path)
    assert lists_of(mutual_friends(index)) == E1
    assert {(r.u, r.v): r.n_mutual for r in mutual_friend_counts(index).collect()} == {k: len(v) for k, v in E1.items()}
    assert [(r.u, r.v, r.n_mutual) for r in top_mutual_pairs(index, 3).collect()] == [(0, 1, 2), (0, 2, 1), (0, 3, 1)]


def graph(seed):
    """Hubs that list few and are listed by many, one-sided edges, ids far apart."""
    rnd = random.Random(seed)
    n = 60
    edges = {(rnd.randrange(n), rnd.randrange(n)) for _ in range(500)} | {(k, 0) for k in range(1, n)} | {(0, k) for k in range(1, n, 3)}
    edges |= {(1, k) for k in range(2, n)} | {(k, 1) for k in range(2, n, 2)}
    edges |= {(100 + k, 200 + k) for k in range(3)}
    return {(s * 10 ** 9 + 7, d * 10 ** 9 + 7) for s, d in edges if s != d}


# lists in one row; in hashed parts; in bitmaps; some of each
SHAPES = [(512, 256, 8192, 64), (4, 3, 8192, 0), (4, 3, 64, 100), (4, 2, 64, 2), (20, 8, 128, 3)]


@pytest.mark.parametrize("whole,part,span,dense", SHAPES)
def test_answers_equal_brute_force(spark, monkeypatch, whole, part, span, dense):
    for name, value in (("PART", part), ("SPAN", span), ("DENSE", dense), ("OWNED", 3), ("HOT", 7), ("FIRST", 5)):
        monkeypatch.setattr(X, name, value)
    edge_set = graph(whole + dense)
    index = index_of(spark, spark.createDataFrame(sorted(edge_set), "src long, dst long"), whole=whole, floor_rows=5)
    want = brute_force(edge_set)
    assert lists_of(mutual_friends(index)) == want
    got = {}
    for r in mutual_friend_rows(index).collect():
        got.setdefault((r.u, r.v), []).append(r.friend_id)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    counts = mutual_friend_counts(index).collect()
    assert {(r.u, r.v): r.n_mutual for r in counts} == {k: len(v) for k, v in want.items()} and len(counts) == len(want)
    full = sorted(((len(v), *k) for k, v in want.items()), key=lambda t: (-t[0], t[1:]))
    for k in (0, 1, 7, 40, len(full) + 5):
        assert [(r.n_mutual, r.u, r.v) for r in top_mutual_pairs(index, k).collect()] == full[:k]
    assert {tuple(r) for r in index.edges().collect()} == edge_set
    kinds = {(r.part > 0, r.words is not None) for r in index.lists.collect()}
    assert (True, True) in kinds or not (whole < 100 and dense * 4 > 60)
    assert max(len(r.ids) for r in index.lists.collect()) <= max(whole, span if dense else 60)


def test_no_edges(spark):
    index = index_of(spark, spark.createDataFrame([], "src long, dst long"))
    assert mutual_friends(index).count() == mutual_friend_counts(index).count() == top_mutual_pairs(index, 3).count() == 0


def test_ranks_are_dense(spark):
    users = spark.range(1000).select(F.col("id").alias("user_id"), (F.col("id") % 7).alias("degree"), F.lit(1).alias("listed"))
    got = X._ranked(users.repartition(5), scratch_path(spark, "ranges")).orderBy("degree", "user_id").collect()
    assert [r["rank"] for r in got] == list(range(1000))


def test_exchanges_of_a_question(spark):
    edges = spark.createDataFrame(sorted(graph(1)), "src long, dst long")
    for whole, most in ((512, 2), (4, 3)):
        index = index_of(spark, edges, whole=whole)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            for df in (mutual_friend_counts(index), mutual_friend_rows(index)):
                assert plan_of(df).count("Exchange hashpartitioning") <= most
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def hub_graph(spark, n_users=3000, hubs=6):
    """A sparse ring, and hubs that are friends with everybody."""
    rnd = random.Random(3)
    edges = {(k, (k + d) % n_users) for k in range(n_users) for d in (1, 2)} | {(k, rnd.randrange(n_users)) for k in range(n_users)}
    edges |= {(k, h) for k in range(n_users) for h in range(hubs)}
    edges = {(s, d) for s, d in edges if s != d}
    return spark.createDataFrame(sorted(edges | {(d, s) for s, d in edges}), "src long, dst long")


def test_top_pairs_meet_few_lists(spark):
    index = index_of(spark, hub_graph(spark), whole=64)
    counts = mutual_friend_counts(index)
    top = [tuple(r) for r in top_mutual_pairs(index, 10).collect()]
    order = [F.col("n_mutual").desc(), "u", "v"]
    assert top == [tuple(r) for r in counts.orderBy(*order).limit(10).collect()]
    least = index.threshold(10)
    few, all_ = index.meetings(least=least).count(), index.meetings().count()
    assert few < 100 and all_ > 20_000


def test_named_pairs_profiles_and_ages(spark, friends_path, profiles_path):
    from amity import read_profiles
    edges, profiles = read_friends(spark, friends_path).edges, read_profiles(spark, profiles_path).rows
    index = index_of(spark, edges)
    assert top_mutual_pairs_named(index, profiles, 3).collect() == top_mutual_pairs_named(edges, profiles, 3).collect()
    for a, b in ((0, 1), (1, 0), (6, 7), (2, 28)):
        assert sorted(mutual_friend_profiles(index, profiles, a, b).collect()) == sorted(mutual_friend_profiles(edges, profiles, a, b).collect())
    assert sorted(map(str, max_friend_age(index, profiles, "2020-06-15").collect())) == \
        sorted(map(str, max_friend_age(edges, profiles, "2020-06-15").collect()))
    assert len(mutual_friend_lists(mutual_friends(index)).collect()) == len(E1)


def test_a_meeting_carries_ranks_only_to_bitmaps(spark, monkeypatch):
    for name, value in (("PART", 2), ("SPAN", 64), ("DENSE", 2), ("OWNED", 3), ("HOT", 7)):
        monkeypatch.setattr(X, name, value)
    edge_set = graph(6)
    index = index_of(spark, spark.createDataFrame(sorted(edge_set), "src long, dst long"), whole=4)
    met = index.meetings()
    assert met.schema["own"].dataType.simpleString() == "array<bigint>"
    rows = met.select("own", "own_ranks", F.col("words_y").isNotNull().alias("bits")).collect()
    assert {r.bits for r in rows} == {True, False}
    assert all((r.own_ranks is not None) == r.bits and (not r.bits or len(r.own_ranks) == len(r.own)) for r in rows)
