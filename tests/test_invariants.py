"""Invariants on the stand-in graph of sf0.001 (symmetric, clean)."""

import os

import pytest
from pyspark.sql import functions as F

from amity import mutual_friend_counts, mutual_friends, ratings_by_address, top_mutual_pairs
from amity.operators.graph import triangles
from amity.plans.standin import StandIn

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def standin(spark):
    return StandIn(spark, SF)


def test_sum_of_counts_is_three_triangles(standin):
    edges = standin.edges()
    total = mutual_friend_counts(edges).agg(F.sum("n_mutual")).first()[0]
    assert total == 3 * triangles(edges).count() > 0


def test_relabelling(standin):
    edges = standin.edges()
    # a bijection that changes the id order (so also which end is u)
    relabel = lambda c: (F.lit(10_000) - F.col(c))
    moved = edges.select(relabel("src").alias("src"), relabel("dst").alias("dst"))
    base = {(r.u, r.v, r.friend_id) for r in mutual_friends(edges).collect()}
    back = {(min(10_000 - r.u, 10_000 - r.v), max(10_000 - r.u, 10_000 - r.v),
             None if r.friend_id is None else 10_000 - r.friend_id)
            for r in mutual_friends(moved).collect()}
    assert base == back


def test_topk_is_prefix_of_full_order(standin):
    edges = standin.edges()
    full = sorted(((r.n_mutual, r.u, r.v) for r in mutual_friend_counts(edges).collect()),
                  key=lambda t: (-t[0], t[1], t[2]))
    top = [(r.n_mutual, r.u, r.v) for r in top_mutual_pairs(edges, 25).collect()]
    assert top == full[:25]


def test_ratings_distinct(standin):
    df = ratings_by_address(standin.business(), standin.reviews(), "ring")
    assert df.count() == df.distinct().count() > 0


def test_mixed_hot_and_cold_keys_on_real_graph(standin):
    from amity import max_friend_age
    edges = standin.edges()
    profiles = standin.profiles()
    plain = sorted(map(tuple, mutual_friend_counts(edges).collect()))
    plain_age = sorted(map(tuple, max_friend_age(edges, profiles, "2024-01-01").collect()))
    split = sorted(map(tuple, mutual_friend_counts(edges, floor_rows=50).collect()))  # some users are hot
    split_age = sorted(map(tuple, max_friend_age(edges, profiles, "2024-01-01", floor_rows=50).collect()))
    assert split == plain and split_age == plain_age
