"""Mutual friends, counts, top pairs on the friends fixture."""

import pytest

from amity import (mutual_friend_counts, mutual_friend_lists, mutual_friend_rows, mutual_friends,
                   read_friends, top_mutual_pairs)

E1 = {
    (0, 1): [2, 3], (0, 2): [1], (0, 3): [1], (0, 9): [1], (1, 2): [0], (1, 3): [0], (1, 9): [0],
    (12, 13): [14], (12, 14): [13], (13, 14): [12],
    (0, 8): [], (2, 28): [], (3, 29): [], (6, 7): [], (10, 11): [], (17, 18): [], (19, 20): [],
    (19, 21): [], (22, 23): [], (26, 27): [], (28, 29): [],
}


@pytest.fixture
def edges(spark, friends_path):
    return read_friends(spark, friends_path).edges


def lists_of(df):
    return {(r.u, r.v): list(r.mutual) for r in mutual_friend_lists(df).collect()}


def test_mutual_friends_long_form(edges):
    rows = mutual_friends(edges).collect()
    assert len(rows) == sum(max(1, len(v)) for v in E1.values())
    assert lists_of(mutual_friends(edges)) == E1
    for r in rows:
        assert r.friend_id not in (r.u, r.v)


def test_counts(edges):
    got = {(r.u, r.v): r.n_mutual for r in mutual_friend_counts(edges).collect()}
    assert got == {k: len(v) for k, v in E1.items()}


def test_top_pairs(edges):
    top = [(r.u, r.v, r.n_mutual) for r in top_mutual_pairs(edges, 10).collect()]
    assert top == [(0, 1, 2), (0, 2, 1), (0, 3, 1), (0, 9, 1), (1, 2, 1), (1, 3, 1), (1, 9, 1),
                   (12, 13, 1), (12, 14, 1), (13, 14, 1)]
    assert [tuple(r) for r in top_mutual_pairs(edges, 3).collect()] == [tuple(r) for r in top[:3]]


def test_salted_path_equals_plain(edges):
    plain = sorted(tuple(r) for r in mutual_friend_rows(edges).collect())
    salted = sorted(tuple(r) for r in mutual_friend_rows(edges, floor_rows=1).collect())  # every key split
    small = sorted(tuple(r) for r in mutual_friend_rows(edges, chunk=1).collect())        # every list cut
    assert salted == plain == small
    counts = {(r.u, r.v): r.n_mutual for r in mutual_friend_counts(edges, floor_rows=1).collect()}
    assert counts == {k: len(v) for k, v in E1.items()}


def brute_force(edge_set):
    lists = {}
    for s, d in edge_set:
        lists.setdefault(s, set()).add(d)
    pairs = {(min(s, d), max(s, d)) for s, d in edge_set}
    return {(u, v): sorted(lists.get(u, set()) & lists.get(v, set())) for u, v in pairs}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_directed_graphs_against_brute_force(spark, seed):
    import random
    rnd = random.Random(seed)
    n = 40
    # a hub listed by many, lists few; plus random one-sided and two-sided edges
    edge_set = {(rnd.randrange(n), rnd.randrange(n)) for _ in range(300)}
    edge_set |= {(i, 0) for i in range(1, n, 2)} | {(0, 1), (0, 2)}
    edge_set = {(s, d) for s, d in edge_set if s != d}
    edges = spark.createDataFrame(sorted(edge_set), "src long, dst long")
    expected = brute_force(edge_set)
    assert lists_of(mutual_friends(edges)) == expected
    got = {(r.u, r.v): r.n_mutual for r in mutual_friend_counts(edges, floor_rows=3).collect()}
    assert got == {k: len(v) for k, v in expected.items()}


def test_top_pairs_fill_with_zero_pairs(spark):
    # two pairs share a friend, all others share nobody: the top 6 needs zeros
    edges = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (3, 1), (2, 3), (3, 2),
                                   (5, 6), (6, 5), (7, 8), (9, 4), (0, 9)], "src long, dst long")
    full = sorted(((r.n_mutual, r.u, r.v) for r in mutual_friend_counts(edges).collect()),
                  key=lambda t: (-t[0], t[1], t[2]))
    for k in (1, 3, 4, 6, 20):
        got = [(r.n_mutual, r.u, r.v) for r in top_mutual_pairs(edges, k).collect()]
        assert got == full[:k]


def test_shared_rows(spark, edges):
    from amity import top_mutual_pairs_named
    from amity.session import scratch_path
    mutual_friend_rows(edges).write.parquet(path := scratch_path(spark, "shared-rows"))
    rows = spark.read.parquet(path)
    assert lists_of(mutual_friends(edges, rows=rows)) == E1
    got = {(r.u, r.v): r.n_mutual for r in mutual_friend_counts(edges, rows=rows).collect()}
    assert got == {k: len(v) for k, v in E1.items()}
    assert [tuple(r) for r in top_mutual_pairs(edges, 3, rows=rows).collect()] == \
        [tuple(r) for r in top_mutual_pairs(edges, 3).collect()]
    profiles = spark.createDataFrame([(0, "Ann", "Ash", "1 A St")], "user_id long, first_name string, "
                                                                    "last_name string, address string")
    assert top_mutual_pairs_named(edges, profiles, 1, rows=rows).first().first_u == "Ann"


@pytest.mark.parametrize("seed,floor,chunk", [(4, None, 128), (5, 2, 3), (6, 1, 1)])
def test_chunks_and_pieces_against_brute_force(spark, seed, floor, chunk):
    import random
    from amity.operators.graph import triangles
    rnd = random.Random(seed)
    edge_set = {(rnd.randrange(30), rnd.randrange(30)) for _ in range(250)} | {(i, 0) for i in range(1, 30)}
    edge_set = {(s, d) for s, d in edge_set if s != d}
    edges = spark.createDataFrame(sorted(edge_set), "src long, dst long")
    expected = brute_force(edge_set)
    got = {}
    for r in mutual_friend_rows(edges, floor, chunk).collect():
        got.setdefault((r.u, r.v), []).append(r.friend_id)
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in expected.items() if v}
    near = {frozenset(e) for e in edge_set}
    corners = [frozenset((r.x, r.y, r.w)) for r in triangles(edges, floor, chunk).collect()]
    brute = {frozenset((a, b, c)) for a in range(30) for b in range(a) for c in range(b)
             if {frozenset((a, b)), frozenset((b, c)), frozenset((a, c))} <= near}
    assert len(corners) == len(brute) and set(corners) == brute


def test_one_users_pairs_are_many_tasks(spark):
    """A user pointing at 1,500 well-connected users is spread over its chunks."""
    from amity.operators.graph import _chunks
    hub, n = 0, 1500
    rows = [(hub, i) for i in range(1, n + 1)] + [(i, 100_000 + i * 3 + k) for i in range(1, n + 1) for k in range(3)]
    rows += [(100_000 + i, 1_000_000 + i * 5 + k) for i in range(3, 4600) for k in range(5)]
    # the 1,500 know one another's neighbours in a ring, and rank above the hub by their fans
    rows += [(i, i % n + 1) for i in range(1, n + 1)] + [(200_000 + i * 2000 + k, i) for i in range(1, 4) for k in range(1600)]
    edges = spark.createDataFrame(rows, "src long, dst long")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        from pyspark.sql import functions as F
        pairs = _chunks(edges, None, 16).select("x", F.spark_partition_id().alias("p"))
        by = {r.p: r["count"] for r in pairs.groupBy("p").count().collect()}
        assert max(by.values()) <= 0.25 * sum(by.values())
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_building_a_query_starts_no_job_and_keeps_settings(spark, edges):
    from amity import max_friend_age, mutual_friend_profiles, oldest_friend_top, top_mutual_pairs_named
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        profiles = spark.createDataFrame([], "user_id long, first_name string, last_name string, address string, "
                                             "city string, state string, dob_text string, dob date")
        spark.sparkContext.setJobGroup("none", "none")
        for df in (mutual_friends(edges), mutual_friend_counts(edges), top_mutual_pairs(edges), mutual_friend_rows(edges),
                   top_mutual_pairs_named(edges, profiles), mutual_friend_profiles(edges, profiles, 0, 1),
                   max_friend_age(edges, profiles), oldest_friend_top(edges, profiles)):
            assert df.columns
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("none") == []
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.sparkContext._jsc.clearJobGroup()


def test_doubled_profile_and_order(spark, edges):
    from amity import oldest_friend_top, top_mutual_pairs_named
    import datetime as dt
    rows = [(u, f, "L", "A", "C", "S", "1/1/1950", dt.date(1950, 1, 1)) for u in (0, 1, 2, 3) for f in ("Ann", "Zed")]
    profiles = spark.createDataFrame(rows, "user_id long, first_name string, last_name string, address string, "
                                           "city string, state string, dob_text string, dob date")
    got = top_mutual_pairs_named(edges, profiles, 1).collect()
    assert [(r.u, r.v, r.first_u, r.first_v) for r in got] == [(0, 1, "Ann", "Ann")]
    top = [(r.n_mutual, r.u, r.v) for r in top_mutual_pairs_named(edges, profiles, 10).collect()]
    assert top == sorted(top, key=lambda t: (-t[0], t[1], t[2])) and len(top) == 10
    old = [(r.max_friend_age, r.user_id) for r in oldest_friend_top(edges, profiles, "2020-06-15", 5).collect()]
    assert old == sorted(old, key=lambda t: (-t[0], t[1])) and len(old) == 5


def test_raw_edges_with_nulls_and_self_edges(spark):
    raw = spark.createDataFrame([(1, 2), (2, 1), (1, 3), (3, 1), (2, 3), (3, 2), (None, 5), (5, None), (4, 4)],
                                "src long, dst long")
    got = {(r.u, r.v): r.n_mutual for r in mutual_friend_counts(raw).collect()}
    assert got == {(1, 2): 1, (1, 3): 1, (2, 3): 1}


def test_a_meetings_lists_are_intersected_once(spark):
    """Whoever is a corner is on both lists: rows without any are not unfolded,
    and the lists by direction meet what was found."""
    from amity.operators.graph import _corners
    ids = "array<bigint>"
    both = spark.createDataFrame([(1, 2, True, True, [2, 3, 4], None, [3], [3, 4, 5], [4], None), (1, 3, True, True, [2], None, None, [5], None, None)],
                                 "x long, y long, xy boolean, yx boolean, " + ", ".join(f"{k}{e} {ids}" for e in "xy" for k in "nab"))
    assert sorted(tuple(r) for r in _corners(both, counted=False).collect()) == [(1, 2, 4), (1, 3, 2), (1, 4, 2), (2, 3, 1)]
    plan = _corners(both, counted=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_intersect(nx" in plan and "array_intersect(coalesce" not in plan
