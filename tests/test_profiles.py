"""Profile joins: ages, oldest friend, named top pairs, one pair's mutual friends."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from amity import (age_years, max_friend_age, mutual_friend_profiles, oldest_friend_top, read_friends,
                   read_profiles, top_mutual_pairs_named)

AS_OF = "2020-06-15"


@pytest.fixture
def edges(spark, friends_path):
    return read_friends(spark, friends_path).edges


@pytest.fixture
def profiles(spark, profiles_path):
    return read_profiles(spark, profiles_path).rows


def test_profile_parse(profiles):
    rows = {r.user_id: r for r in profiles.collect()}
    assert set(rows) == {0, 1, 2, 3, 6, 7, 10}
    assert rows[10].first_name == '"Fay' and rows[10].dob == dt.date(1960, 2, 29)  # quotes are text
    assert rows[6].dob is None and rows[6].dob_text == "bad"
    assert rows[2].city == "Cary" and rows[2].state == "North Carolina"


def test_ages(profiles):
    got = {r.user_id: r.age for r in profiles.select("user_id", age_years("dob", AS_OF).alias("age")).collect()}
    assert got == {0: 30, 1: 40, 2: 29, 3: 29, 6: None, 7: 69, 10: 60}


def test_age_edge_cases(spark):
    df = spark.createDataFrame([(dt.date(2000, 2, 29), dt.date(2021, 2, 28)),
                                (dt.date(2000, 2, 29), dt.date(2021, 3, 1)),
                                (dt.date(1990, 12, 31), dt.date(2020, 12, 30)),
                                (dt.date(1990, 12, 31), dt.date(2020, 12, 31))], "dob date, at date")
    got = [r.a for r in df.select(age_years("dob", F.col("at")).alias("a")).collect()]
    assert got == [20, 21, 29, 30]


def test_max_friend_age(edges, profiles):
    got = {r.user_id: r.max_friend_age for r in max_friend_age(edges, profiles, AS_OF).collect()}
    assert len(got) == 24
    assert sum(v is None for v in got.values()) == 14
    assert got[0] == 40 and got[6] == 69 and got[11] == 60 and got[28] == 29 and got[7] is None


def test_max_friend_age_salted(edges, profiles):
    plain = sorted(tuple(r) for r in max_friend_age(edges, profiles, AS_OF).collect())
    salted = sorted(tuple(r) for r in max_friend_age(edges, profiles, AS_OF, floor_rows=1).collect())
    assert salted == plain


def test_oldest_friend_top(edges, profiles):
    rows = [tuple(r) for r in oldest_friend_top(edges, profiles, AS_OF, 10).collect()]
    got = sorted(((r[0], r[4]) for r in rows), key=lambda t: (-t[1], t[0]))
    assert got == [(6, 69), (11, 60), (0, 40), (2, 40), (3, 40), (9, 40), (1, 30), (8, 30), (28, 29), (29, 29)]
    addr = {r[0]: r[1:4] for r in rows}
    assert addr[6] == ("6 F St", "Flint", "Michigan")  # the user's own address
    assert all(addr[u] == (None, None, None) for u in (11, 9, 8, 28, 29))


def test_top_pairs_named(edges, profiles):
    rows = [tuple(r) for r in top_mutual_pairs_named(edges, profiles, 1).collect()]
    assert rows == [(2, 0, 1, "Ann", "Ash", "1 A St", "Bob", "Birch", "2 B St")]
    rows = {(r.u, r.v): r for r in top_mutual_pairs_named(edges, profiles, 10).collect()}
    assert rows[(0, 9)].first_u == "Ann" and rows[(0, 9)].first_v is None


def test_mutual_friend_profiles(edges, profiles):
    for a, b in ((1, 0), (0, 1)):
        rows = sorted(tuple(r) for r in mutual_friend_profiles(edges, profiles, a, b).collect())
        assert rows == [(0, 1, 2, "Cy", "12/31/1990"), (0, 1, 3, "Cy", "12/31/1990")]
    assert mutual_friend_profiles(edges, profiles, 6, 7).count() == 0
    assert mutual_friend_profiles(edges, profiles, 28, 29).count() == 0   # matched by id, not name
    assert mutual_friend_profiles(edges, profiles, 2, 3).count() == 0     # not friends


def test_first_profile_wins(spark, tmp_path):
    from tests.conftest import PROFILE_LINES, write_lines
    p = write_lines(tmp_path, "u2.txt", PROFILE_LINES + ["0,Zed,Zoo,9 Z St,Zion,Utah,x,x,x,1/1/1970"])
    rows = [r for r in read_profiles(spark, p).rows.collect() if r.user_id == 0]
    assert len(rows) == 1 and rows[0].first_name == "Ann"


def test_profiles_from_a_folder(spark, tmp_path):
    from tests.conftest import PROFILE_LINES
    d = tmp_path / "userdata"
    d.mkdir()
    (d / "part-a.txt").write_text("\n".join(PROFILE_LINES[:3]) + "\n")
    (d / "part-b.txt").write_text("\n".join(PROFILE_LINES[3:]) + "\n")
    assert sorted(r.user_id for r in read_profiles(spark, str(d)).rows.collect()) == [0, 1, 2, 3, 6, 7, 10]


def test_profile_rejects(spark, tmp_path):
    from tests.conftest import PROFILE_LINES, write_lines
    bad = ["8,Short,Line", "x9,Bad,Id,1 A St,Akron,Ohio,x,x,x,1/1/1990", "", ",No,Id,a,b,c,d,e,f,1/1/1990"]
    parsed = read_profiles(spark, write_lines(tmp_path, "u.txt", PROFILE_LINES + bad))
    assert parsed.rows.count() == 7
    got = sorted((r.line, r.reason, r.bad) for r in parsed.rejects.collect())
    assert got == sorted([(bad[0], "arity", []), (bad[1], "id", ["x9"]), (bad[3], "id", [""])])


def test_oldest_friend_early_on_fixture(edges, profiles):
    for k in (1, 2, 3, 6, 10, 30):
        assert oldest_friend_top(edges, profiles, AS_OF, k, early=True).collect() == oldest_friend_top(edges, profiles, AS_OF, k).collect()


@pytest.mark.parametrize("seed,span", [(1, 3), (2, 40), (3, 400)])
def test_oldest_friend_early_on_random_graphs(spark, seed, span):
    import random
    rnd = random.Random(seed)
    # few ages, many ages, hardly two alike; users without profile or birth date; a user with two
    edge_set = {(rnd.randrange(90), rnd.randrange(90)) for _ in range(400)} | {(k, 5) for k in range(20, 80, 3)}
    edges = spark.createDataFrame(sorted((s, d) for s, d in edge_set if s != d), "src long, dst long")
    rows = [(k, None if k % 9 == 0 else dt.date(1900 + rnd.randrange(span) % 110, 1, 1), "a", "c", "s") for k in range(0, 90) if k % 7]
    rows.append((8, dt.date(1890, 1, 1), "b", "c", "s"))
    profiles = spark.createDataFrame(rows, "user_id long, dob date, address string, city string, state string")
    for k in (1, 3, 10, 60, 200):
        assert oldest_friend_top(edges, profiles, AS_OF, k, early=True).collect() == oldest_friend_top(edges, profiles, AS_OF, k).collect()


def test_early_end_joins_few_profiles(spark):
    from amity.operators.graph import _oldest
    edges = spark.range(3000).selectExpr("id AS src", "explode(array((id + 1) % 3000, (id + 7) % 3000, id % 40)) AS dst").where("src != dst")
    profiles = spark.range(3000).selectExpr("id AS user_id", "date_add(DATE'1900-01-01', CAST(id * 10 AS INT)) AS dob")
    got = _oldest(edges, profiles, AS_OF, 10).collect()
    assert 10 <= len(got) < 200  # users reached, of 3,000
    top = sorted(((-r.max_friend_age, r.user_id) for r in got))[:10]
    full = sorted(((-r.max_friend_age, r.user_id) for r in max_friend_age(edges, profiles, AS_OF).collect()))[:10]
    assert top == full


def test_any_k(spark, edges, profiles, monkeypatch):
    from amity.operators import graph
    want = [top_mutual_pairs_named(edges, profiles, 10).collect(), oldest_friend_top(edges, profiles, AS_OF, 10).collect()]
    monkeypatch.setattr(graph, "MAX_TOP_K", 3)  # beyond it nothing is broadcast, and nothing refused
    assert [top_mutual_pairs_named(edges, profiles, 10).collect(), oldest_friend_top(edges, profiles, AS_OF, 10).collect()] == want
    with pytest.raises(ValueError):
        oldest_friend_top(edges, profiles, AS_OF, -1)
