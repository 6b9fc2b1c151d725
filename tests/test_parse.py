"""Adjacency-line parsing: every policy case of the friends fixture."""

from amity import parse_friend_lines, read_friends
from amity.operators.graph import friend_pairs


def test_edge_count_and_rejects(spark, friends_path):
    parsed = read_friends(spark, friends_path)
    edges = {(r.src, r.dst) for r in parsed.edges.collect()}
    assert len(edges) == 37
    assert parsed.edges.count() == 37  # distinct already
    rejects = sorted((r.line, r.reason) for r in parsed.rejects.collect())
    assert rejects == [("16\tx", "id"), ("19\t20,,21", "id"), ("24\t25\textra", "arity")]


def test_policies(spark, friends_path):
    edges = {(r.src, r.dst) for r in read_friends(spark, friends_path).edges.collect()}
    srcs = {s for s, _ in edges}
    assert 4 not in srcs                      # user without friends
    assert (15, 15) not in edges and 15 not in srcs   # self friend dropped
    assert {d for s, d in edges if s == 10} == {11}   # repeated id once
    assert {d for s, d in edges if s == 12} == {13, 14}  # lines united
    assert {d for s, d in edges if s == 17} == {18}   # trailing commas
    assert {d for s, d in edges if s == 19} == {20, 21}  # inner empty rejected, rest kept
    assert (22, 23) in edges                  # 022 == 22
    assert {d for s, d in edges if s == 26} == {27}   # trailing tab
    assert 24 not in srcs and 16 not in srcs
    assert (8, 0) in edges and (0, 8) not in edges  # one-sided kept as listed


def test_pairs(spark, friends_path):
    pairs = friend_pairs(read_friends(spark, friends_path).edges)
    got = {(r.u, r.v) for r in pairs.collect()}
    assert len(got) == 21
    assert all(u < v for u, v in got)
    assert (0, 8) in got and (0, 9) in got and (2, 28) in got


def test_blank_and_whitespace_lines(spark):
    lines = spark.createDataFrame([(" ",), ("\t",), ("5\t 6 , 7",), ("x\t",), ("y\t1",)], "value string")
    parsed = parse_friend_lines(lines)
    assert {(r.src, r.dst) for r in parsed.edges.collect()} == {(5, 6), (5, 7)}
    assert [(r.line, r.reason) for r in parsed.rejects.collect()] == [("y\t1", "id")]


def test_rejects_are_linear_in_the_line(spark):
    line = "1\t" + ",".join(f"bad{i}" for i in range(4000)) + ",7"
    parsed = parse_friend_lines(spark.createDataFrame([(line,)], "value string"))
    rejects = parsed.rejects.collect()
    assert len(rejects) == 1 and rejects[0].line == line and len(rejects[0].bad) == 4000
    assert [tuple(r) for r in parsed.edges.collect()] == [(1, 7)]
