"""Exact top-k search against brute force."""

import math
import os
import random

import pytest

from amity.llm import topk as T

KIND = "vec_id bigint, embedding array<double>, QUERY_ID string, rank int"


def brute(rows, k, scale=64.0):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    queries = {}
    for i, v, *_ in rows:
        if i is not None and i % 20 == 0 and any(i == a for a, _ in ok):
            if v is not None and all(x is not None and math.isfinite(x) for x in v):
                queries[i] = min(queries.get(i, v), v)
    for i, v in queries.items():
        q = [math.floor(scale * x) for x in v]
        scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in ok if j != i and len(c) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def vectors(size):
    rnd = random.Random(size)
    rows = [(i, [rnd.choice([-.5, -.1, 0., .3, .9]) * size for _ in range(4)], "x", 1) for i in range(300)]
    rows += [(1000 + i, [.3, .3, .3, .3], "x", 1) for i in range(60)]
    rows += [(None, [1., 1., 1., 1.], "x", 1), (2000, None, "x", 1), (2001, [1., None, 1., 1.], "x", 1),
             (2020, [float("nan")] * 4, "x", 1), (2040, [float("inf")] * 4, "x", 1), (2060, [1.] * 3, "x", 1),
             (2080, [], "x", 1), (20, [.9] * 4, "x", 1), (21, [.9] * 4, "x", 1), (21, [.9] * 4, "x", 1)]
    return rows


@pytest.mark.parametrize("size,k,cells", [(1.0, 20, (8192, 32768)), (1.0, 7, (20, 5)), (1e7, 20, (50, 32768)), (1.0, 1000, (64, 4))])
def test_equals_brute_force(spark, size, k, cells):
    rows = vectors(size)
    df = spark.createDataFrame(rows, KIND).repartition(4)
    got = T.top_k(df, df.where("vec_id % 20 = 0"), k, cell_candidates=cells[0], cell_queries=cells[1], fan=3)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, k)


def test_empty(spark):
    df = spark.createDataFrame([], KIND)
    assert T.top_k(df, df).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.001/embeddings.parquet')")
    want = sorted(con.execute(T.OP3_SQL).fetchall())
    assert sorted(map(tuple, T.op3_topk(spark, "/root/testdata/sf0.001").collect())) == want
