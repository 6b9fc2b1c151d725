"""Temperature mixing: exponent, quotas and the realised mix."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from amity.llm import mixing as M

KIND = "doc_id bigint, text string, source string, Weight string, cut int"


def test_alpha():
    t = [1000, 100, 10, 0]
    own, top = M.entropy(M.weights(t, 1.0)), math.log(3)
    a = M.find_alpha(t, own + 0.5 * (top - own), None)
    assert math.isclose(M.entropy(M.weights(t, a)), own + 0.5 * (top - own), rel_tol=1e-9)
    assert M.find_alpha(t, 99.0, None) == 0.0 and math.isclose(M.find_alpha(t, 0.0, None), 1.0)
    a = M.find_alpha(t, 99.0, 3.0)
    assert math.isclose(100 ** (1 - a), 3.0, rel_tol=1e-9)
    assert M.find_alpha([5]) == 1.0 and M.find_alpha([]) == 1.0


def documents():
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randint(1, 80), rnd.choice(["hot"] * 6 + ["a", "b", None]), "x", 1) for i in range(900)]
    return rows + [(5000, None, "a", "x", 1), (5001, "", "b", "x", 1), (None, "no id here", "a", "x", 1), (5002, " \n ", "wordless", "x", 1),
                   (5003, "long " * 20000, "hot", "x", 1), (5004, "same row", "b", "x", 1), (5004, "same row", "b", "x", 1)]


@pytest.mark.parametrize("budget,block", [(None, 4096), (None, 16), (9000, 16), (200000, 64)])
def test_mix(spark, budget, block):
    rows = documents()
    df = spark.createDataFrame(rows, KIND).repartition(4)
    out = M.mix_sources(df, target_entropy=1.2, max_epochs=4.0, budget=budget, block_rows=block)
    got = out.collect()
    assert len(got) == len(rows) and set(out.columns) == {"doc_id", "text", "source", "cut", "tokens", "weight", "copies", "block", "place"}
    total = {s: sum(len((t or "").split()) for _, t, x, *_ in rows if x == s) for s in {r[2] for r in rows}}
    names = sorted(total, key=lambda s: (s is None, s or ""))
    alpha = M.find_alpha([total[s] for s in names], 1.2, 4.0)
    weight, quota = M.quotas([total[s] for s in names], alpha, budget)
    for s, w, q in zip(names, weight, quota):
        own = [r for r in got if r.source == s]
        taken = sum(r.tokens * r.copies for r in own)
        assert all(math.isclose(r.weight, w) for r in own)
        if total[s]:
            whole = q // total[s]
            assert {r.copies for r in own} <= {whole, whole + 1} and taken <= q
            # the partial epoch is a beginning of the permutation, as long as it fits
            order = sorted({(r.place, str(r.doc_id or ""), r.tokens): r.copies > whole for r in own}.items())
            flags = [f for _, f in order]
            assert flags == sorted(flags, reverse=True)
            if False in flags and q % total[s]:
                first = order[flags.index(False)][0]
                more = sum(r.tokens for r in own if (r.place, str(r.doc_id or ""), r.tokens) == first)
                assert taken + more > q
        if budget is None:
            assert all(r.copies >= 1 for r in own)


@pytest.mark.parametrize("budget", [None, 9000])
def test_more_sources_than_the_driver_plans(spark, monkeypatch, budget):
    df = spark.createDataFrame(documents(), KIND).repartition(4)

    def mixed(**options):
        out = M.mix_sources(df, budget=budget, block_rows=16, **options).collect()
        return sorted((str(r.doc_id), str(r.source), r.tokens, round(r.weight, 9), r.copies, r.block) for r in out)

    options = [{}, {"target_entropy": 1.2, "max_epochs": 4.0}, {"target_entropy": 99.0, "max_epochs": None}, {"target_entropy": 0.0}]
    want = [mixed(**o) for o in options]
    monkeypatch.setattr(M, "MAX_SOURCES", 2)
    assert [mixed(**o) for o in options] == want
    assert M.mix_sources(df.where("source = 'a'")).count() > 0


def test_very_many_sources(spark):
    n = M.MAX_SOURCES + 20_000
    df = spark.range(2 * n).selectExpr("id AS doc_id", "repeat('w ', CAST(1 + id % 5 AS INT)) AS text", f"concat('host', id % {n}) AS source")
    out = M.mix_sources(df).agg(F.count("*").alias("n"), F.min("copies").alias("least"), F.max("copies").alias("most")).head()
    assert out.n == 2 * n and out.least >= 1 and out.most <= 3


def test_stage_and_empty(spark):
    df = spark.createDataFrame(documents(), KIND)
    out = M.stage_mixing(spark, df, "")
    assert out.columns == df.columns
    assert out.count() == M.mix_sources(df).agg(F.sum("copies")).head()[0]
    assert M.mix_sources(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver test data not present")
def test_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    cur = con.execute(M.OP9_SQL)
    names = [c[0] for c in cur.description]
    want = sorted(cur.fetchall())
    assert sorted(map(tuple, M.op9_mixing(spark, "/root/testdata/sf0.01").select(*names).collect())) == want
