"""Sharding: the permutation, its inverse, and the law ``rows``."""

import zlib
from collections import Counter

import numpy as np
import pytest

from amity.llm import sharding as S


@pytest.mark.parametrize("n", [1, 2, 3, 40, 41, 1000, 4097])
def test_permutation(n):
    f = S.Feistel(n)
    p = f.forward(np.arange(n))
    assert sorted(p.tolist()) == list(range(n))
    assert f.backward(p).tolist() == list(range(n))
    assert n < 1000 or (p[1:] - p[:-1] == 1).mean() < 0.02
    assert all(S.row_of(*S.place(r, n), n) == r for r in range(0, n, max(1, n // 7)))


ROWS = [(i // 2 if i % 3 else None, "t" * (i % 17) if i % 5 else None, "x", i) for i in range(500)] + [(7, "hot", "x", 7)] * 400


def test_rows_law(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string, SHARD string, _s_row int").repartition(5)
    got = S.shard_rows(df, ["doc_id", "text"], 7).collect()
    assert len(got) == len(ROWS)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # the row number behind (shard, slot) follows the key order
    order = sorted(((S.row_of(r.shard, r.slot, len(ROWS), 7), r.doc_id, r.text) for r in got), key=lambda x: x[0])
    keys = [((d is not None, d or 0), (t is not None, t or "")) for _, d, t in order]
    assert keys == sorted(keys)


def test_same_shuffle_for_any_partitioning(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(800)], "doc_id bigint, text string")
    a, b = (sorted(map(tuple, S.shard_rows(df.repartition(k), ["doc_id"]).collect())) for k in (2, 9))
    assert a == b


def test_query(spark, tmp_path):
    rows = [(i, f"é{i % 3}" if i else None) for i in range(95)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in S.op8_sharding(spark, str(tmp_path)).collect()}
    for i, t in rows:
        b = (t or "").encode()
        assert (got[i].size, got[i].text_crc32, got[i].law, got[i].grown_shard) == (len(b) + 16, zlib.crc32(b), "rows", None)
    assert sorted(Counter(r.shard for r in got.values()).values()) == [2] * 25 + [3] * 15
    assert S.shard_rows(spark.createDataFrame([], "doc_id bigint, text string"), ["doc_id"]).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id bigint, text string")
    S.write_shards(df, str(tmp_path / "out"), ["doc_id"], 4, rows_per_file=50)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(300))
    assert {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
