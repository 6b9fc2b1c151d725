"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows get global numbers 0 .. n-1 in key order: a range shuffle sorts them, each
task numbers its own rows, and a table with one count per task turns that into
global numbers. A Feistel network permutes [0, 4**k) >= n, and walking its
cycle until the value is below n permutes [0, n). Permuted number p is shard
``p % shards``, slot ``p // shards``: shard sizes differ by one row at most,
slots have no gap, and either direction is arithmetic (``place``, ``row_of``)
that needs no look-up table and no shuffle.

Rows that are equal in every key column are interchangeable; a salt from their
place in the input parts a hot key over several ranges. Defined results: NULL
keys come first; a NULL text counts as empty; repeated rows get a number each;
an empty table gives no rows. Under law ``rows`` the groups of equal texts are
not kept together.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, free_name, read_table, written

SHARDS, SEED, ROUNDS, OVERHEAD = 40, 2024, 6, 16
PER_TASK = (1 << 33) - 1  # the low bits of monotonically_increasing_id


class Feistel:
    """A permutation of [0, n) and its inverse, on numpy arrays."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS) -> None:
        self.n = n
        self.half = np.uint64(max(1, math.ceil(math.log2(max(n, 2)) / 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{seed}/{k}".encode()).digest()[:8], "big"))
                     for k in range(rounds)]

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        if back:
            for key in reversed(self.keys):
                left, right = right ^ self._round(left, key), left
        else:
            for key in self.keys:
                left, right = right, left ^ self._round(right, key)
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(x, np.uint64), back)
        while (out := x >= self.n).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def forward(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, False)

    def backward(self, permuted: np.ndarray) -> np.ndarray:
        return self._walk(permuted, True)


def place(row: int, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[int, int]:
    """(shard, slot) of global row number ``row`` among ``n``."""
    p = int(Feistel(n, seed).forward(np.array([row]))[0])
    return p % shards, p // shards


def row_of(shard: int, slot: int, n: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The global row number at (shard, slot)."""
    return int(Feistel(n, seed).backward(np.array([slot * shards + shard]))[0])


def number_rows(df: DataFrame, by: list[str], into: str = "row_number") -> DataFrame:
    """``df`` (written once, sorted) plus global row numbers from 0 in the
    order of ``by``; ties in any order."""
    salt, task, own = (free_name(df, c) for c in ("_s_salt", "_s_task", "_s_own"))
    keys = [F.col(col_ref(c)) for c in by]
    ranged = (df.withColumn(salt, F.monotonically_increasing_id())
              .repartitionByRange(*keys, F.col(salt)).sortWithinPartitions(*keys, salt))
    rows = written(ranged.select(*[F.col(col_ref(c)) for c in df.columns], F.spark_partition_id().alias(task),
                                 F.monotonically_increasing_id().bitwiseAND(F.lit(PER_TASK)).alias(own)), "numbered")
    # one row a task: far below any broadcast bound, and one task can sum it
    before = Window.orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(task).agg(F.count(F.lit(1)).alias("c"))
    start = counts.select(task, F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_s_start"))
    return rows.join(F.broadcast(start), task).select(
        *[F.col(col_ref(c)) for c in df.columns], (F.col("_s_start") + F.col(own)).alias(into))


def shard_rows(df: DataFrame, by: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` plus ``shard`` and ``slot``."""
    row = free_name(df, "_s_row")
    numbered = number_rows(df, by, row)
    network = Feistel(numbered.count(), seed)

    @F.pandas_udf("bigint")
    def permuted(rows: pd.Series) -> pd.Series:
        return pd.Series(network.forward(rows.to_numpy()))

    p = free_name(numbered, "_s_permuted")
    kept = [F.col(col_ref(c)) for c in df.columns if c.lower() not in ("shard", "slot")]
    return numbered.withColumn(p, permuted(F.col(row))).select(
        *kept, (F.col(p) % shards).cast("int").alias("shard"), F.floor(F.col(p) / shards).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, by: list[str], shards: int = SHARDS, seed: int = SEED,
                 rows_per_file: int = 1_000_000) -> None:
    """Folders ``shard=N`` of Parquet files, each a run of slots in order."""
    placed = shard_rows(df, by, shards, seed)
    run = F.floor(F.col("slot") / rows_per_file)
    (placed.repartition(F.col("shard"), run).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def text_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + OVERHEAD).cast("long")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under law ``rows``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", text_size(text).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shard_rows(docs, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op8_sharding": op8_sharding}
SQL: dict[str, str] = {}
