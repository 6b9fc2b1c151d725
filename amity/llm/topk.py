"""Exact top-k search by inner product: tiles, partial selection, tree merge.

The product of queries and candidates is cut into a grid of cells: candidates
are dealt to columns by their place in the input, queries to rows of the grid
by a hash, both in pieces of bounded size. A query goes to every column and a
candidate to every grid row, so a cell holds bounded pieces of both and each
(query, candidate) pair meets in one cell. A task multiplies its cell tile by
tile (a matrix product each), keeps per query the k best of the cell by
partial selection, and returns those lists only. Lists of ``fan`` columns at a
time then merge, level by level, into one list a query.

Components become floor(scale * x) as doubles; a product is computed in
doubles where every partial sum is provably exact, else in Python integers; a
score that no long can hold stops the query rather than wrap.

Defined results: rows with a NULL vec_id, a NULL vector or one holding NULL or
a non-finite component take no part; vectors of different lengths do not meet;
a row is no candidate of its own vec_id, also where the id is repeated;
repeated candidate rows each take a rank; a repeated query id is one query
(its smallest vector); equal scores go by vec_id; with fewer than k candidates
all are returned, with none no row; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, read_table

K, SCALE, EVERY = 20, 64.0, 20  # fixed values of the contract
CELL_CANDIDATES, CELL_QUERIES, TILE_QUERIES, FAN = 8192, 32768, 256, 16
EXACT = float(1 << 53)
LISTS = "query_id bigint, col bigint, top array<struct<neg:bigint,vec_id:bigint>>"


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _matrices(t: pa.Table, key: str, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: (ids, scaled rows), rows in id order."""
    vectors, ids = t["vector"].combine_chunks(), t[key].to_numpy()
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False) if len(ids) else np.zeros(0, np.int64)
    out = {}
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        at = at[np.argsort(ids[at], kind="stable")]
        flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        out[int(n)] = ids[at], np.floor(scale * flat.reshape(len(at), n))
    return out


def _best(scores: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row of ``scores``, the k best (score, id); ``ids`` ascends, so
    among equal scores the earlier column is the better one. ``own[i]`` is the
    id row i must leave out."""
    n, out = len(ids), []
    lo, hi = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
    if scores.dtype != object and n and (np.abs(scores).max(initial=0) + 1) * n < EXACT:
        ranked = scores * n + np.arange(n - 1, -1, -1.0)  # one number orders by score, then by place
        for row, a, b in zip(ranked, lo, hi, strict=True):
            row[a:b] = -np.inf
        k2 = min(k, n)
        at = np.argpartition(ranked, n - k2, axis=1)[:, n - k2:]
        best = np.take_along_axis(ranked, at, 1)
        for i in range(len(at)):
            order = at[i][np.argsort(-best[i])]
            order = order[(order < lo[i]) | (order >= hi[i])]
            out.append((scores[i, order], ids[order]))
        return out
    for i in range(len(scores)):
        free = [j for j in range(n) if not lo[i] <= j < hi[i]]
        order = sorted(free, key=lambda j: (-scores[i, j], j))[:k]
        out.append((scores[i, order], ids[order]))
    return out


def cell_lists(queries: pa.Table, candidates: pa.Table, k: int, scale: float) -> dict[int, list[tuple[int, int]]]:
    """query id -> its best (-score, vec_id) in the cell, the best first."""
    lists: dict[int, list[tuple[int, int]]] = {}
    found = _matrices(candidates, "vec_id", scale)
    for n, (qids, q) in _matrices(queries, "query_id", scale).items():
        if n not in found:
            continue
        ids, c = found[n]
        exact = n * np.abs(q).max(initial=0) * np.abs(c).max(initial=0) < EXACT
        if not exact:
            q, c = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (q, c))
        for s in range(0, len(qids), TILE_QUERIES):
            part = qids[s:s + TILE_QUERIES]
            for qid, (score, vec) in zip(part, _best(q[s:s + TILE_QUERIES] @ c.T, part, ids, k), strict=True):
                lists[int(qid)] = [(-int(x), int(v)) for x, v in zip(score, vec, strict=True)]
    return lists


def top_k(candidates: DataFrame, queries: DataFrame, k: int = K, scale: float = SCALE, vec_id: str = "vec_id",
          vector: str = "embedding", cell_candidates: int = CELL_CANDIDATES, cell_queries: int = CELL_QUERIES,
          fan: int = FAN) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row of ``queries`` the
    ``k`` rows of ``candidates`` with the highest scores."""
    def part(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.col(col_ref(vec_id)).isNotNull() & usable(F.col(col_ref(vector)))).select(
            F.col(col_ref(vec_id)).cast("bigint").alias(key), F.col(col_ref(vector)).cast("array<double>").alias("vector"))

    c = part(candidates, "vec_id")
    q = part(queries, "query_id").groupBy("query_id").agg(F.min("vector").alias("vector"))
    n_cols = max(1, -(-c.count() // cell_candidates))
    n_rows = max(1, -(-q.count() // cell_queries))
    c = c.withColumn("col", F.pmod(F.monotonically_increasing_id(), F.lit(n_cols))) \
        .withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    q = q.withColumn("row", F.pmod(F.xxhash64("query_id"), F.lit(n_rows)).cast("int")) \
        .withColumn("col", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_cols - 1).cast("bigint"))))

    def cell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        lists = cell_lists(left, right, k, scale)
        kind = pa.list_(pa.struct([("neg", pa.int64()), ("vec_id", pa.int64())]))
        tops = [[{"neg": s, "vec_id": v} for s, v in top] for top in lists.values()]
        return pa.table({"query_id": pa.array(list(lists), pa.int64()), "col": pa.array([key[0].as_py()] * len(lists), pa.int64()),
                         "top": pa.array(tops, kind)})

    lists = q.groupBy("col", "row").cogroup(c.groupBy("col", "row")).applyInArrow(cell, LISTS)
    while n_cols > 1:  # at most fan lists of k entries meet in one row
        n_cols = -(-n_cols // fan)
        lists = lists.groupBy("query_id", F.floor(F.col("col") / fan).alias("col")).agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("top"))), 1, k).alias("top"))
    return lists.select("query_id", F.posexplode("top").alias("pos", "best")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), "best.vec_id", (-F.col("best.neg")).alias("score"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    rows = read_table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % EVERY == 0))


OP3_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""

QUERIES = {"op3_topk": op3_topk}
SQL = {"op3_topk": OP3_SQL}
