"""How the mutual-friend count scales with graph density, and how it
compares with the adjacency-array form (SURVEY §4 "form A": collect each
user's friend list into an array, join both lists to every pair,
``size(array_intersect)``), on the same edges.

    python tools/scale_check.py /root/testdata/sf0.1 3 6 12

Edges: customers of orders 1..reach apart (the stand-in rule with a wider
reach), written once under the checkpoint folder. Form A is here only as a
yardstick; the library does not use it (a hub's whole list in one row).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from amity.operators import graph  # noqa: E402
from amity.plans.standin import StandIn  # noqa: E402
from amity.session import build_session, scratch_path  # noqa: E402


def edges_with_reach(s: StandIn, reach: int):
    near = s._neighbour_orders(list(range(1, reach + 1)))
    pairs = (near.where(F.col("c1") != F.col("c2"))
             .select(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b")).distinct())
    both = F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
                             F.struct(F.col("b").alias("src"), F.col("a").alias("dst"))))
    return pairs.select(both.alias("e")).select("e.src", "e.dst")


def form_a(edges):
    adj = edges.groupBy("src").agg(F.collect_set("dst").alias("l"))
    pairs = graph.friend_pairs(edges)
    a = adj.select(F.col("src").alias("u"), F.col("l").alias("lu"))
    b = adj.select(F.col("src").alias("v"), F.col("l").alias("lv"))
    return (pairs.join(a, "u", "left").join(b, "v", "left")
            .select("u", "v", F.size(F.array_intersect(F.coalesce("lu", F.array()), F.coalesce("lv", F.array())))
                    .cast("bigint").alias("n_mutual")))


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


if __name__ == "__main__":
    sf, reaches = sys.argv[1], [int(r) for r in sys.argv[2:]] or [3]
    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.driver.memory": "16g"})
    s = StandIn(spark, sf)
    out = []
    for reach in reaches:
        edges_with_reach(s, reach).write.parquet(path := scratch_path(spark, f"edges-r{reach}"))
        edges = spark.read.parquet(path)
        n_edges = edges.count()
        rows = graph.mutual_friend_rows(edges).count()
        chunks = min(timed(graph.mutual_friend_counts(edges)) for _ in range(2))
        base = min(timed(form_a(edges)) for _ in range(2))
        same = graph.mutual_friend_counts(edges).exceptAll(form_a(edges)).count() == 0
        out.append({"reach": reach, "directed_edges": n_edges, "mutual_rows": rows,
                    "chunked_out_lists_sec": round(chunks, 2),
                    "full_adjacency_arrays_sec": round(base, 2), "same_counts": same})
        print(json.dumps(out[-1]), flush=True)
    spark.stop()
