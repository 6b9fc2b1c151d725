"""Mutual-friend counts on the stand-in graph plus a few hub users (the
customers with keys 0 .. n-1) who are friends with every customer (a
tool-only experiment, not a registered query): shows how the three forms
react to hubs.

    python tools/hub_check.py /root/testdata/sf0.1 5 [timeout_sec] [--as-if-big]
"""

from __future__ import annotations

import json
import os
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from amity.operators import graph  # noqa: E402
from amity.plans.standin import StandIn  # noqa: E402
from amity.session import build_session, scratch_path  # noqa: E402

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from scale_check import form_a  # noqa: E402


def run_with_timeout(spark, df, limit: float):
    group = f"hub-check-{time.time()}"
    done = {}

    def go():
        spark.sparkContext.setJobGroup(group, group, interruptOnCancel=True)
        t0 = time.perf_counter()
        try:
            df.write.format("noop").mode("overwrite").save()
            done["t"] = time.perf_counter() - t0
        except Exception:
            done["t"] = None

    th = threading.Thread(target=go)
    th.start()
    th.join(limit)
    if th.is_alive():
        spark.sparkContext.cancelJobGroup(group)
        th.join()
        return f">{limit:.0f}"
    return round(done["t"], 2) if done.get("t") is not None else "failed"


if __name__ == "__main__":
    sf, n_hubs = sys.argv[1], int(sys.argv[2])
    limit = float(sys.argv[3]) if len(sys.argv) > 3 else 300
    as_if_big = "--as-if-big" in sys.argv   # no size-based broadcasts: the plan large inputs get
    extra = {"spark.driver.memory": "16g"}
    if as_if_big:
        extra.update({"spark.sql.autoBroadcastJoinThreshold": "-1",
                      "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark = build_session("local[8]", shuffle_partitions=16, extra=extra)
    s = StandIn(spark, sf)
    users = s.table("customer").select(F.col("c_custkey").alias("c"))
    # hubs: customers 0 .. n_hubs-1; each befriends every other customer (both
    # directions) -- one exploded row per (customer, hub), no join
    hub_ids = F.sequence(F.lit(0).cast("bigint"), F.lit(n_hubs - 1).cast("bigint"))
    hub_edges = (users.where(F.lit(n_hubs) > 0).select("c", F.explode(hub_ids).alias("h"))
                 .where(F.col("h") != F.col("c"))
                 .select(F.explode(F.array(F.struct(F.col("h").alias("src"), F.col("c").alias("dst")),
                                           F.struct(F.col("c").alias("src"), F.col("h").alias("dst")))).alias("e"))
                 .select("e.src", "e.dst"))
    s.edges().unionByName(hub_edges).distinct().write.parquet(path := scratch_path(spark, "hub-edges"))
    edges = spark.read.parquet(path)
    res = {"hubs": n_hubs, "as_if_big": as_if_big, "directed_edges": edges.count()}
    res["chunked_out_lists_sec"] = run_with_timeout(spark, graph.mutual_friend_counts(edges), limit)
    res["full_adjacency_arrays_sec"] = run_with_timeout(spark, form_a(edges), limit)
    print(json.dumps(res))
    spark.stop()
