"""Connected components of a large edge table, as Spark joins.

Alternating large-star / small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond"): each step hangs every node's neighbours
on the smallest id it knows, until the table is a set of stars. Every step's
tables are written to the shared folder, so the lineage stays short, a lost
executor costs one step, and both sides of each join are plain scans whose
skewed partitions adaptive execution can split (a hub is one key with many
rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amity.llm.tables import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).head()
    return tuple(row)


def components(edges: DataFrame, a: str = "a", b: str = "b", together: int = 0) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (two bigint columns):
    ``root`` is the smallest node of its component. Self edges and repeated
    edges are allowed; edges with a NULL end are ignored; no edges, no rows.
    A table of up to ``together`` edges is one task's work in each step."""
    hi, lo = F.greatest(a, b), F.least(a, b)
    e = written(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                .select(hi.alias("u"), lo.alias("v")).distinct(), "edges")
    state = _state(e)
    while state[0]:
        e = e.coalesce(1) if state[0] <= together else e
        both = F.explode(F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
        sym = e.select(both.alias("e")).select("e.u", "e.v")
        least = written(sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        least = least.coalesce(1) if state[0] <= together else least
        large = written(sym.where("v > u").join(least, "u").where("v != m")
                        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        large = large.coalesce(1) if state[0] <= together else large
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        least = least.coalesce(1) if state[0] <= together else least
        moved = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state, before = _state(e), state
        if state == before:
            break
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
