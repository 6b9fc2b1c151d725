"""Text sinks in the reference's output layouts.

``style="tsv"``: fields joined by TAB (the MapReduce ``key<TAB>value`` and
the RDD ``a + "\\t" + b`` outputs). ``style="row"``: ``[a,b,c]`` the way a
Spark Row prints (the DataFrame programs' ``rdd.saveAsTextFile``).
Array columns are written as comma lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amity.functions.columns import LIST_SEP, row_text, tsv_text

SINGLE_FILE_ROWS = 100_000  # rows that one task may write as a single file


def _text_columns(df: DataFrame, list_sep: str):
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), list_sep)
        out.append(c)
    return out


def to_text_lines(df: DataFrame, style: str = "tsv", list_sep: str = LIST_SEP,
                  null: str = "null") -> DataFrame:
    """One ``value`` string per row."""
    cols = _text_columns(df, list_sep)
    if style == "tsv":
        return df.select(tsv_text(*cols, null=null).alias("value"))
    if style == "row":
        return df.select(row_text(*cols).alias("value"))
    raise ValueError("style must be 'tsv' or 'row'")


def write_text(df: DataFrame, path: str, style: str = "tsv", single_file: bool = False,
               mode: str = "overwrite", list_sep: str = LIST_SEP, max_rows: int = SINGLE_FILE_ROWS) -> None:
    """Write ``df`` as text lines. ``single_file`` is for final small results
    (a top-k): one task writes them, so more than ``max_rows`` rows are
    refused before anything is written (``write_ordered_text`` takes any
    number)."""
    lines = to_text_lines(df, style, list_sep)
    if single_file:
        if lines.limit(max_rows + 1).count() > max_rows:
            raise ValueError(f"more than {max_rows} rows for a single file; use write_ordered_text")
        lines = lines.coalesce(1)
    lines.write.mode(mode).text(path)


def write_ordered_text(df: DataFrame, path: str, order: list[str | Column], n_files: int, style: str = "tsv",
                       mode: str = "overwrite", list_sep: str = LIST_SEP) -> None:
    """Write ``df`` as text lines in ``order`` without one task for all: up to
    ``n_files`` part files of about equal size, each sorted, whose names follow
    the order, so that the files one after the other are the ordered result."""
    placed = df.repartitionByRange(n_files, *order).sortWithinPartitions(*order)
    to_text_lines(placed, style, list_sep).write.mode(mode).text(path)


def write_edge_table(edges: DataFrame, path: str, n_files: int, mode: str = "error",
                     row_group_bytes: int = 32 << 20) -> None:
    """Write an edge table laid out for lookups by user: range-partitioned
    and sorted on ``(src, dst)``, so each file covers a narrow ``src`` range
    and a pushed-down ``src = a`` filter (E4, any per-user lookup) reads
    only footers elsewhere: row groups whose min/max ``src`` exclude ``a``,
    or whose Bloom filter of ``src`` does, are skipped. Ranging on ``dst`` too
    splits a hub's edges over several files instead of one write task."""
    (edges.select("src", "dst")
     .repartitionByRange(n_files, "src", "dst")
     .sortWithinPartitions("src", "dst")
     .write.mode(mode).option("parquet.bloom.filter.enabled#src", "true").option("parquet.block.size", row_group_bytes)
     .parquet(path))


def save_co_partitioned(edges: DataFrame, profiles: DataFrame, edge_table: str, profile_table: str, buckets: int,
                        path: str | None = None) -> None:
    """Save edges and profiles as tables bucketed by friend (``dst``) and by
    user, so that the join of friends to their profiles shuffles neither
    (``max_friend_age(..., co_partitioned=True)``). ``path``: a folder for
    the two tables, else the warehouse's."""
    for df, key, name in ((edges.select("src", "dst"), "dst", edge_table), (profiles, "user_id", profile_table)):
        # one task a bucket, so one file a bucket
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        (writer if path is None else writer.option("path", f"{path.rstrip('/')}/{name}")).saveAsTable(name)
