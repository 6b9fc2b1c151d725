"""Registered queries: each reference question run on the stand-in tables.

Every entry is ``(spark, sf_dir) -> DataFrame`` over whole tables. Array
columns are rendered as text and averages rounded to 6 places so that the
result compares value-for-value with the DuckDB twin in
``amity.plans.oracle``. ``*_from_files`` and ``rejects_*`` first write the
stand-in rows as text files in the reference's input formats, under the
session's shared folder, and read them back through the library's text
readers. ``*_directed`` run on the harder stand-in graph, ``lines_*`` render
the reference's output lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amity.operators import graph, ratings
from amity.operators.friend_index import FriendIndex, write_friend_index
from amity.session import scratch_path
from amity.sources import layouts
from amity.sources.sinks import save_co_partitioned, write_edge_table, write_ordered_text, write_text
from amity.sources.text import read_business, read_friends, read_profiles, read_reviews
from amity.plans.oracle import oracle_queries
from amity.plans.standin import AS_OF, NEEDLE, TOP_K, StandIn

# Fixed values (E4 takes one pair as its argument): pairs befriended and with
# shared friends in the stand-ins at sf0.01 and at sf0.1.
PROFILE_PAIR = (124, 1488)
DIRECTED_PAIR = (1, 6)

Query = Callable[[SparkSession, str], DataFrame]


def _e7_text(df: DataFrame) -> DataFrame:
    cats = F.when(F.size("categories") > 0, F.array_join("categories", "|"))
    return df.select("business_id", cats.alias("categories"), "full_address",
                     F.round("avg_stars", 6).alias("avg_stars"))


def q_friend_edges(spark: SparkSession, sf: str) -> DataFrame:
    return StandIn(spark, sf).parsed_edges()


def q_friend_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return graph.friend_pairs(StandIn(spark, sf).edges())


def q_mutual_friends(spark: SparkSession, sf: str) -> DataFrame:
    return graph.mutual_friends(StandIn(spark, sf).edges())


def q_mutual_friend_counts(spark: SparkSession, sf: str) -> DataFrame:
    return graph.mutual_friend_counts(StandIn(spark, sf).edges())


def q_top_mutual_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return graph.top_mutual_pairs(StandIn(spark, sf).edges(), TOP_K)


def q_top_mutual_pairs_named(spark: SparkSession, sf: str) -> DataFrame:
    """The k pairs are written first, since naming them reads them twice."""
    s = StandIn(spark, sf)
    graph.top_mutual_pairs(s.edges(), TOP_K).write.parquet(path := scratch_path(spark, "top-pairs"))
    return graph.top_mutual_pairs_named(s.edges(), s.profiles(), TOP_K, top=spark.read.parquet(path))


def q_mutual_friend_profiles(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return graph.mutual_friend_profiles(s.edges(), s.profiles(), *PROFILE_PAIR)


def q_max_friend_age(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return graph.max_friend_age(s.edges(), s.profiles(), AS_OF)


def q_oldest_friend_top(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return graph.oldest_friend_top(s.edges(), s.profiles(), AS_OF, TOP_K)


def q_ratings_by_address(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return ratings.ratings_by_address(s.business(), s.reviews(), NEEDLE)


def q_top_rated_businesses(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return _e7_text(ratings.top_rated_businesses(s.business(), s.reviews(), TOP_K))


def q_top_rated_businesses_sql(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return _e7_text(ratings.top_rated_businesses_sql(spark, s.business(), s.reviews(), TOP_K))


def q_friend_edges_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """O1/O2 end to end: adjacency text files -> ``read_friends``."""
    s = StandIn(spark, sf)
    return read_friends(spark, s.text_files("friends")).edges


def q_oldest_friend_top_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """E5 with profiles read from comma text files (``read_profiles``)."""
    s = StandIn(spark, sf)
    profiles = read_profiles(spark, s.text_files("userdata")).rows
    return graph.oldest_friend_top(s.edges(), profiles, AS_OF, TOP_K)


def q_ratings_by_address_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """E6 with business and reviews read from ``::`` text files."""
    s = StandIn(spark, sf)
    return ratings.ratings_by_address(read_business(spark, s.text_files("business")).rows,
                                      read_reviews(spark, s.text_files("reviews")).rows, NEEDLE)


def q_top_rated_businesses_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """E7 (SQL form) with business and reviews read from ``::`` text files."""
    s = StandIn(spark, sf)
    return _e7_text(ratings.top_rated_businesses_sql(
        spark, read_business(spark, s.text_files("business")).rows,
        read_reviews(spark, s.text_files("reviews")).rows, TOP_K))


# ------------------------------------------- the directed, uneven stand-in

def q_mutual_friends_directed(spark: SparkSession, sf: str) -> DataFrame:
    return graph.mutual_friends(StandIn(spark, sf).directed_edges())


def q_mutual_friend_counts_directed(spark: SparkSession, sf: str) -> DataFrame:
    return graph.mutual_friend_counts(StandIn(spark, sf).directed_edges())


def q_mutual_friend_profiles_directed(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return graph.mutual_friend_profiles(s.directed_edges(), s.uneven_profiles(), *DIRECTED_PAIR)


def q_max_friend_age_directed(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return graph.max_friend_age(s.directed_edges(), s.uneven_profiles(), AS_OF)


def q_top_rated_brands(spark: SparkSession, sf: str) -> DataFrame:
    """E7 where every business has several addresses and categories."""
    s = StandIn(spark, sf)
    return _e7_text(ratings.top_rated_businesses(s.brands(), s.brand_reviews(), TOP_K))


def q_top_rated_brands_sql(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return _e7_text(ratings.top_rated_businesses_sql(spark, s.brands(), s.brand_reviews(), TOP_K))


# ------------------------------------------------------------ stored tables

def _stored(spark: SparkSession, edges: DataFrame, name: str) -> DataFrame:
    write_edge_table(edges, path := scratch_path(spark, name), n_files=8)
    return spark.read.parquet(path)


def _index(spark: SparkSession, edges: DataFrame) -> FriendIndex:
    return write_friend_index(edges, scratch_path(spark, "friend-index"))


def q_mutual_friends_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """E1 from the stored index of the directed graph, hubs as bitmaps."""
    return graph.mutual_friends(_index(spark, StandIn(spark, sf).directed_edges()))


def q_mutual_friend_counts_indexed(spark: SparkSession, sf: str) -> DataFrame:
    return graph.mutual_friend_counts(_index(spark, StandIn(spark, sf).directed_edges()))


def q_top_mutual_pairs_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """E2 by bound: of the directed graph only pairs that can be among the k
    are counted."""
    return graph.top_mutual_pairs(_index(spark, StandIn(spark, sf).directed_edges()), TOP_K)


def q_mutual_friend_profiles_stored(spark: SparkSession, sf: str) -> DataFrame:
    """E4 from the edge table laid out for lookups."""
    s = StandIn(spark, sf)
    return graph.mutual_friend_profiles(_stored(spark, s.edges(), "edges"), s.profiles(), *PROFILE_PAIR)


def q_max_friend_age_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """E5a from tables bucketed by friend and by user."""
    s, path = StandIn(spark, sf), scratch_path(spark, "bucketed")
    names = [f"{kind}_{path.rpartition('-')[2]}" for kind in ("edges", "profiles")]
    save_co_partitioned(s.edges(), s.profiles(), *names, buckets=16, path=path)
    return graph.max_friend_age(*[spark.table(n) for n in names], AS_OF, co_partitioned=True)


def q_oldest_friend_top_early(spark: SparkSession, sf: str) -> DataFrame:
    """E5 from the oldest profiles down, on the directed graph and profiles
    with gaps."""
    s = StandIn(spark, sf)
    return graph.oldest_friend_top(_stored(spark, s.directed_edges(), "edges"), s.uneven_profiles(), AS_OF, TOP_K, early=True)


def q_ratings_by_address_prefiltered(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    return ratings.ratings_by_address(s.business(), s.reviews(), NEEDLE, prefilter=True)


def q_single_file(spark: SparkSession, sf: str) -> DataFrame:
    """E7 written as one text file and read back (O10)."""
    s, path = StandIn(spark, sf), scratch_path(spark, "single-file")
    top = ratings.top_rated_businesses(s.business(), s.reviews(), TOP_K)
    write_text(_e7_text(top), path, style="row", single_file=True, max_rows=TOP_K)
    return spark.read.text(path).select("value", F.col("_metadata.file_name").alias("f")) \
        .select("value", (F.dense_rank().over(Window.orderBy("f")) - 1).alias("file"))


def q_ordered_files(spark: SparkSession, sf: str) -> DataFrame:
    """E2a of every pair written in the order of (u, v) over several files,
    and read back."""
    path = scratch_path(spark, "ordered-files")
    counts = graph.mutual_friend_counts(StandIn(spark, sf).edges())
    write_ordered_text(counts.select("u", "v", "n_mutual"), path, ["u", "v"], n_files=8)
    return spark.read.text(path)


# ---------------------------------------------------- rejects, output lines

def _rejects(kind: str, reader: Callable) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        found = reader(spark, StandIn(spark, sf).text_files(kind, faulty=True)).rejects
        return found.select("line", "reason", F.array_join("bad", "|").alias("bad"))
    return query


def _lines(render: Callable[[DataFrame], DataFrame], question: Query) -> Query:
    return lambda spark, sf: render(question(spark, sf))


def _e7_rows(spark: SparkSession, sf: str) -> DataFrame:
    s = StandIn(spark, sf)
    top = ratings.top_rated_businesses(s.brands(), s.brand_reviews(), TOP_K)
    return layouts.row_lines(top.withColumn("avg_stars", F.round("avg_stars", 6)))


QUERIES: dict[str, Query] = {
    "friend_edges": q_friend_edges,
    "friend_pairs": q_friend_pairs,
    "mutual_friends": q_mutual_friends,
    "mutual_friend_counts": q_mutual_friend_counts,
    "top_mutual_pairs": q_top_mutual_pairs,
    "top_mutual_pairs_named": q_top_mutual_pairs_named,
    "mutual_friend_profiles": q_mutual_friend_profiles,
    "max_friend_age": q_max_friend_age,
    "oldest_friend_top": q_oldest_friend_top,
    "ratings_by_address": q_ratings_by_address,
    "top_rated_businesses": q_top_rated_businesses,
    "top_rated_businesses_sql": q_top_rated_businesses_sql,
    "friend_edges_from_files": q_friend_edges_from_files,
    "oldest_friend_top_from_files": q_oldest_friend_top_from_files,
    "ratings_by_address_from_files": q_ratings_by_address_from_files,
    "top_rated_businesses_from_files": q_top_rated_businesses_from_files,
    "mutual_friends_directed": q_mutual_friends_directed,
    "mutual_friend_counts_directed": q_mutual_friend_counts_directed,
    "mutual_friend_profiles_directed": q_mutual_friend_profiles_directed,
    "max_friend_age_directed": q_max_friend_age_directed,
    "top_rated_brands": q_top_rated_brands,
    "top_rated_brands_sql": q_top_rated_brands_sql,
    "mutual_friends_indexed": q_mutual_friends_indexed,
    "mutual_friend_counts_indexed": q_mutual_friend_counts_indexed,
    "top_mutual_pairs_indexed": q_top_mutual_pairs_indexed,
    "mutual_friend_profiles_stored": q_mutual_friend_profiles_stored,
    "max_friend_age_bucketed": q_max_friend_age_bucketed,
    "oldest_friend_top_early": q_oldest_friend_top_early,
    "ratings_by_address_prefiltered": q_ratings_by_address_prefiltered,
    "single_file_top_rated": q_single_file,
    "ordered_files_counts": q_ordered_files,
    "rejects_friends": _rejects("friends", read_friends),
    "rejects_profiles": _rejects("userdata", read_profiles),
    "rejects_business": _rejects("business", read_business),
    "rejects_reviews": _rejects("reviews", read_reviews),
    "lines_mutual_friends": _lines(layouts.mutual_friend_lines, q_mutual_friends),
    "lines_pair_counts": _lines(layouts.pair_count_lines, q_top_mutual_pairs),
    "lines_named_pairs": _lines(layouts.named_pair_lines, q_top_mutual_pairs_named),
    "lines_pair_profiles": _lines(layouts.profile_list_lines, q_mutual_friend_profiles),
    "lines_oldest_friend": _lines(layouts.oldest_friend_lines, q_oldest_friend_top),
    "lines_ratings": _lines(layouts.row_lines, q_ratings_by_address),
    "lines_top_rated": _e7_rows,
}


def oracle_sql() -> dict[str, str]:
    return oracle_queries(PROFILE_PAIR, DIRECTED_PAIR)
