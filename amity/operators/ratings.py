"""Business / review operators (reference questions E6, E7).

``business(business_id, full_address, categories)`` and
``reviews(review_id, user_id, business_id, stars double)`` as returned by
``read_business`` / ``read_reviews`` (or any table with those columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.functions.membership import BITS, may_contain

MAX_TOP_K = 100_000  # ids of a top-k that are broadcast; more are joined like any table


def ratings_by_address(business: DataFrame, reviews: DataFrame, needle: str = "Stanford", prefilter: bool = False,
                       bits: int = BITS) -> DataFrame:
    """E6: distinct ``(user_id, stars)`` of reviews of businesses whose
    address contains ``needle`` (case-sensitive).

    Written as a semi-join: a business listed twice cannot fan reviews out,
    and the result is the same as join-then-distinct. The ``contains``
    filter is pushed into the business scan; the distinct is aggregated
    map-side first, so a business with a third of all reviews is reduced
    before the shuffle (and adaptive execution splits its join partition).

    Matches that are too many to broadcast would shuffle every review:
    ``prefilter`` tests the reviews' businesses against a membership filter of
    ``bits`` bits where they are read, so that hardly more than the matching
    reviews move. The result is the same.
    """
    matching = business.where(F.col("full_address").contains(needle)).select("business_id")
    if prefilter:
        reviews = reviews.where(may_contain(matching, "business_id", bits)(F.col("business_id")))
    return (reviews.select("business_id", "user_id", "stars")
            .join(matching, "business_id", "left_semi")
            .select("user_id", "stars")
            .distinct())


def _order(avg_col: str = "avg_stars"):
    return [F.col(avg_col).desc_nulls_last(), F.col("business_id").asc(), F.col("full_address").asc()]


def top_rated_businesses(business: DataFrame, reviews: DataFrame, k: int = 10) -> DataFrame:
    """E7: the ``k`` (business, address) groups with the highest average
    stars, with the set of their category texts: ``(business_id,
    categories array<string>, full_address, avg_stars)``. Ties by
    business_id, then address; NULL averages last.

    Same result as ``GROUP BY business_id, full_address`` over the join,
    computed cheaper: reviews are first reduced to (sum, count) per business
    (partial aggregation, skew-safe), the ``k`` best business ids are picked
    with a top-k, and only their business rows are grouped. A business's
    average is the same for each of its address groups, so the best ``k``
    groups always belong to the best ``k`` ids.
    """
    per_business = (reviews.groupBy("business_id")
                    .agg(F.sum("stars").alias("_s"), F.count("stars").alias("_c")))
    listed = business.select("business_id").where(F.col("business_id").isNotNull())
    scored = (per_business.join(listed, "business_id", "left_semi")
              .select("business_id", (F.col("_s") / F.nullif(F.col("_c"), F.lit(0))).alias("avg_stars")))
    if k < 0:
        raise ValueError("k must not be negative")
    best_ids = scored.orderBy(F.col("avg_stars").desc_nulls_last(), F.col("business_id").asc()).limit(k)
    groups = (business.join(F.broadcast(best_ids) if k <= MAX_TOP_K else best_ids, "business_id")
              .groupBy("business_id", "full_address", "avg_stars")
              .agg(F.array_sort(F.collect_set("categories")).alias("categories")))
    return (groups.orderBy(*_order()).limit(k)
            .select("business_id", "categories", "full_address", "avg_stars"))


def top_rated_businesses_sql(spark: SparkSession, business: DataFrame, reviews: DataFrame, k: int = 10) -> DataFrame:
    """E7 in SQL (O6, O25, O36): the k best ids first, from reviews reduced
    to (sum, count) per business, then the category sets of those k only. The
    tables are passed as arguments of the statement: no view of the caller's
    is replaced."""
    return spark.sql("""
        WITH score AS (
            SELECT business_id, SUM(stars) / NULLIF(COUNT(stars), 0) AS avg_stars
            FROM {reviews} GROUP BY business_id),
        best AS (
            SELECT business_id, avg_stars FROM score
            WHERE business_id IN (SELECT business_id FROM {business})
            ORDER BY avg_stars DESC NULLS LAST, business_id LIMIT {k})
        SELECT b.business_id, array_sort(collect_set(b.categories)) AS categories, b.full_address, best.avg_stars
        FROM {business} b JOIN best ON b.business_id = best.business_id
        GROUP BY b.business_id, b.full_address, best.avg_stars
        ORDER BY avg_stars DESC NULLS LAST, b.business_id, b.full_address
        LIMIT {k}""", business=business, reviews=reviews, k=int(k))
