"""Text sources of the reference's four inputs.

* friends   ``user<TAB>f1,f2,...`` adjacency lines  -> edges(src, dst) + rejects(line, reason, bad)
* userdata  comma text, positional, no header       -> profiles
* business  ``::``-separated text                    -> business(business_id, full_address, categories)
* review    ``::``-separated text                    -> reviews(review_id, user_id, business_id, stars)

All parsing is Column expressions over ``spark.read.text``: nothing is inferred,
nothing leaves the executors, and no line is lost: what a reader cannot use is in
its rejects, once a line.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.functions.columns import DOB_PATTERN, parse_dob, to_id

# Column layouts of the reference's inputs.
PROFILE_FIELDS = ["user_id", "first_name", "last_name", "address", "city", "state",
                  "c6", "c7", "c8", "dob"]
BUSINESS_FIELDS = ["business_id", "full_address", "categories"]
REVIEW_FIELDS = ["review_id", "user_id", "business_id", "stars"]
RATING_SEP = "::"

REJECT_ID = "id"        # a user or friend id that is not a whole number
REJECT_ARITY = "arity"  # a wrong number of fields
REJECT_STARS = "stars"  # stars that are not a number

# Rejects of every source: the line once, why, and its fields at fault.
REJECTS = "line string, reason string, bad array<string>"


class FriendParse(NamedTuple):
    edges: DataFrame     # src bigint, dst bigint: distinct, no self edge
    rejects: DataFrame   # line, reason, bad: one row per line with a fault


class Parsed(NamedTuple):
    rows: DataFrame      # the lines that are as they should be
    rejects: DataFrame   # line, reason, bad: all others but blank ones


def friend_edge_rows(lines: DataFrame, col: str = "value") -> FriendParse:
    """Like ``parse_friend_lines`` but without the final ``distinct``: a
    stateless per-row parse, usable on a streaming DataFrame. The split line
    is exploded as plain text; ids are read after that."""
    line = F.col(col)
    # trailing TABs and trailing commas produce no field in the reference's split
    body = F.regexp_replace(line, r"\t+$", "")
    fields = F.split(body, "\t")
    friends_txt = F.regexp_replace(F.get(fields, 1), r",+$", "")
    tokens = F.when(friends_txt == "", F.array().cast("array<string>")).otherwise(F.split(friends_txt, ","))
    parts = lines.select(line.alias("line"), F.size(fields).alias("n"), F.get(fields, 0).alias("user"), tokens.alias("tokens"),
                         (F.trim(body) == "").alias("blank"))
    src = to_id("user")
    edges = (parts.where((F.col("n") == 2) & ~F.col("blank") & src.isNotNull())
             .select(src.alias("src"), F.explode("tokens").alias("token"))
             .select("src", to_id("token").alias("dst"))
             .where(F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))))
    bad = (F.when(F.col("blank") | (F.col("n") == 1), None)  # nothing, or a user without friends
           .when(F.col("n") > 2, F.array().cast("array<string>"))
           .when(src.isNull(), F.array("user"))
           .otherwise(F.filter("tokens", lambda x: to_id(x).isNull())))
    reason = F.when(F.col("n") > 2, F.lit(REJECT_ARITY)).otherwise(F.lit(REJECT_ID))
    rejects = (parts.select("line", "n", reason.alias("reason"), bad.alias("bad"))
               .where(F.col("bad").isNotNull() & ((F.col("n") > 2) | (F.size("bad") > 0))).select("line", "reason", "bad"))
    return FriendParse(edges, rejects)


def parse_friend_lines(lines: DataFrame, col: str = "value") -> FriendParse:
    """Adjacency lines -> (edges, rejects).

    Meaning (one choice where the reference's programs disagree):
    a user's friend list is the union of all its lines; repeated ids count
    once; self edges are dropped; a line with more than two TAB fields is an
    ``arity`` reject; a line with ids that are not whole numbers is an ``id``
    reject, once, with those ids in ``bad`` (its other ids stay); a line with
    only a user id (no friends) and blank lines are skipped silently.
    """
    rows = friend_edge_rows(lines, col)
    return FriendParse(rows.edges.distinct(), rows.rejects)


def read_friends(spark: SparkSession, path: str | list[str]) -> FriendParse:
    """Read adjacency-line text files (a file, a folder or a glob)."""
    return parse_friend_lines(spark.read.text(path))


def _read_double_colon(spark: SparkSession, path: str | list[str], names: list[str]) -> Parsed:
    """``::``-parted lines, read as CSV with Spark's default quoting, line by
    line. A line that does not give exactly the named fields (a separator too
    many, too few, or swallowed by a stray quote) is an ``arity`` reject."""
    kind = ", ".join(f"{n} string" for n in [*names, "_corrupt"])
    lines = spark.read.text(path).where(F.trim("value") != "")
    read = F.from_csv("value", kind, {"sep": RATING_SEP, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parts = lines.select(F.col("value").alias("line"), read.alias("r"))
    wrong = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    return Parsed(parts.where(~wrong).select("line", *[F.col(f"r.{n}").alias(n) for n in names]),
                  parts.where(wrong).select("line", F.lit(REJECT_ARITY).alias("reason"), F.array().cast("array<string>").alias("bad")))


def read_profiles(spark: SparkSession, path: str | list[str], dedupe: bool = True) -> Parsed:
    """Comma-separated user profiles, positional, no header, no quoting.

    Columns of ``rows``: user_id bigint, first_name, last_name, address, city,
    state, c6, c7, c8 (never read by any query), dob_text (raw ``M/d/yyyy``),
    dob date (NULL when it does not parse). Extra fields are ignored. With
    ``dedupe`` a user with several lines keeps the smallest line. A line with
    fewer fields is an ``arity`` reject, one with a bad user id an ``id`` reject.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    parts = lines.select(F.col("value").alias("line"), F.split("value", ",", -1).alias("f"))
    enough = F.size("f") >= len(PROFILE_FIELDS)
    known = to_id(F.get("f", 0)).isNotNull()
    rejects = parts.where(~enough | ~known).select(
        "line", F.when(enough, F.lit(REJECT_ID)).otherwise(F.lit(REJECT_ARITY)).alias("reason"),
        F.when(enough, F.array(F.get("f", 0))).otherwise(F.array().cast("array<string>")).alias("bad"))
    # an empty field is NULL, as in CSV
    rows = parts.where(enough & known).select(*[F.nullif(F.get("f", k), F.lit("")).alias(n) for k, n in enumerate(PROFILE_FIELDS)])
    df = rows.select(
        to_id("user_id").alias("user_id"),
        *[F.col(c) for c in PROFILE_FIELDS[1:-1]],
        F.col("dob").alias("dob_text"),
        parse_dob("dob", DOB_PATTERN).alias("dob"))
    return Parsed(first_profile_per_user(df) if dedupe else df, rejects)


def first_profile_per_user(profiles: DataFrame, key: str = "user_id") -> DataFrame:
    """One row per user: the smallest row by all columns, so the choice does
    not depend on file or partition order. A partial aggregation: a user with
    many lines is reduced map-side before the shuffle."""
    others = [c for c in profiles.columns if c != key]
    return (profiles.groupBy(key)
            .agg(F.min(F.struct(*others)).alias("_p"))
            .select(key, *[F.col(f"_p.{c}").alias(c) for c in others]))


def read_business(spark: SparkSession, path: str | list[str]) -> Parsed:
    """``business_id::full_address::categories``; categories stay one text
    value (e.g. ``List(Food, Bars)``)."""
    parsed = _read_double_colon(spark, path, BUSINESS_FIELDS)
    return Parsed(parsed.rows.drop("line"), parsed.rejects)


def read_reviews(spark: SparkSession, path: str | list[str]) -> Parsed:
    """``review_id::user_id::business_id::stars``; stars -> double. Stars that
    are no number are NULL, so that they never fail an average, and the line
    is listed as a ``stars`` reject besides."""
    parsed = _read_double_colon(spark, path, REVIEW_FIELDS)
    stars = F.col("stars").try_cast("double")
    rows = parsed.rows.select("review_id", "user_id", "business_id", stars.alias("stars"))
    unread = parsed.rows.where(stars.isNull()).select("line", F.lit(REJECT_STARS).alias("reason"), F.array("stars").alias("bad"))
    return Parsed(rows, parsed.rejects.unionByName(unread))
