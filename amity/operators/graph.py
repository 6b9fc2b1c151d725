"""Friendship-graph operators (reference questions E1-E5).

Input is an edge set ``edges(src bigint, dst bigint)``: ``dst`` is on
``src``'s friend list. Edges are expected distinct and without self edges,
which is what ``parse_friend_lines`` / ``clean_edges`` return.

Meaning of "mutual friends" of a befriended pair {u, v} (u < v; befriended =
an edge in at least one direction): ``A(u) ∩ A(v)`` where ``A(x)`` is x's
own friend list (empty when x has no line). It never contains u or v.

How it is computed (no whole friend list in one row): a mutual friend w
of {u, v} closes a triangle {u, v, w} of befriended users, so the operators
list triangles with the degree ordering of Chiba and Nishizeki / Suri and
Vassilvitskii: each friendship points from its lower- to its higher-degree
user, so nobody points at more than sqrt(2m) users. Those out-lists are cut
by a hash into chunks of about ``CHUNK`` ids; a friendship x->y meets the
chunks of x's list and of y's list that can share an id, one task key being
(x, chunk). That bounds a row's memory by a chunk and a key's work by the
pairs of one chunk, also for a user who points at thousands of well-connected
ones. The direction flags decide which corners of a triangle are mutual
friends of the other two.

Every function returns a lazy DataFrame: calling it starts no Spark job and
writes nothing. Where several questions are asked of one graph, a
``FriendIndex`` (``amity.operators.friend_index``) takes the place of the
edges: the lists are prepared and written once, and each question reads them.
"""

from __future__ import annotations

import datetime as _dt
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amity.functions.columns import age_years, pair_hi, pair_lo
from amity.operators.skew import hot_pieces, lookup_join, piece_rows
from amity.sources.text import first_profile_per_user

if TYPE_CHECKING:
    from amity.operators.friend_index import FriendIndex

MAX_TOP_K = 100_000   # rows of a top-k that are broadcast; more are joined like any table
PAIR_BUCKETS = 64     # tasks one pair's two friend lists are spread over
CHUNK = 128           # ids of an out-list in one row, on average at most


# ---------------------------------------------------------------- edges, pairs

def clean_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct ``(src, dst)`` with NULLs and self edges removed."""
    return (edges.select(F.col(src).cast("bigint").alias("src"), F.col(dst).cast("bigint").alias("dst"))
            .where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))
            .distinct())


def _proper(edges: DataFrame) -> DataFrame:
    """Drop NULL ends and self edges (``least``/``greatest`` skip NULLs, so
    an edge with one NULL end would otherwise pair a user with itself)."""
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))


def friendships(edges: DataFrame) -> DataFrame:
    """Befriended pairs with the directions listed: ``(u, v, uv, vu)``,
    u < v, ``uv`` = v is on u's list, ``vu`` = u is on v's list. One
    aggregation with a map-side partial step."""
    return (_proper(edges)
            .groupBy(pair_lo("src", "dst").alias("u"), pair_hi("src", "dst").alias("v"))
            .agg(F.max(F.col("src") < F.col("dst")).alias("uv"),
                 F.max(F.col("src") > F.col("dst")).alias("vu")))


def friend_pairs(edges: DataFrame) -> DataFrame:
    """Befriended pairs ``(u, v)``, u < v, one row each (O13)."""
    return (_proper(edges).select(pair_lo("src", "dst").alias("u"), pair_hi("src", "dst").alias("v"))
            .distinct())


def in_degrees(edges: DataFrame) -> DataFrame:
    """``(user_id, degree)``: number of lists naming the user."""
    return edges.groupBy(F.col("dst").alias("user_id")).agg(F.count(F.lit(1)).alias("degree"))


def pair_degrees(pairs: DataFrame) -> DataFrame:
    """``(user_id, degree)``: number of befriended pairs a user is in."""
    return (pairs.select(F.explode(F.array("u", "v")).alias("user_id"))
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("degree")))


def _oriented(fs: DataFrame, deg: DataFrame, pieces: DataFrame, rows: Column) -> DataFrame:
    """Friendships pointed from the lower- to the higher-ranked user, rank =
    (number of friendships, id): ``(x, y, xy, yx)`` with the two
    direction flags in that frame.

    A user x keeps at most sqrt(2m) pairs pointing away from it (m pairs in
    all): a user with more has more than sqrt(2m) friends of even higher
    degree, and there are fewer than sqrt(2m) users that big. A hub with a
    third of all friendships points at almost nobody. ``deg`` is
    ``pair_degrees(fs)``; ``pieces`` its hot keys and ``rows`` what one
    piece holds (``skew``)."""

    def with_degree(df: DataFrame, end: str, out: str) -> DataFrame:
        lk = deg.select(F.col("user_id").alias(end), F.col("degree").alias(out))
        spread = F.greatest(F.lit(1), F.ceil(F.col(out) / rows).cast("int"))
        return lookup_join(df, lk, end, pieces.withColumnRenamed("user_id", end), "inner", spread)

    d = with_degree(with_degree(fs, "u", "du"), "v", "dv")
    u_low = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))

    def pick(a: str, b: str) -> Column:
        return F.when(u_low, F.col(a)).otherwise(F.col(b))

    return d.select(pick("u", "v").alias("x"), pick("v", "u").alias("y"),
                    pick("uv", "vu").alias("xy"), pick("vu", "uv").alias("yx"))


def _chunks(edges: DataFrame, floor_rows: int | None, chunk: int) -> DataFrame:
    """``(x, y, xy, yx)`` and the chunks ``nx ax bx`` of x's and ``ny ay by``
    of y's out-list that meet: n the ids pointed at, a those the owner lists,
    b those that list the owner (a, b NULL where equal to n)."""
    fs = friendships(edges)
    deg = pair_degrees(fs)
    per_piece = piece_rows(deg, "degree", floor_rows)
    pieces = hot_pieces(deg, "user_id", "degree", rows=per_piece)
    o = _oriented(fs, deg, pieces, per_piece)
    # at most sqrt(2m) rows of one x
    d = F.count(F.lit(1)).over(Window.partitionBy("x"))
    p = F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(d / F.lit(chunk))))).cast("int")
    sized = o.select("x", "y", "xy", "yx", p.alias("p"))
    some = {c: F.collect_list(F.when(F.col(flag), F.col("y"))) for c, flag in (("a", "xy"), ("b", "yx"))}
    lists = (sized.groupBy("x", "p", F.pmod(F.xxhash64("y"), F.col("p")).cast("int").alias("c"))
             .agg(F.collect_list("y").alias("n"), *[v.alias(k) for k, v in some.items()]))
    lists = lists.select("x", "p", "c", "n", *[F.when(F.size(k) < F.size("n"), F.col(k)).alias(k) for k in "ab"])
    pairs = sized.select("x", "y", "xy", "yx", F.col("p").alias("px"),
                         F.explode(F.sequence(F.lit(0), F.col("p") - 1)).alias("cx"))
    # y's chunks, spread where many point at y; chunk numbers agree on the coarser scale
    ylists = lists.select(F.col("x").alias("y"), F.col("p").alias("py"), F.col("c").alias("cy"),
                          *[F.col(k).alias(f"{k}y") for k in "nab"])
    scale = F.least("px", "py")
    with_y = (lookup_join(pairs, ylists, "y", pieces.withColumnRenamed("user_id", "y"), "inner")
              .where(F.pmod("cx", scale) == F.pmod("cy", scale)))
    xlists = lists.select("x", F.col("c").alias("cx"), *[F.col(k).alias(f"{k}x") for k in "nab"])
    return with_y.join(xlists, ["x", "cx"])


def triangles(edges: DataFrame, floor_rows: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """Every triangle of befriended users once: ``(x, y, w)``, x ranked lowest
    and w highest by (number of friendships, id)."""
    return _chunks(edges, floor_rows, chunk).select("x", "y", F.explode(F.array_intersect("nx", "ny")).alias("w"))


def _corners(both: DataFrame, counted: bool) -> DataFrame:
    """``(u, v, friend_id)`` rows of the meeting chunks; ``counted`` adds a
    weight, and lists the pair {x, y} once with the number of its friends.

    Of a triangle's corners, w is a friend of x and y if both list it, y one
    of x and w if x lists it and w does, and x one of y and w likewise."""
    common = F.array_intersect("nx", "ny")
    both = both.where(F.size(common) > 0).withColumn("w", common)  # the w of x and y: whoever is listed is among them

    def listed(found: Column, k: str) -> Column:
        return F.when(F.col(k).isNull(), found).otherwise(F.array_intersect(found, k))

    of_xy = listed(listed(F.col("w"), "ax"), "ay")
    of_xw = F.when(F.col("xy"), listed(F.col("w"), "by"))
    of_yw = F.when(F.col("yx"), listed(F.col("w"), "bx"))
    one = F.array(F.lit(None).cast("bigint"))
    kinds = [F.struct(F.lit(0).alias("k"), (one if counted else of_xy).alias("w"),
                      (F.size(of_xy) if counted else F.lit(1)).alias("n")),
             F.struct(F.lit(1).alias("k"), of_xw.alias("w"), F.lit(1).alias("n")),
             F.struct(F.lit(2).alias("k"), of_yw.alias("w"), F.lit(1).alias("n"))]
    rows = (both.select("x", "y", F.explode(F.array(*kinds)).alias("s"))
            .select("x", "y", "s.k", "s.n", F.explode("s.w").alias("w")))
    first = F.when(F.col("k") == 2, F.col("y")).otherwise(F.col("x"))
    second = F.when(F.col("k") == 0, F.col("y")).otherwise(F.col("w"))
    friend = F.when(F.col("k") == 0, F.col("w")).when(F.col("k") == 1, F.col("y")).otherwise(F.col("x"))
    out = rows.select(F.least(first, second).alias("u"), F.greatest(first, second).alias("v"), friend.alias("friend_id"),
                      F.col("n").alias("_w"))
    return out.where("_w > 0") if counted else out.drop("_w")


def mutual_friend_rows(edges: DataFrame | FriendIndex, floor_rows: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """``(u, v, friend_id)``: one row per befriended pair and mutual friend.
    Pairs without a mutual friend have no row here (see ``mutual_friends``)."""
    if not isinstance(edges, DataFrame):
        return edges.friend_rows()
    return _corners(_chunks(edges, floor_rows, chunk), counted=False)


def mutual_friends(edges: DataFrame | FriendIndex, rows: DataFrame | None = None, floor_rows: int | None = None) -> DataFrame:
    """E1, long form: ``(u, v, friend_id)`` for every befriended pair; a pair
    with no mutual friend gives one row with ``friend_id`` NULL.

    The long form keeps every row bounded; ``mutual_friend_lists`` turns it
    into the reference's one-line-per-pair layout. ``rows`` takes the
    output of ``mutual_friend_rows`` when it was already computed (as do
    ``mutual_friend_counts``, ``top_mutual_pairs`` and
    ``top_mutual_pairs_named``), so several questions share one listing.
    """
    if not isinstance(edges, DataFrame):
        return edges.mutual_friends()
    rows = mutual_friend_rows(edges, floor_rows) if rows is None else rows
    return friend_pairs(edges).join(rows, ["u", "v"], "left").select("u", "v", "friend_id")


def mutual_friend_lists(mutual_long: DataFrame) -> DataFrame:
    """E1 in the reference's layout: ``(u, v, mutual array<bigint>)``, ids in
    numeric order, empty array for a pair without mutual friends.

    A formatting step for the text sink: one row holds a whole list, which
    is at most min(deg u, deg v) ids. Keep ``mutual_friends`` (long form) as
    the working table for anything downstream.
    """
    return (mutual_long.groupBy("u", "v")
            .agg(F.array_sort(F.collect_list("friend_id")).alias("mutual")))


def _weighted(edges: DataFrame, rows: DataFrame | None, floor_rows: int | None) -> DataFrame:
    """``(u, v, _w)``: weights that sum up to a pair's mutual friends."""
    if rows is not None:
        return rows.select("u", "v", F.lit(1).alias("_w"))
    return _corners(_chunks(edges, floor_rows, CHUNK), counted=True).select("u", "v", "_w")


def mutual_friend_counts(edges: DataFrame | FriendIndex, rows: DataFrame | None = None, floor_rows: int | None = None) -> DataFrame:
    """E2a: ``(u, v, n_mutual bigint)`` for every befriended pair, 0 included.
    Every pair enters as a row of weight 0 next to its weighted rows: one
    hash aggregation with a map-side partial step, no join."""
    if not isinstance(edges, DataFrame):
        return edges.counts()
    pairs = friendships(edges).select("u", "v", F.lit(0).alias("_w"))
    return (_weighted(edges, rows, floor_rows).unionByName(pairs)
            .groupBy("u", "v").agg(F.sum("_w").cast("bigint").alias("n_mutual")))


def top_mutual_pairs(edges: DataFrame | FriendIndex, k: int = 10, rows: DataFrame | None = None,
                     floor_rows: int | None = None) -> DataFrame:
    """E2: the ``k`` pairs with most mutual friends; ties by u, then v.

    Exact without joining every pair to its count: the answer is the top
    ``k`` of the pairs with a count, unless fewer than ``k`` pairs share
    anybody; then the first count-0 pairs in (u, v) order fill it, and those
    are always among the first ``2k`` pairs in that order. So those ``2k``
    pairs join the mutual-friend rows as rows of weight 0, one aggregation
    counts everything, and a per-partition top-k merge picks the answer. A
    friend index counts only the pairs that can be among the k."""
    if not isinstance(edges, DataFrame):
        return edges.top_pairs(k)
    order = [F.col("n_mutual").desc(), F.col("u").asc(), F.col("v").asc()]
    first = (friendships(edges).select("u", "v").orderBy("u", "v").limit(2 * k)
             .select("u", "v", F.lit(0).alias("_w")))
    counts = (_weighted(edges, rows, floor_rows).unionByName(first)
              .groupBy("u", "v").agg(F.sum("_w").cast("bigint").alias("n_mutual")))
    return counts.orderBy(*order).limit(k)


# ------------------------------------------------------------ profile joins

def _few(rows: DataFrame, k: int) -> DataFrame:
    """The rows of a top-k for a join: broadcast where ``k`` bounds their size."""
    return F.broadcast(rows) if k <= MAX_TOP_K else rows


def _profiles_for(profiles: DataFrame, keys: DataFrame, k: int) -> DataFrame:
    """One profile row per user in ``keys`` (the ids of a top-k). ``profiles``
    is scanned once and, for up to ``MAX_TOP_K`` keys, never shuffled whole;
    a user's several rows fold into the smallest."""
    found = profiles.join(_few(keys.select("user_id").distinct(), k), "user_id", "left_semi")
    return first_profile_per_user(found, "user_id")


def top_mutual_pairs_named(edges: DataFrame | FriendIndex, profiles: DataFrame, k: int = 10, rows: DataFrame | None = None,
                           floor_rows: int | None = None, top: DataFrame | None = None) -> DataFrame:
    """E3: E2 plus first name, last name and address of both users (NULL
    when a user has no profile), in E2's order. Columns: n_mutual, u, v,
    first_u, last_u, address_u, first_v, last_v, address_v. Only the k rows'
    users are looked up; a user with several profile rows counts once. The
    plan reads the k rows twice; ``top`` takes E2's result if it is written."""
    top = top_mutual_pairs(edges, k, rows, floor_rows) if top is None else top.limit(k)
    # two rows a pair, one an end; each end's profile, and the end itself in case it has none
    ends = top.select("n_mutual", "u", "v", F.explode(F.array("u", "v")).alias("user_id"))
    fields = ["first_name", "last_name", "address"]
    found = profiles.select("user_id", *fields).join(_few(ends, k), "user_id") \
        .select("n_mutual", "u", "v", "user_id", F.struct(*fields).alias("p"))
    both = found.unionByName(ends.withColumn("p", F.lit(None).cast(found.schema["p"].dataType)))

    def side(s: str) -> Column:
        return F.min(F.when(F.col("user_id") == F.col(s), F.col("p"))).alias(s + "_p")

    # the smallest of a user's profiles; min skips the NULL of the end itself
    named = both.groupBy("n_mutual", "u", "v").agg(side("u"), side("v"))
    cols = [F.col(f"{s}_p.{f}").alias(f"{f.removesuffix('_name')}_{s}") for s in "uv" for f in fields]
    return named.select("n_mutual", "u", "v", *cols).orderBy(F.col("n_mutual").desc(), "u", "v").limit(k)


def mutual_friend_profiles(edges: DataFrame | FriendIndex, profiles: DataFrame, a: int, b: int) -> DataFrame:
    """E4: for the befriended pair {a, b} (either order), each mutual friend
    with first name and birth-date text: ``(u, v, friend_id, first_name,
    dob)``. Friends are matched by id, never by name. No rows when a and b
    are not friends or share nobody.

    One pass over the edges: the rows of both lists (a pushed-down filter),
    spread over ``PAIR_BUCKETS`` buckets by friend. The rows of a and b
    themselves, which prove the friendship, go to every bucket."""
    edges = edges if isinstance(edges, DataFrame) else edges.edges()
    lo, hi = min(int(a), int(b)), max(int(a), int(b))
    near = _proper(edges).where(F.col("src").isin(lo, hi))
    own = F.pmod(F.xxhash64("dst"), F.lit(PAIR_BUCKETS)).cast("int")
    everywhere = F.sequence(F.lit(0), F.lit(PAIR_BUCKETS - 1))
    listed = (near.select("dst", "src", F.explode(F.when(F.col("dst").isin(lo, hi), everywhere)
                                                  .otherwise(F.array(own))).alias("bucket"))
              .groupBy("bucket", "dst").agg(F.max(F.col("src") == lo).alias("in_lo"), F.max(F.col("src") == hi).alias("in_hi")))
    friends = F.max(F.col("dst").isin(lo, hi)).over(Window.partitionBy("bucket"))
    shared = (listed.withColumn("friends", friends)
              .where(F.col("friends") & F.col("in_lo") & F.col("in_hi") & ~F.col("dst").isin(lo, hi))
              .select(F.col("dst").alias("friend_id")))
    # read twice below, computed once: both joins start from this exchange. A left join whose
    # small side is broadcast is not to be had, so profiles of others go first, by a semi-join
    shared = shared.repartition("friend_id")
    prof = profiles.select(F.col("user_id").alias("friend_id"), "first_name", F.col("dob_text").alias("dob"))
    prof = first_profile_per_user(prof.join(shared, "friend_id", "left_semi"), "friend_id")
    return shared.join(prof, "friend_id", "left").select(
        F.lit(lo).cast("bigint").alias("u"), F.lit(hi).cast("bigint").alias("v"), "friend_id", "first_name", "dob")


# ------------------------------------------------------------------- ages

def max_friend_age(edges: DataFrame | FriendIndex, profiles: DataFrame,
                   as_of: Column | str | _dt.date | None = None, floor_rows: int | None = None,
                   co_partitioned: bool = False) -> DataFrame:
    """E5a: ``(user_id, max_friend_age int)`` for every user with a friend
    list: the calendar age on ``as_of`` of the oldest friend. NULL when no
    friend has a readable birth date (or a profile at all).

    The join runs on the friend's id, where a popular user is a hot key: the
    rows of every much-named user are spread over several tasks (see
    ``lookup_join``); the max is aggregated map-side first. With
    ``co_partitioned``, both tables are bucketed by that id
    (``save_co_partitioned``) and joined bucket by bucket: no edge is shuffled
    before the aggregation."""
    edges = _proper(edges if isinstance(edges, DataFrame) else edges.edges())
    ages = profiles.select(F.col("user_id").alias("dst"), age_years("dob", as_of).alias("age"))
    if co_partitioned:
        joined = edges.join(ages, "dst", "left")
    else:
        pieces = hot_pieces(in_degrees(edges), "user_id", "degree", floor_rows).withColumnRenamed("user_id", "dst")
        joined = lookup_join(edges, ages, "dst", pieces, "left")
    return (joined.groupBy(F.col("src").alias("user_id"))
            .agg(F.max("age").alias("max_friend_age")))


def _oldest(edges: DataFrame, profiles: DataFrame, as_of: Column | str | _dt.date | None, k: int) -> DataFrame:
    """``max_friend_age`` of enough users for a top ``k``, from the oldest
    profiles only.

    A friend p whom at least k users list settles k places: those users'
    ages are p's or more. So nobody below the oldest such p's age can be among
    the first k, and at just that age only the k smallest ids that list p, and
    smaller ones. Profiles older than p are listed by fewer than k users each.
    All three numbers are scalar subqueries; without such a p all count."""
    ages = profiles.select(F.col("user_id").alias("dst"), age_years("dob", as_of).alias("age")).where("age IS NOT NULL")
    ages = ages.groupBy("dst").agg(F.max("age").alias("age"))
    named = in_degrees(edges).where(F.col("degree") >= k).select(F.col("user_id").alias("dst"))
    known = ages.join(named, "dst", "left_semi")
    least = known.agg(F.max("age")).scalar()
    # among the oldest such friends, the one with the smallest id
    friend = known.agg(F.max_by("dst", F.struct("age", -F.col("dst")))).scalar()
    last = edges.where(F.col("dst") == friend).select("src").orderBy("src").limit(k).agg(F.max("src")).scalar()
    older = edges.join(ages.where((F.col("age") > least) | F.isnull(least)), "dst")
    equal = edges.where(F.col("src") <= last).join(ages.where(F.col("age") == least), "dst")
    return (older.unionByName(equal).groupBy(F.col("src").alias("user_id")).agg(F.max("age").alias("max_friend_age")))


def oldest_friend_top(edges: DataFrame | FriendIndex, profiles: DataFrame,
                      as_of: Column | str | _dt.date | None = None, k: int = 10,
                      floor_rows: int | None = None, early: bool = False) -> DataFrame:
    """E5: the ``k`` users whose oldest friend is oldest (ties: smaller id;
    users without any known friend age are left out), with the user's own
    address, city and state, in that order: ``(user_id, address, city, state,
    max_friend_age)``. The address lookup runs after the top-k, on k users.

    ``early`` joins only the oldest profiles to the edges, as far down as k
    users need: for stored edges, which it scans several times and shuffles
    little of. The result is the same."""
    if k < 0:
        raise ValueError("k must not be negative")
    order = [F.col("max_friend_age").desc(), F.col("user_id").asc()]
    if early:
        listed = _proper(edges if isinstance(edges, DataFrame) else edges.edges())
        found = _oldest(listed, profiles, as_of, max(k, 1))
    else:
        found = max_friend_age(edges, profiles, as_of, floor_rows)
    top = found.where(F.col("max_friend_age").isNotNull()).orderBy(*order).limit(k)
    addr = _profiles_for(profiles.select("user_id", "address", "city", "state"), top, k)
    return (top.join(_few(addr, k), "user_id", "left")
            .select("user_id", "address", "city", "state", "max_friend_age").orderBy(*order).limit(k))
