"""A stored friend index: the graph once prepared, many questions answered.

``write_friend_index(edges, path)`` derives from an edge table what every
mutual-friend question needs and writes it; ``mutual_friends``,
``mutual_friend_counts``, ``top_mutual_pairs(_named)``,
``mutual_friend_profiles`` and ``max_friend_age`` take the index in place of
the edges.

*Orientation.* Every befriended pair belongs to its lower-ranked user, rank =
(number of friendships, id), so a hub owns few pairs however many it is in.
A row of ``lists`` holds a user, its friend list and the pairs it owns: one
exchange brings each owner's list to the other end's.

*Lists.* Of a user with up to ``WHOLE`` friends the list is one row of ids. A
longer one is cut: by a hash of the id into parts of about ``PART`` ids, or,
where it holds at least one user in ``DENSE``, into bitmaps of ``SPAN`` users
each, by dense rank. A pair meets only in the parts that the lower-ranked
user's ids fall in. So a row is bounded, and a hub is as many keys as it has
parts (and ``ceil(friends / HOT)`` pieces of each).

*Counts.* Two id lists are intersected, an id list is looked up in a bitmap bit
by bit, and two bitmaps are ANDed and their bits counted. A pair's friends are
never listed to be counted.

The tables are written once, in jobs of their own; what the index's methods
return is lazy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amity.operators.graph import friendships
from amity.operators.skew import FLOOR_ROWS, hot_pieces, lookup_join, piece_rows

WHOLE = 512       # friends of a user whose list is one row
PART = 256        # ids of a part of a longer list, on average
SPAN = 8192       # users a bitmap part covers
DENSE = 64        # a list of at least one user in so many is kept as bitmaps
OWNED = 512       # pairs of an owner in one row, on average at most
HOT = 1_000_000   # pairs of a user that meet in one task
FIRST = 1_000     # pairs whose counts give top_pairs its threshold, at least


def _parts(degree: Column, n_users: int, whole: int) -> Column:
    hashed = F.pow(F.lit(2.0), F.ceil(F.log2(degree / F.lit(PART)))).cast("int")
    return F.when(degree <= whole, F.lit(1)).when(_dense(degree, n_users, whole), F.lit(-(-n_users // SPAN))).otherwise(F.greatest(hashed, F.lit(1)))


def _dense(degree: Column, n_users: int, whole: int) -> Column:
    return (degree > whole) & (degree * DENSE >= n_users)


def _part_of(friend: Column, rank: Column, degree: Column, n_users: int, whole: int) -> Column:
    """The part of a user's list (by its ``degree``) that a friend is in."""
    hashed = F.pmod(F.xxhash64(friend), _parts(degree, n_users, whole))
    return F.when(degree <= whole, F.lit(0)).when(_dense(degree, n_users, whole), F.floor(rank / SPAN)).otherwise(hashed).cast("int")


@dataclass
class FriendIndex:
    """The written tables. ``users``: user_id, degree (friendships), listed
    (ids on the user's own list), rank. ``lists``: owner, degree, listed,
    part, primary, ids, ranks, words, targets."""

    users: DataFrame
    lists: DataFrame
    n_users: int
    max_degree: int
    whole: int

    @property
    def cut(self) -> bool:
        """Whether any list is in more than one row."""
        return self.max_degree > self.whole

    def edges(self) -> DataFrame:
        """``(src, dst)``: the edge table again."""
        return self.lists.where("primary").select(F.col("owner").alias("src"), F.explode("ids").alias("dst"))

    def pairs(self) -> DataFrame:
        """``(x, y, bound)``: every befriended pair, x its owner; ``bound``: no
        fewer than its mutual friends."""
        return self.lists.where("part = 0").select(F.col("owner").alias("x"), F.explode("targets").alias("t")) \
            .select("x", F.col("t.y").alias("y"), F.col("t.bound").alias("bound"))

    # -------------------------------------------------------------- meetings
    def meetings(self, least: Column | None = None, only: DataFrame | None = None) -> DataFrame:
        """``(x, y, px, parts, ...)``: each befriended pair with the lists of both
        ends, a row for each part of y's list that ids of x fall in (and one
        for part 0). ``least``: only pairs whose bound reaches it; ``only``:
        a few pairs ``(x, y)``, broadcast."""
        rows, others = self.lists.where(F.size("targets") > 0), self.lists.where("primary")
        if least is not None:
            # a pair's bound is less than either end's number of friendships
            rows, others = rows.where(F.col("degree") > least), others.where(F.col("degree") > least)
        own = ["ids"] + ["part", "degree", "ranks", "words"] * self.cut
        rows = rows.select(F.col("owner").alias("x"), *own, F.explode("targets").alias("t"))
        if least is not None:
            rows = rows.where(F.col("t.bound") >= least)
        rows = rows.select("x", F.col("t.y").alias("y"), *own, F.col("t.degree").alias("dy"))
        if only is not None:
            rows = rows.join(F.broadcast(only.select("x", "y")), ["x", "y"], "left_semi")
        if not self.cut:
            return rows.drop("dy").join(others.select(F.col("owner").alias("y"), F.col("ids").alias("ids_y")), "y")
        return self._cut_meetings(rows, others)

    def _cut_meetings(self, rows: DataFrame, others: DataFrame) -> DataFrame:
        dy, args = F.col("dy"), (self.n_users, self.whole)
        both = _dense(F.col("degree"), *args) & _dense(dy, *args)
        zero = F.when(F.col("part") == 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
        into = F.zip_with("ids", "ranks", lambda i, r: _part_of(i, r, dy, *args))  # the part of y's list each id falls in
        need = F.when(dy <= self.whole, F.array(F.lit(0))).when(both, F.array("part")).otherwise(F.array_union(zero, into))
        pieces = F.ceil(dy / F.lit(HOT)).cast("int")
        rows = rows.select("x", "y", "dy", "degree", "ids", "ranks", "words", F.col("part").alias("px"), F.explode(need).alias("part"))

        def here(listed: str) -> Column:
            in_part = F.filter(F.zip_with(listed, into, lambda v, p: F.when(p == F.col("part"), v)), lambda v: v.isNotNull())
            return F.when((dy <= self.whole) | both, F.col(listed)).otherwise(in_part)

        # every row carries its user's list: ranks go only where a bitmap is asked for them
        rows = rows.select("x", "y", "px", "part", (dy > self.whole).alias("parted"), here("ids").alias("own"),
                           F.when(_dense(dy, *args), here("ranks")).alias("own_ranks"), F.when(both, F.col("words")).alias("words"),
                           F.pmod(F.xxhash64("x"), pieces).cast("int").alias("piece"))
        spread = F.sequence(F.lit(0), F.ceil(F.col("degree") / F.lit(HOT)).cast("int") - 1)
        others = others.select(F.col("owner").alias("y"), "part", F.col("ids").alias("ids_y"), F.col("words").alias("words_y"), F.explode(spread).alias("piece"))
        return rows.join(others, ["y", "part", "piece"])

    def _found(self) -> Column:
        """The common friends of a meeting."""
        if not self.cut:
            return F.array_intersect("ids", "ids_y")
        set_ = F.filter(F.zip_with("own", "own_ranks", lambda i, r: F.when(self._bit(r), i)), lambda i: i.isNotNull())
        return F.when(F.col("words_y").isNull(), F.array_intersect("own", "ids_y")).otherwise(set_)

    @staticmethod
    def _bit(rank: Column) -> Column:
        """Whether y's bitmap has the user of this rank."""
        word = F.get("words_y", F.floor((rank % SPAN) / 64).cast("int"))
        return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), (rank % 64).cast("int"))) != 0

    def _count(self) -> Column:
        if not self.cut:
            return F.size(self._found())
        anded = F.zip_with("words", "words_y", lambda a, b: F.bit_count(a.bitwiseAND(b)))
        return (F.when(F.col("words_y").isNull(), F.size(F.array_intersect("own", "ids_y")))
                .when(F.col("words").isNotNull(), F.aggregate(anded, F.lit(0), lambda s, n: s + n))
                .otherwise(F.size(F.filter("own_ranks", self._bit))))

    # ------------------------------------------------------------- questions
    def friend_rows(self) -> DataFrame:
        """``(u, v, friend_id)``, a row for each pair and mutual friend."""
        return self.meetings().select(*_ordered(), F.explode(self._found()).alias("friend_id"))

    def mutual_friends(self) -> DataFrame:
        """E1: the same, and a row with NULL for a pair that shares nobody."""
        met = self.meetings()
        if not self.cut:
            return met.select(*_ordered(), F.explode_outer(self._found()).alias("friend_id"))
        # a pair that meets in one part is settled there; of the others those without any friend are counted
        one = met.where("NOT parted").select(*_ordered(), F.explode_outer(self._found()).alias("friend_id"))
        many = met.where("parted")
        none = _summed(many.select("x", "y", self._count().alias("n"))).where("n_mutual = 0").select("u", "v", F.lit(None).cast("bigint").alias("friend_id"))
        return one.unionByName(many.select(*_ordered(), F.explode(self._found()).alias("friend_id"))).unionByName(none)

    def counts(self, least: Column | None = None, only: DataFrame | None = None) -> DataFrame:
        """E2a: ``(u, v, n_mutual)`` of every befriended pair, 0 included."""
        met = self.meetings(least, only)
        if not self.cut:  # a pair meets once
            return met.select(*_ordered(), self._count().cast("bigint").alias("n_mutual"))
        return _summed(met.select("x", "y", self._count().alias("n")))

    def threshold(self, k: int) -> Column:
        """A number that at least k pairs reach, or 0: the k-th count among
        the pairs with the largest bounds, as a scalar subquery."""
        first = self.pairs().orderBy(F.col("bound").desc(), "x", "y").limit(max(FIRST, 4 * k))
        kth = self.counts(only=first).orderBy(F.col("n_mutual").desc()).limit(k).agg(F.min("n_mutual").alias("t"), F.count(F.lit(1)).alias("n"))
        return kth.select(F.when(F.col("n") == k, F.col("t")).otherwise(F.lit(0))).scalar()

    def top_pairs(self, k: int) -> DataFrame:
        """E2: the k pairs with most mutual friends, ties by u, then v. Only
        pairs whose bound reaches ``threshold`` are counted: no other can be
        among the first k, ties included."""
        order = [F.col("n_mutual").desc(), F.col("u").asc(), F.col("v").asc()]
        return self.counts(least=self.threshold(k) if k else None).orderBy(*order).limit(k)


def _ordered() -> list[Column]:
    return [F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")]


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("x", "y").agg(F.sum("n").cast("bigint").alias("n_mutual")).select(*_ordered(), "n_mutual")


# ------------------------------------------------------------------ building

def _ranked(users: DataFrame, path: str) -> DataFrame:
    """``users`` with a dense ``rank`` from 0 in the order of (degree, id):
    sorted ranges are written, and each adds its size to the ranks behind it."""
    order = ["degree", "user_id"]
    spark, row_bits = users.sparkSession, 33  # Spark's own numbering: partition, then row
    users.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    ranged = spark.read.parquet(path).withColumn("range", F.shiftright("at", row_bits))
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    # a row a range: no more than there are partitions
    before = sizes.select("range", (F.sum("size").over(Window.orderBy("range")) - F.col("size")).alias("before"))
    rank = F.col("before") + F.col("at").bitwiseAND((1 << row_bits) - 1)
    return ranged.join(F.broadcast(before), "range").select("user_id", "degree", "listed", rank.alias("rank"))


def _oriented(fs: DataFrame, users: DataFrame, max_degree: int, floor_rows: int | None) -> DataFrame:
    """``(owner, degree, listed, id, id_degree, id_rank, on_list, bound)``: every
    friendship seen from both ends; ``bound`` only where the owner's rank is
    the lower one."""
    per_piece = pieces = None
    if max_degree > (FLOOR_ROWS if floor_rows is None else floor_rows):
        per_piece = piece_rows(users, "degree", floor_rows)
        pieces = hot_pieces(users, "user_id", "degree", rows=per_piece)

    def with_user(df: DataFrame, end: str) -> DataFrame:
        known = users.select(F.col("user_id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("degree", "listed", "rank")])
        if pieces is None:
            return df.join(known, end)
        spread = F.greatest(F.lit(1), F.ceil(F.col(f"degree_{end}") / per_piece).cast("int"))
        return lookup_join(df, known, end, pieces.withColumnRenamed("user_id", end), "inner", spread)

    both = with_user(with_user(fs, "u"), "v")
    u_owns = F.struct("degree_u", "u") < F.struct("degree_v", "v")
    # neither end is a mutual friend of the two
    bound = F.least(F.col("listed_u") - F.col("uv").cast("int"), F.col("listed_v") - F.col("vu").cast("int"))

    def seen(a: str, b: str, on_list: str, owns: Column) -> Column:
        return F.struct(F.col(a).alias("owner"), F.col(f"degree_{a}").alias("degree"), F.col(f"listed_{a}").alias("listed"), F.col(b).alias("id"),
                        F.col(f"degree_{b}").alias("id_degree"), F.col(f"rank_{b}").alias("id_rank"), F.col(on_list).alias("on_list"),
                        F.when(owns, bound).alias("bound"))

    return both.select(F.explode(F.array(seen("u", "v", "uv", u_owns), seen("v", "u", "vu", ~u_owns))).alias("e")).select("e.*")


def _target() -> Column:
    return F.collect_list(F.when(F.col("bound").isNotNull(), F.struct(F.col("id").alias("y"), F.col("id_degree").alias("degree"), "bound"))).alias("targets")


def _cut_lists(seen: DataFrame, n_users: int, whole: int) -> DataFrame:
    """The rows of the lists with more than ``whole`` friends: their parts, and
    each part again with the pairs the user owns."""
    long = seen.where(F.col("degree") > whole)
    user = ["owner", "degree", "listed"]
    part = _part_of(F.col("id"), F.col("id_rank"), F.col("degree"), n_users, whole)
    listed = long.where("on_list").select(*user, part.alias("part"), F.struct("id_rank", "id").alias("friend"))
    # part 0 is there for every user: a pair without common parts meets in it
    marks = long.select(*user, F.lit(0).alias("part"), F.lit(None).cast(listed.schema["friend"].dataType).alias("friend")).distinct()
    parts = listed.unionByName(marks).groupBy(*user, "part").agg(F.array_sort(F.collect_list("friend")).alias("friends"))
    parts = parts.select(*user, "part", F.col("friends.id").alias("ids"), F.col("friends.id_rank").alias("ranks"))
    # bits set in a word, then the words of a part
    bits = parts.where(_dense(F.col("degree"), n_users, whole)).select("owner", "part", F.explode("ranks").alias("r"))
    word = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("r") % 64).cast("int")))
    words = bits.groupBy("owner", "part", F.floor((F.col("r") % SPAN) / 64).cast("int").alias("w")).agg(word.alias("bits"))
    words = words.groupBy("owner", "part").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("m"))
    none = F.lit(0).cast("bigint")
    full = F.transform(F.sequence(F.lit(0), F.lit(SPAN // 64 - 1)), lambda i: F.coalesce(F.element_at("m", i), none))
    empty = F.when(_dense(F.col("degree"), n_users, whole), F.array_repeat(none, SPAN // 64))
    parts = parts.join(words.select("owner", "part", full.alias("full")), ["owner", "part"], "left") \
        .select(*user, "part", "ids", "ranks", F.coalesce("full", empty).alias("words"))
    row = F.pmod(F.xxhash64("id"), F.ceil(F.col("degree") / F.lit(OWNED))).cast("int")
    owned = long.where("bound IS NOT NULL").groupBy("owner", row.alias("row")).agg(_target()).select("owner", "targets")
    primary = parts.select("*", F.lit(True).alias("primary"), F.array().cast(owned.schema["targets"].dataType).alias("targets"))
    return primary.unionByName(parts.join(owned, "owner").withColumn("primary", F.lit(False)))


def write_friend_index(edges: DataFrame, path: str, whole: int = WHOLE, floor_rows: int | None = None) -> FriendIndex:
    """Derive the index from ``edges(src, dst)`` (distinct) and write it under
    ``path``, which must not exist; returns it as ``read_friend_index`` does.
    ``floor_rows``: rows of a user from which joins split it (``skew``)."""
    spark, ends = edges.sparkSession, F.explode(F.array(F.struct(F.col("u").alias("user_id"), F.col("uv").alias("lists")),
                                                        F.struct(F.col("v").alias("user_id"), F.col("vu").alias("lists"))))
    friendships(edges).write.parquet(f"{path}/friendships")
    fs = spark.read.parquet(f"{path}/friendships")
    fs.select(ends.alias("e")).groupBy(F.col("e.user_id").alias("user_id")) \
        .agg(F.count(F.lit(1)).alias("degree"), F.sum(F.col("e.lists").cast("bigint")).alias("listed")).write.parquet(f"{path}/degrees")
    users = spark.read.parquet(f"{path}/degrees")
    n_users, max_degree = users.agg(F.count(F.lit(1)), F.coalesce(F.max("degree"), F.lit(0))).head()
    # ranks number the bits of bitmaps; where every list is one row nothing needs them
    users = _ranked(users, f"{path}/ranges") if max_degree > whole else users.withColumn("rank", F.lit(None).cast("bigint"))
    users.write.parquet(f"{path}/users")
    seen = _oriented(fs, spark.read.parquet(f"{path}/users"), max_degree, floor_rows)
    lists = seen.where(F.col("degree") <= whole).groupBy("owner", "degree", "listed").agg(
        F.collect_list(F.when(F.col("on_list"), F.col("id"))).alias("ids"),
        F.collect_list(F.when(F.col("on_list"), F.col("id_rank"))).alias("ranks"), _target())
    lists = lists.select("owner", "degree", "listed", F.lit(0).alias("part"), "ids", "ranks", F.lit(None).cast("array<bigint>").alias("words"),
                         F.lit(True).alias("primary"), "targets")
    if max_degree > whole:
        lists = lists.unionByName(_cut_lists(seen, n_users, whole))
    # a user's list is found by the Bloom filters of the row groups
    lists.sortWithinPartitions("owner", "part").write.option("parquet.bloom.filter.enabled#owner", "true").parquet(f"{path}/lists")
    spark.range(1).select(F.lit(n_users).alias("n_users"), F.lit(max_degree).alias("max_degree"), F.lit(whole).alias("whole")) \
        .write.parquet(f"{path}/meta")
    return read_friend_index(spark, path)


def read_friend_index(spark: SparkSession, path: str) -> FriendIndex:
    """The index that ``write_friend_index`` wrote under ``path``."""
    meta = spark.read.parquet(f"{path}/meta").head()
    return FriendIndex(spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/lists"), meta.n_users, meta.max_degree, meta.whole)
