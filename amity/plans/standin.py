"""Stand-in inputs derived from the driver's TPC-H-like parquet tables.

The driver ships no friends / userdata / business / review files, so the
registered queries run on tables Spark derives from the given ones; every
definition here has a DuckDB twin in ``amity.plans.oracle`` and grows
linearly with the data:

* friendship: customers whose orders lie 1 to ``FRIEND_REACH`` apart in
  order-key order are friends (both directions). One equi-join of orders
  with itself on ``o_orderkey = k + d``; no group is ever paired with itself.
* ``friend_lines``: the same graph as adjacency text, one line per order:
  ``custkey<TAB>customers of the neighbouring orders`` -- it feeds the text
  parser, so the parser is checked against the oracle too (several lines
  per user, repeats and self mentions all occur).
* profiles: customer + nation + region, birth date = first order date.
* business: part (id, name as address, type as category).
* reviews: lineitem + orders (the order's customer reviews the part,
  quantity as stars).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.functions.columns import DOB_PATTERN
from amity.session import scratch_path, write_text_lines
from amity.sources.text import first_profile_per_user, parse_friend_lines

# Fixed values of the stand-in (must equal the oracle SQL's).
FRIEND_REACH = 3          # orders k and k+1..k+3 make their customers friends
AS_OF = "2024-01-01"      # date ages are computed on
NEEDLE = "ring"           # address substring for ratings_by_address
TOP_K = 10
HUBS = 3                  # customers 1..HUBS are listed by every second customer


@dataclass
class StandIn:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    # ------------------------------------------------------------ friends
    def _neighbour_orders(self, offsets: list[int]) -> DataFrame:
        """(k, c1, d, c2): order k of customer c1 and the customer c2 of order
        k + d, for each offset d -- one equi-join on the shifted key."""
        o = self.table("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c1"))
        n = self.table("orders").select(F.col("o_orderkey").alias("nk"), F.col("o_custkey").alias("c2"))
        shifted = o.select("k", "c1", F.explode(F.array(*[F.lit(d) for d in offsets])).alias("d")) \
                   .withColumn("nk", F.col("k") + F.col("d"))
        return shifted.join(n, "nk").select("k", "c1", "d", "c2")

    def edges(self) -> DataFrame:
        """Directed friend edges ``(src, dst)``, both ways, distinct, no self edges."""
        near = self._neighbour_orders(list(range(1, FRIEND_REACH + 1)))
        # distinct unordered pairs first (half the rows), then both directions
        pairs = (near.where(F.col("c1") != F.col("c2"))
                 .select(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b"))
                 .distinct())
        both = F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
                                 F.struct(F.col("b").alias("src"), F.col("a").alias("dst"))))
        return pairs.select(both.alias("e")).select("e.src", "e.dst")

    def directed_edges(self) -> DataFrame:
        """The harder graph: order k's customer lists the customers of orders
        k+1 .. k+FRIEND_REACH and is not listed back, customers with an even
        key also list a hub of theirs (one of HUBS), and a hub lists those of
        them whose key is divisible by 6."""
        near = self._neighbour_orders(list(range(1, FRIEND_REACH + 1))).select(F.col("c1").alias("src"), F.col("c2").alias("dst"))
        fans = self.table("customer").where(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").alias("src"))
        fans = fans.select("src", (F.col("src") / 2 % HUBS + 1).cast("bigint").alias("dst"))
        back = fans.where(F.col("src") % 6 == 0).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        return near.unionByName(fans).unionByName(back).where(F.col("src") != F.col("dst")).distinct()

    def friend_lines(self) -> DataFrame:
        """Adjacency text ``value``: per order, its customer then the
        customers of the orders up to FRIEND_REACH before and after it."""
        offsets = [d for d in range(-FRIEND_REACH, FRIEND_REACH + 1) if d != 0]
        # at most 2 * FRIEND_REACH neighbours per order: a bounded group
        near = (self._neighbour_orders(offsets)
                .groupBy("k", "c1")
                .agg(F.array_sort(F.collect_list(F.struct("d", "c2"))).alias("nb")))
        friends = F.array_join(F.transform("nb", lambda s: s["c2"].cast("string")), ",")
        return near.select(F.concat_ws("\t", F.col("c1").cast("string"), friends).alias("value"))

    def parsed_edges(self) -> DataFrame:
        return parse_friend_lines(self.friend_lines()).edges

    # ----------------------------------------------------------- profiles
    def profiles(self) -> DataFrame:
        c = self.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        n = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.table("region").select("r_regionkey", "r_name")
        first = (self.table("orders").groupBy(F.col("o_custkey").alias("c_custkey"))
                 .agg(F.min("o_orderdate").cast("date").alias("dob")))
        j = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
              .join(r, n.n_regionkey == r.r_regionkey, "left")
              .join(first, "c_custkey", "left"))
        return j.select(F.col("c_custkey").alias("user_id"),
                        F.col("c_name").alias("first_name"),
                        F.col("c_mktsegment").alias("last_name"),
                        F.col("c_name").alias("address"),
                        F.col("n_name").alias("city"),
                        F.col("r_name").alias("state"),
                        F.date_format("dob", DOB_PATTERN).alias("dob_text"),
                        "dob")

    def uneven_profiles(self) -> DataFrame:
        """Profiles with gaps and repeats: every seventh customer has none,
        every eleventh a second one that is born 40 years earlier."""
        base = self.profiles().where(F.col("user_id") % 7 != 0)
        dob = F.add_months("dob", -480)
        second = base.where(F.col("user_id") % 11 == 0).withColumns({
            "first_name": F.concat(F.lit("Z"), "first_name"), "dob": dob, "dob_text": F.date_format(dob, DOB_PATTERN)})
        return first_profile_per_user(base.unionByName(second))

    # ------------------------------------------------------------ ratings
    def business(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("business_id"),
                                         F.col("p_name").alias("full_address"),
                                         F.col("p_type").alias("categories"))

    def brands(self) -> DataFrame:
        """Businesses with several categories and addresses each: part brands
        (address = size class, category = type)."""
        return self.table("part").select(F.col("p_brand").alias("business_id"), (F.col("p_size") % 3).cast("string").alias("full_address"),
                                         F.col("p_type").alias("categories"))

    def brand_reviews(self) -> DataFrame:
        part = self.table("part").select(F.col("p_partkey").alias("business_id"), F.col("p_brand").alias("brand"))
        return self.reviews().join(part, "business_id").select("review_id", "user_id", F.col("brand").alias("business_id"), "stars")

    def reviews(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
        o = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        return li.join(o, "l_orderkey").select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("review_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("business_id"),
            F.col("l_quantity").cast("double").alias("stars"))

    # ------------------------------------------------- text-file round trips
    def business_lines(self) -> DataFrame:
        """``business_id::full_address::categories`` text lines."""
        b = self.business()
        return b.select(_joined("::", "business_id", "full_address", "categories"))

    def review_lines(self) -> DataFrame:
        """``review_id::user_id::business_id::stars`` text lines."""
        return self.reviews().select(_joined("::", "review_id", "user_id", "business_id", "stars"))

    def profile_lines(self) -> DataFrame:
        """Comma userdata lines: id, first, last, address, city, state, three
        unused fields, birth date as M/d/yyyy."""
        p = self.profiles().withColumns({c: F.lit("-") for c in ("c6", "c7", "c8")})
        return p.select(_joined(",", "user_id", "first_name", "last_name", "address", "city", "state", "c6", "c7", "c8", "dob_text"))

    # lines with faults, a few in a hundred, derived from the same tables
    def faulty_lines(self, kind: str) -> DataFrame:
        """``(key, value)``: per order, customer, part or lineitem one line,
        some of them broken in the ways its reader must report."""
        if kind == "friends":
            o = self.table("orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").cast("string").alias("c"))
            value = (F.when(F.col("key") % 10 == 0, F.concat_ws("\t", "c", F.lit("1,x,2,,y")))
                     .when(F.col("key") % 10 == 1, F.concat_ws("\t", "c", F.lit("1"), F.lit("extra")))
                     .when(F.col("key") % 10 == 2, F.concat_ws("\t", F.lit("u"), F.lit("1,2")))
                     .when(F.col("key") % 10 == 3, F.col("c")).otherwise(F.concat_ws("\t", "c", F.lit("1,2,,"))))
            return o.select("key", value.alias("value"))
        if kind == "userdata":
            c = self.table("customer").select(F.col("c_custkey").alias("key"), F.col("c_custkey").cast("string").alias("c"), "c_name")
            tail = ",a,b,c,d,e,f,g,1/1/1990"
            value = (F.when(F.col("key") % 10 == 0, F.concat_ws(",", "c", "c_name"))
                     .when(F.col("key") % 10 == 1, F.concat(F.lit("id"), "c", F.lit(","), "c_name", F.lit(tail)))
                     .otherwise(F.concat("c", F.lit(","), "c_name", F.lit(tail + ",more"))))
            return c.select("key", value.alias("value"))
        if kind == "business":
            b = self.table("part").select(F.col("p_partkey").alias("key"), F.col("p_partkey").cast("string").alias("b"), "p_name", "p_type")
            value = (F.when(F.col("key") % 10 == 0, F.concat_ws("::", "b", "p_name", "p_name", "p_type"))
                     .when(F.col("key") % 10 == 1, F.concat_ws("::", "b", "p_name")).otherwise(F.concat_ws("::", "b", "p_name", "p_type")))
            return b.select("key", value.alias("value"))
        li = self.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), F.col("l_partkey").cast("string").alias("p"))
        value = (F.when(F.col("key") % 10 == 1, F.concat_ws("::", F.col("key").cast("string"), F.lit("u"), "p", F.lit("many")))
                 .when(F.col("key") % 10 == 2, F.concat_ws("::", F.col("key").cast("string"), F.lit("u"), "p"))
                 .otherwise(F.concat_ws("::", F.col("key").cast("string"), F.lit("u"), "p", F.lit("4.5"))))
        return li.select("key", value.alias("value"))

    def text_files(self, kind: str, faulty: bool = False) -> str:
        """Write the stand-in lines of ``kind`` (friends, business, reviews,
        userdata) as text files under the session's shared folder; returns
        the folder, to be read back with the library's text readers."""
        lines = {"friends": self.friend_lines, "business": self.business_lines,
                 "reviews": self.review_lines, "userdata": self.profile_lines}
        made = self.faulty_lines(kind) if faulty else lines[kind]()
        return write_text_lines(made, scratch_path(self.spark, kind))


def _joined(sep: str, *cols: str) -> Column:
    """Fields as one line; a NULL is an empty field, so places never shift."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("value")
