"""DuckDB SQL twins of the registered queries (the correctness oracle).

The stand-in tables of ``amity.plans.standin`` are spelled out as CTEs over
the driver's pre-registered views; each query below is plain SQL over them,
written the straightforward way (joins and GROUP BY, no orientation tricks),
so that it checks the Spark plans rather than repeating them.
"""

from __future__ import annotations

from amity.plans.standin import AS_OF, FRIEND_REACH, HUBS, NEEDLE, TOP_K

STANDIN_CTES = f"""
o_ AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders),
near_ AS (SELECT a.c AS c1, b.c AS c2 FROM (SELECT c, k + unnest(range(1, {FRIEND_REACH} + 1)) AS nk FROM o_) a
          JOIN o_ b ON b.k = a.nk),
edges AS (SELECT c1 AS src, c2 AS dst FROM near_ WHERE c1 <> c2
          UNION SELECT c2 AS src, c1 AS dst FROM near_ WHERE c1 <> c2),
pairs AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM edges),
mrows AS (SELECT p.u, p.v, a.dst AS friend_id
          FROM pairs p JOIN edges a ON a.src = p.u
                       JOIN edges b ON b.src = p.v AND b.dst = a.dst),
mcounts AS (SELECT p.u, p.v, CAST(count(m.friend_id) AS BIGINT) AS n_mutual
            FROM pairs p LEFT JOIN mrows m ON m.u = p.u AND m.v = p.v GROUP BY p.u, p.v),
first_order_ AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS dob FROM orders GROUP BY o_custkey),
profiles AS (SELECT c.c_custkey AS user_id, c.c_name AS first_name, c.c_mktsegment AS last_name,
                    c.c_name AS address, n.n_name AS city, r.r_name AS state,
                    strftime(f.dob, '%-m/%-d/%Y') AS dob_text, f.dob
             FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                             LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
                             LEFT JOIN first_order_ f ON f.o_custkey = c.c_custkey),
ages AS (SELECT user_id, CAST(year(DATE '{AS_OF}') - year(dob)
                  - CASE WHEN month(DATE '{AS_OF}') < month(dob)
                           OR (month(DATE '{AS_OF}') = month(dob) AND day(DATE '{AS_OF}') < day(dob))
                         THEN 1 ELSE 0 END AS INTEGER) AS age
         FROM profiles),
friend_age AS (SELECT e.src AS user_id, max(a.age) AS max_friend_age
               FROM edges e LEFT JOIN ages a ON a.user_id = e.dst GROUP BY e.src),
business AS (SELECT p_partkey AS business_id, p_name AS full_address, p_type AS categories FROM part),
reviews AS (SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS review_id,
                   o.o_custkey AS user_id, l.l_partkey AS business_id, CAST(l.l_quantity AS DOUBLE) AS stars
            FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)
"""


# the harder graph and the uneven profiles, under the same names
DIRECTED_EDGES = """
edges AS (SELECT c1 AS src, c2 AS dst FROM near_ WHERE c1 <> c2
          UNION SELECT src, dst FROM fans_ WHERE src <> dst
          UNION SELECT dst AS src, src AS dst FROM fans_ WHERE src <> dst AND src % 6 = 0),"""
FANS = f"""
fans_ AS (SELECT c_custkey AS src, c_custkey // 2 % {HUBS} + 1 AS dst FROM customer WHERE c_custkey % 2 = 0),"""


def with_standin(body: str) -> str:
    return "WITH " + STANDIN_CTES.strip() + "\n" + body.strip()


def with_directed(body: str) -> str:
    start, end = STANDIN_CTES.index("edges AS"), STANDIN_CTES.index("pairs AS")
    ctes = STANDIN_CTES[:start].strip() + FANS + DIRECTED_EDGES + "\n" + STANDIN_CTES[end:]
    return "WITH " + ctes.replace(
        "ON f.o_custkey = c.c_custkey)", "ON f.o_custkey = c.c_custkey WHERE c.c_custkey % 7 <> 0)") + "\n" + body.strip()


def profile_pair_body(a: int, b: int) -> str:
    lo, hi = min(a, b), max(a, b)
    return f"""
SELECT CAST({lo} AS BIGINT) AS u, CAST({hi} AS BIGINT) AS v, x.dst AS friend_id,
       p.first_name, p.dob_text AS dob
FROM edges x JOIN edges y ON y.src = {hi} AND y.dst = x.dst
     LEFT JOIN profiles p ON p.user_id = x.dst
WHERE x.src = {lo}
  AND EXISTS (SELECT 1 FROM edges e WHERE (e.src = {lo} AND e.dst = {hi}) OR (e.src = {hi} AND e.dst = {lo}))
"""


MUTUAL = """
SELECT u, v, friend_id FROM mrows
UNION ALL
SELECT p.u, p.v, CAST(NULL AS BIGINT) AS friend_id FROM pairs p
WHERE NOT EXISTS (SELECT 1 FROM mrows m WHERE m.u = p.u AND m.v = p.v)"""
NAMED = f"""
SELECT t.n_mutual, t.u, t.v,
       pu.first_name AS first_u, pu.last_name AS last_u, pu.address AS address_u,
       pv.first_name AS first_v, pv.last_name AS last_v, pv.address AS address_v
FROM (SELECT u, v, n_mutual FROM mcounts ORDER BY n_mutual DESC, u, v LIMIT {TOP_K}) t
     LEFT JOIN profiles pu ON pu.user_id = t.u
     LEFT JOIN profiles pv ON pv.user_id = t.v"""
BRANDS = f"""
SELECT b.p_brand AS business_id, string_agg(DISTINCT b.p_type, '%s' ORDER BY b.p_type) AS categories,
       CAST(b.p_size % 3 AS VARCHAR) AS full_address, s.avg_stars
FROM part b JOIN (SELECT p.p_brand, round(avg(r.stars), 6) AS avg_stars, avg(r.stars) AS exact
                  FROM reviews r JOIN part p ON p.p_partkey = r.business_id GROUP BY p.p_brand) s ON s.p_brand = b.p_brand
GROUP BY b.p_brand, b.p_size % 3, s.avg_stars, s.exact
ORDER BY s.exact DESC NULLS LAST, b.p_brand, full_address LIMIT {TOP_K}
"""


def brands_sql(sep: str) -> str:
    # the only per cent sign to fill is the separator's
    return with_standin(BRANDS.replace("'%s'", f"'{sep}'"))


def shown(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'null')"


E7_SQL = with_standin(f"""
SELECT b.business_id,
       string_agg(DISTINCT b.categories, '|' ORDER BY b.categories) AS categories,
       b.full_address,
       round(avg(r.stars), 6) AS avg_stars
FROM business b JOIN reviews r ON b.business_id = r.business_id
GROUP BY b.business_id, b.full_address
ORDER BY avg(r.stars) DESC NULLS LAST, b.business_id, b.full_address
LIMIT {TOP_K}
""")


E7_TEXT_SQL = with_standin(f"""
SELECT CAST(b.business_id AS VARCHAR) AS business_id,
       string_agg(DISTINCT b.categories, '|' ORDER BY b.categories) AS categories,
       b.full_address,
       round(avg(r.stars), 6) AS avg_stars
FROM business b JOIN reviews r ON b.business_id = r.business_id
GROUP BY b.business_id, b.full_address
ORDER BY avg(r.stars) DESC NULLS LAST, CAST(b.business_id AS VARCHAR), b.full_address
LIMIT {TOP_K}
""")


E5 = f"""
SELECT t.user_id, p.address, p.city, p.state, t.max_friend_age
FROM (SELECT user_id, max_friend_age FROM friend_age WHERE max_friend_age IS NOT NULL
      ORDER BY max_friend_age DESC, user_id LIMIT {TOP_K}) t
     LEFT JOIN profiles p ON p.user_id = t.user_id"""
E6 = f"""
SELECT DISTINCT {{user}} AS user_id, r.stars
FROM business b JOIN reviews r ON b.business_id = r.business_id
WHERE contains(b.full_address, '{NEEDLE}')"""
AGES = "SELECT user_id, max_friend_age FROM friend_age"
COUNTS = "SELECT u, v, n_mutual FROM mcounts"
TOP = f"SELECT u, v, n_mutual FROM mcounts ORDER BY n_mutual DESC, u, v LIMIT {TOP_K}"

REJECTS = {
    "rejects_friends": """
SELECT o_custkey || chr(9) || '1,x,2,,y' AS line, 'id' AS reason, 'x||y' AS bad FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT o_custkey || chr(9) || '1' || chr(9) || 'extra', 'arity', '' FROM orders WHERE o_orderkey % 10 = 1
UNION ALL SELECT 'u' || chr(9) || '1,2', 'id', 'u' FROM orders WHERE o_orderkey % 10 = 2""",
    "rejects_profiles": """
SELECT c_custkey || ',' || c_name AS line, 'arity' AS reason, '' AS bad FROM customer WHERE c_custkey % 10 = 0
UNION ALL SELECT 'id' || c_custkey || ',' || c_name || ',a,b,c,d,e,f,g,1/1/1990', 'id', 'id' || c_custkey
FROM customer WHERE c_custkey % 10 = 1""",
    "rejects_business": """
SELECT p_partkey || '::' || p_name || '::' || p_name || '::' || p_type AS line, 'arity' AS reason, '' AS bad
FROM part WHERE p_partkey % 10 = 0
UNION ALL SELECT p_partkey || '::' || p_name, 'arity', '' FROM part WHERE p_partkey % 10 = 1""",
    "rejects_reviews": """
SELECT l_orderkey * 10 + l_linenumber || '::u::' || l_partkey || '::many' AS line, 'stars' AS reason, 'many' AS bad
FROM lineitem WHERE (l_orderkey * 10 + l_linenumber) % 10 = 1
UNION ALL SELECT l_orderkey * 10 + l_linenumber || '::u::' || l_partkey, 'arity', ''
FROM lineitem WHERE (l_orderkey * 10 + l_linenumber) % 10 = 2""",
}


def oracle_queries(profile_pair: tuple[int, int], directed_pair: tuple[int, int]) -> dict[str, str]:
    pair = profile_pair_body(*profile_pair)
    named = " || chr(9) || ".join(shown(c) for c in ("n_mutual", "first_u", "last_u", "address_u", "first_v", "last_v", "address_v"))
    e5_line = f"{shown('user_id')} || chr(9) || " + " || ',' || ".join(shown(c) for c in ("address", "city", "state", "max_friend_age"))
    return {
        "friend_edges": with_standin("SELECT src, dst FROM edges"),
        "friend_pairs": with_standin("SELECT u, v FROM pairs"),
        "mutual_friends": with_standin(MUTUAL),
        "mutual_friend_counts": with_standin(COUNTS),
        "top_mutual_pairs": with_standin(TOP),
        "top_mutual_pairs_named": with_standin(NAMED),
        "mutual_friend_profiles": with_standin(pair),
        "max_friend_age": with_standin(AGES),
        "oldest_friend_top": with_standin(E5),
        "ratings_by_address": with_standin(E6.format(user="r.user_id")),
        "top_rated_businesses": E7_SQL,
        "top_rated_businesses_sql": E7_SQL,
        # text readers: ids come back as text from the business / review files
        "friend_edges_from_files": with_standin("SELECT src, dst FROM edges"),
        "oldest_friend_top_from_files": with_standin(E5),
        "ratings_by_address_from_files": with_standin(E6.format(user="CAST(r.user_id AS VARCHAR)")),
        "top_rated_businesses_from_files": E7_TEXT_SQL,
        "mutual_friends_directed": with_directed(MUTUAL),
        "mutual_friend_counts_directed": with_directed(COUNTS),
        "mutual_friend_profiles_directed": with_directed(profile_pair_body(*directed_pair)),
        "max_friend_age_directed": with_directed(AGES),
        "top_rated_brands": brands_sql("|"),
        "top_rated_brands_sql": brands_sql("|"),
        "mutual_friends_indexed": with_directed(MUTUAL),
        "mutual_friend_counts_indexed": with_directed(COUNTS),
        "top_mutual_pairs_indexed": with_directed(TOP),
        "mutual_friend_profiles_stored": with_standin(pair),
        "max_friend_age_bucketed": with_standin(AGES),
        "oldest_friend_top_early": with_directed(E5),
        "ratings_by_address_prefiltered": with_standin(E6.format(user="r.user_id")),
        "single_file_top_rated": with_standin(f"""
SELECT '[' || business_id || ',' || categories || ',' || full_address || ',' || avg_stars || ']' AS value, 0 AS file
FROM ({E7_SQL})"""),
        "ordered_files_counts": with_standin(f"SELECT u || chr(9) || v || chr(9) || n_mutual AS value FROM ({COUNTS})"),
        **REJECTS,
        "lines_mutual_friends": with_standin(f"""
SELECT u || chr(9) || v || chr(9) || coalesce(string_agg(CAST(friend_id AS VARCHAR), ',' ORDER BY friend_id), '') AS value
FROM ({MUTUAL}) GROUP BY u, v"""),
        "lines_pair_counts": with_standin(f"SELECT u || ',' || v || chr(9) || n_mutual AS value FROM ({TOP})"),
        "lines_named_pairs": with_standin(f"SELECT {named} AS value FROM ({NAMED})"),
        "lines_pair_profiles": with_standin(f"""
SELECT u || ',' || v || chr(9) || '[' || string_agg(e, ', ' ORDER BY e) || ']' AS value
FROM (SELECT u, v, {shown('first_name')} || ':' || {shown('dob')} AS e FROM ({pair})) GROUP BY u, v"""),
        "lines_oldest_friend": with_standin(f"SELECT {e5_line} AS value FROM ({E5})"),
        "lines_ratings": with_standin(f"SELECT '[' || user_id || ',' || stars || ']' AS value FROM ({E6.format(user='r.user_id')})"),
        "lines_top_rated": _brand_lines(),
    }


def _brand_lines() -> str:
    body = BRANDS.replace("'%s'", "', '")
    return with_standin(f"SELECT '[' || business_id || ',[' || categories || '],' || full_address || ',' || avg_stars || ']' AS value FROM ({body})")
