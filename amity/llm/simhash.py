"""SimHash near-duplicates through a Gray-ordered hierarchical index.

1. *Fingerprints.* Every whole text becomes 64 bits: a bit is set if it is set
   in more than half the XXH64 hashes of its word shingles. Equal fingerprints
   collapse to one class right away (``min(doc_id)``, aggregated map-side), so
   thousands of copies are one row from there on.
2. *Buckets.* Two fingerprints within ``max_bits`` agree on at least
   ``parts - max_bits`` of ``parts`` bit segments (pigeonhole). Each class is
   listed once for every choice of that many segments; only classes in one
   bucket can link, and every link is in some bucket: the search is exact.
   ``parts`` follows the number of classes, so a bucket's expected size stays
   small at every input size; a larger bucket is split into blocks and the
   blocks meet in pairs, so no task holds more than two blocks of it.
3. *Index.* A bucket is sorted by Gray rank, so neighbours share most bits.
   Groups of ``FAN`` neighbours form a node with the pattern of bits they all
   share; groups of nodes form upper nodes, up to one root a bucket, whose own
   pattern holds the segments all members share. Two subtrees are compared by
   the bits their patterns add to those already compared above: once the
   accumulated differences exceed ``max_bits`` the whole pair of groups goes,
   and once they cannot exceed it any more the whole pair links unseen.
4. *Components.* A bucket returns a forest of its links (fewer edges than
   classes), never its pairs; the forests meet in ``components``.

Defined results: a NULL or empty text has fingerprint zero and links like any
other; a NULL doc_id takes part and gets its component, but never names one (a
component of NULL ids only has component_id NULL); repeated rows stay and
share a component; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from amity.llm.components import components
from amity.llm.tables import col_ref, free_name, read_table, written

SHINGLE, MAX_BITS, SEED = 4, 4, 42  # fixed values of the contract
FAN = 16          # children of an index node
BLOCK = 8192      # classes of a bucket that one task compares with as many others
CHUNK = 1 << 18   # classes a task indexes at once, and group pairs it expands at once
STEP = 1 << 16    # shingles hashed at once
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of one text, unsigned."""
    words = (text or b"").lower().split()  # on bytes both are ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True)
    n, ones, digest = len(words) - k + 1, np.zeros(64, np.int64), xxhash.xxh64_digest
    for _ in range(0, n, STEP):
        part = b"".join([digest(line[s:e], seed) for s, e in (x for _, x in zip(range(STEP), spans))])
        ones += np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """The fingerprint as a signed bigint of the same 64 bits."""
    @pandas_udf("bigint")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64))

    return fp(text.cast("string").cast("binary"))


def gray_rank(c: Column) -> Column:
    """Rank of a 64-bit code in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, shift))
    return c


def _levels(codes: np.ndarray, units: np.ndarray) -> list[tuple]:
    """The index from leaves to roots: (pattern, mask, first child, end) a level.
    ``units`` is sorted; a node never spans two units."""
    pat, mask, unit = codes, np.full(len(codes), FULL), units
    levels = [(pat, mask, None, None)]
    while True:
        new = np.concatenate(([True], unit[1:] != unit[:-1]))
        if len(levels) > 1 and new.all():
            return levels
        place = np.arange(len(unit)) - np.maximum.accumulate(np.where(new, np.arange(len(unit)), 0))
        start = np.flatnonzero(new | (place % FAN == 0))
        both, some = np.bitwise_and.reduceat(pat, start), np.bitwise_or.reduceat(pat, start)
        mask = np.bitwise_and.reduceat(mask, start) & ~(both ^ some)
        pat, unit = both & mask, unit[start]
        levels.append((pat, mask, start, np.append(start[1:], place.size)))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + size[0] - 1, start[1] .. and so on."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes, the smallest node it reaches over edges a-b."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root != (up := root[root])).any():
            root = up


def links(codes: np.ndarray, units: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """For each code, the first one of its unit that it reaches over links of
    at most ``max_bits`` differing bits. Both arrays sorted by unit, then by
    Gray rank."""
    n, levels = len(codes), _levels(codes, units)
    # leaves below each node, for groups that link as a whole
    spans = [(np.arange(n), np.arange(n) + 1)]
    for _, _, first, end in levels[1:]:
        spans.append((spans[-1][0][first], spans[-1][1][end - 1]))
    top = len(levels) - 1
    roots = np.arange(len(levels[top][0]))
    root, todo = np.arange(n), [(top, roots, roots, np.zeros(len(roots), np.uint8))]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    while todo:
        level, a, b, acc = todo.pop()
        if len(a) > CHUNK // FAN and level:
            todo.append((level, a[CHUNK // FAN:], b[CHUNK // FAN:], acc[CHUNK // FAN:]))
            a, b, acc = a[:CHUNK // FAN], b[:CHUNK // FAN], acc[:CHUNK // FAN]
        pat, mask = levels[level][:2]
        open_bits = np.bitwise_count(~(mask[a] & mask[b]))
        sure = acc + open_bits <= max_bits  # no two members can differ in more
        first, end = spans[level]
        x, y = a[sure], b[sure]
        found.append((_ranges(first[x], end[x] - first[x]), np.repeat(first[y], end[x] - first[x])))
        found.append((np.repeat(first[x], end[y] - first[y]), _ranges(first[y], end[y] - first[y])))
        held += len(found[-1][0]) + len(found[-2][0])
        a, b, acc = a[~sure], b[~sure], acc[~sure]
        if level and len(a):
            kid, end_kid = levels[level][2:]
            na, nb = end_kid[a] - kid[a], end_kid[b] - kid[b]
            parent = np.repeat(np.arange(len(a)), na)
            ca = _ranges(kid[a], na)
            reps = nb[parent]
            ca, parent = np.repeat(ca, reps), np.repeat(parent, reps)
            cb = _ranges(kid[b][np.repeat(np.arange(len(a)), na)], reps)
            ahead = (a[parent] != b[parent]) | (ca <= cb)
            ca, cb, parent = ca[ahead], cb[ahead], parent[ahead]
            p2, m2 = levels[level - 1][:2]
            seen = mask[a[parent]] & mask[b[parent]]
            more = np.bitwise_count((p2[ca] ^ p2[cb]) & m2[ca] & m2[cb] & ~seen)
            acc2 = acc[parent] + more
            near = acc2 <= max_bits
            todo.append((level - 1, ca[near], cb[near], acc2[near]))
        if held > CHUNK or not todo:
            root = _forest(n, np.concatenate([np.arange(n), *(f[0] for f in found)]),
                           np.concatenate([root, *(f[1] for f in found)]))
            found, held = [], 0
    return root


def _bucket_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Forest edges of the buckets of one task, read in (unit, Gray) order."""
    held: list[pa.Table] = []

    def solve(t: pa.Table) -> pa.RecordBatch:
        units = t["unit"].to_numpy()
        lo = t["lo"].to_numpy()
        codes = t["fp"].to_numpy().view(np.uint64)
        edge = np.concatenate(([True], (units[1:] != units[:-1]) | (lo[1:] != lo[:-1])))
        root = links(codes, np.cumsum(edge), max_bits)
        linked = root != np.arange(len(root))
        signed = codes.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[linked]), pa.array(signed[root[linked]])], ["a", "b"])

    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) >= CHUNK:
            t = pa.concat_tables(held).combine_chunks()
            units, lo = t["unit"].to_numpy(), t["lo"].to_numpy()
            cut = np.flatnonzero((units[1:] != units[:-1]) | (lo[1:] != lo[:-1]))
            if len(cut):  # the last bucket may go on
                yield solve(t.slice(0, cut[-1] + 1))
                t = t.slice(cut[-1] + 1)
            held = [t]
    if held:
        yield solve(pa.concat_tables(held).combine_chunks())


def _parts(classes: int, max_bits: int) -> int:
    """The fewest segments whose buckets are expected to hold under 128 classes."""
    for parts in range(max_bits + 1, max_bits + 5):
        bits = 64 * (parts - max_bits) // parts
        if classes <= 128 << bits:
            break
    return parts


def fingerprint_links(classes: DataFrame, max_bits: int = MAX_BITS, parts: int | None = None,
                      block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` between the distinct fingerprints in ``classes.fp``
    that connect exactly those reachable over links of ``max_bits`` bits."""
    parts = parts or _parts(classes.count(), max_bits)
    cuts = [64 * k // parts for k in range(parts + 1)]
    keys = []
    for chosen in combinations(range(parts), parts - max_bits):
        mask = sum(((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in chosen)
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(len(keys)), F.col("fp").bitwiseAND(F.lit(mask))))
    # two buckets under one 64-bit name only mean a few needless comparisons
    listed = classes.select("fp", F.explode(F.array(*keys)).alias("unit"))
    large = written(listed.groupBy("unit").count().where(F.col("count") > block)
                    .select("unit", F.ceil(F.col("count") / block).cast("int").alias("p")), "large-buckets")
    listed = listed.withColumn("lo", F.lit(0))
    if large.head(1):
        own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("p")).cast("int")
        pairs = F.transform(F.filter(F.sequence(F.lit(0), F.col("p") - 1), lambda j: j != F.col("own")),
                            lambda j: F.least("own", j) * F.col("p") + F.greatest("own", j))
        split = listed.drop("lo").join(large, "unit", "left").withColumn("own", own)
        # block numbers stay far below 2**15, so a pair fits an int
        listed = split.select("fp", "unit", F.explode(F.when(F.col("p").isNull(), F.array(F.lit(0)))
                                                      .otherwise(pairs)).alias("lo"))
    rows = (listed.withColumn("gray", gray_rank(F.col("fp")))
            .repartition("unit", "lo").sortWithinPartitions("unit", "lo", "gray").select("unit", "lo", "fp"))
    return rows.mapInArrow(lambda it: _bucket_links(it, max_bits), "a bigint, b bigint")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                   max_bits: int = MAX_BITS, parts: int | None = None, block: int = BLOCK) -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)`` for every row of
    ``docs``. ``root`` names the component even where ``component_id``, its
    smallest doc_id, is NULL; ``text_hash`` tells rows of one doc_id apart."""
    value = F.col(col_ref(text)).cast("string")
    prints = written(docs.select(F.col(col_ref(doc_id)).alias("doc_id"), F.xxhash64(value).alias("text_hash"),
                                 fingerprint_column(value, shingle).alias("fp")), "simhash")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    labels = written(components(fingerprint_links(classes, max_bits, parts, block)), "simhash-labels")
    rooted = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-named")
    lookup = written(rooted.select("fp", "root").join(named, "root"), "simhash-lookup")
    return prints.join(lookup, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` less all but one document of each group: the one
    with the smallest doc_id stays (NULLs last; of several texts under it one;
    of fully repeated rows one, the smallest by all columns)."""
    groups = simhash_groups(docs, doc_id, text, **how)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = groups.groupBy("root").agg(F.min(order).alias("m")).select("m.doc_id", "m.text_hash")
    copies = groups.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    keep = written(best.alias("x").join(copies.alias("y"), F.expr("x.doc_id <=> y.doc_id AND x.text_hash = y.text_hash"))
                   .select(F.col("x.doc_id").alias("_k_id"), F.col("x.text_hash").alias("_k_hash"),
                           F.col("copies").alias("_k_copies")), "simhash-keep")
    names = {c: free_name(docs, c) for c in keep.columns}
    keep = keep.select(*[F.col(c).alias(n) for c, n in names.items()])
    same = F.col(col_ref(doc_id)).eqNullSafe(F.col(names["_k_id"])) \
        & (F.xxhash64(F.col(col_ref(text)).cast("string")) == F.col(names["_k_hash"]))
    kept = docs.join(keep, same)
    cols = [F.col(col_ref(c)) for c in docs.columns]
    once = kept.where(F.col(names["_k_copies"]) == 1).select(*cols)
    if not keep.where(F.col(names["_k_copies"]) > 1).head(1):
        return once
    fold = kept.where(F.col(names["_k_copies"]) > 1).groupBy(names["_k_id"], names["_k_hash"]) \
        .agg(F.min(F.struct(*cols)).alias("row")).select("row.*")
    return once.unionByName(fold)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return simhash_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                       "component_id")


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each SimHash group stays."""
    return keep_one_per_group(docs)


QUERIES = {"op2_simhash_near_dedup": op2_simhash_near_dedup}
SQL: dict[str, str] = {}
