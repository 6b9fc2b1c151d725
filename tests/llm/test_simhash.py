"""SimHash near-duplicates against a brute-force comparison of all pairs."""

import os
import random
from itertools import combinations

import pytest
import xxhash

from amity.llm import simhash as S

DOCS = "doc_id bigint, text string, Extra string, fp string"


def brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=4):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if bin(prints[i] ^ prints[j]).count("1") <= bits:
            root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("flips,n", [(3, 700), (12, 700), (40, 1500)])
def test_index_links_equal_all_pairs(flips, n):
    import numpy as np

    rnd = random.Random(flips)
    centres = [rnd.getrandbits(64) for _ in range(5)]
    codes = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, flips))) for c in rnd.choices(centres, k=n)}

    def rank(c):
        for s in (1, 2, 4, 8, 16, 32):
            c ^= c >> s
        return c

    codes = sorted(codes, key=rank)
    got = S.links(np.array(codes, np.uint64), np.zeros(len(codes), np.int64))
    assert got.tolist() == brute_components(codes)


def make_docs():
    rnd = random.Random(5)
    vocab = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    rows, base = [], [[rnd.choice(vocab) for _ in range(rnd.randint(1, 300))] for _ in range(60)]
    for k in range(400):
        words = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 30])):
            words[rnd.randrange(len(words))] = rnd.choice(vocab)
        rows.append((1000 - k, rnd.choice([" ", "\n", "\t "]).join(words), "x", "y"))
    rows += [(None, "", "x", "y"), (7000, None, None, None), (7001, "  \n", "z", "z"), (None, "alone in the world here", "a", "b"),
             (7002, "same row twice", "q", "q"), (7002, "same row twice", "q", "q"), (7002, "one id two texts", "q", "q"),
             (7003, "long " * 30000, "q", "q")]
    return rows


@pytest.mark.parametrize("parts,block", [(None, 8192), (5, 16), (6, 8192)])
def test_groups_equal_brute_force(spark, parts, block):
    rows = make_docs()
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = S.simhash_groups(df, parts=parts, block=block).collect()
    prints = [brute_print(r[1]) for r in rows]
    roots = brute_components(prints)
    ids = {}
    for r, root in zip(rows, roots):
        if r[0] is not None:
            ids[root] = min(ids.get(root, r[0]), r[0])
    want = sorted((str(r[0]), p, str(ids.get(root))) for r, p, root in zip(rows, prints, roots))
    assert sorted((str(g.doc_id), g.fp % (1 << 64), str(g.component_id)) for g in got) == want


def test_one_document_of_each_group_stays(spark):
    rows = make_docs()
    df = spark.createDataFrame(rows, DOCS)
    kept = S.keep_one_per_group(df)
    assert kept.columns == df.columns
    got = sorted(map(str, (tuple(r) for r in kept.collect())))
    roots = brute_components([brute_print(r[1]) for r in rows])
    best = {}
    for r, root in zip(rows, roots):
        key = (r[0] is None, r[0] or 0)
        if root not in best or key < best[root][0]:
            best[root] = (key, r)
    assert len(got) == len(best)
    assert {str(r[1][0]) for r in best.values()} >= {g.split(",")[0].strip("(") for g in got}


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert S.simhash_groups(empty).count() == 0
    assert S.keep_one_per_group(empty).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_query_on_driver_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    roots = brute_components(prints)
    least = {}
    for r, root in zip(rows, roots):
        least[root] = min(least.get(root, r.doc_id), r.doc_id)
    want = sorted((r.doc_id, f"{p:016x}", least[root]) for r, p, root in zip(rows, prints, roots))
    got = S.op2_simhash_near_dedup(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect())) == want
