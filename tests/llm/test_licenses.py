"""License scans against a comparison of every block with every template."""

import math
import os
import random
import re

import duckdb
import pytest

from amity.llm import licenses as L

DOCS = "doc_id bigint, text string, Label string, blocks string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, templates, phrases, threshold, block, stride):
    words = words_of(text)
    places = sorted((label, i) for label, p in phrases for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    found, start = [], 0
    while words and (start == 0 or start - stride + block < len(words)):
        held = set(words[start:start + block])
        for t, (label, body) in enumerate(templates):
            wanted = set(words_of(body))
            shared = len(wanted & held)
            if shared >= math.ceil(threshold * len(wanted) - 1e-9):
                found.append((t, label, start, len(words[start:start + block]), shared, shared / len(wanted)))
        start += stride
    return len(words), places, sorted(found)


def scanned(df, **options):
    out = []
    for r in L.license_scan(df, **options).collect():
        out.append((str(r.doc_id), r.n_words, sorted(tuple(p) for p in r.phrases), sorted(tuple(b) for b in r.blocks)))
    return sorted(out, key=repr)


def make_rows():
    rnd = random.Random(4)
    body = [w for _, t in L.TEMPLATES for w in t.split()] + ["and", "É", "ü7", "GPL", "x"] * 8
    rows = []
    for k in range(150):
        parts = rnd.choices(body, k=rnd.choice([0, 3, 40, 130, 400]))
        for _ in range(rnd.choice([0, 1, 2])):
            notice = rnd.choice(L.TEMPLATES)[1].split()
            if rnd.random() < 0.5:
                notice.pop(rnd.randrange(len(notice)))
            at = rnd.randint(0, len(parts))
            parts[at:at] = notice
        rows.append((k, rnd.choice([" ", "\n", "-- "]).join(parts), "x", "y"))
    rows += [(500, None, None, None), (501, "", "x", "y"), (None, "The MIT\x00license, mit_license MIT License", "x", "y")]
    rows += [(502, "CC BY cc-by 4.0\nCC BY ccc by CC BY", "x", "y")] * 2
    rows += [(503, "filler and more " * 40000 + "GNU General  Public\nLicense", "x", "y")]
    return rows


@pytest.mark.parametrize("threshold,block,stride", [(0.9, 128, 64), (0.6, 128, 64), (0.5, 40, 9), (1.0, 64, 30)])
def test_every_block_that_meets_a_template(spark, threshold, block, stride):
    rows = make_rows()
    templates = tuple(t for t in L.TEMPLATES if len(words_of(t[1])) <= block - stride)
    got = scanned(spark.createDataFrame(rows, DOCS).repartition(3), templates=templates, threshold=threshold, block=block, stride=stride)
    want = [(str(r[0]), *brute(r[1], templates, L.PHRASES, threshold, block, stride)) for r in rows]
    assert got == sorted(want, key=repr)
    assert any(w[3] for w in want)


def test_join_of_random_sets_is_exact():
    rnd = random.Random(11)
    letters = [f"w{k}" for k in range(30)]
    for _ in range(300):
        templates = tuple((f"t{k}", " ".join(rnd.choices(letters, k=rnd.randint(1, 12)))) for k in range(6))
        threshold = rnd.choice([0.3, 0.5, 0.8, 1.0])
        index = L.TemplateIndex(templates, {w.encode(): rnd.randint(0, 5) for w in letters}, threshold)
        held = set(rnd.choices(letters, k=rnd.randint(0, 25)))
        block = {index.rank[w.encode()] for w in held if w.encode() in index.rank}
        want = [(t, len(set(x.split()) & held)) for t, (_, x) in enumerate(templates)
                if len(set(x.split()) & held) >= math.ceil(threshold * len(set(x.split())) - 1e-9)]
        assert index.matches(block) == want


def test_filters_leave_few_candidates():
    index = L.TemplateIndex(L.TEMPLATES, {b"the": 1000, b"of": 900, b"and": 800, b"to": 700}, 0.9)
    common = sorted(index.rank[w] for w in (b"the", b"of", b"and", b"to"))
    assert index.candidates(common) == []


def test_report_and_labels(spark):
    rows = [(1, "Licensed under CC BY-NC 4.0.", "", ""), (2, "nothing here at all", "", ""), (3, None, "", ""),
            (4, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                "following conditions are met", "", ""), (5, "x Apache License y MIT License z apache license", "", "")]
    got = {r.doc_id: tuple(r)[1:] for r in L.license_report(L.license_scan(spark.createDataFrame(rows, DOCS))).collect()}
    assert got[1] == (7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc-4.0", 1.0)
    assert got[2] == (4, 0, None, None, "", "", 0.0) and got[3] == (0, 0, None, None, "", "", 0.0)
    assert got[4][1:] == (0, None, None, "", "bsd", 1.0)
    assert got[5] == (9, 3, 1, 7, "apache,mit", "apache,mit", 1.0)


def test_empty_tables_and_bad_options(spark):
    empty = spark.createDataFrame([], DOCS)
    assert L.license_scan(empty).count() == 0
    one = spark.createDataFrame([(1, "MIT License", "", "")], DOCS)
    assert scanned(one, templates=()) == [("1", 2, [("mit", 0)], [])]
    assert scanned(one, phrases=()) == [("1", 2, [], [])]
    for bad in ({"threshold": 0.0}, {"threshold": 1.2}, {"stride": 0}, {"templates": (("x", "..."),)}, {"block": 70}):
        with pytest.raises(ValueError):
            L.license_scan(one, **bad)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver test data not present")
def test_query_matches_sql(spark):
    df = L.op12_license_scan(spark, "/root/testdata/sf0.01")
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.01/documents.parquet')")
    want = con.execute(L.OP12_SQL)
    assert df.columns == [c[0] for c in want.description]
    rows = sorted(map(tuple, df.collect()))
    assert rows == sorted(want.fetchall())
    assert {x for r in rows for x in r[6].split(",")} >= {"gpl-3.0", "apache-2.0", "cc-by-nc-4.0", "mit"}
