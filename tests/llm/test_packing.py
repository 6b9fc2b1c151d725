"""Packing: the search against a plain scan, and an exact round trip."""

import base64
import os
import random
import zlib

import numpy as np
import pytest

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")

from amity.llm import packing as P  # noqa: E402

KIND = "doc_id bigint, text string, IDS string, pieces int"


def plain_best_fit(sizes, length):
    rooms, rows = [], []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        fits = [r for r in rooms if r >= sizes[k]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - sizes[k])
        else:
            rooms.append(length - sizes[k])
            rows.append(k)
    return sorted(rooms)


@pytest.mark.parametrize("length", [1, 7, 64, 100])
def test_best_fit(length):
    rnd = random.Random(length)
    for n in (0, 1, 50, 400):
        sizes = [rnd.randint(1, length) for _ in range(n)]
        rows = P.best_fit_decreasing(np.array(sizes, int), length)
        assert sorted(k for r in rows for k in r) == list(range(n))
        assert sorted(length - sum(sizes[k] for k in r) for r in rows) == plain_best_fit(sizes, length)


def test_round_trip(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices(["the", "Straße", "日本", "x\n"], k=rnd.randint(0, 90))), "x", 1) for i in range(200)]
    rows += [(900, None, "x", 1), (901, "", "x", 1), (None, "no id", "x", 1), (902, "long text " * 5000, None, None), (903, "a" * 20000, "x", 1)]
    rows += [(904, "same", "x", 1)] * 2
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.default_tokenizer(), "rb"))}
    code = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame(rows, KIND).repartition(3)
    packed = P.pack_documents(df, length=128, group_tokens=3000)
    full = packed.collect()
    assert len({r.pack_id for r in full}) == len(full) and all(len(r.ids) == 256 for r in full)
    for r in full:
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 128 and r.position_resets == r.cu_seqlens[:-1]
        assert set(np.frombuffer(r.ids, "<u2")[r.n_tokens:]) <= {P.END_OF_TEXT}
    assert sum(r.n_tokens for r in full) / (128 * len(full)) > 0.9
    parts = {}
    for s in P.segments(packed).collect():
        assert len(s.ids) == 2 * s.n_tokens
        parts.setdefault(s.doc_id, []).append((s.piece, np.frombuffer(s.ids, "<u2").tolist()))
    assert sum(p[0] == 0 for p in parts[904]) == 2
    for i, t, *_ in rows:
        if i != 904:
            want = [*code.encode_ordinary(t or ""), P.END_OF_TEXT]
            got = [ids for _, ids in sorted(parts[i])]
            assert sum(got, []) == want and all(len(x) == 128 for x in got[:-1])


def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.default_tokenizer(), "rb"))}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_runs_change_no_pre_token():
    code, rnd = encoding(), random.Random(5)
    for _ in range(3000):
        parts = ["".join(rnd.choices(" \n\t\r\x0b\x0c\x85\xa0\u2003\u3000\x1c\u200b", k=rnd.randint(1, 9))) if rnd.random() < 0.6 else
                 rnd.choice(["word", "don't", "'s", "42", "!?", "é", "日本"]) for _ in range(rnd.randint(0, 9))]
        text = "".join(parts)
        assert P.encode_text(code, text, 3).tolist() == code.encode_ordinary(text)


def test_white_space_runs_above_a_million(spark):
    code = encoding()
    texts = ["before" + " " * 1_500_000 + "after", "\n" * 1_500_000, "a" + "\t" * 1_200_000 + " b" + " " * 1_100_000]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(9, "short", "x", 1)], KIND)
    parts = {}
    for s in P.segments(P.pack_documents(df)).collect():
        parts.setdefault(s.doc_id, []).append((s.piece, np.frombuffer(s.ids, "<u2").tolist()))
    ids = {i: sum((x for _, x in sorted(p)), []) for i, p in parts.items()}
    assert {i: code.decode(x[:-1]) for i, x in ids.items()} == dict(enumerate(texts)) | {9: "short"}
    assert all(x[-1] == P.END_OF_TEXT for x in ids.values())


def test_empty(spark):
    assert P.segments(P.pack_documents(spark.createDataFrame([], KIND))).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_query_on_driver_table(spark):
    sf = "/root/testdata/sf0.001"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.default_tokenizer(), "rb"))}
    code = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = [*code.encode_ordinary(r.text), P.END_OF_TEXT]
        for p, s in enumerate(range(0, len(ids), P.LENGTH)):
            part = ids[s:s + P.LENGTH]
            want.append((r.doc_id, p, len(part), zlib.crc32(np.array(part, "<u2").tobytes())))
    rows = P.op10_packing(spark, sf).collect()
    assert sorted((r.doc_id, r.piece, r.n_tokens, r.ids_crc32) for r in rows) == sorted(want)
    # segments of a row neither overlap nor leave a gap
    by = {}
    for r in rows:
        by.setdefault(r.pack_id, []).append((r.start, r.n_tokens))
    for spans in by.values():
        ends = [0] + [s + n for s, n in sorted(spans)]
        assert [s for s, _ in sorted(spans)] == ends[:-1] and ends[-1] <= P.LENGTH
