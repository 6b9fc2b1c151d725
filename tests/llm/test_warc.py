"""WARC writing, reading and segment reassembly."""

import base64
import gzip
import hashlib
import random

import pytest

from amity.llm import warc as W

KIND = "page_id bigint, url string, html string, COMPLETE string, sha1 int"


def pages():
    rnd = random.Random(1)
    bodies = ["", "short", "é" * 500, "日本語" * 9000, "a\r\n\r\nWARC/1.1\r\n\r\n0\r\n\r\n" * 200, "x" * 200_000]
    rows = [(i, f"http://h{i % 3}/ a\n{i}", rnd.choice(bodies) + (str(i) if i % 4 == 0 else ""), "c", 1) for i in range(120, 0, -1)]
    rows += [(500, None, None, "c", 1), (501, "", "", "c", 1), (None, "u", "x" * 200_000, "c", 1), (None, None, "only here", "c", 1)]
    rows += [((1 << 60) + 1, "u", "big id " * 9000, "c", 1), ((1 << 60) + 3, "u", "big id " * 9000, "c", 1)]
    rows += [(600, "u", "twice " * 9000, "c", 1)] * 2 + [(601, "u", "twice " * 9000, "c", 1)]
    return rows


def expected(rows, least=0):
    first = {}
    for i, _, h, *_ in rows:
        h = h or ""
        if i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        revisit = i is not None and first[h or ""] != i and len(b) >= least
        out.append((str(i), len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response",
                    str(first[h or ""] if revisit else None), True))
    return sorted(out)


def result(df):
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete")
    return sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"]), r["complete"])
                  for r in df.select(*cols).collect())


@pytest.mark.parametrize("segment,least,per_file", [(32 << 10, 0, 4096), (1000, 600, 7)])
def test_round_trip(spark, tmp_path, segment, least, per_file):
    rows = pages()
    df = spark.createDataFrame(rows, KIND).repartition(3)
    W.write_archive(df, str(tmp_path / "w"), segment_bytes=segment, min_revisit_bytes=least, records_per_file=per_file)
    assert result(W.read_archive(spark, str(tmp_path / "w"))) == expected(rows, least)
    sizes = [len(list(W.parse(gzip.decompress(f.read_bytes())))) for f in (tmp_path / "w").glob("part-*")]
    assert sum(sizes) >= len(rows) and max(sizes) <= per_file


def test_empty(spark, tmp_path):
    W.write_archive(spark.createDataFrame([], KIND), str(tmp_path / "w"))
    assert W.read_archive(spark, str(tmp_path / "w")).count() == 0


def test_chunked_framing():
    for data in (b"", b"a", "é日🙂".encode() * 5000):
        assert W.unchunked(W.chunked(data, 7)) == data
        assert b"".join(W.pieces(data, 7)) == data and all(len(p) <= 7 and p.decode() for p in W.pieces(data, 7))
    assert W.unchunked(b"3;ext=1\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        W.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


@pytest.mark.parametrize("broken", ["missing", "total", "digest", "frame"])
def test_broken_segments_are_reported(spark, tmp_path, broken):
    payload = b"abc " * 1000
    records = W.page_records("1", "u", payload, 0, None, False, 1000)
    if broken == "missing":
        del records[2]
    elif broken == "total":
        records[-1] = records[-1].replace(b"Total-Length: ", b"Total-Length: 9")
    elif broken == "digest":
        records[0] = records[0].replace(W.base32_sha1(payload).encode() + b"\r\nContent-Type", b"A" * 32 + b"\r\nContent-Type")
    else:
        records[0] = records[0].replace(b"\r\nfa0\r\n", b"\r\nfa1\r\n").replace(b"\r\n\r\nfa0", b"\r\n\r\nfa1")
    records += W.page_records("2", "u", b"whole", 1, None, False, 1000)
    random.Random(0).shuffle(records)
    (tmp_path / "part-0").write_bytes(b"".join(r + W.END for r in records))
    got = {r.page_id: r for r in W.read_archive(spark, str(tmp_path)).collect()}
    assert not got[1].complete and got[1].payload_bytes is None
    assert got[2].complete and got[2].payload_bytes == 5
