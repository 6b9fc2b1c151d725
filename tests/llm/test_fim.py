"""Fill-in-middle: frames, cuts, outputs and restoring against plain strings."""

import hashlib
import os
import random
import re

import duckdb
import pytest
import zstandard

from amity.llm import fim

DOCS = "doc_id bigint, text string, Form string, n string"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    low, high = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    prefix, middle, suffix = ["".join(x) for x in (units[:low], units[low:high], units[high:])]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (doc_id, n, "plain", None, None, sha(text), sha(text)), text
    if h[3] % 100 < 80:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return (doc_id, n, form, len(prefix), len(middle), sha(out), sha(text)), out


def make_rows():
    rnd = random.Random(3)
    parts = [" ", "\n", "\t\t", "\r\n", "a", "bc", "é", "漢字", "😀", "<", "<P", "P>", ">", "<S", "\x0b", " ", "\x85", "word", "\x1f"]
    rows = [(k, "".join(rnd.choices(parts, k=rnd.choice([0, 1, 2, 5, 60, 400]))), "x", "y") for k in range(300)]
    rows += [(1000 + k, t, "x", "y") for k, t in enumerate([None, "", " ", "\n \t", "one", " one", "one ", "a <P> b", "x<S>", "<M", "é" * 5000, " " * 4000])]
    rows += [(None, "no id here at all", None, None), (None, None, None, None)] + [(5, "same row", "q", "q")] * 3
    rows += [(2000 + k, "long words here, é and 漢. " * 30000, "q", "q") for k in range(4)]
    rows += [(3000 + k, "q" * 700_000 + " " * 700_000 + "r" * 10, "q", "q") for k in range(4)]
    return rows


@pytest.mark.parametrize("frame_bytes", [4, 7, 64, fim.FRAME_BYTES])
def test_rows_outputs_and_restored_texts(spark, frame_bytes):
    rows = [r for r in make_rows() if frame_bytes > 1000 or len(r[1] or "") < 5000]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    outputs = fim.fill_in_middle(fim.frame_table(df, frame_bytes=frame_bytes))
    got = sorted(map(repr, (tuple(r) for r in fim.with_digests(outputs).collect())))
    assert got == sorted(repr(expected(r[0], r[1])[0]) for r in rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], set()).add(expected(r[0], r[1])[1])
    for r in outputs.select("doc_id", "form", "output").collect():
        out = fim.join_frames([bytes(f) for f in r.output]).decode()
        assert out in texts[r.doc_id]
        assert all(zstandard.frame_content_size(bytes(f)) <= max(4, frame_bytes) for f in r.output)


def test_frames_can_be_sought():
    rnd = random.Random(8)
    text = "".join(rnd.choices(["ab ", "é", "\n", "  ", "xyz"], k=3000))
    frames = fim.frames_of(text.encode(), 100)
    units = UNIT.findall(text)
    cutter = fim.Cutter(frames, len(units))
    for u in [0, 1, len(units) - 1, len(units), *rnd.sample(range(len(units)), 200)]:
        frame, byte, chars = cutter.place(u)
        assert chars == len("".join(units[:u]))
        assert len(cutter.opened) <= 1  # never more than the frame of the cut
        assert b"".join(map(fim._opened, cutter.section((0, 0, 0), (frame, byte, chars)))).decode() == "".join(units[:u])
    assert sum(f["chars"] for f in frames) == len(text)


def test_only_cut_frames_are_compressed_anew():
    text = ("some words " * 50000).encode()
    frames = fim.frames_of(text)
    cutter = fim.Cutter(frames, 100001)
    a, z = cutter.place(30000), cutter.place(60001)
    pieces = cutter.section((0, 0, 0), a) + cutter.section(a, z) + cutter.section(z, (len(frames), 0, 0))
    stored = {f["data"] for f in frames}
    assert sum(p not in stored for p in pieces) <= 4
    assert b"".join(map(fim._opened, pieces)) == text
    joined = zstandard.ZstdDecompressor().stream_reader(b"".join(pieces), read_across_frames=True).read()
    assert joined == text


def test_a_broken_output_is_refused():
    pack = zstandard.ZstdCompressor()
    with pytest.raises(ValueError):
        fim.restored([pack.compress(b"<S>a<P>b")], "spm")
    # markers across frames
    own, parts = fim.restored([pack.compress(p) for p in (b"<", b"S>c", b"<P", b">a<M", b">b")], "spm")
    assert b"".join(parts) == b"abc" and own == hashlib.sha256(b"<S>c<P>a<M>b").hexdigest()


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert fim.with_digests(fim.fill_in_middle(fim.frame_table(empty))).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver test data not present")
def test_query_matches_sql(spark):
    df = fim.op13_fill_in_middle(spark, "/root/testdata/sf0.001")
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    want = con.execute(fim.OP13_SQL)
    assert df.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, df.collect())) == sorted(want.fetchall())
