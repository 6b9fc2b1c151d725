"""Fill-in-middle transformation over seekable compressed frames.

*Store.* Every text becomes a row of independent zstandard frames of at most
``FRAME_BYTES`` bytes of UTF-8, cut between characters. Beside each frame stand
the numbers of units and code points before it and in it, so any unit can be
found without reading what comes before. (A unit is white space and the word
after it, or the white space at the end: a new unit starts wherever white
space follows something else, so frames may be cut anywhere.)

*Select.* The two cuts are drawn from the SHA-256 of seed and doc_id over the
number of units, which the index gives. Only the frames that hold a cut are
decompressed; all others go into the output as they are. An output is again a
list of frames, and joined together they are one valid zstandard stream.

*Digest and restore.* Frames are streamed in order, one decompressed at a
time. Restoring reads nothing but output and form: it finds the three markers
in the stream (also across frames) and then seeks the sections in their
original order.

No shuffle: a document's frames never leave its row, which is no larger than
the text's own row; a worker holds one batch of rows and one open frame.

Defined results: a NULL text is an empty one (no units, plain, digest of no
bytes); a NULL doc_id is drawn as an empty number and comes back NULL; repeated
rows are transformed alike, one row each; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, read_table, scratch_path

FRAME_BYTES = 64 << 10
SEED = 42
FIM_PERCENT, SPM_PERCENT = 50, 80  # texts that are transformed, and of those in the order suffix, prefix, middle
LEVEL = 3
HOLD_BYTES = 2 << 20               # of compressed rows a worker hands on at once
ROW_GROUP_BYTES = 8 << 20          # of a written frame table
# The markers
P, S, M = b"<P>", b"<S>", b"<M>"
MARKERS = (P, S, M)

FRAME = pa.struct([("first_unit", pa.int64()), ("units", pa.int64()), ("first_char", pa.int64()), ("chars", pa.int64()),
                   ("data", pa.binary())])
STORED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("marked", pa.bool_()), ("frames", pa.list_(FRAME))])
STORED_DDL = ("doc_id bigint, n bigint, marked boolean, frames array<struct<first_unit: bigint, units: bigint, "
              "first_char: bigint, chars: bigint, data: binary>>")
OUTPUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                    ("middle_chars", pa.int64()), ("output", pa.list_(pa.binary()))])
OUTPUT_DDL = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<binary>"


def _white(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def unit_starts(data: bytes, before: bool) -> np.ndarray:
    """Byte offsets in ``data`` at which a unit starts; ``before``: whether
    one starts at its first byte if that is white space (what comes before is
    not), or, at the beginning of a text, anyway."""
    white = _white(np.frombuffer(data, np.uint8))
    inner = np.flatnonzero(white[1:] & ~white[:-1]) + 1
    return np.concatenate([[0], inner]) if before and len(data) else inner


def code_points(data: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def frames_of(text: bytes, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> list[dict]:
    """The frames of a text with their places in it."""
    pack, out, at, unit, char = zstandard.ZstdCompressor(level=level), [], 0, 0, 0
    while at < len(text):
        end = min(at + frame_bytes, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80 and end > at + 1:
            end -= 1
        part = text[at:end]
        opens = at == 0 or bool(_white(np.frombuffer(text[at:at + 1], np.uint8))[0] and not _white(np.frombuffer(text[at - 1:at], np.uint8))[0])
        units, chars = len(unit_starts(part, opens)), code_points(part)
        out.append({"first_unit": unit, "units": units, "first_char": char, "chars": chars, "data": pack.compress(part)})
        at, unit, char = end, unit + units, char + chars
    return out


def _opened(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _batches(rows: Iterable[dict], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """``rows`` as batches of about ``HOLD_BYTES``."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += 200 + size(row)
        if total >= HOLD_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def frame_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES,
                level: int = LEVEL) -> DataFrame:
    """``(doc_id, n, marked, frames)``: every text as compressed frames. ``n``:
    its units; ``marked``: whether a marker occurs in it."""
    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for b in batches:
                for i, t in zip(b.column(0), b.column(1), strict=True):
                    data = t.as_py() or b""
                    frames = frames_of(data, frame_bytes, level)
                    yield {"doc_id": i.as_py(), "n": sum(f["units"] for f in frames),
                           "marked": any(m in data for m in MARKERS), "frames": frames}

        yield from _batches(rows(), STORED, lambda r: sum(len(f["data"]) for f in r["frames"]))

    # as bytes: a text is never decoded
    source = docs.select(F.col(col_ref(doc_id)).cast("bigint").alias("doc_id"), F.col(col_ref(text)).cast("string").cast("binary").alias("text"))
    return source.mapInArrow(store, STORED_DDL)


def cut_plan(doc_id: Column, n: Column, marked: Column, seed: int = SEED) -> dict[str, Column]:
    """``form`` and the two cuts in units, ``low`` and ``high``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    plain = (n == 0) | marked | (h3 % 100 >= FIM_PERCENT)
    form = F.when(plain, "plain").when(h4 % 100 < SPM_PERCENT, "spm").otherwise("psm")
    cuts = [h1 % (n + 1), h2 % (n + 1)]
    return {"form": form, "low": F.least(*cuts), "high": F.greatest(*cuts)}


class Cutter:
    """Cuts a stored text at units, decompressing only the frames they are in."""

    def __init__(self, frames: list[dict], n: int, level: int = LEVEL) -> None:
        self.frames, self.n, self.opened, self.pack = frames, n, {}, zstandard.ZstdCompressor(level=level)

    def data(self, k: int) -> bytes:
        if k not in self.opened:
            self.opened = {k: _opened(self.frames[k]["data"])}
        return self.opened[k]

    def place(self, unit: int) -> tuple[int, int, int]:
        """(frame, byte in it, code points before) of the start of a unit."""
        if unit == self.n:
            last = self.frames[-1]
            return len(self.frames), 0, last["first_char"] + last["chars"]
        lo, hi = 0, len(self.frames) - 1  # the last frame that starts with no more units before it than this one
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.frames[mid]["first_unit"] <= unit else (lo, mid - 1)
        frame, data = self.frames[lo], self.data(lo)
        inner = unit_starts(data, False)
        starts = inner if len(inner) == frame["units"] else np.concatenate([[0], inner])
        byte = int(starts[unit - frame["first_unit"]])
        return lo, byte, frame["first_char"] + code_points(data[:byte])

    def section(self, start: tuple[int, int, int], end: tuple[int, int, int]) -> list[bytes]:
        """The frames between two places; cut ones are compressed anew."""
        out = []
        for k in range(start[0], min(end[0] + 1, len(self.frames))):
            a, b = start[1] if k == start[0] else 0, end[1] if k == end[0] else None
            if a == 0 and b is None:
                out.append(self.frames[k]["data"])
            elif part := self.data(k)[a:b]:
                out.append(self.pack.compress(part))
        return out


def fill_in_middle(stored: DataFrame, seed: int = SEED, level: int = LEVEL) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` from a frame
    table: ``output`` is the transformed text as frames (``join_frames``)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level)
        mark = {m: pack.compress(m) for m in MARKERS}

        def rows() -> Iterator[dict]:
            for b in batches:
                for k in range(b.num_rows):
                    i, n, form, low, high = [b.column(c)[k].as_py() for c in range(5)]
                    frames = b.column(5)[k].as_py()
                    row = {"doc_id": i, "n": n, "form": form, "prefix_chars": None, "middle_chars": None}
                    if form == "plain":
                        yield row | {"output": [f["data"] for f in frames]}
                        continue
                    cutter = Cutter(frames, n, level)
                    a, z = cutter.place(low), cutter.place(high)
                    prefix, middle = cutter.section((0, 0, 0), a), cutter.section(a, z)
                    suffix = cutter.section(z, (len(frames), 0, 0))
                    front = [mark[S], *suffix, mark[P], *prefix] if form == "spm" else [mark[P], *prefix, mark[S], *suffix]
                    yield row | {"prefix_chars": a[2], "middle_chars": z[2] - a[2], "output": [*front, mark[M], *middle]}

        yield from _batches(rows(), OUTPUT, lambda r: sum(map(len, r["output"])))

    plan = cut_plan(F.col("doc_id"), F.col("n"), F.col("marked"), seed)
    return stored.select("doc_id", "n", *[c.alias(name) for name, c in plan.items()], "frames").mapInArrow(cut, OUTPUT_DDL)


def join_frames(output: list[bytes]) -> bytes:
    """The transformed text of a list of frames."""
    return b"".join(map(_opened, output))


class Output:
    """An output's text, read as a stream of frames."""

    def __init__(self, frames: list[bytes]) -> None:
        self.frames = frames
        sizes = [zstandard.frame_content_size(f) for f in frames]
        self.ends = np.cumsum(sizes, dtype=np.int64) if sizes else np.zeros(0, np.int64)

    def scan(self, wanted: tuple[bytes, ...]) -> tuple[str, list[int]]:
        """The digest of the whole text, and where each wanted marker stands."""
        digest, found, tail, at = hashlib.sha256(), [], b"", 0
        for f in self.frames:
            data = _opened(f)
            digest.update(data)
            window = tail + data
            while len(found) < len(wanted):
                from_ = max(0, found[-1] + 3 - (at - len(tail))) if found else 0
                if (hit := window.find(wanted[len(found)], from_)) < 0:
                    break
                found.append(at - len(tail) + hit)
            tail, at = window[-2:], at + len(data)
        return digest.hexdigest(), found

    def read(self, start: int, end: int) -> Iterator[bytes]:
        """The bytes from ``start`` to ``end``, a frame at a time."""
        k = int(np.searchsorted(self.ends, start, "right"))
        while start < end:
            first = int(self.ends[k - 1]) if k else 0
            yield _opened(self.frames[k])[start - first:end - first]
            start, k = int(self.ends[k]), k + 1


def restored(output: list[bytes], form: str) -> tuple[str, Iterator[bytes]]:
    """The output's own digest, and the original text as a stream, from
    nothing but output and form."""
    text = Output(output)
    if form == "plain":
        return text.scan(())[0], map(_opened, output)
    order = (S, P, M) if form == "spm" else (P, S, M)
    digest, marks = text.scan(order)
    if len(marks) != 3 or marks[0] != 0:
        raise ValueError(f"not an output of the form {form}")
    ends = dict(zip(order, [*marks[1:], int(text.ends[-1])], strict=True))
    starts = {m: at + 3 for m, at in zip(order, marks, strict=True)}
    return digest, (part for m in (P, M, S) for part in text.read(starts[m], ends[m]))


def with_digests(outputs: DataFrame) -> DataFrame:
    """``fill_in_middle``'s rows with ``output_sha256`` and the digest of the
    text rebuilt from the output, ``restored_sha256``, in place of it."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = []
            for form, output in zip(b.column("form").to_pylist(), b.column("output"), strict=True):
                own, parts = restored(output.as_py(), form)
                again = hashlib.sha256()
                for part in parts:
                    again.update(part)
                pairs.append((own, again.hexdigest()))
            cols = [b.column(c) for c in names] + [pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(cols, [*names, "output_sha256", "restored_sha256"])

    return outputs.select(*names, "output").mapInArrow(digests, OUTPUT_DDL.replace("output array<binary>", "output_sha256 string, restored_sha256 string"))


def write_frames(stored: DataFrame, path: str) -> DataFrame:
    """A frame table written under ``path`` and read back. The frames are
    compressed already, and small row groups keep a writer's buffers small."""
    stored.write.option("compression", "uncompressed").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return stored.sparkSession.read.schema(STORED_DDL).parquet(path)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as frames, transformed, and rebuilt."""
    stored = write_frames(frame_table(read_table(spark, sf_dir, "documents")), scratch_path(spark, "fim-frames"))
    return with_digests(fill_in_middle(stored))


QUERIES = {"op13_fill_in_middle": op13_fill_in_middle}

OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
      [CAST('0x' || h[8*k+1:8*k+8] AS BIGINT) FOR k IN range(4)] AS h FROM d),
c AS (SELECT *, CAST(len(units) AS BIGINT) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS low,
      greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS high,
      CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
           WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low+1:high], '') AS middle,
      array_to_string(units[high+1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form != 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form != 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
SQL = {"op13_fill_in_middle": OP13_SQL}
