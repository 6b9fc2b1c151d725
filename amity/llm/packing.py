"""Token ids packed into fixed-length rows by best-fit decreasing.

Each task reads its part of the documents as a stream: it tokenises whole
texts, ends each with the end-of-text id, cuts what is longer than a row into
pieces (nothing is dropped), and once ``group_tokens`` have gathered packs
them and lets them go. Packing places the longest piece first, each into the
row with the least room that still holds it; a segment tree over room sizes
finds that row in O(log length). No shuffle: a group's few thousand documents
pack as tightly as the whole corpus would, a task's memory is one group's, and
a lost executor's task packs the same rows again.

A written row has its ``length`` ids (little-endian unsigned 16- or 32-bit,
padded), ``cu_seqlens`` (where its segments start, and the end), the doc_id
and piece number of each segment, and ``position_resets`` (where position ids
start again from 0). ``segments`` reads the files back, one row a segment.

Defined results: a NULL or empty text is the end-of-text id alone; a NULL
doc_id is kept NULL; repeated rows are packed each; a very long text becomes
many full rows and one rest; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, read_table, scratch_path

LENGTH = 2048
GROUP_TOKENS = 4 << 20
END_OF_TEXT = 50256
LONG_RUN = 100_000  # white-space characters in a row that tiktoken's pattern is kept from
# The characters of Unicode's White_Space, which \s of the pattern is
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
ROW = ("pack_id bigint, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
       "doc_ids array<bigint>, pieces array<int>")


class RoomTree:
    """Rows by free room: a segment tree over rooms 0 .. top, each node true
    where a row with such room exists."""

    def __init__(self, top: int) -> None:
        self.size = 1 << top.bit_length()
        self.some = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(top + 1)]

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.size
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The (room, row) with the least room of at least ``need``, removed."""
        node, some = need + self.size, self.some
        if not some[node]:
            while node > 1 and (node & 1 or not some[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if some[2 * node] else 2 * node + 1
        room = node - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            some[node] = 0
            while node > 1 and not some[node ^ 1]:
                node >>= 1
                some[node] = 0
        return room, row


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Items of each row, longest first; sizes are 1 .. ``length``."""
    tree, rows = RoomTree(length), []
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        found = tree.take(size)
        if found is None:
            found = length, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(k)
        if room > size:
            tree.put(room - size, row)
    return rows


def _packed(docs: list[tuple[int | None, np.ndarray]], length: int, first_id: int, pad: int) -> pa.RecordBatch:
    """One group's rows."""
    parts = [(i, p, ids[s:s + length]) for i, ids in docs for p, s in enumerate(range(0, len(ids), length))]
    rows = best_fit_decreasing(np.array([len(x) for _, _, x in parts]), length)
    blobs, totals, cu, resets, ids, pieces = [], [], [], [], [], []
    for row in rows:
        matrix_row = np.full(length, pad, parts[0][2].dtype)
        ends = np.cumsum([0] + [len(parts[k][2]) for k in row])
        for k, s in zip(row, ends, strict=False):
            matrix_row[s:s + len(parts[k][2])] = parts[k][2]
        blobs.append(matrix_row.tobytes())
        totals.append(int(ends[-1]))
        cu.append(ends.tolist())
        resets.append(ends[:-1].tolist())
        ids.append([parts[k][0] for k in row])
        pieces.append([parts[k][1] for k in row])
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(range(first_id, first_id + len(rows)), pa.int64()), pa.array(blobs, pa.binary()), pa.array(totals, pa.int32()),
         pa.array(cu, ints), pa.array(resets, ints), pa.array(ids, longs), pa.array(pieces, ints)],
        [f.split()[0] for f in ROW.split(", ")])


def encode_text(code, text: str, long_run: int = LONG_RUN) -> np.ndarray:
    """The ids of ``text`` by ``code``, a tiktoken encoding. Its pattern gives up
    on about a million white-space characters in a row. A run is one pre-token
    up to its last character, which the pattern leaves to what follows (at the
    end of the text: the whole run); nothing before a run depends on it. So
    long runs are encoded as the pre-tokens they are, without the pattern."""
    runs = [m.span() for m in WHITE.finditer(text) if m.end() - m.start() >= long_run] if len(text) >= long_run else []
    if not runs:
        return code.encode_to_numpy(text, disallowed_special=())
    out, at = [], 0
    for start, end in runs:
        end -= end < len(text)
        out.append(code.encode_to_numpy(text[at:start], disallowed_special=()))
        out.append(np.array(code._encode_single_piece(text[start:end]), out[0].dtype))
        at = end
    return np.concatenate([*out, code.encode_to_numpy(text[at:], disallowed_special=())])


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   group_tokens: int = GROUP_TOKENS, end_of_text: int = END_OF_TEXT) -> DataFrame:
    """The packed rows of ``docs``. ``tokenizer`` is a file of token ranks."""
    import public_tokenizers

    with open(tokenizer or default_tokenizer(), "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast((f.read(), public_tokenizers.PATTERN))  # a vocabulary: about 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.value[0].splitlines())}
        code = tiktoken.Encoding("own", pat_str=ranks.value[1], mergeable_ranks=table, special_tokens={})
        kind = np.uint16 if max(max(table.values()), end_of_text) < 1 << 16 else np.uint32
        held, total, next_id = [], 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode_text(code, t.as_py() or "")
                held.append((i, np.append(ids, end_of_text).astype(kind)))
                total += len(held[-1][1])
                if total >= group_tokens:
                    out = _packed(held, length, next_id, end_of_text)
                    held, total, next_id = [], 0, next_id + out.num_rows
                    yield out
        if held:
            yield _packed(held, length, next_id, end_of_text)

    rows = docs.select(F.col(col_ref(doc_id)).cast("bigint").alias("doc_id"), F.col(col_ref(text)).cast("string").alias("text"))
    return rows.mapInArrow(run, ROW)


def segments(packed: DataFrame, width: int = 2) -> DataFrame:
    """``(doc_id, piece, pack_id, start, n_tokens, ids)`` of every segment;
    ``width`` bytes an id."""
    k = F.explode(F.sequence(F.lit(0), F.size("doc_ids") - 1)).alias("k")
    cut = packed.select("pack_id", "ids", "cu_seqlens", "doc_ids", "pieces", k)
    start, end = F.get("cu_seqlens", F.col("k")), F.get("cu_seqlens", F.col("k") + 1)
    return cut.select(F.get("doc_ids", F.col("k")).alias("doc_id"), F.get("pieces", F.col("k")).alias("piece"), "pack_id",
                      start.alias("start"), (end - start).alias("n_tokens"),
                      F.substring("ids", start * width + 1, (end - start) * width).alias("ids"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed and written; where each piece of it lies in the
    written rows, and the CRC-32 of its ids there."""
    path = scratch_path(spark, "packed")
    pack_documents(read_table(spark, sf_dir, "documents")).write.parquet(path)
    found = segments(spark.read.schema(ROW).parquet(path))
    return found.select("doc_id", "piece", "pack_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op10_packing": op10_packing}
SQL: dict[str, str] = {}
