"""Byte-level BPE encoding and decoding of whole texts.

The encoder never runs the merge loop. An Aho-Corasick automaton over all
token strings gives, for each position of a pre-token, the longest token that
starts there. A backtracking pass takes the longest match, and falls back to
the next shorter token (a prefix table) where two neighbours could not stand
side by side in a merged result. Whether they can is read from the pair table:
undo the later of the two tokens' merges at the seam, one at a time, and see
if an earlier merge would have joined the parts across it. Positions found to
lead nowhere are marked once, so the pass is linear in the text, and the
result is exactly the merge loop's. Decoding copies slices of one byte string
through an offset table.

Each text is encoded on its own in a projection over the scan: no shuffle, no
state a lost executor could take along. A worker keeps a bounded memo of
pre-tokens (emptied when full), which changes speed only.

Defined results: a NULL text is encoded as the empty one (no tokens, decodes
to empty); repeated rows each get their own result; a NULL doc_id passes
through; an empty table gives an empty table. Very long texts are encoded
whole, also where they hold no space at all.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, read_table

MEMO = 400_000  # pre-tokens a worker remembers
LIMIT = 1 << 31


@lru_cache(1)
def byte_letters() -> dict[str, int]:
    """The letters byte-level vocabularies write bytes with: printable Latin-1
    characters stand for themselves, the others for 256, 257, ... in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


# Letters (L) and numbers (N) that Unicode 16, the version the
# tokenizers library splits by, added to 15.1, Python 3.13's version.
UNICODE_16 = """
L 1c89-1c8a L a7cb-a7cd L a7da-a7dc L 105c0-105f3 N 10d40-10d49 L 10d4a-10d65 L 10d6f-10d85 L 10ec2-10ec4
L 11380-11389 L 1138b-1138b L 1138e-1138e L 11390-113b5 L 113b7-113b7 L 113d1-113d1 L 113d3-113d3
N 116d0-116e3 L 11bc0-11be0 N 11bf0-11bf9 L 13460-143fa L 16100-1611d N 16130-16139 L 16d40-16d6c
N 16d70-16d79 L 18cff-18cff N 1ccf0-1ccf9 L 1e5d0-1e5ed L 1e5f0-1e5f0 N 1e5f1-1e5fa
"""


@lru_cache(2)
def pre_token_pattern(last: int = 0x10FFFF) -> re.Pattern:
    """The byte-level pre-tokenizer's pattern, with the Unicode properties
    spelled out as character ranges, for texts of characters up to ``last``
    (the re module tests ranges beyond 0xFFFF one by one, which is slow)."""
    kinds: dict[str, list[list[int]]] = {"L": [], "N": [], "Z": []}
    for k in range(last + 1):
        c = chr(k)
        kind = "Z" if c.isspace() and not "\x1c" <= c <= "\x1f" else unicodedata.category(c)[0]
        if kind == "Z" and not c.isspace():
            continue
        if kind in kinds:
            runs = kinds[kind]
            if runs and runs[-1][1] == k - 1:
                runs[-1][1] = k
            else:
                runs.append([k, k])
    more = UNICODE_16.split()
    for kind, run in zip(more[::2], more[1::2], strict=True):
        ends = [int(x, 16) for x in run.split("-")]
        if ends[1] <= last:
            kinds[kind].append(ends)
    letter, number, space = ("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in kinds[k]) for k in "LNZ")
    # Fixed value: the order of the alternatives
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


class Bpe(dict):
    """Tables of one tokenizer, and the memo: pre-token -> ids as bytes."""

    def __init__(self, tokenizer_json: str) -> None:
        super().__init__()
        spec = json.loads(tokenizer_json)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        strings = {t: bytes(letters[c] for c in t) for t in vocab}
        # tokens in the order merges make them: the bytes, then merge by merge
        first = [t for t, b in strings.items() if len(b) == 1]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        order = first + [a + b for a, b in merges]
        if len(set(order)) != len(order) or set(order) != set(vocab):
            raise ValueError("every token must be one byte or made by exactly one merge")
        rank = {t: k for k, t in enumerate(order)}
        self.strings = [strings[t] for t in order]
        self.sizes = [len(b) for b in self.strings]
        self.parts = [(k, k) for k in range(len(first))] + [(rank[a], rank[b]) for a, b in merges]
        self.merged = {p: k + len(first) for k, p in enumerate(self.parts[len(first):])}
        self.seams: dict[tuple[int, int], bool] = {}
        # a token stands in a result only if merging its own string gives it back
        made = [True] * len(order)
        for k in range(len(first), len(order)):
            a, b = self.parts[k]
            made[k] = made[a] and made[b] and self._meets(a, b, k)
        where = {s: k for k, s in enumerate(self.strings) if made[k]}
        self.matcher = ahocorasick.Automaton()
        for s, k in where.items():
            self.matcher.add_word(s.decode("latin-1"), k)
        self.matcher.make_automaton()
        self.shorter = [next((where[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in where), -1) for s in self.strings]
        self.packed = [vocab[t].to_bytes(4, "little") for t in order]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        names = sorted(self.special, key=len, reverse=True)
        self.split = re.compile("|".join(map(re.escape, names))) if names else None
        # decoding: all token strings end to end, and where each id's starts
        by_id = {vocab[t]: b for t, b in strings.items()} | {k: t.encode() for t, k in self.special.items()}
        self.joined = np.frombuffer(b"".join(by_id.get(k, b"") for k in range(max(by_id) + 1)), np.uint8)
        self.offsets = np.cumsum([0] + [len(by_id.get(k, b"")) for k in range(max(by_id) + 1)])
        self.update((t, self.__missing__(t)) for t in map(self._text, where) if t)

    @staticmethod
    def _text(token: bytes) -> str | None:
        try:
            return token.decode()
        except UnicodeDecodeError:  # part of a character
            return None

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The pre-tokens of ``text``, end to end."""
        plane = len(text.encode("utf-16-le")) == 2 * len(text)
        return pre_token_pattern(0xFFFF if plane else 0x10FFFF).findall(text)

    def _meets(self, a: int, b: int, limit: int = LIMIT) -> bool:
        """Whether no merge before ``limit`` joins the neighbours a and b, or
        what they are made of, across the seam between them."""
        parts, merged = self.parts, self.merged
        while True:
            joined = merged.get((a, b), limit)
            if joined < limit:
                return False
            # undo the later merge on the seam; from then on only an earlier
            # merge across the seam would have come first. Of two equal ones the
            # left is made first, so the right one is undone first
            left, right = parts[a][1] != a, parts[b][0] != b
            if left and (a > b or not right):
                limit, a = a, parts[a][1]
            elif right:
                limit, b = b + 1, parts[b][0]
            else:
                return True

    def beside(self, a: int, b: int) -> bool:
        if len(self.seams) >= MEMO:
            self.seams.clear()
        ok = self.seams[a, b] = self._meets(a, b)
        return ok

    def tokens(self, piece: bytes) -> list[int]:
        """One pre-token's tokens, by merge order."""
        longest = [-1] * len(piece)
        sizes, seams, beside = self.sizes, self.seams, self.beside
        for end, token in self.matcher.iter(piece.decode("latin-1")):
            longest[end + 1 - sizes[token]] = token  # a later end is a longer match
        n, at, last = len(piece), 0, -1
        out: list[int] = []
        dead: set[int] = set()
        token = longest[0]
        while at < n:
            while token >= 0:
                if at + sizes[token] not in dead:
                    fits = True if last < 0 else seams.get((last, token))
                    if fits or fits is None and beside(last, token):
                        break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                last = token
                at += sizes[token]
                token = longest[at] if at < n else -1
            else:  # nothing goes on from here: take the last token back
                dead.add(at)
                token = out.pop()
                at -= sizes[token]
                token, last = self.shorter[token], out[-1] if out else -1
        return out

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        ids = b"".join([self.packed[t] for t in self.tokens(piece.encode())])
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.split is None or not self.split.search(text):
            return b"".join(map(self.__getitem__, self.pieces(text)))
        out, at = [], 0
        for m in self.split.finditer(text):
            out += map(self.__getitem__, self.pieces(text[at:m.start()]))
            out.append(self.special[m[0]].to_bytes(4, "little"))
            at = m.end()
        return b"".join([*out, *map(self.__getitem__, self.pieces(text[at:]))])

    def decode(self, ids: bytes, step: int = 1 << 16) -> bytes:
        """The bytes the ids stand for, as valid UTF-8."""
        found, out = np.frombuffer(ids, "<u4"), []
        for k in range(0, len(found), step):
            part = found[k:k + step]
            start = self.offsets[part]
            size = self.offsets[part + 1] - start
            ends = np.cumsum(size)
            out.append(self.joined[np.repeat(start - (ends - size), size) + np.arange(ends[-1])].tobytes())
        text = b"".join(out)
        try:
            text.decode()
        except UnicodeDecodeError:  # ids cut inside a character
            text = text.decode(errors="replace").encode()
        return text


@lru_cache(2)
def tables(tokenizer_json: str) -> Bpe:
    """A worker builds the tables of a tokenizer once."""
    return Bpe(tokenizer_json)


def _spec(spark: SparkSession, tokenizer: str) -> Broadcast:
    """The tokenizer file's text; a fixed vocabulary, a few MB."""
    with open(tokenizer, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def encode_texts(df: DataFrame, tokenizer: str | None = None, text: str = "text") -> DataFrame:
    """``df`` plus ``token_ids`` (binary: little-endian unsigned 32-bit ids of
    the whole text) and ``n_tokens``."""
    spec = _spec(df.sparkSession, tokenizer or default_tokenizer())

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tables(spec.value)
        for texts in batches:
            yield pd.Series([bpe.encode(t or "") for t in texts], dtype=object)

    cols = [F.col(col_ref(c)) for c in df.columns if c.lower() not in ("token_ids", "n_tokens")]
    out = df.select(*cols, encode(F.col(col_ref(text)).cast("string")).alias("token_ids"))
    return out.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


def decode_ids(df: DataFrame, tokenizer: str | None = None, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``df`` plus the text that the ids in column ``ids`` stand for."""
    spec = _spec(df.sparkSession, tokenizer or default_tokenizer())

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = tables(spec.value)
        for blobs in batches:
            yield pd.Series([bpe.decode(b or b"").decode() for b in blobs], dtype=object)

    cols = [F.col(col_ref(c)) for c in df.columns if c.lower() != text.lower()]
    return df.select(*cols, decode(F.col(col_ref(ids))).alias(text))


def round_trip(df: DataFrame, tokenizer: str | None = None, text: str = "text", with_ids: bool = False) -> DataFrame:
    """``df`` less its texts, plus ``n_tokens`` and the SHA-256 of the ids and
    of what they decode to (and the ids themselves): encoding and decoding in
    one pass, so neither ids nor texts travel back only to be hashed. Copies of
    a document that follow each other are encoded once."""
    spec = _spec(df.sparkSession, tokenizer or default_tokenizer())
    kind = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids binary" * with_ids

    @F.pandas_udf(kind)
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe, last, found = tables(spec.value), None, None
        for texts in batches:
            rows = []
            for t in texts:
                if found is None or t != last:
                    last, ids = t, bpe.encode(t or "")
                    found = ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()
                rows.append(found)
            out = {"n_tokens": np.array([len(r[0]) // 4 for r in rows], np.int64),
                   "ids_sha256": [r[1] for r in rows], "decoded_sha256": [r[2] for r in rows]}
            yield pd.DataFrame(out | ({"token_ids": [r[0] for r in rows]} if with_ids else {}))

    made = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["token_ids"] * with_ids
    rest = [F.col(col_ref(c)) for c in df.columns if c.lower() not in [text.lower(), *made]]
    return df.select(*rest, both(F.col(col_ref(text)).cast("string")).alias("made__")).select(
        *rest, *[F.col(f"made__.{c}") for c in made])


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded again."""
    return round_trip(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the token ids of every document, checked by decoding."""
    return round_trip(docs.select("doc_id", "source", "text"), with_ids=True)


QUERIES = {"op6_bpe": op6_bpe}
SQL: dict[str, str] = {}
