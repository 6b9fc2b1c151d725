"""BPE encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from amity.llm import bpe as B  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(str(PATH))
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return B.Bpe(f.read())


def texts():
    rnd = random.Random(3)
    alphabet = ["the", "ing", " ", "  ", "\n", "\t", "é", "ß", "日本", "🙂", "'s", "'ll", "don't", "12", "½", "²", "_", "-",
                " ", "́", "\x1c", "\x85", "​", "<|endoftext|>", "A", "zq", "x", "!!", "...", "\r\n", " "]
    out = ["", " ", "\n\n ", "<|endoftext|>", "a<|endoftext|>b <|endoftext|", "a" * 5000, "zxqj" * 800, " " * 3000 + "x", "'" * 99]
    out += ["".join(rnd.choices(alphabet, k=rnd.randint(1, 60))) for _ in range(1500)]
    out += ["".join(rnd.choices("abcdehinorst", k=rnd.randint(1, 80))) for _ in range(800)]
    return out


def test_equals_library(own, library):
    for t in texts():
        ids = np.frombuffer(own.encode(t), "<u4").tolist()
        assert ids == library.encode(t, add_special_tokens=False).ids, repr(t)
        assert own.decode(own.encode(t)).decode() == library.decode(ids, skip_special_tokens=False) == t


def test_every_character(own, library):
    """Each character between letters, digits, marks and spaces."""
    wrong = []
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]):
        t = f"a{c}a 1{c}1 !{c}! {c}"
        if own.pieces(t) != [t[s:e] for _, (s, e) in library.pre_tokenizer.pre_tokenize_str(t)]:
            wrong.append(hex(ord(c)))
    assert not wrong, (len(wrong), wrong[:20])


def test_decodes_cut_characters(own, library):
    ids = library.encode("日本🙂").ids
    for part in (ids[:1], ids[1:], ids[:-1]):
        blob = np.array(part, "<u4").tobytes()
        assert own.decode(blob).decode() == library.decode(part, skip_special_tokens=False)


def test_query(spark, library):
    rows = [(1, "hello world", "x"), (2, None, None), (None, "", "y"), (1, "hello world", "x"), (3, "é" * 40000, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, N_TOKENS string")
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.round_trip(df).collect())
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    back = B.decode_ids(B.encode_texts(df)).collect()
    assert sorted(r.decoded for r in back) == sorted(t or "" for _, t, _ in rows)
    assert B.round_trip(df.limit(0)).count() == 0
