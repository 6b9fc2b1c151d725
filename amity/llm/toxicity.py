"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

*Features.* A whole text's words (lower case), pairs of neighbouring words and
skip-grams (pairs with one or two words between) are hashed to ``BITS`` bits;
what counts is which features a text holds, not how often.

*Training.* FTRL-proximal keeps two numbers a feature: its own learning rate
falls with its own gradients, and L1 holds every weight at exactly zero until
the evidence outweighs it. It reads a sample of at most ``SAMPLE_ROWS``
labelled documents (the first by a hash of doc_id, so the same at every run),
whose features Spark extracts in parallel; one task runs the passes. That
bound is the only one: the score covers every whole document.

*Scoring.* The few weights left are one array of 2**BITS floats, broadcast.

Labels are learnt only where crc32(doc_id) mod 5 is not 0. Defined results: a
NULL or empty text has no features and gets the score of the intercept;
repeated rows score alike; a doc_id labelled more than once is toxic if any
label says so, a NULL label says nothing; several texts under one doc_id: the
smallest is learnt from; a NULL doc_id is never learnt from and counts as held
out; no labels at all give every text ``NO_LABELS``; empty tables give none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amity.llm.tables import col_ref, free_name, read_table, written

BITS = 20
SAMPLE_ROWS = 16_000
PASSES = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0
FOLDS = 5          # fixed value of the contract
NO_LABELS = 0.25   # below the threshold: nothing is called toxic unlearnt
MEMO = 300_000     # words a worker remembers the hash of
WORD = re.compile(r"\w+")


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """The distinct feature numbers of one text, ascending."""
    words = WORD.findall((text or "").lower())
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    all_ = [h * np.uint64(0x9E3779B97F4A7C15)]
    for gap, odd in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9), (3, 0xD6E8FEB86659FD93)):
        # the hash of the pair, with the distance between its words
        x = (h[:-gap] ^ np.uint64(odd)) * np.uint64(0xBF58476D1CE4E5B9) + h[gap:]
        all_.append((x ^ (x >> np.uint64(31))) * np.uint64(odd))
    return np.unique((np.concatenate(all_) >> np.uint64(64 - bits)).astype(np.int32))


def train(rows: list[tuple[np.ndarray, int]], bits: int = BITS, passes: int = PASSES, alpha: float = ALPHA,
          beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights by feature number; the last entry is the intercept."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weight(i: np.ndarray) -> np.ndarray:
        over = np.abs(z[i]) - np.where(i == size, 0.0, l1)
        return np.where(over > 0, -np.sign(z[i]) * over / ((beta + np.sqrt(n[i])) / alpha + l2), 0.0)

    rows = [(np.append(f, size), y) for f, y in rows]
    for _ in range(passes):
        for i, y in rows:
            w = weight(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weight(np.arange(size + 1))


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> np.ndarray | None:
    """Weights learnt from the labels outside fold 0, None without any."""
    known = labels.where(F.col(col_ref(label)).isNotNull() & F.col(col_ref(doc_id)).isNotNull() & (fold(F.col(col_ref(doc_id))) != 0))
    sample = written(known.groupBy(F.col(col_ref(doc_id)).alias("_t_id")).agg(F.max((F.col(col_ref(label)) == 1).cast("int")).alias("_t_y"))
                     .orderBy(F.xxhash64("_t_id"), "_t_id").limit(sample_rows), "toxicity-sample")
    value = F.col(col_ref(text)).cast("string")
    texts = docs.select(F.col(col_ref(doc_id)).alias("_t_id"), value.alias("_t_text"))

    @F.pandas_udf("array<int>")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, bits) for t in texts])

    # at most sample_rows short rows: a proven bound
    chosen = texts.join(F.broadcast(sample), "_t_id").groupBy("_t_id", "_t_y").agg(F.min("_t_text").alias("_t_text")) \
        .select("_t_id", "_t_y", hashed("_t_text").alias("f"))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(i, np.asarray(f, np.int64), y) for b in batches for i, f, y in zip(b["_t_id"], b["f"], b["_t_y"], strict=True)]
        if rows:
            rows.sort(key=lambda r: xxhash.xxh64_intdigest(str(r[0])))
            w = train([(f, y) for _, f, y in rows], bits)
            at = np.flatnonzero(w)
            at = np.union1d(at, [len(w) - 1])
            yield pd.DataFrame({"at": at, "w": w[at]})

    found = chosen.repartition(1).mapInPandas(learn, "at bigint, w double").toPandas()
    if not len(found):
        return None
    out = np.zeros((1 << bits) + 1, np.float32)
    out[found["at"].to_numpy()] = found["w"].to_numpy()
    return out


def score_texts(df: DataFrame, weights: np.ndarray | None, text: str = "text", bits: int = BITS, into: str = "score") -> DataFrame:
    """``df`` plus the probability that each whole text is toxic."""
    cols = [F.col(col_ref(c)) for c in df.columns if c.lower() != into.lower()]
    if weights is None:
        return df.select(*cols, F.lit(NO_LABELS).alias(into))
    model = df.sparkSession.sparkContext.broadcast(weights)  # 4 MB

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        w = model.value
        logit = np.array([w[features(t, bits)].sum(dtype=np.float64) + w[-1] for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(logit, -35, 35))))

    return df.select(*cols, score(F.col(col_ref(text)).cast("string")).alias(into))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``, learnt from ``labels``."""
    scored = score_texts(docs, fit(docs, labels, doc_id, text, label), text, into=free_name(docs, "_t_score"))
    kept = [F.col(col_ref(c)) for c in docs.columns if c.lower() not in ("score", "predicted")]
    score = F.col(col_ref(scored.columns[-1]))
    return scored.select(*kept, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, read_table(spark, sf_dir, "labels")).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


QUERIES = {"op5_toxicity": op5_toxicity}
SQL: dict[str, str] = {}
