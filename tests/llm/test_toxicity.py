"""Toxicity: FTRL-proximal against held-out labels and its own definition."""

import os
import random
import zlib

import numpy as np
import pytest

from amity.llm import toxicity as T

BAD = ["vile", "odious", "rotten"]
KIND = "doc_id bigint, text string, SCORE string, _t_score int"


def corpus(n=900):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.2
        text = rnd.choices(words, k=rnd.randint(5, 120))
        if toxic:
            text[rnd.randrange(len(text))] = rnd.choice(BAD)
        rows.append((i, " ".join(text), "x", 1))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_features_are_of_whole_texts():
    a, b = "one two three four", "One, two; THREE four"
    assert T.features(a).tolist() == T.features(b).tolist()
    assert len(T.features(a)) == 4 + 3 + 2 + 1
    assert not len(T.features(None)) and not len(T.features(" .\n"))
    assert set(T.features("vile")) <= set(T.features("w " * 50000 + "vile"))


def test_train_is_ftrl_proximal():
    rnd = np.random.default_rng(1)
    rows = [(np.sort(rnd.choice(16, 5, replace=False)), int(rnd.integers(2))) for _ in range(30)]
    z, n = [0.0] * 17, [0.0] * 17

    def weight(i):
        l1 = 0.0 if i == 16 else 0.5
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((1.0 + n[i] ** 0.5) / 0.2 + 0.1)

    for _ in range(3):
        for f, y in rows:
            idx = [*f, 16]
            w = [weight(i) for i in idx]
            g = 1 / (1 + np.exp(-sum(w))) - y
            for i, x in zip(idx, w):
                s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.2
                z[i] += g - s * x
                n[i] += g * g
    got = T.train(rows, bits=4, passes=3, alpha=0.2, beta=1.0, l1=0.5, l2=0.1)
    assert np.allclose(got, [weight(i) for i in range(17)])
    assert (got == 0).any()


def test_learns_and_handles_odd_rows(spark):
    rows, labels = corpus()
    truth = {i: any(b in t for b in BAD) for i, t, *_ in rows}
    rows += [(9000, None, "x", 1), (9001, "", None, None), (None, "so vile", "x", 1), (9002, "long " * 60000 + "odious", "x", 1), (5, rows[5][1], "x", 1)]
    labels += [(None, 1, 1), (1, 0, None), (77777, 1, 1), labels[3]]
    df = spark.createDataFrame(rows, KIND).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    out = T.toxicity(df, marks).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [r for r in out if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(bool(r.predicted) == truth[r.doc_id] for r in held) / len(held) > 0.95
    by = {r.doc_id: r for r in out}
    assert by[9002].predicted == 1 and by[9000].score == by[9001].score < 0.5


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus(200)
    df = spark.createDataFrame(rows, KIND)
    flip = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (T.fit(df, spark.createDataFrame(x, "doc_id bigint, quality int, toxic int")) for x in (labels, flip))
    assert np.array_equal(a, b)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "text", "x", 1)], KIND)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r.score for r in T.toxicity(df, none).collect()] == [T.NO_LABELS]
    assert T.toxicity(df.limit(0), none).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver test data not present")
def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = T.op5_toxicity(spark, sf).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    wrongly = sum(r.predicted > r.toxic for r in rows)
    assert right > 0.95 and wrongly <= 0.01 * len(rows)
