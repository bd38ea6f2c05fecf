from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from adtally.llm import quality
from adtally.llm.common import fold
from adtally.llm.queries import op4_quality
from tests.llm.helpers import awkward, documents, empty


def plain_features(text: str) -> dict:
    """Hashed features one by one: words, neighbours, and n-grams of words with their borders."""
    out: dict = {}

    def add(kind, *parts):
        out[(kind, *parts)] = out.get((kind, *parts), 0) + 1

    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    for w in words:
        add("word", w)
    for a, b in zip(words, words[1:]):
        add("pair", *(("same",) if a == b else (a, b)))
    padded = f"\n{text}\n"
    blank = lambda c: c in "\x20\x09\x0a\x0b\x0c\x0d"
    for size in quality.GRAMS:
        for i in range(len(padded) - size + 1):
            gram = padded[i : i + size]
            if not any(map(blank, gram[1:-1])):
                add(size, gram)
    return out


def test_features_are_counted_as_described():
    for text in ("the the cat  sat\non the mat", "a", "", " \n", "été 日本語 🙂🙂 x"):
        found = quality.hashed_features([text])
        counts = sorted(np.unique(np.concatenate([f[0] for f in found]), return_counts=True)[1].tolist()) if found else []
        assert counts == sorted(plain_features(text).values())
    batch = quality.hashed_features(["a b", "c d e"])
    assert [np.bincount(owner, minlength=2).tolist() for _, owner in batch][0] == [2, 3]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op4_quality(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95
    good = [r["score"] for r in held if truth[r["doc_id"]]]
    bad = [r["score"] for r in held if not truth[r["doc_id"]]]
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_score_is_that_of_the_mean_vector():
    texts = ["good clean words " * 5, "### $$$ !!! " * 5] * 10
    examples = []
    for t in texts:
        rows, counts = np.unique(np.concatenate([f[0] for f in quality.hashed_features([t])]), return_counts=True)
        examples.append((rows, counts.astype(float)))
    model = quality.train(examples, np.array([1, 0] * 10), epochs=40)
    scores = model.score(texts)
    assert (scores[::2] > 0.7).all() and (scores[1::2] < 0.3).all()
    rows, counts = examples[0]
    logit = (model.weights[rows] * counts).sum() / counts.sum() + model.bias
    assert abs(scores[0] - 1 / (1 + np.exp(-logit))) < 1e-9


def test_awkward_and_empty(spark):
    df = awkward(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (6, None), (None, 1)], "doc_id long, quality int")
    model = quality.learn(df, labels, F.lit(True))
    rows = quality.score(df, model).collect()
    assert len(rows) == df.count() and all(0 <= r["score"] <= 1 for r in rows)
    blank = {r["score"] for r in rows if r["doc_id"] in (0, 1, 2, 3)}
    assert len(blank) == 1
    none = quality.learn(df, labels.limit(0), fold("doc_id", 5) != 0)
    assert {r["score"] for r in quality.score(documents(spark, ["a", None]), none).collect()} == {0.5}
    assert quality.score(empty(spark), none).count() == 0
