from __future__ import annotations

import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from adtally.llm import language_id
from adtally.llm.common import fold
from adtally.llm.queries import op10_language_id
from tests.llm.helpers import awkward, documents, empty


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = op10_language_id(spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_the_text_decides(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.learn(docs, fold("doc_id", 3) != 1)
    plain = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model).collect()}
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("yy")})
    assert plain == {r["doc_id"]: r["lang_pred"] for r in language_id.predict(other, model).collect()}


def test_codewords_differ():
    for classes in (2, 3, 4, 5, 9, 20):
        code = language_id.codebook(classes)
        gaps = [int((code[a] != code[b]).sum()) for a, b in itertools.combinations(range(classes), 2)]
        assert min(gaps) >= max(1, code.shape[1] // 4)
        assert all(0 < (column > 0).sum() < classes for column in code.T)


def test_decoding_mends_a_wrong_bit():
    code = language_id.codebook(4)
    model = language_id.LanguageModel(list("abcd"), code, np.zeros((language_id.FEATURES, 7), np.float32), np.zeros(7), np.full(7, 1 / 7))
    for wanted in range(4):
        for wrong in range(7):
            model.bias = code[wanted] * 4.0
            model.bias[wrong] *= -1
            assert model.predict(["some text"], 0.02)[0] == ["abcd"[wanted]]
    model.bias = np.zeros(7)
    assert model.predict(["some text"], 0.02)[2].all()


def test_many_languages():
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for language in range(9):
        letters = rng.permutation(list("abcdefghijklmnopqrstuvwxyz"))[:8]
        for _ in range(30):
            texts.append(" ".join("".join(rng.choice(letters, 5)) for _ in range(30)))
            labels.append(f"l{language}")
    x, _ = language_id.features(texts)
    model = language_id.train(x[::2].astype(float), labels[::2])
    names = model.predict(texts[1::2], 0.0)[0]
    assert np.mean([a == b for a, b in zip(names, labels[1::2])]) >= 0.95


def test_awkward_and_empty(spark):
    df = awkward(spark)
    model = language_id.learn(df, F.lit(True))
    rows = language_id.predict(df, model, keep=("doc_id", "text", "score"), prefix="own_").collect()
    assert len(rows) == df.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["own_lang_pred"] == "und") == (not letters) and (letters or r["own_score"] == 0)
    assert language_id.learn(empty(spark), F.lit(True)).languages == []
    none = language_id.predict(documents(spark, ["abc", ""]), language_id.learn(empty(spark), F.lit(True))).collect()
    assert [r["lang_pred"] for r in none] == ["und", "und"]
