from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from adtally.llm import language_id
from adtally.llm.common import fold
from tests.llm.helpers import awkward, documents, empty
from tests.llm.test_line_templates import brute as brute_lines
from tests.llm.test_mixture import targets
from tests.llm.test_shingle_join import brute as brute_components


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    """Every stage's input and output, written as the pipeline does."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        step(spark, docs, folder).write.parquet(path)
        made = spark.read.parquet(path)
        out[name], docs = (docs, made), made
    return out


def texts(df) -> dict:
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(steps):
    first = steps["language"][0].columns
    assert all(steps[n][1].columns == first for n in ("language", "lines", "near_duplicates", "mixture"))


def test_language_keeps_clean_documents(steps):
    docs, kept = steps["language"]
    model = language_id.learn(docs, fold("doc_id", 3) != 1)
    given = texts(docs)
    names, _, unsure = model.predict(list(given.values()), 0.02)
    assert texts(kept) == {d: t for (d, t), n, u in zip(given.items(), names, unsure) if n != "und" and not u}
    assert len(texts(kept)) >= 0.98 * len(given)


def test_lines(steps):
    docs, kept = steps["lines"]
    assert texts(kept) == brute_lines(texts(docs), 10)
    assert kept.filter(F.col("n_chars") != F.length("text")).isEmpty()


def test_near_duplicates(steps):
    docs, kept = steps["near_duplicates"]
    expected = {d for d, _, c in brute_components(list(texts(docs).items())) if d == c}
    assert set(texts(kept)) == expected


def test_mixture(steps):
    docs, mix = steps["mixture"]
    sizes: dict = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    goal, got = targets(sizes), {}
    for r in mix.collect():
        got[r["source"]] = got.get(r["source"], 0) + len(r["text"].split())
    assert abs(sum(got.values()) - sum(goal.values())) <= 0.25 * sum(goal.values())
    assert mix.groupBy("doc_id").count().filter("count > 2").isEmpty()


def test_bpe(steps):
    docs, made = steps["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    given = texts(docs)
    assert made.count() == docs.count()
    for r in made.collect():
        ids = library.encode(given[r["doc_id"]], add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_run(spark, folder, steps):
    rows = corpus_pipeline.run(spark, folder)
    key = lambda r: (r["doc_id"], r["decoded"])
    assert sorted(map(key, rows.collect())) == sorted(map(key, steps["bpe"][1].collect()))


def test_awkward_rows_pass_every_stage(spark, folder, tmp_path):
    for number, docs in enumerate((awkward(spark), empty(spark), documents(spark, ["only one text"]))):
        for name, step in corpus_pipeline.STAGES:
            made = step(spark, docs, folder)
            assert name == "bpe" or made.columns == docs.columns
            made.write.parquet(f"{tmp_path}/{number}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{number}/{name}")


def test_repeated_rows_stay_once(spark, folder):
    df = documents(spark, ["one text of seven words is here", "another text that stands here alone"])
    rows = corpus_pipeline.near_duplicates(spark, df.unionByName(df), folder).collect()
    assert sorted(r["doc_id"] for r in rows) == [0, 1]
