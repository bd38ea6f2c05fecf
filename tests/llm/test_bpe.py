from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from adtally.llm import bpe
from adtally.llm.queries import op1_bpe
from tests.llm.helpers import awkward, documents, empty

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_words_match_the_library(library):
    rng, own = random.Random(3), bpe.vocabulary(PATH)
    letters = "abcdefghijklmnopqrstuvwxyzaeinstéüñ0!?'- "
    words = ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(5000)]
    words += ["a" * k for k in range(1, 80)] + ["ab" * k for k in range(1, 60)] + ["x" * 20_000]
    for word in words:
        assert own.encode(word).tolist() == library.encode(word, add_special_tokens=False).ids, word


def test_every_simple_code_point_matches_the_library(library):
    own = bpe.vocabulary(PATH)
    for c in map(chr, range(1, 0x250)):
        for text in (c, c + c, f"a{c}b", f"{c}ab", f"ab{c}", f"a{c}{c}b", f"x {c} y", f"A{c}B"):
            assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_random_simple_texts_match_the_library(library):
    rng, own = random.Random(5), bpe.vocabulary(PATH)
    letters = [chr(c) for c in range(1, 0x250)] + ["\u0130", "\u018f", "\u212a", "\u1e9e", "\u0307", "\u0301", "e\u0301"]
    for _ in range(20_000):
        text = "".join(rng.choices(letters, k=rng.randint(1, 12)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_awkward_rows(spark, library):
    df = awkward(spark)
    rows = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(rows) == df.count()
    by_text = {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    for row in rows:
        ids = library.encode(by_text[row["doc_id"]] or "", add_special_tokens=False).ids
        assert list(row["ids"]) == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_null_ids_and_empty_tables(spark):
    assert bpe.decode(bpe.encode(empty(spark), PATH), PATH).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["decoded"] for r in bpe.decode(nulls, PATH).collect()} == {""}


def test_query(spark, folder, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op1_bpe(spark, folder).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode(docs[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_workers_remember_nothing_after_a_task(spark):
    """A worker process waits on through other operators; its remembered words would stand beside theirs."""
    texts = documents(spark, [f"some words {w} of text {i}" for i, w in enumerate("abcdefghijkl")])
    bpe.encode(texts.repartition(4), PATH).collect()

    def known(batches):
        for _ in batches:
            own = bpe.vocabulary(PATH)
            yield pa.RecordBatch.from_pydict({"n": [len(own.words) + len(own.runs) + len(own.pairs)]})

    rows = spark.range(0, 8, 1, 4).mapInArrow(known, "n long").collect()
    assert len(rows) >= 4 and not any(r["n"] for r in rows)
