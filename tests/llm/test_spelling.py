from __future__ import annotations

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adtally.llm import spelling
from adtally.llm.fm_index import WordIndex
from adtally.llm.queries import SPELLING_SQL, op13_spelling
from tests.llm.helpers import awkward, documents, empty


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows, least_count=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least_count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def as_set(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_equals_brute_force(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = brute_force(docs)
    got = as_set(op13_spelling(spark, folder))
    assert got == want and any(row[1] for row in got)


def test_query_equals_sql(spark, folder):
    from check_oracles import compare, connect

    assert compare(spark, connect(folder), folder, "op13_spelling", op13_spelling, SPELLING_SQL).startswith("ok")


def chained(spark):
    texts = ["lettern " * 700, "letterm " * 130 + "lettexm " * 25 + "lattexm " * 5, "letter " * 6, "ÀÉÎõüÿ " * 5 + "àéîõüÿ " * 30, "×÷×÷×÷ " * 5]
    return documents(spark, texts)


def test_chains_and_letters(spark):
    df = chained(spark)
    want = brute_force([(r.doc_id, r.text) for r in df.collect()])
    assert as_set(spelling.spelling_forms(df)) == want
    roots = {row[0]: row[2] for row in want}
    assert roots["lattexm"] == "lettern" and roots["ÀÉÎõüÿ"] == "ÀÉÎõüÿ"


def test_blocks_and_parts_lose_no_pair(spark, folder):
    words = spelling.count_words(spark.read.parquet(f"{folder}/documents.parquet"), least_count=2)
    whole = {(r.word, r.near, r.near_n) for r in spelling.near_words(words).collect()}
    cut = spelling.near_words(words, block_words=50, asked_at_once=30).collect()
    assert len(cut) == len(whole) and {(r.word, r.near, r.near_n) for r in cut} == whole


def test_words_sharing_one_half(spark):
    """A half that fills many blocks: every word of it asks all of them."""
    names = [f"prefix{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    words = spark.createDataFrame([(w, 5) for w in names], "word string, n long")
    got = {(r.word, r.near) for r in spelling.near_words(words, block_words=40, asked_at_once=100).collect()}
    assert got == {(a, b) for a in names for b in names if one_edit(a, b)}


@pytest.mark.parametrize("first_half", [True, False])
def test_index_with_unknown_letters_and_long_words(first_half):
    words = ["a" * 3000, "a" * 2999 + "b", "bcdefg", "ab" * 500]
    index = WordIndex(words)
    found = set(zip(*(part.tolist() for part in index.near([*words, "zzzzzz", "bcdefgz"], first_half=first_half)), strict=True))
    assert found == ({(0, 1), (1, 0), (5, 2)} if first_half else set())


def test_awkward_rows(spark):
    df = awkward(spark).withColumns({name: F.lit("x") for name in ("word", "near", "form", "root", "block", "asks", "of")})
    want = brute_force([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    assert as_set(spelling.spelling_forms(df)) == want
    assert spelling.spelling_forms(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_forms(df, times=1)
