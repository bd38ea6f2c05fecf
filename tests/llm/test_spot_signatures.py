from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from adtally.llm import spot_signatures as spots
from adtally.llm.queries import op7_spot_signatures
from tests.llm.helpers import awkward, documents, empty


def chains(text: str) -> set:
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    content = [i for i, w in enumerate(words) if w not in spots.ANCHORS]
    found = {tuple(words[i] for i in content[j : j + 3]) for j, i in enumerate(content) if i and words[i - 1] in spots.ANCHORS}
    return found or ({("all", *words)} if words else set())


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def expected(texts: list[str]) -> list[tuple]:
    out = []
    for i, text in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        mine = chains(text)
        out.append((len(text), hashlib.sha256(edited.encode()).hexdigest(), len(mine), jaccard(mine, chains(edited)), jaccard(mine, chains(after))))
    return out


def check(rows, texts):
    for row, want in zip(rows, expected(texts), strict=True):
        marks = [m for m in row["fingerprint"].split(",") if m]
        got = (row["n_chars"], row["edited_sha256"], len(marks), row["near_edited"], row["near_next"])
        assert got[:3] == want[:3]
        assert abs(got[3] - want[3]) < 1e-9 and abs(got[4] - want[4]) < 1e-9


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    rows = op7_spot_signatures(spark, folder).orderBy("doc_id").collect()
    check(rows, [r["text"] for r in docs])


def test_many_ranges_and_skewed_ids(spark):
    texts = [f"the word{i} of a thing{i % 7} and more text for it {i * i} to see" for i in range(400)]
    ids = [i if i < 390 else 10**15 + i for i in range(400)]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(5)
    found = spots.with_next_row(df, "doc_id", "text", {"after": "text"}, range_rows=3).orderBy("doc_id").collect()
    assert [r["after"] for r in found] == texts[1:] + texts[:1]


def test_equal_texts_and_pruning(spark):
    df = documents(spark, ["the cat of a house is on the mat", "the cat of a house is on the mat", "", None, "zebra"])
    rows = spots.fingerprint_neighbours(df).orderBy("doc_id").collect()
    assert rows[0]["fingerprint"] == rows[1]["fingerprint"] and rows[0]["near_next"] == 1.0
    assert rows[2]["near_next"] == 1.0 and rows[3]["near_next"] == 0.0 and rows[4]["near_next"] == 0.0
    pair = spark.range(1).select(F.array(F.lit(1)).alias("a"), F.array(*[F.lit(i) for i in range(1, 5)]).alias("b"))
    assert pair.select(spots.likeness(F.col("a"), F.col("b"))).first()[0] == 0.25
    assert pair.select(spots.likeness(F.col("a"), F.col("b"), floor=0.5)).first()[0] == 0.0


def test_awkward_and_empty(spark):
    df = awkward(spark)
    assert spots.fingerprint_neighbours(df).count() == df.count()
    assert spots.fingerprint_neighbours(empty(spark)).count() == 0
    assert spots.fingerprint_neighbours(documents(spark, ["the one text"])).first()["near_next"] == 1.0


def test_ranges_hold_many_ids_up_to_the_last(spark):
    """The last cut's range step follows the largest id: no range of its own for every id there."""
    df = spark.range(20_000).select("id", F.col("id").cast("string").alias("t"))
    made = spots.with_next_row(df, "id", "t", {"next_t": "t"}, range_rows=1000)
    assert made.filter((F.col("id") < 19_999) & (F.col("next_t") != (F.col("id") + 1).cast("string"))).isEmpty()
    ranges = []
    given = spots.stage
    try:
        spots.stage = lambda frame, label="table", **more: ranges.append(frame.count()) or given(frame, label, **more)
        spots.with_next_row(df, "id", "t", {"next_t": "t"}, range_rows=1000).count()
    finally:
        spots.stage = given
    assert ranges and max(ranges) <= 2 * spots.CUTS
