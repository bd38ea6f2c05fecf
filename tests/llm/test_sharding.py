from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from adtally.llm import sharding
from adtally.llm.queries import op12_kd_shards
from tests.llm.helpers import awkward, documents, empty


def check_slots(rows):
    by_shard = {}
    for row in rows:
        by_shard.setdefault(row["shard"], []).append(row["slot"])
    for slots in by_shard.values():
        assert sorted(slots) == list(range(len(slots)))


def bytes_of(rows, shards):
    return [sum(r["size"] for r in rows if r["shard"] == s) for s in range(shards)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_over_the_whole_table(spark, sf):
    folder = f"/root/testdata/{sf}"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op12_kd_shards(spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert r["size"] == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    check_slots(rows)
    sizes = bytes_of(rows, 8)
    # Three cuts, each within half a document or the tolerance.
    allowed = 3 * (max(len(t.encode()) + 1 for t in texts.values()) / 2 + 0.01 * sum(sizes) / 8)
    assert max(abs(s - sum(sizes) / 8) for s in sizes) <= allowed


def test_rows_of_a_shard_share_a_box(spark, folder):
    """The tree cuts along one dimension at a time: with one dimension, shards are ranges of it."""
    docs = documents(spark, ["word " * (i % 7 + 1) for i in range(400)])
    rows = sharding.shard_by_bytes(docs, shards=5, dimensions=["doc_id"]).collect()
    order = [r["shard"] for r in sorted(rows, key=lambda r: r["doc_id"])]
    # Neighbouring numbers share a coordinate, so only such a pair may be out of order.
    assert sorted(order) == [s for s in order] or sum(a > b for a, b in zip(order, order[1:])) <= 4
    sizes = bytes_of(rows, 5)
    assert max(sizes) - min(sizes) <= 3 * 36


@pytest.mark.parametrize("hot", ["text", "id", "row"])
def test_hot_values_are_split(spark, hot):
    rows = [(i, f"text number {i}", "en", "s", 0) for i in range(600)]
    if hot == "text":
        rows += [(1000 + i, "the same text", "en", "hot", 0) for i in range(400)]
    elif hot == "id":
        rows += [(7, f"another text {i}", "en", "hot", 0) for i in range(400)]
    else:
        rows += [(7, "the same row", "en", "hot", 0)] * 400
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = sharding.shard_by_bytes(df, shards=8).collect()
    sizes = bytes_of(made, 8)
    assert len(made) == 1000 and max(sizes) - min(sizes) <= 100
    check_slots(made)


def test_small_groups_of_equal_texts_are_not_cut_apart_by_a_tie(spark):
    rows = [(0, f"text {i // 3}", "en", "s", 0) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    made = sharding.shard_by_bytes(df, shards=8, keep=("text",)).collect()
    assert len({(r["text"], r["shard"]) for r in made}) == 1000


def test_awkward_rows(spark):
    df = awkward(spark).withColumns({name: F.lit("x") for name in ("k0", "d0", "tie", "row", "node", "shard", "slot", "at", "part", "spread", "crc")})
    made = sharding.shard_by_bytes(df, shards=8).collect()
    assert len(made) == df.count()
    check_slots(made)
    assert sharding.shard_by_bytes(empty(spark), shards=8).count() == 0
    assert {r["shard"] for r in sharding.shard_by_bytes(documents(spark, [None]), shards=8).collect()} <= set(range(8))


def test_target_bytes_and_writing(spark, tmp_path):
    docs = documents(spark, [f"some text of row {i}" for i in range(1000)])
    made = sharding.shard_by_bytes(docs, target_bytes=2_000, keep=("doc_id", "text"))
    rows = made.collect()
    total = sum(r["size"] for r in rows)
    shards = -(-total // 2_000)
    assert {r["shard"] for r in rows} == set(range(shards))
    assert max(bytes_of(rows, shards)) <= 2_100
    sharding.write_shards(made, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).select("text").distinct().count() == 1000
    with pytest.raises(ValueError):
        sharding.shard_by_bytes(docs)
