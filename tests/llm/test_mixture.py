from __future__ import annotations

import re

from pyspark.sql import functions as F

from adtally.llm import mixture
from adtally.llm.queries import op6_mixture
from tests.llm.helpers import awkward, documents, empty

WORD = re.compile("[^\x20\x09-\x0d]+")


def targets(sizes: dict, share=1.5, most=2.0) -> dict:
    """Share by weight, stop at the limits, share the excess again, until none is above."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: (5.0, 2.0, 1.0)[i % 3] for i, n in enumerate(names)}
    total, capped, out = share * sum(sizes.values()), set(), {}
    while True:
        free = [n for n in names if n not in capped]
        rest = total - sum(most * sizes[n] for n in capped)
        out = {n: most * sizes[n] if n in capped else rest * weight[n] / sum(weight[f] for f in free) for n in names}
        above = {n for n in free if out[n] > most * sizes[n]}
        if not above:
            return out
        capped |= above


def check(rows, docs, block=mixture.BLOCK_WORDS):
    sizes: dict = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    expected = targets(sizes) if sizes else {}
    assert len(rows) == len(docs)
    taken: dict = {}
    for row in rows:
        assert row["taken"] <= 2 * row["size"]
        assert row["source_size"] == sizes[row["source"]]
        assert abs(row["target"] - expected[row["source"]]) <= 1e-6 * max(1, expected[row["source"]])
        taken[row["source"]] = taken.get(row["source"], 0) + row["taken"]
    for source in sizes:
        assert abs(taken[source] - expected[source]) <= 2 * block, source


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = mixture.mix_sources(docs).documents.collect()
    check(rows, [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    again = mixture.mix_sources(docs.repartition(7)).documents.collect()
    key = lambda r: (r["doc_id"], r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert {"doc_id", "size", "source_size", "target", "taken"} <= set(op6_mixture(spark, folder).columns)


def test_blocks_are_permuted_and_whole(spark, folder):
    mix = mixture.mix_sources(spark.read.parquet(f"{folder}/documents.parquet"))
    each = mix.slots.groupBy("sid", "pass").agg(
        F.count("*").alias("n"), F.countDistinct("block").alias("d"), F.countDistinct("k").alias("k")
    ).collect()
    assert all(r["n"] == r["d"] == r["k"] for r in each)
    parts = mix.blocks.groupBy("sid", "block").agg(F.sum("words").alias("words")).groupBy("sid").agg(
        F.sum((F.col("words") < mixture.BLOCK_WORDS).cast("int")).alias("short"), F.max("words").alias("most")
    )
    assert all(r["short"] <= 1 and r["most"] <= mixture.BLOCK_WORDS for r in parts.collect())


def test_hot_source(spark):
    texts = ["a b c d e f g h " * (1 + i % 40) for i in range(600)]
    df = documents(spark, texts).withColumn("source", F.when(F.col("doc_id") < 400, "hot").otherwise(F.col("source")))
    check(mixture.mix_sources(df).documents.collect(), [(r[0], r[1], r[3]) for r in df.collect()])


def test_awkward_and_empty(spark):
    df = awkward(spark)
    rows = mixture.mix_sources(df).documents.collect()
    check(rows, [(r["doc_id"], r["text"], r["source"]) for r in df.collect()])
    assert mixture.mix_sources(empty(spark)).documents.count() == 0
    blank = documents(spark, [None, "", " \n"])
    assert [r["taken"] for r in mixture.mix_sources(blank).documents.collect()] == [0, 0, 0]


def test_orders_of_many_blocks(spark):
    """A permutation of few blocks, and no overflow with far more than fit a product of 64 bits."""
    from adtally.llm.mixture import permuted

    few = spark.range(5000).select(permuted(F.col("id"), F.lit(5000).cast("long"), 17, F.lit(1), F.lit(0)).alias("b"))
    assert sorted(r["b"] for r in few.collect()) == list(range(5000))
    for blocks in (10**12, 9 * 10**18):
        index = [blocks - 1 - i for i in range(1000)]
        df = spark.createDataFrame([(i,) for i in index], "i long")
        rows = df.select(permuted(F.col("i"), F.lit(blocks).cast("long"), 17, F.lit(1), F.lit(3)).alias("b")).collect()
        got = [r["b"] for r in rows]
        assert len(set(got)) == 1000 and all(0 <= b < blocks for b in got)
        steps = {(got[k] - got[k + 1]) % blocks for k in range(999)}
        assert len(steps) == 1
