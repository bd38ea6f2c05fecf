"""Mixing sources to target weights by drawing fixed-length blocks.

The words of each source, its documents one after another, are packed into blocks of `block_words` words.
The mix has one slot per block it takes. Slots are dealt to output shards; a repeatable draw per slot picks
its source, which makes the source counts of a shard multinomial. Counts above a source's quota are cut from
its last draws, and a closing shard holds what is missing, so that totals meet the quotas. The k-th slot of a
source takes block `p(k)`, where `p` is a pseudorandom permutation of the source's blocks, another one in
each pass, and blocks are joined by that index. No block comes more than `most` times.

Targets: all sources share `share` times all words by their weights; no target exceeds `most` times its
source, and what exceeds is shared again by weight. Sources are ordered by code point, null last.

Offsets are running sums in two steps, within chunks of a source and over its chunks, so a source that holds
most rows is spread over many tasks. Draws are hashes of keys, so reruns and retries agree.

Defined results: null and blank texts have size 0 and are never taken; a source without words has target 0;
repeated rows are packed one after another; an empty table gives an empty table. Only the named columns are
read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtally.llm.common import WORD, uniform
from adtally.sources.staging import stage

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_WORDS = 32
CHUNK_ROWS = 4096
SHARD_SLOTS = 1 << 16
# Multipliers of the index permutations. A prime that does not divide the number of blocks permutes them.
PRIMES = (1000000007, 1000000009, 1000000021, 1000000033, 1000000087, 1000000093, 1000000097, 1000000103)


@dataclass(frozen=True)
class Mix:
    documents: DataFrame  # doc_id, source, size, source_size, target, taken
    slots: DataFrame  # shard, sid, place, pass, block: one row per block of the mix
    blocks: DataFrame  # sid, block, chunk, place, words: the parts of documents in each block


def source_targets(sized: DataFrame, *, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per source: sid, source_size, weight and target. One row per source, so its windows are small.

    With sources ordered by the ratio of their limit to their weight, those whose limit binds come first: a
    limit binds if it is at most the level that all later ones would share.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.asc_nulls_last("source"))
    ranked = sums.withColumn("sid", F.row_number().over(everything) - 1)
    choices = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(choices, F.pmod("sid", F.lit(len(weights)))))
    ranked = ranked.withColumn("limit", F.lit(most) * F.col("source_size"))
    ranked = ranked.withColumn("total", F.lit(share) * F.sum("source_size").over(Window.partitionBy(F.lit(0))))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    spent = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", (F.col("total") - spent) / F.sum("weight").over(after))
    ranked = ranked.withColumn("binds", F.col("limit") / F.col("weight") <= F.col("level"))
    final = F.min(F.when(~F.col("binds"), F.struct((F.col("limit") / F.col("weight")).alias("r"), F.col("sid"), F.col("level")))).over(
        Window.partitionBy(F.lit(0))
    )
    target = F.when(F.col("binds"), F.col("limit")).otherwise(final["level"] * F.col("weight"))
    return ranked.withColumn("target", F.coalesce(target, F.lit(0.0))).select("source", "sid", "source_size", "target")


def packed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Every document with the place of its first word in its source: columns chunk, place, begin."""
    rows = max(sized.count(), 1)
    chunks = -(-rows // CHUNK_ROWS)
    chunk = F.pmod(F.xxhash64("doc_id", "size"), F.lit(chunks))
    own = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "doc_id", sized["source"], "size", "sid", "source_size", "target", chunk.alias("chunk")
    )
    sums = own.groupBy("sid", "chunk").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("sid", "chunk", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("sid", "chunk").orderBy("doc_id", "size")
    ahead = F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = own.withColumns({"place": F.row_number().over(within), "ahead": ahead})
    return placed.join(offsets, ["sid", "chunk"]).withColumn("begin", F.col("ahead") + F.col("offset")).drop("ahead", "offset")


def draw_slots(sources: DataFrame, *, seed: int, block_words: int, most: float) -> DataFrame:
    """The blocks of the mix: shard, sid, k, pass and block."""
    blocks = F.ceil(F.col("source_size") / block_words)
    quota = F.round(F.col("target") * F.col("n_blocks") / F.col("source_size")).cast("long")
    plan = sources.filter("source_size > 0").select("sid", "source_size", "target", blocks.cast("long").alias("n_blocks"))
    plan = plan.withColumn("quota", F.least(quota, (F.lit(most) * F.col("n_blocks")).cast("long")))
    order = Window.orderBy("sid")
    upper = F.sum("quota").over(order.rowsBetween(Window.unboundedPreceding, 0))
    plan = stage(plan.withColumns({"upper": upper, "lower": upper - F.col("quota")}), "plan")
    total, number = plan.agg(F.sum("quota"), F.count(F.lit(1))).first()
    if not total:
        return plan.select(F.lit(0).cast("long").alias("shard"), "sid", "quota", "n_blocks").limit(0).select(
            "shard", "sid", F.col("quota").alias("k"), F.col("quota").alias("pass"), F.col("n_blocks").alias("block")
        )
    # A draw finds its source by the interval it falls in; cells of equal width make that an equal-key join.
    cells = 4 * number
    cell_of = lambda place: F.floor(place * cells / total).cast("long")
    where = plan.filter("quota > 0").withColumn("cell", F.explode(F.sequence(cell_of(F.col("lower")), cell_of(F.col("upper") - 1))))
    shards = -(-total // SHARD_SLOTS)
    slots = plan.sparkSession.range(total).select(
        F.floor(F.col("id") / SHARD_SLOTS).alias("shard"),
        F.least(F.floor(uniform(seed, F.col("id")) * total).cast("long"), F.lit(total - 1)).alias("point"),
    )
    met = slots.withColumn("cell", cell_of(F.col("point"))).join(where.select("cell", "lower", "upper", "sid"), "cell")
    counts = met.filter("point >= lower and point < upper").groupBy("shard", "sid").agg(F.count(F.lit(1)).alias("drawn"))
    running = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("from", F.coalesce(F.sum("drawn").over(running), F.lit(0)))
    counts = stage(counts, "counts")
    got = counts.groupBy("sid").agg(F.sum("drawn").alias("got"))
    closing = plan.join(got, "sid", "left").filter("coalesce(got, 0) < quota").select(
        F.lit(shards).cast("long").alias("shard"), "sid", F.coalesce("got", F.lit(0)).alias("from"), F.col("quota").alias("until"), "n_blocks"
    )
    kept = counts.join(plan, "sid").filter("`from` < quota").select(
        "shard", "sid", "from", F.least(F.col("from") + F.col("drawn"), F.col("quota")).alias("until"), "n_blocks"
    )
    ranges = kept.unionByName(closing)
    # The ranges are few; their slots are many: spread them first.
    ranges = ranges.repartition(max(1, min(10_000, -(-total // 1_000_000))), "shard", "sid")
    each = ranges.withColumn("k", F.explode(F.sequence("from", F.col("until") - 1)))
    turn = F.floor(F.col("k") / F.col("n_blocks")).cast("long")
    index = F.col("k") - turn * F.col("n_blocks")
    block = permuted(index, F.col("n_blocks"), seed, F.col("sid"), turn)
    return each.select("shard", "sid", "k", turn.alias("pass"), block.alias("block"))


def permuted(index: Column, blocks: Column, seed: int, *key: Column) -> Column:
    """The place of `index` in a pseudorandom order of 0 .. blocks - 1 that the key chooses: factor and shift modulo `blocks`.

    The factor is a prime that does not divide `blocks`; the product is formed in 38 digits, so it cannot overflow.
    """
    primes = F.array(*[F.lit(p) for p in PRIMES])
    usable = F.filter(primes, lambda p: F.pmod(blocks, p) != 0)
    first = F.pmod(F.xxhash64(F.lit(seed), *key, F.lit("factor")), F.size(usable))
    shift = F.pmod(F.xxhash64(F.lit(seed), *key, F.lit("shift")), blocks)
    wide = lambda c: c.cast("decimal(19,0)")
    product = F.pmod(wide(index) * wide(F.pmod(F.get(usable, first.cast("int")), blocks)), wide(blocks)).cast("long")
    # Both summands are below `blocks`, and so is the larger of the two differences.
    return F.when(product >= blocks - shift, product - (blocks - shift)).otherwise(product + shift)


def mix_sources(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17,
    block_words: int = BLOCK_WORDS, weights=WEIGHTS, share: float = 1.5, most: float = 2.0,
) -> Mix:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sized = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")), "sized")
    sources = stage(source_targets(sized, weights=weights, share=share, most=most), "sources")
    placed = stage(packed(sized, sources), "placed")
    slots = draw_slots(sources, seed=seed, block_words=block_words, most=most)
    last = F.floor((F.col("begin") + F.col("size") - 1) / block_words)
    touched = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / block_words), last)))
    words = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block_words) - F.greatest("begin", F.col("block") * block_words)
    blocks = touched.select("sid", "block", "chunk", "place", words.alias("words"))
    drawn = slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = blocks.join(drawn, ["sid", "block"]).groupBy("sid", "chunk", "place").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    documents = placed.join(taken, ["sid", "chunk", "place"], "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
    return Mix(documents, slots, blocks)


def copies(size: Column, taken: Column, *key: str, seed: int = 19) -> Column:
    """How often a whole document stands in the mix: its taken share, rounded by a repeatable draw without bias."""
    return F.when(size > 0, F.floor(taken / size + uniform(seed, *key))).otherwise(0).cast("int")
