"""Encodings and imputations fitted on the training split and applied to every split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.operators.coding import category_codes, with_code
from adtally.operators.selection import medians
from adtally.sources.staging import stage


def _train(df: DataFrame, split_col: str) -> DataFrame:
    return df.filter(F.col(split_col) == "train")


def _with_campaign_rate(df: DataFrame, campaign_col: str, label_col: str, split_col: str) -> DataFrame:
    train = _train(df, split_col)
    rates = (
        train.filter(F.col(campaign_col).isNotNull())
        .groupBy(campaign_col)
        .agg(F.avg(label_col).alias("__campaign_rate"))
        .withColumnRenamed(campaign_col, "__encoded_campaign")
    )
    # No broadcast hint: the number of campaigns is open, adaptive execution broadcasts by measured size.
    return df.join(rates, F.col(campaign_col) == F.col("__encoded_campaign"), "left").drop("__encoded_campaign")


def encode_campaign(
    df: DataFrame,
    *,
    label_col: str,
    campaign_col: str = "campaign",
    split_col: str = "split",
    output: str = "campaign_ctr",
) -> DataFrame:
    """Training mean of the label per campaign; the global training mean for campaigns never trained on."""
    prior = _train(df, split_col).agg(F.avg(label_col).alias("prior")).first()["prior"]
    encoded = _with_campaign_rate(df, campaign_col, label_col, split_col)
    return encoded.withColumn(output, F.coalesce("__campaign_rate", F.lit(prior))).drop("__campaign_rate")


def encoding_metadata(
    df: DataFrame, *, label_col: str, campaign_col: str = "campaign", split_col: str = "split"
) -> DataFrame:
    """Prior, number of trained campaigns, and unseen rows and rate per split (rate null for an empty split)."""
    trained = F.col(split_col) == "train"
    unseen = F.col("__campaign_rate").isNull()
    encoded = _with_campaign_rate(df, campaign_col, label_col, split_col)
    aggregates = [F.avg(F.when(trained, F.col(label_col))).alias("global_prior")]
    for name in ("validation", "test"):
        here = F.col(split_col) == name
        aggregates += [
            F.count_if(here & unseen).alias(f"{name}_unseen_rows"),
            F.avg(F.when(here, unseen.cast("double"))).alias(f"{name}_unseen_rate"),
        ]
    groups = (
        _train(df, split_col).select(campaign_col).filter(F.col(campaign_col).isNotNull()).distinct()
        .agg(F.count(F.lit(1)).alias("train_groups"))
    )
    one = F.lit(1).alias("one")
    # Two one-row tables side by side.
    return encoded.agg(*aggregates).select("*", one).join(F.broadcast(groups.select("*", one)), "one").drop("one")


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent non-null value per column, the smallest one on ties; None for an empty column.

    One pass over (column, value) pairs serves all columns; the pairs are counted before they are shuffled.
    """
    if not columns:
        return {}
    pairs = [item for name in columns for item in (F.lit(name), F.col(name).cast("long"))]
    long = df.select(F.stack(F.lit(len(columns)), *pairs).alias("name", "value")).filter(F.col("value").isNotNull())
    counts = long.groupBy("name", "value").count()
    best = counts.groupBy("name").agg(
        F.max_by("value", F.struct(F.col("count"), (-F.col("value")).alias("smaller"))).alias("value")
    )
    found = {row["name"]: row["value"] for row in best.collect()}
    return {name: found.get(name) for name in columns}


def impute(
    df: DataFrame, *, numeric: Sequence[str], categorical: Sequence[str], split_col: str = "split"
) -> DataFrame:
    """Fill nulls with the training median (numeric) or the most frequent training value (categorical)."""
    train = _train(df, split_col)
    fills = medians(train, {name: F.col(name) for name in numeric}) if numeric else {}
    modes = most_frequent(train, categorical)
    return df.withColumns(
        {name: F.coalesce(F.col(name).cast("double"), F.lit(fills[name])) for name in numeric}
        | {name: F.coalesce(F.col(name).cast("long"), F.lit(modes[name])) for name in categorical}
    )


def ordinal_codes(df: DataFrame, columns: Sequence[str], *, split_col: str = "split") -> DataFrame:
    """0-based code of every training value per column, in numeric order: (name, value, code)."""
    return category_codes(_train(df, split_col), columns)


def ordinal_encode(df: DataFrame, columns: Sequence[str], *, split_col: str = "split") -> DataFrame:
    """Replace every column by its training code; -1 for values never trained on."""
    codes = ordinal_codes(df, columns, split_col=split_col)
    for name in columns:
        df = with_code(df, name, codes, name, name).withColumn(name, F.coalesce(name, F.lit(-1)).cast("int"))
    return df


def one_hot_slots(df: DataFrame, columns: Sequence[str], *, split_col: str = "split") -> tuple[DataFrame, DataFrame]:
    """(rows with the sparse one-hot vector as `slots`, table of slots: name, value, slot).

    Slots of a column follow its training values in numeric order, columns follow each other by name. A row's vector has a one at each of
    its slots, listed ascending; values never trained on, and nulls, have none.
    """
    codes = stage(ordinal_codes(df, columns, split_col=split_col), "codes")
    sizes = {row["name"]: row["count"] for row in codes.groupBy("name").count().collect()}
    start, starts = 0, {}
    for name in sorted(columns):
        starts[name] = start
        start += sizes.get(name, 0)
    offset = F.coalesce(*[F.when(F.col("name") == name, F.lit(first)) for name, first in starts.items()])
    table = codes.select("name", "value", (F.col("code") + offset).alias("slot"))
    own = []
    for i, name in enumerate(sorted(columns)):
        df = with_code(df, name, codes, name, f"__slot{i}")
        own.append(F.col(f"__slot{i}") + F.lit(starts[name]))
    slots = F.filter(F.array(*own), lambda slot: slot.isNotNull())
    return df.withColumn("slots", slots).drop(*[f"__slot{i}" for i in range(len(own))]), table
