"""Builds the ad log from a raw user-event table.

The raw table has one row per user action: event_id, ts, user_id, event_type, value, props (JSON text
holding a number `k`). The ad log has one row per view or click, with the click path it belongs to.

Path building needs running counts per user. One user may own a large share of all rows, so the windows
never run over a whole heavy user: heavy users are cut into time chunks, crowded hours into finer ones, each
chunk is counted on its own, and small per-chunk summaries carry the counts across chunks.

Events without a user belong to no path. They stay, each as a path of its own with a null `uid`, so that the
null check of the contract reports them; they need no window and are not gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.sources.staging import stage, staged_cache

HEAVY_USER_ROWS = 1_000_000
CHUNK_MICROS = 3_600_000_000

_logs: dict[tuple[str, str], DataFrame] = staged_cache()


def _micros(events: DataFrame, name: str) -> Column:
    """Microseconds since 1970; a time without zone is read as UTC whatever the session's zone is."""
    if isinstance(events.schema[name].dataType, T.TimestampNTZType):
        seconds = F.expr(f"CAST(`{name}` - TIMESTAMP_NTZ'1970-01-01' AS INTERVAL SECOND)").cast("decimal(20,6)")
        return (seconds * F.lit(1_000_000)).cast("long")
    return F.unix_micros(F.col(name).cast("timestamp"))


def _user_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("long").alias("uid"),
        _micros(events, "ts").alias("timestamp"),
        F.col("event_id").cast("long").alias("event_id"),
        F.col("event_type"),
        F.col("value").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


def _with_chunk(rows: DataFrame, heavy_user_rows: int, chunk_micros: int) -> DataFrame:
    """Chunk 0 for ordinary users; for users above the row limit a time slot, cut finer where it is crowded.

    A slot of more rows than the limit is cut into as many equal parts as it holds limits. Events without a
    time come first, as they do in the order of a user's events.
    """
    slot = F.floor(F.col("timestamp") / F.lit(chunk_micros))
    heavy = rows.groupBy("uid").count().filter(F.col("count") > heavy_user_rows).select("uid")
    slots = (
        rows.join(heavy, "uid", "left_semi")
        .groupBy("uid", slot.alias("slot"))
        .count()
        .select("uid", "slot", F.greatest(F.lit(1), F.ceil(F.col("count") / F.lit(heavy_user_rows))).alias("parts"))
    )
    begin = F.col("r.slot") * F.lit(chunk_micros)
    within = F.floor((F.col("timestamp") - begin) * F.col("parts") / F.lit(chunk_micros))
    chunk = F.coalesce(F.col("r.slot") * F.lit(1 << 20) + F.least(within, F.lit((1 << 20) - 1)), F.lit(-(1 << 62)))
    # Few rows: one per slot of a heavy user. No hint: the planner sees their number at run time.
    return (
        rows.withColumn("slot", slot)
        .alias("r")
        .join(slots.alias("h"), (F.col("r.uid") == F.col("h.uid")) & F.col("r.slot").eqNullSafe(F.col("h.slot")), "left")
        .select("r.*", F.when(F.col("parts").isNotNull(), chunk).otherwise(F.lit(0)).cast("long").alias("chunk"))
        .drop("slot")
    )


def ad_log(
    events: DataFrame,
    *,
    heavy_user_rows: int = HEAVY_USER_ROWS,
    chunk_micros: int = CHUNK_MICROS,
) -> DataFrame:
    """One row per view or click with its path columns.

    A path is the run of a user's events between two purchases. `conversion` says that the path ends in a
    purchase, `click_nb` counts its clicks, `click_pos` is the 0-based position of a click in it (-1 for a
    view), `time_since_last_click` the whole seconds since the user's previous click (-1 for none).
    """
    is_click = F.col("event_type") == "click"
    is_purchase = F.col("event_type") == "purchase"
    given = _user_events(events)
    rows = _with_chunk(given.filter(F.col("uid").isNotNull()), heavy_user_rows, chunk_micros)

    in_chunk = Window.partitionBy("uid", "chunk").orderBy("timestamp", "event_id")
    earlier = in_chunk.rowsBetween(Window.unboundedPreceding, -1)
    # Later rows are read as the earlier rows of the reverse order: a frame that ends at the last row would
    # be summed anew for every row.
    onward = (
        Window.partitionBy("uid", "chunk")
        .orderBy(F.desc("timestamp"), F.desc("event_id"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = (
        rows.withColumn("purchases_here", F.coalesce(F.sum(is_purchase.cast("long")).over(earlier), F.lit(0)))
        .withColumn("clicks_here", F.coalesce(F.sum(is_click.cast("long")).over(earlier), F.lit(0)))
        .withColumn("prev_click_here", F.max(F.when(is_click, F.col("timestamp"))).over(earlier))
        # Clicks already counted when the path began, and when it will end, as seen from this chunk.
        .withColumn("mark", F.when(is_purchase, F.col("clicks_here")))
        .withColumn("start_here", F.max("mark").over(earlier))
        .withColumn("end_here", F.min("mark").over(onward))
    )

    summary = local.groupBy("uid", "chunk").agg(
        F.sum(is_purchase.cast("long")).alias("purchases"),
        F.sum(is_click.cast("long")).alias("clicks"),
        F.max(F.when(is_click, F.col("timestamp"))).alias("last_click"),
        F.min("mark").alias("first_mark"),
        F.max("mark").alias("last_mark"),
    )
    by_user = Window.partitionBy("uid")
    before = by_user.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    after = by_user.orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        summary.withColumn("clicks_before", F.coalesce(F.sum("clicks").over(before), F.lit(0)))
        .withColumn("purchases_before", F.coalesce(F.sum("purchases").over(before), F.lit(0)))
        .select(
            "uid",
            "chunk",
            "clicks_before",
            "purchases_before",
            F.max("last_click").over(before).alias("click_before"),
            F.coalesce(F.max(F.col("clicks_before") + F.col("last_mark")).over(before), F.lit(0)).alias("start_before"),
            F.min(F.col("clicks_before") + F.col("first_mark")).over(after).alias("end_after"),
            F.sum("clicks").over(by_user).alias("user_clicks"),
            F.sum("purchases").over(by_user).alias("user_purchases"),
        )
    )

    clicks_so_far = F.col("clicks_before") + F.col("clicks_here")
    path_start = F.coalesce(F.col("clicks_before") + F.col("start_here"), F.col("start_before"))
    path_end = F.coalesce(F.col("clicks_before") + F.col("end_here"), F.col("end_after"), F.col("user_clicks"))
    previous_click = F.coalesce("prev_click_here", "click_before")
    shown = ("view", "click")
    paths = (
        local.join(carried, ["uid", "chunk"])
        .filter(F.col("event_type").isin(*shown))
        .withColumns(
            {
                "path_ends": F.col("purchases_before") + F.col("purchases_here") < F.col("user_purchases"),
                "place": clicks_so_far - path_start,
                "path_clicks": path_end - path_start,
                "since": F.floor((F.col("timestamp") - previous_click) / F.lit(1_000_000)),
            }
        )
    )
    alone = given.filter(F.col("uid").isNull() & F.col("event_type").isin(*shown)).withColumns(
        {
            "path_ends": F.lit(False),
            "place": F.lit(0).cast("long"),
            "path_clicks": is_click.cast("long"),
            "since": F.lit(None).cast("long"),
        }
    )
    columns = [*given.columns, "path_ends", "place", "path_clicks", "since"]
    k = F.col("k")
    return (
        paths.select(*columns)
        .unionByName(alone.select(*columns))
        .select(
            "timestamp",
            "uid",
            (k % 10).alias("campaign"),
            is_click.cast("int").alias("click"),
            F.col("path_ends").cast("int").alias("conversion"),
            F.when(is_click, F.col("place")).otherwise(F.lit(-1)).cast("long").alias("click_pos"),
            F.col("path_clicks").cast("long").alias("click_nb"),
            (F.col("value") * (k % 10 + 5) / F.lit(10.0)).alias("cost"),
            (k % 10 + 5).cast("double").alias("cpo"),
            F.coalesce(F.col("since"), F.lit(-1)).cast("long").alias("time_since_last_click"),
            (k % 7).alias("cat1"),
            (k % 13).alias("cat2"),
            (F.col("uid") % 11).alias("cat3"),
            (F.col("uid") % 5).alias("cat4"),
            F.expr("timestamp div 3600000000 % 24").alias("cat5"),
            F.expr("timestamp div 86400000000 % 7").alias("cat6"),
            (F.col("event_id") % 17).alias("cat7"),
            F.expr("k div 10").alias("cat8"),
            ((F.col("uid") + k) % 23).alias("cat9"),
        )
    )


def ad_log_table(spark: SparkSession, folder: str) -> DataFrame:
    """The ad log of `folder`, written once per application and then scanned like any stored table."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _logs:
        _logs[key] = stage(ad_log(spark.read.parquet(f"{folder}/events.parquet")), "ad-log")
    return _logs[key]
