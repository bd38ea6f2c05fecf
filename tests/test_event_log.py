import pandas as pd
from pyspark.sql import functions as F

from adtally.sources.event_log import _user_events, _with_chunk, ad_log


def expected(events: pd.DataFrame) -> pd.DataFrame:
    """Paths by a plain loop over each user's events in order."""
    out = []
    for uid, rows in events.sort_values(["ts", "event_id"]).groupby("user_id"):
        paths, last_click = [[]], None
        for row in rows.itertuples():
            since = -1 if last_click is None else int((row.ts - last_click).total_seconds() // 1)
            paths[-1].append((row, since))
            if row.event_type == "click":
                last_click = row.ts
            if row.event_type == "purchase":
                paths.append([])
        for path in paths:
            clicks = [row.event_id for row, _ in path if row.event_type == "click"]
            won = any(row.event_type == "purchase" for row, _ in path)
            for row, since in path:
                if row.event_type in ("view", "click"):
                    position = clicks.index(row.event_id) if row.event_type == "click" else -1
                    micros = row.ts.value // 1000 if row.ts.unit == "ns" else row.ts.value
                    out.append((micros, uid, int(won), position, len(clicks), since))
    columns = ["timestamp", "uid", "conversion", "click_pos", "click_nb", "time_since_last_click"]
    return pd.DataFrame(out, columns=columns).sort_values(columns).reset_index(drop=True)


def test_paths_match_a_plain_loop_for_light_and_heavy_users(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    frame = events.toPandas()
    frame["ts"] = frame["ts"].astype("datetime64[ns]")
    want = expected(frame)
    # Every user above 20 events counts as heavy and is cut into two-day chunks in the second run.
    zone = spark.conf.get("spark.sql.session.timeZone")
    for options in ({}, {"heavy_user_rows": 20, "chunk_micros": 2 * 86_400_000_000}):
        # The result does not depend on the session's zone.
        spark.conf.set("spark.sql.session.timeZone", "America/New_York" if options else zone)
        got = ad_log(events, **options).select(*want.columns).toPandas()
        got = got.sort_values(list(want.columns)).reset_index(drop=True).astype("int64")
        spark.conf.set("spark.sql.session.timeZone", zone)
        pd.testing.assert_frame_equal(got, want.astype("int64"))


def test_one_user_holding_every_row(spark):
    """A single heavy user is still counted chunk by chunk."""
    events = spark.range(0, 3000).select(
        F.col("id").alias("event_id"),
        F.timestamp_micros(F.col("id") * 60_000_000).cast("timestamp_ntz").alias("ts"),
        F.lit(7).cast("long").alias("user_id"),
        F.when(F.col("id") % 50 == 49, "purchase").when(F.col("id") % 5 == 0, "click").otherwise("view").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    )
    whole = ad_log(events)
    chunked = ad_log(events, heavy_user_rows=100, chunk_micros=3_600_000_000)
    assert whole.exceptAll(chunked).isEmpty() and chunked.exceptAll(whole).isEmpty()
    assert {row[0] for row in chunked.select("click_nb").distinct().collect()} == {10}


def test_events_without_user_or_time_stay(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    holey = events.withColumns(
        {
            "user_id": F.when(F.col("event_id") % 10 != 0, F.col("user_id")),
            "ts": F.when(F.col("event_id") % 7 != 0, F.col("ts")),
        }
    )
    shown = holey.filter(F.col("event_type").isin("view", "click"))
    for options in ({}, {"heavy_user_rows": 5, "chunk_micros": 3_600_000_000}):
        log = ad_log(holey, **options)
        assert log.count() == shown.count()
        assert log.filter("uid is null").count() == shown.filter("user_id is null").count()
        assert log.filter("uid is null and (conversion <> 0 or click_nb <> click)").isEmpty()


def test_a_crowded_hour_is_cut(spark):
    """All rows of one user in one hour: finer slots, the same paths."""
    events = spark.range(0, 2000).select(
        F.col("id").alias("event_id"),
        F.timestamp_micros(F.col("id") * 1_000_000).cast("timestamp_ntz").alias("ts"),
        F.lit(7).cast("long").alias("user_id"),
        F.when(F.col("id") % 50 == 49, "purchase").when(F.col("id") % 5 == 0, "click").otherwise("view").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    )
    cut = _with_chunk(_user_events(events), 100, 3_600_000_000)
    assert cut.groupBy("chunk").count().agg(F.max("count")).first()[0] <= 200
    whole, chunked = ad_log(events), ad_log(events, heavy_user_rows=100, chunk_micros=3_600_000_000)
    assert whole.exceptAll(chunked).isEmpty() and chunked.exceptAll(whole).isEmpty()
