import pytest
from pyspark.sql import functions as F

from adtally.operators import attribution as A

SCHEMA = "campaign long, conversion int, click int, click_pos long, click_nb long, cost double, cpo double"


def clicks(spark):
    rows = [
        # one converted path of three clicks over two campaigns, and a view in it
        (1, 1, 1, 0, 3, 1.0, 4.0), (2, 1, 1, 1, 3, 2.0, 2.0), (1, 1, 1, 2, 3, 3.0, 4.0), (2, 1, 0, -1, 3, 0.0, 2.0),
        # an unconverted click, a campaign of views only, a row without campaign
        (3, 0, 1, 0, 1, 5.0, 0.0), (4, 0, 0, -1, 0, 0.0, 1.0), (None, 0, 1, 0, 1, 9.0, 1.0),
        # click_nb 0: the last-touch rule has no length test, the shared rules do
        (5, 1, 1, -1, 0, 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def by_campaign(df):
    return {row["campaign"]: row for row in df.collect()}


def test_credits(spark):
    rows = A.with_credits(clicks(spark)).collect()
    assert [r.last_touch for r in rows] == [0, 0, 1, 0, 0, 0, 0, 1]
    assert [r.multi_touch_linear for r in rows] == [pytest.approx(1 / 3)] * 3 + [0] * 5
    assert [r.time_decay for r in rows[:3]] == pytest.approx([1 / 7, 2 / 7, 4 / 7])
    assert [r.time_decay for r in rows[3:]] == [0] * 5


def test_decay_rate(spark):
    rows = A.with_credits(clicks(spark), 1.0).collect()
    assert [r.time_decay for r in rows] == [r.multi_touch_linear for r in rows]
    for bad in (0, 1.5, -1):
        with pytest.raises(ValueError, match="decay_rate"):
            A.position_decay_credit(bad)


def test_report_guards_zero_denominators(spark):
    report = by_campaign(A.campaign_report(clicks(spark)))
    assert set(report) == {1, 2, 3, 4, 5}
    assert report[1].total_cost == 4.0 and report[1].clicks == 2 and report[1].ctr == 1.0
    assert report[3].roi_proxy_linear == 0.0 and report[3].last_touch_share == 0.0
    assert report[4].cost_per_click == 0.0


def test_summary_counts_rows_without_campaign(spark):
    row = A.attribution_summary(clicks(spark)).first()
    assert (row.rows, row.campaigns, row.total_clicks, row.total_conversions) == (8, 5, 6, 5)
    assert row.total_multi_touch_linear == pytest.approx(1.0)
    assert row.total_time_decay == pytest.approx(1.0)


def test_decisions_and_views(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 0, 1, 1.0, 1.0)] * 3 + [(2, 1, 1, 0, 1, 9.0, 1.0)] * 3 + [(3, 1, 1, 0, 1, 5.0, 1.0)], SCHEMA
    )
    decisions = A.decision_report(A.campaign_report(df), min_conversions=3)
    rows = by_campaign(decisions)
    assert decisions.columns == A.DECISION_COLUMNS
    assert [rows[i].priority_bucket for i in (1, 2, 3)] == ["scale_candidate", "review_candidate", "monitor"]
    # share over share for decay, credit per conversion over share for linear
    assert rows[1].efficiency_index_time_decay == pytest.approx((3 / 7) / (3 / 35))
    assert rows[1].efficiency_index_linear == pytest.approx(1 / (3 / 35))
    views = {(r["view"], r["position"]): r["campaign"] for r in A.review_views(decisions, top_campaigns=2).collect()}
    assert views == {
        ("top_scale_candidates", 1): 1, ("top_review_candidates", 1): 2,
        ("top_monitor_by_spend", 1): 2, ("top_monitor_by_spend", 2): 3,
    }


def test_missing_columns(spark):
    with pytest.raises(ValueError, match=r"missing required columns: \['cpo'\]"):
        A.campaign_report(clicks(spark).drop("cpo"))


def test_credits_of_whole_paths_sum_to_one(spark, log):
    paths = A.with_credits(log).filter("conversion = 1 and click = 1").agg(
        F.sum("multi_touch_linear").alias("linear"), F.sum("time_decay").alias("decay"), F.sum("last_touch").alias("last")
    ).first()
    assert paths.linear == pytest.approx(paths.last) and paths.decay == pytest.approx(paths.last)
