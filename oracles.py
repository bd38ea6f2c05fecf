"""DuckDB SQL for the named queries: plain windows and aggregates over the same tables.

Every query ends in a projection that casts whole numbers to BIGINT and rounds doubles to six digits.
Doubles are written with an exponent, since a plain decimal literal would be a DECIMAL.
"""

from __future__ import annotations

LOG = """
ev AS (
  SELECT CAST(user_id AS BIGINT) AS uid, epoch_us(ts) AS t, CAST(event_id AS BIGINT) AS event_id, event_type,
         CAST(value AS DOUBLE) AS value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
grouped AS (
  SELECT *,
    coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER earlier, 0) AS grp,
    max(CASE WHEN event_type = 'click' THEN t END) OVER earlier AS prev_click
  FROM ev
  WINDOW earlier AS (PARTITION BY uid ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
paths AS (
  SELECT *,
    max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY uid, grp) AS conversion,
    sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY uid, grp) AS click_nb,
    CASE WHEN event_type = 'click' THEN
      sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)
        OVER (PARTITION BY uid, grp ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) - 1 ELSE -1 END AS click_pos
  FROM grouped),
log AS MATERIALIZED (
  SELECT CAST(t AS BIGINT) AS "timestamp", uid, CAST(k % 10 AS BIGINT) AS campaign,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS click, conversion,
    CAST(click_pos AS BIGINT) AS click_pos, CAST(click_nb AS BIGINT) AS click_nb,
    value * (k % 10 + 5) / 10e0 AS cost, CAST(k % 10 + 5 AS DOUBLE) AS cpo,
    CAST(coalesce((t - prev_click) // 1000000, -1) AS BIGINT) AS time_since_last_click,
    k % 7 AS cat1, k % 13 AS cat2, uid % 11 AS cat3, uid % 5 AS cat4, (t // 3600000000) % 24 AS cat5,
    (t // 86400000000) % 7 AS cat6, event_id % 17 AS cat7, k // 10 AS cat8, (uid + k) % 23 AS cat9
  FROM paths WHERE event_type IN ('view', 'click'))"""

# Every tenth event loses its user: such events are paths of their own.
LOG_MISSING_USERS = LOG.replace(
    "FROM events)", "FROM (SELECT * REPLACE (CASE WHEN event_id % 10 <> 0 THEN user_id END AS user_id) FROM events))"
).replace("PARTITION BY uid", "PARTITION BY uid, CASE WHEN uid IS NULL THEN event_id END")

CREDITED = """
credited AS (
  SELECT *,
    CASE WHEN conversion = 1 AND click = 1 AND click_pos = click_nb - 1 THEN 1e0 ELSE 0e0 END AS last_touch,
    CASE WHEN conversion = 1 AND click = 1 AND click_nb > 0 THEN 1e0 / click_nb ELSE 0e0 END AS multi_touch_linear,
    CASE WHEN conversion = 1 AND click = 1 AND click_nb > 0
      THEN pow(5e-1, greatest(click_nb - 1 - click_pos, 0)) / ((1e0 - pow(5e-1, click_nb)) / (1e0 - 5e-1))
      ELSE 0e0 END AS time_decay
  FROM log)"""

CAMPAIGNS = """
sums AS (
  SELECT campaign, count(*) AS "rows", sum(click) AS clicks, sum(conversion) AS conversions,
    sum(cost) AS total_cost, avg(cost) AS mean_cost, avg(cpo) AS mean_cpo, avg(click) AS ctr,
    sum(last_touch) AS last_touch, sum(multi_touch_linear) AS multi_touch_linear, sum(time_decay) AS time_decay
  FROM credited WHERE campaign IS NOT NULL GROUP BY campaign),
campaigns AS (
  SELECT *, multi_touch_linear - last_touch AS attribution_diff,
    time_decay - last_touch AS time_decay_diff_vs_last_touch,
    time_decay - multi_touch_linear AS time_decay_diff_vs_linear,
    coalesce(last_touch / nullif(conversions, 0), 0e0) AS last_touch_share,
    coalesce(multi_touch_linear / nullif(conversions, 0), 0e0) AS multi_touch_linear_share,
    coalesce(time_decay / nullif(conversions, 0), 0e0) AS time_decay_share,
    coalesce(multi_touch_linear / nullif(mean_cpo, 0), 0e0) AS roi_proxy_linear,
    coalesce(time_decay / nullif(mean_cpo, 0), 0e0) AS roi_proxy_time_decay,
    coalesce(total_cost / nullif(clicks, 0), 0e0) AS cost_per_click,
    coalesce(CAST(conversions AS DOUBLE) / nullif("rows", 0), 0e0) AS conversion_rate
  FROM sums)"""

DECISIONS = """
shares AS (
  SELECT *, coalesce(total_cost / nullif(sum(total_cost) OVER (), 0), 0e0) AS spend_share,
    coalesce(CAST(conversions AS DOUBLE) / nullif(sum(conversions) OVER (), 0), 0e0) AS conversion_share,
    coalesce(CAST(clicks AS DOUBLE) / nullif(sum(clicks) OVER (), 0), 0e0) AS click_share,
    coalesce(time_decay / nullif(sum(time_decay) OVER (), 0), 0e0) AS attributed_conversion_share_time_decay
  FROM campaigns),
indexed AS (
  SELECT *,
    coalesce(attributed_conversion_share_time_decay / nullif(spend_share, 0), 0e0) AS efficiency_index_time_decay,
    coalesce(multi_touch_linear_share / nullif(spend_share, 0), 0e0) AS efficiency_index_linear,
    roi_proxy_time_decay - roi_proxy_linear AS roi_proxy_gap_time_decay_vs_linear
  FROM shares),
decisions AS (
  SELECT *, CASE WHEN efficiency_index_time_decay >= 12e-1 AND conversions >= 100 THEN 'scale_candidate'
                 WHEN efficiency_index_time_decay <= 8e-1 AND conversions >= 100 THEN 'review_candidate'
                 ELSE 'monitor' END AS priority_bucket
  FROM indexed)"""

FEATURES = """
feat AS (
  SELECT * EXCLUDE (time_since_last_click), time_since_last_click AS raw_recency,
    ln(1e0 + cost) AS log_cost, ln(1e0 + cpo) AS log_cpo,
    CAST(CASE WHEN time_since_last_click <> -1 THEN time_since_last_click END AS DOUBLE) AS time_since_last_click,
    CASE WHEN time_since_last_click <> -1 THEN 1 ELSE 0 END AS has_prev_click,
    CAST(greatest(time_since_last_click, 0) AS DOUBLE) AS rec,
    ln(1e0 + greatest(time_since_last_click, 0)) AS log_time_since_last_click,
    CASE WHEN time_since_last_click <= 0 THEN 0 WHEN time_since_last_click <= 3600 THEN 1
         WHEN time_since_last_click <= 86400 THEN 2 WHEN time_since_last_click <= 604800 THEN 3
         ELSE 4 END AS recency_bucket
  FROM log)"""


def _split(source: str, output: str) -> str:
    return f"""
{output} AS MATERIALIZED (
  SELECT * EXCLUDE (rn, n),
    CASE WHEN rn <= floor(n * 7e-1) THEN 'train' WHEN rn <= floor(n * (7e-1 + 1e-1)) THEN 'validation'
         ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY "timestamp", uid, campaign) AS rn, count(*) OVER () AS n FROM {source}))"""


SPLIT_LOG = _split("feat", "split_log")
CLICKS = """
clicks AS MATERIALIZED (SELECT *, 5e-2 + 9e-1 * cost / (cost + 40e0 + cpo) AS pred_score FROM split_log)"""


def _mean_rank(column: str) -> str:
    return f"(rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2e0)"


def _share_rank(column: str) -> str:
    return f"{_mean_rank(column)} / (count(*) OVER ())"


def _uniform(seed: int, salt: str = "") -> str:
    prefix = f"{seed}|{salt}|" if salt else f"{seed}|"
    text = f"'{prefix}' || \"timestamp\" || '|' || uid || '|' || campaign"
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496e0"


KNOWN = f"""
ranked AS (
  SELECT *, {_share_rank('cost')} AS cost_rank, {_share_rank('cpo')} AS cpo_rank, {_share_rank('rec')} AS recency_rank
  FROM feat),
bench AS (
  SELECT *,
    greatest(least(2e-2 + 16e-2 * cpo_rank + 6e-2 * has_prev_click - 4e-2 * recency_rank, 25e-2), 1e-2)
      AS true_treatment_effect,
    greatest(least(15e-2 + 55e-2 * cost_rank + 15e-2 * has_prev_click, 95e-2), 5e-2) AS synthetic_treatment_propensity,
    greatest(least(6e-2 + 20e-2 * cost_rank + 10e-2 * (1e0 - recency_rank), 70e-2), 2e-2)
      AS baseline_outcome_probability
  FROM ranked),
treated AS (
  SELECT *, CASE WHEN {_uniform(42, 't')} < synthetic_treatment_propensity THEN 1 ELSE 0 END AS synthetic_treatment
  FROM bench),
probable AS (
  SELECT *, greatest(least(baseline_outcome_probability + synthetic_treatment * true_treatment_effect, 95e-2), 0e0)
    AS synthetic_outcome_probability
  FROM treated),
known AS (
  SELECT *, CASE WHEN {_uniform(42, 'y')} < synthetic_outcome_probability THEN 1 ELSE 0 END AS synthetic_outcome,
    greatest(least(cost / (cost + 20e0), 95e-2), 5e-2) AS propensity_score,
    1e-1 + cpo / 50e0 AS treated_outcome_score,
    5e-2 + cost / (cost + 300e0) AS control_outcome_score,
    cpo / 50e0 - cost / (cost + 300e0) AS observational_score,
    1e-2 * cpo + 3e-2 * has_prev_click AS doubly_robust_score
  FROM probable),""" + _split("known", "uplift")

TEST = """
test AS MATERIALIZED (SELECT * FROM uplift WHERE split = 'test')"""

FRACTIONS = "(VALUES (0, 1e-2), (1, 5e-2), (2, 1e-1), (3, 2e-1), (4, 3e-1)) AS f(i, fraction)"
TIME = '"timestamp", uid, campaign'


def _positions(score: str) -> str:
    return f"row_number() OVER (ORDER BY {score} DESC NULLS LAST, {TIME})"


def _edges(source: str, value: str, bins: str = "10", where: str = "true") -> str:
    """Distinct interpolated quantiles of a column as a list, as scalar subquery text."""
    return f"""(SELECT list_sort(list_distinct(list(edge))) FROM (
      SELECT CASE WHEN h - floor(h) >= 5e-1 THEN b - (b - a) * (1 - (h - floor(h))) ELSE a + (b - a) * (h - floor(h)) END
        AS edge
      FROM (SELECT h, vs[CAST(floor(h) AS BIGINT) + 1] AS a, vs[least(CAST(floor(h) AS BIGINT) + 2, n)] AS b
            FROM (SELECT vs, n, ((CASE WHEN i = q THEN 1e0 ELSE i * (1e0 / q) END) * 100 / 100) * (n - 1) AS h
                  FROM (SELECT vs, n, q, unnest(range(q + 1)) AS i
                        FROM (SELECT vs, len(vs) AS n, {bins} AS q
                              FROM (SELECT list_sort(list(CAST({value} AS DOUBLE))) AS vs FROM {source}
                                    WHERE {value} IS NOT NULL AND {where})))))))"""


def _bin(edges: str, value: str) -> str:
    """Inner edges below the value."""
    return f"len(list_filter({edges}[2:len({edges}) - 1], lambda e: e < {value}))"


def _final(ctes: list[str], source: str, columns: str) -> str:
    """Project `columns` ('name:l' whole, ':d' double, ':s' text) from `source` after the given CTEs."""
    parts = []
    for item in columns.split():
        name, kind = item.split(":")
        quoted = f'"{name}"'
        if kind == "l":
            parts.append(f"CAST({quoted} AS BIGINT) AS {quoted}")
        elif kind == "d":
            rounded = f"round(CAST({quoted} AS DOUBLE), 6)"
            parts.append(f"CASE WHEN {rounded} = 0 THEN 0e0 ELSE {rounded} END AS {quoted}")
        else:
            parts.append(f"CAST({quoted} AS VARCHAR) AS {quoted}")
    with_clause = f"WITH {','.join(ctes)}\n" if ctes else ""
    return f"{with_clause}SELECT {', '.join(parts)} FROM ({source})"


KEY_COLUMNS = "timestamp:l uid:l campaign:l"
CREDIT_COLUMNS = "last_touch:d multi_touch_linear:d time_decay:d"
DECISION_COLUMNS = (
    "campaign:l priority_bucket:s rows:l clicks:l conversions:l total_cost:d ctr:d conversion_rate:d "
    + CREDIT_COLUMNS
    + " roi_proxy_linear:d roi_proxy_time_decay:d roi_proxy_gap_time_decay_vs_linear:d spend_share:d click_share:d "
    "conversion_share:d attributed_conversion_share_time_decay:d efficiency_index_linear:d "
    "efficiency_index_time_decay:d"
)
SUMMARY_COLUMNS = (
    "campaign:l rows:l clicks:l conversions:l total_cost:d ctr:d conversion_rate:d "
    + CREDIT_COLUMNS
    + " attribution_diff:d time_decay_diff_vs_last_touch:d time_decay_diff_vs_linear:d roi_proxy_linear:d "
    "roi_proxy_time_decay:d"
)


def _ranked_views(source: str, views: list[tuple[str, str, str, int]]) -> str:
    return " UNION ALL ".join(
        f"(SELECT *, row_number() OVER (ORDER BY {order}) AS position, '{view}' AS \"view\" FROM {source} "
        f"WHERE {where} QUALIFY row_number() OVER (ORDER BY {order}) <= {n})"
        for view, where, order, n in views
    )


def _attribution() -> dict[str, str]:
    base = [LOG, CREDITED, CAMPAIGNS]
    by_efficiency = "efficiency_index_time_decay DESC, conversions DESC, campaign"
    budget = """
budget AS (
  SELECT campaign, avg(last_touch) AS last_touch, avg(multi_touch_linear) AS multi_touch_linear, avg(cpo) AS cpo,
    avg(cost) AS cost, avg(click) AS ctr, avg(multi_touch_linear) / nullif(avg(cpo), 0) AS roi_proxy,
    avg(multi_touch_linear) - avg(last_touch) AS diff
  FROM credited GROUP BY campaign)"""
    log_columns = (
        KEY_COLUMNS + " click:l conversion:l click_pos:l click_nb:l cost:d cpo:d time_since_last_click:l "
        + " ".join(f"cat{i}:l" for i in range(1, 10))
    )
    return {
        "ad_log": _final([LOG], "SELECT * FROM log", log_columns),
        "ad_log_missing_users": _final([LOG_MISSING_USERS], "SELECT * FROM log", log_columns),
        "attribution_credits": _final([LOG, CREDITED], "SELECT * FROM credited", f"{KEY_COLUMNS} {CREDIT_COLUMNS}"),
        "attribution_campaign": _final(
            base,
            "SELECT * FROM campaigns",
            "campaign:l rows:l clicks:l conversions:l total_cost:d mean_cost:d mean_cpo:d ctr:d "
            + CREDIT_COLUMNS
            + " attribution_diff:d time_decay_diff_vs_last_touch:d time_decay_diff_vs_linear:d last_touch_share:d "
            "multi_touch_linear_share:d time_decay_share:d roi_proxy_linear:d roi_proxy_time_decay:d "
            "cost_per_click:d conversion_rate:d",
        ),
        "attribution_summary": _final(
            base,
            """SELECT (SELECT count(*) FROM log) AS "rows", count(*) AS campaigns,
              (SELECT sum(click) FROM log) AS total_clicks, (SELECT sum(conversion) FROM log) AS total_conversions,
              sum(last_touch) AS total_last_touch, sum(multi_touch_linear) AS total_multi_touch_linear,
              sum(time_decay) AS total_time_decay, 5e-1 AS time_decay_rate FROM campaigns""",
            "rows:l campaigns:l total_clicks:l total_conversions:l total_last_touch:d total_multi_touch_linear:d "
            "total_time_decay:d time_decay_rate:d",
        ),
        "attribution_decision": _final([*base, DECISIONS], "SELECT * FROM decisions", DECISION_COLUMNS),
        "attribution_review_views": _final(
            [*base, DECISIONS],
            _ranked_views(
                "decisions",
                [
                    ("top_scale_candidates", "priority_bucket = 'scale_candidate'", by_efficiency, 3),
                    ("top_review_candidates", "priority_bucket = 'review_candidate'", by_efficiency, 3),
                    ("top_monitor_by_spend", "true", "spend_share DESC, campaign", 3),
                ],
            ),
            DECISION_COLUMNS + " position:l view:s",
        ),
        "attribution_top_lists": _final(
            base,
            _ranked_views(
                "campaigns",
                [
                    ("top_campaigns_by_conversions", "true", "conversions DESC, clicks DESC, campaign", 5),
                    ("top_campaigns_by_diff", "true", "attribution_diff DESC, campaign", 5),
                    ("top_campaigns_by_time_decay_diff_vs_linear", "true", "time_decay_diff_vs_linear DESC, campaign", 5),
                    ("top_campaigns_by_roi_proxy_time_decay", "true", "roi_proxy_time_decay DESC, campaign", 5),
                ],
            ),
            SUMMARY_COLUMNS + " position:l view:s",
        ),
        "budget_views": _final(
            [LOG, CREDITED, budget],
            _ranked_views(
                "budget",
                [
                    ("top_roi", "true", "roi_proxy DESC NULLS LAST, campaign", 4),
                    ("bottom_roi", "true", "roi_proxy ASC NULLS LAST, campaign", 4),
                    ("top_diff", "true", "diff DESC, campaign", 4),
                    ("bottom_diff", "true", "diff ASC, campaign", 4),
                ],
            ),
            "campaign:l last_touch:d multi_touch_linear:d cpo:d cost:d ctr:d roi_proxy:d diff:d position:l view:s",
        ),
    }


SOURCE_COLUMNS = ["timestamp", "uid", "campaign", "click", "cost", "cpo", "time_since_last_click"] + [
    f"cat{i}" for i in range(1, 10)
]
LINE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def _violations(source: str, required: list[str], key: list[str], minimums: dict[str, float], binary: list[str]) -> str:
    keys = ", ".join(f'"{name}"' for name in key)
    parts = [
        f"SELECT 'null' AS \"check\", '{name}' AS \"column\", count(*) FILTER (\"{name}\" IS NULL) AS violations, "
        f"CAST(NULL AS DOUBLE) AS observed_min FROM {source}"
        for name in required
    ]
    parts.append(
        f"SELECT 'duplicate_row', '*', (SELECT count(*) FROM {source}) - count(*), NULL FROM (SELECT DISTINCT * FROM {source})"
    )
    parts.append(
        f"SELECT 'duplicate_key', '{','.join(key)}', (SELECT count(*) FROM {source}) - count(*), NULL "
        f"FROM (SELECT DISTINCT {keys} FROM {source})"
    )
    parts += [
        f"SELECT 'minimum', '{name}', count(*) FILTER (\"{name}\" < {low}), CAST(min(\"{name}\") AS DOUBLE) FROM {source}"
        for name, low in minimums.items()
    ]
    parts += [
        f"SELECT 'binary', '{name}', count(*) FILTER (\"{name}\" NOT IN (0, 1)), NULL FROM {source}" for name in binary
    ]
    return " UNION ALL ".join(parts)


def _describe(source: str, columns: list[str]) -> str:
    parts = []
    for name in columns:
        v = f'CAST("{name}" AS DOUBLE)'
        parts.append(
            f"SELECT '{name}' AS \"column\", count({v}) AS count, avg({v}) AS mean, stddev_samp({v}) AS std, "
            f"min({v}) AS min, quantile_cont({v}, 25e-2) AS p25, quantile_cont({v}, 5e-1) AS p50, "
            f"quantile_cont({v}, 75e-2) AS p75, max({v}) AS max FROM {source}"
        )
    return " UNION ALL ".join(parts)


DESCRIBE_COLUMNS = "column:s count:l mean:d std:d min:d p25:d p50:d p75:d max:d"


def _tables() -> dict[str, str]:
    minimums = {"timestamp": 0, "cost": 0, "cpo": 0, "time_since_last_click": -1, "campaign": 0}
    minimums |= {f"cat{i}": 0 for i in range(1, 10)}
    log_names = [
        "timestamp", "uid", "campaign", "click", "conversion", "click_pos", "click_nb", "cost", "cpo",
        "time_since_last_click", *[f"cat{i}" for i in range(1, 10)],
    ]
    profile = [
        "SELECT 'rows' AS measure, '*' AS \"column\", CAST(count(*) AS DOUBLE) AS value FROM log",
        f"SELECT 'columns', '*', {len(log_names)}e0",
    ]
    profile += [f"SELECT 'null_rate', '{n}', avg(CASE WHEN \"{n}\" IS NULL THEN 1e0 ELSE 0e0 END) FROM log" for n in log_names]
    profile += [f"SELECT 'mean', '{n}', avg(\"{n}\") FROM log" for n in ("click", "conversion")]
    profile += [
        f"SELECT 'distinct', '{n}', CAST(count(DISTINCT \"{n}\") AS DOUBLE) FROM log"
        for n in ["campaign", *[f"cat{i}" for i in range(1, 10)]]
    ]
    check_columns = "check:s column:s violations:l observed_min:d"
    return {
        "quality_violations": _final(
            [LOG], _violations("log", SOURCE_COLUMNS, ["uid", "timestamp", "campaign"], minimums, ["click"]), check_columns
        ),
        "quality_violations_missing_users": _final(
            [LOG_MISSING_USERS],
            _violations("log", SOURCE_COLUMNS, ["uid", "timestamp", "campaign"], minimums, ["click"]),
            check_columns,
        ),
        "contract_report": _final(
            [LOG_MISSING_USERS],
            "SELECT *, CASE WHEN violations = 0 THEN 'ok' ELSE 'violated' END AS verdict FROM ("
            + _violations("log", SOURCE_COLUMNS, ["uid", "timestamp", "campaign"], minimums, ["click"])
            + ")",
            "check:s column:s verdict:s",
        ),
        "runs_table": _final(
            [LOG],
            """SELECT 'weekly' AS run_name, 'attribution' AS pipeline_name, 'events' AS dataset, test_rows, metric, value
            FROM (SELECT count(*) AS test_rows, count(*) AS "rows", sum(click) AS clicks, sum(conversion) AS conversions FROM log),
            LATERAL (VALUES ('rows', "rows"), ('total_clicks', clicks), ('total_conversions', conversions)) AS t(metric, value)""",
            "run_name:s pipeline_name:s dataset:s test_rows:l metric:s value:d",
        ),
        **{
            f"round_trip_{kind}": _final(
                [], "SELECT * FROM orders",
                "o_orderkey:l o_custkey:l o_orderstatus:s o_totalprice:d o_orderpriority:s",
            )
            for kind in ("csv", "tsv", "json", "parquet")
        },
        "describe_numeric_with_nan": _final(
            [],
            _describe(
                "(SELECT CASE WHEN l_linenumber <> 3 THEN l_discount END AS l_discount, l_tax FROM lineitem)",
                ["l_discount", "l_tax"],
            ),
            DESCRIBE_COLUMNS,
        ),
        "lineitem_quality_violations": _final(
            [],
            _violations("lineitem", LINE_COLUMNS, ["l_orderkey", "l_linenumber"], {"l_quantity": 10, "l_discount": 0}, []),
            check_columns,
        ),
        "table_profile": _final([LOG], " UNION ALL ".join(profile), "measure:s column:s value:d"),
        "describe_numeric": _final([LOG], _describe("log", ["cost", "cpo", "time_since_last_click"]), DESCRIBE_COLUMNS),
        "lineitem_describe_numeric": _final(
            [], _describe("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]), DESCRIBE_COLUMNS
        ),
        "head_sample": _final(
            [],
            "SELECT * FROM orders LIMIT 1000",
            "o_orderkey:l o_custkey:l o_orderstatus:s o_totalprice:d o_orderpriority:s",
        ),
        "head_sample_by_key": _final(
            [LOG], f"SELECT * FROM log ORDER BY {TIME} LIMIT 1000", KEY_COLUMNS + " click:l cost:d"
        ),
    }


def _features() -> dict[str, str]:
    return {
        "click_features": _final(
            [LOG, FEATURES],
            "SELECT * FROM feat",
            KEY_COLUMNS + " log_cost:d log_cpo:d time_since_last_click:d has_prev_click:l "
            "log_time_since_last_click:d recency_bucket:l",
        ),
        "rank_features": _final(
            [LOG, FEATURES],
            f"SELECT {TIME}, {_share_rank('cost')} AS cost_rank, {_share_rank('cpo')} AS cpo_rank, "
            f"{_share_rank('rec')} AS recency_rank FROM feat",
            KEY_COLUMNS + " cost_rank:d cpo_rank:d recency_rank:d",
        ),
        "lineitem_rank": _final(
            [],
            f"SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, "
            f"{_mean_rank('l_quantity')} AS quantity_rank, {_mean_rank('l_extendedprice')} AS price_rank FROM lineitem",
            "l_orderkey:l l_partkey:l l_linenumber:l l_quantity:d l_extendedprice:d quantity_rank:d price_rank:d",
        ),
        "expected_value_top": _final(
            [LOG, FEATURES, SPLIT_LOG, CLICKS],
            f"SELECT *, pred_score * cpo AS expected_value FROM clicks ORDER BY expected_value DESC, {TIME} LIMIT 20",
            KEY_COLUMNS + " expected_value:d",
        ),
        "cumulative_gain": _final(
            [LOG, FEATURES, KNOWN, TEST],
            f"""SELECT {TIME}, observational_score, conversion, {_positions('observational_score')} AS position,
              sum(conversion) OVER (ORDER BY observational_score DESC, {TIME} ROWS UNBOUNDED PRECEDING)
                AS cumulative_outcomes FROM test""",
            KEY_COLUMNS + " observational_score:d conversion:l position:l cumulative_outcomes:l",
        ),
        "time_split": _final([LOG, FEATURES, SPLIT_LOG], "SELECT * FROM split_log", KEY_COLUMNS + " split:s"),
        "time_split_other_column": _final(
            [LOG, FEATURES, _split("feat", "split_log").replace('ORDER BY "timestamp"', 'ORDER BY cost, "timestamp"')],
            "SELECT * FROM split_log",
            KEY_COLUMNS + " split:s",
        ),
        "time_split_two_way": _final(
            [LOG],
            f"""SELECT CASE WHEN rn <= floor(n * 8e-1) THEN 'train' ELSE 'test' END AS split, count(*) AS "rows",
              min("timestamp") AS first, max("timestamp") AS last
            FROM (SELECT *, row_number() OVER (ORDER BY {TIME}) AS rn, count(*) OVER () AS n FROM log) GROUP BY 1""",
            "split:s rows:l first:l last:l",
        ),
        "time_slices": _final([LOG], _sliced("log", 7), KEY_COLUMNS + " time_slice:l"),
        "random_selection": _final(
            [LOG],
            f"""SELECT *, CASE WHEN rn <= greatest(1, trunc(n * 1e-2)) THEN 1e-2
                WHEN rn <= greatest(1, trunc(n * 1e-1)) THEN 1e-1 ELSE 3e-1 END AS smallest_fraction
              FROM (SELECT {TIME}, row_number() OVER (ORDER BY {_uniform(42)}, {TIME}) AS rn, count(*) OVER () AS n FROM log)
              WHERE rn <= greatest(1, trunc(n * 3e-1))""",
            KEY_COLUMNS + " smallest_fraction:d",
        ),
        "hash_draws": _final([LOG], f"SELECT {TIME}, {_uniform(7, 't')} AS draw FROM log", KEY_COLUMNS + " draw:d"),
    }


def _sliced(source: str, slices: int) -> str:
    """Rows with the 1-based quantile slice of their position in time."""
    return f"""
SELECT * EXCLUDE (pos, edges), 1 + len(list_filter(edges[2:len(edges) - 1], lambda e: e < pos)) AS time_slice
FROM (SELECT *, row_number() OVER (ORDER BY {TIME}) - 1 AS pos FROM {source})
CROSS JOIN (SELECT {_edges(f'(SELECT row_number() OVER () - 1 AS pos FROM {source})', 'pos', f'least({slices}, len(vs))')} AS edges)"""


def _encodings() -> dict[str, str]:
    base = [LOG, FEATURES, SPLIT_LOG]
    train = "FROM split_log WHERE split = 'train'"
    holey = """
holey AS (SELECT * EXCLUDE (cat4), CASE WHEN cat7 <> 3 THEN cat4 END AS cat4 FROM split_log)"""
    codes = ", ".join(
        f"""coalesce((SELECT code FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
              FROM (SELECT DISTINCT {name} AS v {train} AND {name} IS NOT NULL)) WHERE v = s.{name}), -1) AS {name}"""
        for name in ("cat9", "campaign")
    )
    return {
        "campaign_encoding": _final(
            base,
            f"""SELECT s.*, coalesce(r.rate, (SELECT avg(click) {train})) AS campaign_ctr
            FROM split_log s LEFT JOIN (SELECT campaign, avg(click) AS rate {train} GROUP BY campaign) r USING (campaign)""",
            KEY_COLUMNS + " campaign_ctr:d",
        ),
        "encoding_metadata": _final(
            base,
            f"""SELECT (SELECT avg(click) {train}) AS global_prior,
              count(*) FILTER (split = 'validation' AND r.rate IS NULL) AS validation_unseen_rows,
              avg(CASE WHEN r.rate IS NULL THEN 1e0 ELSE 0e0 END) FILTER (split = 'validation') AS validation_unseen_rate,
              count(*) FILTER (split = 'test' AND r.rate IS NULL) AS test_unseen_rows,
              avg(CASE WHEN r.rate IS NULL THEN 1e0 ELSE 0e0 END) FILTER (split = 'test') AS test_unseen_rate,
              (SELECT count(DISTINCT cat9) {train}) AS train_groups
            FROM split_log s LEFT JOIN (SELECT cat9, avg(click) AS rate {train} GROUP BY cat9) r USING (cat9)""",
            "global_prior:d validation_unseen_rows:l validation_unseen_rate:d test_unseen_rows:l test_unseen_rate:d "
            "train_groups:l",
        ),
        "impute": _final(
            [*base, holey],
            f"""SELECT {TIME},
              coalesce(time_since_last_click, (SELECT median(time_since_last_click) FROM holey WHERE split = 'train'))
                AS time_since_last_click,
              coalesce(cat4, (SELECT cat4 FROM holey WHERE split = 'train' AND cat4 IS NOT NULL GROUP BY cat4
                              ORDER BY count(*) DESC, cat4 LIMIT 1)) AS cat4 FROM holey""",
            KEY_COLUMNS + " time_since_last_click:d cat4:l",
        ),
        "ordinal_encode": _final(
            base, f'SELECT "timestamp", uid, {codes} FROM split_log s', "timestamp:l uid:l cat9:l campaign:l"
        ),
    }


def _metrics(source: str, label: str, score: str, by: str) -> str:
    """Ranking and probability metrics per group, from cumulative counts over distinct scores."""
    return f"""
SELECT g.*, a.roc_auc, a.pr_auc FROM (
  SELECT {by}, count(*) AS "rows", avg({label}) AS positive_rate, avg({score}) AS avg_score,
    -avg({label} * ln(greatest(least({score}, 1e0 - 2.220446049250313e-16), 2.220446049250313e-16))
      + (1 - {label}) * ln(1e0 - greatest(least({score}, 1e0 - 2.220446049250313e-16), 2.220446049250313e-16))) AS log_loss,
    avg(pow({score} - {label}, 2)) AS brier_score
  FROM {source} GROUP BY {by}) g
JOIN (
  SELECT {by}, CASE WHEN sum(p) > 0 AND sum(q) > 0 THEN sum(q * (tp - p / 2e0)) / (CAST(sum(p) AS DOUBLE) * sum(q)) END AS roc_auc,
    CASE WHEN sum(p) > 0 AND sum(q) > 0 THEN sum(p * CAST(tp AS DOUBLE) / (tp + fp)) / sum(p) END AS pr_auc
  FROM (SELECT *, sum(p) OVER down AS tp, sum(q) OVER down AS fp
        FROM (SELECT {by}, {score} AS s, sum({label}) AS p, sum(1 - {label}) AS q FROM {source} GROUP BY {by}, {score})
        WINDOW down AS (PARTITION BY {by} ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
  GROUP BY {by}) a USING ({by})"""


METRIC_COLUMNS = "rows:l positive_rate:d avg_score:d roc_auc:d pr_auc:d log_loss:d brier_score:d"


def _evaluation() -> dict[str, str]:
    base = [LOG, FEATURES, SPLIT_LOG, CLICKS]
    test = "\ntest_clicks AS MATERIALIZED (SELECT * FROM clicks WHERE split = 'test')"
    edges = _edges("test_clicks", "pred_score", "least(10, len(vs))")
    bins = f"""
edged AS MATERIALIZED (SELECT {edges} AS edges),
binned AS (SELECT click, pred_score, {_bin('edges', 'pred_score')} AS bin FROM test_clicks CROSS JOIN edged),
bins AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY avg_score DESC) AS rank_by_score,
    actual_rate / nullif((SELECT avg(click) FROM test_clicks), 0) AS lift_vs_baseline
  FROM (SELECT bin, count(*) AS "rows", sum(click) AS positives, avg(pred_score) AS avg_score, avg(click) AS actual_rate
        FROM binned GROUP BY bin))"""
    top = "\ntop AS (SELECT campaign FROM test_clicks GROUP BY campaign ORDER BY count(*) DESC, campaign LIMIT 4)"
    sliced = f"\nsliced AS MATERIALIZED ({_sliced('test_clicks', 5)})"
    return {
        "binary_metrics": _final(base, _metrics("clicks", "click", "pred_score", "split"), "split:s " + METRIC_COLUMNS),
        "calibration_bins": _final(
            [*base, test, bins],
            "SELECT * FROM bins",
            "bin:l rank_by_score:l rows:l positives:d avg_score:d actual_rate:d lift_vs_baseline:d",
        ),
        "calibration_summary": _final(
            [*base, test, bins],
            """SELECT (SELECT avg(click) FROM test_clicks) AS baseline_positive_rate,
              avg(abs(avg_score - actual_rate)) AS calibration_bin_mae,
              arg_min(lift_vs_baseline, rank_by_score) AS top_bin_lift,
              arg_max(lift_vs_baseline, rank_by_score) AS bottom_bin_lift FROM bins""",
            "baseline_positive_rate:d calibration_bin_mae:d top_bin_lift:d bottom_bin_lift:d",
        ),
        "campaign_slices": _final(
            [*base, test, top, "\nchosen AS (SELECT * FROM test_clicks WHERE campaign IN (SELECT campaign FROM top))"],
            f'SELECT *, CAST(campaign AS VARCHAR) AS "group" FROM ({_metrics("chosen", "click", "pred_score", "campaign")})',
            METRIC_COLUMNS + " group:s",
        ),
        "time_slice_metrics": _final(
            [*base, test, sliced],
            f"""SELECT m.*, 'slice_' || m.time_slice AS "group", r.timestamp_min, r.timestamp_max
            FROM ({_metrics('sliced', 'click', 'pred_score', 'time_slice')}) m
            JOIN (SELECT time_slice, min("timestamp") AS timestamp_min, max("timestamp") AS timestamp_max
                  FROM sliced GROUP BY time_slice) r USING (time_slice)""",
            "time_slice:l " + METRIC_COLUMNS + " timestamp_min:l timestamp_max:l group:s",
        ),
        "propensity_metrics": _final(
            [LOG, FEATURES, KNOWN],
            _metrics("uplift", "synthetic_treatment", "propensity_score", "split"),
            "split:s " + METRIC_COLUMNS,
        ),
    }


SCORES = ("observational_score", "doubly_robust_score")


def _uplift() -> dict[str, str]:
    base = [LOG, FEATURES, KNOWN, TEST]
    positioned = "\nplaced AS (" + " UNION ALL ".join(
        f"""SELECT '{s}' AS score_col, {s} AS score, synthetic_treatment AS t, synthetic_outcome AS y,
          true_treatment_effect AS e, {_positions(s)} AS rn, count(*) OVER () AS n FROM test"""
        for s in SCORES
    ) + ")"
    diagnostics = """
SELECT score_col, max(n) AS "rows", count(*) FILTER (rn <= k) AS top_rows, count(*) FILTER (rn > n - k) AS bottom_rows,
  avg(score) FILTER (rn <= k) AS top_mean_score, avg(score) FILTER (rn > n - k) AS bottom_mean_score,
  avg(y) FILTER (rn <= k) AS top_observed_conversion_rate, avg(y) FILTER (rn > n - k) AS bottom_observed_conversion_rate,
  avg(t) FILTER (rn <= k) AS top_treatment_rate, avg(t) FILTER (rn > n - k) AS bottom_treatment_rate
FROM (SELECT *, greatest(1, CAST(trunc(n * 1e-1) AS BIGINT)) AS k FROM placed) GROUP BY score_col"""
    curve = f"""
SELECT *, treated_outcome_rate - control_outcome_rate AS observed_treated_control_gap,
  observed_outcome_rate / nullif(baseline_outcome_rate, 0) AS outcome_rate_lift
FROM (SELECT score_col, fraction AS top_fraction, count(*) FILTER (rn <= k) AS "rows",
    avg(score) FILTER (rn <= k) AS mean_score, avg(y) FILTER (rn <= k) AS observed_outcome_rate,
    avg(y) AS baseline_outcome_rate, avg(t) FILTER (rn <= k) AS treatment_rate, avg(t) AS baseline_treatment_rate,
    avg(y) FILTER (rn <= k AND t = 1) AS treated_outcome_rate, avg(y) FILTER (rn <= k AND t = 0) AS control_outcome_rate
  FROM (SELECT *, greatest(1, CAST(trunc(n * fraction) AS BIGINT)) AS k FROM placed, {FRACTIONS})
  GROUP BY score_col, fraction)"""
    correlations = " UNION ALL ".join(
        f"""SELECT '{s}' AS score_col, corr(ra, rb) AS spearman, corr(a, b) AS pearson
        FROM (SELECT {s} AS a, true_treatment_effect AS b, {_mean_rank(s)} AS ra,
                {_mean_rank('true_treatment_effect')} AS rb FROM test)"""
        for s in SCORES
    )
    effect_placed = positioned + f""",
oracle_placed AS (
  SELECT 'oracle_true_effect' AS score_col, CAST(NULL AS DOUBLE) AS score, true_treatment_effect AS e,
    {_positions('true_treatment_effect')} AS rn, count(*) OVER () AS n FROM test),
all_placed AS (SELECT score_col, score, e, rn, n FROM placed UNION ALL SELECT * FROM oracle_placed),
correlations AS ({correlations} UNION ALL SELECT 'oracle_true_effect', 1e0, 1e0)"""
    known = f"""
SELECT *, mean_true_effect / nullif(baseline_true_effect, 0) AS true_effect_lift
FROM (SELECT score_col, fraction AS top_fraction, any_value(spearman) AS spearman_corr_with_true_effect,
    any_value(pearson) AS pearson_corr_with_true_effect, count(*) FILTER (rn <= k) AS "rows",
    avg(score) FILTER (rn <= k) AS mean_score, avg(e) FILTER (rn <= k) AS mean_true_effect, avg(e) AS baseline_true_effect
  FROM (SELECT *, greatest(1, CAST(trunc(n * fraction) AS BIGINT)) AS k
        FROM all_placed JOIN correlations USING (score_col), {FRACTIONS})
  GROUP BY score_col, fraction)"""
    return {
        "known_effect_columns": _final(
            [LOG, FEATURES, KNOWN],
            "SELECT * FROM uplift",
            KEY_COLUMNS + " synthetic_treatment:l synthetic_outcome:l true_treatment_effect:d "
            "synthetic_treatment_propensity:d synthetic_outcome_probability:d baseline_outcome_probability:d",
        ),
        "ranking_diagnostics": _final(
            [*base, positioned],
            diagnostics,
            "score_col:s rows:d top_rows:d bottom_rows:d top_mean_score:d bottom_mean_score:d "
            "top_observed_conversion_rate:d bottom_observed_conversion_rate:d top_treatment_rate:d bottom_treatment_rate:d",
        ),
        "policy_curve": _final(
            [*base, positioned],
            curve,
            "score_col:s top_fraction:d rows:d mean_score:d observed_outcome_rate:d baseline_outcome_rate:d "
            "outcome_rate_lift:d treatment_rate:d baseline_treatment_rate:d treated_outcome_rate:d "
            "control_outcome_rate:d observed_treated_control_gap:d",
        ),
        "known_effect_report": _final(
            [*base, effect_placed],
            known,
            "score_col:s top_fraction:d spearman_corr_with_true_effect:d pearson_corr_with_true_effect:d rows:d "
            "mean_score:d mean_true_effect:d baseline_true_effect:d true_effect_lift:d",
        ),
        "score_correlation": _final(
            base, "SELECT corr(observational_score, doubly_robust_score) AS correlation FROM test", "correlation:d"
        ),
        "dr_pseudo_outcome": _final(
            [LOG, FEATURES, KNOWN],
            """SELECT *, ((synthetic_treatment - propensity_score) / (propensity_score * (1e0 - propensity_score)))
              * (synthetic_outcome - CASE WHEN synthetic_treatment = 1 THEN treated_outcome_score
                                          ELSE control_outcome_score END)
              + (treated_outcome_score - control_outcome_score) AS effect_outcome FROM uplift""",
            KEY_COLUMNS + " effect_outcome:d",
        ),
    }


POLICY_COLUMNS = (
    "policy_name:s score_col:s top_fraction:d selected_rows:l selected_share:d mean_score:d observed_outcome_rate:d "
    "baseline_outcome_rate:d observed_outcome_lift:d treatment_rate:d baseline_treatment_rate:d mean_true_effect:d "
    "baseline_true_effect:d true_effect_lift:d expected_incremental_conversions:d "
    "expected_incremental_conversions_per_1k_selected:d oracle_expected_incremental_conversions:d "
    "oracle_regret_incremental_conversions:d"
)
COMPARISON_COLUMNS = (
    "policy_name:s score_col:s top_fraction:d selected_rows:l mean_true_effect:d true_effect_lift:d "
    "expected_incremental_conversions:d expected_incremental_conversions_per_1k_selected:d "
    "random_expected_incremental_conversions:d oracle_expected_incremental_conversions:d "
    "incremental_conversions_vs_random:d oracle_regret_incremental_conversions:d oracle_capture_rate:d"
)


def _policy_ctes() -> str:
    orders = [
        ("random_policy", "NULL", "CAST(NULL AS DOUBLE)", f"row_number() OVER (ORDER BY {_uniform(42)}, {TIME})"),
        ("oracle_true_effect", "'true_treatment_effect'", "true_treatment_effect", _positions("true_treatment_effect")),
        *[(f"top_{s}", f"'{s}'", s, _positions(s)) for s in SCORES],
    ]
    placed = " UNION ALL ".join(
        f"""SELECT '{name}' AS policy_name, {col} AS score_col, {score} AS score, {rn} AS rn, count(*) OVER () AS n,
          synthetic_treatment AS t, synthetic_outcome AS y, true_treatment_effect AS e FROM test"""
        for name, col, score, rn in orders
    )
    return f"""
placed AS MATERIALIZED ({placed}),
selected AS (
  SELECT policy_name, score_col, fraction AS top_fraction, score, t, y, e, n
  FROM (SELECT *, greatest(1, CAST(trunc(n * fraction) AS BIGINT)) AS k FROM placed, {FRACTIONS}) WHERE rn <= k
  UNION ALL
  SELECT 'all_rows', NULL, 1e0, NULL, t, y, e, n FROM placed WHERE policy_name = 'random_policy'),
base AS (SELECT avg(synthetic_outcome) AS by_, avg(synthetic_treatment) AS bt, avg(true_treatment_effect) AS be FROM test),
plain AS (
  SELECT policy_name, score_col, top_fraction, count(*) AS selected_rows, count(*) / CAST(max(n) AS DOUBLE) AS selected_share,
    avg(score) AS mean_score, avg(y) AS observed_outcome_rate, avg(t) AS treatment_rate, avg(e) AS mean_true_effect,
    sum(e) AS expected_incremental_conversions,
    sum(e) / count(*) * 1000e0 AS expected_incremental_conversions_per_1k_selected
  FROM selected GROUP BY policy_name, score_col, top_fraction),
policies AS MATERIALIZED (
  SELECT plain.*, by_ AS baseline_outcome_rate, bt AS baseline_treatment_rate, be AS baseline_true_effect,
    observed_outcome_rate / nullif(by_, 0) AS observed_outcome_lift, mean_true_effect / nullif(be, 0) AS true_effect_lift,
    o.best AS oracle_expected_incremental_conversions,
    o.best - expected_incremental_conversions AS oracle_regret_incremental_conversions
  FROM plain CROSS JOIN base LEFT JOIN (
    SELECT top_fraction, expected_incremental_conversions AS best FROM plain WHERE policy_name = 'oracle_true_effect') o
    USING (top_fraction)),
comparison AS MATERIALIZED (
  SELECT p.* EXCLUDE (score_col), 'doubly_robust_score' AS score_col,
    r.expected_incremental_conversions AS random_expected_incremental_conversions,
    p.expected_incremental_conversions - r.expected_incremental_conversions AS incremental_conversions_vs_random,
    p.expected_incremental_conversions / nullif(p.oracle_expected_incremental_conversions, 0) AS oracle_capture_rate
  FROM policies p LEFT JOIN (SELECT * FROM policies WHERE policy_name = 'random_policy') r USING (top_fraction)
  WHERE p.policy_name = 'top_doubly_robust_score')"""


def _targeting() -> dict[str, str]:
    base = [LOG, FEATURES, KNOWN, TEST]
    policies = _policy_ctes()
    pick = lambda order: f"(SELECT * FROM comparison ORDER BY {order}, top_fraction LIMIT 1)"
    recommendation = f"""
SELECT r.policy_name AS recommended_policy_name, r.score_col AS recommended_score_col,
  r.top_fraction AS recommended_top_fraction, r.selected_rows AS recommended_selected_rows,
  r.expected_incremental_conversions AS recommended_expected_incremental_conversions,
  r.incremental_conversions_vs_random AS recommended_incremental_conversions_vs_random,
  r.oracle_capture_rate AS recommended_oracle_capture_rate,
  r.oracle_regret_incremental_conversions AS recommended_oracle_regret_incremental_conversions,
  e.top_fraction AS highest_efficiency_top_fraction,
  e.expected_incremental_conversions_per_1k_selected AS highest_efficiency_incremental_conversions_per_1k_selected,
  c.top_fraction AS highest_oracle_capture_top_fraction, c.oracle_capture_rate AS highest_oracle_capture_rate
FROM {pick('abs(top_fraction - 1e-1)')} r, {pick('expected_incremental_conversions_per_1k_selected DESC')} e,
  {pick('oracle_capture_rate DESC')} c"""
    scored = f"""
batch AS MATERIALIZED (
  SELECT *, 'doubly_robust_score' AS policy_score_col, 1e0 - (policy_score_rank - 1) / greatest(n, 1) AS policy_score_percentile,
    1e-1 AS recommended_top_fraction,
    CASE WHEN policy_score_rank <= greatest(1, trunc(n * 1e-1)) THEN 1 ELSE 0 END AS recommended_policy
  FROM (SELECT *, {_positions('doubly_robust_score')} AS policy_score_rank, count(*) OVER () AS n FROM test))"""
    return {
        "policy_table": _final([*base, policies], "SELECT * FROM policies", POLICY_COLUMNS),
        "policy_comparison": _final([*base, policies], "SELECT * FROM comparison", COMPARISON_COLUMNS),
        "policy_recommendation": _final(
            [*base, policies],
            recommendation,
            "recommended_policy_name:s recommended_score_col:s recommended_top_fraction:d recommended_selected_rows:l "
            "recommended_expected_incremental_conversions:d recommended_incremental_conversions_vs_random:d "
            "recommended_oracle_capture_rate:d recommended_oracle_regret_incremental_conversions:d "
            "highest_efficiency_top_fraction:d highest_efficiency_incremental_conversions_per_1k_selected:d "
            "highest_oracle_capture_top_fraction:d highest_oracle_capture_rate:d",
        ),
        "batch_scores": _final(
            [*base, scored],
            "SELECT * FROM batch",
            "uid:l timestamp:l campaign:l true_treatment_effect:d observational_score:d doubly_robust_score:d "
            "policy_score_col:s policy_score_rank:l policy_score_percentile:d recommended_top_fraction:d "
            "recommended_policy:l",
        ),
        "batch_summary": _final(
            [*base, scored],
            """SELECT count(*) AS "rows", count(*) FILTER (recommended_policy = 1) AS recommended_rows,
              avg(recommended_policy) AS recommended_share, 'doubly_robust_score' AS preferred_score_col,
              1e-1 AS recommended_top_fraction, avg(doubly_robust_score) AS mean_preferred_score,
              avg(doubly_robust_score) FILTER (recommended_policy = 1) AS recommended_mean_preferred_score,
              avg(true_treatment_effect) AS mean_true_effect,
              avg(true_treatment_effect) FILTER (recommended_policy = 1) AS recommended_mean_true_effect,
              sum(true_treatment_effect) FILTER (recommended_policy = 1) AS recommended_expected_incremental_conversions,
              sum(true_treatment_effect) FILTER (recommended_policy = 1) / count(*) FILTER (recommended_policy = 1) * 1000e0
                AS recommended_expected_incremental_conversions_per_1k FROM batch""",
            "rows:l recommended_rows:l recommended_share:d preferred_score_col:s recommended_top_fraction:d "
            "mean_preferred_score:d recommended_mean_preferred_score:d mean_true_effect:d recommended_mean_true_effect:d "
            "recommended_expected_incremental_conversions:d recommended_expected_incremental_conversions_per_1k:d",
        ),
    }


def _psi(r: str, c: str) -> str:
    return f"(greatest({c}, 1e-6) - greatest({r}, 1e-6)) * ln(greatest({c}, 1e-6) / greatest({r}, 1e-6))"


def _numeric_drift(table: str, side: str, columns: list[str]) -> str:
    """`side` is an SQL condition that is true for reference rows and false for current rows."""
    parts = []
    for name in columns:
        v = f"CAST({name} AS DOUBLE)"
        ref, cur = f"FILTER ({side})", f"FILTER (NOT {side})"
        parts.append(
            f"""SELECT '{name}' AS "column", 'numeric' AS kind, count(*) {ref} AS reference_rows,
              count(*) {cur} AS current_rows, avg(CASE WHEN {v} IS NULL THEN 1e0 ELSE 0e0 END) {ref} AS reference_missing_rate,
              avg(CASE WHEN {v} IS NULL THEN 1e0 ELSE 0e0 END) {cur} AS current_missing_rate,
              avg({v}) {ref} AS reference_mean, avg({v}) {cur} AS current_mean,
              avg({v}) {cur} - avg({v}) {ref} AS mean_delta, stddev_pop({v}) {ref} AS reference_std,
              stddev_pop({v}) {cur} AS current_std,
              (SELECT sum({_psi('r / rn', 'c / cn')}) FROM (
                SELECT CAST(r AS DOUBLE) AS r, CAST(c AS DOUBLE) AS c, sum(r) OVER () AS rn, sum(c) OVER () AS cn FROM (
                  SELECT {_bin('edges', v)} AS bin, count(*) {ref} AS r, count(*) {cur} AS c
                  FROM {table} CROSS JOIN (SELECT {_edges(table, v, '10', side)} AS edges)
                  WHERE {v} IS NOT NULL GROUP BY 1))) AS psi
            FROM {table}"""
        )
    return " UNION ALL ".join(parts)


def _categorical_drift(table: str, side: str, columns: list[str], top_n: int) -> str:
    parts = []
    for name in columns:
        counts = f"""(SELECT CAST({name} AS VARCHAR) AS v, count(*) FILTER ({side}) AS r, count(*) FILTER (NOT {side}) AS c
                      FROM {table} GROUP BY 1)"""
        order = "TRY_CAST(v AS DOUBLE) NULLS LAST, v NULLS LAST"
        parts.append(
            f"""SELECT '{name}' AS "column", 'categorical' AS kind, sum(r) AS reference_rows, sum(c) AS current_rows,
              coalesce(sum(r) FILTER (v IS NULL), 0) / CAST(sum(r) AS DOUBLE) AS reference_missing_rate,
              coalesce(sum(c) FILTER (v IS NULL), 0) / CAST(sum(c) AS DOUBLE) AS current_missing_rate,
              count(*) FILTER (v IS NOT NULL AND r > 0) AS reference_unique,
              count(*) FILTER (v IS NOT NULL AND c > 0) AS current_unique,
              coalesce(sum(c) FILTER (v IS NOT NULL AND r = 0), 0) / CAST(sum(c) AS DOUBLE) AS new_category_share,
              first(v) FILTER (rr = 1) AS top_reference_category, first(v) FILTER (rc = 1) AS top_current_category,
              sum({_psi('r / CAST(rn AS DOUBLE)', 'c / CAST(cn AS DOUBLE)')})
                FILTER ((rr <= {top_n} AND r > 0) OR (rc <= {top_n} AND c > 0)) AS psi
            FROM (SELECT *, sum(r) OVER () AS rn, sum(c) OVER () AS cn,
                    row_number() OVER (ORDER BY r DESC, {order}) AS rr,
                    row_number() OVER (ORDER BY c DESC, {order}) AS rc FROM {counts})"""
        )
    return " UNION ALL ".join(parts)


NUMERIC_COLUMNS = (
    "column:s kind:s reference_rows:l current_rows:l reference_missing_rate:d current_missing_rate:d reference_mean:d "
    "current_mean:d mean_delta:d reference_std:d current_std:d psi:d"
)
CATEGORICAL_COLUMNS = (
    "column:s kind:s reference_rows:l current_rows:l reference_missing_rate:d current_missing_rate:d "
    "reference_unique:l current_unique:l new_category_share:d top_reference_category:s top_current_category:s psi:d"
)


def _drift() -> dict[str, str]:
    base = [LOG, FEATURES, KNOWN, "\nsides AS MATERIALIZED (SELECT * FROM uplift WHERE split <> 'validation')"]
    features = ["log_cost", "log_cpo", "time_since_last_click", "cost_rank", "recency_rank"]
    numeric = _numeric_drift("sides", "split = 'train'", [*features, *SCORES])
    categorical = _categorical_drift("sides", "split = 'train'", ["campaign", "recency_bucket", "cat9"], 5)
    names = ", ".join(f"'{s}'" for s in SCORES)
    summary = f"""
SELECT max(reference_rows) AS reference_rows, max(current_rows) AS current_rows,
  count(*) FILTER (kind = 'numeric' AND NOT score) AS numeric_feature_count,
  count(*) FILTER (kind = 'categorical') AS categorical_feature_count, count(*) FILTER (score) AS score_count,
  max(psi) FILTER (NOT score) AS max_feature_psi, max(psi) FILTER (score) AS max_score_psi
FROM (SELECT kind, reference_rows, current_rows, psi, "column" IN ({names}) AS score FROM ({numeric})
      UNION ALL SELECT kind, reference_rows, current_rows, psi, false FROM ({categorical}))"""
    early = "l_shipdate < TIMESTAMP '1998-06-01'"
    clicks = [LOG, FEATURES, SPLIT_LOG, CLICKS]
    p = "greatest(least(pred_score, 1e0 - 2.220446049250313e-16), 2.220446049250313e-16)"
    edges = _edges("clicks", "pred_score", "10", "split = 'validation'")
    calibrated = f"""
edged AS MATERIALIZED (SELECT {edges} AS edges),
totals AS MATERIALIZED (
  SELECT split, {_bin('edges', 'pred_score')} AS bin, count(*) AS "rows", sum(click) AS positives, avg(pred_score) AS s,
    avg(click) AS a
  FROM clicks CROSS JOIN edged WHERE split <> 'train' GROUP BY split, bin),
bins AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY bin) AS bin, *  EXCLUDE (bin),
    current_avg_score - reference_avg_score AS avg_score_delta,
    current_actual_rate - reference_actual_rate AS actual_rate_delta
  FROM (SELECT bin, coalesce(r."rows", 0) AS reference_rows, coalesce(c."rows", 0) AS current_rows,
      coalesce(r.positives, 0) AS reference_positives, coalesce(c.positives, 0) AS current_positives,
      coalesce(r.s, 0e0) AS reference_avg_score, coalesce(c.s, 0e0) AS current_avg_score,
      coalesce(r.a, 0e0) AS reference_actual_rate, coalesce(c.a, 0e0) AS current_actual_rate
    FROM (SELECT * FROM totals WHERE split = 'validation') r
    FULL OUTER JOIN (SELECT * FROM totals WHERE split = 'test') c USING (bin)))"""
    measures = {
        "positive_rate": "avg(click) FILTER ({s})",
        "avg_score": "avg(pred_score) FILTER ({s})",
        "log_loss": f"-avg(click * ln({p}) + (1 - click) * ln(1e0 - {p})) FILTER ({{s}})",
        "brier_score": "avg(pow(pred_score - click, 2)) FILTER ({s})",
    }
    parts = ["count(*) FILTER (split = 'validation') AS reference_rows", "count(*) FILTER (split = 'test') AS current_rows"]
    for name, text in measures.items():
        r, c = text.format(s="split = 'validation'"), text.format(s="split = 'test'")
        parts += [f"{r} AS reference_{name}", f"{c} AS current_{name}", f"{c} - ({r}) AS {name}_delta"]
    mae = "(SELECT sum(abs(s - a) * \"rows\") / sum(\"rows\") FROM totals WHERE split = '{}')"
    r, c = mae.format("validation"), mae.format("test")
    parts += [f"{r} AS reference_calibration_mae", f"{c} AS current_calibration_mae", f"{c} - {r} AS calibration_mae_delta"]
    parts += [
        "(SELECT count(*) FROM bins) AS bins",
        "(SELECT max(abs(actual_rate_delta)) FROM bins) AS max_bin_actual_rate_delta",
        "(SELECT max(abs(avg_score_delta)) FROM bins) AS max_bin_avg_score_delta",
    ]
    sided = " ".join(
        f"reference_{m}:d current_{m}:d {m}_delta:d"
        for m in ("positive_rate", "avg_score", "log_loss", "brier_score", "calibration_mae")
    )
    return {
        "numeric_drift": _final(base, numeric, NUMERIC_COLUMNS),
        "categorical_drift": _final(base, categorical, CATEGORICAL_COLUMNS),
        "drift_summary": _final(
            base,
            summary,
            "reference_rows:l current_rows:l numeric_feature_count:l categorical_feature_count:l score_count:l "
            "max_feature_psi:d max_score_psi:d",
        ),
        "lineitem_numeric_drift": _final(
            [], _numeric_drift("lineitem", f"({early})", ["l_quantity", "l_extendedprice", "l_discount"]), NUMERIC_COLUMNS
        ),
        "lineitem_categorical_drift": _final(
            [],
            _categorical_drift("lineitem", f"({early})", ["l_returnflag", "l_linestatus", "l_suppkey"], 20),
            CATEGORICAL_COLUMNS,
        ),
        "calibration_drift_bins": _final(
            [*clicks, calibrated],
            "SELECT * FROM bins",
            "bin:l reference_rows:l current_rows:l reference_positives:d current_positives:d reference_avg_score:d "
            "current_avg_score:d avg_score_delta:d reference_actual_rate:d current_actual_rate:d actual_rate_delta:d",
        ),
        "calibration_drift": _final(
            [*clicks, calibrated],
            f"SELECT {', '.join(parts)} FROM clicks",
            f"reference_rows:l current_rows:l bins:l {sided} max_bin_actual_rate_delta:d max_bin_avg_score_delta:d",
        ),
    }


NEWTON_STEPS = 9


def _design(name: str, rows: str, numeric: list[str], categorical: list[str]) -> str:
    """Sparse design of `rows` (rid, train, columns): name_x (rid, i, v), feature numbers name_slots, name_n columns in all.

    Categories are those of the training rows; position 0 is the leading one.
    """
    p = len(numeric)
    values = " UNION ALL ".join(f"SELECT {k} AS pos, '{c}' AS name, {c} AS value FROM {rows} WHERE train" for k, c in enumerate(categorical))
    parts = [f"SELECT rid, 0 AS i, 1e0 AS v FROM {rows}"]
    parts += [f"SELECT rid, {k + 1} AS i, CAST({c} AS DOUBLE) AS v FROM {rows}" for k, c in enumerate(numeric)]
    parts += [f"SELECT rid, s.i, 1e0 AS v FROM {rows} r JOIN {name}_slots s ON s.name = '{c}' AND s.value = r.{c}" for c in categorical]
    names = ["SELECT 0 AS i, 'intercept' AS feature"]
    names += [f"SELECT {k + 1} AS i, '{c}' AS feature" for k, c in enumerate(numeric)]
    names.append(f"SELECT i, name || '=' || value AS feature FROM {name}_slots")
    return f"""
{name}_slots AS MATERIALIZED (SELECT *, {p} + row_number() OVER (ORDER BY pos, value) AS i FROM (SELECT DISTINCT * FROM ({values}))),
{name}_names AS ({' UNION ALL '.join(names)}),
{name}_n AS MATERIALIZED (SELECT count(*) AS n FROM {name}_names),
{name}_x AS MATERIALIZED ({' UNION ALL '.join(parts)})"""


def _solved(name: str, design: str, gram: str, cross: str) -> str:
    """name (i, b): the solution of gram (i, j, v) b = cross (i, v), by Gauss-Jordan steps."""
    return f"""
{name}_g AS (
  SELECT 0 AS p, i, j, v FROM (
    SELECT a.i, b.i AS j, coalesce(g.v, 0e0) AS v FROM {design}_names a CROSS JOIN {design}_names b LEFT JOIN {gram} g ON g.i = a.i AND g.j = b.i
    UNION ALL SELECT a.i, n AS j, coalesce(c.v, 0e0) AS v FROM {design}_names a CROSS JOIN {design}_n LEFT JOIN {cross} c ON c.i = a.i)
  UNION ALL
  SELECT p + 1, i, j, CASE WHEN i = p THEN pj / pp ELSE v - ip * pj / pp END
  FROM (SELECT *, max(CASE WHEN j = p THEN v END) OVER (PARTITION BY i) AS ip,
          max(CASE WHEN i = p THEN v END) OVER (PARTITION BY j) AS pj,
          max(CASE WHEN i = p AND j = p THEN v END) OVER () AS pp FROM {name}_g)
  WHERE p < (SELECT n FROM {design}_n)),
{name} AS MATERIALIZED (SELECT i, v AS b FROM {name}_g WHERE p = (SELECT n FROM {design}_n) AND j = (SELECT n FROM {design}_n))"""


def _ridge(name: str, design: str, label: str, alpha: str) -> list[str]:
    """name (i, b) from `label` (rid, y) over the rows that have one."""
    return [
        f"""
{name}_gram AS MATERIALIZED (
  SELECT i, j, v + CASE WHEN i = j AND i > 0 THEN {alpha} ELSE 0e0 END AS v FROM (
    SELECT a.i, b.i AS j, sum(a.v * b.v) AS v
    FROM {design}_x a JOIN {design}_x b USING (rid) WHERE rid IN (SELECT rid FROM {label}) GROUP BY a.i, b.i)),
{name}_cross AS MATERIALIZED (SELECT i, sum(v * y) AS v FROM {design}_x JOIN {label} USING (rid) GROUP BY i)""",
        _solved(name, design, f"{name}_gram", f"{name}_cross"),
    ]


def _newton(name: str, design: str, label: str, penalty: str = "1e0") -> list[str]:
    """name (i, b): logistic coefficients for `label` (rid, y) by whole Newton steps from zero."""
    ctes = [f"\n{name}_0 AS MATERIALIZED (SELECT i, 0e0 AS b FROM {design}_names)"]
    for k in range(NEWTON_STEPS):
        old, step = f"{name}_{k}", f"{name}_step{k}"
        ctes.append(f"""
{step}_p AS MATERIALIZED (
  SELECT rid, any_value(y) AS y, 1e0 / (1e0 + exp(-sum(v * b))) AS p
  FROM {design}_x JOIN {old} USING (i) JOIN {label} USING (rid) GROUP BY rid),
{step}_gram AS MATERIALIZED (
  SELECT a.i, b.i AS j, sum(p * (1 - p) * a.v * b.v) + CASE WHEN a.i = b.i AND a.i > 0 THEN {penalty} ELSE 0e0 END AS v
  FROM {step}_p JOIN {design}_x a USING (rid) JOIN {design}_x b USING (rid) GROUP BY a.i, b.i),
{step}_cross AS MATERIALIZED (
  SELECT i, sum((y - p) * v) - any_value(CASE WHEN i > 0 THEN {penalty} * b ELSE 0e0 END) AS v
  FROM {step}_p JOIN {design}_x USING (rid) JOIN {old} USING (i) GROUP BY i)""")
        ctes.append(_solved(step, design, f"{step}_gram", f"{step}_cross"))
        ctes.append(f"\n{name}_{k + 1} AS MATERIALIZED (SELECT i, o.b + s.b AS b FROM {old} o JOIN {step} s USING (i))")
    ctes.append(f"\n{name} AS MATERIALIZED (SELECT * FROM {name}_{NEWTON_STEPS})")
    return ctes


def _margin(design: str, beta: str) -> str:
    return f"(SELECT rid, sum(v * b) AS m FROM {design}_x JOIN {beta} USING (i) GROUP BY rid)"


def _five(column: str) -> str:
    return f"round({column}, 5) AS {column}"


def _fits() -> dict[str, str]:
    base = [LOG, FEATURES, SPLIT_LOG]
    click_rows = """
rows_in AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY "timestamp", uid, campaign) AS rid, "timestamp", uid, campaign, split, split = 'train' AS train, click,
    log_cost, has_prev_click, recency_bucket,
    coalesce(CASE WHEN cat7 <> 3 THEN cat4 END, (SELECT cat4 FROM split_log WHERE split = 'train' AND cat7 <> 3 GROUP BY cat4
      ORDER BY count(*) DESC, cat4 LIMIT 1)) AS cat4
  FROM split_log),
click_y AS MATERIALIZED (SELECT rid, click AS y FROM rows_in WHERE train)"""
    click = [*base, click_rows, _design("d", "rows_in", ["log_cost", "has_prev_click"], ["cat4", "recency_bucket"]), *_newton("beta", "d", "click_y")]
    uplift_rows = """
rows_in AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY "timestamp", uid, campaign) AS rid, *, split = 'train' AS train FROM uplift)"""
    design = _design("d", "rows_in", ["log_cost", "cpo_rank", "has_prev_click"], ["cat4", "recency_bucket"])
    uplift = [LOG, FEATURES, KNOWN, uplift_rows, design]
    effect = "(t - e) / (e * (1e0 - e)) * (y - CASE WHEN t = 1 THEN m1 ELSE m0 END) + (m1 - m0) AS y"
    given = f"""
effect_y AS MATERIALIZED (
  SELECT rid, {effect} FROM (SELECT rid, synthetic_treatment AS t, synthetic_outcome AS y, propensity_score AS e,
    treated_outcome_score AS m1, control_outcome_score AS m0 FROM rows_in WHERE train))"""
    labels = """
t_y AS MATERIALIZED (SELECT rid, synthetic_treatment AS y FROM rows_in WHERE train),
y1 AS MATERIALIZED (SELECT rid, synthetic_outcome AS y FROM rows_in WHERE train AND synthetic_treatment = 1),
y0 AS MATERIALIZED (SELECT rid, synthetic_outcome AS y FROM rows_in WHERE train AND synthetic_treatment = 0)"""
    scored = f"""
nuisances AS MATERIALIZED (
  SELECT r.rid, synthetic_treatment AS t, synthetic_outcome AS y, train,
    greatest(least(1e0 / (1e0 + exp(-e.m)), 95e-2), 5e-2) AS e, 1e0 / (1e0 + exp(-a.m)) AS m1, 1e0 / (1e0 + exp(-b.m)) AS m0
  FROM rows_in r JOIN {_margin('d', 'beta_t')} e USING (rid) JOIN {_margin('d', 'beta_1')} a USING (rid) JOIN {_margin('d', 'beta_0')} b USING (rid)),
effect_y AS MATERIALIZED (SELECT rid, {effect} FROM nuisances WHERE train)"""
    fitted = [labels, *_newton("beta_t", "d", "t_y"), *_newton("beta_1", "d", "y1"), *_newton("beta_0", "d", "y0"), scored, *_ridge("tau", "d", "effect_y", "1e0")]
    inputs = ("has_prev_click", "recency_bucket", "cat4", "cat6", "cpo", "cat9")
    long = " UNION ALL ".join(f"SELECT {k} AS k, '{c}' AS input, CAST({c} AS DOUBLE) AS v, click FROM split_log WHERE split = 'train'" for k, c in enumerate(inputs))
    stump = f"""
long AS MATERIALIZED ({long}),
prior AS (SELECT avg(click) AS p FROM split_log WHERE split = 'train'),
cells AS (SELECT k, input, v, sum(p - click) AS g, sum(p * (1 - p)) AS h FROM long, prior GROUP BY k, input, v),
sides AS (SELECT *, sum(g) OVER upto AS lg, sum(h) OVER upto AS lh, sum(g) OVER (PARTITION BY k) AS ag, sum(h) OVER (PARTITION BY k) AS ah,
    max(v) OVER (PARTITION BY k) AS top
  FROM cells WINDOW upto AS (PARTITION BY k ORDER BY v ROWS UNBOUNDED PRECEDING)),
splits AS (SELECT k, input, v AS cut, round(5e-1 * (lg * lg / (lh + 1) + (ag - lg) * (ag - lg) / (ah - lh + 1) - ag * ag / (ah + 1)), 9) AS gain,
    -lg / (lh + 1) AS left_value, -(ag - lg) / (ah - lh + 1) AS right_value
  FROM sides WHERE v < top AND lh >= 1 AND ah - lh >= 1)"""
    slots = "\nslots AS (SELECT *, row_number() OVER (ORDER BY name, value) - 1 AS slot FROM (" + " UNION ".join(
        f"SELECT '{c}' AS name, {c} AS value FROM holey WHERE split = 'train' AND {c} IS NOT NULL" for c in ("campaign", "cat4", "cat9")
    ) + "))"
    holey = """
holey AS (SELECT * EXCLUDE (cat4), CASE WHEN cat7 <> 3 THEN cat4 END AS cat4 FROM split_log)"""
    listed = ", ".join(f"(SELECT slot FROM slots WHERE name = '{c}' AND value = h.{c})" for c in ("campaign", "cat4", "cat9"))
    pred = "\npred AS MATERIALIZED (SELECT split, click, round(1e0 / (1e0 + exp(-m)), 9) AS s FROM rows_in JOIN " + _margin("d", "beta") + " USING (rid))"
    compared = [*base, """
rows_in AS MATERIALIZED (SELECT row_number() OVER (ORDER BY "timestamp", uid, campaign) AS rid, *, split = 'train' AS train FROM split_log),
click_y AS MATERIALIZED (SELECT rid, click AS y FROM rows_in WHERE train)"""]
    compared += [_design("d", "rows_in", ["log_cost", "has_prev_click"], ["cat4"]), *_newton("beta", "d", "click_y")]
    compared += [_design("e", "rows_in", ["log_cost"], ["recency_bucket", "cat6"]), *_newton("gamma", "e", "click_y")]
    compared.append("\npred AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT '{name}' AS name, click, round(1e0 / (1e0 + exp(-m)), 9) AS s FROM rows_in JOIN {_margin(d, b)} USING (rid) WHERE split = 'test'"
        for name, d, b in (("cost", "d", "beta"), ("recency", "e", "gamma"))
    ) + ")")
    compared.append(f"\nmeasured AS MATERIALIZED ({_metrics('pred', 'click', 's', 'name')})")
    ranked = {"roc_auc": "DESC NULLS LAST", "pr_auc": "DESC NULLS LAST", "log_loss": "ASC", "brier_score": "ASC"}
    ranks = ", ".join(f"row_number() OVER (ORDER BY {c} {order}, name) AS rank_{c}" for c, order in ranked.items())
    rounded = """
scored AS MATERIALIZED (
  SELECT split, synthetic_treatment, synthetic_outcome, round(e, 9) AS e, round(m1 - m0, 9) AS o, round(m, 9) AS dr
  FROM rows_in JOIN (SELECT rid, e, m1, m0 FROM nuisances) USING (rid) JOIN """ + _margin("d", "tau") + """ USING (rid) WHERE split <> 'train')"""
    recursive = lambda ctes: ["RECURSIVE " + ctes[0], *ctes[1:]]
    return {
        "ridge_fit": _final(
            recursive([*uplift, given, *_ridge("beta", "d", "effect_y", "2e0")]),
            f"SELECT feature, {_five('coefficient')} FROM (SELECT feature, b AS coefficient FROM beta JOIN d_names USING (i))",
            "feature:s coefficient:d",
        ),
        "logistic_fit": _final(
            recursive(click),
            f"SELECT feature, {_five('coefficient')} FROM (SELECT feature, b AS coefficient FROM beta JOIN d_names USING (i))",
            "feature:s coefficient:d",
        ),
        "model_round_trip": _final(
            recursive(click),
            f"SELECT {TIME}, split, round(p, 5) AS score_before, round(p, 5) AS score_after "
            f"FROM (SELECT *, 1e0 / (1e0 + exp(-m)) AS p FROM rows_in JOIN {_margin('d', 'beta')} USING (rid))",
            KEY_COLUMNS + " split:s score_before:d score_after:d",
        ),
        "uplift_linear_scores": _final(
            recursive([*uplift, *fitted]),
            f"""SELECT {TIME}, split, round(e, 5) AS propensity_score, round(m1, 5) AS treated_outcome_score,
              round(m0, 5) AS control_outcome_score, round(m1 - m0, 5) AS observational_score, round(m, 5) AS doubly_robust_score
            FROM rows_in JOIN (SELECT rid, e, m1, m0 FROM nuisances) USING (rid) JOIN {_margin('d', 'tau')} USING (rid)""",
            KEY_COLUMNS + " split:s propensity_score:d treated_outcome_score:d control_outcome_score:d observational_score:d doubly_robust_score:d",
        ),
        "click_linear_metrics": _final(
            recursive([*click, pred]), _metrics("pred", "click", "s", "split"), "split:s " + METRIC_COLUMNS
        ),
        "click_linear_comparison": _final(
            recursive(compared),
            f"""SELECT name, model_type, {', '.join(_five(c) for c in ranked)}, {', '.join(f'rank_{c}' for c in ranked)},
              CASE WHEN rank_roc_auc = 1 THEN 1 ELSE 0 END AS is_best
            FROM (SELECT *, 'logistic_regression' AS model_type, {ranks} FROM measured)""",
            "name:s model_type:s roc_auc:d pr_auc:d log_loss:d brier_score:d rank_roc_auc:l rank_pr_auc:l rank_log_loss:l rank_brier_score:l is_best:l",
        ),
        "uplift_linear_evaluation": _final(
            recursive([*uplift, *fitted, rounded]),
            f"""SELECT split, "rows", {', '.join(_five(c) for c in ('positive_rate', 'avg_score', 'roc_auc', 'pr_auc', 'log_loss', 'brier_score',
                'treatment_rate', 'outcome_rate', 'score_correlation'))}
            FROM ({_metrics('scored', 'synthetic_treatment', 'e', 'split')}) JOIN (
              SELECT split, avg(synthetic_treatment) AS treatment_rate, avg(synthetic_outcome) AS outcome_rate, corr(o, dr) AS score_correlation
              FROM scored GROUP BY split) USING (split)""",
            "split:s " + METRIC_COLUMNS + " treatment_rate:d outcome_rate:d score_correlation:d",
        ),
        "stump_fit": _final(
            [*base, stump],
            """SELECT input, cut, round(gain, 5) AS gain, left_value, right_value,
              CASE WHEN row_number() OVER (ORDER BY gain DESC, k, cut) = 1 AND gain > 0 THEN 1 ELSE 0 END AS taken FROM splits""",
            "input:s cut:d gain:d left_value:d right_value:d taken:l",
        ),
        "one_hot": _final(
            [*base, holey, slots],
            f"SELECT {TIME}, array_to_string(list_filter([{listed}], lambda s: s IS NOT NULL), ',') AS slots FROM holey h",
            KEY_COLUMNS + " slots:s",
        ),
    }


WHOLE, ANY_NUMBER = "('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT')", "('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT', 'DOUBLE', 'FLOAT')"


def _verdicts() -> dict[str, str]:
    base = [LOG, FEATURES, SPLIT_LOG]

    def columns(copy: str, contract: str, expected: dict[str, str], casts: dict[str, str], lost: tuple[str, ...] = ()) -> list[str]:
        rows = []
        for name, kind in expected.items():
            kinds = {"integer": WHOLE, "numeric": ANY_NUMBER}.get(kind)
            found = f"typeof({casts.get(name, name)}) IN {kinds}" if kinds else "true"
            verdict = "'missing'" if name in lost else f"CASE WHEN (SELECT any_value({found}) FROM log) THEN 'ok' ELSE 'wrong type' END"
            rows.append(f"SELECT '{copy}' AS copy, '{contract}' AS contract, '{name}' AS \"column\", '{kind}' AS expected, {verdict} AS verdict")
        return rows

    source = {n: "numeric" if n in ("cost", "cpo") else "integer" for n in ["timestamp", "uid", "campaign", "click", "cost", "cpo", "time_since_last_click"] + [f"cat{i}" for i in range(1, 10)]}
    quoted = {"timestamp": '"timestamp"'}
    needed = {n: "any" for n in ("campaign", "click", "conversion", "click_pos", "click_nb", "cost", "cpo")}
    listed = columns("as given", "source", source, quoted)
    listed += columns("no campaign", "source", source, quoted, ("campaign",))
    listed += columns("fractional uid", "source", source, quoted | {"uid": "CAST(uid AS DOUBLE)"})
    listed += columns("cost as text", "source", source, quoted | {"cost": "CAST(cost AS VARCHAR)"})
    listed += columns("as given", "attribution", needed, {}) + columns("no path", "attribution", needed, {}, ("click_pos", "conversion"))
    verdict = lambda count, refusal: f"CASE WHEN {count} = 0 THEN 'ok' ELSE '{refusal}' END AS verdict"
    labels = """
labels_in AS (SELECT split, CASE WHEN cat7 = 3 THEN NULL WHEN cat6 = 2 AND split = 'test' THEN 2 ELSE click END AS click FROM split_log),
counted AS (SELECT split, count(*) FILTER (click IS NOT NULL AND click NOT IN (0, 1)) AS other, count(*) FILTER (click IS NULL) AS nulls FROM labels_in GROUP BY split)"""
    copies = {
        "as given": "SELECT click AS y, pred_score AS s FROM clicks",
        "holes": "SELECT click AS y, CASE WHEN cat4 <> 1 THEN pred_score END AS s FROM clicks",
        "other values": "SELECT click * 2 AS y, pred_score * 2 - 5e-1 AS s FROM clicks",
        "empty": "SELECT click AS y, pred_score AS s FROM clicks WHERE cost < 0",
    }
    calibration = "\ncounted AS (" + " UNION ALL ".join(
        f"""SELECT '{name}' AS copy, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS empty, count(*) FILTER (y IS NULL OR s IS NULL) AS nulls,
          count(*) FILTER (y NOT IN (0, 1)) AS labels, count(*) FILTER (s < 0 OR s > 1) AS scores FROM ({rows})"""
        for name, rows in copies.items()
    ) + ")"
    checks = {"rows": ("empty", "empty"), "nulls": ("nulls", "missing values"), "labels": ("labels", "not binary"), "scores": ("scores", "no probability")}
    asked = "(VALUES (7e-1, 1e-1), (8e-1, 0e0), (9e-1, 1e-1), (5e-1, 6e-1), (0e0, 1e-1), (6e-1, -1e-1)) AS f(a, b)"
    return {
        "column_verdicts": _final([LOG], " UNION ALL ".join(listed), "copy:s contract:s column:s expected:s verdict:s"),
        "label_verdicts": _final(
            [*base, labels],
            f"SELECT split, 'binary' AS \"check\", other AS violations, {verdict('other', 'not binary')} FROM counted "
            f"UNION ALL SELECT split, 'null', nulls, {verdict('nulls', 'missing')} FROM counted",
            "split:s check:s violations:l verdict:s",
        ),
        "calibration_verdicts": _final(
            [*base, CLICKS, calibration],
            " UNION ALL ".join(f"SELECT copy, '{n}' AS \"check\", {c} AS violations, {verdict(c, r)} FROM counted" for n, (c, r) in checks.items()),
            "copy:s check:s violations:l verdict:s",
        ),
        "overlap_verdicts": _final(
            [LOG, FEATURES, KNOWN],
            """SELECT *, CASE WHEN treated = 0 THEN 'no treated rows' WHEN control = 0 THEN 'no control rows' ELSE 'ok' END AS verdict
            FROM (SELECT split, count(*) FILTER (synthetic_treatment = 1) AS treated, count(*) FILTER (synthetic_treatment = 0) AS control
                  FROM uplift WHERE split <> 'validation' OR synthetic_treatment = 0 GROUP BY split)""",
            "split:s treated:l control:l verdict:s",
        ),
        "split_verdicts": _final(
            [LOG],
            f"""SELECT a AS train_fraction, b AS validation_fraction, verdict,
              CASE WHEN verdict = 'ok' THEN floor(n * a) END AS train_rows,
              CASE WHEN verdict = 'ok' THEN floor(n * (a + b)) - floor(n * a) END AS validation_rows,
              CASE WHEN verdict = 'ok' THEN n - floor(n * (a + b)) END AS test_rows
            FROM (SELECT *, CASE WHEN a <= 0 OR a >= 1 THEN 'train fraction out of range' WHEN b < 0 THEN 'validation fraction out of range'
                    WHEN a + b >= 1 THEN 'no test rows left' ELSE 'ok' END AS verdict
                  FROM {asked} CROSS JOIN (SELECT count(*) AS n FROM log))""",
            "train_fraction:d validation_fraction:d verdict:s train_rows:l validation_rows:l test_rows:l",
        ),
    }


def oracle_queries() -> dict[str, str]:
    return (
        _attribution() | _tables() | _features() | _encodings() | _evaluation() | _uplift() | _targeting() | _drift() | _fits() | _verdicts()
    )
