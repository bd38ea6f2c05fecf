"""Data contracts and quality checks.

Column checks read only the schema. Value checks give a table of violations from bounded aggregates;
`require` turns the first violation into an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The source contract of the event log (column -> kind) and its smallest allowed values.
SOURCE_CONTRACT = {
    "timestamp": "integer", "uid": "integer", "campaign": "integer", "click": "integer", "cost": "numeric",
    "cpo": "numeric", "time_since_last_click": "integer", "cat1": "integer", "cat2": "integer",
    "cat3": "integer", "cat4": "integer", "cat5": "integer", "cat6": "integer", "cat7": "integer",
    "cat8": "integer", "cat9": "integer",
}
SOURCE_MINIMUMS = {
    "timestamp": 0, "cost": 0, "cpo": 0, "time_since_last_click": -1, "campaign": 0, "cat1": 0, "cat2": 0,
    "cat3": 0, "cat4": 0, "cat5": 0, "cat6": 0, "cat7": 0, "cat8": 0, "cat9": 0,
}
ROW_KEY = ("uid", "timestamp", "campaign")

_KINDS = {"integer": T.IntegralType, "numeric": T.NumericType}

VIOLATION_SCHEMA = "check string, column string, violations long, observed_min double"


def check_columns(df: DataFrame, contract: Mapping[str, str], *, schema_name: str) -> None:
    """Raise when a contract column is missing or has another kind of type; further columns are allowed."""
    missing = [name for name in contract if name not in df.columns]
    if missing:
        raise ValueError(f"{schema_name} is missing required columns: {missing}")
    wrong = [
        f"{name} expected {kind}, found {df.schema[name].dataType.simpleString()}"
        for name, kind in contract.items()
        if not isinstance(df.schema[name].dataType, _KINDS[kind])
    ]
    if wrong:
        raise ValueError(f"wrong column types in the {schema_name}: {wrong}")


def training_contract(
    *, label_col: str, timestamp_col: str, numeric_features: Sequence[str], categorical_features: Sequence[str]
) -> dict[str, str]:
    """Contract of a training table; a name listed twice keeps its first kind."""
    contract = {timestamp_col: "integer"}
    for names, kind in (([label_col], "integer"), (numeric_features, "numeric"), (categorical_features, "integer")):
        for name in names:
            contract.setdefault(name, kind)
    return contract


def _not_binary(name: str) -> Column:
    return F.count_if(F.col(name).isNotNull() & ~F.col(name).isin(0, 1))


def check_binary_label(df: DataFrame, label_col: str) -> None:
    """Raise with the number of offending rows and the range of their values, all from one aggregate."""
    value = F.col(label_col)
    bad = F.when(value.isNotNull() & ~value.isin(0, 1), value)
    found = df.agg(F.count(bad).alias("rows"), F.min(bad).alias("least"), F.max(bad).alias("most")).first()
    if found["rows"]:
        raise ValueError(
            f"{label_col} must be binary with values in {{0, 1}}; "
            f"found {found['rows']} other rows from {found['least']} to {found['most']}"
        )


def check_source_schema(df: DataFrame) -> None:
    check_columns(df, SOURCE_CONTRACT, schema_name="baseline source")
    check_binary_label(df, "click")


def check_training_table(df: DataFrame, *, split_col: str | None = None, **columns) -> None:
    """Contract and label check of a training table; with `split_col`, one pass covers every split."""
    check_columns(df, training_contract(**columns), schema_name="baseline training")
    if split_col is None:
        check_binary_label(df, columns["label_col"])
        return
    rows = df.groupBy(split_col).agg(_not_binary(columns["label_col"]).alias("bad")).collect()
    bad = sorted(str(row[split_col]) for row in rows if row["bad"])
    if bad:
        raise ValueError(f"{columns['label_col']} must be binary with values in {{0, 1}}; wrong in {bad}")


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows beyond the first of every group equal on `columns` (null equals null), as one row `duplicates`."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"))


def _duplicate_rows(df: DataFrame, key: Sequence[str]) -> int:
    """Fully equal rows beyond the first, counted among the rows whose key repeats: only those are shuffled whole."""
    repeated = df.groupBy(*key).count().filter(F.col("count") > 1).select(*[F.col(n).alias(f"__{n}") for n in key])
    same = reduce(Column.__and__, [F.col(f"`{n}`").eqNullSafe(F.col(f"__{n}")) for n in key])
    return duplicate_count(df.join(repeated, same, "left_semi"), df.columns).first()["duplicates"]


def quality_violations(
    df: DataFrame,
    *,
    required: Sequence[str] = tuple(SOURCE_CONTRACT),
    key: Sequence[str] = ROW_KEY,
    minimums: Mapping[str, float] = SOURCE_MINIMUMS,
    binary: Sequence[str] = ("click",),
) -> DataFrame:
    """One row per check and column: (check, column, violations, observed_min).

    Nulls, minimums and labels come from a single aggregate. Fully equal rows are equal on the key, so the
    wide duplicate count over all columns runs only when the narrow key count found any, on those rows.
    """
    spark = df.sparkSession
    measures = {f"null|{name}": F.count_if(F.col(name).isNull()) for name in required}
    for name, low in minimums.items():
        measures[f"below|{name}"] = F.count_if(F.col(name) < low)
        measures[f"min|{name}"] = F.min(F.col(name)).cast("double")
    measures |= {f"binary|{name}": _not_binary(name) for name in binary}
    found = df.agg(*[column.alias(name) for name, column in measures.items()]).first().asDict()
    same_key = duplicate_count(df, key).first()["duplicates"]
    same_row = _duplicate_rows(df, key) if same_key else 0
    rows = [("null", name, found[f"null|{name}"], None) for name in required]
    rows += [("duplicate_row", "*", same_row, None), ("duplicate_key", ",".join(key), same_key, None)]
    rows += [("minimum", name, found[f"below|{name}"], found[f"min|{name}"]) for name in minimums]
    rows += [("binary", name, found[f"binary|{name}"], None) for name in binary]
    return spark.createDataFrame(rows, VIOLATION_SCHEMA)


def contract_report(violations: DataFrame) -> DataFrame:
    """(check, column, verdict): `ok` or `violated`, without raising."""
    verdict = F.when(F.col("violations") == 0, "ok").otherwise("violated")
    return violations.select("check", "column", verdict.alias("verdict"))


def require(violations: DataFrame, *, minimums: Mapping[str, float] = SOURCE_MINIMUMS) -> None:
    """Raise for the first kind of violation found: nulls, duplicate rows, duplicate keys, then minimums."""
    found = [row for row in violations.collect() if row["violations"]]
    nulls = [row["column"] for row in found if row["check"] == "null"]
    if nulls:
        raise ValueError(f"values are missing: nulls in required columns: {nulls}")
    for row in found:
        if row["check"] == "duplicate_row":
            raise ValueError(f"the log contains {row['violations']} fully duplicated rows")
    for row in found:
        if row["check"] == "duplicate_key":
            name = row["column"].replace(",", "/")
            raise ValueError(f"rows beyond the first with duplicate {name} keys: {row['violations']}")
    for row in found:
        if row["check"] == "minimum":
            raise ValueError(
                f"lower limit broken: {row['column']} must be >= {minimums[row['column']]}; "
                f"found minimum {row['observed_min']}"
            )
    for row in found:
        raise ValueError(f"{row['column']} must be binary with values in {{0, 1}}")


def check_source(df: DataFrame) -> None:
    """Full source gate: schema, label, nulls, duplicates, minimums."""
    check_source_schema(df)
    require(quality_violations(df))


def check_fraction(value: float, *, name: str, below: float | None = None) -> None:
    """0 < value <= 1, or 0 < value < below."""
    inside = 0 < value < below if below is not None else 0 < value <= 1
    if not inside:
        raise ValueError(f"{name} must be between 0 and {below if below is not None else 1}")


def check_present(df: DataFrame, columns: Sequence[str], message: str) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{message}: {missing}")


def check_overlap(df: DataFrame, treatment_col: str) -> None:
    """Both treated and control rows must exist."""
    counts = df.agg(
        F.count_if(F.col(treatment_col) == 1).alias("treated"), F.count_if(F.col(treatment_col) == 0).alias("control")
    ).first()
    if not counts["treated"] or not counts["control"]:
        raise ValueError("no uplift without both treated and control rows")


def check_scored(df: DataFrame, label_col: str, score_col: str) -> None:
    """No row may lack a label or a score: such a row has no place in a metric."""
    label, score = F.col(label_col).cast("double"), F.col(score_col).cast("double")
    found = df.agg(
        F.count_if(label.isNull() | F.isnan(label)).alias("labels"), F.count_if(score.isNull() | F.isnan(score)).alias("scores")
    ).first()
    if found["labels"]:
        raise ValueError(f"{found['labels']} rows have no value in the label column {label_col}")
    if found["scores"]:
        raise ValueError(f"{found['scores']} rows have no value in the score column {score_col}")


def check_calibration_input(df: DataFrame, label_col: str, score_col: str, *, frame_name: str) -> None:
    """Non-empty, no nulls, labels 0/1 and scores within [0, 1], in one aggregate."""
    label, score = F.col(label_col).cast("double"), F.col(score_col).cast("double")
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(label.isNull() | score.isNull()).alias("nulls"),
        F.count_if(~label.isin(0.0, 1.0)).alias("labels"),
        F.count_if((score < 0.0) | (score > 1.0)).alias("scores"),
    ).first()
    if not found["rows"]:
        raise ValueError(f"no rows to calibrate on in {frame_name}")
    if found["nulls"]:
        raise ValueError(f"{found['nulls']} rows without label or score in {frame_name}")
    if found["labels"]:
        raise ValueError(f"{found['labels']} labels other than 0 and 1 in {frame_name}")
    if found["scores"]:
        raise ValueError(f"{found['scores']} scores in {frame_name} do not lie between 0 and 1")
