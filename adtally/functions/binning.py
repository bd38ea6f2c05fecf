"""Bin numbers by binary search. A long chain of comparisons would exceed what the JVM compiles; this does not."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_interval(df: DataFrame, columns: Mapping[str, tuple[Column, Sequence[float]]]) -> DataFrame:
    """Add, per output name, the number of starts at or below the value (0 below the first); null for null.

    `columns` maps an output name to (value, strictly increasing finite interval starts).
    """
    searched = {name: item for name, item in columns.items() if len(item[1])}
    work = {name: f"{name}_value" for name in searched}
    # Adding zero turns -0.0 into 0.0, which the search would otherwise place below 0.0.
    wide = df.withColumns({work[name]: value.cast("double") + 0.0 for name, (value, _) in searched.items()})
    found = {name: f"{name}_found" for name in searched}
    if searched:
        wide = Bucketizer(
            inputCols=list(work.values()),
            outputCols=list(found.values()),
            splitsArray=[[-math.inf, *starts, math.inf] for _, starts in searched.values()],
            handleInvalid="keep",
        ).transform(wide)
    numbered = {
        name: F.when(value.isNotNull(), F.col(found[name]).cast("int") if name in searched else F.lit(0))
        for name, (value, _) in columns.items()
    }
    return wide.withColumns(numbered).drop(*work.values(), *found.values())


def with_right_closed_bin(df: DataFrame, columns: Mapping[str, tuple[Column, Sequence[float]]]) -> DataFrame:
    """Add, per output name, the 0-based right-closed bin: the number of inner edges below the value."""
    return with_interval(
        df,
        {
            name: (value, [math.nextafter(edge, math.inf) for edge in edges])
            for name, (value, edges) in columns.items()
        },
    )
