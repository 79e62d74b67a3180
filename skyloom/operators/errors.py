"""Failures as rows: what went wrong in which run and file, at which stage, against which rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "run timestamp_ntz, url string, stage string, rule string, detail string"


def errors(rows: DataFrame, stage: str, rule: str | Column, run: str | None = None, url: str | Column | None = None, detail: str | Column | None = None) -> DataFrame:
    """One error row (run, url, stage, rule, detail) for each row; `rule` is a name or a column, run and url name columns."""
    none = F.lit(None)
    column = lambda x: none if x is None else (x if isinstance(x, Column) else F.col(x))
    return rows.select(
        column(run).cast("timestamp_ntz").alias("run"), column(url).cast("string").alias("url"), F.lit(stage).alias("stage"),
        (rule if isinstance(rule, Column) else F.lit(rule)).cast("string").alias("rule"), column(detail).cast("string").alias("detail"),
    )


def together(*parts: DataFrame) -> DataFrame:
    """All error rows of several stages."""
    return reduce(DataFrame.unionByName, parts)
