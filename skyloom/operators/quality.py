"""Checks over stores: what is missing, what is out of range, which runs pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import catalog
from . import axes
from .errors import errors
from .layout import layout_of


def missing_share(expected: DataFrame, cells: DataFrame, area: int | Column) -> DataFrame:
    """expected images with `share`, the part of their area cells that no cell has; images without any cell or area lack it all.

    An image is what the cells' layout says: of a run, step and variable, and of a statistic or member where they have one.
    """
    have = cells.where("value is not null").groupBy(*layout_of(cells.columns).image).agg(F.count("*").alias("_n"))
    return _shares(expected, have, area)


def blocks_missing_share(expected: DataFrame, blocks: DataFrame, area: int | Column) -> DataFrame:
    """As missing_share, of a store of blocks: their counts are read, their values aren't."""
    return _shares(expected, blocks.groupBy(*layout_of(blocks.columns).image).agg(F.sum("n").alias("_n")), area)


def _shares(expected: DataFrame, have: DataFrame, area: int | Column) -> DataFrame:
    image = layout_of(have.columns).image
    size = area if isinstance(area, Column) else F.lit(area)
    share = F.when(size > 0, 1.0 - F.coalesce("_n", F.lit(0)) / size).otherwise(1.0)
    return expected.join(have, image, "left").select(*image, share.alias("share"))


def dense_missing_share(values: str) -> Column:
    """The part of an image array that is null; 1 for an empty one and for none."""
    n = F.size(values)
    return F.when(n > 0, F.size(F.filter(values, lambda x: x.isNull())) / n).otherwise(1.0)


def verdict(shares: DataFrame, by: list[str], of_image: float = 0.05, of_images: float = 0.02) -> DataFrame:
    """(by, n_images, bad_images, ok): a store passes unless more than of_images of its images lack more than of_image."""
    facts = shares.groupBy(*by).agg(F.count("*").alias("n_images"), F.count_if(F.col("share") > of_image).alias("bad_images"))
    return facts.select(*by, "n_images", "bad_images", (F.col("bad_images") / F.col("n_images") <= of_images).alias("ok"))


def corner(cells: DataFrame, axis: DataFrame) -> DataFrame:
    """Cells at the first two ticks of every dimension of the axis but the run; each dimension's two ticks are a semi-join's small side."""
    for d in [x for x in axes.DIMS[1:] if axes.column_of(x) in cells.columns]:
        first = axis.where((F.col("dim") == d) & (F.col("idx") < 2)).select(F.col("str" if d in axes.LABELS else "num").alias("_tick"))
        cells = cells.join(F.broadcast(first), axes.tick_of(d) == F.col("_tick"), "left_semi")
    return cells


def missing_runs(runs: DataFrame, cells: DataFrame, axis: DataFrame) -> DataFrame:
    """Runs of whose corner (the first two ticks of every other axis) no cell is there."""
    have = corner(cells.where("value is not null"), axis).select("init_time").distinct()
    return runs.join(have, "init_time", "left_anti").select("init_time")


def bounds_of(spark: SparkSession) -> DataFrame:
    """(variable, lo, hi): the limits of all parameters, those given the wrong way round turned."""
    return catalog.parameters(spark).select("variable", F.least("lower", "upper").alias("lo"), F.greatest("lower", "upper").alias("hi"))


def scan(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(variable, mean, n, has_nulls, outside_share, is_valid) for every parameter that occurs, judged by its limits; and error rows of unknown ones.

    Limits given the wrong way round (wind direction) count as turned.
    """
    both = cells.join(F.broadcast(bounds_of(cells.sparkSession)), "variable", "left")
    facts = both.groupBy("variable").agg(
        F.avg("value").alias("mean"), F.count("value").alias("n"), (F.count_if(F.col("value").isNull()) > 0).alias("has_nulls"), F.count_if(~F.col("value").between(F.col("lo"), F.col("hi"))).alias("outside"), F.max("lo").alias("lo"),
    )
    share = F.when(F.col("n") > 0, F.col("outside") / F.col("n"))
    found = facts.where("lo is not null").select("variable", "mean", "n", "has_nulls", share.alias("outside_share"), F.coalesce(share <= catalog.THRESHOLD, F.lit(False)).alias("is_valid"))
    return found, errors(facts.where("lo is null"), "scan", "unknown parameter", None, None, "variable")


def axis_diff(stored: DataFrame, expected: DataFrame, by: str | None = None) -> DataFrame:
    """Where two axis tables differ: (by, dim, idx, stored, expected), ticks as text. With `by` every group's axes are held against the expected ones."""
    tick = F.coalesce("str", F.format_string("%.4f", "num"))
    a, b = stored.select(*([by] if by else []), "dim", "idx", tick.alias("stored")), expected.select("dim", "idx", tick.alias("expected"))
    if by:
        b = stored.select(by).distinct().crossJoin(F.broadcast(b))  # an axis for each group, as each has one
    keys = [by, "dim", "idx"] if by else ["dim", "idx"]
    return a.join(b, keys, "full").where(~F.col("stored").eqNullSafe(F.col("expected"))).select(*keys, "stored", "expected")


def outcome(runs: DataFrame, pieces: DataFrame, run: str, tolerance: float = 0.06, shown: int = 5) -> DataFrame:
    """(run, n, n_failed, bytes, ok, rule, sample) of the ingest results of each run; pieces: (run, url, failed, bytes).

    ok unless more than the tolerance failed; rule says why not: `no pieces`, or `too many failures`. sample: the urls of
    the first failures, `shown` at most.
    """
    facts = pieces.groupBy(run).agg(F.count("*").alias("n"), F.count_if("failed").alias("n_failed"), F.sum(F.when(~F.col("failed"), F.col("bytes")).otherwise(0)).alias("bytes"))
    first = pieces.where("failed").withColumn("_n", F.row_number().over(W.partitionBy(run).orderBy("url"))).where(F.col("_n") <= shown)
    first = first.groupBy(run).agg(F.array_join(F.sort_array(F.collect_list("url")), " ").alias("sample"))
    both = runs.select(run).distinct().join(facts, run, "left").join(first, run, "left")
    rule = F.when(F.col("n").isNull(), "no pieces").when(F.col("n_failed") / F.col("n") > tolerance, "too many failures")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return both.select(run, zero("n"), zero("n_failed"), zero("bytes"), rule.isNull().alias("ok"), rule.alias("rule"), F.coalesce("sample", F.lit("")).alias("sample"))
