"""Models, their schedules and what sources offer of them."""

from __future__ import annotations

import json
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import catalog
from ..sources.tables import hours
from .axes import box_rule


def run_hours_of(moments: DataFrame) -> DataFrame:
    """(hour, n_runs) of run times."""
    return moments.groupBy(F.hour("init_time").alias("hour")).agg(F.count("*").alias("n_runs"))


def month_runs(months: DataFrame, run_hours: list[int], month: str = "month") -> DataFrame:
    """Every run time of each month: all days by all running hours."""
    day = F.explode(F.sequence(F.col(month).cast("date"), F.last_day(month), F.expr("interval 1 day")))
    days = months.select(month, day.alias("day"))
    return days.select(month, F.explode(F.array(*map(F.lit, run_hours))).alias("h"), "day").select(month, (F.col("day").cast("timestamp_ntz") + hours(F.col("h"))).alias("init_time"))


def latest_run(moment: Column, run_hours: list[int], delay_minutes: int) -> Column:
    """The newest run that is out at a moment; null without running hours."""
    hour = F.date_trunc("hour", moment.cast("timestamp_ntz"))
    cutoff = F.date_trunc("hour", hour - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(delay_minutes))).cast("timestamp_ntz")
    day = F.date_trunc("day", cutoff).cast("timestamp_ntz")
    ready = [F.when(day + hours(h - 24 * back) <= cutoff, day + hours(h - 24 * back)) for h in run_hours for back in (0, 1)]
    return F.greatest(*ready) if ready else F.lit(None).cast("timestamp_ntz")


def latest_of(moments: DataFrame, run_hours: list[int], delay_minutes: int, moment: str = "now") -> DataFrame:
    return moments.select(latest_run(F.col(moment), run_hours, delay_minutes).alias("init_time")).where("init_time is not null").distinct()


def wanted_runs(spark: SparkSession, period: datetime | date | None, now: datetime, run_hours: list[int], delay_minutes: int) -> DataFrame:
    """The run times (init_time) that a period asks for: none the latest that is out by `now`, a time that run, a date the runs of its month.

    A time's zone is put to UTC as it stands, not converted.
    """
    plain = lambda t: t.replace(tzinfo=None)
    if isinstance(period, datetime):  # before date, which a datetime is too
        return spark.createDataFrame([(plain(period),)], "init_time timestamp_ntz")
    if isinstance(period, date):
        return month_runs(spark.createDataFrame([(datetime(period.year, period.month, 1),)], "month timestamp_ntz"), run_hours).select("init_time")
    return latest_of(spark.createDataFrame([(plain(now),)], "now timestamp_ntz"), run_hours, delay_minutes)


def model_axes(models: DataFrame) -> DataFrame:
    """(model, dim, idx, num, str) of all models: every tick of every axis but the run's, from first ticks, steps and counts."""
    labels = lambda d, c: models.select("model", F.lit(d).alias("dim"), F.posexplode(c).alias("idx", "str")).select("model", "dim", "idx", F.lit(None).cast("double").alias("num"), "str")
    numbers = lambda d, c, rows=models: rows.select("model", F.lit(d).alias("dim"), F.posexplode(c).alias("idx", "num")).select("model", "dim", "idx", F.col("num").cast("double").alias("num"), F.lit(None).cast("string").alias("str"))
    whole = lambda c: F.flatten(F.transform(c, lambda r: F.transform(F.sequence(F.lit(0), r["n"] - 1), lambda i: r["first"] + r["by"] * i)))
    degrees = lambda c: F.transform(whole(c), lambda v: F.bround(v / 1000000, 4))
    parts = [
        numbers("step", F.sequence("first_step", "last_step", "step_by")), labels("variable", "variables"), labels("ensemble_stat", "stats"),
        numbers("ensemble_member", F.sequence(F.lit(1), "members"), models.where("members > 0")),
    ]
    for grid, y, x, ticks in (("latlon", "latitude", "longitude", degrees), ("osgb", "y_osgb", "x_osgb", whole), ("laea", "y_laea", "x_laea", whole)):
        own = models.where(F.col("grid") == grid)
        parts += [numbers(y, ticks("y_runs"), own), numbers(x, ticks("x_runs"), own)]
    return reduce(DataFrame.unionByName, parts)


def effective(offered: DataFrame, models: DataFrame) -> DataFrame:
    """Offered models after each source's changes: hours, delay, extra parameters (sorted in, not made unique), steps, and block counts.

    A source's own map of block counts takes the place of the model's, whose is empty; `idle_counts` names those of
    dimensions that the model doesn't have, which change nothing.
    """
    both = offered.join(models, "model")
    last = F.coalesce(F.least("last_step", "max_step"), "last_step")
    pair = F.when(F.col("grid") == "latlon", F.array(F.lit("latitude"), F.lit("longitude"))).otherwise(F.array(F.concat(F.lit("y_"), "grid"), F.concat(F.lit("x_"), "grid")))
    dims = F.concat(F.array(F.lit("init_time"), F.lit("step"), F.lit("variable")), F.when(F.size("stats") > 0, F.array(F.lit("ensemble_stat"))).otherwise(F.array()), F.when(F.col("members") > 0, F.array(F.lit("ensemble_member"))).otherwise(F.array()), pair)
    counts = F.coalesce("block_counts", F.map_from_entries(F.array().cast("array<struct<k:string,v:int>>")))
    return both.select(
        "source", "offered", "model", "region", F.coalesce("own_hours", "hours").alias("hours"), F.coalesce("own_delay", "delay").alias("delay"),
        F.sort_array(F.concat("variables", "extra")).alias("variables"), F.size(F.filter(F.sequence("first_step", "last_step", "step_by"), lambda s: s <= last)).alias("n_steps"),
        counts.alias("block_counts"), F.array_except(F.map_keys(counts), dims).alias("idle_counts"),
    )


def axis_length(runs: str) -> Column:
    return F.aggregate(runs, F.lit(0), lambda n, r: n + r["n"])


def named_regions(asked: DataFrame, models: DataFrame, regions: DataFrame) -> DataFrame:
    """(model, region, name, ny, nx, rule) of models cropped to regions; asked: (model, region).

    An unknown region leaves the model as it is, with the rule `unknown region`; a box that can't be cut out of the
    model's grid leaves ny and nx null and says why.
    """
    grid = asked.select("model").distinct().join(model_axes(models), "model").where(F.col("dim").isin("latitude", "longitude", "y_osgb", "x_osgb", "y_laea", "x_laea"))
    there = asked.join(models.select("model", F.col("name").alias("_name")), "model").join(F.broadcast(regions), "region", "left")
    is_y = F.col("dim").isin("latitude", "y_osgb", "y_laea")
    within = F.when(F.col("north").isNull(), True).when(F.col("dim") == "latitude", F.col("num").between(F.col("south"), F.col("north"))).when(F.col("dim") == "longitude", F.col("num").between(F.col("west"), F.col("east")))
    edge = lambda f, d: f(F.when(F.col("dim") == d, F.col("num")))
    facts = there.join(grid, "model").groupBy("model", "region", "_name", "suffix", "north", "west", "south", "east").agg(
        F.count_if(is_y & within).alias("ny"), F.count_if(~is_y & within).alias("nx"), edge(F.max, "latitude").alias("_n"), edge(F.min, "longitude").alias("_w"), edge(F.min, "latitude").alias("_s"), edge(F.max, "longitude").alias("_e"),
    )
    rule = F.when(F.col("north").isNull(), "unknown region").otherwise(box_rule(tuple(map(F.col, ("north", "west", "south", "east"))), tuple(map(F.col, ("_n", "_w", "_s", "_e")))))
    cut = F.col("north").isNotNull() & rule.isNotNull()
    return facts.select(
        "model", "region", F.when(F.col("north").isNull() | cut, F.col("_name")).otherwise(F.concat("_name", F.lit("_"), "suffix")).alias("name"),
        F.when(~cut, F.col("ny").cast("int")).alias("ny"), F.when(~cut, F.col("nx").cast("int")).alias("nx"), rule.alias("rule"),
    )


def crs_label(grid: str) -> Column:
    """The name of a grid's coordinate system; null for unknown grids."""
    return F.element_at(F.create_map(*[F.lit(x) for k, v in catalog.CRS.items() for x in (k, next(iter(v)))]), F.col(grid))


def crs_values(grid: str) -> Column:
    """A grid's coordinate system with all its values, as JSON."""
    return F.element_at(F.create_map(*[F.lit(x) for k, v in catalog.CRS.items() for x in (k, json.dumps(v))]), F.col(grid))


def crs_flag(grid: str) -> Column:
    """What is known to be wrong with a coordinate system that is carried as given."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in catalog.CRS_FLAGS.items() for x in pair]), F.col(grid))
