"""What a scan of a store needs, kept beside it: sums of each run and variable, written with their version and added on read.

    path/sums/version=V/...   a row for each folder (init_time, variable) that the version wrote

A row counts if the store's last state reads its folder from that version, so that upserts, drops and writes that die change
sums and cells together, and a scan reads a few numbers for each folder and no cells.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import catalog
from ..operators.quality import bounds_of
from . import storage, versions

SCHEMA = "init_time timestamp_ntz, variable string, n_cells long, n long, total double, low double, high double, outside long, version string"


def of_cells(cells: DataFrame) -> DataFrame:
    """(init_time, variable, n_cells, n, total, low, high, outside): mergeable sums of each folder's cells. outside: values beyond the parameter's limits, null for unknown parameters."""
    both = cells.join(F.broadcast(bounds_of(cells.sparkSession)), "variable", "left")
    beyond = F.count_if(~F.col("value").between(F.col("lo"), F.col("hi")))
    return both.groupBy("init_time", "variable").agg(
        F.count("*").alias("n_cells"), F.count("value").alias("n"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"), F.min("value").alias("low"), F.max("value").alias("high"), F.when(F.max("lo").isNotNull(), beyond).alias("outside"),
    )


def of_blocks(blocks: DataFrame, area: int | Column) -> DataFrame:
    """The same of block rows, whose arrays are summed one by one; area: the cells of an image, counted once for each image that has a block."""
    both = blocks.join(F.broadcast(bounds_of(blocks.sparkSession)), "variable", "left")
    each = both.select(
        "init_time", "variable", "n", F.col("lo"), F.aggregate("value", F.lit(0.0), lambda x, v: x + F.coalesce(v, F.lit(0.0))).alias("total"), F.array_min("value").alias("low"), F.array_max("value").alias("high"),
        F.size(F.filter("value", lambda v: ~v.between(F.col("lo"), F.col("hi")))).alias("beyond"), F.when((F.col("cy") == 0) & (F.col("cx") == 0), area).alias("area"),
    )
    return each.groupBy("init_time", "variable").agg(
        F.sum(F.coalesce("area", F.lit(0))).cast("long").alias("n_cells"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.when(F.max("lo").isNotNull(), F.sum("beyond")).alias("outside"),
    )


def kept(write: Callable[[DataFrame, str], None], path: str, sums: Callable[[DataFrame], DataFrame] = of_cells) -> Callable[[DataFrame, str], None]:
    """A write of versions that also writes their sums, for versions.put: the sums are there before a state names the version, and are read from what was written."""

    def both(rows: DataFrame, folder: str) -> None:
        write(rows, folder)
        version = folder.rsplit("version=", 1)[1]
        back = rows.sparkSession.read.schema(rows.schema).parquet(folder)
        sums(back).write.mode("overwrite").parquet(f"{path}/sums/version={version}")  # a row for each folder of one write

    return both


def publish(cells: DataFrame, path: str, version: str | None = None) -> str:
    """As versions.publish, with sums."""
    return versions.put(cells, path, kept(storage.write, path), True, version)


def upsert(pieces: DataFrame, path: str, version: str | None = None) -> str:
    """As versions.upsert, with sums: those of folders that no piece touches stay as they are."""
    return versions.upsert(pieces, path, version, kept(storage.write, path))


def found(spark: SparkSession, path: str) -> DataFrame:
    """The sums of the folders that the last state reads; empty where there is no store. Folder names come to the driver, as in versions.found."""
    state = versions.folders(spark, path)
    live = spark.createDataFrame(state, "init_time timestamp_ntz, variable string, version string")
    if not state:
        return spark.createDataFrame([], SCHEMA).drop("version")
    named = sorted({v for _, _, v in state})
    rows = spark.read.schema(SCHEMA).option("basePath", f"{path}/sums").parquet(*(f"{path}/sums/version={v}" for v in named))
    return rows.join(F.broadcast(live), ["init_time", "variable", "version"], "left_semi").drop("version")


def scan(sums: DataFrame) -> DataFrame:
    """(variable, mean, n, has_nulls, outside_share, is_valid), as quality.scan has them of cells; parameters that aren't known have null shares and count as not valid."""
    facts = sums.groupBy("variable").agg(F.sum("n_cells").alias("n_cells"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("outside").alias("outside"))
    share = F.when(F.col("n") > 0, F.col("outside") / F.col("n"))
    return facts.select("variable", F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean"), "n", (F.col("n") < F.col("n_cells")).alias("has_nulls"), share.alias("outside_share"), F.coalesce(share <= catalog.THRESHOLD, F.lit(False)).alias("is_valid"))


def store_mean(sums: DataFrame) -> DataFrame:
    """(store_mean, n) of all values of a store."""
    return sums.agg((F.sum("total") / F.sum("n")).alias("store_mean"), F.sum("n").alias("n"))
