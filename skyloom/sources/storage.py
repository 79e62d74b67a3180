"""Stores: cells in Parquet folders by run and variable, written piece by piece and read back."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import axes
from ..operators.errors import SCHEMA, errors
from ..operators.layout import layout_of

#: The keys of cells on a grid of degrees without members.
KEYS = ["init_time", "step", "variable", "lat_e4", "lon_e4"]
ABOUT = "model string, attributes map<string, string>"


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which all executors see. Without the setting only a session on one machine goes on, in a folder there."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_open = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What kept() writes inside is deleted at the end, also after a failure."""
    outer, _open.paths = getattr(_open, "paths", None), []
    try:
        yield
    finally:
        mine, _open.paths = _open.paths, outer
        for path in mine:
            remove(spark, path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to shared storage and read back, until the end of the scratch() it is in: later stages, and executors that are lost, don't run it again."""
    path = new_path(df.sparkSession, name)
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the queries that run inside; then it is put back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def write_folders(rows: DataFrame, path: str, parts: list[str], order: list[Column | str], **options: str) -> None:
    """Writes whole folders, in some order inside; others at the path stay.

    Large folders are written by several tasks, as Spark finds their sizes. Partitions aren't put together: a folder lies in
    one anyway, so that this would make no fewer files, but one task open those of hundreds of small folders in turn.
    """
    spark = rows.sparkSession
    spread = spark.sql(f"select /*+ rebalance({', '.join(parts)}) */ * from {{rows}}", rows=rows)
    with setting(spark, COALESCE, "false"):
        spread.sortWithinPartitions(*parts, *order).write.mode("overwrite").options(partitionOverwriteMode="dynamic", **options).partitionBy(*parts).parquet(path)


def write(cells: DataFrame, path: str) -> None:
    """Writes whole folders (run and variable), in canonical order inside, members and statistics one after another; others at the path stay."""
    layout = layout_of(cells.columns)
    write_folders(cells, path, layout.parts, layout.order)


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    """The store's cells; with its schema given no file is opened to infer one."""
    return spark.read.schema(schema).parquet(path)


def found(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """What is stored at a path, or None if there is nothing."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def create(spark: SparkSession, path: str, model: str, runs: DataFrame, axis: DataFrame, known: list[str], attributes: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A store for a model's runs at path, or the one that is there: (expected images, about, errors).

    axis: the model's (dim, idx, num, str) without runs. Images are those of all runs that the store is asked to hold, old
    ones included; about has (model, reused, size_kb): 0 for a new store, the whole logical size for one that is used again.
    No runs, a store of another model, and axes that don't come back whole give an error row and no images. The skeleton
    is kept beside the cells, at path + ".images" and ".about".
    """
    empty = spark.createDataFrame([], SCHEMA)
    kept, old = found(spark, f"{path}.about"), None
    whole = runs.select("init_time").distinct().withColumn("_all", F.lit(0))
    if not whole.limit(1).count():
        return _no_images(spark), _about(spark, model, False, 0), _failure(spark, path, "no runs")
    if kept is not None:
        name = kept.first()["model"]
        if name != model:
            return _no_images(spark), _about(spark, model, True, 0), _failure(spark, path, "different model", name)
        old = found(spark, f"{path}.images")
    run_axis = axes.ordered(axes.ticks(whole.select("init_time")))
    images = axes.skeleton(axis.where("dim <> 'init_time'").select("dim", "idx", "num", "str").unionByName(run_axis).withColumn("_all", F.lit(0)), "_all")
    images = images.select(F.timestamp_seconds("init_seconds").cast("timestamp_ntz").alias("init_time"), "step", "variable", "ensemble_stat", "ensemble_member", "area")
    new = images if old is None else images.join(old.select("init_time").distinct(), "init_time", "left_anti")
    new.write.mode("append").parquet(f"{path}.images")
    if kept is None:
        spark.createDataFrame([(model, attributes or {})], ABOUT).coalesce(1).write.parquet(f"{path}.about")
    back = spark.read.schema(images.schema).parquet(f"{path}.images")
    held = axes.ticks(back.withColumn("_all", F.lit(0)), ("_all",)).unionByName(axis.where(F.col("dim").isin(axes.SPACE)).select(F.lit(0).alias("_all"), "dim", "num", "str"))
    breach = axes.validate(axes.ordered(held, ("_all",)), "_all", known).where("breach is not null")
    size = back.agg(F.coalesce(F.sum("area"), F.lit(0))).first()[0] * 4 // 1024 if kept is not None else 0
    return back, _about(spark, model, kept is not None, size), empty.unionByName(errors(breach, "store", F.col("breach"), None, F.lit(path)))


def _no_images(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "init_time timestamp_ntz, step int, variable string, ensemble_stat string, ensemble_member int, area long")


def _about(spark: SparkSession, model: str, reused: bool, size_kb: int) -> DataFrame:
    return spark.createDataFrame([(model, reused, int(size_kb))], "model string, reused boolean, size_kb long")


def _failure(spark: SparkSession, path: str, rule: str, detail: str | None = None) -> DataFrame:
    return spark.createDataFrame([(None, path, "store", rule, detail)], SCHEMA)


def upsert(store: DataFrame, pieces: DataFrame, path: str, order: str = "seq") -> DataFrame:
    """The store at path after writing pieces: of equal cells the last written one wins, and only touched folders are written.

    store: cells with `order`; pieces: the same columns. Cells are equal if they are in all dimensions that they have. Of
    equal cells with the same order the greatest values stay. Folders are overwritten in place; versions.upsert leaves
    readers the old ones.
    """
    layout = layout_of(store.columns)
    rest = [c for c in store.columns if c not in (*layout.keys, order)]
    touched = pieces.select(*layout.parts).distinct()
    old = store.join(touched, layout.parts, "left_semi")
    last = old.unionByName(pieces).groupBy(*layout.keys).agg(F.max(F.struct(order, *rest)).alias("_last"))
    with scratch(store.sparkSession):
        staged = kept(last.select(*layout.keys, "_last.*").select(*store.columns), "staged")  # what is overwritten must not be read at the same time
        write(staged, path)
    return read(store.sparkSession, path, store.schema)


def folder(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path there."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes what is at a path, with all below it. False if there was nothing."""
    fs, place = folder(spark, path)
    return fs.delete(place, True)


def drop_store(spark: SparkSession, path: str) -> None:
    """Deletes a store, its skeleton too."""
    for end in ("", ".images", ".about"):
        remove(spark, path + end)


def drop_runs(spark: SparkSession, path: str, runs: DataFrame) -> int:
    """Deletes the folders of some runs (init_time); nothing else is read or written. The number of folders that went.

    Run times come to the driver: at most as many as the store has folders.
    """
    fs, place = folder(spark, path)
    if not fs.exists(place):
        return 0
    gone = {str(r.init_time) for r in runs.select("init_time").distinct().collect()}
    mine = [f.getPath() for f in fs.listStatus(place) if unquote(f.getPath().getName()).removeprefix("init_time=") in gone]
    return sum(fs.delete(f, True) for f in mine)


def size_kb(n_values: Column, bytes_each: int = 4) -> Column:
    """Kilobytes of so many values, floored as stores report them."""
    return F.floor(n_values * bytes_each / 1024).cast("long")


def size_mb(n_values: Column, bytes_each: int = 4) -> Column:
    """Megabytes as stores report them: kilobytes, then megabytes, both floored."""
    return F.floor(size_kb(n_values, bytes_each) / 1024).cast("long")


def block_sizes(shape: DataFrame, counts: DataFrame, by: str) -> DataFrame:
    """shape (by, dim, length) with `block`, the ticks of a block, and `rule`.

    A block holds 1 tick of axes of up to 8 and of run, step and variable, else the whole axis. counts (by, dim, count)
    divide an axis, floored; a count of none or of more than there are ticks gives no block but the rule `block count`.
    """
    usual = F.when((F.col("length") <= 8) | F.col("dim").isin("init_time", "step", "variable"), F.lit(1)).otherwise(F.col("length"))
    bad = (F.col("count") < 1) | (F.col("count") > F.col("length"))
    block = F.when(F.col("count").isNull(), usual).when(~bad, F.floor(F.col("length") / F.col("count"))).cast("int")
    return shape.join(counts.select(by, "dim", "count"), [by, "dim"], "left").select(*shape.columns, block.alias("block"), F.when(bad, "block count").alias("rule"))


def pack(cells: DataFrame, keys: list[str], by: int, bx: int) -> DataFrame:
    """Blocks (keys, cy, cx, value array) of by * bx cells in row order; missing cells are null.

    A block is as large as its two sizes say, and is filled in one pass over its cells in order: the nulls before a cell
    are as many as places lie between it and the one before. Of repeated places the greatest value stays.
    """
    at = (F.col("iy") % by) * bx + F.col("ix") % bx
    cut = cells.select(*keys, F.expr(f"cast(iy div {by} as int)").alias("cy"), F.expr(f"cast(ix div {bx} as int)").alias("cx"), at.cast("int").alias("p"), "value")
    once = cut.groupBy(*keys, "cy", "cx", "p").agg(F.max("value").alias("value"))
    rows = once.groupBy(*keys, "cy", "cx").agg(F.sort_array(F.collect_list(F.struct("p", "value"))).alias("s"))
    none = F.lit(None).cast(cells.schema["value"].dataType)
    before = lambda i: F.when(i > 0, F.get("s", i - 1)["p"]).otherwise(-1)
    parts = F.transform("s", lambda c, i: F.concat(F.array_repeat(none, c["p"] - before(i) - 1), F.array(c["value"])))
    rest = F.array_repeat(none, F.lit(by * bx - 1) - F.element_at("s", -1)["p"])
    return rows.select(*keys, "cy", "cx", F.concat(F.flatten(parts), rest).alias("value"))


def unpack(blocks: DataFrame, keys: list[str], by: int, bx: int) -> DataFrame:
    """Cells of blocks; what is missing in a block is missing again."""
    rows = blocks.select(*keys, "cy", "cx", F.posexplode("value").alias("p", "value")).where("value is not null")
    return rows.select(*keys, F.expr(f"cast(cy * {by} + p div {bx} as int)").alias("iy"), F.expr(f"cast(cx * {bx} + p % {bx} as int)").alias("ix"), "value")
