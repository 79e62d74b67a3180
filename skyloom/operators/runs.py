"""Runs from listing to summary: all wanted runs in one pass, failures as rows, only whole runs published."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import storage, versions
from . import axes, normalise, quality
from .errors import errors, together
from .layout import Layout, layout_of, layout_on

#: Raw fields of the wanted runs to canonical cells and error rows; both may read what storage.kept() has written.
Convert = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


@dataclass(frozen=True)
class Rules:
    """When runs pass: the share of pieces that may fail, of an image that may lack, and of images that may lack more."""

    of_pieces: float = 0.06
    of_image: float = 0.05
    of_images: float = 0.02
    delete_on_failure: bool = True


@dataclass
class Consumed:
    """runs: a row for each wanted run; errors: all that went wrong at this store so far; written: cells that were published, seconds it took."""

    runs: DataFrame
    errors: DataFrame
    written: int
    seconds: float


def status(outcome: DataFrame, verdict: DataFrame, delete_on_failure: bool) -> DataFrame:
    """outcome with status: `fetch_failed` where pieces failed or none came; where images lack too much `deleted_invalid`, or `kept_invalid` if nothing is to be deleted; else `ok`."""
    failed = F.lit("deleted_invalid" if delete_on_failure else "kept_invalid")
    both = outcome.join(verdict.select("init_time", "n_images", "bad_images", F.col("ok").alias("_good")), "init_time", "left")
    return both.withColumn("status", F.when(~F.col("ok"), "fetch_failed").when(~F.coalesce("_good", F.lit(False)), failed).otherwise("ok")).drop("ok", "_good")


def within_files(fields: DataFrame) -> DataFrame:
    """One cell of those that are equal within a file: that of its first data set. Columns: the layout's keys, value, url.

    Dealt before they are grouped, as few are equal: structs are grouped by sorting, which is so done once and not on both sides.
    """
    keys = [*layout_of(fields.columns).keys, "url"]
    return fields.repartition(*keys).groupBy(*keys).agg(F.min(F.struct("dataset_no", "value"))["value"].alias("value"))


def between_files(cells: DataFrame) -> DataFrame:
    """One cell of those that are equal in several files: that of the file which is written last, in the order of their urls."""
    keys = layout_of(cells.columns).keys
    return cells.repartition(*keys).groupBy(*keys).agg(F.max(F.struct("url", "value"))["value"].alias("value"))


def pieces_of(fields: DataFrame, allowed: list[str], kind: str) -> tuple[DataFrame, DataFrame]:
    """Canonical cells with their file (url) and piece (file and variable), and the error rows of files that name a parameter twice or hold nothing wanted.

    fields: init_time, url, dataset_no, alias, value and a column for every other dimension. They are read once. Only
    parameters that come under several names somewhere can clash in a file: these names are at most as many as there are parameters.
    """
    known = normalise.named(fields).withColumn("_kept", F.coalesce(F.col("variable").isin(allowed), F.lit(False)))
    if "lon_e4" in fields.columns:
        known = known.withColumn("lon_e4", normalise.wrap_longitude(F.col("lon_e4")).cast("int"))
    known = storage.kept(known, "fields")
    policy = normalise.POLICIES.get(kind, "never")
    sets = ["init_time", "url", *(["dataset_no"] if policy == "any" else [])]  # a file that needs only one wanted data set is judged as one
    each = known.groupBy(*sets).agg(F.max("_kept").alias("_kept")).withColumn("_kind", F.lit(kind))
    kept = known.where("_kept").drop("_kept")
    mixed = [r.variable for r in kept.groupBy("variable").agg((F.min("alias_ord") < F.max("alias_ord")).alias("_mixed")).where("_mixed").collect()]
    settled, clashes = normalise.settle_clashes(kept.where(F.col("variable").isin(mixed)), ["init_time", "url"])
    kept = kept.where(~F.col("variable").isin(mixed)).unionByName(settled)
    cells = within_files(kept).withColumn("piece", F.concat_ws("/", "url", "variable"))
    if policy == "never":
        return cells, clashes
    return cells, clashes.unionByName(normalise.nothing_relevant(each, "init_time", "url", "_kept", "_kind"))


def consume(
    spark: SparkSession, path: str, model: str, axis: DataFrame, runs: DataFrame, fetch: Callable[[DataFrame], DataFrame], allowed: list[str], kind: str = "gfs", rules: Rules = Rules(), attributes: dict[str, str] | None = None, convert: Convert | None = None
) -> Consumed:
    """Takes up the wanted runs that the store at path lacks.

    fetch gives the raw fields of the runs it is given: only those whose corner is missing, so that a second call goes on
    where the first one stopped. convert makes cells of them (init_time and the other keys, value, url, piece) and error
    rows; without it they are decoded fields, as pieces_of takes them. Cells of whatever dimensions the model's axes have
    go the same way. Of equal cells in a file the first data set's stays. Pieces are laid into the axes; a file that its
    conversion fails fails as a whole and counts once. Each run is judged by its pieces and then by its images; of equal
    cells in good pieces of several files the last file's stays. Only runs that pass are published, or those that are
    kept all the same, each whole (see versions). A row for each run goes to path + ".runs", error rows to path + ".errors".

    runs: (init_time, status, n, n_failed, bytes, rule, sample, misaligned, n_images, bad_images), misaligned being the
    pieces whose region starts or stops inside a block of the store; runs that were there before have the status `stored`.
    A store that can't be made leaves every run `store_failed`. Intermediates are deleted when it returns.
    """
    began, call, small = time.time(), uuid.uuid4().hex, []

    def hold(df: DataFrame) -> DataFrame:
        """A table of axes or runs, kept in memory while it is used."""
        small.append(df.persist())
        return df

    axis = hold(axis)  # made of cells, maybe, and read by each that follows
    images, _, failed = storage.create(spark, path, model, runs, axis, allowed, attributes)
    wanted = runs.select("init_time").distinct()
    if failed.limit(1).count():
        axis.unpersist()
        return Consumed(wanted.withColumn("status", F.lit("store_failed")), failed, 0, time.time() - began)
    layout = layout_on(axis)
    with storage.scratch(spark):
        outer = hold(axis.where("dim <> 'init_time'").select("dim", "idx", "num", "str").unionByName(axes.ordered(axes.ticks(images.select("init_time")))))
        stored = versions.found(spark, path, layout.schema)
        missing = hold(wanted if stored is None else quality.missing_runs(wanted, stored, outer))
        cells, said = (convert or (lambda fields: pieces_of(fields, allowed, kind)))(fetch(missing))
        said = storage.kept(said, "said")
        files = storage.kept(said.where("stage = 'convert'").select(F.col("run").alias("init_time"), "url").distinct(), "files")
        cells = storage.kept(cells.join(files, ["init_time", "url"], "left_anti"), "cells")
        judged, passed, pieces = _judge(cells, files, missing, outer, images, rules)
        judged = hold(judged)
        passing = judged.where("status in ('ok', 'kept_invalid')").select("init_time")
        written = versions.size(spark, path, versions.publish(passed.join(passing, "init_time", "left_semi"), path))
        old = wanted.join(missing, "init_time", "left_anti").select("init_time", F.lit("stored").alias("status"))
        judged.unionByName(old, allowMissingColumns=True).withColumn("call", F.lit(call)).write.mode("append").parquet(f"{path}.runs")
        told = together(said, errors(pieces.where("rule is not null"), "region", F.col("rule"), "init_time", "piece", "dim"), errors(judged.where("rule is not null"), "outcome", F.col("rule"), "init_time", None, "sample"))
        told.write.mode("append").parquet(f"{path}.errors")
        for df in small:
            df.unpersist()
    rows = spark.read.parquet(f"{path}.runs").where(F.col("call") == call).drop("call")
    return Consumed(rows, spark.read.parquet(f"{path}.errors"), written, time.time() - began)


def _judge(cells: DataFrame, files: DataFrame, missing: DataFrame, outer: DataFrame, images: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(runs with their status, unique cells of good pieces, all pieces with what keeps them from having a region).

    files: (init_time, url) of those that a conversion failed, known before pieces count: they have no cells here, so that their
    pieces are no results, and their cells meet no others.
    Pieces may be as many as cells: they are one row each, and are written, as their cells are; nothing holds them in memory.
    """
    blocks = storage.block_sizes(axes.shape(outer.withColumn("_all", F.lit(0)), "_all"), outer.select(F.lit(0).alias("_all"), "dim", F.lit(None).cast("int").alias("count")).limit(0), "_all")
    placed = axes.placed(cells, outer, "init_time", "piece", {r.dim: r.block for r in blocks.collect()}, storage.kept)
    counts = placed.agg(F.count_if(F.col("rule").isNull()).alias("good"), F.count_if(F.col("rule").isNotNull()).alias("bad")).first()
    rare, how = ("rule is null", "left_semi") if counts.good < counts.bad else ("rule is not null", "left_anti")
    named = storage.kept(placed.where(rare).select(F.col("piece").alias("_piece")).distinct(), "named")  # the shorter list of the two
    pieces = placed.select("init_time", F.col("piece").alias("url"), F.col("rule").isNotNull().alias("failed"), (F.col("n") * 4).alias("bytes"), F.when(F.col("odd"), 1).alias("_odd"))
    pieces = pieces.unionByName(files.select("init_time", "url", F.lit(True).alias("failed"), F.lit(0).cast("long").alias("bytes"), F.lit(None).cast("int").alias("_odd")))
    results = quality.outcome(missing, pieces, "init_time", rules.of_pieces).join(pieces.where("not failed").groupBy("init_time").agg(F.count("_odd").alias("misaligned")), "init_time", "left")
    results = results.withColumn("misaligned", F.coalesce("misaligned", F.lit(0)).cast("long"))
    passed = storage.kept(between_files(cells.join(named, F.col("piece").eqNullSafe(F.col("_piece")), how)), "passed")
    asked = images.join(missing, "init_time", "left_semi")
    shares = quality.missing_share(asked, passed, F.col("area"))
    return status(results, quality.verdict(shares, ["init_time"], rules.of_image, rules.of_images), rules.delete_on_failure), passed, placed


def summary(spark: SparkSession, path: str, done: Consumed, layout: Layout) -> DataFrame:
    """(store, status, n_cells, size_kb, size_mb, seconds, written) of each run; seconds and written are those of the whole call."""
    stored = versions.found(spark, path, layout.schema)
    counts = stored.groupBy("init_time").agg(F.count("*").alias("n_cells")) if stored is not None else done.runs.select("init_time", F.lit(0).cast("long").alias("n_cells")).limit(0)
    rows = done.runs.select("init_time", "status").join(counts, "init_time", "left").withColumn("n_cells", F.coalesce("n_cells", F.lit(0)))
    return rows.select(
        F.date_format("init_time", "yyyyMMddHH").alias("store"), "status", "n_cells", storage.size_kb(F.col("n_cells")).alias("size_kb"), storage.size_mb(F.col("n_cells")).alias("size_mb"), F.lit(done.seconds).alias("seconds"), F.lit(done.written).cast("long").alias("written"),
    )
