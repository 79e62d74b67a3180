"""Stores of dense blocks: what is written, put in later, chosen and left unread."""

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skyloom.operators import axes, quality
from skyloom.sources import blocks, storage

KEYS = ["init_time", "step", "variable", "ensemble_member", "y_osgb", "x_osgb"]


def grid(spark, ny=7, nx=10, steps=(0, 1, 2), members=(0, 3), every=1):
    """(cells of a members' model in metres, its axis table); `every`: only cells whose number divides by it."""
    n = spark.range(len(steps) * len(members) * ny * nx)
    pick = lambda values, by: F.element_at(F.array(*map(F.lit, values)), (F.expr(f"id div {by}") % len(values) + 1).cast("int"))
    cells = n.select(
        F.lit("2024-01-02").cast("timestamp_ntz").alias("init_time"), pick(steps, len(members) * ny * nx).alias("step"), F.lit("temperature_sl").alias("variable"), pick(members, ny * nx).alias("ensemble_member"),
        (F.lit(9000) - 2000 * (F.expr(f"id div {nx}") % ny)).cast("int").alias("y_osgb"), (F.lit(-5000) + 2000 * (F.col("id") % nx)).cast("int").alias("x_osgb"), F.col("id").cast("double").alias("value"), "id",
    )
    axis = axes.ordered(axes.ticks(cells.drop("id", "init_time")))
    return cells.where(F.col("id") % every == 0).drop("id"), axis


def rows(cells):
    return {tuple(r[:-1]): r[-1] for r in cells.select(*KEYS, "value").collect()}


def test_blocks_are_the_cells_and_know_what_lacks(spark):
    cells, axis = grid(spark, every=3)
    form, path = blocks.form_on(axis, 4, 4), storage.new_path(spark, "blocks")
    assert (form.ny, form.nx, form.by, form.bx, form.y, form.x) == (7, 10, 4, 4, "y_osgb", "x_osgb")
    assert blocks.found(spark, path, form) is None
    blocks.publish(cells, axis, path, form)
    stored = blocks.found(spark, path, form)
    assert rows(blocks.select(stored, axis, form)) == rows(cells)
    assert {(len(r.value), r.n) for r in stored.select("value", "n").where("cy = 1 and cx = 2").collect()} <= {(16, k) for k in range(7)}
    expected = cells.select("init_time", "step", "variable", "ensemble_member").distinct()
    shares = lambda df: sorted(map(tuple, df.collect()))
    assert shares(quality.blocks_missing_share(expected, stored, 70)) == shares(quality.missing_share(expected, cells, 70))


def test_cells_put_in_later_win_their_places_only(spark):
    cells, axis = grid(spark, every=2)
    form, path = blocks.form_on(axis, 3, 4), storage.new_path(spark, "blocks")
    blocks.publish(cells, axis, path, form)
    whole, _ = grid(spark)
    late = whole.where("value % 5 = 0").withColumn("value", F.when(F.col("value") % 20 > 0, -F.col("value")))
    other = late.limit(3).withColumns({"init_time": F.lit("2024-01-03").cast("timestamp_ntz"), "value": F.lit(1.0)})
    blocks.upsert(late.unionByName(other), axis, path, form)
    want = {**rows(cells), **rows(late), **rows(other)}
    assert rows(blocks.select(blocks.found(spark, path, form), axis, form)) == {k: v for k, v in want.items() if v is not None}
    blocks.upsert(cells.limit(0), axis, path, form)
    blocks.publish(cells.limit(2), axis, path, form)
    left = rows(blocks.select(blocks.found(spark, path, form), axis, form))
    assert left == {**rows(cells.limit(2)), **rows(other)}, "a run that is published anew loses what it had, another one stays"


@pytest.mark.parametrize(
    "isel, sel",
    [
        ({"y_osgb": slice(1, 5), "x_osgb": slice(None, None, 3)}, {}), ({"step": -1, "ensemble_member": [0, 1]}, {"x_osgb": slice(-1000, 5000)}), ({"y_osgb": [6, 0]}, {"ensemble_member": 3}),
        ({}, {"y_osgb": slice(5000, -1000), "step": [0, 2]}), ({"x_osgb": slice(8, 99)}, {"y_osgb": slice(None, 6000)}), ({"step": slice(3, 9)}, {}), ({"y_osgb": slice(0, 3)}, {"y_osgb": slice(7000, 1000)}),
    ],
)
def test_choices_are_those_of_an_array(spark, isel, sel):
    cells, axis = grid(spark)
    form, path = blocks.form_on(axis, 3, 4), storage.new_path(spark, "blocks")
    blocks.publish(cells, axis, path, form)
    ticks = {"step": [0, 1, 2], "ensemble_member": [0, 3], "y_osgb": list(range(9000, -4001, -2000))[:7], "x_osgb": list(range(-5000, 14000, 2000))}
    keep = {}
    for d, lines in ticks.items():
        at = np.atleast_1d(np.arange(len(lines))[isel.get(d, slice(None))])
        some = {lines[i] for i in at}
        if isinstance(s := sel.get(d), slice):
            a, z = (s.start if s.start is not None else lines[0]), (s.stop if s.stop is not None else lines[-1])
            low, high = min(a, z), max(a, z)
            some = {t for t in some if low <= t <= high}
        elif s is not None:
            some &= set(s if isinstance(s, list) else [s])
        keep[d] = some
    want = {k: v for k, v in rows(cells).items() if k[1] in keep["step"] and k[3] in keep["ensemble_member"] and k[4] in keep["y_osgb"] and k[5] in keep["x_osgb"]}
    assert rows(blocks.select(blocks.found(spark, path, form), axis, form, isel, sel)) == want


def test_what_is_not_there_raises(spark):
    cells, axis = grid(spark)
    form, path = blocks.form_on(axis, 3, 4), storage.new_path(spark, "blocks")
    with pytest.raises(PySparkException, match="no grid line"):
        blocks.publish(cells.withColumn("x_osgb", F.col("x_osgb") + 1), axis, path, form)
    blocks.publish(cells, axis, path, form)
    stored = blocks.found(spark, path, form)
    for isel, sel in (({"step": 7}, {}), ({}, {"step": 7}), ({"latitude": 0}, {})):
        with pytest.raises((IndexError, KeyError, ValueError)):
            blocks.select(stored, axis, form, isel, sel)
    with pytest.raises(ValueError, match="at least one cell"):
        blocks.form_on(axis, 0, 4)


def test_a_box_leaves_row_groups_unread(spark):
    """Rows that a scan hands on fall with the box, as row groups of other tiles are skipped by their statistics."""
    cells, axis = grid(spark, 64, 64, steps=(0,), members=(0,))
    form = blocks.form_on(axis, 2, 2)
    made, path = blocks.tiles(cells, axis, form), storage.new_path(spark, "blocks")
    blocks.write(blocks._filled(made, form, F.transform("piece", lambda p: p["v"])), path, form, group_bytes=4096)
    stored = spark.read.schema(form.schema).parquet(path)

    def read(df):
        plan = df.where("n > 0")._jdf.queryExecution().executedPlan()
        plan.executeCollect()
        return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()

    whole, box = read(stored), read(stored.where("cy < 4 and cx < 4"))
    assert whole == 1024 and box <= 256


def test_the_curve_takes_bits_in_turn(spark):
    got = spark.range(1).select(*(blocks.curve(F.lit(y), F.lit(x)) for y, x in ((0, 1), (1, 0), (1, 1), (2, 3), (65535, 65535), (0, 65535)))).first()
    both = lambda y, x: sum(((y >> i & 1) << (2 * i + 1)) | ((x >> i & 1) << (2 * i)) for i in range(16))
    assert list(got) == [both(0, 1), both(1, 0), both(1, 1), both(2, 3), 2**32 - 1, both(0, 65535)]
