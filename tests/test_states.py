"""Sums that are kept with a store, against scans of its cells."""

import pytest
from pyspark.sql import functions as F
from test_blocks import grid

from skyloom.operators import quality
from skyloom.operators.layout import layout_of
from skyloom.sources import blocks, states, storage, versions


def facts(df):
    return sorted((r.variable, r.n, r.has_nulls, r.is_valid, round(r.mean, 6), round(r.outside_share, 6)) for r in df.collect())


def test_kept_sums_follow_upserts_drops_and_writes_that_die(spark, monkeypatch):
    cells, _ = grid(spark)
    cells = cells.unionByName(cells.withColumns({"init_time": F.lit("2024-01-03").cast("timestamp_ntz"), "variable": F.lit("wind_direction_10m")}))
    path, schema = storage.new_path(spark, "store"), layout_of(cells.columns).schema
    same = lambda: facts(states.scan(states.found(spark, path))) == facts(quality.scan(versions.found(spark, path, schema))[0])
    assert states.found(spark, path).count() == 0
    states.publish(cells, path)
    assert same() and facts(states.scan(states.found(spark, path)))[0][1] == 420
    states.upsert(cells.where("variable = 'temperature_sl' and step = 1").withColumn("value", F.when(F.col("value") % 2 > 0, -900.0)), path)
    assert same()
    before = facts(states.scan(states.found(spark, path)))
    with monkeypatch.context() as m:
        m.setattr(versions, "_take_up", lambda *a, **k: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            states.publish(cells.withColumn("value", F.lit(0.0)), path)
    assert facts(states.scan(states.found(spark, path))) == before and same()
    versions.sweep(spark, path)
    assert facts(states.scan(states.found(spark, path))) == before
    mean = states.store_mean(states.found(spark, path)).first()
    assert round(mean.store_mean, 6) == round(versions.found(spark, path, schema).agg(F.avg("value")).first()[0], 6)
    versions.drop_runs(spark, path, cells.where("variable = 'temperature_sl'").select("init_time"))
    assert same() and len(facts(states.scan(states.found(spark, path)))) == 1


def test_sums_of_blocks_are_those_of_cells(spark):
    cells, axis = grid(spark, every=2)
    form, path = blocks.form_on(axis, 4, 4), storage.new_path(spark, "blocks")
    blocks.publish(cells, axis, path, form)
    a = states.of_blocks(blocks.found(spark, path, form), 70).drop("n_cells").collect()
    assert a == states.of_cells(cells).drop("n_cells").collect()
    odd = states.of_cells(cells.withColumn("variable", F.lit("odd"))).first()
    assert odd.outside is None and odd.n == cells.count()
