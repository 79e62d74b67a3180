"""Queries that write stores and read them back."""

from pyspark.sql import functions as F

from ..functions import catalog
from ..operators import axes as a
from ..operators import normalise as n
from ..operators import quality as q
from ..sources import blocks as b
from ..sources import states, versions
from ..sources import storage as s
from ..sources import tables as t
from .axes import CELLS, EXPECTED_SQL, VARIABLES, expected, known
from .registry import query


STORE_SQL = f"""images as (select init_time, step, variable, null::varchar as ensemble_stat, null::int as ensemble_member, (select count(distinct lat_e4) * count(distinct lon_e4) from known)::bigint as area from expected)"""


def model_axis(spark, folder):
    """The axes of a model whose grid is that of the events, without runs."""
    return a.ordered(a.ticks(known(spark, folder).select("step", "variable", "lat_e4", "lon_e4")))


@query("""select 'image' as what, init_time, step, variable, area from images union all select 'first: new store', null, null, null, 0 union all select 'then: used again', null, null, null, (select sum(area) * 4 // 1024 from images)
  union all select 'different model', null, null, null, null union all select 'no runs', null, null, null, null""", *CELLS, EXPECTED_SQL, STORE_SQL)
def create_store(spark, folder):
    """A store for the morning's runs, made again for all; then asked for by another model, and for no runs."""
    runs, axis, path = t.field_events(spark, folder).select("init_time").distinct(), model_axis(spark, folder), s.new_path(spark, "store")
    said = catalog.attributes(VARIABLES, "latlon")
    _, first, _ = s.create(spark, path, "events", runs.where(F.hour("init_time") < 12), axis, VARIABLES, said)
    images, then, _ = s.create(spark, path, "events", runs, axis, VARIABLES, said)
    other = s.create(spark, path, "another", runs, axis, VARIABLES)[2].unionByName(s.create(spark, s.new_path(spark, "store"), "events", runs.where("false"), axis, VARIABLES)[2])
    none = lambda *c: [F.lit(None).cast(k).alias(n) for n, k in zip(("init_time", "step", "variable"), ("timestamp_ntz", "int", "string"), strict=True)]
    about = first.select(F.lit("first: new store").alias("what"), *none(), F.col("size_kb").alias("area")).unionByName(then.where("reused").select(F.lit("then: used again").alias("what"), *none(), F.col("size_kb").alias("area")))
    rows = images.select(F.lit("image").alias("what"), "init_time", "step", "variable", "area")
    return rows.unionByName(about).unionByName(other.select(F.col("rule").alias("what"), *none(), F.lit(None).cast("long").alias("area")))


CANONICAL_SQL = "canonical as (select init_time, step, variable, lat_e4, lon_e4, min(event_id) as event_id, arg_min(value, event_id) as value from known group by all)"


def canonical(spark, folder):
    return n.merge_first_wins(known(spark, folder), s.KEYS, "event_id").select(*s.KEYS, "event_id", "value")


def _stored(spark, cells):
    path = s.new_path(spark, "store")
    s.write(cells, path)
    return s.read(spark, path, cells.schema), path


@query("select init_time, step, variable, lat_e4, lon_e4, value + case when event_id % 3 = 0 then 1000 else 0 end as value from canonical", *CELLS, CANONICAL_SQL)
def region_upsert(spark, folder):
    cells = canonical(spark, folder).withColumn("seq", F.lit(0))
    store, path = _stored(spark, cells)
    pieces = cells.where("event_id % 3 = 0").withColumns({"value": F.col("value") + 1000, "seq": F.lit(1)})
    return s.upsert(store, pieces, path).select(*s.KEYS, "value")


@query("select init_time, step, variable, lat_e4, lon_e4, value from canonical where variable = 'temperature_sl' and init_time >= timestamp '2024-01-10' and step < 3", *CELLS, CANONICAL_SQL)
def select_cells(spark, folder):
    store, _ = _stored(spark, canonical(spark, folder))
    return store.where((F.col("variable") == "temperature_sl") & (F.col("init_time") >= F.lit("2024-01-10").cast("timestamp_ntz")) & (F.col("step") < 3)).select(*s.KEYS, "value")


@query("select init_time, count(*) as n_cells from canonical where day(init_time) > 5 group by 1", *CELLS, CANONICAL_SQL)
def drop_run(spark, folder):
    cells = canonical(spark, folder)
    store, path = _stored(spark, cells)
    s.drop_runs(spark, path, store.where(F.dayofmonth("init_time") <= 5).select("init_time"))
    return s.read(spark, path, cells.schema).groupBy("init_time").agg(F.count("*").alias("n_cells"))


@query("select label, count(*) as n_images, (sum(n) * 4 // 1024)::bigint as size_kb, (sum(n) * 4 // 1024 // 1024)::bigint as size_mb, sum(n)::bigint as n_values from (select label, len(embedding) as n from embeddings) group by 1")
def store_size(spark, folder):
    images = t.flat_vectors(spark, folder).withColumn("n", F.greatest(F.size("value"), F.lit(0)).cast("long"))
    facts = images.groupBy("label").agg(F.count("*").alias("n_images"), F.sum("n").alias("n_values"))
    return facts.select("label", "n_images", s.size_kb(F.col("n_values")).alias("size_kb"), s.size_mb(F.col("n_values")).alias("size_mb"), "n_values")


CELL_SQL = "cells as (select init_time, step, variable, iy, ix, value from (select *, row_number() over (partition by init_time, step, variable, iy, ix order by event_id) as r from known) where r = 1)"


def _cells(spark, folder):
    keys = ["init_time", "step", "variable", "iy", "ix"]
    return n.merge_first_wins(known(spark, folder), keys, "event_id").select(*keys, "value")


@query("""select init_time, step, variable, cy, cx, array_to_string(list_transform(generate_series(0, 24), lambda p: coalesce(m[p][1]::varchar, '-')), ' ') as block
  from (select init_time, step, variable, (iy // 5)::int as cy, (ix // 5)::int as cx, map_from_entries(list((((iy % 5) * 5 + ix % 5), round(value * 100)::bigint))) as m from cells group by 1, 2, 3, 4, 5)""".replace("m[p][1]", "m[p]"), *CELLS, CELL_SQL)
def pack_blocks(spark, folder):
    blocks = s.pack(_cells(spark, folder), ["init_time", "step", "variable"], 5, 5)
    text = F.array_join(F.transform("value", lambda v: F.coalesce(F.round(v * 100).cast("long").cast("string"), F.lit("-"))), " ")
    return blocks.select("init_time", "step", "variable", "cy", "cx", text.alias("block"))


@query("select init_time, step, variable, iy, ix, value from cells where value is not null", *CELLS, CELL_SQL)
def unpack_blocks(spark, folder):
    keys = ["init_time", "step", "variable"]
    return s.unpack(s.pack(_cells(spark, folder), keys, 5, 5), keys, 5, 5)


# tiles of 4 x 6 on the model's grid: a partial upsert of two kinds of pieces, one of which writes nulls
UPSERT_SQL = "upserted as (select init_time, step, variable, lat_e4, lon_e4, case when event_id % 7 = 0 then null when event_id % 3 = 0 then value + 1000 else value end as value from canonical)"


def _block_store(spark, folder):
    axis, path, cells = model_axis(spark, folder), s.new_path(spark, "blocks"), canonical(spark, folder)
    form = b.form_on(axis, 4, 6)
    b.publish(cells, axis, path, form)
    late = F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value") + 1000)
    b.upsert(cells.where("event_id % 3 = 0 or event_id % 7 = 0").withColumn("value", late), axis, path, form)
    return b.found(spark, path, form), axis, form


@query("select init_time, step, variable, lat_e4, lon_e4, value from upserted where value is not null", *CELLS, CANONICAL_SQL, UPSERT_SQL)
def block_upsert(spark, folder):
    return b.select(*_block_store(spark, folder))


@query("""select init_time, step, variable, lat_e4, lon_e4, value from upserted where value is not null and variable in ('cloud_cover_total', 'temperature_sl') and lat_e4 between 593000 and 598000
  and lon_e4 in (select lon_e4 from (select lon_e4, row_number() over (order by lon_e4) - 1 as ix from (select distinct lon_e4 from known)) where ix >= 3 and ix < 11) and step in (select step from (select step, row_number() over (order by step) as i from (select distinct step from known)) where i > 2)""", *CELLS, CANONICAL_SQL, UPSERT_SQL)  # fmt: skip
def select_box(spark, folder):
    """A box by labels in one direction and by indices in the other, of some variables and the later steps."""
    return b.select(*_block_store(spark, folder), isel={"longitude": slice(3, 11), "step": slice(2, None)}, sel={"latitude": slice(59.8, 59.3), "variable": ["temperature_sl", "cloud_cover_total"]})


@query("select init_time, step, variable, round(1.0::double - coalesce(n, 0) / 150.0::double, 6) as share from expected left join (select init_time, step, variable, count(value) as n from upserted group by all) using (init_time, step, variable)", *CELLS, CANONICAL_SQL, UPSERT_SQL, EXPECTED_SQL)
def block_missing_share(spark, folder):
    blocks, _, _ = _block_store(spark, folder)
    return q.blocks_missing_share(expected(spark, folder), blocks, 150).withColumn("share", F.round("share", 6))


@query("""select variable, round(avg(value), 6) as mean, count(value) as n, count(value) < count(*) as has_nulls, round(sum((value not between least(lower, upper) and greatest(lower, upper))::int) / count(value)::double, 6) as outside_share,
  sum((value not between least(lower, upper) and greatest(lower, upper))::int) / count(value)::double <= 0.05 as is_valid from upserted join params using (variable) where day(init_time) > 5 group by 1""", *CELLS, catalog.PARAMETER_SQL, CANONICAL_SQL, UPSERT_SQL)
def kept_scan(spark, folder):
    """A scan of the sums kept with a store, after an upsert of some pieces and after runs were dropped."""
    path, cells = s.new_path(spark, "store"), canonical(spark, folder)
    states.publish(cells.select(*s.KEYS, "value"), path)
    late = F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value") + 1000)
    states.upsert(cells.where("event_id % 3 = 0 or event_id % 7 = 0").select(*s.KEYS, late.alias("value")), path)
    versions.drop_runs(spark, path, cells.where(F.dayofmonth("init_time") <= 5).select("init_time"))
    return states.scan(states.found(spark, path)).withColumns({"mean": F.round("mean", 6), "outside_share": F.round("outside_share", 6)})
