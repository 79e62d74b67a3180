"""Queries over axes and regions."""

from pyspark.sql import functions as F

from ..functions import catalog
from ..operators import axes as a
from ..operators import normalise as n
from ..sources import storage as s
from ..sources import tables as t
from .registry import query

STEPS = [0, 1, 2, 3, 4, 5]
VARIABLES = ["cloud_cover_total", "downward_shortwave_radiation_flux_gl", "temperature_sl", "wind_u_component_10m"]
VARIABLES_SQL = ", ".join(map(catalog.sql_value, VARIABLES))
KNOWN_SQL = "known as (select * from field_ev join aliases using (alias))"


def known(spark, folder):
    return n.named(t.field_events(spark, folder)).where("variable is not null")


def ticks_sql(name: str, source: str, by: str = "") -> str:
    """Common tables: the different ticks of five dimensions of `source`, numbered in canonical order."""
    b, p = (f"{by}, ", f"{by}, ") if by else ("", "")
    return f"""{name} as (select *, (row_number() over (partition by {p}dim order by case when dim = 'latitude' then -num else num end, str) - 1)::int as idx from (
      select distinct {b}'init_time' as dim, epoch(init_time)::double as num, null::varchar as str from {source} union all select distinct {b}'step', step::double, null from {source}
      union all select distinct {b}'variable', null::double, variable from {source} union all select distinct {b}'latitude', lat_e4 / 10000.0::double, null from {source}
      union all select distinct {b}'longitude', lon_e4 / 10000.0::double, null from {source}))"""


CELLS = (t.FIELD_SQL, catalog.ALIAS_SQL, KNOWN_SQL)
WHOLE = (*CELLS, ticks_sql("whole", "known"))


@query("select dim, num, str, idx from whole", *WHOLE)
def axes_from_cells(spark, folder):
    return a.ordered(a.ticks(known(spark, folder)))


# The cells of three models on three kinds of grid, made of the same events: degrees, OSGB metres with members, LAEA metres with statistics.
GRIDS_SQL = """grids as (select 'latlon' as grid, * from (select init_time, step, variable, null::varchar as ensemble_stat, null::int as ensemble_member, lat_e4 / 10000.0::double as y, lon_e4 / 10000.0::double as x, event_id, user_id from known)
  union all select 'osgb', init_time, step, variable, null, (event_id % 5 + 1)::int, (1223000 - 2000 * iy)::double, (-239000 + 2000 * ix)::double, event_id, user_id from known where user_id % 3 > 0
  union all select 'laea', init_time, step, variable, case when event_id % 2 = 0 then 'mean' else 'std' end, null, (700000 - 2000 * iy)::double, (-576000 + 2000 * ix)::double, event_id, user_id from known where user_id % 3 > 1)"""
GRID_TICKS_SQL = """long as (
  select grid, 'init_time' as dim, epoch(init_time)::double as num, null::varchar as str, event_id from grids union all select grid, 'step', step::double, null, event_id from grids union all select grid, 'variable', null, variable, event_id from grids
  union all select grid, 'ensemble_stat', null, ensemble_stat, event_id from grids where ensemble_stat is not null union all select grid, 'ensemble_member', ensemble_member::double, null, event_id from grids where ensemble_member is not null
  union all select grid, case grid when 'latlon' then 'latitude' else 'y_' || grid end, y, null, event_id from grids union all select grid, case grid when 'latlon' then 'longitude' else 'x_' || grid end, x, null, event_id from grids),
tick as (select grid, dim, num, str from long group by all)"""
GRIDS = (*CELLS, GRIDS_SQL, GRID_TICKS_SQL)


def gridded(spark, folder):
    cells = known(spark, folder)
    none = lambda kind: F.lit(None).cast(kind)
    keys = ["init_time", "step", "variable", "event_id", "user_id"]
    degrees = cells.select(F.lit("latlon").alias("grid"), *keys, none("string").alias("ensemble_stat"), none("int").alias("ensemble_member"), "lat_e4", "lon_e4")
    osgb = cells.where("user_id % 3 > 0").select(F.lit("osgb").alias("grid"), *keys, none("string").alias("ensemble_stat"), (F.col("event_id") % 5 + 1).cast("int").alias("ensemble_member"), (F.lit(1223000) - 2000 * F.col("iy")).alias("y_osgb"), (F.lit(-239000) + 2000 * F.col("ix")).alias("x_osgb"))
    laea = cells.where("user_id % 3 > 1").select(F.lit("laea").alias("grid"), *keys, F.when(F.col("event_id") % 2 == 0, "mean").otherwise("std").alias("ensemble_stat"), (F.lit(700000) - 2000 * F.col("iy")).alias("y_laea"), (F.lit(-576000) + 2000 * F.col("ix")).alias("x_laea"))
    return degrees.unionByName(osgb, allowMissingColumns=True).unionByName(laea, allowMissingColumns=True)


@query("select grid, dim, case dim when 'init_time' then 1 when 'step' then 2 when 'variable' then 3 when 'ensemble_stat' then 4 when 'ensemble_member' then 5 when 'latitude' then 6 when 'longitude' then 7 when 'y_osgb' then 8 when 'x_osgb' then 9 when 'y_laea' then 10 else 11 end as place, count(*) as length from tick group by 1, 2", *GRIDS)
def shape_map(spark, folder):
    return a.shape(a.ticks(gridded(spark, folder), ("grid",)), "grid")


# axes as runs give them: ticks in the order in which a run's events come, some without a dimension, some with an unknown one
GIVEN_SQL = """given as (select grid || '/' || strftime(init_time, '%Y%m%d%H') as axes, g.*, init_time as run from grids g),
arrived as (select axes, dim, num, str, (row_number() over (partition by axes, dim order by min(event_id)) - 1)::int as idx from (
  select axes, 'init_time' as dim, epoch(init_time)::double as num, null::varchar as str, event_id from given union all select axes, 'step', step::double, null, event_id from given where hour(run) <> 18 or day(run) % 2 = 0
  union all select axes, 'variable', null, variable, event_id from given union all select axes, 'ensemble_stat', null, ensemble_stat, event_id from given where ensemble_stat is not null union all select axes, 'ensemble_member', ensemble_member::double, null, event_id from given where ensemble_member is not null
  union all select axes, case when grid = 'latlon' then 'latitude' else 'y_' || grid end, y, null, event_id from given union all select axes, case when grid = 'latlon' then case when day(run) = 7 then 'lon' else 'longitude' end else 'x_' || grid end, x, null, event_id from given) group by axes, dim, num, str)"""


@query("""select axes, case when sum((dim = 'init_time')::int) = 0 or sum((dim = 'step')::int) = 0 or sum((dim = 'variable')::int) = 0 then 'missing dimension'
  when sum((dim = 'variable' and str not in ('cloud_cover_total', 'temperature_sl', 'wind_u_component_10m'))::int) > 0 and axes like '%06' then 'unknown variable' when sum((dim = 'lon')::int) > 0 then 'unknown dimension'
  when arg_min(num, idx) filter (where dim = 'latitude') < arg_max(num, idx) filter (where dim = 'latitude') then 'latitude order' when arg_min(num, idx) filter (where dim = 'longitude') > arg_max(num, idx) filter (where dim = 'longitude') then 'longitude order'
  when arg_min(num, idx) filter (where dim = 'y_osgb') < arg_max(num, idx) filter (where dim = 'y_osgb') then 'y_osgb order' when arg_min(num, idx) filter (where dim = 'x_osgb') > arg_max(num, idx) filter (where dim = 'x_osgb') then 'x_osgb order'
  when arg_min(num, idx) filter (where dim = 'y_laea') < arg_max(num, idx) filter (where dim = 'y_laea') then 'y_laea order' when arg_min(num, idx) filter (where dim = 'x_laea') > arg_max(num, idx) filter (where dim = 'x_laea') then 'x_laea order' end as breach from arrived group by axes""", *GRIDS, GIVEN_SQL)  # fmt: skip
def validate_axes(spark, folder):
    cells = gridded(spark, folder).withColumn("axes", F.concat("grid", F.lit("/"), F.date_format("init_time", "yyyyMMddHH")))
    run = F.col("init_time")
    one = lambda d: F.struct(F.lit(d).alias("dim"), (F.lit(None).cast("double") if d in a.LABELS else a.tick_of(d)).alias("num"), (a.tick_of(d) if d in a.LABELS else F.lit(None).cast("string")).alias("str"))
    long = cells.select("axes", "event_id", run.alias("run"), "grid", F.inline(F.array(*map(one, a.DIMS)))).where("num is not null or str is not null")
    long = long.where(~((F.col("dim") == "step") & (F.hour("run") == 18) & (F.dayofmonth("run") % 2 == 1))).withColumn("dim", F.when((F.col("dim") == "longitude") & (F.dayofmonth("run") == 7), "lon").otherwise(F.col("dim")))
    axis = n.numbered(long.groupBy("axes", "dim", "num", "str").agg(F.min("event_id").alias("first")), [F.col("first")], ("axes", "dim"))
    three, four = ["cloud_cover_total", "temperature_sl", "wind_u_component_10m"], VARIABLES
    morning = F.col("axes").endswith("06")  # runs of this hour know only three variables
    return a.validate(axis.where(morning), "axes", three).unionByName(a.validate(axis.where(~morning), "axes", four))


@query("select event_id, epoch_us(init_time) * 1000 as init_time_ns, step::bigint * 3600000000000 as step_ns, variable from known", *CELLS)
def encode_times(spark, folder):
    return a.encode_times(known(spark, folder), "event_id", "variable")


# pieces: the cells of one run and variable, named by both; two hours' pieces lack longitudes, and one variable's come as two-run pieces
PIECE_SQL = """pieces as (select *, strftime(init_time, '%Y%m%d%H') || '/' || variable as piece from known where step >= 1 and iy < 9 and variable <> 'wind_u_component_10m'
  union all select *, strftime(init_time, '%Y%m%d') || '/' || variable from known where variable = 'wind_u_component_10m')"""
EACH_SQL = ticks_sql("every", "pieces", "piece") + ", each as (select * from every where not (dim = 'longitude' and piece like '%12/cloud_cover_total'))"
REGION_SQL = """met as materialized (select e.piece, e.dim, e.num, e.str, o.idx from each e left join inner_whole o on e.dim = o.dim and e.num is not distinct from o.num and e.str is not distinct from o.str),
facts as (select piece, dim, min(idx) as start, max(idx) + 1 as stop, count(*) as n, count(*) - count(idx) as lost from met group by 1, 2),
region as (select piece, dim, start, stop, case when (select count(*) from facts g where g.piece = f.piece) <> 5 then 'dimensions' when n > (select count(*) from inner_whole w where w.dim = f.dim) then 'longer'
  when lost > 0 then 'outside' when stop - start <> n then 'gaps' end as rule from facts f)"""
# the outer axes end before the last longitude and step
OUTER_SQL = "inner_whole as (select * from whole where not (dim = 'longitude' and num > 0.85) and not (dim = 'step' and num > 4))"
PIECES = (*WHOLE, OUTER_SQL, PIECE_SQL, EACH_SQL, REGION_SQL)
MET = (*WHOLE, OUTER_SQL, PIECE_SQL, EACH_SQL, REGION_SQL.split(",\nfacts as")[0])


def pieces(spark, folder):
    cells = known(spark, folder)
    wind = F.col("variable") == "wind_u_component_10m"
    name = F.concat(F.when(wind, F.date_format("init_time", "yyyyMMdd")).otherwise(F.date_format("init_time", "yyyyMMddHH")), F.lit("/"), F.col("variable"))
    return cells.where(wind | ((F.col("step") >= 1) & (F.col("iy") < 9))).withColumn("piece", name)


def inner_axes(spark, folder):
    found = a.ticks(pieces(spark, folder), ("piece",))
    return found.where(~((F.col("dim") == "longitude") & F.col("piece").like("%12/cloud_cover_total")))


def outer_axes(spark, folder):
    return a.ordered(a.ticks(known(spark, folder))).where("not (dim = 'longitude' and num > 0.85) and not (dim = 'step' and num > 4)")


def regions(spark, folder):
    return a.regions(inner_axes(spark, folder), outer_axes(spark, folder), "piece")


@query("select piece, dim, start, stop, rule from region", *PIECES)
def determine_region(spark, folder):
    return regions(spark, folder)


@query("""select piece, dim, 'gap' as kind, before, idx as after, null::varchar as tick from (select piece, dim, idx, lag(idx) over (partition by piece, dim order by idx) as before from met where idx is not null) where idx > before + 1
  union all select piece, dim, 'outside', null, null, coalesce(str, printf('%.4f', num)) from met where idx is null""", *MET)
def region_gaps(spark, folder):
    return a.gaps(inner_axes(spark, folder), outer_axes(spark, folder), "piece")


EXPECTED_SQL = f"expected as (select init_time, step::int as step, variable from (select distinct init_time from field_ev), unnest({STEPS}) as a(step), unnest({catalog.sql_value(VARIABLES)}) as b(variable))"


def expected(spark, folder):
    return a.expected_images(t.field_events(spark, folder).select("init_time").distinct(), STEPS, VARIABLES)


@query("""select d.grid, t.num::bigint as init_seconds, s.num::int as step, v.str as variable, e.str as ensemble_stat, m.num::int as ensemble_member, d.area from (
    select grid, product(n)::bigint as area from (select grid, dim, count(*) as n from tick where dim in ('latitude', 'longitude', 'y_osgb', 'x_osgb', 'y_laea', 'x_laea') group by 1, 2) group by 1) d
  join tick t on t.grid = d.grid and t.dim = 'init_time' join tick s on s.grid = d.grid and s.dim = 'step' join tick v on v.grid = d.grid and v.dim = 'variable'
  left join tick e on e.grid = d.grid and e.dim = 'ensemble_stat' left join tick m on m.grid = d.grid and m.dim = 'ensemble_member'""", *GRIDS)
def expected_images(spark, folder):
    return a.skeleton(a.ordered(a.ticks(gridded(spark, folder), ("grid",)), ("grid",)), "grid")


# boxes by run: most lie within the data of their run, some outside it, some are no boxes
BOX_SQL = """edges as (select init_time, max(lat_e4) as n, min(lon_e4) as w, min(lat_e4) as s, max(lon_e4) as e from field_ev group by 1),
boxes as (select init_time, case when day(init_time) % 10 = 0 then 59.0 else 59.8 end as north, case when hour(init_time) = 18 then -5.5 else -4.6 end as west, 59.2 as south, -4.1 as east from edges),
judged as (select *, case when south >= north then 'no such box' when north * 10000 > n or south * 10000 < s or west * 10000 < w or east * 10000 > e then 'outside the data' end as rule from boxes join edges using (init_time))"""


def boxes(spark, folder):
    runs = t.field_events(spark, folder).select("init_time").distinct()
    north, west = F.when(F.dayofmonth("init_time") % 10 == 0, 59.0).otherwise(59.8), F.when(F.hour("init_time") == 18, -5.5).otherwise(-4.6)
    return runs.select("init_time", north.alias("north"), west.alias("west"), F.lit(59.2).alias("south"), F.lit(-4.1).alias("east"))


@query("select event_id, lat_e4, lon_e4, null::varchar as rule from field_ev join judged using (init_time) where rule is null and lat_e4 between round(south * 10000) and round(north * 10000) and lon_e4 between round(west * 10000) and round(east * 10000) union all select null, null, null, rule from judged where rule is not null", t.FIELD_SQL, BOX_SQL)
def crop_region(spark, folder):
    kept, said = a.crop(t.field_events(spark, folder), boxes(spark, folder), "init_time")
    return kept.select("event_id", "lat_e4", "lon_e4", F.lit(None).cast("string").alias("rule")).unionByName(said.select("rule"), allowMissingColumns=True)


@query("select init_time, max(lat_e4) / 10000.0::double as north, min(lon_e4) / 10000.0::double as west, min(lat_e4) / 10000.0::double as south, max(lon_e4) / 10000.0::double as east from field_ev group by 1", t.FIELD_SQL)
def bounds(spark, folder):
    return a.bounds(t.field_events(spark, folder), "init_time")


# two blocks an axis for latitude and longitude, a count of more than there are for the member axis
COUNTS = [("latitude", 2), ("longitude", 2), ("variable", 1), ("ensemble_member", 9), ("y_osgb", 3)]
BLOCKS_SQL = """blocks as (select grid, dim, length, case when count is null then case when length <= 8 or dim in ('init_time', 'step', 'variable') then 1 else length end when count between 1 and length then length // count end::int as block,
  case when count not between 1 and length then 'block count' end as rule from (select grid, dim, count(*) as length from tick group by 1, 2) left join (values ('latitude', 2), ('longitude', 2), ('variable', 1), ('ensemble_member', 9), ('y_osgb', 3)) c(dim, count) using (dim))"""


def blocks(spark, folder):
    sizes = a.shape(a.ticks(gridded(spark, folder), ("grid",)), "grid")
    counts = spark.createDataFrame(COUNTS, "dim string, count int")
    return s.block_sizes(sizes, sizes.select("grid").distinct().crossJoin(F.broadcast(counts)), "grid")


@query("select grid, dim, length, block, rule from blocks", *GRIDS, BLOCKS_SQL)
def block_sizes(spark, folder):
    return blocks(spark, folder).select("grid", "dim", "length", "block", "rule")


@query("select piece, r.dim, start, stop, block from region r join blocks b on b.grid = 'latlon' and b.dim = r.dim where start % block <> 0 or stop % block <> 0", *PIECES, GRIDS_SQL, GRID_TICKS_SQL, BLOCKS_SQL)
def misaligned_regions(spark, folder):
    return a.misaligned(regions(spark, folder).drop("rule"), blocks(spark, folder).where("grid = 'latlon'")).select("piece", "dim", "start", "stop", "block")
