"""Queries from raw fields to canonical cells."""

from pyspark.sql import functions as F

from ..functions import catalog
from ..operators import normalise as n
from ..sources import tables as t
from .registry import query

GFS = sorted(catalog.model("NCEP_GFS_1DEGREE")["variables"])
GFS_SQL = ", ".join(map(catalog.sql_value, GFS))


@query("""select event_id, alias, case alias when 't2m' then 'temperature_sl' when 'dswrf' then 'downward_shortwave_radiation_flux_gl' when 'tcc' then 'cloud_cover_total' when 'u10' then 'wind_u_component_10m' end as variable from field_ev""", t.FIELD_SQL)
def alias_lookup(spark, folder):
    return n.named(t.field_events(spark, folder)).select("event_id", "alias", "variable")


# some events come under a second name of their parameter; a file of a run that has both keeps the first name's
TWICE_SQL = """twice as (select f.* exclude (alias), variable, alias_ord, f.alias from (select * replace (case when alias = 't2m' and event_id % 50 = 0 then 'tas' when alias = 'u10' and event_id % 3 = 0 then 'uas' else alias end as alias) from field_ev) f join aliases using (alias)),
settled as (select *, min(alias_ord) over (partition by init_time, variable) as least, max(alias_ord) over (partition by init_time, variable) as most from twice)"""


@query(f"""select event_id, variable, value, null::varchar as rule, null::varchar as detail from settled where variable in ({GFS_SQL}) and alias_ord = least
  union all select null, null, null, 'several short names', variable || ': ' || string_agg(distinct alias, ', ' order by alias) from settled where least < most and variable in ({GFS_SQL}) group by init_time, variable""", t.FIELD_SQL, catalog.ALIAS_SQL, TWICE_SQL)
def rename_else_drop(spark, folder):
    name, e = F.col("alias"), F.col("event_id")
    fields = t.field_events(spark, folder).withColumn("alias", F.when((name == "t2m") & (e % 50 == 0), "tas").when((name == "u10") & (e % 3 == 0), "uas").otherwise(name))
    kept, said = n.settle_clashes(n.rename_else_drop(fields, GFS), ["init_time"])
    return kept.select("event_id", "variable", "value").unionByName(said.select("rule", "detail"), allowMissingColumns=True)


_NUMBERS = [192, 193, 194, 195, 1, 7, 0]


@query(f"""select l_orderkey, l_linenumber, l_suppkey, case when name <> 'unknown' then name else coalesce(case number {' '.join(f"when {k} then '{v}'" for k, v in n.UNKNOWN.items())} end, name) end as short_name
  from (select *, case when l_returnflag = 'R' then 'unknown' else 'tcc' end as name, {_NUMBERS}[l_linenumber] as number from lineitem)""")
def resolve_unknown(spark, folder):
    lines = t.table(spark, folder, "lineitem").withColumn("name", F.when(F.col("l_returnflag") == "R", "unknown").otherwise("tcc")).withColumn("number", F.try_element_at(F.array(*map(F.lit, _NUMBERS)), F.col("l_linenumber")))
    return lines.select("l_orderkey", "l_linenumber", "l_suppkey", n.resolve_unknown("name", "number").alias("short_name"))


_NAMES = ["tcc", "hcc", "u10", "v100", "sdswrf", "t", "sdwe", "prate", "vis", "r2"]
_KINDS = ["surface", "heightAboveGround", "highCloudLayer", "lowCloudLayer", "isobaric"]
_LEVELS = [0, 2, 10]


@query(f"""select min(event_id) as event_id, short_name, level, type_of_level, step_type, file from messages where (
  (short_name in ('tcc', 'hcc', 'lcc', 'mcc') and level = 0 and type_of_level in ('highCloudLayer', 'lowCloudLayer', 'middleCloudLayer', 'convectiveCloudLayer') and step_type = 'instant')
  or short_name in ('u10', 'v10', 'u100', 'v100') or (type_of_level in ('surface', 'heightAboveGround') and level in (0, 2) and step_type = 'instant')
  or (type_of_level = 'surface' and step_type = 'avg' and short_name in ('sdswrf', 'sdlwrf'))) and short_name not in ('t', 'sdwe') group by all""",
  f"messages as (select event_id, hour(ts) as file, {_NAMES}[(user_id % 10) + 1] as short_name, {_LEVELS}[(event_id % 3) + 1] as level, {_KINDS}[(event_id // 3 % 5) + 1] as type_of_level, case when event_id // 15 % 2 = 0 then 'instant' else 'avg' end as step_type from events)")
def message_filter(spark, folder):
    of = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))
    e = F.col("event_id")
    rows = t.table(spark, folder, "events").select(
        e, of(_NAMES, F.col("user_id") % 10).alias("short_name"), of(_LEVELS, e % 3).alias("level"), of(_KINDS, F.expr("event_id div 3 % 5")).alias("type_of_level"),
        F.when(F.expr("event_id div 15 % 2") == 0, "instant").otherwise("avg").alias("step_type"), F.hour("ts").cast("long").alias("file"),
    )
    return n.wanted_messages(rows, ["file", "short_name", "type_of_level", "level", "step_type"], "event_id")


CELL = ["init_time", "step", "alias", "lat_e4", "lon_e4"]


@query("select init_time, step, alias, lat_e4, lon_e4, min(event_id) as event_id, arg_min(value, event_id) as value from field_ev group by all", t.FIELD_SQL)
def merge_first_wins(spark, folder):
    return n.merge_first_wins(t.field_events(spark, folder), CELL, "event_id").select(*CELL, "event_id", "value")


@query("""select ix, alias, step, value from fld_li f where alias <> 't' or step = 1 or (select count(distinct step) from fld_li g where g.ix = f.ix and g.alias = f.alias) = 1""".replace("(select count(distinct step) from fld_li g where g.ix = f.ix and g.alias = f.alias) = 1", "(ix, alias) in (select (ix, alias) from fld_li group by ix, alias having min(step) = max(step))"), t.LINES_SQL)
def select_level(spark, folder):
    return n.select_level(t.field_lines(spark, folder), "ix", "alias", "step", ["t"]).select("ix", "alias", "step", "value")


@query("select event_id, step from field_ev where step <= 4", t.FIELD_SQL)
def step_cutoff(spark, folder):
    return n.step_cutoff(t.field_events(spark, folder), 4).select("event_id", "step")


@query("select l_orderkey, l_linenumber, variable, value from lineitem, lateral (values ('l_quantity', l_quantity), ('l_discount', l_discount), ('l_extendedprice', l_extendedprice)) as v(variable, value)")
def unpivot_vars(spark, folder):
    return n.unpivot(t.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_extendedprice"])


@query(f"""select init_time, step, variable, lat_e4, lon_e4, arg_min(value, event_id) as value from (
  select * replace ((((lon_e4 + 1800000) % 3600000 + 3600000) % 3600000 - 1800000)::int as lon_e4) from field_ev join aliases using (alias) where variable in ({GFS_SQL})) group by all""", t.FIELD_SQL, catalog.ALIAS_SQL)
def normalise_fields(spark, folder):
    return n.normalise_fields(t.field_events(spark, folder), GFS)


@query("select event_id, ((lon + 1800000) % 3600000 - 1800000)::int as lon_e4 from (select event_id, (user_id * 7 + event_id) % 361 * 10000 as lon from events)")
def wrap_longitude(spark, folder):
    lon = ((F.col("user_id") * 7 + F.col("event_id")) % 361 * 10000).cast("int")
    return t.table(spark, folder, "events").select("event_id", n.wrap_longitude(lon).cast("int").alias("lon_e4"))


@query("select event_id, (top - iy)::int as iy, ix from (select *, max(ix) over (partition by init_time) as edge, max(iy) over (partition by init_time) as top from field_ev) where ix < edge", t.FIELD_SQL)
def trim_tile_overlap(spark, folder):
    return n.trim_overlap(t.field_events(spark, folder)).select("event_id", "iy", "ix")


_STREAMS = ["enfo-em", "enfo-es", "enfo-pf", "oper-fc"]
NAMED_SQL = f"files as (select key, 'ecmwf_' || {_STREAMS}[(key % 4) + 1] || '_' || strftime(init_time, '%Y%m%dT%H') || '.grib' as name, (key % 50 + 1)::int as number from listed)"


def _files(spark, folder):
    name = F.concat(F.lit("ecmwf_"), F.element_at(F.array(*map(F.lit, _STREAMS)), (F.col("key") % 4 + 1).cast("int")), F.lit("_"), F.date_format("init_time", "yyyyMMdd'T'HH"), F.lit(".grib"))
    return t.listed_orders(spark, folder).select("key", name.alias("name"), (F.col("key") % 50 + 1).cast("int").alias("number"))


@query("select key, name, case when contains(name, 'enfo-es') then 'std' when contains(name, 'enfo-em') then 'mean' end as ensemble_stat from files", t.ORDERS_SQL, NAMED_SQL)
def tag_ensemble_stat(spark, folder):
    return _files(spark, folder).select("key", "name", n.stat_of(F.col("name")).alias("ensemble_stat"))


@query("select key, name, case when contains(name, 'enfo-pf') then number end as ensemble_member from files", t.ORDERS_SQL, NAMED_SQL)
def tag_ensemble_member(spark, folder):
    return _files(spark, folder).select("key", "name", n.member_of(F.col("name"), F.col("number")).alias("ensemble_member"))


@query("select vec_id, label, (pos // 8)::int as iy, pos % 8 as ix, value from flat", t.FLAT_SQL)
def unflatten_grid(spark, folder):
    flat = t.flat_vectors(spark, folder)
    return n.unflatten(flat, ["vec_id", "label"], "value", 8, 8)


RAW_CELLS_SQL = """kept as (select *, min(alias_ord) over (partition by file_name, variable) as least, max(alias_ord) over (partition by file_name, variable) as most from (
    select r.*, case when short_name = 'unknown' then case parameter_number when 194 then 'wdir' else 'unknown' end else short_name end as alias from raw r) join aliases using (alias) where variable in ('temperature_sl', 'wind_direction_10m', 'cloud_cover_total', 'visibility_sl')),
cells as (select init_time, step, variable, number as ensemble_member, ((pos - 1) // 8)::int as iy, ((pos - 1) % 8)::int as ix, arg_min(value[pos], dataset_no) as value from kept, generate_series(1, 64) g(pos) where alias_ord = least and len(value) = 64 group by all)"""


@query("""select init_time, step, variable, ensemble_member, iy, ix, (1223000 - 2000 * iy)::int as y, (-239000 + 2000 * ix)::int as x, value, null::varchar as url, null::varchar as rule from cells
  union all select null, null, null, null, null, null, null, null, null, file_name, 'several short names' from kept where least < most group by file_name, variable union all select null, null, null, null, null, null, null, null, null, file_name, 'size' from kept where alias_ord = least and len(value) <> 64""", t.RAW_SQL, catalog.ALIAS_SQL, RAW_CELLS_SQL)
def normalise_messages(spark, folder):
    """Decoded messages of many files to canonical cells on a metre grid, with what went wrong."""
    allowed = ["temperature_sl", "wind_direction_10m", "cloud_cover_total", "visibility_sl"]
    cells, said = n.normalise_messages(t.raw_messages(spark, folder), allowed, (1223000, -2000, 8), (-239000, 2000, 8))
    return cells.unionByName(said.select("url", "rule"), allowMissingColumns=True)


@query("""select vec_id, (7 - pos // 8)::int as iy, pos % 8 as ix, (700000 - 2000 * (7 - pos // 8))::int as y, (-576000 + 2000 * (pos % 8))::int as x, value, null::varchar as rule, null::varchar as detail from flat where vec_id % 7 > 0
  union all select vec_id, null, null, null, null, null, 'size', '7x8' from embeddings where vec_id % 7 = 0""", t.FLAT_SQL)
def assign_expected_grid(spark, folder):
    cells = n.unflatten(t.flat_vectors(spark, folder), ["vec_id"], "value", 8, 8).where("vec_id % 7 > 0 or iy < 7")  # every seventh grid lacks its last row
    placed, said = n.expected_grid(cells, "vec_id", (700000, -2000, 8), (-576000, 2000, 8))
    return placed.select("vec_id", "iy", "ix", "y", "x", "value").unionByName(said.select(F.col("url").cast("long").alias("vec_id"), "rule", "detail"), allowMissingColumns=True)


BOX = (600000, -36500, 500000, 80000)
SETS_SQL = f"sets as (select init_time, alias from field_ev group by 1, 2 having max(lat_e4) between {BOX[2]} and {BOX[0]} and max(lon_e4) between {BOX[1]} and {BOX[3]} and min(step) between 1 and 4)"


@query("select init_time, alias from sets", t.FIELD_SQL, SETS_SQL)
def relevant_datasets(spark, folder):
    return n.relevant(t.field_events(spark, folder), ["init_time", "alias"], BOX, (1, 4))


# a file's data sets are its aliases; which of them are wanted is that of the sets above; runs of different hours are of different kinds
WANTED_SQL = """marked as (select f.init_time, f.alias, ['global', 'ukv', 'realtime', 'gfs'][hour(f.init_time) // 6 + 1] as kind, s.alias is not null as kept from (select distinct init_time, alias from field_ev) f left join sets s using (init_time, alias))"""


@query("select init_time as run, kind as detail, 'convert' as stage, 'nothing relevant' as rule from marked group by 1, 2 having case kind when 'global' then count(*) > count(*) filter (where kept) when 'ukv' then false else count(*) filter (where kept) = 0 end", t.FIELD_SQL, SETS_SQL, WANTED_SQL)
def files_without_fields(spark, folder):
    fields = t.field_events(spark, folder)
    kept = n.relevant(fields, ["init_time", "alias"], BOX, (1, 4)).withColumn("_k", F.lit(True))
    kind = F.element_at(F.array(*map(F.lit, ["global", "ukv", "realtime", "gfs"])), (F.floor(F.hour("init_time") / 6) + 1).cast("int"))
    sets = fields.select("init_time", "alias").distinct().join(kept, ["init_time", "alias"], "left").select("init_time", F.date_format("init_time", "yyyyMMddHH").alias("url"), kind.alias("kind"), F.coalesce("_k", F.lit(False)).alias("kept"))
    return n.nothing_relevant(sets, "init_time", "url", "kept", "kind").select("run", "detail", "stage", "rule")


@query("select init_time, variable, count(*) as n_cells, min(step) as first_step, max(step) as last_step from field_ev join aliases using (alias) group by 1, 2", t.FIELD_SQL, catalog.ALIAS_SQL)
def pieces_per_variable(spark, folder):
    pieces = n.named(t.field_events(spark, folder)).where("variable is not null").groupBy("init_time", "variable")
    return pieces.agg(F.count("*").alias("n_cells"), F.min("step").alias("first_step"), F.max("step").alias("last_step"))


@query("select num, (row_number() over (order by num desc) - 1)::int as idx from (select distinct round_even(lat_e4 / 10000.0 + ix / 64.0, 4) as num from field_ev)", t.FIELD_SQL)
def canonical_axes(spark, folder):
    lat = t.field_events(spark, folder).select((F.col("lat_e4") / 10000.0 + F.col("ix") / 64.0).alias("lat"))
    return n.canonical_axis(lat, "lat", descending=True)
