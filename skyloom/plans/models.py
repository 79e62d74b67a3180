"""Queries over models and schedules, each held against the runs and cells of the tables."""

from pyspark.sql import functions as F

from ..functions import catalog
from ..operators import models as m
from ..operators import normalise as n
from ..sources import tables as t
from .registry import query

HOURS_SQL = "by_hour as (select hour(init_time) as hour, count(*) as n_runs from (select distinct init_time from field_ev) group by 1)"
GFS = catalog.model("NCEP_GFS_1DEGREE")


def by_hour(spark, folder):
    return m.run_hours_of(t.field_events(spark, folder).select("init_time").distinct())


# What the models are, written out again for the checks: key, name, hours, delay, number of steps, of variables, of statistics, members, grid, ny, nx.
MODEL_SQL = """models(model, name, hours, delay, n_steps, n_variables, n_stats, members, grid, ny, nx) as (values
  ('ECMWF_HRES_IFS_0P1DEGREE', 'hres-ifs', [0, 6, 12, 18], 1560, 85, 18, 0, 0, 'latlon', 1801, 3601), ('ECMWF_ENS_STAT_0P1DEGREE', 'ens-stat', [0, 12], 1560, 29, 4, 6, 0, 'latlon', 1800, 3600),
  ('ECMWF_ENS_0P1DEGREE', 'ens', [0, 6, 12, 18], 1560, 56, 6, 0, 50, 'latlon', 1800, 3600), ('NCEP_GFS_1DEGREE', 'ncep-gfs', [0, 6, 12, 18], 300, 16, 15, 0, 0, 'latlon', 181, 361),
  ('MO_UM_GLOBAL_17KM', 'um-global', [0, 6, 12, 18], 300, 48, 11, 0, 0, 'latlon', 1153, 1540), ('MO_UM_GLOBAL_10KM', 'um-global', [0, 12], 300, 55, 11, 0, 0, 'latlon', 1920, 2560),
  ('MO_UM_UKV_2KM_OSGB', 'um-ukv', [0, 6, 12, 18], 120, 49, 15, 0, 0, 'osgb', 704, 548), ('MO_UM_UKV_2KM_LAEA', 'um-ukv', [0, 3, 6, 9, 12, 15, 18, 21], 120, 43, 12, 0, 0, 'laea', 639, 455))"""


@query("""select model, name, delay, n_steps, n_variables, n_stats, members, ny, nx, case grid when 'latlon' then 'geodesic_ellipsiodal' when 'osgb' then 'transverse_mercator' else 'lambert_azimuthal_equal_area' end as crs,
  case grid when 'osgb' then 0.0 end::double as scale_factor, case grid when 'latlon' then null when 'osgb' then 49.0 else 54.9 end::double as origin, case grid when 'osgb' then 'scale factor 0 as given' end as flag,
  (select coalesce(sum(n_runs), 0) from by_hour where list_contains(hours, hour))::bigint as n_runs from models""", t.FIELD_SQL, HOURS_SQL, MODEL_SQL)
def model_catalog(spark, folder):
    models = catalog.models(spark)
    axes = m.model_axes(models).groupBy("model").pivot("dim", ["step", "variable", "ensemble_stat", "ensemble_member", "latitude", "longitude", "y_osgb", "x_osgb", "y_laea", "x_laea"]).agg(F.count("idx").cast("int"))
    counts = models.select("model", F.explode("hours").alias("hour")).join(by_hour(spark, folder), "hour").groupBy("model").agg(F.sum("n_runs").alias("n_runs"))
    of = lambda *c: F.coalesce(*c, F.lit(0))
    inside = lambda name: F.coalesce(*(F.get_json_object(m.crs_values("grid"), f"$.{kind}.{name}") for kind in ("transverse_mercator", "lambert_azimuthal_equal_area"))).cast("double")
    return models.join(axes, "model").join(counts, "model", "left").select(
        "model", "name", "delay", of("step").alias("n_steps"), of("variable").alias("n_variables"), of("ensemble_stat").alias("n_stats"), of("ensemble_member").alias("members"), of("latitude", "y_osgb", "y_laea").alias("ny"), of("longitude", "x_osgb", "x_laea").alias("nx"),
        m.crs_label("grid").alias("crs"), inside("scale_factor_at_central_meridian").alias("scale_factor"), inside("latitude_of_projection_origin").alias("origin"), m.crs_flag("grid").alias("flag"), of("n_runs").cast("long").alias("n_runs"),
    )


# the ticks that events could lie on: every model's latitudes and longitudes, or metres, by generating expressions
AXES_SQL = """axis_runs(model, dim, first, step, n, digits) as (values
  ('ECMWF_HRES_IFS_0P1DEGREE', 'latitude', 90.0, -0.1, 1801, 4), ('ECMWF_HRES_IFS_0P1DEGREE', 'longitude', -180.0, 0.1, 3601, 4), ('ECMWF_ENS_STAT_0P1DEGREE', 'latitude', 90.0, -0.1, 1800, 4), ('ECMWF_ENS_STAT_0P1DEGREE', 'longitude', -180.0, 0.1, 3600, 4),
  ('ECMWF_ENS_0P1DEGREE', 'latitude', 90.0, -0.1, 1800, 4), ('ECMWF_ENS_0P1DEGREE', 'longitude', -180.0, 0.1, 3600, 4), ('NCEP_GFS_1DEGREE', 'latitude', 90.0, -1.0, 181, 4), ('NCEP_GFS_1DEGREE', 'longitude', -180.0, 1.0, 361, 4),
  ('MO_UM_UKV_2KM_OSGB', 'y_osgb', 1223000.0, -2000.0, 704, 0), ('MO_UM_UKV_2KM_OSGB', 'x_osgb', -239000.0, 2000.0, 548, 0), ('MO_UM_UKV_2KM_LAEA', 'y_laea', 700000.0, -2000.0, 639, 0), ('MO_UM_UKV_2KM_LAEA', 'x_laea', -576000.0, 2000.0, 455, 0)),
model_ticks as (select model, dim, i::int as idx, round(first + step * i, 4)::double as num from axis_runs, generate_series(0, n - 1) as g(i))"""


@query("select model, dim, idx, num, (case dim when 'latitude' then (select count(*) from field_ev where lat_e4 = round(num * 10000)) when 'longitude' then (select count(*) from field_ev where lon_e4 = round(num * 10000)) else 0 end)::bigint as n_cells from model_ticks", t.FIELD_SQL, AXES_SQL)
def model_axes(spark, folder):
    """Every grid line of six models, with the cells that lie on it."""
    axes = m.model_axes(catalog.models(spark)).where(F.col("dim").isin("latitude", "longitude", "y_osgb", "x_osgb", "y_laea", "x_laea") & ~F.col("model").startswith("MO_UM_GLOBAL"))
    events = t.field_events(spark, folder)
    on = [events.groupBy(F.lit(d).alias("dim"), F.col(c).alias("e4")).agg(F.count("*").alias("c")) for d, c in (("latitude", "lat_e4"), ("longitude", "lon_e4"))]
    both = axes.withColumn("e4", F.round(F.col("num") * 10000).cast("long")).join(on[0].unionByName(on[1]), ["dim", "e4"], "left")
    return both.select("model", "dim", "idx", "num", F.coalesce("c", F.lit(0)).cast("long").alias("n_cells"))


# every model asked for every region, and for one that nobody knows
REGION_SQL = """boxes(region, north, west, south, east, suffix) as (values ('uk', 62, -12, 48, 3, 'uk'), ('uk-north60', 60, -12, 48, 3, 'uk'), ('india', 35, 67, 6, 97, 'india'), ('west-europe', 63, -12, 35, 26, 'west-europe'), ('nl', 54, 2, 50, 8, 'nl'), ('atlantis', null, null, null, null, null)),
grid_lines as (select * from model_ticks union all select 'MO_UM_GLOBAL_17KM', 'latitude', i::int, round(89.856 - 0.156 * i, 4) from generate_series(0, 1152) g(i) union all select 'MO_UM_GLOBAL_17KM', 'longitude', (k * 385 + i)::int, round(-45 + 90 * k + 0.234 * i, 4) from generate_series(0, 384) g(i), generate_series(0, 3) h(k)
  union all select 'MO_UM_GLOBAL_10KM', 'latitude', i::int, round(89.953125 - 0.09375 * i, 4) from generate_series(0, 1919) g(i) union all select 'MO_UM_GLOBAL_10KM', 'longitude', i::int, round(-179.929687 + 0.140625 * i, 4) from generate_series(0, 2559) g(i)),
asked as (select m.model, m.name, b.*, m.grid <> 'latlon' as metric from models m, boxes b)"""


@query("""select model, region, case when north is null or metric then name else name || '_' || suffix end as name, case when north is null or not metric then (select count(*) from grid_lines l where l.model = a.model and dim[1:1] in ('l', 'y') and dim not like 'lon%' and (a.north is null or num between south and north)) end::int as ny,
  case when north is null or not metric then (select count(*) from grid_lines l where l.model = a.model and (dim like 'lon%' or dim like 'x%') and (a.north is null or num between west and east)) end::int as nx,
  case when north is null then 'unknown region' when metric then 'no latitude or longitude' end as rule,
  (select count(*) from field_ev f where lat_e4 between a.south * 10000 and a.north * 10000 and lon_e4 between a.west * 10000 and a.east * 10000) as n_cells from asked a""", t.FIELD_SQL, MODEL_SQL, AXES_SQL, REGION_SQL)
def model_regions(spark, folder):
    boxes = catalog.regions(spark)
    asked = catalog.models(spark).select("model").crossJoin(F.broadcast(boxes.select("region").union(spark.createDataFrame([("atlantis",)], "region string"))))
    spots = t.field_events(spark, folder).groupBy("lat_e4", "lon_e4").agg(F.count("*").alias("c"))
    inside = spots.join(F.broadcast(boxes), F.col("lat_e4").between(F.col("south") * 10000, F.col("north") * 10000) & F.col("lon_e4").between(F.col("west") * 10000, F.col("east") * 10000))
    counts = inside.groupBy("region").agg(F.sum("c").alias("n_cells"))
    return m.named_regions(asked, catalog.models(spark), boxes).join(counts, "region", "left").select("model", "region", "name", "ny", "nx", "rule", F.coalesce("n_cells", F.lit(0)).cast("long").alias("n_cells"))


# what sources offer, written out again: source, name there, model, number of hours, delay, steps, variables, block counts, and those of dimensions it lacks
OFFERED_SQL = """offered(source, offered, model, own_hours, own_delay, extra, block_counts) as (values
  ('CEDA', 'default', 'MO_UM_GLOBAL_17KM', [0, 12], null, 0, 'latitude=8,longitude=8'), ('CEDA', 'mo-um-global', 'MO_UM_GLOBAL_17KM', [0, 12], null, 0, 'latitude=8,longitude=8'), ('CEDA', 'mo-um-ukv', 'MO_UM_UKV_2KM_OSGB', null, null, 0, ''),
  ('NOAA-GFS-S3', 'default', 'NCEP_GFS_1DEGREE', null, null, 0, ''), ('NOAA-GFS-S3', 'gfs-1deg', 'NCEP_GFS_1DEGREE', null, null, 0, ''),
  ('ECMWF-Realtime-S3', 'default', 'ECMWF_HRES_IFS_0P1DEGREE', null, 420, 0, ''), ('ECMWF-Realtime-S3', 'hres-ifs-uk', 'ECMWF_HRES_IFS_0P1DEGREE', null, 420, 0, ''), ('ECMWF-Realtime-S3', 'hres-ifs-india', 'ECMWF_HRES_IFS_0P1DEGREE', null, 420, 0, 'variable=1'), ('ECMWF-Realtime-S3', 'hres-ifs-nl', 'ECMWF_HRES_IFS_0P1DEGREE', null, 420, 0, ''),
  ('ECMWF-MARS', 'default', 'ECMWF_HRES_IFS_0P1DEGREE', null, null, 0, ''), ('ECMWF-MARS', 'hres-ifs-uk', 'ECMWF_HRES_IFS_0P1DEGREE', null, null, 0, ''), ('ECMWF-MARS', 'hres-ifs-india', 'ECMWF_HRES_IFS_0P1DEGREE', null, null, 0, ''), ('ECMWF-MARS', 'hres-ifs-west-europe', 'ECMWF_HRES_IFS_0P1DEGREE', null, null, 0, ''),
  ('ECMWF-MARS', 'ens-stat-india', 'ECMWF_ENS_STAT_0P1DEGREE', null, null, 0, ''), ('ECMWF-MARS', 'ens-stat-uk', 'ECMWF_ENS_STAT_0P1DEGREE', null, null, 0, ''), ('ECMWF-MARS', 'ens-uk', 'ECMWF_ENS_0P1DEGREE', null, null, 0, 'latitude=1,longitude=1'),
  ('MetOffice-Weather-Datahub', 'default', 'MO_UM_GLOBAL_10KM', null, null, 0, ''), ('MetOffice-Weather-Datahub', 'um-global-10km-india', 'MO_UM_GLOBAL_10KM', null, null, 0, ''), ('MetOffice-Weather-Datahub', 'um-global-10km-uk', 'MO_UM_GLOBAL_10KM', null, null, 0, ''),
  ('MetOffice-Weather-Datahub', 'um-global-10km-nl', 'MO_UM_GLOBAL_10KM', null, null, 1, ''), ('MetOffice-Weather-Datahub', 'um-ukv-2km', 'MO_UM_UKV_2KM_LAEA', null, null, 0, ''))"""


@query("""select source, offered, model, coalesce(own_delay, delay)::int as delay, array_to_string(coalesce(own_hours, hours), ',') as hours, (n_variables + extra)::int as n_variables, n_steps, block_counts, '' as idle_counts,
  (select coalesce(sum(n_runs), 0) from by_hour where list_contains(coalesce(own_hours, hours), hour))::bigint as n_runs, source in ('CEDA', 'ECMWF-MARS') as is_archive from offered join models using (model)""", t.FIELD_SQL, HOURS_SQL, MODEL_SQL, OFFERED_SQL)
def effective_models(spark, folder):
    found = m.effective(catalog.offered(spark), catalog.models(spark)).join(F.broadcast(catalog.sources(spark)), "source")
    counts = found.select("source", "offered", F.explode("hours").alias("hour")).join(by_hour(spark, folder), "hour").groupBy("source", "offered").agg(F.sum("n_runs").alias("n_runs"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    pairs = F.array_join(F.array_sort(F.transform(F.map_entries("block_counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ",")
    return found.join(counts, ["source", "offered"], "left").select("source", "offered", "model", "delay", text("hours").alias("hours"), F.size("variables").alias("n_variables"), "n_steps", pairs.alias("block_counts"), text("idle_counts").alias("idle_counts"), F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"), "is_archive")


@query("select month::timestamp as month, d + to_hours(h::int) as init_time from (select distinct date_trunc('month', o_orderdate) as month from orders), unnest(generate_series(month::timestamp, (last_day(month))::timestamp, interval 1 day)) as a(d), unnest([0, 6, 12, 18]) as b(h)")
def month_init_times(spark, folder):
    months = t.table(spark, folder, "orders").select(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")).distinct()
    return m.month_runs(months, GFS["hours"])


@query("""select event_id, list_max(list_filter([d, d + interval 6 hour, d + interval 12 hour, d + interval 18 hour, d - interval 24 hour, d - interval 18 hour, d - interval 12 hour, d - interval 6 hour], lambda c: c <= cut)) as init_time
  from (select event_id, date_trunc('hour', date_trunc('hour', ts) - interval 300 minute) as cut, date_trunc('day', date_trunc('hour', ts) - interval 300 minute)::timestamp as d from events)""")
def latest_init_time(spark, folder):
    return t.table(spark, folder, "events").select("event_id", m.latest_run(F.col("ts"), GFS["hours"], GFS["delay"]).alias("init_time"))


# the parameters, written out again: place, name, units, upper and lower limit, GRIB2 code, number of short names
CODES_SQL = """codes(ord, variable, units, upper, lower, grib2_code, n_aliases) as (values (0, 'temperature_sl', 'C', 60.0, -90.0, '167', 3), (1, 'downward_shortwave_radiation_flux_gl', 'W/m^2', 1500, 0, '169', 4), (2, 'downward_longwave_radiation_flux_gl', 'W/m^2', 500, 0, '175', 3), (3, 'relative_humidity_sl', '%', 100, 0, '157', 2),
  (4, 'visibility_sl', 'm', 4500, 0, '20', 1), (5, 'wind_u_component_10m', 'm/s', 100, -100, '165', 3), (6, 'wind_v_component_10m', 'm/s', 100, -100, '166', 3), (7, 'wind_u_component_100m', 'm/s', 100, -100, '246', 1), (8, 'wind_v_component_100m', 'm/s', 100, -100, '247', 1), (9, 'wind_u_component_200m', 'm/s', 150, -150, '239', 1),
  (10, 'wind_v_component_200m', 'm/s', 150, -150, '240', 1), (11, 'snow_depth_gl', 'm', 12, 0, '141', 3), (12, 'cloud_cover_high', 'UI', 1, 0, '188', 1), (13, 'cloud_cover_medium', 'UI', 1, 0, '187', 1), (14, 'cloud_cover_low', 'UI', 1, 0, '186', 1), (15, 'cloud_cover_total', 'UI', 1, 0, '164', 2),
  (16, 'total_precipitation_rate_gl', 'kg/m^2/s', 0.2, 0, '260048', 3), (17, 'downward_ultraviolet_radiation_flux_gl', 'W/m^2', 1000, 0, '57', 1), (18, 'direct_shortwave_radiation_flux_gl', 'W/m^2', 1000, 0, '47', 1), (19, 'wind_speed_10m', 'm/s', 150, 0, '207', 2), (20, 'wind_speed_100m', 'm/s', 200, 0, '249', 2),
  (21, 'wind_direction_10m', 'degrees', 0, 360, '194', 3), (22, 'pressure_msl', 'Pa', 105000, 95000, '151', 3))"""


@query("""select ord, variable, units, upper::double as upper, lower::double as lower, grib2_code, n_aliases, true as described, coalesce(n, 0) as n_cells from codes left join (select case alias when 't2m' then 'temperature_sl' when 'dswrf' then 'downward_shortwave_radiation_flux_gl' when 'tcc' then 'cloud_cover_total' else 'wind_u_component_10m' end as variable, count(*) as n
  from field_ev where alias <> 'junk' group by 1) c using (variable)""", t.FIELD_SQL, CODES_SQL)
def parameter_catalog(spark, folder):
    used = n.named(t.field_events(spark, folder)).where("variable is not null").groupBy("variable").agg(F.count("*").alias("n_cells"))
    return catalog.parameters(spark).join(used, "variable", "left").select("ord", "variable", "units", "upper", "lower", "grib2_code", F.size("aliases").alias("n_aliases"), (F.length("description") > 0).alias("described"), F.coalesce("n_cells", F.lit(0)).alias("n_cells"))
