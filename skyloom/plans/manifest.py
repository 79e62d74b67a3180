"""Queries over listings and manifests."""

from pyspark.sql import functions as F

from ..functions import catalog
from ..operators import manifest as m
from ..operators.errors import together
from ..sources import landing, storage
from ..sources import tables as t
from .registry import query

STEPS = m.gfs_steps()
RUNS_SQL = "runs as (select distinct init_time from field_ev)"


@query(f"select key, gfs_name from listed where try_cast(nullif(regexp_extract(gfs_name, '^gfs\\.t(\\d{{2}})z\\.pgrb2\\.1p00\\.f(\\d{{3}})$', 1), '') as int) = 6 and try_cast(nullif(regexp_extract(gfs_name, '^gfs\\.t(\\d{{2}})z\\.pgrb2\\.1p00\\.f(\\d{{3}})$', 2), '') as int) in ({', '.join(map(str, STEPS))})", t.ORDERS_SQL)
def gfs_wanted_files(spark, folder):
    return m.gfs_wanted(t.listed_orders(spark, folder), "gfs_name", 6, STEPS).select("key", "gfs_name")


@query("""select key, ecmwf_name from (select *, try_strptime(strftime(init_time, '%Y') || substr(ecmwf_name, 12, 8), '%Y%m%d%H%M') as near,
  try_strptime((year(init_time) + 1)::varchar || substr(ecmwf_name, 12, 8), '%Y%m%d%H%M') as far from listed)
  where substr(ecmwf_name, 4, 8) = strftime(init_time, '%m%d%H%M') and (case when near < init_time then far else near end) <= init_time + interval 84 hour""", t.ORDERS_SQL)
def ecmwf_wanted_files(spark, folder):
    return m.ecmwf_wanted(t.listed_orders(spark, folder), "ecmwf_name", "init_time", 84).select("key", "ecmwf_name")


@query("select init_time, 'gfs.' || strftime(init_time, '%Y%m%d/%H') || '/atmos' as path from runs", t.FIELD_SQL, RUNS_SQL)
def gfs_manifest_paths(spark, folder):
    return m.runs_of(t.field_events(spark, folder)).select("init_time", m.gfs_folder("init_time").alias("path"))


@query("""select init_time, '/global-grib/' || strftime(init_time, '%Y/%m/%d/%Y%m%d%H') || '_WSGlobal17km_' || stub || '_Area' || chr(64 + area::int) || '_000144.grib' as url from runs, generate_series(1, 8) as a(area),
  (values ('Total_Downward_Surface_SW_Flux'), ('high_cloud_amount'), ('low_cloud_amount'), ('medium_cloud_amount'), ('relative_humidity_1_5m'), ('snow_depth'), ('temperature_1_5m'), ('visibility_1_5m'), ('wind_u_10m'), ('wind_v_10m')) as b(stub)""", t.FIELD_SQL, RUNS_SQL)
def area_manifest(spark, folder):
    return m.area_manifest(m.runs_of(t.field_events(spark, folder)))


@query("""select init_time, '/ukv-grib/' || strftime(init_time, '%Y/%m/%d/%Y%m%d%H%M') || '_u1096_ng_umqv_Wholesale' || n || late || '.grib' as url from runs, (values ('1'), ('2')) as a(n), (values (''), ('T54')) as b(late)""", t.FIELD_SQL, RUNS_SQL)
def ukv_manifest(spark, folder):
    return m.ukv_manifest(m.runs_of(t.field_events(spark, folder)))


@query("""select user_id, file_id, '/orders/latest/' || file_id || '/data' as url from (
  select user_id, event_type || '_' || json_extract_string(props, '$.k') || case when event_id % 11 = 0 then '_+' else '' end || '_' || event_id as file_id from events) where not contains(file_id, '+')""")
def order_files(spark, folder):
    return m.order_files(t.json_listings(spark, folder), "user_id", "body")


def _kind(hour):
    return F.when(hour == 0, "stat").when(hour == 12, "member").otherwise("plain")


@query("""select init_time, params, steps, printf('%.1f/%.1f/%.1f/%.1f', n / 10000.0, w / 10000.0, s / 10000.0, e / 10000.0) as area, stream, field_type,
  case when kind = 'member' then array_to_string(list_transform(generate_series(1, 50), lambda i: i::varchar), '/') end as number,
  'ecmwf_' || stream || '-' || field_type || '_' || strftime(init_time, '%Y%m%dT%H') || '.grib' as filename
  from (select *, case when kind = 'plain' then 'oper' else 'enfo' end as stream, unnest(case kind when 'stat' then ['em', 'es'] when 'member' then ['pf'] else ['fc'] end) as field_type from (
    select init_time, case hour(init_time) when 0 then 'stat' when 12 then 'member' else 'plain' end as kind, string_agg(distinct grib2_code, '/' order by grib2_code) as params,
      array_to_string(list_transform(list_sort(list(distinct step)), lambda x: x::varchar), '/') as steps, max(lat_e4) as n, min(lon_e4) as w, min(lat_e4) as s, max(lon_e4) as e
    from field_ev join aliases using (alias) join params using (variable) group by 1, 2))""", t.FIELD_SQL, catalog.ALIAS_SQL, catalog.PARAMETER_SQL)
def archive_requests(spark, folder):
    names = catalog.aliases(spark).join(catalog.parameters(spark).select("variable", F.col("grib2_code").alias("code")), "variable").select("alias", "code")
    cells = t.field_events(spark, folder).join(F.broadcast(names), "alias").withColumn("kind", _kind(F.hour("init_time")))
    return m.archive_requests(cells)


_SOURCES = [s[0] for s in catalog.SOURCES]
SOURCE_SQL = "sourced as (select *, case key % 5 when 0 then 'CEDA' when 1 then 'NOAA-GFS-S3' when 2 then 'ECMWF-Realtime-S3' when 3 then 'ECMWF-MARS' else 'MetOffice-Weather-Datahub' end as source from listed)"


def _sourced(spark, folder):
    source = F.element_at(F.array(*map(F.lit, _SOURCES)), (F.col("key") % 5 + 1).cast("int"))
    return t.listed_orders(spark, folder).withColumn("source", source)


@query("select key, source, gfs_name, remote_bytes from sourced s where not exists (select 1 from cached where cached.key = s.key and (length > 0 or source not in ('ECMWF-Realtime-S3', 'MetOffice-Weather-Datahub')))", t.ORDERS_SQL, t.CACHE_SQL, SOURCE_SQL)
def files_to_fetch(spark, folder):
    return m.to_fetch(_sourced(spark, folder), t.cached_files(spark, folder)).select("key", "source", "gfs_name", "remote_bytes")


@query("select key, remote_bytes, length from listed join cached using (key) where case when key % 2 = 0 then length <> remote_bytes else length < remote_bytes end", t.ORDERS_SQL, t.CACHE_SQL)
def size_mismatches(spark, folder):
    return m.size_mismatches(t.listed_orders(spark, folder).withColumn("exact", F.col("key") % 2 == 0), t.cached_files(spark, folder))


@query("""select key, source, 'raw/' || source || '/' || model || '/raw/' || case source when 'NOAA-GFS-S3' then strftime(init_time, '%Y/%m/%d/%H') || '/' || gfs_name || '.grib' when 'MetOffice-Weather-Datahub' then key || '.grib'
  when 'ECMWF-Realtime-S3' then left(gfs_name, length(gfs_name) - strpos(reverse(gfs_name), '.')::int) || '.grib' else gfs_name end as path
  from (select *, case when key % 2 = 0 then 'um-global' else 'hres-ifs_uk' end as model from sourced)""", t.ORDERS_SQL, SOURCE_SQL)
def raw_paths(spark, folder):
    rows = _sourced(spark, folder).withColumn("url", F.concat(F.lit("s3://files/"), F.col("key").cast("string"), F.lit("/"), F.col("gfs_name")))
    rows = rows.withColumn("model", F.when(F.col("key") % 2 == 0, "um-global").otherwise("hres-ifs_uk"))
    return rows.select("key", "source", m.raw_path("source", "model", "url", "init_time").alias("path"))


@query("select 'enfo-pf_' || (vec_id // 8) as file_name, (vec_id % 8)::int as dataset_no, short_name, init_time as time, len(value)::int as n, round(list_sum(value::double[]), 3) + 0.0 as total from raw", t.RAW_SQL)
def read_fields(spark, folder):
    """Lands messages as raw files of a binary format, one for each task, and reads these through a decoder."""

    def decode(frames):
        import io

        import pyarrow.parquet as pq

        for frame in frames:
            for content in frame["content"]:
                yield pq.read_table(io.BytesIO(content)).to_pandas()

    messages = t.raw_messages(spark, folder)
    landing = storage.new_path(spark, "raw")
    messages.repartition(16, "file_name").write.parquet(landing)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in messages.schema)
    rows = t.read_fields(spark, landing, decode, kinds)
    total = F.aggregate("value", F.lit(0.0), lambda x, v: x + v.cast("double"))
    return rows.select("file_name", "dataset_no", "short_name", "time", F.size("value").alias("n"), (F.round(total, 3) + 0.0).alias("total"))


URL_SQL = "urls as (select key, ['/global-grib/', '/ukv-grib/', '/other/'][(key % 3) + 1] || gfs_name as url from listed)"


def _urls(spark, folder):
    place = F.element_at(F.array(F.lit("/global-grib/"), F.lit("/ukv-grib/"), F.lit("/other/")), (F.col("key") % 3 + 1).cast("int"))
    return t.listed_orders(spark, folder).select("key", F.concat(place, "gfs_name").alias("url"))


@query("""select key, case when contains(url, 'global-grib') then 'global' when contains(url, 'ukv-grib') then 'ukv' else 'error' end as kind
  from urls""", t.ORDERS_SQL, URL_SQL)
def route_kind(spark, folder):
    return _urls(spark, folder).select("key", m.route("url").alias("kind"))


NO_FILES_SQL = "select distinct init_time from fld_li where init_time not in (select init_time from listed where init_time is not null)"


@query(f"select init_time as run, 'listing' as stage, 'no files' as rule from ({NO_FILES_SQL})", t.LINES_SQL, t.ORDERS_SQL)
def runs_without_files(spark, folder):
    return m.runs_without_files(m.runs_of(t.field_lines(spark, folder)), t.listed_orders(spark, folder)).select("run", "stage", "rule")


@query(f"select init_time as run, null::varchar as url, 'listing' as stage, 'no files' as rule, null::varchar as detail from ({NO_FILES_SQL}) union all select null, url, 'convert', 'unknown kind', null from urls where contains(url, '/other/')", t.LINES_SQL, t.ORDERS_SQL, URL_SQL)
def ingest_errors(spark, folder):
    return together(m.runs_without_files(m.runs_of(t.field_lines(spark, folder)), t.listed_orders(spark, folder)), m.unknown_kinds(_urls(spark, folder), "url"))


# raw files of each run and kind of event, landed as lines of text, perhaps in parts: one day's don't land, and another day's lack the lines of odd events
LANDED_SQL = """landed as (select init_time, strftime(init_time, '%Y%m%d%H') || '/' || alias as url, sum(length(event_id::varchar) + 1)::bigint as remote_bytes,
  (sum(length(event_id::varchar) + 1) filter (where day(init_time) <> 3 and not (day(init_time) = 6 and event_id % 2 = 1)))::bigint as length from field_ev group by 1, 2)"""


@query("""select init_time as run, url, 'fetch' as stage, case when length is null then 'missing' else 'size' end as rule, length::varchar || ' of ' || remote_bytes::varchar as detail from landed where length is null or length <> remote_bytes
  union all select null, 'file=' || replace(url, '/', '-'), 'listing', 'no such folder', 'file=' || replace(url, '/', '-') from landed where length is null""", t.FIELD_SQL, LANDED_SQL)
def landed_errors(spark, folder):
    """Lands files, lists what is there, and tells what a fetch left undone; no file is opened to tell."""
    events = t.field_events(spark, folder).withColumn("url", F.concat(F.date_format("init_time", "yyyyMMddHH"), F.lit("/"), "alias"))
    day, line, place = F.dayofmonth("init_time"), F.col("event_id").cast("string"), F.regexp_replace("url", "/", "-")
    root = storage.new_path(spark, "landing")
    events.where((day != 3) & ~((day == 6) & (F.col("event_id") % 2 == 1))).select(place.alias("file"), line.alias("value")).repartition("file").write.partitionBy("file").text(root)
    wanted = events.groupBy("init_time", "url").agg(F.sum(F.length(line) + 1).alias("remote_bytes"))
    files, said = landing.listing(wanted.select(F.concat(F.lit("file="), place).alias("prefix")), root, ".txt")
    there = landing.by_folder(files, F.regexp_replace(F.element_at(F.split("folder", "="), -1), "-", "/"))
    manifest = wanted.select("init_time", F.col("url").alias("key"), "url", F.lit("ECMWF-Realtime-S3").alias("source"), "remote_bytes", F.lit(True).alias("exact"))
    return together(m.fetch_errors(manifest, there, "init_time", "url"), said)
