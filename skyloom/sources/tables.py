"""Reading: tables of a folder, decoded fields, and views that read the event and order tables as forecast data."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a decoder returns for each message of a raw file.
MESSAGES = "file_name string, dataset_no int, short_name string, parameter_number int, type_of_level string, level int, step_type string, time timestamp_ntz, step int, number int, ny int, nx int, lat_first int, lon_first int, value array<float>"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_fields(spark: SparkSession, path: str, decode: Callable[[Iterator], Iterator] | None = None, schema: str = MESSAGES) -> DataFrame:
    """Decoded messages of many raw files: Parquet that has them, or any files through the user's decoder.

    decode takes and yields pandas frames, of (path, content) rows and of rows in `schema`; files are read in parallel,
    each whole by one task, as raw formats ask for.
    """
    if decode is None:
        return spark.read.parquet(path)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInPandas(decode, schema)


def hours(n: Column | int) -> Column:
    return F.make_dt_interval(F.lit(0), n if isinstance(n, Column) else F.lit(n))


def field_events(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse forecast cells: one run every 6 hours, steps 0 to 5, aliases of four variables and an unknown one."""
    e = table(spark, folder, "events")
    return e.select(
        F.window("ts", "6 hours").start.cast("timestamp_ntz").alias("init_time"), (F.hour("ts") % 6).cast("int").alias("step"),
        F.when(F.col("event_type") == "click", "t2m").when(F.col("event_type") == "error", "dswrf").when(F.col("event_type") == "purchase", "tcc").when(F.col("event_type") == "signup", "u10").otherwise("junk").alias("alias"),
        (600000 - (F.col("user_id") % 10) * 1000).cast("int").alias("lat_e4"), (-50000 + F.expr("user_id div 10") * 1000).cast("int").alias("lon_e4"),
        (F.col("user_id") % 10).cast("int").alias("iy"), F.expr("user_id div 10").cast("int").alias("ix"), "value", "event_id", "user_id",
    )


def field_files(spark: SparkSession, folder: str) -> DataFrame:
    """Raw fields of many files, one for each run and user: what a fetch of these runs gives."""
    e = field_events(spark, folder)
    return e.select("init_time", F.concat(F.date_format("init_time", "yyyyMMddHH"), F.lit("/"), "user_id").alias("url"), F.col("event_id").alias("dataset_no"), "alias", "step", "lat_e4", "lon_e4", "value")


FIELD_SQL = """field_ev as (select time_bucket(interval '6 hours', ts) as init_time, (hour(ts) % 6)::int as step,
  case event_type when 'click' then 't2m' when 'error' then 'dswrf' when 'purchase' then 'tcc' when 'signup' then 'u10' else 'junk' end as alias,
  (600000 - (user_id % 10) * 1000)::int as lat_e4, (-50000 + (user_id // 10) * 1000)::int as lon_e4,
  (user_id % 10)::int as iy, (user_id // 10)::int as ix, value, event_id, user_id from events)"""


def flat_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Dense 8 x 8 images as flat vectors with gaps: (vec_id, label, value array<float>)."""
    gap = lambda x, i: F.when((F.col("vec_id") % 5 == 0) & ((F.col("vec_id") * 64 + i) % 17 == 0), F.lit(None)).otherwise(x)
    return table(spark, folder, "embeddings").select("vec_id", "label", F.transform("embedding", gap).alias("value"))


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded messages as MESSAGES has them: 8 x 8 images of vectors, eight to a file, some under an unknown name or of a wrong size."""
    e, short = table(spark, folder, "embeddings"), F.array(*map(F.lit, ["t2m", "tas", "unknown", "tcc", "vis", "prate"]))
    return e.select(
        F.concat(F.lit("enfo-pf_"), F.expr("vec_id div 8").cast("string")).alias("file_name"), (F.col("vec_id") % 8).cast("int").alias("dataset_no"),
        F.element_at(short, (F.col("label") % 6 + 1).cast("int")).alias("short_name"), F.when(F.col("vec_id") % 2 == 0, 194).otherwise(7).alias("parameter_number"), F.lit("surface").alias("type_of_level"), F.lit(0).alias("level"),
        F.lit("instant").alias("step_type"), (F.lit("2024-01-01").cast("timestamp_ntz") + hours(F.expr("vec_id div 64").cast("int"))).alias("time"), F.when(F.col("vec_id") % 3 > 0, (F.col("vec_id") % 3).cast("int")).alias("step"),
        (F.expr("vec_id div 8") % 8).cast("int").alias("number"), F.lit(8).alias("ny"), F.lit(8).alias("nx"), F.lit(0).alias("lat_first"), F.lit(0).alias("lon_first"),
        F.when(F.col("vec_id") % 29 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")).alias("value"),
    )


RAW_SQL = """raw as (select vec_id, 'enfo-pf_' || (vec_id // 8) as file_name, (vec_id % 8)::int as dataset_no, ['t2m', 'tas', 'unknown', 'tcc', 'vis', 'prate'][(label % 6) + 1] as short_name,
  case when vec_id % 2 = 0 then 194 else 7 end as parameter_number, timestamp '2024-01-01' + to_hours((vec_id // 64)::int) as init_time, (vec_id % 3)::int as step, (vec_id // 8 % 8)::int as number,
  case when vec_id % 29 = 0 then embedding[1:63] else embedding end as value from embeddings)"""

FLAT_SQL = """flat as (select vec_id, label, (pos - 1)::int as pos,
  case when vec_id % 5 = 0 and (vec_id * 64 + pos - 1) % 17 = 0 then null else embedding[pos] end as value
  from embeddings, unnest(generate_series(1, len(embedding))) as g(pos))"""


def field_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The large field table: a cell for each line item."""
    flag = F.col("l_returnflag")
    return table(spark, folder, "lineitem").select(
        F.col("l_shipdate").alias("init_time"), F.col("l_linenumber").alias("step"), F.col("l_suppkey").cast("int").alias("ix"), "l_orderkey", F.col("l_returnflag").alias("flag"),
        (F.lit(600000) - (F.col("l_orderkey") % 3) * 1000).cast("int").alias("lat_e4"), ((F.col("l_suppkey") % 5) * 1000).cast("int").alias("lon_e4"),
        F.when(flag == "A", "tcc").when(flag == "N", "t").otherwise("vis").alias("alias"),
        F.when(flag == "A", F.col("l_discount") * 12).when(flag == "N", F.col("l_quantity") * 1.5).otherwise(F.col("l_extendedprice")).alias("value"),
    )


def line_files(spark: SparkSession, folder: str) -> DataFrame:
    """Raw fields of the line items, a file for each run and order."""
    file = F.concat(F.date_format("init_time", "yyyyMMddHH"), F.lit("/"), F.col("l_orderkey").cast("string"))
    return field_lines(spark, folder).select(F.col("init_time").cast("timestamp_ntz").alias("init_time"), file.alias("url"), (F.col("l_orderkey") * 8 + F.col("step")).alias("dataset_no"), "alias", F.col("step").cast("int").alias("step"), "lat_e4", "lon_e4", F.col("value").cast("double").alias("value"))


LINES_SQL = """fld_li as (select l_shipdate as init_time, l_linenumber as step, l_suppkey::int as ix, l_orderkey, l_returnflag as flag,
  (600000 - (l_orderkey % 3) * 1000)::int as lat_e4, ((l_suppkey % 5) * 1000)::int as lon_e4,
  case l_returnflag when 'A' then 'tcc' when 'N' then 't' else 'vis' end as alias,
  case l_returnflag when 'A' then l_discount * 12 when 'N' then l_quantity * 1.5 else l_extendedprice end as value from lineitem)"""


def listed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """File listings in two naming styles, of runs at the order dates: (key, init_time, gfs_name, ecmwf_name, remote_bytes)."""
    key = F.col("o_orderkey")
    stamp = lambda t: F.date_format(t, "MMddHHmm")
    return table(spark, folder, "orders").select(
        key.alias("key"), F.col("o_orderdate").alias("init_time"), (F.col("o_totalprice")).cast("long").alias("remote_bytes"),
        F.concat(F.format_string("gfs.t%02dz.pgrb2.1p00.f%03d", key % 24, key % 60), F.when(key % 7 == 0, ".nc").otherwise("")).alias("gfs_name"),
        F.concat(F.when(key % 2 == 0, "A2D").otherwise("A2S"), stamp("o_orderdate"), stamp(F.col("o_orderdate") + hours((key % 120).cast("int"))), F.lit("1")).alias("ecmwf_name"),
    )


ORDERS_SQL = """listed as (select o_orderkey as key, o_orderdate as init_time, trunc(o_totalprice)::bigint as remote_bytes,
  printf('gfs.t%02dz.pgrb2.1p00.f%03d', o_orderkey % 24, o_orderkey % 60) || case when o_orderkey % 7 = 0 then '.nc' else '' end as gfs_name,
  case when o_orderkey % 2 = 0 then 'A2D' else 'A2S' end || strftime(o_orderdate, '%m%d%H%M')
    || strftime(o_orderdate + to_hours((o_orderkey % 120)::int), '%m%d%H%M') || '1' as ecmwf_name from orders)"""


def json_listings(spark: SparkSession, folder: str) -> DataFrame:
    """One listing in JSON for each user: (user_id, body)."""
    k = F.get_json_object("props", "$.k").cast("int")
    one = F.concat(F.lit('{"fileId":"'), "event_type", F.lit("_"), k.cast("string"), F.when(F.col("event_id") % 11 == 0, "_+").otherwise(""), F.lit("_"), F.col("event_id").cast("string"), F.lit('"}'))
    rows = table(spark, folder, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", one.alias("f")))).alias("files"))
    return rows.select("user_id", F.concat(F.lit('{"orderDetails":{"files":['), F.array_join(F.transform("files", lambda x: x["f"]), ","), F.lit("]}}")).alias("body"))


def cached_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files already on disk, from the first line of each order: (key, length)."""
    first = table(spark, folder, "lineitem").where("l_linenumber = 1")
    return first.groupBy(F.col("l_orderkey").alias("key")).agg(F.max(F.when(F.col("l_returnflag") == "A", 0).otherwise(F.col("l_extendedprice"))).cast("long").alias("length"))


CACHE_SQL = """cached as (select l_orderkey as key, trunc(max(case when l_returnflag = 'A' then 0 else l_extendedprice end))::bigint as length
  from lineitem where l_linenumber = 1 group by 1)"""
