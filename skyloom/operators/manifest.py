"""Which files of which runs are wanted, where they go, and which are still missing. All work on whole listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import catalog
from ..sources.tables import hours
from .errors import errors

# Pieces of file names in the archive of the global and the UKV model.
GLOBAL_STUBS = ["Total_Downward_Surface_SW_Flux", "high_cloud_amount", "low_cloud_amount", "medium_cloud_amount", "relative_humidity_1_5m", "snow_depth", "temperature_1_5m", "visibility_1_5m", "wind_u_10m", "wind_v_10m"]
AREAS = ["AreaA", "AreaB", "AreaC", "AreaD", "AreaE", "AreaF", "AreaG", "AreaH"]
UKV_STUBS = ["Wholesale1.grib", "Wholesale1T54.grib", "Wholesale2.grib", "Wholesale2T54.grib"]


def gfs_wanted(listing: DataFrame, name: str, run_hour: Column | int, steps: list[int]) -> DataFrame:
    """Names `gfs.tHHz.pgrb2.1p00.fSSS` of the run's hour whose step is one of `steps`; the whole name must match."""
    pattern = r"^gfs\.t(\d{2})z\.pgrb2\.1p00\.f(\d{3})$"
    part = lambda i: F.regexp_extract(name, pattern, i).try_cast("int")
    return listing.where((part(1) == run_hour) & part(2).isin(steps))


def ecmwf_wanted(listing: DataFrame, name: str, run: str, last_step: int, prefix: str = "A2") -> DataFrame:
    """Names prefix + D or S + start + target + digit whose start is the run and whose target is at most last_step hours on.

    Months have no year: a target before the start belongs to the next year, so that runs at the end of December are judged like others.
    """
    pattern = rf"^{prefix}[DS](\d{{8}})(\d{{2}})(\d{{2}})(\d{{2}})(\d{{2}})\d$"
    part = lambda i: F.regexp_extract(name, pattern, i).try_cast("int")
    target = lambda year: F.try_make_timestamp_ntz(year, part(2), part(3), part(4), part(5), F.lit(0))
    near = target(F.year(run))
    rolled = F.when(near < F.col(run), target(F.year(run) + 1)).otherwise(near)
    return listing.where((F.regexp_extract(name, pattern, 1) == F.date_format(run, "MMddHHmm")) & (rolled <= F.col(run) + hours(last_step)))


def gfs_folder(run: str) -> Column:
    return F.concat(F.lit("gfs."), F.date_format(run, "yyyyMMdd"), F.lit("/"), F.date_format(run, "HH"), F.lit("/atmos"))


def area_manifest(runs: DataFrame, run: str = "init_time", base: str = "") -> DataFrame:
    """One URL for each run, parameter and area of the global archive."""
    each = runs.withColumn("stub", F.explode(F.array(*map(F.lit, GLOBAL_STUBS)))).withColumn("area", F.explode(F.array(*map(F.lit, AREAS))))
    return each.select(run, F.concat(F.lit(f"{base}/global-grib/"), F.date_format(run, "yyyy/MM/dd"), F.lit("/"), F.date_format(run, "yyyyMMddHH"), F.lit("_WSGlobal17km_"), "stub", F.lit("_"), "area", F.lit("_000144.grib")).alias("url"))


def ukv_manifest(runs: DataFrame, run: str = "init_time", base: str = "") -> DataFrame:
    each = runs.withColumn("stub", F.explode(F.array(*map(F.lit, UKV_STUBS))))
    return each.select(run, F.concat(F.lit(f"{base}/ukv-grib/"), F.date_format(run, "yyyy/MM/dd"), F.lit("/"), F.date_format(run, "yyyyMMddHHmm"), F.lit("_u1096_ng_umqv_"), "stub").alias("url"))


def order_files(listings: DataFrame, key: str, body: str, base: str = "/orders/latest/") -> DataFrame:
    """File ids at orderDetails.files of each listing that hold no '+', and their URLs. A listing without the path gives no rows."""
    parsed = F.from_json(body, "orderDetails struct<files: array<struct<fileId: string>>>")
    ids = listings.select(key, F.explode(parsed["orderDetails"]["files"]["fileId"]).alias("file_id"))
    ids = ids.where(F.col("file_id").isNotNull() & ~F.contains("file_id", F.lit("+")))
    return ids.select(key, "file_id", F.concat(F.lit(base), "file_id", F.lit("/data")).alias("url"))


def archive_requests(cells: DataFrame, run: str = "init_time") -> DataFrame:
    """Request rows of each run from its cells (init_time, code, step, north, west, south, east, members, stats).

    Runs of statistics ask for means and for deviations, runs with members for those, others for the plain forecast. Runs
    of several kinds get no request (see mixed_kinds).
    """
    lists = cells.groupBy(run).agg(
        F.array_join(F.array_sort(F.collect_set("code")), "/").alias("params"), F.array_join(F.transform(F.sort_array(F.collect_set("step")), lambda s: s.cast("string")), "/").alias("steps"),
        F.max("lat_e4").alias("n"), F.min("lon_e4").alias("w"), F.min("lat_e4").alias("s"), F.max("lon_e4").alias("e"), F.min("kind").alias("kind"), F.max("kind").alias("_other"),
    ).where(F.col("kind").eqNullSafe(F.col("_other")))
    types = F.when(F.col("kind") == "stat", F.array(F.lit("em"), F.lit("es"))).when(F.col("kind") == "member", F.array(F.lit("pf"))).otherwise(F.array(F.lit("fc")))
    rows = lists.withColumn("field_type", F.explode(types)).withColumn("stream", F.when(F.col("kind") == "plain", "oper").otherwise("enfo"))
    area = F.format_string("%.1f/%.1f/%.1f/%.1f", *(F.col(c) / 10000.0 for c in "nwse"))
    number = F.when(F.col("kind") == "member", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: i.cast("string")), "/"))
    name = F.concat(F.lit("ecmwf_"), "stream", F.lit("-"), "field_type", F.lit("_"), F.date_format(run, "yyyyMMdd'T'HH"), F.lit(".grib"))
    return rows.select(run, "params", "steps", area.alias("area"), "stream", "field_type", number.alias("number"), name.alias("filename"))


def mixed_kinds(cells: DataFrame, run: str = "init_time") -> DataFrame:
    """Error rows of runs whose cells are of several kinds, for which no one request can ask."""
    kinds = cells.groupBy(run).agg(F.array_join(F.sort_array(F.collect_set("kind")), ", ").alias("_kinds"), F.min("kind").alias("_a"), F.max("kind").alias("_b")).where("_a < _b")
    return errors(kinds, "request", "several kinds", run, None, "_kinds")


# Sources that fetch an empty file again.
NEEDS_BYTES = ["ECMWF-Realtime-S3", "MetOffice-Weather-Datahub"]


def to_fetch(manifest: DataFrame, cached: DataFrame, key: str = "key", source: str = "source") -> DataFrame:
    """Rows of the manifest that no cached file has; for some sources empty files don't count."""
    have = cached.groupBy(key).agg(F.max(F.coalesce("length", F.lit(0))).alias("_length")).select(F.col(key).alias("_key"), "_length")
    done = (F.col(key) == F.col("_key")) & (~F.col(source).isin(NEEDS_BYTES) | (F.col("_length") > 0))
    return manifest.join(have, done, "left_anti")


def size_mismatches(manifest: DataFrame, cached: DataFrame, key: str = "key") -> DataFrame:
    """Fetched files of the wrong size: exact sources where it differs, others where less came than there is."""
    both = manifest.join(cached, key)
    return both.where(F.when(F.col("exact"), F.col("length") != F.col("remote_bytes")).otherwise(F.col("length") < F.col("remote_bytes"))).select(key, "remote_bytes", "length")


def size_errors(manifest: DataFrame, cached: DataFrame, run: str, url: str, key: str = "key") -> DataFrame:
    """Error rows of fetched files of the wrong size; the detail says how many bytes came of how many."""
    wrong = size_mismatches(manifest, cached, key).join(manifest.select(F.col(key).alias("_key"), F.col(run).alias("_run"), F.col(url).alias("_url")), F.col(key) == F.col("_key"))
    return errors(wrong, "fetch", "size", "_run", "_url", F.concat_ws(" of ", "length", "remote_bytes"))


def fetch_errors(manifest: DataFrame, cached: DataFrame, run: str, url: str, key: str = "key", source: str = "source") -> DataFrame:
    """Error rows of a fetch that is over: files that didn't land (`missing`), landed without bytes where their source needs some (`empty`), or have the wrong size.

    An empty file is told once, as `empty`.
    """
    sizes = cached.groupBy(key).agg(F.max(F.coalesce("length", F.lit(0))).alias("_length")).withColumnRenamed(key, "_key")
    lost = to_fetch(manifest, cached, key, source).join(sizes, F.col(key) == F.col("_key"), "left")
    gone = errors(lost, "fetch", F.when(F.col("_length").isNull(), "missing").otherwise("empty"), run, url)
    wrong = size_errors(manifest, cached, run, url, key)
    return gone.unionByName(wrong.join(gone.select("url"), "url", "left_anti").select(*gone.columns))


def raw_path(source: str, model: str, url: str, run: str, root: str = "raw") -> Column:
    """Where a fetched file goes: a folder for source and model, in which one source nests by run, and a name by source."""
    parts = F.split(F.col(url), "/")
    base, above = F.element_at(parts, -1), F.element_at(parts, -2)
    own = (
        F.when(F.col(source) == "NOAA-GFS-S3", F.concat(F.date_format(run, "yyyy/MM/dd/HH"), F.lit("/"), base, F.lit(".grib"))).when(F.col(source) == "MetOffice-Weather-Datahub", F.concat(above, F.lit(".grib")))
        .when(F.col(source) == "ECMWF-Realtime-S3", F.concat(F.regexp_replace(base, r"(?<=.)\.[^.]+$", ""), F.lit(".grib"))).otherwise(base)
    )
    return F.concat_ws("/", F.lit(root), F.col(source), F.col(model), F.lit("raw"), own)


def route(url: str) -> Column:
    """Which conversion a file goes to; unknown kinds are for the error table."""
    return F.when(F.contains(url, F.lit("global-grib")), "global").when(F.contains(url, F.lit("ukv-grib")), "ukv").otherwise("error")


def unknown_kinds(files: DataFrame, url: str) -> DataFrame:
    """Error rows of files that no conversion takes."""
    return errors(files.where(route(url) == "error"), "convert", "unknown kind", None, url)


def runs_without_files(runs: DataFrame, manifest: DataFrame, run: str = "init_time") -> DataFrame:
    """Error rows of runs for which nothing is listed."""
    return errors(runs.join(manifest.select(run), run, "left_anti"), "listing", "no files", run)


def gfs_steps() -> list[int]:
    a, b, by = catalog.model("NCEP_GFS_1DEGREE")["steps"]
    return list(range(a, b + 1, by))


def runs_of(cells: DataFrame) -> DataFrame:
    return cells.select("init_time").distinct()

