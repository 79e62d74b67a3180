"""Listings of files that are really there, and what they say of a fetch."""

from pyspark.sql import functions as F

from skyloom.operators import manifest
from skyloom.sources import landing

FILES = {"2024/01/02/00/a.grib": 7, "2024/01/02/00/b.grib": 0, "2024/01/02/06/a.grib": 500, "2024/01/02/06/a.idx": 9, "top.grib": 3}


def landed(tmp_path):
    root = tmp_path / "raw data"
    for name, size in FILES.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x" * size)
    return root


def test_files_are_listed_without_being_read(spark, tmp_path):
    root = landed(tmp_path)
    for name in FILES:
        (root / name).chmod(0)  # nothing opens them
    ask = lambda *p: spark.createDataFrame([(x,) for x in p], "prefix string")
    files, said = landing.listing(ask(""), str(root))
    assert {r.key: (r.folder, r.name, r.length) for r in files.collect()} == {k: (k.rpartition("/")[0], k.rpartition("/")[2], n) for k, n in FILES.items()}
    assert said.count() == 0 and files.where("modified > timestamp '2020-01-01'").count() == 5
    files, said = landing.listing(ask("2024/01/02/00", "2024/01/02/00", "2024/01/03", None), f"file://{root}", ".grib")
    assert {(r.prefix, r.key) for r in files.collect()} == {("2024/01/02/00", "2024/01/02/00/a.grib"), ("2024/01/02/00", "2024/01/02/00/b.grib")} and files.count() == 2
    assert [tuple(r) for r in said.collect()] == [(None, "2024/01/03", "listing", "no such folder", "2024/01/03")]
    assert landing.listing(ask().limit(0), str(root))[0].count() == 0
    files, _ = landing.listing(ask(""), str(root))
    assert {(r.key, r.length, r.n_files) for r in landing.by_folder(files).collect()} == {("2024/01/02/00", 7, 2), ("2024/01/02/06", 509, 2), ("", 3, 1)}


def test_what_a_fetch_left_undone(spark, tmp_path):
    there, _ = landing.listing(spark.createDataFrame([("",)], "prefix string"), str(landed(tmp_path)), ".grib")
    keys = [("2024/01/02/00/a.grib", 7, "ECMWF-Realtime-S3"), ("2024/01/02/00/b.grib", 5, "ECMWF-Realtime-S3"), ("2024/01/02/00/c.grib", 5, "ECMWF-Realtime-S3"), ("2024/01/02/06/a.grib", 501, "NOAA-GFS-S3"), (None, 1, "NOAA-GFS-S3")]
    m = spark.createDataFrame(keys, "key string, remote_bytes long, source string").select("*", F.lit("2024-01-02").cast("timestamp_ntz").alias("run"), F.lit(True).alias("exact"), F.col("key").alias("url"))
    got = {(r.url, r.stage, r.rule, r.detail) for r in manifest.fetch_errors(m, there, "run", "url").collect()}
    assert got == {("2024/01/02/00/b.grib", "fetch", "empty", None), ("2024/01/02/00/c.grib", "fetch", "missing", None), ("2024/01/02/06/a.grib", "fetch", "size", "500 of 501"), (None, "fetch", "missing", None)}
