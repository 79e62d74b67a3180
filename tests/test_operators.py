"""Operators on small tables with known answers."""

import time
from datetime import date, datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.functions import catalog
from skyloom.operators import axes, manifest, models, normalise, quality, runs
from skyloom.operators.layout import layout_of
from skyloom.sources import storage, tables, versions
from skyloom.streaming import live

RUN = datetime(2021, 1, 1)
CELL = "init_time timestamp_ntz, step int, variable string, lat_e4 int, lon_e4 int, value double"


def cells(spark, runs_=3, steps=range(12), variables=("a", "b", "c"), lats=(60, 61, 62), lons=(10, 11, 12)):
    rows = [(RUN + timedelta(hours=3 * r), s, v, y * 10000, x * 10000, 1.0) for r in range(runs_) for s in steps for v in variables for y in lats for x in lons]
    return spark.createDataFrame(rows, CELL)


def region(spark, inner, outer=None):
    outer = axes.ordered(axes.ticks(cells(spark))) if outer is None else outer
    found = axes.regions(axes.ticks(inner.withColumn("piece", F.lit("p")), ("piece",)), outer, "piece")
    return {r.dim: (r.start, r.stop, r.rule) for r in found.collect()}


def test_regions_of_subsets(spark):
    got = region(spark, cells(spark, 1, range(6)))
    assert got == {"init_time": (0, 1, None), "step": (0, 6, None), "variable": (0, 3, None), "latitude": (0, 3, None), "longitude": (0, 3, None)}
    got = region(spark, cells(spark).where(F.hour("init_time") > 0))
    assert got["init_time"] == (1, 3, None) and got["step"] == (0, 12, None)


def test_regions_with_gaps_or_outside(spark):
    assert region(spark, cells(spark, steps=(1, 3, 5)))["step"] == (1, 6, "gaps")
    assert region(spark, cells(spark, lats=(60, 63)))["latitude"][2] == "outside"
    assert region(spark, cells(spark, steps=(15,)))["step"] == (None, None, "outside")
    assert region(spark, cells(spark, lats=(12, 13)))["latitude"] == (None, None, "outside")


def test_regions_need_the_same_dimensions_and_no_longer_axes(spark):
    assert {x[2] for x in region(spark, cells(spark).drop("lat_e4", "lon_e4")).values()} == {"dimensions"}
    assert {x[2] for x in region(spark, cells(spark).withColumn("ensemble_member", F.lit(1))).values()} == {"dimensions"}
    assert region(spark, cells(spark, lats=(60, 61, 62, 63)))["latitude"][2] == "longer"
    empty = axes.ticks(cells(spark).withColumn("piece", F.lit("p")), ("piece",)).where("dim <> 'step'").unionByName(spark.createDataFrame([("p", "step", None, None)], "piece string, dim string, num double, str string"))
    found = axes.regions(empty, axes.ordered(axes.ticks(cells(spark))), "piece")
    assert {r.dim: r.rule for r in found.collect()}["step"] == "empty"
    said = axes.region_errors(found, "piece").collect()
    assert [(r.url, r.stage, r.rule, r.detail) for r in said] == [("p", "region", "empty", "step")]


def test_regions_of_metres_members_and_statistics(spark):
    whole = [(RUN, s, "a", e, m, y, x) for s in range(3) for e in ("mean", "std") for m in (1, 2, 3) for y in (4000, 2000, 0) for x in (0, 2000)]
    schema = "init_time timestamp_ntz, step int, variable string, ensemble_stat string, ensemble_member int, y_osgb int, x_osgb int"
    outer = spark.createDataFrame(whole, schema)
    inner = outer.where("ensemble_member > 1 and y_osgb < 4000 and ensemble_stat = 'std'")
    got = region(spark, inner, axes.ordered(axes.ticks(outer)))
    assert got["ensemble_member"] == (1, 3, None) and got["y_osgb"] == (1, 3, None) and got["x_osgb"] == (0, 2, None) and got["ensemble_stat"] == (1, 2, None)
    axis = axes.ordered(axes.ticks(outer.withColumn("g", F.lit("g")), ("g",)), ("g",))
    assert [r.breach for r in axes.validate(axis, "g", ["a"]).collect()] == [None]
    assert [(r.dim, r.length) for r in axes.shape(axis, "g").orderBy("place").collect()] == [("init_time", 1), ("step", 3), ("variable", 1), ("ensemble_stat", 2), ("ensemble_member", 3), ("y_osgb", 3), ("x_osgb", 2)]
    images = axes.skeleton(axis, "g")
    assert images.count() == 3 * 2 * 3 and {r.area for r in images.collect()} == {6}


def test_pieces_are_placed_as_regions_are_but_few_ticks_are_counted(spark):
    """Only pieces that their ends leave open, or that have several runs, go through sets of ticks."""
    parts = {
        "whole": cells(spark, 1), "two": cells(spark, 2, (3,)), "gap": cells(spark, 1, (1, 3, 5)), "long": cells(spark, 1, (0,), ("a",), range(60, 66)),
        "one": cells(spark, 1, (4,), ("b",), (61,), (11,)), "thin": cells(spark, 1, (0, 9), ("a",), (60,), (10,)), "out": cells(spark, 1, (0,), ("a",), (63,), (10,)), "other": cells(spark, 1, (0,), ("x",), (63,), (10,)),
        "null": cells(spark, 1, (4,), ("b",), (61,), (11,)).withColumns({"step": F.lit(None).cast("int"), "value": F.lit(None).cast("double")}),
    }
    inner = None
    for name, rows in parts.items():
        rows = rows.withColumn("piece", F.lit(name))
        inner = rows if inner is None else inner.unionByName(rows)
    outer, kept, blocks = axes.ordered(axes.ticks(cells(spark))), {}, {"latitude": 3, "longitude": 3, "step": 1, "variable": 1, "init_time": 1}
    got = axes.placed(inner, outer, "init_time", "piece", blocks, lambda df, name: kept.setdefault(name, df))
    region = axes.regions(axes.ticks(inner, ("piece",)), outer, "piece")
    bad = {r.url: (r.rule, r.detail) for r in axes.region_errors(region, "piece").collect()}
    odd = {r.piece for r in axes.misaligned(region, spark.createDataFrame(list(blocks.items()), "dim string, block int")).collect()}
    runs_ = {(r.init_time, r.piece): r.n for r in inner.groupBy("init_time", "piece").agg(F.count("value").alias("n")).collect()}
    assert {(r.init_time, r.piece): (r.n, r.rule, r.dim, r.odd) for r in got.collect()} == {k: (n, *bad.get(k[1], (None, None)), k[1] in odd) for k, n in runs_.items()}
    assert bad == {"gap": ("gaps", "step"), "long": ("longer", "latitude"), "thin": ("gaps", "step"), "out": ("outside", "latitude"), "other": ("outside", "variable"), "null": ("dimensions", "init_time")} and odd >= {"one"}
    assert {r.piece for r in kept["counted"].collect()} == {"whole", "two", "gap", "long"}


def test_axes_are_judged_as_they_are_given(spark):
    def breach(*drop, **ticks_):
        given = {"init_time": [0.0], "step": [0.0, 72.0], "variable": ["temperature_sl"], "latitude": [61.0, 60.0], "longitude": [10.0, 11.0]} | ticks_
        rows = [("g", d, i, *((None, v) if isinstance(v, str) else (v, None))) for d, values in given.items() if d not in drop for i, v in enumerate(values)]
        rows += [("g", d, None, None, None) for d, values in given.items() if not values]
        return axes.validate(spark.createDataFrame(rows, "g string, dim string, idx int, num double, str string"), "g", ["temperature_sl"]).first().breach

    assert breach() is None and breach("step") == "missing dimension" and breach(step=[]) == "empty dimension" and breach(variable=["odd"]) == "unknown variable" and breach(depth=[1.0]) == "unknown dimension"
    assert breach(latitude=[60.0, 61.0]) == "latitude order" and breach(longitude=[11.0, 10.0]) == "longitude order"
    for dim, rising in (("y_osgb", False), ("x_osgb", True), ("y_laea", False), ("x_laea", True)):
        assert breach(**{dim: [0.0, 2000.0]}) == (None if rising else f"{dim} order") and breach(**{dim: [2000.0, 0.0]}) == (f"{dim} order" if rising else None)


def test_gaps_name_both_sides_and_what_is_outside(spark):
    inner = axes.ticks(cells(spark, steps=(1, 3, 5, 15)).withColumn("piece", F.lit("p")), ("piece",))
    found = axes.gaps(inner, axes.ordered(axes.ticks(cells(spark))), "piece").where("dim = 'step'").collect()
    assert sorted((r.kind, r.before, r.after, r.tick) for r in found if r.kind == "gap") == [("gap", 1, 3, None), ("gap", 3, 5, None)]
    assert [r.tick for r in found if r.kind == "outside"] == ["15.0000"]


def test_crop(spark):
    rows = [("g", y, x) for y in range(800000, -800000, -1000) for x in range(150000, -150000, -1000) if (y % 10000 == 0 or 599000 < y <= 606000) and (x % 10000 == 0 or x > 99000)]
    data = spark.createDataFrame(rows, "g string, lat_e4 int, lon_e4 int").unionByName(spark.createDataFrame([("flat", None, None)], "g string, lat_e4 int, lon_e4 int"))
    def cut(*box, group="g"):
        kept, said = axes.crop(data, spark.createDataFrame([(group, *map(float, box))], "g string, north double, west double, south double, east double"), "g")
        return kept, [r.rule for r in said.collect()]

    kept, said = cut(60.5, 10, 60, 10.5)
    assert (kept.select("lat_e4").distinct().count(), kept.select("lon_e4").distinct().count(), said) == (6, 6, [])
    for box, rule in (((60, 10, 61, 11), "no such box"), ((91, 0, 0, 10), "no such box"), ((10, 20, 0, 10), "no such box"), ((89, -10, 0, 10), "outside the data"), ((60, -20, 50, 10), "outside the data")):
        kept, said = cut(*box)
        assert kept.count() == 0 and said == [rule]
    assert cut(60, 10, 59, 11, group="flat")[1] == ["no latitude or longitude"]
    assert data.where(axes.inside(60.5, 10.0, 60.0, 10.5)).count() == 36


def test_named_regions(spark):
    ask = [("ECMWF_HRES_IFS_0P1DEGREE", "uk"), ("ECMWF_HRES_IFS_0P1DEGREE", "india"), ("ECMWF_HRES_IFS_0P1DEGREE", "nowhere"), ("MO_UM_UKV_2KM_OSGB", "uk")]
    got = models.named_regions(spark.createDataFrame(ask, "model string, region string"), catalog.models(spark), catalog.regions(spark))
    assert {(r.region, r.name): (r.ny, r.nx, r.rule) for r in got.collect()} == {
        ("uk", "hres-ifs_uk"): (141, 151, None), ("india", "hres-ifs_india"): (291, 301, None), ("nowhere", "hres-ifs"): (1801, 3601, "unknown region"), ("uk", "um-ukv"): (None, None, "no latitude or longitude"),
    }


def test_periods(spark):
    runs_of = lambda period: sorted(r.init_time for r in models.wanted_runs(spark, period, datetime(2021, 1, 2, 0), [0, 6, 12, 18], 60).collect())
    assert runs_of(None) == [datetime(2021, 1, 1, 18)] and runs_of(datetime(2020, 5, 1, 3)) == [datetime(2020, 5, 1, 3)]
    assert len(runs_of(date(2024, 2, 1))) == 116 and runs_of(date(2024, 2, 9))[0] == datetime(2024, 2, 1)


def test_latest_run(spark):
    moments = [(datetime(2021, 1, 2, 0), datetime(2021, 1, 1, 18)), (datetime(2021, 1, 1, 5), datetime(2021, 1, 1, 0)), (datetime(2021, 1, 1, 6), datetime(2021, 1, 1, 0)), (datetime(2021, 1, 1, 7), datetime(2021, 1, 1, 6))]
    df = spark.createDataFrame(moments, "t timestamp_ntz, want timestamp_ntz")
    assert df.where(~models.latest_run(F.col("t"), [0, 6, 12, 18], 60).eqNullSafe(F.col("want"))).count() == 0
    assert df.select(models.latest_run(F.col("t"), [], 60).alias("x")).where("x is not null").count() == 0


def test_month_runs(spark):
    month = spark.createDataFrame([(datetime(2024, 2, 1),)], "month timestamp_ntz")
    assert models.month_runs(month, [0, 6, 12, 18]).count() == 116


def test_file_names(spark):
    names = ["gfs.t00z.pgrb2.1p00.f003", "gfs.t06z.pgrb2.1p00.f003", "gfs.t00z.pgrb2.0p25.f003", "gfs.t00z.pgrb2.1p00.f003.nc", "gfs.t00z.pgrb2.1p00.f049", "gfs.t00z.pgrb2.1p00.f000", None, ""]
    got = manifest.gfs_wanted(spark.createDataFrame([(n,) for n in names], "name string"), "name", 0, manifest.gfs_steps())
    assert [r.name for r in got.collect()] == ["gfs.t00z.pgrb2.1p00.f003"]
    run, newyear = datetime(2024, 10, 25), datetime(2024, 12, 31)
    rows = [("A2D10250000102503001", run), ("A2D10260000102603001", run), ("B2D10250000102503001", run), ("A2D10250000102503001.nc", run), ("A2D10250000103103001", run), ("A2S12310000010103001", newyear), ("A2S12310000011003001", newyear)]
    got = manifest.ecmwf_wanted(spark.createDataFrame(rows, "name string, run timestamp_ntz"), "name", "run", 84)
    assert sorted(r.name for r in got.collect()) == ["A2D10250000102503001", "A2S12310000010103001"]


def test_order_listing_without_path_gives_nothing(spark):
    bodies = [(1, '{"orderDetails":{"files":[{"fileId":"a"},{"fileId":"b_+1"},{}]}}'), (2, "{}"), (3, None), (4, "no json")]
    got = manifest.order_files(spark.createDataFrame(bodies, "k int, body string"), "k", "body").collect()
    assert [(r.k, r.file_id) for r in got] == [(1, "a")]


def test_aliases_are_unique_and_canonical_names_are_none(spark):
    table = catalog.aliases(spark)
    assert table.count() == table.select("alias").distinct().count() == 46
    found = normalise.named(spark.createDataFrame([("temperature_sl",), ("t",), (None,)], "alias string")).collect()
    assert {r.alias: r.variable for r in found} == {"temperature_sl": None, "t": "temperature_sl", None: None}


def test_longitudes_wrap_by_floored_modulo(spark):
    rows = [(0, 0), (1800000, -1800000), (3590000, -10000), (-1800000, -1800000), (-1900000, 1700000)]
    df = spark.createDataFrame(rows, "lon int, want int")
    assert df.where(normalise.wrap_longitude(F.col("lon")) != F.col("want")).count() == 0


def test_grid_sizes_that_do_not_fit(spark):
    flat = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0]), (2, [1.0]), (3, None)], "k int, v array<float>")
    assert normalise.unflatten(flat, ["k"], "v", 2, 2).count() == 4
    assert {(r.url, r.rule) for r in normalise.wrong_length(flat, "k", "v", 2, 2).collect()} == {("2", "size"), ("3", "size")}
    grid = spark.createDataFrame([("a", y, x) for y in range(2) for x in range(3)] + [("b", 0, 0)], "f string, iy int, ix int")
    placed, said = normalise.expected_grid(grid, "f", (10, -2, 2), (0, 2, 3))
    assert {(r.iy, r.ix, r.y, r.x) for r in placed.collect()} == {(1 - y, x, 10 - 2 * (1 - y), 2 * x) for y in range(2) for x in range(3)}
    assert [(r.url, r.rule, r.detail) for r in said.collect()] == [("b", "size", "1x1")]


def test_names_that_clash_in_a_file(spark):
    rows = [("f", "t2m", 1.0), ("f", "tas", 2.0), ("f", "tcc", 3.0), ("g", "tas", 4.0), ("g", "junk", 5.0)]
    kept, said = normalise.settle_clashes(normalise.rename_else_drop(spark.createDataFrame(rows, "file string, alias string, v double"), ["temperature_sl", "cloud_cover_total"]), ["file"])
    assert sorted(r.v for r in kept.collect()) == [1.0, 3.0, 4.0]
    assert [(r.url, r.rule, r.detail) for r in said.collect()] == [("f", "several short names", "temperature_sl: t2m, tas")]


def test_equal_messages_come_once_from_the_first_data_set(spark):
    rows = [("u10", 10, "heightAboveGround", "instant", 2), ("u10", 10, "heightAboveGround", "instant", 1), ("t", 2, "surface", "instant", 1), ("sdwe", 0, "surface", "instant", 1), ("tcc", 0, "lowCloudLayer", "avg", 1), ("sdswrf", 0, "surface", "avg", 3)]
    messages = spark.createDataFrame(rows, "short_name string, level int, type_of_level string, step_type string, dataset_no int")
    got = normalise.wanted_messages(messages, ["short_name", "level", "type_of_level", "step_type"], "dataset_no").collect()
    assert sorted((r.short_name, r.dataset_no) for r in got) == [("sdswrf", 3), ("u10", 1)]


def test_which_files_hold_nothing_wanted(spark):
    rows = [(RUN, k + str(i), k, kept) for k in ("global", "ukv", "realtime", "gfs") for i, sets in enumerate(([True], [True, False], [False])) for kept in sets]
    said = normalise.nothing_relevant(spark.createDataFrame(rows, "run timestamp_ntz, file string, kind string, kept boolean"), "run", "file", "kept", "kind")
    assert sorted(r.url for r in said.collect()) == ["gfs2", "global1", "global2", "realtime2"]


def test_raw_paths_and_what_is_fetched(spark):
    rows = [("CEDA", "s3://a/b/x.grib"), ("NOAA-GFS-S3", "s3://a/b/gfs.f003"), ("ECMWF-Realtime-S3", "s3://a/b/A2D.1"), ("ECMWF-MARS", "y.grib"), ("MetOffice-Weather-Datahub", "https://o/file_id/data")]
    df = spark.createDataFrame([(s, "m", u, RUN) for s, u in rows], "source string, model string, url string, run timestamp_ntz")
    got = [r.p.split("/m/raw/")[1] for r in df.select(manifest.raw_path("source", "model", "url", "run").alias("p")).collect()]
    assert got == ["x.grib", "2021/01/01/00/gfs.f003.grib", "A2D.grib", "y.grib", "file_id.grib"]
    listed = spark.createDataFrame([(1, "CEDA"), (2, "ECMWF-Realtime-S3"), (3, "ECMWF-Realtime-S3"), (4, "CEDA")], "key int, source string")
    have = spark.createDataFrame([(1, 0), (2, 0), (3, 5), (3, 0)], "key int, length long")
    assert sorted(r.key for r in manifest.to_fetch(listed, have).collect()) == [2, 4]


def test_blocks_round_trip_and_sizes(spark):
    rows = [(1, y, x, float(y * 10 + x)) for y in range(7) for x in range(9) if (y + x) % 3]
    df = spark.createDataFrame(rows, "k int, iy int, ix int, value double")
    packed = storage.pack(df, ["k"], 4, 4)
    assert packed.count() == 6 and packed.where("size(value) <> 16").count() == 0
    assert sorted(storage.unpack(packed, ["k"], 4, 4).collect()) == sorted(df.collect())
    lengths = spark.createDataFrame([("g", d, n) for d, n in (("init_time", 9), ("step", 48), ("latitude", 181), ("longitude", 8), ("y_laea", 4), ("x_laea", 40))], "g string, dim string, length int")
    counts = spark.createDataFrame([("g", "latitude", 8), ("g", "y_laea", 5), ("g", "x_laea", 0)], "g string, dim string, count int")
    got = {r.dim: (r.block, r.rule) for r in storage.block_sizes(lengths, counts, "g").collect()}
    assert got == {"init_time": (1, None), "step": (1, None), "latitude": (22, None), "longitude": (1, None), "y_laea": (None, "block count"), "x_laea": (None, "block count")}


def test_a_large_block_is_packed_in_one_pass(spark):
    many = spark.range(40000).where("id % 3 > 0").selectExpr("1 as k", "cast(id div 200 as int) iy", "cast(id % 200 as int) ix", "cast(id as double) value")
    began = time.time()
    block = storage.pack(many, ["k"], 200, 200).collect()
    assert len(block) == 1 and block[0].value == [None if i % 3 == 0 else float(i) for i in range(40000)] and time.time() - began < 20


def test_store_keeps_untouched_partitions_and_last_write_wins(spark):
    first = cells(spark, 2, range(2)).withColumn("seq", F.lit(0))
    path = storage.new_path(spark, "t")
    storage.write(first, path)
    store = storage.read(spark, path, first.schema)
    later = first.where("variable = 'a' and step = 0").withColumns({"value": F.lit(5.0), "seq": F.lit(1)}).limit(3)
    got = storage.upsert(store, later, path)
    assert got.count() == first.count() and got.where("value = 5").count() == 3


def test_missing_runs_and_verdict(spark):
    whole = cells(spark, 4, range(4), ("a",), lats=range(60, 72), lons=range(18))
    runs_, axis = whole.select("init_time").distinct(), axes.ordered(axes.ticks(whole.drop("init_time")))
    missing = lambda have: sorted(r.init_time.hour for r in quality.missing_runs(runs_, have, axis).collect())
    assert missing(whole.where("false")) == [0, 3, 6, 9] and missing(whole.where(F.hour("init_time").isin(0, 6))) == [3, 9] and missing(whole) == []
    assert missing(whole.where("step > 1")) == [0, 3, 6, 9] == missing(whole.where("lat_e4 < 700000"))  # only the first two ticks count
    shares = spark.createDataFrame([("x", 0.06 if i < 2 else 0.05) for i in range(100)] + [("y", 0.06 if i < 3 else 0.0) for i in range(100)], "m string, share double")
    assert {r.m: r.ok for r in quality.verdict(shares, ["m"]).collect()} == {"x": True, "y": False}


def test_outcome_of_pieces(spark):
    rows = [(RUN, f"u{i:02d}", i < 6, 10) for i in range(100)] + [(RUN + timedelta(hours=6), f"u{i:02d}", i < 7, 10) for i in range(100)]
    two = spark.createDataFrame([(RUN + timedelta(hours=6 * i),) for i in range(3)], "init_time timestamp_ntz")
    got = {r.init_time.hour: tuple(r)[1:] for r in quality.outcome(two, spark.createDataFrame(rows, "init_time timestamp_ntz, url string, failed boolean, bytes int"), "init_time").collect()}
    assert got[0] == (100, 6, 940, True, None, "u00 u01 u02 u03 u04") and got[6][1:5] == (7, 930, False, "too many failures") and got[12] == (0, 0, 0, False, "no pieces", "")


def test_axes_that_differ(spark):
    a, b = (axes.ordered(axes.ticks(cells(spark, 1, s))) for s in ((0, 1, 2), (0, 1, 3, 4)))
    assert sorted((r.dim, r.idx, r.stored, r.expected) for r in quality.axis_diff(a, b).collect()) == [("step", 2, "2.0000", "3.0000"), ("step", 3, None, "4.0000")]


def test_limits_of_wind_direction_count_as_turned(spark):
    df = spark.createDataFrame([("wind_direction_10m", 90.0), ("wind_direction_10m", 400.0), ("temperature_sl", None), ("odd", 1.0)], "variable string, value double")
    found, said = quality.scan(df)
    got = {r.variable: (r.outside_share, r.is_valid, r.has_nulls) for r in found.collect()}
    assert [(r.rule, r.detail) for r in said.collect()] == [("unknown parameter", "odd")]
    assert got == {"wind_direction_10m": (0.5, False, False), "temperature_sl": (None, False, True)}


GRID = layout_of(storage.KEYS)


def stored(spark, path):
    return versions.found(spark, path, GRID.schema)


def store_of(spark, hours_=(0, 6, 12, 18)):
    """Raw fields of four runs, their wanted runs, and the model's axes."""
    rows = [(RUN + timedelta(hours=h), f"{h}/{s}", 0, a, s, y * 10000, x * 10000, 1.0) for h in hours_ for s in range(4) for a in ("t", "junk") for y in (61, 60) for x in (10, 11, 12)]
    fields = spark.createDataFrame(rows, "init_time timestamp_ntz, url string, dataset_no int, alias string, step int, lat_e4 int, lon_e4 int, value double")
    axis = axes.ordered(axes.ticks(fields.where("alias = 't'").withColumn("variable", F.lit("temperature_sl")).drop("init_time")))
    return fields, fields.select("init_time").distinct(), axis


def take_up(spark, path, fields, runs_, axis, seen, model="m", **rules):
    def fetch(missing):
        seen.append(sorted(r.init_time.hour for r in missing.collect()))
        return fields.join(missing, "init_time", "left_semi")

    return runs.consume(spark, path, model, axis, runs_, fetch, ["temperature_sl"], "gfs", runs.Rules(**rules))


def test_runs_are_taken_up_once_and_others_later(spark):
    fields, runs_, axis = store_of(spark)
    path, seen = storage.new_path(spark, "store"), []
    done = take_up(spark, path, fields.where(F.hour("init_time").isin(0, 12)), runs_, axis, seen)
    assert {r.init_time.hour: (r.status, r.rule, r.bytes) for r in done.runs.collect()} == {0: ("ok", None, 96), 6: ("fetch_failed", "no pieces", 0), 12: ("ok", None, 96), 18: ("fetch_failed", "no pieces", 0)}
    assert done.written == 48 and {(r.run.hour, r.rule) for r in done.errors.where("stage = 'outcome'").collect()} == {(6, "no pieces"), (18, "no pieces")}
    again = take_up(spark, path, fields, runs_, axis, seen)
    assert seen == [[0, 6, 12, 18], [6, 18]] and {r.init_time.hour: r.status for r in again.runs.collect()} == {0: "stored", 6: "ok", 12: "stored", 18: "ok"}
    assert stored(spark, path).count() == 4 * 24
    third = take_up(spark, path, fields, runs_, axis, seen)
    assert seen[2] == [] and {r.status for r in third.runs.collect()} == {"stored"}
    told = runs.summary(spark, path, third, GRID).collect()
    assert {(r.n_cells, r.size_kb, r.size_mb, r.written) for r in told} == {(24, 0, 0, 0)} and all(r.seconds > 0 for r in told)


def test_runs_that_fail_are_not_published(spark):
    fields, runs_, axis = store_of(spark)
    hour = F.hour("init_time")
    bad = fields.withColumn("lon_e4", F.when((hour == 6) & (F.col("step") == 2), 990000).otherwise(F.col("lon_e4"))).where(~((hour == 12) & (F.col("step") == 3) & (F.col("lat_e4") == 610000)))
    path = storage.new_path(spark, "store")
    got = take_up(spark, path, bad, runs_, axis, [])
    assert {r.init_time.hour: (r.status, r.n_failed) for r in got.runs.collect()} == {0: ("ok", 0), 6: ("fetch_failed", 1), 12: ("deleted_invalid", 0), 18: ("ok", 0)}
    assert [(r.run.hour, r.rule, r.detail) for r in got.errors.where("stage = 'region'").collect()] == [(6, "outside", "longitude")]
    assert {r.init_time.hour for r in stored(spark, path).select("init_time").distinct().collect()} == {0, 18}
    path = storage.new_path(spark, "store")
    kept = take_up(spark, path, bad, runs_, axis, [], delete_on_failure=False)
    assert {r.init_time.hour: r.status for r in kept.runs.collect()}[12] == "kept_invalid" and stored(spark, path).where(hour == 12).count() == 21


def test_a_failed_piece_takes_no_cells_of_others_with_it(spark):
    """Two files share cells; the one that is read first has a tick outside: the other one's cells are all published."""
    _, runs_, axis = store_of(spark, (0,))
    row = lambda url, step, lon, v: (RUN, url, 0, "t", step, 610000, lon * 10000, v)
    fields = spark.createDataFrame([row("f1", 0, 10, 1.0), row("f1", 0, 11, 1.0), row("f1", 0, 99, 1.0), *(row("f2", 0, x, 2.0) for x in (10, 11, 12)), row("f2", 0, 10, 9.0)], store_of(spark, (0,))[0].schema)
    fields = fields.withColumn("dataset_no", (F.col("value") == 9).cast("int"))
    path = storage.new_path(spark, "store")
    got = take_up(spark, path, fields, runs_, axis, [], of_pieces=0.5, of_images=1.0)
    run = got.runs.first()
    assert (run.status, run.n, run.n_failed, run.bytes, got.written) == ("ok", 2, 1, 12, 3)
    assert sorted((r.lon_e4, r.value) for r in stored(spark, path).collect()) == [(100000, 2.0), (110000, 2.0), (120000, 2.0)]


def test_the_later_file_wins_cells_that_two_good_files_have(spark):
    fields, runs_, axis = store_of(spark, (0,))
    later = fields.where("step = 1 and lat_e4 = 600000").withColumns({"url": F.lit("z"), "value": F.lit(7.0)})
    path = storage.new_path(spark, "store")
    got = take_up(spark, path, later.unionByName(fields), runs_, axis, [])
    assert got.runs.first().status == "ok" and stored(spark, path).where("value = 7").count() == 3 and got.written == 24


def test_a_file_fails_as_a_whole_and_counts_once(spark):
    """One empty data set fails a file of kind `global`: none of its cells is published."""
    fields, runs_, axis = store_of(spark, (0,))
    name = F.when(F.col("alias") == "junk", F.when(F.col("step") == 2, "junk").otherwise("t2m")).otherwise("t")
    path = storage.new_path(spark, "store")
    fetch = lambda missing: fields.where("alias = 't' or step = 2").withColumns({"alias": name, "dataset_no": (F.col("alias") == "junk").cast("int")})
    got = runs.consume(spark, path, "m", axis, runs_, fetch, ["temperature_sl"], "global", runs.Rules(of_pieces=0.5, of_images=1.0))
    run = got.runs.first()
    assert (run.status, run.n, run.n_failed) == ("ok", 4, 1) and {r.step for r in stored(spark, path).select("step").distinct().collect()} == {0, 1, 3}
    assert [(r.url, r.rule) for r in got.errors.where("stage = 'convert'").collect()] == [("0/2", "nothing relevant")]


def test_cells_of_failed_files_are_never_written(spark, monkeypatch):
    """They leave once, before cells are written; where one wanted data set is enough, files are judged and not their data sets."""
    fields, runs_, axis = store_of(spark, (0,))
    written, judged, kept, judge = [], [], storage.kept, normalise.nothing_relevant

    def keep(df, name):
        out = kept(df, name)
        if name == "cells":
            written.append({r.url for r in out.select("url").collect()})
        return out

    monkeypatch.setattr(storage, "kept", keep)
    monkeypatch.setattr(normalise, "nothing_relevant", lambda sets, *a: (judged.append(sets.count()), judge(sets, *a))[1])
    mixed = fields.where("alias = 't' or step = 2").withColumn("dataset_no", (F.col("alias") == "junk").cast("int"))
    empty = fields.where("alias = 't' or step = 2").withColumns({"dataset_no": F.col("lon_e4") + (F.col("alias") == "junk").cast("int"), "alias": F.when(F.col("step") == 2, "junk").otherwise(F.col("alias"))})
    for kind, raw in (("global", mixed), ("gfs", mixed), ("gfs", empty)):
        got = runs.consume(spark, storage.new_path(spark, "store"), "m", axis, runs_, lambda missing: raw, ["temperature_sl"], kind, runs.Rules(of_pieces=0.5, of_images=1.0))
        fails = [] if (kind, raw) == ("gfs", mixed) else ["0/2"]
        assert [(r.url, r.rule, r.detail) for r in got.errors.where("stage = 'convert'").collect()] == [(u, "nothing relevant", kind) for u in fails] and (got.runs.first().n, got.runs.first().n_failed) == (4, len(fails))
    assert written == [{"0/0", "0/1", "0/3"}, {"0/0", "0/1", "0/2", "0/3"}, {"0/0", "0/1", "0/3"}] and judged == [5, 4, 4]


def members_of(spark, values=(1, 2, 3)):
    one = cells(spark, 1, range(2), ("temperature_sl",))
    return one.withColumn("ensemble_member", F.explode(F.array(*map(F.lit, values))))


def test_members_are_judged_one_by_one(spark):
    whole = members_of(spark, (1, 2))
    images = whole.select("init_time", "step", "variable", "ensemble_member").distinct()
    share = lambda have: {(r.step, r.ensemble_member): r.share for r in quality.missing_share(images, have, 9).collect()}
    assert share(whole.where("ensemble_member = 1")) == {(0, 1): 0.0, (1, 1): 0.0, (0, 2): 1.0, (1, 2): 1.0}
    assert set(share(whole).values()) == {0.0}


def test_writing_one_member_leaves_the_others(spark):
    whole = members_of(spark).withColumn("seq", F.lit(0))
    path = storage.new_path(spark, "store")
    storage.write(whole, path)
    got = storage.upsert(storage.read(spark, path, whole.schema), whole.where("ensemble_member = 2").withColumns({"value": F.lit(5.0), "seq": F.lit(1)}), path)
    assert {(r.ensemble_member, r.value): r["count"] for r in got.groupBy("ensemble_member", "value").count().collect()} == {(1, 1.0): 18, (2, 5.0): 18, (3, 1.0): 18}
    versioned = storage.new_path(spark, "store")
    schema = layout_of(whole.columns).schema
    versions.publish(whole.drop("seq"), versioned)
    versions.upsert(whole.where("ensemble_member = 2 and step = 1").drop("seq").withColumn("value", F.lit(5.0)), versioned)
    assert versions.found(spark, versioned, schema).where("value = 5").count() == 9 and versions.found(spark, versioned, schema).count() == 54


def test_members_on_metres_are_consumed(spark):
    rows = [(RUN, f"{m}/{s}", 0, "t", s, m, y, x, 1.0) for m in (1, 2) for s in range(3) for y in (2000, 0) for x in (0, 2000, 4000)]
    fields = spark.createDataFrame(rows, "init_time timestamp_ntz, url string, dataset_no int, alias string, step int, ensemble_member int, y_osgb int, x_osgb int, value double")
    axis = axes.ordered(axes.ticks(fields.withColumn("variable", F.lit("temperature_sl")).drop("init_time", "url", "value")))
    path = storage.new_path(spark, "store")
    take = lambda have: runs.consume(spark, path, "m", axis, fields.select("init_time").distinct(), lambda _: have, ["temperature_sl"], "gfs", runs.Rules(of_images=0.4))
    first = take(fields.where("ensemble_member = 1")).runs.first()
    assert (first.status, first.n_images, first.bad_images) == ("deleted_invalid", 6, 3) and versions.found(spark, path, layout_of(fields.columns).schema) is None
    assert take(fields).runs.first().status == "ok" and take(fields).runs.first().status == "stored"


def test_a_write_that_dies_leaves_the_old_run(spark, monkeypatch):
    first = cells(spark, 2, range(2))
    path, schema = storage.new_path(spark, "store"), layout_of(first.columns).schema
    versions.publish(first, path)
    whole = lambda: {(r.init_time.hour, r.value): r["count"] for r in versions.found(spark, path, schema).groupBy("init_time", "value").count().collect()}
    n = first.where(F.hour("init_time") == 0).count()
    reader = versions.found(spark, path, schema)
    with monkeypatch.context() as m:
        m.setattr(versions, "name_once", lambda *a: 1 / 0)
        try:
            versions.publish(first.where(F.hour("init_time") == 0).withColumn("value", F.lit(2.0)), path)
        except ZeroDivisionError:
            pass
    assert whole() == {(0, 1.0): n, (3, 1.0): n} and versions.sweep(spark, path) == 3
    versions.publish(first.where(F.hour("init_time") == 0).withColumn("value", F.lit(2.0)), path, "again")
    assert whole() == {(0, 2.0): n, (3, 1.0): n} and reader.where("value = 1").count() == 2 * n  # who began before reads on
    versions.publish(first.where(F.hour("init_time") == 0).withColumn("value", F.lit(2.0)), path, "again")
    assert whole() == {(0, 2.0): n, (3, 1.0): n} and versions.sweep(spark, path) == 3 and versions.sweep(spark, path) == 0
    assert versions.drop_runs(spark, path, first.where(F.hour("init_time") == 3).select("init_time")) == 1 and whole() == {(0, 2.0): n}
    with monkeypatch.context() as m:  # another writer takes the name first: what it left is kept
        once, others = versions.name_once, [first.where(F.hour("init_time") == 3)]
        m.setattr(versions, "name_once", lambda *a: (versions.publish(others.pop(), path) if others else None, once(*a))[1])
        versions.publish(first.where(F.hour("init_time") == 0).withColumn("value", F.lit(3.0)), path)
    assert whole() == {(0, 3.0): n, (3, 1.0): n}


def test_consume_leaves_nothing_behind_and_decodes_once(spark, tmp_path, monkeypatch):
    fields, runs_, axis = store_of(spark)
    decoded, made = spark.sparkContext.accumulator(0), []
    monkeypatch.setattr(storage, "new_path", lambda _, name: (made.append(name), f"file://{tmp_path}/own/{name}-{len(made)}")[1])

    def decode(frames):
        for f in frames:
            decoded.add(len(f))
            yield f

    path = storage.new_path(spark, "store")
    done = runs.consume(spark, path, "m", axis, runs_, lambda missing: fields.join(missing, "init_time", "left_semi").mapInPandas(decode, fields.schema), ["temperature_sl"])
    assert done.runs.count() == 4 and decoded.value == fields.count()
    assert set(made) > {"store", "cells"} and {p.name.split("-")[0] for p in (tmp_path / "own").iterdir()} == {"store"}


def test_consume_makes_its_axes_once(spark):
    """Axes may be made of all cells of a model: what reads them again doesn't make them again."""
    fields, runs_, axis = store_of(spark, (0,))
    made, n = spark.sparkContext.accumulator(0), axis.count()

    def make(frames):
        for f in frames:
            made.add(len(f))
            yield f

    done = runs.consume(spark, storage.new_path(spark, "store"), "m", axis.mapInPandas(make, axis.schema), runs_, lambda missing: fields.join(missing, "init_time", "left_semi"), ["temperature_sl"])
    assert [r.status for r in done.runs.collect()] == ["ok"] and made.value == n


def test_clashes_are_looked_for_where_a_parameter_has_several_names(spark, monkeypatch):
    row = lambda url, no, name, step, v: (RUN, url, no, name, step, 610000, 100000, v)
    rows = [row("f1", 0, "t2m", 0, 1.0), row("f1", 1, "t", 0, 2.0), row("f1", 1, "t", 1, 3.0), row("f2", 0, "t2m", 0, 4.0), *(row(f, 2, "tcc", 0, 5.0) for f in ("f1", "f2")), row("f3", 0, "junk", 0, 6.0)]
    fields, looked, real = spark.createDataFrame(rows, store_of(spark, (0,))[0].schema), [], normalise.settle_clashes
    monkeypatch.setattr(normalise, "settle_clashes", lambda f, *a: (looked.append({r.variable for r in f.collect()}), real(f, *a))[1])
    with storage.scratch(spark):
        got, said = runs.pieces_of(fields, ["temperature_sl", "cloud_cover_total"], "ukv")
        found = {(r.url, r.variable, r.step): r.value for r in got.collect()}
        first = {"t": {("f1", "temperature_sl", 0): 2.0, ("f1", "temperature_sl", 1): 3.0}, "t2m": {("f1", "temperature_sl", 0): 1.0}}
        name = min(("t", "t2m"), key=lambda a: normalise.named(fields.where(F.col("alias") == a)).first().alias_ord)
        assert found == first[name] | {("f2", "temperature_sl", 0): 4.0, ("f1", "cloud_cover_total", 0): 5.0, ("f2", "cloud_cover_total", 0): 5.0}
        assert [(r.rule, r.detail) for r in said.collect()] == [("several short names", "temperature_sl: t, t2m")] and looked == [{"temperature_sl"}]


def test_wrong_sizes_and_mixed_kinds_are_error_rows(spark):
    files = spark.createDataFrame([(1, RUN, "a", 10, True), (2, RUN, "b", 10, True), (3, RUN, "c", 10, False), (4, RUN, "d", 10, False)], "key int, init_time timestamp_ntz, url string, remote_bytes long, exact boolean")
    have = spark.createDataFrame([(1, 10), (2, 12), (3, 12), (4, 9)], "key int, length long")
    said = manifest.size_errors(files, have, "init_time", "url")
    assert sorted((r.url, r.stage, r.rule, r.detail) for r in said.collect()) == [("b", "fetch", "size", "12 of 10"), ("d", "fetch", "size", "9 of 10")]
    rows = [(RUN + timedelta(hours=h), "167", s, 600000, 0, k) for h, kinds in ((0, ("stat", "stat")), (6, ("member", "plain"))) for s, k in enumerate(kinds)]
    asked = spark.createDataFrame(rows, "init_time timestamp_ntz, code string, step int, lat_e4 int, lon_e4 int, kind string")
    assert {r.init_time.hour for r in manifest.archive_requests(asked).collect()} == {0}
    assert [(r.run.hour, r.rule, r.detail) for r in manifest.mixed_kinds(asked).collect()] == [(6, "several kinds", "member, plain")]


def test_stores_know_their_model(spark):
    fields, runs_, axis = store_of(spark)
    path = storage.new_path(spark, "store")
    images, about, said = storage.create(spark, path, "m", runs_, axis, ["temperature_sl"], catalog.attributes(["temperature_sl"], "osgb"))
    assert (images.count(), images.first().area, about.first().reused, about.first().size_kb, said.count()) == (16, 6, False, 0, 0)
    _, about, said = storage.create(spark, path, "m", runs_, axis, ["temperature_sl"])
    assert about.first().reused and about.first().size_kb == 16 * 6 * 4 // 1024 and said.count() == 0
    assert [r.rule for r in storage.create(spark, path, "other", runs_, axis, ["temperature_sl"])[2].collect()] == ["different model"]
    assert [r.rule for r in storage.create(spark, path, "m", runs_.where("false"), axis, ["temperature_sl"])[2].collect()] == ["no runs"]
    assert [r.rule for r in storage.create(spark, storage.new_path(spark, "s"), "m", runs_, axis, ["visibility_sl"])[2].collect()] == ["unknown variable"]
    failed = take_up(spark, path, fields, runs_, axis, [], model="other")
    assert {r.status for r in failed.runs.collect()} == {"store_failed"}
    said = spark.read.parquet(f"{path}.about").first().attributes
    assert '"scale_factor_at_central_meridian": 0.0' in said["coord_system"] and '"units": "C"' in said["variables"]
    storage.drop_store(spark, path)
    assert storage.found(spark, f"{path}.about") is None


def test_runs_are_deleted_without_touching_others(spark):
    first = cells(spark, 3, range(2))
    path = storage.new_path(spark, "store")
    storage.write(first, path)
    assert storage.drop_runs(spark, path, first.where(F.hour("init_time") == 3).select("init_time")) == 1
    assert {r.init_time.hour for r in spark.read.schema(first.schema).parquet(path).select("init_time").distinct().collect()} == {0, 6}
    assert storage.drop_runs(spark, storage.new_path(spark, "none"), first.select("init_time")) == 0


def test_messages_of_binary_files(spark):
    import io

    import pandas as pd

    path = storage.new_path(spark, "raw")
    spark.createDataFrame([(f"{i},{i * 2}",) for i in range(40)], "value string").repartition(4).write.text(path)

    def decode(frames):
        for frame in frames:
            for content in frame["content"]:
                yield pd.read_csv(io.BytesIO(content), names=["a", "b"])

    got = tables.read_fields(spark, path, decode, "a long, b long")
    assert sorted((r.a, r.b) for r in got.collect()) == [(i, 2 * i) for i in range(40)] and got.rdd.getNumPartitions() > 0


def test_fields_land_while_a_store_is_followed(spark):
    fields = store_of(spark)[0].withColumn("event_id", F.monotonically_increasing_id())
    landing, store, marks = (storage.new_path(spark, x) for x in ("landing", "store", "marks"))
    fields.where("step < 2").write.parquet(landing)
    assert live.follow(spark, landing, fields.schema, store, ["temperature_sl"], marks).count() == 48
    fields.where("step >= 1").withColumn("value", F.lit(7.0)).write.mode("append").parquet(landing)
    got = live.follow(spark, landing, fields.schema, store, ["temperature_sl"], marks)
    assert got.count() == 96 and got.where("value = 7").count() == 72


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 8), st.integers(1, 4))
def test_the_region_of_a_slice_is_the_slice(spark, start, n):
    assert region(spark, cells(spark, 1, range(start, start + n), ("a",)), axes.ordered(axes.ticks(cells(spark, 1, range(12), ("a",)))))["step"] == (start, start + n, None)


def test_without_the_text_subpackage(tmp_path):
    """The entry point works where the text subpackage and its pipeline are gone."""
    import shutil
    import subprocess
    import sys

    from conftest import ROOT

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": f"{copy}:{':'.join(p for p in sys.path if p and p != ROOT)}"})
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[0]) == int(said.stdout.split()[1]) > 60


def test_live_runs_are_judged_once_when_whole_or_late(spark):
    """Run 0 is whole with the second part, run 6 never is and is judged late, run 12 comes in one part; a replay changes nothing."""
    fields, runs_, axis = store_of(spark, (0, 6, 12))
    hour, step = F.hour("init_time"), F.col("step")
    parts = [fields.where(((hour == 0) & (step < 2)) | ((hour == 6) & (step == 0))), fields.where((hour == 0) & (step > 1)), fields.where(hour == 12), fields.where((hour == 6) & (step == 3))]
    landing, path, marks = (storage.new_path(spark, n) for n in ("landing", "store", "marks"))
    expected = fields.groupBy("init_time").agg(F.count_distinct("url").alias("n_files"))
    take = lambda marks: live.follow_runs(spark, landing, fields.schema, path, "m", axis, expected, ["temperature_sl"], marks, patience=2, files_each=1)
    seen = []
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(landing)
        seen.append({r.init_time.hour: (r.status, r.n, r.bad_images) for r in take(marks).collect()})
    assert seen == [{}, {0: ("ok", 4, 0)}, {0: ("ok", 4, 0), 6: ("deleted_invalid", 1, 3), 12: ("ok", 4, 0)}, seen[2]]
    again = take(storage.new_path(spark, "marks"))  # all parts once more, as after a lost checkpoint
    assert {r.init_time.hour: (r.status, r.n, r.bad_images) for r in again.collect()} == seen[2] and again.count() == 3
    assert stored(spark, path).count() == 48
    want = take_up(spark, storage.new_path(spark, "store"), fields.where(hour != 6), runs_.where(hour != 6), axis, []).runs.drop("sample")
    got = again.where(hour != 6).select(want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_following_an_empty_folder_gives_an_empty_store(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    fields = store_of(spark)[0]
    got = live.follow(spark, f"file://{tmp_path}/landing", fields.schema, storage.new_path(spark, "store"), ["temperature_sl"], storage.new_path(spark, "marks"), order="dataset_no")
    assert got.count() == 0 and set(storage.KEYS) < set(got.columns)
