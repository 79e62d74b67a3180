"""Queries over quality and runs."""

from datetime import date, datetime

from pyspark.sql import functions as F

from ..functions import catalog
from ..operators import axes as a
from ..operators import models as m
from ..operators import quality as q
from ..operators import runs as r
from ..operators.layout import layout_of, layout_on
from ..sources import storage as s
from ..sources import tables as t
from ..sources import versions
from ..streaming import live
from .axes import CELLS, EXPECTED_SQL, GRIDS_SQL, STEPS, VARIABLES, VARIABLES_SQL, expected, gridded, known, ticks_sql
from .registry import query
from .stores import CANONICAL_SQL, canonical, model_axis

AREA = 150
# images of this data hold a few cells of their area: the share that an image may lack is set for that
LACK = 0.98
SHARES_SQL = f"shares as (select init_time, step, variable, 1.0::double - coalesce(n, 0) / {AREA}.0::double as share from expected left join (select init_time, step, variable, count(value) as n from canonical group by all) using (init_time, step, variable))"
SHARES = (*CELLS, CANONICAL_SQL, EXPECTED_SQL, SHARES_SQL)


def shares(spark, folder):
    return q.missing_share(expected(spark, folder), canonical(spark, folder), AREA)


@query("select init_time, step, variable, round(share, 6) as share from shares", *SHARES)
def missing_share(spark, folder):
    return shares(spark, folder).withColumn("share", F.round("share", 6))


@query("select vec_id, label, round(lack, 6) as share, lack > 0.05 as bad from (select e.vec_id, e.label, coalesce(sum((value is null)::int) / count(*) filter (where pos is not null)::double, 1.0) as lack from embeddings e left join flat f using (vec_id) group by 1, 2)", t.FLAT_SQL)
def dense_missing_share(spark, folder):
    images = t.flat_vectors(spark, folder).withColumn("lack", q.dense_missing_share("value"))
    return images.select("vec_id", "label", F.round("lack", 6).alias("share"), (F.col("lack") > 0.05).alias("bad"))


@query(f"""select strftime(init_time, '%Y%m%d%H') as store, count(*) as n_images, sum((share > {LACK})::int)::bigint as bad_images, sum((share > {LACK})::int) / count(*)::double <= 0.3 as ok from shares group by 1
  union all select 'label ' || label, count(*), sum((lack > 0.05)::int), sum((lack > 0.05)::int) / count(*)::double <= 0.02 from (select label, vec_id, sum((value is null)::int) / count(*)::double as lack from flat group by 1, 2) group by 1""", *SHARES, t.FLAT_SQL)
def store_verdict(spark, folder):
    """Stores of one run each, by thresholds for sparse images, and stores of dense images by the usual ones."""
    sparse = q.verdict(shares(spark, folder), ["init_time"], LACK, 0.3).withColumn("store", F.date_format("init_time", "yyyyMMddHH"))
    dense = q.verdict(t.flat_vectors(spark, folder).select("label", q.dense_missing_share("value").alias("share")), ["label"]).withColumn("store", F.concat(F.lit("label "), "label"))
    columns = ["store", "n_images", "bad_images", "ok"]
    return sparse.select(*columns).unionByName(dense.select(*columns))


@query("""select distinct init_time from field_ev where init_time not in (select init_time from known k where value is not null
  and (select count(distinct step) from known j where j.step < k.step) < 2 and (select count(distinct lat_e4) from known j where j.lat_e4 > k.lat_e4) < 2 and (select count(distinct lon_e4) from known j where j.lon_e4 < k.lon_e4) < 2
  and (select count(distinct variable) from known j where j.variable < k.variable) < 2)""", *CELLS)  # fmt: skip
def missing_init_times(spark, folder):
    return q.missing_runs(t.field_events(spark, folder).select("init_time").distinct(), known(spark, folder), model_axis(spark, folder))


SCAN_SQL = "select variable, round(avg(value), 4) as mean, count(value) as n, sum((value is null)::int) > 0 as has_nulls, round(sum((value not between least(lower, upper) and greatest(lower, upper))::int) / count(value)::double, 6) as outside_share, sum((value not between least(lower, upper) and greatest(lower, upper))::int) / count(value)::double <= 0.05 as is_valid from fld_li join aliases using (alias) join params using (variable) group by 1"
LINES = (t.LINES_SQL, catalog.ALIAS_SQL, catalog.PARAMETER_SQL)


def scanned(spark, folder):
    """All lines by parameter; those of one flag come under a name that is no parameter's."""
    names = catalog.aliases(spark).select("alias", "variable")
    lines = t.field_lines(spark, folder).withColumn("alias", F.when(F.col("l_orderkey") % 97 == 0, "odd").otherwise(F.col("alias"))).join(F.broadcast(names), "alias", "left")
    found, said = q.scan(lines.withColumn("variable", F.coalesce("variable", "alias")))
    return found.withColumns({"mean": F.round("mean", 4), "outside_share": F.round("outside_share", 6)}), said


EVEN = (t.LINES_SQL.replace("from lineitem)", "from lineitem where l_orderkey % 97 <> 0)"), catalog.ALIAS_SQL, catalog.PARAMETER_SQL)


@query(f"select variable, mean, n, has_nulls, null::varchar as rule from ({SCAN_SQL}) union all select distinct 'odd', null::double, null::bigint, null::boolean, 'unknown parameter' from lineitem where l_orderkey % 97 = 0", *EVEN)
def parameter_scan(spark, folder):
    found, said = scanned(spark, folder)
    return found.select("variable", "mean", "n", "has_nulls").unionByName(said.select(F.col("detail").alias("variable"), "rule"), allowMissingColumns=True)


@query("select round(avg(value), 4) as store_mean, count(*) as n from fld_li", t.LINES_SQL)
def store_mean(spark, folder):
    return t.field_lines(spark, folder).agg(F.round(F.avg("value"), 4).alias("store_mean"), F.count("*").alias("n"))


@query(f"select variable, outside_share, is_valid from ({SCAN_SQL})", *EVEN)
def limit_check(spark, folder):
    return scanned(spark, folder)[0].select("variable", "outside_share", "is_valid")


# each run's axes against those of all runs
RUN_SQL = ticks_sql("run_axes", "(select *, strftime(init_time, '%Y%m%d%H') as run from known)", "run")


@query("""select coalesce(a.run, b.run) as run, coalesce(a.dim, b.dim) as dim, coalesce(a.idx, b.idx) as idx, coalesce(a.str, printf('%.4f', a.num)) as stored, coalesce(b.str, printf('%.4f', b.num)) as expected
  from (select * from run_axes where dim <> 'init_time') a full join (select run, w.dim, w.idx, w.num, w.str from (select distinct run from run_axes) d, whole w where w.dim <> 'init_time') b on a.run = b.run and a.dim = b.dim and a.idx = b.idx
  where coalesce(a.str, printf('%.4f', a.num)) is distinct from coalesce(b.str, printf('%.4f', b.num))""", *CELLS, ticks_sql("whole", "known"), RUN_SQL)
def axis_diff(spark, folder):
    cells = known(spark, folder)
    stored = a.ordered(a.ticks(cells.withColumn("run", F.date_format("init_time", "yyyyMMddHH")), ("run",)), ("run",)).where("dim <> 'init_time'")
    return q.axis_diff(stored, a.ordered(a.ticks(cells)).where("dim <> 'init_time'"), "run")


OUTCOME_SQL = """pieces as (select init_time, init_time::date || '/' || event_id as url, event_id % 17 = 0 as failed, event_id % 1000 as bytes from field_ev),
asked as (select distinct init_time from field_ev union select distinct init_time + interval 31 day from field_ev),
outcome as (select init_time, coalesce(n, 0) as n, coalesce(n_failed, 0)::bigint as n_failed, coalesce(bytes, 0)::bigint as bytes, case when n is null then 'no pieces' when n_failed / n::double > 0.06 then 'too many failures' end as rule, coalesce(sample, '') as sample from asked
  left join (select init_time, count(*) as n, sum(failed::int) as n_failed, sum(case when failed then 0 else bytes end) as bytes from pieces group by 1) using (init_time)
  left join (select init_time, string_agg(url, ' ' order by url) as sample from (select *, row_number() over (partition by init_time order by url) as k from pieces where failed) where k <= 5 group by 1) using (init_time))"""


@query("select init_time, n, n_failed, bytes, rule is null as ok, rule, sample from outcome", t.FIELD_SQL, OUTCOME_SQL)
def ingest_outcome(spark, folder):
    fields = t.field_events(spark, folder)
    pieces = fields.select("init_time", F.concat(F.date_format("init_time", "yyyy-MM-dd/"), "event_id").alias("url"), (F.col("event_id") % 17 == 0).alias("failed"), (F.col("event_id") % 1000).alias("bytes"))
    runs = fields.select("init_time").distinct()
    return q.outcome(runs.union(runs.select(F.col("init_time") + F.expr("interval 31 days"))), pieces, "init_time")


# A whole run: wanted run times of a period; files that a conversion fails go whole and count once; pieces of the others (of a
# variable) must lie in the axes, ticks in a row; a share of both may fail; then cells of good pieces meet, the last file's stay;
# images of these; verdict and status. The events' files fail oftener than real ones, hence another tolerance there.
PLACE = ["lat_e4", "lon_e4"]


def consumed_sql(cells: str, period: str, images: str, area: str, lack: float, bad: float, fail: float = 0.06, keys: list[str] = PLACE, failing: str = "select null::timestamp as init_time, null as url where false", gaps: str = "max(step) - min(step) + 1 <> count(distinct step)") -> str:
    """Common tables up to `published`, for cells (init_time, url, variable, step, keys, outside, value: one each in a file)."""
    image = ["init_time", "step", "variable", *(k for k in keys if k.startswith("ensemble"))]
    names, place = ", ".join(image), ", ".join(["init_time", "step", "variable", *keys])
    return f"""cell as ({cells}), wanted as ({period}), failing as ({failing}), lost as (select f.* from failing f join wanted using (init_time)),
    mine as (select c.* from cell c join wanted using (init_time) anti join failing f on f.init_time = c.init_time and f.url = c.url),
    piece as (select init_time, url, variable, count(*) as n, bool_or(outside) as outside, {gaps} as gaps from mine group by all),
    result as (select init_time, outside or gaps as failed, n * 4 as bytes from piece union all select init_time, true, 0 from lost),
    facts as (select init_time, count(*) as n, sum(failed::int)::bigint as n_failed, sum(case when failed then 0 else bytes end)::bigint as bytes from result group by 1),
    good as (select {", ".join("m." + k for k in ["init_time", "step", "variable", *keys])}, arg_max(m.value, m.url::varchar) as value from mine m join piece p using (init_time, url, variable) where not p.outside and not gaps group by all),
    image as ({images}),
    filled as (select {", ".join("i." + c for c in image)}, 1 - count(g.value) / {area}::double as share from image i left join good g on {" and ".join(f"g.{c} = i.{c}" for c in image)} group by all),
    shown as (select init_time, count(*) as n_images, sum((share > {lack})::int)::bigint as bad_images from filled group by 1),
    consumed as (select init_time, coalesce(n, 0) as n, coalesce(n_failed, 0) as n_failed, coalesce(bytes, 0) as bytes, case when n is null then 'no pieces' when n_failed / n::double > {fail} then 'too many failures' end as rule, n_images, bad_images,
      case when n is null or n_failed / n::double > {fail} then 'fetch_failed' when bad_images / n_images::double > {bad} then 'kept_invalid' else 'ok' end as status from wanted left join facts using (init_time) left join shown using (init_time)),
    published as (select g.* from good g join consumed using (init_time) where status <> 'fetch_failed')"""


def image_sql(steps: str, variables: str) -> str:
    return f"select init_time, s::int as step, v as variable from wanted, unnest({steps}) a(s), unnest({variables}) b(v)"


OUTCOME = ["init_time", "status", "n", "n_failed", "bytes", "rule", "n_images", "bad_images"]
CONSUMED_SQL = f"select {', '.join(OUTCOME)} from consumed"
RULES = r.Rules(of_pieces=0.09, of_image=LACK, of_images=0.5, delete_on_failure=False)
EVENT_CELLS_SQL = "select distinct on (init_time, user_id, step, variable) init_time, user_id as url, variable, step, lat_e4, lon_e4, ix = 14 as outside, value from known order by init_time, user_id, step, variable, event_id"
MONTH_SQL = "select d + to_hours(h::int) as init_time from generate_series(timestamp '2024-01-01', timestamp '2024-01-31', interval 1 day) as x(d), unnest([0, 6, 12, 18]) as y(h)"
EVENT_IMAGES_SQL, EVENT_AREA_SQL = image_sql(str(STEPS), f"[{VARIABLES_SQL}]"), "(select count(distinct lat_e4) * least(count(distinct lon_e4), 14) from known)"


def events_consumed(fail: float, failing: str | None = None) -> tuple[str, ...]:
    return (*CELLS, consumed_sql(EVENT_CELLS_SQL, MONTH_SQL, EVENT_IMAGES_SQL, EVENT_AREA_SQL, LACK, 0.5, fail, **({"failing": failing} if failing else {})))


EVENTS_CONSUMED = events_consumed(0.09)


def _consumed(spark, folder, period, kind="ukv", rules=RULES):
    """The store of the events' files for a period; its grid ends before the last longitude of some files."""
    axis = model_axis(spark, folder).where("not (dim = 'longitude' and idx > 13)")
    runs = m.wanted_runs(spark, period, datetime(2024, 2, 1), [0, 6, 12, 18], 300)
    fetch = lambda missing: t.field_files(spark, folder).join(F.broadcast(missing), "init_time", "left_semi")
    path = s.new_path(spark, "store")
    return path, r.consume(spark, path, "events", axis, runs, fetch, VARIABLES, kind, rules, catalog.attributes(VARIABLES, "latlon"))


@query(CONSUMED_SQL, *EVENTS_CONSUMED)
def consume_run(spark, folder):
    """A month of runs from files to published store."""
    return _consumed(spark, folder, date(2024, 1, 1))[1].runs.select(*OUTCOME)


# files (of a user) that hold some, or nothing but, events of an unknown kind
HOLDS_JUNK_SQL = "select init_time, user_id as url from field_ev group by 1, 2 having {} (alias = 'junk')"


@query(CONSUMED_SQL, *events_consumed(0.45, HOLDS_JUNK_SQL.format("bool_or")))
def consume_any_fails(spark, folder):
    """The same month where a file fails by any of its data sets that holds nothing wanted."""
    return _consumed(spark, folder, date(2024, 1, 1), "global", r.Rules(0.45, LACK, 0.5, False))[1].runs.select(*OUTCOME)


@query(CONSUMED_SQL, *events_consumed(0.25, HOLDS_JUNK_SQL.format("bool_and")))
def consume_all_fail(spark, folder):
    """The same month where a file fails if all of its data sets hold nothing wanted."""
    return _consumed(spark, folder, date(2024, 1, 1), "gfs", r.Rules(0.25, LACK, 0.5, False))[1].runs.select(*OUTCOME)


# Two models that aren't degrees and nothing else: members on OSGB metres, statistics on LAEA metres. A file is a run's events of a user.
METRES_SQL = """files as (select init_time, user_id as url, event_id, step, variable, ensemble_stat, ensemble_member, y::int as y, x::int as x, value from grids join (select event_id, value from events) using (event_id) where grid = '{grid}')"""


def _metres_sql(grid: str, extra: str, lack: float, fail: float) -> tuple[str, ...]:
    keys = [extra, "y", "x"]
    cells = f"select init_time, url, variable, step, {', '.join(keys)}, false as outside, arg_min(value, event_id) as value from files group by all"
    images = f"select init_time, step, variable, {extra} from wanted, (select distinct step from files), (select distinct variable from files), (select distinct {extra} from files)"
    area = "(select count(distinct y) * count(distinct x) from files)"
    gaps = f"max(step) - min(step) + 1 <> count(distinct step)" + (" or max(ensemble_member) - min(ensemble_member) + 1 <> count(distinct ensemble_member)" if extra == "ensemble_member" else "")
    return (*CELLS, GRIDS_SQL, METRES_SQL.format(grid=grid), consumed_sql(cells, "select distinct init_time from files", images, area, lack, 0.9, fail, keys, gaps=gaps))


def _metres(spark, folder, grid, extra, y, x, rules):
    """(path, layout, outcome) of consuming one of these models from its files, with axes as its cells have them."""
    files = gridded(spark, folder).where(F.col("grid") == grid).join(t.table(spark, folder, "events").select("event_id", "value"), "event_id")
    short = F.create_map(*[F.lit(v) for pair in zip(VARIABLES, ["tcc", "dswrf", "t2m", "u10"], strict=True) for v in pair])
    files = files.select("init_time", F.concat(F.date_format("init_time", "yyyyMMddHH"), F.lit("/"), "user_id").alias("url"), F.col("event_id").alias("dataset_no"), F.element_at(short, F.col("variable")).alias("alias"), "step", extra, y, x, "value", "variable")
    axis = a.ordered(a.ticks(files.drop("init_time", "url", "value")))
    path, runs = s.new_path(spark, "store"), files.select("init_time").distinct()
    fetch = lambda missing: files.drop("variable").join(F.broadcast(missing), "init_time", "left_semi")
    return path, layout_on(axis), r.consume(spark, path, grid, axis, runs, fetch, VARIABLES, "ukv", rules, catalog.attributes(VARIABLES, grid))


@query("""select init_time, status, n_images, bad_images, null::int as ensemble_member, null::bigint as n_cells, null::double as total from consumed
  union all select init_time, null, null, null, ensemble_member, count(*), round(sum(value + case when ensemble_member = 2 then 1000 else 0 end), 4) from published group by init_time, ensemble_member""", *_metres_sql("osgb", "ensemble_member", 0.99, 0.4))
def consume_members(spark, folder):
    """Members on a metre grid: consumed, judged, one member written again over what is stored, and all read back."""
    path, layout, done = _metres(spark, folder, "osgb", "ensemble_member", "y_osgb", "x_osgb", r.Rules(0.4, 0.99, 0.9, False))
    versions.upsert(versions.found(spark, path, layout.schema).where("ensemble_member = 2").withColumn("value", F.col("value") + 1000), path)
    stored = versions.found(spark, path, layout.schema).groupBy("init_time", "ensemble_member").agg(F.count("*").alias("n_cells"), F.round(F.sum("value"), 4).alias("total"))
    return done.runs.select("init_time", "status", "n_images", "bad_images").unionByName(stored, allowMissingColumns=True)


@query("""select init_time, status, n_images, bad_images, null::int as step, null::varchar as variable, null::varchar as ensemble_stat, null::double as share from consumed
  union all select init_time, null, null, null, step, variable, ensemble_stat, round(share, 6) from filled join consumed using (init_time) where status <> 'fetch_failed'""", *_metres_sql("laea", "ensemble_stat", 0.99, 0.2))
def consume_statistics(spark, folder):
    """Statistics on a metre grid: consumed, judged, and the shares of what was stored."""
    path, layout, done = _metres(spark, folder, "laea", "ensemble_stat", "y_laea", "x_laea", r.Rules(0.2, 0.99, 0.9, False))
    there = done.runs.where("status <> 'fetch_failed'").select("init_time")
    images = spark.read.parquet(f"{path}.images").join(there, "init_time", "left_semi")
    shares = q.missing_share(images, versions.found(spark, path, layout.schema), F.col("area")).withColumn("share", F.round("share", 6))
    return done.runs.select("init_time", "status", "n_images", "bad_images").unionByName(shares, allowMissingColumns=True)


LINE_CELLS_SQL = "select distinct on (init_time, l_orderkey, step, variable, lat_e4, lon_e4) init_time, l_orderkey as url, variable, step, lat_e4, lon_e4, lon_e4 = 4000 as outside, value from fld_li join aliases using (alias) order by init_time, l_orderkey, step, variable, lat_e4, lon_e4, l_orderkey * 8 + step, value"
LINE_MONTH_SQL = "select d + to_hours(h::int) as init_time from generate_series(timestamp '1995-03-01', timestamp '1995-03-31', interval 1 day) as x(d), unnest([0, 12]) as y(h)"


@query(CONSUMED_SQL, t.LINES_SQL, catalog.ALIAS_SQL, consumed_sql(LINE_CELLS_SQL, LINE_MONTH_SQL, image_sql("[1, 2, 3, 4, 5, 6, 7]", "['cloud_cover_total', 'temperature_sl', 'visibility_sl']"), "12", 0.95, 0.99, 0.25))
def archive_month(spark, folder):
    """One month of the many that the line items have, twice a day; the second run of a day has no files."""
    names = ["cloud_cover_total", "temperature_sl", "visibility_sl"]
    row = lambda d, values, kind: spark.createDataFrame([(d, i, *((float(v), None) if kind == "num" else (None, v))) for i, v in enumerate(values)], "dim string, idx int, num double, str string")
    axis = row("step", range(1, 8), "num").union(row("variable", names, "str")).union(row("latitude", [60.0, 59.9, 59.8], "num")).union(row("longitude", [0.0, 0.1, 0.2, 0.3], "num"))
    fetch = lambda missing: t.line_files(spark, folder).join(F.broadcast(missing), "init_time", "left_semi")
    runs = m.wanted_runs(spark, date(1995, 3, 1), datetime(1995, 4, 1), [0, 12], 0)
    done = r.consume(spark, s.new_path(spark, "store"), "lines", axis, runs, fetch, names, "ukv", r.Rules(of_pieces=0.25, of_image=0.95, of_images=0.99, delete_on_failure=False))
    return done.runs.select(*OUTCOME)


@query("select init_time, case when day(init_time) <= 10 and first_ok then 'stored' else status end as status from (select *, init_time in (select init_time from published where step < 2 and variable in ('cloud_cover_total', 'downward_shortwave_radiation_flux_gl') and lat_e4 > 598000 and lon_e4 < -48000) as first_ok from consumed)", *EVENTS_CONSUMED)
def run_status(spark, folder):
    """The month asked for again after its first ten days have been taken up: only runs whose corner is missing are fetched."""
    axis = model_axis(spark, folder).where("not (dim = 'longitude' and idx > 13)")
    runs = m.wanted_runs(spark, date(2024, 1, 1), datetime(2024, 2, 1), [0, 6, 12, 18], 300)
    fetch = lambda missing: t.field_files(spark, folder).join(F.broadcast(missing), "init_time", "left_semi")
    path = s.new_path(spark, "store")
    r.consume(spark, path, "events", axis, runs.where(F.dayofmonth("init_time") <= 10), fetch, VARIABLES, "ukv", RULES)
    return r.consume(spark, path, "events", axis, runs, fetch, VARIABLES, "ukv", RULES).runs.select("init_time", "status")


@query("""select strftime(init_time, '%Y%m%d%H') as store, status, count(p.init_time) as n_cells, (count(p.init_time) * 4 // 1024)::bigint as size_kb, (count(p.init_time) * 4 // 1024 // 1024)::bigint as size_mb, true as timed, (select count(*) from published) as written
  from consumed left join published p using (init_time) group by 1, 2""", *EVENTS_CONSUMED)
def run_summary(spark, folder):
    path, done = _consumed(spark, folder, date(2024, 1, 1))
    return r.summary(spark, path, done, layout_of(s.KEYS)).select("store", "status", "n_cells", "size_kb", "size_mb", (F.col("seconds") > 0).alias("timed"), "written")


@query("select init_time, step, variable, lat_e4, lon_e4, value from canonical", *CELLS, CANONICAL_SQL)
def live_ingest(spark, folder):
    """Lands the fields in a folder, picks them up with a stream, and reads the store that it has written."""
    fields = t.field_events(spark, folder)
    landing, store, marks = (s.new_path(spark, name) for name in ("landing", "store", "marks"))
    fields.write.parquet(landing)
    return live.follow(spark, landing, fields.schema, store, VARIABLES, marks).select(*s.KEYS, "value")


@query(f"{CONSUMED_SQL} where n > 0", *EVENTS_CONSUMED)
def live_runs(spark, folder):
    """The month's files land in three parts and are picked up one by one; each run is judged when the last of its files is there."""
    files, axis = t.field_files(spark, folder).where("init_time < timestamp '2024-02-01'"), model_axis(spark, folder).where("not (dim = 'longitude' and idx > 13)")
    landing, store, marks = (s.new_path(spark, name) for name in ("landing", "store", "marks"))
    for part in range(3):
        files.where(F.pmod(F.hash("url"), F.lit(3)) == part).coalesce(1).write.mode("append").parquet(landing)
    expected = files.groupBy("init_time").agg(F.count_distinct("url").alias("n_files"))
    return live.follow_runs(spark, landing, files.schema, store, "events", axis, expected, VARIABLES, marks, files_each=1, kind="ukv", rules=RULES).select(*OUTCOME)
