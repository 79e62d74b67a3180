"""Queries from raw messages of four kinds of source to judged runs. Messages are the 8 x 8 images of vectors, four to a file."""

from pyspark.sql import functions as F

from ..functions import catalog
from ..operators import axes as a
from ..operators import convert as c
from ..operators import runs as r
from ..sources import storage as s
from ..sources import tables as t
from .checks import OUTCOME, consumed_sql
from .registry import query

NAMES = ["t2m", "tcc", "u10", "unknown", "t", "tas", "sdswrf", "junk"]
KINDS, LEVELS = ["surface", "heightAboveGround", "highCloudLayer"], [0, 1, 2]
ALLOWED = ["cloud_cover_total", "downward_shortwave_radiation_flux_gl", "temperature_sl", "wind_u_component_10m"]
RULES = r.Rules(of_pieces=0.3, of_image=0.05, of_images=0.9, delete_on_failure=False)


def messages(spark, folder):
    """(MESSAGES with url): six runs, five steps; every 31st message lacks a value, every 23rd a row."""
    e, file, v = t.table(spark, folder, "embeddings"), F.expr("vec_id div 4"), F.col("vec_id")
    pick = lambda values, i: F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))
    name = F.concat(F.lit("enfo-pf_"), file.cast("string"))
    return e.select(
        name.alias("file_name"), name.alias("url"), (v % 4).cast("int").alias("dataset_no"), pick(NAMES, (F.col("label") + v % 3) % 8).alias("short_name"), pick([192, 1, 77], v % 3).alias("parameter_number"),
        pick(KINDS, v % 5 % 3).alias("type_of_level"), pick(LEVELS, v % 7 % 3).alias("level"), F.when(v % 11 == 0, "avg").otherwise("instant").alias("step_type"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + t.hours((file % 6 * 6).cast("int"))).alias("time"), F.expr("cast(vec_id div 24 % 5 as int)").alias("step"), (v % 2 + 1).cast("int").alias("number"),
        F.when(v % 23 == 0, 7).otherwise(8).alias("ny"), F.lit(8).alias("nx"), F.lit(600000).alias("lat_first"), (F.lit(3530000) + file % 2 * 70000).cast("int").alias("lon_first"),
        F.when(v % 31 == 0, F.slice("embedding", 1, 63)).when(v % 23 == 0, F.slice("embedding", 1, 56)).otherwise(F.col("embedding")).alias("value"),
    )


def _list(values):
    return f"[{', '.join(map(catalog.sql_value, values))}]"


MESSAGES_SQL = f"""msg as (select 'enfo-pf_' || (vec_id // 4) as url, (vec_id % 4)::int as dataset_no, {_list(NAMES)}[(label + vec_id % 3) % 8 + 1] as short_name, [192, 1, 77][vec_id % 3 + 1] as parameter_number,
  {_list(KINDS)}[vec_id % 5 % 3 + 1] as type_of_level, {_list(LEVELS)}[vec_id % 7 % 3 + 1] as level, case when vec_id % 11 = 0 then 'avg' else 'instant' end as step_type, timestamp '2024-01-01' + to_hours((vec_id // 4 % 6 * 6)::int) as init_time,
  (vec_id // 24 % 5)::int as step, (vec_id % 2 + 1)::int as ensemble_member, case when vec_id % 23 = 0 then 7 else 8 end as ny, 600000 as lat_first, 3530000 + vec_id // 4 % 2 * 70000 as lon_first,
  case when vec_id % 31 = 0 then embedding[1:63] when vec_id % 23 = 0 then embedding[1:56] else embedding end as value from embeddings)"""
WANTED_SQL = """((short_name in ('tcc', 'hcc', 'lcc', 'mcc') and level = 0 and type_of_level in ('highCloudLayer', 'lowCloudLayer', 'middleCloudLayer', 'convectiveCloudLayer') and step_type = 'instant') or short_name in ('u10', 'v10', 'u100', 'v100')
  or (type_of_level in ('surface', 'heightAboveGround') and level in (0, 2) and step_type = 'instant') or (type_of_level = 'surface' and step_type = 'avg' and short_name in ('sdswrf', 'sdlwrf'))) and short_name not in ('t', 'sdwe')"""
FILTERED, UNKNOWN, LATE = f"when not ({WANTED_SQL}) then 'filtered'", f"when variable is null or variable not in ({', '.join(map(catalog.sql_value, ALLOWED))}) then 'unknown name'", "when step > 3 then 'late step'"
SIZE = "when len(value) <> ny * 8 then 'size'"
LON_SQL = "((lon_first + 10000 * (p % 8) + 1800000) % 3600000 - 1800000)"


def kind_sql(reasons: str, y: str, x: str, policy: str, steps: int, alias: str = "short_name", levels: str = "false", trim: str = "true", member: bool = False) -> tuple[str, ...]:
    """Common tables up to `consumed` and `tally`, for messages that go for these reasons, in this order."""
    extra = ["ensemble_member"] if member else []
    keys = [*extra, "y", "x"]
    tagged = f"""named as (select m.*, variable, alias_ord from (select *, {alias} as alias from msg) m left join aliases using (alias)),
    reasoned as (select *, case {reasons} end as early from named),
    known as (select *, min(case when early is null then alias_ord end) over w as first_ord, min(case when early is null then level end) over w as low, max(case when early is null then level end) over w as high from reasoned window w as (partition by init_time, url, variable)),
    tagged as (select *, coalesce(early, case when alias_ord <> first_ord then 'another name' when {levels} and low < high and level <> 1 then 'other level' end) as reason from known),
    spread as (select init_time, url, dataset_no, step, variable, ensemble_member, {y} as y, {x} as x, value[p + 1]::double as value from tagged, generate_series(0, 63) g(p) where reason is null and p < len(value) and {trim}),
    tally as (select init_time, reason, count(*) as n_messages from tagged group by 1, 2)"""
    cells = f"select init_time, url, variable, step, {', '.join(keys)}, false as outside, arg_min(value, dataset_no) as value from spread group by all"
    lost = {"any": "bool_or(not kept)", "all": "bool_and(not kept)", "never": "false"}[policy]
    failing = f"""select init_time, url from tagged group by 1, 2 having bool_or(reason = 'size') union select init_time, url from (select init_time, url, dataset_no, bool_or(coalesce(reason in ('late step', 'another name', 'other level'), true)) as kept from tagged group by all) group by 1, 2 having {lost}"""
    images = f"select init_time, s as step, v as variable{', m as ensemble_member' if member else ''} from wanted, generate_series(0, {steps - 1}) a(s), unnest({_list(ALLOWED)}) b(v){', generate_series(1, 2) c(m)' if member else ''}"
    gaps = "max(step) - min(step) + 1 <> count(distinct step)"
    return (MESSAGES_SQL, catalog.ALIAS_SQL, tagged, consumed_sql(cells, "select distinct init_time from msg", images, "(select count(distinct y) * count(distinct x) from spread)", 0.05, 0.9, 0.3, keys, failing, gaps))


RESULT_SQL = f"select {', '.join(OUTCOME)}, null::varchar as reason, null::bigint as n_messages from consumed union all select init_time, {', '.join('null' for _ in OUTCOME[1:])}, reason, n_messages from tally"


def judged(spark, folder, plan, steps, members=()):
    """Outcomes of all runs, and how many messages went and why; the model's axes are as wide as its files' values lie."""
    fields = messages(spark, folder)
    with s.scratch(spark):
        lines = a.ticks(c.convert(plan, ALLOWED)(fields)[0].select(plan.y, plan.x))
        row = lambda d, values, text: spark.createDataFrame([(d, None if text else float(v), v if text else None) for v in values], "dim string, num double, str string")
        axis = lines.unionByName(row("step", range(steps), False)).unionByName(row("variable", ALLOWED, True))
        axis = s.kept(a.ordered(axis.unionByName(row("ensemble_member", members, False)) if members else axis), "axis")
        fetch = lambda missing: fields.join(F.broadcast(missing.withColumnRenamed("init_time", "time")), "time", "left_semi")
        done = r.consume(spark, s.new_path(spark, "store"), "images", axis, fields.select(F.col("time").alias("init_time")).distinct(), fetch, ALLOWED, rules=RULES, convert=c.convert(plan, ALLOWED))
    tally = c.gone(fields, plan, ALLOWED).groupBy("init_time", "reason").agg(F.sum("n").alias("n_messages"))
    return done.runs.select(*OUTCOME).unionByName(tally, allowMissingColumns=True)


@query(RESULT_SQL, *kind_sql(f"{FILTERED} {UNKNOWN} {SIZE}", "600000 - 10000 * (p // 8)", LON_SQL, "all", 5))
def consume_filtered(spark, folder):
    """Files of many levels, of which five filters take some; longitudes pass 360 degrees; a file fails if nothing is left."""
    return judged(spark, folder, c.Plan("gfs", filters=True), 5)


@query(RESULT_SQL, *kind_sql(f"{UNKNOWN} {LATE} {SIZE}", "600000 + 10000 * (p // 8)", LON_SQL, "any", 4, trim="p % 8 < 7"))
def consume_tiles(spark, folder):
    """Tiles from south to north that overlap by a column, cut off after a step; any data set without anything wanted fails its file."""
    return judged(spark, folder, c.Plan("global", last_step=3, by=(10000, 10000), trimmed=True), 4)


@query(RESULT_SQL, *kind_sql(f"{UNKNOWN} when step > 3 then 'late step' when len(value) <> ny * 8 or ny <> 8 then 'size'", "700000 - 2000 * (7 - p // 8)", "-576000 + 2000 * (p % 8)", "never", 4, levels="alias in ('t')",
  alias="case when short_name = 'unknown' then case parameter_number when 192 then 'u10' when 1 then 'tcc' else 'unknown' end else short_name end"))
def consume_metres(spark, folder):
    """Files on the model's own lines, turned, with names by parameter number and one level of those that have several; other sizes fail a file."""
    plan = c.Plan("ukv", "y_laea", "x_laea", numbers=True, level_one=("t",), last_step=3, lines=((700000, -2000, 8), (-576000, 2000, 8)), turned=True)
    return judged(spark, folder, plan, 4)


IN_BOX = "when not (lon_first + 70000 between 3600000 and 3700000) then 'elsewhere' when step not between 0 and 3 then 'other step'"


@query(RESULT_SQL, *kind_sql(f"{UNKNOWN} {IN_BOX} {SIZE}", "600000 - 10000 * (p // 8)", LON_SQL, "all", 4, member=True))
def consume_ensemble(spark, folder):
    """Members, tagged by the file's name, of which only data sets in a box and of some steps are wanted."""
    return judged(spark, folder, c.Plan("realtime", tagged="ensemble_member", box=(600000, 3600000, 500000, 3700000), steps=(0, 3)), 4, (1, 2))
