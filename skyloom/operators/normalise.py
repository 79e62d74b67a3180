"""From decoded fields to canonical cells: names, levels, steps, grids. Each takes the fields of all files at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import catalog
from .errors import errors

# What a parameter number says where the short name is unknown.
UNKNOWN = {192: "u10", 193: "v10", 194: "wdir", 195: "si10", 1: "tcc"}


def named(fields: DataFrame, alias: str = "alias") -> DataFrame:
    """fields with `variable`, the parameter that the short name stands for; null for unknown names. Canonical names are no aliases."""
    names = catalog.aliases(fields.sparkSession).select(F.col("alias").alias("_alias"), "variable", "alias_ord")
    return fields.join(F.broadcast(names), F.col(alias) == F.col("_alias"), "left").drop("_alias")


def rename_else_drop(fields: DataFrame, allowed: list[str], alias: str = "alias") -> DataFrame:
    """fields whose short name stands for an allowed parameter, with `variable` and `alias_ord`."""
    return named(fields, alias).where(F.col("variable").isin(allowed))


def settle_clashes(fields: DataFrame, file: list[str], alias: str = "alias") -> tuple[DataFrame, DataFrame]:
    """Renamed fields, and error rows of files that hold a parameter under several short names.

    Of these the name that comes first among the parameter's stays, and the others' fields go.
    """
    names = fields.groupBy(*file, "variable").agg(F.min("alias_ord").alias("_least"), F.max("alias_ord").alias("_most"), F.sort_array(F.collect_set(alias)).alias("_names"))
    clash = names.where("_least < _most")
    where = F.concat_ws("/", *(F.col(c).cast("string") for c in file))
    said = errors(clash, "rename", "several short names", None, where, F.concat(F.col("variable"), F.lit(": "), F.array_join("_names", ", ")))
    first = clash.select(*(F.col(c).alias(f"_{c}") for c in [*file, "variable"]), F.col("_least"))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*file, "variable"]]
    both = fields.join(first, on, "left").where(F.col("_least").isNull() | (F.col("alias_ord") == F.col("_least")))
    return both.select(*(fields[c] for c in fields.columns)), said


def resolve_unknown(name: str, number: str) -> Column:
    """The short name, found by parameter number where the file calls it unknown."""
    by_number = F.create_map(*[F.lit(x) for pair in UNKNOWN.items() for x in pair])
    return F.when(F.col(name) == "unknown", F.coalesce(F.try_element_at(by_number, F.col(number).cast("int")), F.col(name))).otherwise(F.col(name))


# The five filters of messages, and the names that are dropped after them.
CLOUDS, CLOUD_LAYERS = ["tcc", "hcc", "lcc", "mcc"], ["highCloudLayer", "lowCloudLayer", "middleCloudLayer", "convectiveCloudLayer"]
WINDS = ["u10", "v10", "u100", "v100"]
SURFACES, SURFACE_LEVELS = ["surface", "heightAboveGround"], [0, 2]
RADIATION = ["sdswrf", "sdlwrf"]
DROPPED = ["t", "sdwe"]


def is_wanted() -> Column:
    """Whether any of the five filters takes a message, and it isn't one of the dropped names (`t`: on several levels; `sdwe`: there twice)."""
    name, level, kind, step = F.col("short_name"), F.col("level"), F.col("type_of_level"), F.col("step_type")
    clouds = name.isin(CLOUDS) & (level == 0) & kind.isin(CLOUD_LAYERS) & (step == "instant")
    surface = kind.isin(SURFACES) & level.isin(SURFACE_LEVELS) & (step == "instant")
    radiation = (kind == "surface") & (step == "avg") & name.isin(RADIATION)
    return (clouds | name.isin(WINDS) | surface | radiation) & ~name.isin(DROPPED)


def wanted_messages(messages: DataFrame, key: list[str] | None = None, order: str | None = None) -> DataFrame:
    """Messages that the filters take. One scan judges them all, so that a message which several take comes once.

    With a key, of messages that share it the first in order stays, as data sets are merged.
    """
    kept = messages.where(is_wanted())
    return merge_first_wins(kept, key, order) if key else kept


def merge_first_wins(fields: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each cell: that of the first data set which has it."""
    return fields.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where("_n = 1").drop("_n")


def select_level(fields: DataFrame, file: str, variable: str, level: str, only: list[str]) -> DataFrame:
    """Level 1 of the variables in `only` where a file has several levels of them; all else stays."""
    several = fields.where(F.col(variable).isin(only)).groupBy(file, variable).agg(F.min(level).alias("_a"), F.max(level).alias("_b")).where("_a < _b").select(F.col(file).alias("_f"), F.col(variable).alias("_v"))
    both = fields.join(several, (F.col(file) == F.col("_f")) & (F.col(variable) == F.col("_v")), "left")
    return both.where(F.col("_f").isNull() | (F.col(level) == 1)).drop("_f", "_v")


def step_cutoff(fields: DataFrame, last_step: int) -> DataFrame:
    return fields.where(F.col("step") <= last_step)


def unpivot(fields: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """One row for each variable of a wide row: keys, variable, value."""
    return fields.unpivot(keys, variables, "variable", "value")


def wrap_longitude(lon_e4: Column) -> Column:
    """0..360 degrees to -180..180 by floored modulo, in ten-thousandths; +180 becomes -180."""
    return F.pmod(lon_e4 + 1800000, F.lit(3600000)) - 1800000


def promote(messages: DataFrame) -> DataFrame:
    """Messages with their own time and step as columns of the data: `time` becomes init_time, a missing step is 0."""
    return messages.withColumnRenamed("time", "init_time").withColumn("step", F.coalesce("step", F.lit(0)).cast("int"))


def normalise_messages(messages: DataFrame, allowed: list[str], y: tuple[int, int, int], x: tuple[int, int, int]) -> tuple[DataFrame, DataFrame]:
    """Canonical cells of decoded messages on one grid, and error rows.

    Names are resolved and renamed, times promoted, values unfolded to (iy, ix), and the expected coordinates (first, by,
    count; metres) put in the place of the file's; of equal cells the first data set's stays. Surplus columns go.
    """
    known = promote(messages.withColumn("alias", resolve_unknown("short_name", "parameter_number")))
    kept, clashes = settle_clashes(rename_else_drop(known, allowed), ["file_name"])
    keys = ["file_name", "dataset_no", "init_time", "step", "variable", "number"]
    cells = merge_first_wins(unflatten(kept, keys, "value", y[2], x[2]), ["init_time", "step", "variable", "number", "iy", "ix"], "dataset_no")
    placed = cells.withColumns({"y": (y[0] + F.col("iy") * y[1]).cast("int"), "x": (x[0] + F.col("ix") * x[1]).cast("int")})
    placed = placed.select("init_time", "step", "variable", F.col("number").alias("ensemble_member"), "iy", "ix", "y", "x", "value")
    return placed, clashes.unionByName(wrong_length(kept, "file_name", "value", y[2], x[2]))


def normalise_fields(fields: DataFrame, allowed: list[str], order: str = "event_id") -> DataFrame:
    """Canonical cells of raw fields: known names, wrapped longitudes, of equal cells the first in order, columns in canonical order."""
    known = rename_else_drop(fields, allowed).withColumn("lon_e4", wrap_longitude(F.col("lon_e4")).cast("int"))
    cells = merge_first_wins(known, ["init_time", "step", "variable", "lat_e4", "lon_e4"], order)
    return cells.select("init_time", "step", "variable", "lat_e4", "lon_e4", "value")


def trim_overlap(tiles: DataFrame, file: str = "init_time") -> DataFrame:
    """Tiles without their last column, which the neighbour has too, and with rows from north to south (iy turned)."""
    size = tiles.groupBy(F.col(file).alias("_f")).agg(F.max("ix").alias("_x"), F.max("iy").alias("_y"))
    return tiles.join(size, F.col(file) == F.col("_f")).where("ix < _x").withColumn("iy", F.col("_y") - F.col("iy")).drop("_f", "_x", "_y")


def stat_of(file_name: Column) -> Column:
    """The statistic a file holds, from its name."""
    return F.when(F.contains(file_name, F.lit("enfo-es")), "std").when(F.contains(file_name, F.lit("enfo-em")), "mean")


def member_of(file_name: Column, number: Column) -> Column:
    return F.when(F.contains(file_name, F.lit("enfo-pf")), number)


def unflatten(flat: DataFrame, key: list[str], values: str, ny: int, nx: int) -> DataFrame:
    """Cells (key, iy, ix, value) of flat rows of ny * nx values; rows of another length are left out (see wrong_length)."""
    good = flat.where(F.size(values) == ny * nx).select(*key, F.posexplode(values).alias("_p", "value"))
    return good.select(*key, F.expr(f"cast(_p div {nx} as int)").alias("iy"), (F.col("_p") % nx).cast("int").alias("ix"), "value")


def wrong_length(flat: DataFrame, file: str, values: str, ny: int, nx: int) -> DataFrame:
    """Error rows of flat rows that are not ny * nx long."""
    bad = flat.where(F.col(values).isNull() | (F.size(values) != ny * nx))
    return errors(bad, "unflatten", "size", None, file, F.coalesce(F.size(values), F.lit(0)))


def _grid_sizes(cells: DataFrame, file: str) -> DataFrame:
    return cells.groupBy(F.col(file).alias("_f")).agg((F.max("iy") + 1).alias("_ny"), (F.max("ix") + 1).alias("_nx"))


def expected_grid(cells: DataFrame, file: str, y: tuple[int, int, int], x: tuple[int, int, int]) -> tuple[DataFrame, DataFrame]:
    """Cells with the expected coordinates (first, by, count) in place of their own, rows turned so that y falls; error rows of files of another size."""
    size = _grid_sizes(cells, file).withColumn("_fits", (F.col("_ny") == y[2]) & (F.col("_nx") == x[2]))
    fit = cells.join(size.where("_fits"), F.col(file) == F.col("_f")).withColumn("iy", F.lit(y[2] - 1) - F.col("iy"))
    placed = fit.withColumns({"y": (y[0] + F.col("iy") * y[1]).cast("int"), "x": (x[0] + F.col("ix") * x[1]).cast("int")}).drop("_f", "_ny", "_nx", "_fits")
    return placed, errors(size.where("not _fits"), "grid", "size", None, "_f", F.concat_ws("x", "_ny", "_nx"))


def relevant(cells: DataFrame, keys: list[str], box: tuple[int, int, int, int], steps: tuple[int, int]) -> DataFrame:
    """Keys of data sets whose greatest latitude and longitude lie in the box (north, west, south, east) and whose step is expected."""
    n, w, s, e = box
    top = cells.groupBy(*keys).agg(F.max("lat_e4").alias("_y"), F.max("lon_e4").alias("_x"), F.min("step").alias("_s"))
    return top.where(F.col("_y").between(s, n) & F.col("_x").between(w, e) & F.col("_s").between(*steps)).select(*keys)


#: Which files fail, by conversion: those with any data set that holds nothing wanted, those with none that does, or none at all.
POLICIES = {"global": "any", "ukv": "never", "realtime": "all", "gfs": "all"}


def nothing_relevant(sets: DataFrame, run: str, file: str, kept: str, kind: str) -> DataFrame:
    """Error rows of files that hold nothing wanted; sets: one row for each data set of a file, `kept` whether it is wanted, `kind` its conversion."""
    policy = F.element_at(F.create_map(*[F.lit(v) for pair in POLICIES.items() for v in pair]), F.col(kind))
    facts = sets.groupBy(run, file, kind).agg(F.count("*").alias("_n"), F.count_if(kept).alias("_kept"))
    bad = facts.where(F.when(policy == "any", F.col("_kept") < F.col("_n")).when(policy == "all", F.col("_kept") == 0).otherwise(False))
    return errors(bad, "convert", "nothing relevant", run, file, kind)


def canonical_axis(values: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """(num, idx): a coordinate rounded to 4 places (half to even), each once, in canonical order."""
    ticks = values.select(F.bround(column, 4).alias("num")).where("num is not null").distinct()
    return numbered(ticks, [F.col("num").desc() if descending else F.col("num")])


def numbered(rows: DataFrame, order: list[Column], by: tuple[str, ...] = (), name: str = "idx") -> DataFrame:
    """rows with their place in order. An axis has as many ticks as a grid has lines, not as there are cells."""
    window = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    return rows.withColumn(name, F.row_number().over(window.orderBy(*order)) - 1)
