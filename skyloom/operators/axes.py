"""Axes, regions and skeletons: where pieces belong in the whole, and what the whole should hold.

An axis table has a row for each tick: (by, dim, idx, num, str). Times are seconds, coordinates degrees or metres; only
variables and statistics have str. A dimension that is there without ticks has one row whose idx is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .errors import errors
from .normalise import numbered

# All dimensions, in their order.
DIMS = ["init_time", "step", "variable", "ensemble_stat", "ensemble_member", "latitude", "longitude", "y_osgb", "x_osgb", "y_laea", "x_laea"]
REQUIRED = DIMS[:3]
#: Ordered from north to south, and from west to east, in the order in which they are checked.
FALLING, RISING = ["latitude", "y_osgb", "y_laea"], ["longitude", "x_osgb", "x_laea"]
SPACE = DIMS[5:]
LABELS = ["variable", "ensemble_stat"]
#: Columns of cells that hold a dimension under another name.
COLUMN = {"latitude": "lat_e4", "longitude": "lon_e4"}


def column_of(dim: str) -> str:
    return COLUMN.get(dim, dim)


def tick_of(dim: str) -> Column:
    """A cell's tick on a dimension, as axis tables hold it."""
    c = F.col(column_of(dim))
    if dim in LABELS:
        return c.cast("string")
    return (F.unix_seconds(c.cast("timestamp")) if dim == "init_time" else c / 10000 if dim in COLUMN else c).cast("double")


def place(dim: str = "dim") -> Column:
    """A dimension's place in the order of all, from 1; 0 for unknown ones."""
    return F.array_position(F.array(*map(F.lit, DIMS)), F.col(dim)).cast("int")


def ticks(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, dim, num, str) of every different tick of each dimension that the cells have.

    One shuffle, of sets that are joined before it: a row has what a task saw of an axis, never a cell.
    """
    have = [d for d in DIMS if column_of(d) in cells.columns]
    sets = cells.groupBy(*by).agg(*(F.collect_set(tick_of(d)).alias(d) for d in have))
    none = lambda kind: F.lit(None).cast(kind)
    row = lambda d: F.transform(d, lambda x: F.struct(F.lit(d).alias("dim"), (none("double") if d in LABELS else x).alias("num"), (x if d in LABELS else none("string")).alias("str")))
    return sets.select(*by, F.inline(F.flatten(F.array(*map(row, have)))))


def ordered(axis: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Ticks with idx: north to south where a dimension falls, everything else ascending."""
    return numbered(axis, [F.when(F.col("dim").isin(FALLING), -F.col("num")).otherwise(F.col("num")), F.col("str")], (*by, "dim"))


def validate(axis: DataFrame, by: str, known: list[str]) -> DataFrame:
    """(by, breach): the first rule that the axes of each group break, as they are given, else null."""
    here = lambda d: F.col("dim") == d
    end = lambda f, d: f(F.when(here(d), F.col("num")), F.when(here(d), F.col("idx")))
    facts = axis.groupBy(by).agg(
        *(F.count_if(here(d)).alias(f"has_{d}") for d in REQUIRED), *(F.count_if(here(d) & F.col("idx").isNotNull()).alias(f"n_{d}") for d in REQUIRED),
        F.count_if(here("variable") & ~F.col("str").isin(known)).alias("unknown"), F.count_if(~F.col("dim").isin(DIMS)).alias("odd"),
        *(end(f, d).alias(f"{name}_{d}") for d in FALLING + RISING for f, name in ((F.min_by, "first"), (F.max_by, "last"))),
    )
    breach = F.when(F.least(*(F.col(f"has_{d}") for d in REQUIRED)) == 0, "missing dimension").when(F.least(*(F.col(f"n_{d}") for d in REQUIRED)) == 0, "empty dimension")
    breach = breach.when(F.col("unknown") > 0, "unknown variable").when(F.col("odd") > 0, "unknown dimension")
    for y, x in zip(FALLING, RISING, strict=True):
        breach = breach.when(F.col(f"first_{y}") < F.col(f"last_{y}"), f"{y} order").when(F.col(f"first_{x}") > F.col(f"last_{x}"), f"{x} order")
    return facts.select(by, breach.alias("breach"))


def encode_times(cells: DataFrame, *keys: str) -> DataFrame:
    """Run time and step in nanoseconds, as stores keep them."""
    nanos = F.unix_micros(F.col("init_time").cast("timestamp")) * 1000
    return cells.select(*keys, nanos.alias("init_time_ns"), (F.col("step").cast("long") * 3600000000000).alias("step_ns"))


def shape(axis: DataFrame, by: str) -> DataFrame:
    """(by, dim, place, length) of the dimensions that are there, in canonical order."""
    return axis.groupBy(by, "dim").agg(F.count("*").alias("length")).select(by, "dim", place().alias("place"), "length")


def _found(inner: DataFrame, outer: DataFrame, piece: str) -> DataFrame:
    """Each tick of the pieces with its place in the outer axis, null if it has none. The outer axis is a grid's lines, the small side."""
    o = outer.where("idx is not null").select("dim", F.col("num").alias("_n"), F.col("str").alias("_s"), F.col("idx").alias("at"))
    some = inner.withColumn("_there", F.col("num").isNotNull() | F.col("str").isNotNull())
    return some.join(o, (some["dim"] == o["dim"]) & some["num"].eqNullSafe(o["_n"]) & some["str"].eqNullSafe(o["_s"]), "left").select(piece, some["dim"], "num", "str", "_there", "at")


def regions(inner: DataFrame, outer: DataFrame, piece: str) -> DataFrame:
    """(piece, dim, start, stop, rule): where each piece's axis lies in the outer axis.

    rule is null where all is well, else the first that fails: `dimensions` (the piece hasn't the same ones; all its rows),
    `empty`, `longer` than the outer axis, ticks `outside` it, or not in a row and once (`gaps`). start and stop are those
    of the ticks that were found.
    """
    sizes = outer.groupBy("dim").agg(F.count("idx").alias("_most"))
    theirs = outer.agg(F.sort_array(F.collect_set("dim")).alias("_theirs"))
    facts = _found(inner, outer, piece).groupBy(piece, "dim").agg(
        F.min("at").alias("start"), (F.max("at") + 1).alias("stop"), F.count_if("_there").alias("_n"), F.count_if(F.col("_there") & F.col("at").isNull()).alias("_lost"),
    )
    own = facts.groupBy(F.col(piece).alias("_p")).agg(F.sort_array(F.collect_set("dim")).alias("_own"))
    both = facts.join(own, F.col(piece).eqNullSafe(F.col("_p"))).join(F.broadcast(sizes), "dim", "left").crossJoin(F.broadcast(theirs))
    rule = (
        F.when(F.col("_own") != F.col("_theirs"), "dimensions").when(F.col("_n") == 0, "empty").when(F.col("_n") > F.col("_most"), "longer")
        .when(F.col("_lost") > 0, "outside").when(F.col("stop") - F.col("start") != F.col("_n"), "gaps")
    )
    return both.select(piece, "dim", "start", "stop", rule.alias("rule"))


def placed(cells: DataFrame, outer: DataFrame, run: str, piece: str, blocks: dict[str, int], keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(run, piece, n, rule, dim, odd): each piece's runs with their number of values, and what regions() would say of the piece.

    rule and dim are those of its first failing dimension, null where it has a region; odd says whether a region starts or
    stops inside a block (the ticks of a block of each dimension). The same as regions() of ticks(), but lines of the outer
    axis are joined to cells, so that a piece is one row of numbers throughout. Most pieces are told by their first and last
    places and their number of cells; only where these leave open how many ticks there are, or where a piece has several
    runs, are ticks counted. keep writes a table that is read more than once.
    """
    here = [d for d in DIMS if column_of(d) in cells.columns]
    most = {r.dim: r.n for r in outer.groupBy("dim").agg(F.count("idx").alias("n")).collect()}  # a row for each dimension
    col = lambda name, d: F.col(f"_{name}_{d}")
    wide = lambda d: col("stop", d) - col("from", d)

    def on_lines(rows: DataFrame) -> DataFrame:
        for d in here:
            line = outer.where((F.col("dim") == d) & F.col("idx").isNotNull()).select(F.col("str" if d in LABELS else "num").alias("_line"), F.col("idx").alias(f"_at_{d}"))
            rows = rows.join(F.broadcast(line), tick_of(d) == F.col("_line"), "left").drop("_line")
        return rows

    def ends(d: str) -> list[Column]:
        there = tick_of(d).isNotNull()
        return [F.min(col("at", d)).alias(f"_from_{d}"), (F.max(col("at", d)) + 1).alias(f"_stop_{d}"), F.max(there & col("at", d).isNull()).alias(f"_lost_{d}"), F.max(there).alias(f"_has_{d}")]

    def judged(longer: Callable[[str], Column], gaps: Callable[[str], Column]) -> list[Column]:
        same = F.lit(set(most) <= set(here))
        for d in here:
            same = same & (col("has", d) == F.lit(d in most))
        said = lambda rule, d: F.struct(F.lit(rule).alias("rule"), F.lit(d).alias("dim"))
        wrong, odd = F.lit(None).cast("struct<rule: string, dim: string>"), F.lit(False)
        for d in reversed(here):
            own = F.when(~same, said("dimensions", d)).when(longer(d), said("longer", d)).when(col("lost", d), said("outside", d)).when(gaps(d), said("gaps", d))
            wrong = F.coalesce(F.when(col("has", d), own), wrong)
            if blocks.get(d):
                odd = odd | F.coalesce((col("from", d) % blocks[d] != 0) | (col("stop", d) % blocks[d] != 0), F.lit(False))
        return [wrong["rule"].alias("rule"), wrong["dim"].alias("dim"), odd.alias("odd")]

    quick = on_lines(cells).groupBy(piece).agg(F.min(run).alias(run), F.max(run).alias("_last"), F.count("*").alias("_cells"), F.count("value").alias("n"), *(c for d in here for c in ends(d)))
    unsure = F.col(run).isNull() | (F.col(run) != F.col("_last"))
    for d in here:
        unsure = unsure | F.when(col("lost", d), F.col("_cells") > most.get(d, 0)).otherwise(F.coalesce(wide(d).between(3, F.col("_cells")), F.lit(False)))
    quick = keep(quick.select(run, piece, "n", *judged(lambda d: F.lit(False), lambda d: wide(d) > 2), unsure.alias("_unsure")), "quick")
    sure = quick.where("not _unsure").drop("_unsure")

    # written, so that its size is known and cells aren't shuffled for the few pieces that are left
    left = keep(quick.where("_unsure").select(F.col(piece).alias("_piece")), "unsure")
    rows = on_lines(cells.join(left, F.col(piece).eqNullSafe(F.col("_piece")), "left_semi"))
    each = rows.groupBy(run, piece).agg(F.count("value").alias("n"), *(c for d in here for c in [F.collect_set(tick_of(d)).alias(f"_set_{d}"), *ends(d)]))
    whole = lambda d: [F.size(F.array_distinct(F.flatten(F.collect_list(col("set", d))))).alias(f"_n_{d}"), F.min(col("from", d)).alias(f"_from_{d}"), *(F.max(col(x, d)).alias(f"_{x}_{d}") for x in ("stop", "lost", "has"))]
    facts = each.groupBy(piece).agg(F.collect_list(F.struct(F.col(run).alias("run"), "n")).alias("_runs"), *(c for d in here for c in whole(d)))
    told = facts.select(piece, "_runs", *judged(lambda d: col("n", d) > most.get(d, 0), lambda d: wide(d) != col("n", d)))
    counted = told.select(piece, F.inline("_runs").alias(run, "n"), "rule", "dim", "odd").select(run, piece, "n", "rule", "dim", "odd")
    return sure.unionByName(keep(counted, "counted"))


def region_errors(region: DataFrame, piece: str, run: str | None = None) -> DataFrame:
    """An error row for each piece that has no region: the rule of its first failing dimension."""
    bad = region.where("rule is not null").groupBy(*{piece, run} - {None}).agg(F.min_by(F.struct("rule", "dim"), place()).alias("_bad"))
    return errors(bad, "region", F.col("_bad.rule"), run, piece, F.col("_bad.dim"))


def gaps(inner: DataFrame, outer: DataFrame, piece: str) -> DataFrame:
    """What keeps pieces from having a region: (piece, dim, kind, before, after, tick).

    kind `gap`: outer places on both sides of a hole; kind `outside`: a tick that the outer axis doesn't have.
    """
    both = _found(inner, outer, piece).where("_there")
    last = F.lag("at").over(W.partitionBy(piece, "dim").orderBy("at"))
    holes = both.where("at is not null").withColumn("before", last).where("at > before + 1").select(piece, "dim", F.lit("gap").alias("kind"), "before", F.col("at").alias("after"), F.lit(None).cast("string").alias("tick"))
    none = F.lit(None).cast("int")
    tick = F.coalesce("str", F.format_string("%.4f", "num"))
    return holes.unionByName(both.where("at is null").select(piece, "dim", F.lit("outside").alias("kind"), none.alias("before"), none.alias("after"), tick.alias("tick")))


def expected_images(runs: DataFrame, steps: list[int], variables: list[str], stats: list[str] | None = None, members: list[int] | None = None) -> DataFrame:
    """Every image a store of these runs should have, by statistic or member if the model has them; the grid stays implicit."""
    for name, values in (("step", steps), ("variable", variables), ("ensemble_stat", stats), ("ensemble_member", members)):
        if values:
            runs = runs.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    return runs


def skeleton(axis: DataFrame, by: str) -> DataFrame:
    """The expected images of every group of an axis table, with the area (ny * nx) of each one's grid.

    Columns: by, run time in seconds, step, variable, ensemble_stat and ensemble_member (null where a group has no such
    dimension), area. What is crossed are lists of ticks; the grid is only counted.
    """
    lists = axis.where("idx is not null").groupBy(by).agg(
        *(F.sort_array(F.collect_list(F.when(F.col("dim") == d, F.struct("idx", F.col("str" if d in LABELS else "num").alias("x"))))).alias(d) for d in DIMS[:5]),
        *(F.count_if(F.col("dim") == d).alias(d) for d in SPACE),
    )
    out, area = lists, F.lit(1).cast("long")
    for d in SPACE:
        area = area * F.greatest(F.col(d), F.lit(1))
    out = out.withColumn("area", area)
    for d in DIMS[:5]:
        unfold = F.explode_outer if d in DIMS[3:5] else F.explode
        out = out.withColumn(d, unfold(F.transform(d, lambda t: t["x"])))
    return out.select(by, F.col("init_time").cast("long").alias("init_seconds"), F.col("step").cast("int").alias("step"), "variable", "ensemble_stat", F.col("ensemble_member").cast("int").alias("ensemble_member"), "area")


def inside(north: float, west: float, south: float, east: float) -> Column:
    """Whether a cell lies in one box, edges included: a filter that the scan takes."""
    e4 = lambda x: round(x * 10000)
    return F.col("lat_e4").between(e4(south), e4(north)) & F.col("lon_e4").between(e4(west), e4(east))


def box_rule(box: tuple[Column, ...], edge: tuple[Column, ...]) -> Column:
    """Why boxes (north, west, south, east, degrees) can't be cut from data with these edges (null without coordinates); else null."""
    (n, w, s, e), (top, left, low, right) = box, edge
    return (
        F.when(top.isNull() | left.isNull(), "no latitude or longitude").when(~((s >= -90) & (s < n) & (n <= 90) & (w >= -180) & (w < e) & (e <= 180)), "no such box")
        .when((n > top) | (s < low) | (w < left) | (e > right), "outside the data")
    )


def crop(cells: DataFrame, boxes: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """The cells of each group that lie in its box (by, north, west, south, east), edges included; and error rows of boxes that can't be cut.

    A box must be one on the globe and lie within the group's data: nothing is clipped silently.
    """
    edge = cells.groupBy(by).agg((F.max("lat_e4") / 10000).alias("_n"), (F.min("lon_e4") / 10000).alias("_w"), (F.min("lat_e4") / 10000).alias("_s"), (F.max("lon_e4") / 10000).alias("_e"))
    judged = boxes.join(edge, by, "left").withColumn("_rule", box_rule(tuple(map(F.col, ("north", "west", "south", "east"))), tuple(map(F.col, ("_n", "_w", "_s", "_e")))))
    good = judged.where("_rule is null").select(by, *(F.round(F.col(c) * 10000).cast("int").alias(f"_{c}") for c in ("north", "west", "south", "east")))
    kept = cells.join(good, by).where("lat_e4 between _south and _north and lon_e4 between _west and _east").select(*(cells[c] for c in cells.columns))
    return kept, errors(judged.where("_rule is not null"), "crop", F.col("_rule"), None, by)


def bounds(cells: DataFrame, by: str) -> DataFrame:
    """North, west, south, east of each group in degrees; the whole globe where there are no coordinates."""
    edge = lambda f, c, whole: F.coalesce(f(c) / 10000, F.lit(whole))
    return cells.groupBy(by).agg(edge(F.max, "lat_e4", 90.0).alias("north"), edge(F.min, "lon_e4", -180.0).alias("west"), edge(F.min, "lat_e4", -90.0).alias("south"), edge(F.max, "lon_e4", 180.0).alias("east"))


def misaligned(region: DataFrame, blocks: DataFrame) -> DataFrame:
    """Regions that start or stop inside a block; blocks: (dim, block), the ticks of a block of each dimension."""
    return region.join(F.broadcast(blocks.select("dim", "block")), "dim").where((F.col("start") % F.col("block") != 0) | (F.col("stop") % F.col("block") != 0))
