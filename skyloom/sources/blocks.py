"""Stores of dense blocks: a row holds a tile of an image as one array, not a row for each cell.

A block row is (image keys, cy, cx, z, n, value): the tile's place among tiles, its place on a Z-order curve, how many of
its cells have a value, and by * bx values in row order, null where none is. Tiles at the grid's edge are filled with nulls.
Inside a run and variable rows lie along the curve, so that the tiles of a box are near each other and the statistics of
row groups and pages leave the others unread. Blocks are published as versions (see versions).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.axes import COLUMN, FALLING, LABELS, RISING, column_of
from ..operators.layout import Layout, layout_on
from . import storage, versions

#: Bytes of a row group: small, so that a box reads little more than its own tiles.
GROUP_BYTES = 8 << 20
#: An index or a label, several, or a slice; slices of indices end before their end, those of labels with it.
Choice = int | float | str | slice | list


@dataclass(frozen=True)
class Form:
    """How a model's images are cut: the layout of its cells, the lines of its grid, and a tile's height and width."""

    layout: Layout
    ny: int
    nx: int
    by: int
    bx: int

    @property
    def y(self) -> str:
        return next(d for d in self.layout.dims if d in FALLING)

    @property
    def x(self) -> str:
        return next(d for d in self.layout.dims if d in RISING)

    @property
    def keys(self) -> list[str]:
        return [*self.layout.image, "cy", "cx"]

    @property
    def schema(self) -> str:
        """Block rows as Spark reads them, folders last."""
        kinds = dict(c.rsplit(" ", 1) for c in self.layout.schema.split(", "))
        inner = [c for c in self.layout.image if c not in self.layout.parts]
        return ", ".join([*(f"{c} {kinds[c]}" for c in inner), "cy int, cx int, z long, n int, value array<double>", *(f"{c} {kinds[c]}" for c in self.layout.parts)])


def form_on(axis: DataFrame, by: int = 64, bx: int = 64) -> Form:
    """The form of a model's blocks from its axis table; tiles are no larger than the grid. A count for each dimension comes to the driver."""
    if by < 1 or bx < 1:
        raise ValueError("a tile has at least one cell")
    layout = layout_on(axis)
    lines = {r.dim: r.n for r in axis.groupBy("dim").agg(F.count("idx").alias("n")).collect()}
    y, x = ([d for d in layout.dims if d in some] for some in (FALLING, RISING))
    if len(y) != 1 or len(x) != 1:
        raise ValueError(f"blocks need one vertical and one horizontal axis, not {y} and {x}")
    ny, nx = lines[y[0]], lines[x[0]]
    return Form(layout, ny, nx, max(1, min(by, ny)), max(1, min(bx, nx)))


def curve(y: Column, x: Column) -> Column:
    """The place of (y, x), each below 65,536, on the Z-order curve: their bits in turn."""

    def spaced(c: Column) -> Column:
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return c

    return F.shiftleft(spaced(y.cast("long")), 1).bitwiseOR(spaced(x.cast("long")))


def _lines(axis: DataFrame, dim: str, index: str) -> DataFrame:
    """(index, tick's column as cells have it) of one axis."""
    tick = F.round(F.col("num") * 10000) if dim in COLUMN else F.col("num")
    return axis.where((F.col("dim") == dim) & F.col("idx").isNotNull()).select(F.col("idx").alias(index), tick.cast("int").alias(column_of(dim)))


def tiles(cells: DataFrame, axis: DataFrame, form: Form) -> DataFrame:
    """Cells as pieces of blocks: (image keys, cy, cx, piece), with a null where a tile has no cell and {v} where it has one, also of null.

    Cells beside the grid's lines have no place in a block: axes.regions tells them, and they raise here, as leaving them out
    would lose them. Of cells at one place the greatest value stays. One shuffle by place and one by tile, which both combine
    rows before they are sent.
    """
    y, x = _lines(axis, form.y, "iy"), _lines(axis, form.x, "ix")
    there = cells.join(y, column_of(form.y), "left").join(x, column_of(form.x), "left")
    off = F.raise_error(F.concat(F.lit("no grid line for a cell at "), F.col(column_of(form.y)).cast("string"), F.lit(", "), F.col(column_of(form.x)).cast("string")))
    sure = lambda c: F.when(F.col(c).isNull(), off.cast("int")).otherwise(F.col(c)).alias(c)
    placed = there.select(*form.layout.image, sure("iy"), sure("ix"), F.struct(F.col("value").cast("double").alias("v")).alias("value"))
    return storage.pack(placed, form.layout.image, form.by, form.bx).withColumnRenamed("value", "piece")


def _filled(rows: DataFrame, form: Form, value: Column) -> DataFrame:
    whole = rows.select(*form.keys, curve(F.col("cy"), F.col("cx")).alias("z"), value.alias("value"))
    return whole.withColumn("n", F.size(F.filter("value", lambda v: v.isNotNull())))


def write(blocks: DataFrame, path: str, form: Form, group_bytes: int = GROUP_BYTES) -> None:
    """Writes whole folders, rows along the curve inside; others at the path stay."""
    inner = [c for c in form.layout.image if c not in form.layout.parts]
    storage.write_folders(blocks, path, form.layout.parts, ["z", *inner], **{"parquet.block.size": str(group_bytes)})


def publish(cells: DataFrame, axis: DataFrame, path: str, form: Form, version: str | None = None) -> str:
    """Writes whole runs as blocks, in the place of what these runs had; the version's name."""
    return versions.put(_filled(tiles(cells, axis, form), form, F.transform("piece", lambda p: p["v"])), path, partial(write, form=form), True, version)


def upsert(cells: DataFrame, axis: DataFrame, path: str, form: Form, version: str | None = None) -> str:
    """Puts cells into their blocks: those that are given win their places, also with null; all others stay.

    Folders that no cell touches are neither read nor written. Blocks meet by a join, place by place inside.
    """
    new, old = tiles(cells, axis, form), found(cells.sparkSession, path, form)
    if old is None:
        return publish(cells, axis, path, form, version)
    touched = cells.select(*form.layout.parts).distinct()
    both = old.join(touched, form.layout.parts, "left_semi").select(*form.keys, "value").join(new, form.keys, "full")
    merged = F.zip_with("value", "piece", lambda o, p: F.when(p.isNull(), o).otherwise(p["v"]))
    merged = F.when(F.col("piece").isNull(), F.col("value")).when(F.col("value").isNull(), F.transform("piece", lambda p: p["v"])).otherwise(merged)
    return versions.put(_filled(both, form, merged), path, partial(write, form=form), False, version)


def found(spark: SparkSession, path: str, form: Form) -> DataFrame | None:
    """The block rows of the last state, or None where there are none."""
    return versions.found(spark, path, form.schema)


def _picked(lines: list, by_index: Choice | None, by_label: Choice | None) -> list[int]:
    """Indices of a choice on one axis; what isn't there raises, but for slices, which end where the axis does."""
    every = list(range(len(lines)))
    if by_index is not None:
        every = every[by_index] if isinstance(by_index, slice) else [every[i] for i in (by_index if isinstance(by_index, list) else [by_index])]
    if by_label is None:
        return every
    if isinstance(by_label, slice):
        if by_label.step is not None:
            raise ValueError("a slice of labels has no step")
        ends = [e for e in (by_label.start, by_label.stop) if e is not None]
        if len(ends) == 2:
            return [i for i in every if min(ends) <= lines[i] <= max(ends)]
        rising = len(lines) < 2 or lines[0] < lines[-1]
        after = (by_label.start is not None) == rising  # what is open goes on to the axis's own end
        return [i for i in every if not ends or (lines[i] >= ends[0] if after else lines[i] <= ends[0])]
    place = {tick: i for i, tick in enumerate(lines)}
    wanted = {place[t] for t in (by_label if isinstance(by_label, list) else [by_label])}
    return [i for i in every if i in wanted]


def _among(c: Column, values: list, whole: list) -> Column:
    """Whether c is one of the values: between two where they are neighbours on the axis, so that scans can prune."""
    if not values:
        return F.lit(False)
    low, high = min(values), max(values)
    if len(set(values)) == sum(low <= t <= high for t in whole):
        return c.between(low, high)
    return c.isin(sorted(set(values)))


def select(blocks: DataFrame, axis: DataFrame, form: Form, isel: Mapping[str, Choice] | None = None, sel: Mapping[str, Choice] | None = None) -> DataFrame:
    """Cells (the layout's keys, value) at some indices and labels of the model's axes; dimensions that aren't named are whole, runs are chosen by a filter on blocks.

    Both kinds of choice may name the same dimension and then must both hold. Labels are degrees, metres, hours, members or
    names. Choices become ranges of tiles, steps and members that the scan takes; only tiles that are left are unfolded.
    Cells without value aren't returned. Ticks of the axes that are named come to the driver: at most a grid's lines each.
    """
    isel, sel = dict(isel or {}), dict(sel or {})
    named = sorted({*isel, *sel})
    if odd := [d for d in named if d not in form.layout.dims or d == "init_time"]:
        raise ValueError(f"no such axis: {odd}")
    lines: dict[str, list] = {d: [] for d in named}
    for r in axis.where(F.col("dim").isin(named) & F.col("idx").isNotNull()).orderBy("dim", "idx").collect() if named else []:
        lines[r.dim].append(r.str if r.dim in LABELS else r.num)
    at = {d: _picked(lines[d], isel.get(d), sel.get(d)) for d in named}
    tiles_wanted, cells_wanted = F.lit(True), F.lit(True)
    for d in named:
        if d in (form.y, form.x):
            side, index, tile = (form.by, "iy", "cy") if d == form.y else (form.bx, "ix", "cx")
            every = range(len(lines[d]))
            tiles_wanted &= _among(F.col(tile), [i // side for i in at[d]], sorted({i // side for i in every}))
            cells_wanted &= _among(F.col(index), at[d], list(every))
        else:
            plain = lambda t: t if isinstance(t, str) else int(t)
            tiles_wanted &= _among(F.col(d), [plain(lines[d][i]) for i in at[d]], [plain(t) for t in lines[d]])
    cells = storage.unpack(blocks.where(tiles_wanted), form.layout.image, form.by, form.bx).where(cells_wanted)
    return cells.join(_lines(axis, form.y, "iy"), "iy").join(_lines(axis, form.x, "ix"), "ix").select(*form.layout.keys, "value")
