"""How a model's cells lie: which columns place a cell, which of them name its image, and which are folders of a store.

All follows from the dimensions that cells have, so that members, statistics and metres need no code of their own.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .axes import DIMS, FALLING, SPACE, column_of

_TYPES = {"init_time": "timestamp_ntz", "variable": "string", "ensemble_stat": "string"}
#: Dimensions that are folders: one file never holds two of their ticks. Statistics and members aren't: a member of one
#: variable is a few megabytes; sorted inside a variable's files, they are found by the statistics of row groups.
FOLDERS = ["init_time", "variable"]


@dataclass(frozen=True)
class Layout:
    dims: tuple[str, ...]

    @property
    def keys(self) -> list[str]:
        """The columns that place a cell, in canonical order."""
        return [column_of(d) for d in self.dims]

    @property
    def image(self) -> list[str]:
        """The columns that name an image: all but those of its area."""
        return [column_of(d) for d in self.dims if d not in SPACE]

    @property
    def parts(self) -> list[str]:
        """The columns that are folders of a store."""
        return [d for d in FOLDERS if d in self.dims]

    @property
    def order(self) -> list[Column]:
        """The order of cells in a file: images first, each from north to south and from west to east."""
        return [F.desc(column_of(d)) if d in FALLING else F.asc(column_of(d)) for d in self.dims if d not in self.parts]

    @property
    def schema(self) -> str:
        """The cells of a store of this layout, folders last, as Spark reads them."""
        kind = lambda d: f"{column_of(d)} {_TYPES.get(d, 'int')}"
        return ", ".join([*(kind(d) for d in self.dims if d not in self.parts), "value double", *(kind(d) for d in self.parts)])


def layout_of(columns: Iterable[str]) -> Layout:
    """The layout of cells with these columns."""
    have = set(columns)
    return Layout(tuple(d for d in DIMS if column_of(d) in have))


def layout_on(axis: DataFrame) -> Layout:
    """The layout of a model's cells from its axis table; a dimension without ticks counts as there. At most one row for each dimension comes to the driver."""
    have = {r.dim for r in axis.select("dim").distinct().collect()} | {"init_time"}
    return Layout(tuple(d for d in DIMS if d in have))
