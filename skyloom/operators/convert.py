"""Conversion plans: what each kind of source does to its messages on the way to cells, declared and folded into one scan.

A plan says which messages go and why, which files fail, and where values lie on the model's grid. All messages of all
files are tagged in one pass with the first reason that makes them go; what needs the whole file (levels, clashing names,
data sets without anything wanted) is found in the tags alone, whose columns hold no values.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import storage
from . import normalise
from .errors import errors, together
from .runs import Convert, within_files

#: A grid's lines: the first one, the distance to the next, and how many there are.
Line = tuple[int, int, int]


@dataclass(frozen=True)
class Plan:
    """How messages of a kind of source become cells.

    filters: only what the five message filters take; numbers: unknown names are found by parameter number; level_one:
    names of which only level 1 stays where a file has several; last_step: later messages go; box and steps: data sets
    whose greatest latitude and longitude lie elsewhere, or whose step isn't expected, go; tagged: statistic or member
    from the file's name. Where values lie: `lines` (y, x) are the model's own, put in the place of the file's and so of
    that size or the file fails; without them a message's first latitude and longitude and `by` (ten-thousandths of a
    degree) say it. turned: rows come from south to north; trimmed: the last column is the neighbour's first. policy:
    which files fail for data sets without anything wanted (see normalise.POLICIES).
    """

    policy: str
    y: str = "lat_e4"
    x: str = "lon_e4"
    filters: bool = False
    numbers: bool = False
    level_one: tuple[str, ...] = ()
    last_step: int | None = None
    box: tuple[int, int, int, int] | None = None
    steps: tuple[int, int] | None = None
    tagged: str | None = None
    lines: tuple[Line, Line] | None = None
    by: tuple[int, int] = (-10000, 10000)
    turned: bool = False
    trimmed: bool = False

    def reason(self, allowed: list[str]) -> Column:
        """Why a message goes: the first rule that it breaks; null for those that stay."""
        rules: list[tuple[Column, str]] = []
        if self.filters:
            rules.append((~F.coalesce(normalise.is_wanted(), F.lit(False)), "filtered"))
        rules.append((~F.coalesce(F.col("variable").isin(allowed), F.lit(False)), "unknown name"))
        if self.last_step is not None:
            rules.append((F.col("step") > self.last_step, "late step"))
        if self.box:
            n, w, s, e = self.box
            lat = F.greatest(F.col("lat_first"), F.col("lat_first") + (F.col("ny") - 1) * self.by[0])
            lon = F.greatest(F.col("lon_first"), F.col("lon_first") + (F.col("nx") - 1) * self.by[1])
            rules.append((~F.coalesce(lat.between(s, n) & lon.between(w, e), F.lit(False)), "elsewhere"))
        if self.steps:
            rules.append((~F.coalesce(F.col("step").between(*self.steps), F.lit(False)), "other step"))
        wrong = F.size("value") != F.col("ny") * F.col("nx")
        if self.lines:
            wrong = wrong | (F.col("ny") != self.lines[0][2]) | (F.col("nx") != self.lines[1][2])
        rules.append((F.col("value").isNull() | F.coalesce(wrong, F.lit(True)), "size"))
        return reduce(lambda c, r: c.when(*r), rules[1:], F.when(*rules[0]))

    def cells(self, kept: DataFrame) -> DataFrame:
        """Cells of the kept messages: keys, value, url, dataset_no."""
        extra = {"ensemble_stat": normalise.stat_of(F.col("url")), "ensemble_member": normalise.member_of(F.col("url"), F.col("number"))}
        tags = [extra[self.tagged].alias(self.tagged)] if self.tagged else []
        names = ["init_time", "step", "variable", *([self.tagged] if self.tagged else []), "url", "dataset_no"]
        flat = kept.select("init_time", "step", "variable", *tags, "url", "dataset_no", "ny", "nx", "lat_first", "lon_first", F.posexplode("value").alias("_p", "value")).where("value is not null")
        iy, ix = F.expr("_p div nx"), F.col("_p") % F.col("nx")
        row = F.col("ny") - 1 - iy if self.turned else iy
        if self.trimmed:
            flat = flat.where(ix < F.col("nx") - 1)
        if self.lines:
            y, x = self.lines[0][0] + row * self.lines[0][1], self.lines[1][0] + ix * self.lines[1][1]
        else:
            y, x = F.col("lat_first") + row * self.by[0], F.col("lon_first") + ix * self.by[1]
        x = normalise.wrap_longitude(x) if self.x == "lon_e4" else x
        return flat.select(*names, y.cast("int").alias(self.y), x.cast("int").alias(self.x), F.col("value").cast("double").alias("value"))


def tagged(messages: DataFrame, plan: Plan, allowed: list[str]) -> DataFrame:
    """Messages (MESSAGES, with url) with init_time, step, variable and the reason that makes them go; those that clash or are of another level than 1 too."""
    known = normalise.promote(messages.withColumn("alias", normalise.resolve_unknown("short_name", "parameter_number") if plan.numbers else F.col("short_name")))
    rows = normalise.named(known).withColumn("reason", plan.reason(allowed))
    rows = storage.kept(rows, "messages")  # decoded once; what follows reads names and levels of it, and values of those that stay
    tags = rows.where("reason is null").groupBy("init_time", "url", "variable").agg(F.min("alias_ord").alias("_first"), F.min("level").alias("_low"), F.max("level").alias("_high"))
    both = rows.join(tags.withColumnsRenamed({c: f"_{c}" for c in ("init_time", "url", "variable")}), F.col("init_time").eqNullSafe(F.col("_init_time")) & (F.col("url") == F.col("_url")) & (F.col("variable") == F.col("_variable")), "left")
    later = F.when(F.col("alias_ord") != F.col("_first"), "another name").when(F.col("alias").isin(list(plan.level_one)) & (F.col("_low") < F.col("_high")) & (F.col("level") != 1), "other level")
    return both.withColumn("reason", F.coalesce("reason", later)).drop("_init_time", "_url", "_variable", "_low", "_high")


def convert(plan: Plan, allowed: list[str]) -> Convert:
    """What consume() does to the messages of this kind: (cells with url and piece, error rows).

    Error rows: files that name a parameter twice, files with a message of a wrong size (they fail), and files that fail
    because data sets hold nothing wanted. Messages that go for other reasons are no errors; gone() counts them.
    """

    def run(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = tagged(messages, plan, allowed)
        cells = within_files(plan.cells(rows.where("reason is null"))).withColumn("piece", F.concat_ws("/", "url", "variable"))
        clash = rows.where("reason = 'another name'").groupBy("init_time", "url", "variable").agg(F.array_join(F.sort_array(F.collect_set("alias")), ", ").alias("_names"))
        wrong = rows.where("reason = 'size'").groupBy("init_time", "url").agg(F.min("dataset_no").alias("_set"))
        sets = rows.groupBy("init_time", "url", "dataset_no").agg(F.max(F.coalesce(F.col("reason").isNull() | F.col("reason").isin("late step", "another name", "other level"), F.lit(False))).alias("_kept")).withColumn("_kind", F.lit(plan.policy))
        return cells, together(
            errors(clash, "rename", "several short names", "init_time", "url", F.concat_ws(": ", "variable", "_names")), errors(wrong, "convert", "size", "init_time", "url", F.col("_set")),
            normalise.nothing_relevant(sets, "init_time", "url", "_kept", "_kind"),
        )

    return run


def gone(messages: DataFrame, plan: Plan, allowed: list[str]) -> DataFrame:
    """(init_time, url, reason, n): how many messages of each file go and why, and how many stay (reason null)."""
    return tagged(messages, plan, allowed).groupBy("init_time", "url", "reason").agg(F.count("*").alias("n"))
