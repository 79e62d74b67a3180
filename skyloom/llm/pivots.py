"""Near-duplicate vectors by a pivot-permutation index.

Each vector is described by its nearest reference points, in order of nearness. Inverted lists, one for each pivot, hold
the vectors that have it among their first few; two vectors of a list are candidates if the pivots they share, weighted
by their places in both orders, count enough. Candidates are verified by their cosine in double precision, each pair in
the first list that has both. How many pivots are described and listed, and what count is enough, is measured on trial
pairs at the threshold, as both depend on the number of pivots.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import lasting, saved, scratch, without
from .vectors import classes, matrix, sample, unit, usable


@dataclass(frozen=True)
class Settings:
    """per_root: pivots for each root of the number of vectors, so that lists keep their length; most_pivots bounds them and so what is sent to executors.

    depth: pivots of a description at least. So many are described and listed, and so low is the count asked for, that a
    share `recall` of `trials` pairs at the threshold are candidates.
    """

    cosine: float = 0.9
    depth: int = 8
    per_root: float = 2.0
    least_pivots: int = 64
    most_pivots: int = 65_536
    block: int = 512
    group_rows: int = 8_000
    apart: float = 0.7
    recall: float = 0.97
    trials: int = 2_000
    seed: int = 19


@dataclass(frozen=True)
class Plan:
    """depth pivots describe a vector, the first `listed` of them have it in their lists, and `least` is the count that makes a candidate."""

    depth: int
    listed: int
    least: float


def nearest(x: np.ndarray, pivots: np.ndarray, depth: int) -> np.ndarray:
    """The `depth` nearest pivots of each vector, in order of nearness."""
    cos = x @ pivots.T
    if depth < cos.shape[1]:
        some = np.argpartition(-cos, depth - 1, axis=1)[:, :depth]
        order = np.argsort(-np.take_along_axis(cos, some, 1), axis=1, kind="stable")
        return np.take_along_axis(some, order, 1)
    return np.argsort(-cos, axis=1, kind="stable")[:, :depth]


def describe(nodes: DataFrame, pivots: np.ndarray, depth: int) -> DataFrame:
    """nodes with `near`: the `depth` nearest pivots in order of nearness."""
    sent = nodes.sparkSession.sparkContext.broadcast(pivots.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch.column(batch.schema.get_field_index("vec")))).astype(np.float32)
            near = np.concatenate([nearest(x[i : i + 512], p, depth) for i in range(0, len(x), 512)])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * near.shape[1]), pa.array(near.reshape(-1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "near"])

    return nodes.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema) + ", near array<int>")


def reference_points(found: np.ndarray, size: int, s: Settings) -> np.ndarray:
    """Unit vectors of a sample that lie apart, in its order, and random directions up to the least number.

    Pivots inside one crowd would order differently for each of its members; one of them describes them all alike.
    """
    x = unit(found)
    kept = np.zeros((0, x.shape[1]))
    for at in range(0, len(x), 256):
        part = x[at : at + 256]
        part = part[(part @ kept.T < s.apart).all(1)] if len(kept) else part
        near, own = part @ part.T, []
        for i in range(len(part)):
            if not own or (near[i, own] < s.apart).all():
                own.append(i)
        kept = np.concatenate([kept, part[own]])[:size]
    more = np.random.default_rng(s.seed).normal(size=(max(0, s.least_pivots - len(kept)), x.shape[1]))
    return np.concatenate([kept, unit(more)]) if len(more) else kept


def counted(left: np.ndarray, right: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Position-weighted counts of the pivots that two sets of descriptions share: for each the product of what its place in both is worth, the first most."""

    def worth(near):
        out, depth = np.zeros((len(near), len(names)), np.float32), near.shape[1]
        out[np.arange(len(near))[:, None], np.searchsorted(names, near)] = np.arange(depth, 0, -1)
        return out

    return worth(left) @ worth(right).T


def plan_for(drawn: np.ndarray, pivots: np.ndarray, s: Settings) -> Plan:
    """The shortest description and lists, and the highest count, by which a share s.recall of pairs at the threshold become candidates.

    The pairs are vectors of the sample and the same turned in random directions. A vector that is a pivot is tried without it.
    """
    rng, p = np.random.default_rng(s.seed), pivots.astype(np.float32)
    x = unit(drawn[rng.choice(len(drawn), s.trials)])
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1)[:, None] * x
    y = s.cosine * x + (1 - s.cosine**2) ** 0.5 * side / np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
    most, depth = len(pivots), min(s.depth, len(pivots))
    while True:
        needed, counts = [], []
        for i in range(0, s.trials, 256):
            near = [nearest(v[i : i + 256].astype(np.float32), p, min(depth + 1, most)) for v in (x, y)]
            own = np.where((x[i : i + 256].astype(np.float32) * p[near[0][:, 0]]).sum(1) > 1 - 1e-6, near[0][:, 0], -1)
            near = [np.take_along_axis(v, np.argsort(v == own[:, None], axis=1, kind="stable"), 1)[:, :depth] for v in near]
            same = near[0][:, :, None] == near[1][:, None, :]
            places = np.arange(depth)
            needed.append(np.where(same, np.maximum(places[:, None], places[None, :]) + 1, most + 1).min((1, 2)))
            counts.append((same * np.outer(depth - places, depth - places)).sum((1, 2)))
        needed, counts = np.concatenate(needed), np.concatenate(counts)
        listed = int(np.quantile(needed, (1 + s.recall) / 2, method="higher"))
        if listed <= depth or depth == most:
            break
        depth = min(2 * depth, most)
    listed = min(listed, depth)
    found = np.where(needed <= listed, counts, -1.0)
    return Plan(depth, listed, float(max(1.0, np.quantile(found, 1 - s.recall, method="lower"))))


def _judge(x: np.ndarray, near: np.ndarray, p: int, plan: Plan, cosine: float) -> np.ndarray:
    """Links among the vectors of one list (of pivot p): candidates by their count, whose first shared list this is, verified."""
    names = np.unique(near)
    candidate = counted(near, near, names) >= plan.least
    first = np.where(near[:, : plan.listed] < p, near[:, : plan.listed], -1)
    if (first >= 0).any():
        before = np.zeros((len(near), len(names) + 1), np.float32)
        before[np.arange(len(near))[:, None], np.where(first >= 0, np.searchsorted(names, first), len(names))] = 1
        before = before[:, :-1]
        candidate &= before @ before.T == 0
    np.fill_diagonal(candidate, False)
    return candidate & (x @ x.T >= cosine) if candidate.any() else candidate


def _least_linked(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric table of links, the least row that links lead to."""
    label = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        new = np.where(linked, label[None, :], len(linked)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(nodes: DataFrame, s: Settings) -> DataFrame:
    """(node, other, n) for vectors (node, times, vec): parts of n, the vectors linked with node (each as often as it occurs),
    and edges that connect what is linked."""
    n = nodes.count()
    size = min(s.most_pivots, max(s.least_pivots, int(s.per_root * n**0.5)))
    if n < 2:
        return nodes.where("false").select("node", F.lit(None).cast("long").alias("other"), F.lit(0).cast("long").alias("n"))
    drawn = sample(nodes, 2 * size)
    found = reference_points(drawn, size, s)
    plan = plan_for(drawn, found, s)
    known = saved(describe(nodes.select("node", "times", "vec"), found, plan.depth), "described")
    rows = known.select("node", F.explode(F.slice("near", 1, plan.listed)).alias("list"))
    counts = saved(rows.groupBy("list").agg(F.count("*").alias("c")).where("c > 1").withColumn("blocks", F.ceil(F.col("c") / s.block).cast("int")), "lists")
    total = counts.agg(F.sum(F.col("c") * F.col("blocks"))).first()[0] or 0
    groups = max(64, int(total) // s.group_rows)
    listed = rows.join(counts, "list").withColumn("mine", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    # a row of a list in blocks meets every other block once
    dealt = listed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("node", "list", "mine", F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"))
    dealt = dealt.withColumn("grp", F.pmod(F.xxhash64("list", "i", "j"), F.lit(groups)).cast("int")).join(known, "node")
    dealt = dealt.select("grp", "list", "i", "j", "mine", "node", "times", "vec", "near")

    def judge(group: pa.Table) -> pa.Table:
        p, i, j, mine, node, times = (group.column(c).to_numpy() for c in ("list", "i", "j", "mine", "node", "times"))
        x, near = unit(matrix(group.column("vec"))), matrix(group.column("near")).astype(np.int64)
        order = np.lexsort((node, j, i, p))
        key = np.stack([p, i, j])[:, order]
        heads = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(0)]))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)], strict=True):
            rows = order[a:b]
            if len(rows) < 2:
                continue
            linked = _judge(x[rows], near[rows], p[rows[0]], plan, s.cosine)
            if i[rows[0]] != j[rows[0]]:  # pairs within one block are judged where i = j
                linked &= mine[rows][:, None] != mine[rows][None, :]
            hit = np.flatnonzero(linked.any(1))
            if len(hit):
                root = rows[_least_linked(linked)][hit]
                out.append((node[rows[hit]], node[root], (linked @ times[rows])[hit]))
        cat = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out, strict=True) if out else ((), (), ()))]
        return pa.table({"node": cat[0].astype(np.int64), "other": cat[1].astype(np.int64), "n": cat[2].astype(np.int64)})

    return dealt.groupBy("grp").applyInArrow(judge, "node long, other long, n long")


def near_duplicates(vectors: DataFrame, s: Settings = Settings(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each row of vectors: key, n_links, component_id, kept.

    n_links: other rows whose cosine is at least s.cosine; component_id: the least key that links lead to, the own one
    included; kept: whether that is the own one. Equal vectors are one class, counted as often as it occurs. Rows that
    can't be compared (see vectors.usable) have no links and are their own component; without a key they have none and
    are not kept. Rows with the same key have the links of the one with most. Other columns are not looked at. An empty
    table gives an empty result.
    """
    with scratch(vectors.sparkSession):
        return lasting(_near_duplicates(vectors, s, key, vector), "near-vectors")


def _near_duplicates(vectors: DataFrame, s: Settings, key: str, vector: str) -> DataFrame:
    rows = usable(vectors, key, vector)[0]
    own = classes(rows)
    times = saved(rows.groupBy("h1", "h2").agg(F.count("*").alias("times")), "times")
    nodes = saved(own.join(times, ["h1", "h2"]).select("h1", "h2", "node", "times", "vec"), "nodes")
    found = links(nodes, s)
    found = saved(found.groupBy("node", "other").agg(F.sum("n").alias("n")), "links")
    tally = found.groupBy("node").agg(F.sum("n").alias("n"))
    reached = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    least = saved(reached.groupBy("root").agg(F.min("node").alias("component_id")), "least")
    label = reached.join(least, "root").select("node", "component_id")
    per = nodes.select("h1", "h2", "node", "times").join(tally, "node", "left").join(label, "node", "left")
    per = saved(per.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component_id", "node").alias("component_id")), "per")
    judged = saved(rows.select("key", "h1", "h2").join(per, ["h1", "h2"]).select("key", "n_links", "component_id"), "judged")
    per_key = judged.groupBy("key").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = without(vectors.select(F.col(key).cast("long").alias(key))).join(per_key, F.col(key) == F.col("key"), "left")
    out = out.select(key, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", key).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
