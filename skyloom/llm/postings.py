"""Nearest neighbours by balanced posting lists.

Vectors are dealt to the lists of their nearest centroids; those near a boundary go to several. Lists that grow large
are cut in blocks. A query walks a graph of the centroids, which fits in memory, keeps the lists whose distance is
within a ratio of the nearest one's, and is compared with every vector in them.

The graph holds so many centroids at most; of more vectors each list is divided again, by centroids of its own that are
fitted and applied where the list is, so that lists keep their size however many vectors there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import lasting, saved, scratch
from .vectors import classes, matrix, sample, unit, usable


@dataclass(frozen=True)
class Settings:
    """sample_rows bounds what the centroids are fitted on, most_lists how many the graph has (and what each executor holds).

    A list that is divided again has at most most_parts parts, and is worked on by `share` rows at a time.
    """

    neighbours: int = 5
    list_rows: int = 64
    least_lists: int = 8
    most_lists: int = 8_192
    sample_rows: int = 16_000
    rounds: int = 8
    copies: int = 4
    copy_ratio: float = 1.3
    probe_factor: float = 6.0
    probe_ratio: float = 1.4
    edges: int = 24
    block: int = 256
    most_parts: int = 4_096
    share: int = 65_536
    seed: int = 3


def centroids(x: np.ndarray, many: int, s: Settings) -> np.ndarray:
    """Spherical k-means; a cluster of over twice the mean size is cut in two, so that lists stay balanced."""
    rng = np.random.default_rng(s.seed)
    many = max(1, min(many, len(x)))
    c = x[rng.choice(len(x), many, replace=False)].copy()
    for turn in range(s.rounds):
        mine = np.concatenate([(x[i : i + 1024] @ c.T).argmax(1) for i in range(0, len(x), 1024)])
        sums = np.zeros_like(c)
        np.add.at(sums, mine, x)
        size = np.bincount(mine, minlength=len(c))
        norm = np.linalg.norm(sums, axis=1)
        good = (size > 0) & (norm > 1e-9)
        c[good] = sums[good] / norm[good, None]
        if turn < s.rounds - 2:  # the emptiest centroids move into the fullest clusters
            full = np.flatnonzero(size > 2 * len(x) / len(c))
            empty = np.argsort(size, kind="stable")[: len(full)]
            for a, b in zip(empty, full, strict=True):
                inside = np.flatnonzero(mine == b)
                c[a] = x[inside[(x[inside] @ c[b]).argmin()]]
    return c


def graph(c: np.ndarray, edges: int) -> np.ndarray:
    """Each centroid's nearest others, and a few at fixed strides so that all can be reached."""
    n = len(c)
    near = np.concatenate([np.argsort(-(c[i : i + 512] @ c.T), axis=1, kind="stable")[:, 1 : edges + 1] for i in range(0, n, 512)])
    strides = [max(1, n // 2**k) for k in range(1, 7)]
    return np.concatenate([near, np.stack([(np.arange(n) + d) % n for d in strides], 1)], 1)


def walk(q: np.ndarray, c: np.ndarray, near: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of the graph for all queries at once: the `wanted` best centroids found, and their cosines."""
    n, wanted = len(q), min(wanted, len(c))
    seen = np.full((n, len(c)), -2.0, np.float32)
    opened = np.zeros((n, len(c)), bool)
    start = np.arange(0, len(c), max(1, len(c) // 8))
    seen[:, start] = q @ c[start].T
    active = np.arange(n)
    while len(active):
        part = np.where(opened[active] | (seen[active] < -1.5), -3.0, seen[active])
        best = part.argmax(1)
        value = part[np.arange(len(active)), best]
        worst = -np.partition(-seen[active], wanted - 1, axis=1)[:, wanted - 1]
        go = (value > -2.5) & (value >= worst)
        active, best = active[go], best[go]
        if len(active):
            opened[active, best] = True
            to = near[best]
            seen[active[:, None], to] = np.einsum("qd,qed->qe", q[active], c[to])
    top = np.argsort(-seen, axis=1, kind="stable")[:, :wanted]
    return top, np.take_along_axis(seen, top, 1)


def usual_distance(x: np.ndarray, c: np.ndarray) -> float:
    """The median distance to the second nearest centroid: vectors that lie on a centroid are judged as if this near."""
    if len(c) < 2 or not len(x):
        return 2.0
    second = np.concatenate([np.partition(-(x[i : i + 1024] @ c.T), 1, axis=1)[:, 1] for i in range(0, len(x), 1024)])
    return float(np.sqrt(np.maximum(2 + 2 * np.median(second), 0)))


def _lists(rows: DataFrame, c: np.ndarray, near: np.ndarray | None, wanted: int, ratio: float, usual: float) -> DataFrame:
    """(node, vec, list): the lists of each vector, by the graph if given, with distances up to `ratio` times the least, or the usual one if that is more."""
    sent = rows.sparkSession.sparkContext.broadcast((c.astype(np.float32), near))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, near = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                x = unit(matrix(batch.column(1))).astype(np.float32)
                if near is None:
                    cos = x @ c.T
                    top = np.argsort(-cos, axis=1, kind="stable")[:, :wanted]
                    cos = np.take_along_axis(cos, top, 1)
                else:
                    top, cos = walk(x, c, near, wanted)
                far = np.sqrt(np.maximum(2 - 2 * cos, 1e-6))
                row, col = np.nonzero((far <= ratio * np.maximum(far[:, :1], usual)) & (cos > -1.5))
                picked = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(top[row, col].astype(np.int64))], ["node", "vec", "list"])

    return rows.select("node", "vec").mapInArrow(run, f"node long, vec {rows.schema['vec'].dataType.simpleString()}, list long")


def _fitted(posted: DataFrame, parts: int, s: Settings) -> DataFrame:
    """(list, own): centroids inside each list, packed, fitted on up to eight vectors for each."""
    nth = F.row_number().over(W.partitionBy("list").orderBy(F.xxhash64("node"), "node"))
    some = posted.select("list", "vec", nth.alias("_n")).where(F.col("_n") <= 8 * parts)

    def fit(group: pa.Table) -> pa.Table:
        x = unit(matrix(group.column("vec")))
        own = centroids(x, min(parts, max(1, len(x) // 8)), s).astype(np.float32)
        return pa.table({"list": group.column("list").slice(0, 1), "own": pa.array([own.tobytes()], pa.binary())})

    return saved(some.groupBy("list").applyInArrow(fit, "list long, own binary"), "own")


def _divided(rows: DataFrame, own: DataFrame, parts: int, wanted: int, ratio: float, s: Settings) -> DataFrame:
    """rows (node, vec, list) in the parts of their lists: those of the nearest own centroids, up to `wanted` within `ratio`."""
    shares = rows.groupBy("list").agg(F.ceil(F.count("*") / s.share).cast("int").alias("_shares"))
    shares = saved(shares, "shares")
    left = rows.join(shares, "list").select("list", F.pmod(F.xxhash64("node", F.lit(5)), "_shares").cast("int").alias("_share"), "node", "vec")
    right = own.join(shares.withColumnRenamed("_shares", "_many"), "list").select("list", F.explode(F.sequence(F.lit(0), F.col("_many") - 1)).alias("_share"), "own")

    def assign(group: pa.Table, held: pa.Table) -> pa.Table:
        if not group.num_rows or not held.num_rows:
            return group.select(["node", "vec", "list"]).slice(0, 0)
        x = unit(matrix(group.column("vec"))).astype(np.float32)
        c = np.frombuffer(held.column("own")[0].as_py(), np.float32).reshape(-1, x.shape[1])
        made = []
        for at in range(0, len(x), 4096):
            cos = x[at : at + 4096] @ c.T
            top = np.argsort(-cos, axis=1, kind="stable")[:, :wanted]
            far = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(cos, top, 1), 1e-6))
            row, col = np.nonzero(far <= ratio * far[:, :1])
            made.append((row + at, top[row, col]))
        row, part = (np.concatenate(z) for z in zip(*made, strict=True))
        picked = group.select(["node", "vec", "list"]).take(pa.array(row))
        return picked.set_column(2, "list", pa.array(picked.column("list").to_numpy() * parts + part))

    kind = rows.schema["vec"].dataType.simpleString()
    return left.groupBy("list", "_share").cogroup(right.groupBy("list", "_share")).applyInArrow(assign, f"node long, vec {kind}, list long")


def search(vectors: DataFrame, queries: DataFrame, s: Settings = Settings(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of queries its nearest rows of vectors but itself, by cosine in double precision.

    Ties go to the smaller key. Equal vectors are one entry of the index with as many of its least keys as can matter,
    and equal queries are searched once. Rows that can't be compared (see vectors.usable) take no part on either side,
    nor do queries of another length than the vectors'; an empty side gives an empty result. Repeated keys count once.
    Other columns of both tables are not looked at.
    """
    with scratch(vectors.sparkSession):
        return lasting(_search(vectors, queries, s, key, vector), "nearest")


def _search(vectors: DataFrame, queries: DataFrame, s: Settings, key: str, vector: str) -> DataFrame:
    rows, length = usable(vectors, key, vector)
    index = classes(rows.dropDuplicates(["key", "h1", "h2"]), s.neighbours + 1)
    n = index.count()
    asked = saved(usable(queries, key, vector, length)[0].dropDuplicates(["key", "h1", "h2"]), "asked")
    ask = classes(asked)
    if not n:
        return rows.where("false").select(F.col("key").alias("query_id"), F.lit(0).alias("rank"), F.col("key").alias("vec_id"), F.lit(0.0).alias("score"))
    many = min(s.most_lists, max(s.least_lists, n // s.list_rows))
    parts = min(s.most_parts, -(-n // (many * s.list_rows)) if many == s.most_lists else 1)
    some = unit(sample(index, s.sample_rows))
    c = centroids(some, many, s)
    usual = usual_distance(some, c)
    probes = max(s.copies * 4, int(np.ceil(s.probe_factor * len(c) ** 0.5)))
    posted = saved(_lists(index, c, None, s.copies, s.copy_ratio, usual), "posted")
    probed = _lists(ask, c, graph(c, min(s.edges, len(c) - 1)), probes, s.probe_ratio, usual)
    if parts > 1:
        own, probed = _fitted(posted, parts, s), saved(probed, "probed")
        posted = saved(_divided(posted, own, parts, s.copies, s.copy_ratio, s), "divided")
        probed = _divided(probed, own, parts, max(s.copies * 4, int(np.ceil(s.probe_factor * parts**0.5))), s.probe_ratio, s)
    probed = saved(probed, "probes")
    # both sides of a list are cut in blocks, and every block of vectors meets every block of queries
    size = lambda df, name: df.groupBy("list").agg(F.ceil(F.count("*") / s.block).cast("int").alias(name))
    blocks = saved(size(posted, "blocks").join(size(probed, "turns"), "list"), "blocks")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    mine = lambda c: F.pmod(F.xxhash64("node"), c).cast("int")
    inside = posted.join(blocks, "list").select("list", mine("blocks").alias("block"), upto("turns").alias("turn"), "node", "vec", F.lit(False).alias("asks"))
    wanting = probed.join(blocks, "list").select("list", upto("blocks").alias("block"), mine("turns").alias("turn"), "node", "vec", F.lit(True).alias("asks"))

    def compare(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        node, x = group.column("node").to_numpy(), matrix(group.column("vec"))
        q, v = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(q) or not len(v):
            return pa.table({"q": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        norm, keep = np.sqrt((x * x).sum(1)), min(s.neighbours + 1, len(v))
        v = v[np.argsort(node[v], kind="stable")]
        score = (x[q] @ x[v].T) / (norm[q][:, None] * norm[v][None, :])
        top = np.argsort(-score, axis=1, kind="stable")[:, :keep]
        return pa.table({"q": np.repeat(node[q], keep), "node": node[v][top].reshape(-1), "score": np.take_along_axis(score, top, 1).reshape(-1)})

    near = inside.unionByName(wanting).groupBy("list", "block", "turn").applyInArrow(compare, "q long, node long, score double")
    near = near.groupBy("q", "node").agg(F.max("score").alias("score"))
    best = near.withColumn("_n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "node"))).where(F.col("_n") <= s.neighbours + 1)
    best = saved(best.select("q", "node", "score"), "best")
    every = best.join(index.select("node", "ids"), "node").select("q", "score", F.explode("ids").alias("id"))
    who = asked.select("key", "h1", "h2").join(ask.select("h1", "h2", F.col("node").alias("q")), ["h1", "h2"]).select(F.col("key").alias("query_id"), "q")
    pairs = who.join(every, "q").where("id <> query_id").groupBy("query_id", F.col("id").alias("vec_id")).agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.neighbours).select("query_id", "rank", "vec_id", "score")
