"""Near-duplicate documents by SetSketch registers over word shingles.

A register is the truncated logarithm of the least of a set's hashes (exponentially spaced), so that sketches merge by
maximum and equal registers grow with similarity. Bands of registers name candidates, the likelihood of both sketches
drops those that can't reach the threshold, and the full shingle sets decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import binary, chunks, lasting, saved, scratch, utf8
from .words import Coder, mix, shingles, words

#: Rows of ids (8 bytes each) up to which a side is sent to all executors; beyond that the join shuffles.
BROADCAST_ROWS = 500_000
#: Documents on either side of a task that compares in blocks.
BLOCK = 256


@dataclass(frozen=True)
class Settings:
    """percent: links have 100 * intersection >= percent * union. A pair at it misses all bands with a chance under 1e-7.

    margin: what the estimate may fall short of it; over four standard errors of 128 registers.
    """

    shingle: int = 5
    percent: int = 80
    registers: int = 128
    band: int = 4
    base: float = 1.001
    rate: float = 20.0
    margin: float = 0.17
    seed: int = 5

    @property
    def bands(self) -> int:
        return self.registers // self.band


def _sets(part: pa.RecordBatch, text: str, k: int) -> list[np.ndarray]:
    """Each text's different shingle codes, sorted."""
    data, ends = utf8(part.column(part.schema.get_field_index(text)))
    starts, stops, bounds = words(data, ends)
    codes = Coder(data).code(starts, stops) if len(starts) else np.zeros(0, np.uint64)
    found, edges = shingles(codes, bounds, k)
    return [np.unique(found[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


class Sketcher:
    def __init__(self, s: Settings):
        rng = np.random.default_rng(s.seed)
        self.s = s
        self.times = rng.integers(1, 2**63, s.registers, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 2**63, s.registers, dtype=np.uint64)

    def registers(self, codes: np.ndarray) -> np.ndarray:
        low = np.full(self.s.registers, 2**64 - 1, np.uint64)
        for at in range(0, len(codes), 1024):
            x = np.multiply.outer(self.times, codes[at : at + 1024])
            x += self.plus[:, None]
            np.minimum(low, x.min(1), out=low)
        least = -np.log1p(-((low >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53) / self.s.rate
        return np.clip(np.floor(1 - np.log(least) / np.log(self.s.base)), 0, 65535).astype("<u2")


def estimate(n_a: np.ndarray, n_b: np.ndarray, above: np.ndarray, below: np.ndarray, same: np.ndarray, base: float) -> np.ndarray:
    """The similarity of greatest likelihood, given set sizes and how many registers are greater, smaller and equal."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    share = lambda x: -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def likelihood(j):
        p, q = share(u - v * j), share(v - u * j)
        tiny = 1e-12
        return above * np.log(p + tiny) + below * np.log(q + tiny) + same * np.log(np.maximum(1 - p - q, tiny))

    g = (5**0.5 - 1) / 2
    for _ in range(30):
        a, b = high - g * (high - low), low + g * (high - low)
        left = likelihood(a) > likelihood(b)
        low, high = np.where(left, low, a), np.where(left, b, high)
    return (low + high) / 2


def sketch(docs: DataFrame, s: Settings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, set_hi, set_lo, registers): size, digest and packed registers of each text's shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Sketcher(s)
        for batch in batches:
            for part in chunks(batch, text):
                sets = _sets(part, text, s.shingle)
                counts = np.array([len(x) for x in sets], np.int64)
                digest = [np.array([mix(x ^ np.uint64(c)).sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64) for c in (0x51ED, 0xC0FE)]
                made = [maker.registers(x) if len(x) else np.zeros(s.registers, "<u2") for x in sets]
                body = np.concatenate(made).view(np.uint8)
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(key)), pa.array(counts), *map(pa.array, digest), binary(body, np.arange(len(sets) + 1) * s.registers * 2)], ["id", "n_shingles", "set_hi", "set_lo", "registers"])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, "id long, n_shingles long, set_hi long, set_lo long, registers binary")


def likely(pairs: DataFrame, s: Settings) -> DataFrame:
    """(a, b) of pairs (a, b, n_a, n_b, registers_a, registers_b) whose estimate comes within the margin of the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = lambda c, b=batch: b.column(b.schema.get_field_index(c))
            x, y = (np.frombuffer(utf8(column(c))[0].tobytes(), "<u2").reshape(batch.num_rows, -1) for c in ("registers_a", "registers_b"))
            j = estimate(column("n_a").to_numpy().astype(float), column("n_b").to_numpy().astype(float), (x > y).sum(1), (x < y).sum(1), (x == y).sum(1), s.base)
            yield batch.select(["a", "b"]).filter(pa.array(j >= s.percent / 100 - s.margin))

    return pairs.mapInArrow(run, "a long, b long")


def full_sets(docs: DataFrame, needed: DataFrame, s: Settings, key: str, text: str) -> DataFrame:
    """(id, codes): the shingle sets of the documents whose ids are needed. Each text is read and cut up once."""
    side = F.broadcast(needed) if needed.count() <= BROADCAST_ROWS else needed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                sets = _sets(part, text, s.shingle)
                edges = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
                body = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(body))], ["id", "codes"])

    texts = docs.select(F.col(key).cast("long").alias("id"), text).join(side, "id", "left_semi")
    return saved(texts.mapInArrow(run, "id long, codes array<long>"), "sets")


def verified(pairs: DataFrame, docs: DataFrame, s: Settings, key: str, text: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    needed = saved(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "needed")
    sets = full_sets(docs, needed, s, key, text)
    a, b = sets.select(F.col("id").alias("a"), F.col("codes").alias("codes_a")), sets.select(F.col("id").alias("b"), F.col("codes").alias("codes_b"))
    both = F.size(F.array_intersect("codes_a", "codes_b"))
    return pairs.join(a, "a").join(b, "b").where(100 * both >= s.percent * (F.size("codes_a") + F.size("codes_b") - both)).select("a", "b")


def across(groups: DataFrame, nodes: DataFrame, docs: DataFrame, s: Settings, key: str, text: str) -> DataFrame:
    """Links between documents of one group that are not connected yet; groups: (node, grp, root), root the component so far.

    The documents outside a group's largest component are its queries, and are compared with all its documents in blocks,
    in two passes. The first has sizes and sketches only, and says which documents of two blocks have a likely partner in
    the other. The second has the full sets, of these documents alone, and gives the links, one for each query and
    component. Rows that leave a task are no more than those that came, whatever pairs they make.
    """
    sizes = saved(groups.groupBy("grp", "root").agg(F.count("*").alias("c")), "sizes")
    most = sizes.groupBy("grp").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("n"), (F.sum("c") - F.max("c")).alias("q"))
    most = saved(most.select("grp", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("jn"), F.ceil(F.col("q") / BLOCK).cast("int").alias("in")).where("in > 0"), "most")
    rows = groups.join(most, "grp").join(nodes.select("node", F.col("n_shingles").alias("size"), "registers"), "node")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    mine = lambda c: F.pmod(F.xxhash64("node"), c).cast("int")
    asking = rows.where("root <> main").select("grp", mine("in").alias("i"), upto("jn").alias("j"), F.lit(True).alias("asks"), "node", "root", "size", "registers")
    asked = rows.select("grp", upto("in").alias("i"), mine("jn").alias("j"), F.lit(False).alias("asks"), "node", "root", "size", "registers")

    def pairs_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Places of the queries and others of two blocks that are likely to be linked and aren't connected."""
        asks, root, size = (table.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "root", "size"))
        reg = np.frombuffer(utf8(table.column("registers"))[0].tobytes(), "<u2").reshape(len(root), -1)
        other, pairs = np.flatnonzero(~asks), []
        for q in np.flatnonzero(asks):
            some = other[(root[other] != root[q]) & (100 * np.minimum(size[other], size[q]) >= s.percent * np.maximum(size[other], size[q]))]
            above, below = (reg[q] > reg[some]).sum(1), (reg[q] < reg[some]).sum(1)
            pairs.append(np.stack([np.full(len(some), q), some, above, below]))
        q, m, above, below = np.concatenate(pairs, axis=1) if pairs else np.zeros((4, 0), np.int64)
        near = estimate(size[q].astype(float), size[m].astype(float), above, below, reg.shape[1] - above - below, s.base) >= s.percent / 100 - s.margin
        return q[near], m[near]

    def likely_rows(table: pa.Table) -> pa.Table:
        return table.take(pa.array(np.unique(np.concatenate(pairs_of(table)))))

    kind = "grp long, i int, j int, asks boolean, node long, root long, size long, registers binary"
    some = saved(asking.unionByName(asked).groupBy("grp", "i", "j").applyInArrow(likely_rows, kind), "likely")
    sets = full_sets(docs, saved(some.select(F.col("node").alias("id")).distinct(), "needed"), s, key, text)

    def compare(table: pa.Table) -> pa.Table:
        node, root = table.column("node").to_numpy(), table.column("root").to_numpy()
        lists = table.column("codes").combine_chunks()
        edges, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy().view(np.uint64)
        edges = edges - edges[0]
        long = np.diff(edges)  # of the set at hand: rows with one key may have several
        q, m = pairs_of(table)
        names, place = np.unique(flat, return_inverse=True)
        mark, a, b = np.zeros(len(names), bool), [], []
        for query in np.unique(q):
            own, near = place[edges[query] : edges[query + 1]], m[q == query]
            mark[own] = True
            both = np.add.reduceat(mark[np.concatenate([place[edges[x] : edges[x + 1]] for x in near])], np.cumsum(long[near]) - long[near], dtype=np.int64)
            mark[own] = False
            hit = near[100 * both >= s.percent * (long[query] + long[near] - both)]
            hit = hit[np.unique(root[hit], return_index=True)[1]]
            a += [int(node[query])] * len(hit)
            b += node[hit].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    full = some.join(sets.select(F.col("id").alias("node"), "codes"), "node").select("grp", "i", "j", "asks", "node", "root", "size", "registers", "codes")
    return saved(full.groupBy("grp", "i", "j").applyInArrow(compare, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, s: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: key, n_shingles, component_id, kept.

    component_id is the smallest key that links lead to, the document's own included; kept marks the documents whose key it is.
    Texts without words (null and empty ones too) have no shingles and link with nothing. Equal sets are one class before
    any pair is made. Rows with the same key count as one document with the links of all its texts. A row without a key
    links with nothing and has no component. An empty table gives an empty result. Texts of any length count whole, and
    other columns are not looked at.

    No bucket of a band makes all its pairs: each member is compared with the bucket's least member, then components are
    found. Buckets that hold several components form groups, within which across() compares what is still apart.
    """
    with scratch(docs.sparkSession):
        return lasting(_near_duplicates(docs, s, key, text), "near-texts")


def _near_duplicates(docs: DataFrame, s: Settings, key: str, text: str) -> DataFrame:
    marks = saved(sketch(docs, s, key, text), "sketches")
    classes = saved(marks.where("n_shingles > 0 and id is not null").groupBy("set_hi", "set_lo").agg(F.min("id").alias("node")), "classes")
    own = marks.join(classes, ["set_hi", "set_lo"]).where("id = node").select("node", "n_shingles", "registers")
    nodes = saved(own.dropDuplicates(["node", "registers"]), "nodes")
    width = 2 * s.band
    cut = F.transform(F.sequence(F.lit(0), F.lit(s.bands - 1)), lambda i: F.xxhash64(i, F.substring("registers", i * width + 1, F.lit(width))))
    rows = saved(nodes.select("node", F.explode(cut).alias("bucket")), "bands")
    heads = saved(rows.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("bucket", "hub"), "hubs")
    members = saved(rows.join(heads, "bucket"), "members")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of pairs (a, b) of nodes, those that are links."""
        pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        one, two = (nodes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("registers").alias(f"registers_{c}")) for c in "ab")
        close = pairs.join(one, "a").join(two, "b").where(100 * F.least("n_a", "n_b") >= s.percent * F.greatest("n_a", "n_b"))
        return saved(verified(saved(likely(close, s).distinct(), "likely"), docs, s, key, text).distinct(), "links")

    links = linked(members.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    found = components(links)
    placed = saved(members.join(found, "node", "left").select("bucket", "node", "hub", F.coalesce("root", "node").alias("root")), "placed")
    open_buckets = saved(placed.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("bucket"), "open")
    unsure = saved(placed.join(open_buckets, "bucket").groupBy("node", "hub").agg(F.min("root").alias("root")), "unsure")
    groups = components(unsure.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    groups = saved(groups.withColumnRenamed("root", "grp").join(unsure.select("node", "root").distinct(), "node"), "groups")
    links = saved(links.unionByName(across(groups, nodes, docs, s, key, text)), "links")
    found = components(links)
    least = saved(found.groupBy("root").agg(F.min("node").alias("component_id")), "least")
    label = saved(found.join(least, "root").select("node", "component_id"), "labels")
    out = marks.join(classes, ["set_hi", "set_lo"], "left")
    out = out.withColumn("node", F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("node")).otherwise(F.col("id")))
    out = out.join(label, "node", "left").select(F.col("id").alias(key), "n_shingles", F.coalesce("component_id", "node").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))


def one_of_each(docs: DataFrame, s: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs whose document is kept; rows without a key stay."""
    judged = near_duplicates(docs, s, key, text)
    gone = judged.where(F.col(key).isNotNull() & ~F.col("kept")).select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, docs[f"`{key}`"].cast("long") == gone["_gone"], "left_anti")
