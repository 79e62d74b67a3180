"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records uniformly, by a seeded hash of what they hold, into buckets that fit in memory. Pass 2
gathers one bucket at a time, shuffles it (Fisher-Yates, seeded by the bucket) and deals its records to the shards where
the bucket before it stopped. Shard sizes in rows so differ by one at most, whatever the keys.

Nothing depends on where a record stands in the input: the same records go to the same shards and slots however they
are split into files, tasks and attempts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import lasting, saved, scratch, shared_dir, without

LEAST_BUCKETS = 256
#: Digests (8 bytes each) up to which the repeated ones are sent to all tasks; beyond that rows meet them by a shuffle.
BROADCAST_ROWS = 500_000
#: Buckets whose counts one step of the prefix sum adds up.
SPAN = 4096


def _digest(df: DataFrame):
    """A 64-bit hash of all columns of a row; maps count by their entries in order."""
    plain = lambda f: F.array_sort(F.map_entries(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
    return F.xxhash64(*map(plain, df.schema))


def numbered(df: DataFrame) -> DataFrame:
    """df with `_digest` and `_nth`: rows that are equal in every column are told apart by a number from 0.

    Only rows whose digest comes more than once are grouped, whole and combined before the shuffle, and then unfolded by
    their count: no task gathers the copies of a row.
    """
    rows = df.withColumn("_digest", _digest(df))
    often = lasting(rows.groupBy("_digest").agg(F.count("*").alias("_c")).where("_c > 1").select(F.col("_digest").alias("_often")), "repeated")
    side = F.broadcast(often) if often.count() <= BROADCAST_ROWS else often
    on = rows["_digest"] == side["_often"]
    once = rows.join(side, on, "left_anti").withColumn("_nth", F.lit(0).cast("long"))
    again = rows.join(side, on, "left_semi").groupBy(*(F.col(f"`{c}`") for c in rows.columns)).agg(F.count("*").alias("_c"))
    return once.unionByName(again.withColumn("_nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c") - 1))).drop("_c"))


def starts_of(counts: DataFrame) -> DataFrame:
    """(_bucket, _n, _start) from (_bucket, _n): how many records the buckets before hold, by sums over spans of buckets."""
    spans = counts.groupBy(F.expr(f"_bucket div {SPAN}").alias("_span")).agg(F.sum("_n").alias("_all"))
    before = spans.select("_span", (F.sum("_all").over(W.orderBy("_span")) - F.col("_all")).alias("_before"))
    inside = counts.withColumn("_span", F.expr(f"_bucket div {SPAN}"))
    own = F.sum("_n").over(W.partitionBy("_span").orderBy("_bucket")) - F.col("_n")
    return inside.withColumn("_own", own).join(before, "_span").select("_bucket", "_n", (F.col("_own") + F.col("_before")).alias("_start"))


def shard(df: DataFrame, shards: int = 16, seed: int = 17, text: str = "text", bucket_bytes: int = 8 << 20) -> DataFrame:
    """Every record of df, with `shard` (0 to shards - 1) and `slot` (its place there, gapless from 0).

    Repeated rows, null keys and null or empty texts are records like others; very long texts count with their size, and
    a bucket holds `bucket_bytes` of rows on average (but at least one record). Columns of df called shard or slot give
    way. An empty df gives an empty result. A bucket that changes between the passes fails loudly.
    """
    plain = without(df, "shard", "slot", "_bucket", "_digest", "_nth", "_count", "_start")
    with scratch(df.sparkSession):
        total = plain.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()[0] or 0
        buckets = max(LEAST_BUCKETS, -(-int(total) // bucket_bytes))
        placed = numbered(plain).withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "_digest", "_nth"), F.lit(buckets)).cast("int"))
        counts = placed.groupBy("_bucket").agg(F.count("*").alias("_n"))
        starts = lasting(starts_of(saved(counts, "counts")), "starts")
        return _dealt(placed, starts, plain.schema, shards, seed)


def _dealt(placed: DataFrame, starts: DataFrame, schema: T.StructType, shards: int, seed: int) -> DataFrame:
    out = T.StructType([*schema.fields, T.StructField("shard", T.IntegerType(), False), T.StructField("slot", T.LongType(), False)])

    def deal(group: pa.Table, start: pa.Table) -> pa.Table:
        n = group.num_rows
        if not start.num_rows or n != start.column("_n")[0].as_py():
            raise RuntimeError(f"a bucket has {n} records, counted {start.column('_n').to_pylist()}: the input changed between the passes")
        order = np.lexsort((group.column("_nth").to_numpy(), group.column("_digest").to_numpy()))
        np.random.Generator(np.random.PCG64([seed, start.column("_bucket")[0].as_py()])).shuffle(order)  # numpy's shuffle is Fisher-Yates
        at = start.column("_start")[0].as_py() + np.arange(n)
        return group.drop_columns(["_bucket", "_digest", "_nth"]).take(pa.array(order)).append_column("shard", pa.array((at % shards).astype(np.int32))).append_column("slot", pa.array(at // shards))

    return placed.groupBy("_bucket").cogroup(starts.groupBy("_bucket")).applyInArrow(deal, out)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Writes sharded records as one folder for each shard. A file holds a bucket's records, whose slots there follow one another; nothing is shuffled again.

    Null and long texts and repeated rows are records like others. An empty table writes a folder without records.
    """
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(df: DataFrame, **settings) -> DataFrame:
    """The records of df as they stand in shards that have been written to shared storage.

    All columns come back with `shard` and `slot`, null and long texts whole, repeated rows as often as they are there; an
    empty table gives none.
    """
    dealt = shard(df, **settings)
    path = shared_dir(df.sparkSession, "shards")
    write_shards(dealt, path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)
