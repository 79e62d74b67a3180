"""Tables of vectors: which rows take part, classes of equal vectors, and how they reach numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import saved


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", length: int | None = None) -> tuple[DataFrame, int]:
    """(key, vec, h1, h2) of the rows that can be compared, h1 and h2 hashes of the vector; and the vectors' length.

    Left out are rows without a key, null vectors, vectors that are zero or hold null or non-finite components, and
    vectors of another length. Without `length` it is the one that most rows have, the greater of two as common: a table
    has one. Components stay double where they are, others become float.
    """
    exact = isinstance(vectors.schema[vector].dataType.elementType, (T.DoubleType, T.LongType, T.DecimalType))
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(fine).select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>" if exact else "array<float>").alias("vec"))
    if length is None:
        most = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
        length = most[0] if most else 0
    rows = rows.where(F.size("vec") == length)
    return rows.select("key", "vec", F.xxhash64("vec").alias("h1"), F.hash(F.reverse("vec"), F.lit(7)).alias("h2")), length


def classes(rows: DataFrame, ids: int = 1) -> DataFrame:
    """(h1, h2, node, ids, vec), one row for each different vector: its least key and its `ids` least keys. Written to shared storage."""
    first = rows.withColumn("_n", F.row_number().over(W.partitionBy("h1", "h2").orderBy("key"))).where(F.col("_n") <= ids)
    own = first.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("key")).alias("ids"), F.max("vec").alias("vec"))
    return saved(own.select("h1", "h2", F.col("ids")[0].alias("node"), "ids", "vec"), "classes")


def sample(nodes: DataFrame, most: int) -> np.ndarray:
    """`most` vectors at most, those with the least hashes of their nodes: what an index is fitted on. The bound is the caller's parameter."""
    rows = nodes.select(F.xxhash64("node").alias("_h"), "node", "vec").orderBy("_h", "node").limit(most).toArrow()
    return matrix(rows.column("vec"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)
