"""Product codes of vectors, learned and assigned in integers through Walsh-Hadamard transforms.

Components become integers, vectors are cut into equal parts, and each part has a codebook of its own. Parts and entries
are padded with zeros to a power of two, P, and transformed with signs alone; the squared differences of their
coefficients sum to P times the squared distance. They are added in order of sequency, slowly changing patterns first,
where most of a difference lies: an entry goes as soon as its sum passes what another entry has in all. Nothing is
rounded, so that ties are real ties.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import lasting, saved, scratch

#: Vectors that one numpy pass works on; a pass holds so many rows for each entry of a codebook.
ROWS = 4096


@dataclass(frozen=True)
class Settings:
    """parts of a vector, entries of each part's codebook (256 at most, as codes have two digits), rounds of learning, and what components are multiplied by."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


@dataclass
class Coded:
    """rows: (key, label, code, error) of every vector; books: entries by part, entry and position."""

    rows: DataFrame
    books: np.ndarray


def sequency(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the last axis, whose length is a power of two, by rising number of sign changes."""
    n, half, out = x.shape[-1], 1, x.copy()
    while half < n:
        pair = out.reshape(*x.shape[:-1], -1, 2, half)
        out = np.stack([pair[..., 0, :] + pair[..., 1, :], pair[..., 0, :] - pair[..., 1, :]], -2).reshape(x.shape)
        half *= 2
    places = np.arange(n)
    signs = np.array([[bin(i & j).count("1") & 1 for j in places] for i in places]).reshape(n, n)
    return out[..., np.argsort(np.abs(np.diff(signs, axis=1)).sum(1), kind="stable")]


def padded(x: np.ndarray) -> np.ndarray:
    """x with zeros after its last axis, up to a power of two."""
    more = (1 << max(0, x.shape[-1] - 1).bit_length()) - x.shape[-1]
    return np.concatenate([x, np.zeros((*x.shape[:-1], more), x.dtype)], -1) if more else x


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row and P times its squared distance, both given by their coefficients; the first one of equals."""
    begun = (x[:, :1] - entries[:, 0]) ** 2
    bound = ((x - entries[begun.argmin(1)]) ** 2).sum(1)
    row, entry = np.nonzero(begun <= bound[:, None])
    so_far = begun[row, entry]
    for k in range(1, x.shape[1]):
        so_far += (x[row, k] - entries[entry, k]) ** 2
        left = so_far <= bound[row]
        row, entry, so_far = row[left], entry[left], so_far[left]
    least = np.minimum.reduceat(so_far, np.searchsorted(row, np.arange(len(x)))) if len(x) else so_far
    at = np.flatnonzero(so_far == least[row])
    return entry[at[np.searchsorted(row[at], np.arange(len(x)))]], least


def assigned(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, squared distances) of each row's parts; x by row, part and position, books by part, entry and position."""
    size, of = padded(x[:1, 0]).shape[-1] if len(x) else 1, [sequency(padded(b)) for b in books]
    index, far = np.zeros(x.shape[:2], np.int64), np.zeros(x.shape[:2], np.int64)
    for start in range(0, len(x), ROWS):
        rows = slice(start, start + ROWS)
        for p, entries in enumerate(of):
            index[rows, p], far[rows, p] = nearest(sequency(padded(x[rows, p])), entries)
    return index, far // size


def _limit(length: int, parts: int) -> int:
    """Components below this keep every sum within 64 bits, an error over all parts too."""
    return 1 << (28 - max(0, length // parts - 1).bit_length() - max(0, (parts - 1).bit_length() - 4) // 2)


def integers(vectors: DataFrame, settings: Settings, key: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """(key, label, v) of the vectors that take part, their components multiplied and floored; and the vectors' length."""
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(fine)
    most = rows.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    length = most[0] if most else 0
    if length % settings.parts:
        raise ValueError(f"vectors of {length} components can't be cut into {settings.parts} equal parts")
    within = F.forall(x, lambda c: F.abs(c) < _limit(length, settings.parts) / settings.scale)
    whole = F.transform(x, lambda c: F.floor(c * settings.scale).cast("int"))
    return rows.where((F.size(vector) == length) & within).select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), whole.alias("v")), length


def _matrix(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, parts, -1)


def _summing(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each entry that a task's parts chose: how many did, and the sums of their components."""
    parts, entries, wide = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, wide), np.int64)
        for batch in batches:
            x = _matrix(batch, parts)
            cell = (assigned(x, books)[0] + np.arange(parts) * entries).ravel()
            count += np.bincount(cell, minlength=parts * entries)
            np.add.at(total, cell, x.reshape(-1, wide))
        used = np.repeat(np.flatnonzero(count), wide)
        place = np.tile(np.arange(wide), len(used) // wide)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(place), pa.array(count[used]), pa.array(total[used, place])], ["cell", "place", "n", "s"])

    return run


def _coding(books: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    digits = np.array([f"{i:02x}" for i in range(256)], "S2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                index, far = assigned(_matrix(batch, books.shape[0]), books)
                code = pa.array(np.ascontiguousarray(digits[index]).view(f"S{2 * books.shape[0]}").ravel()).cast("string")
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), code, pa.array(far.sum(1))], ["key", "label", "code", "error"])

    return run


def encode(vectors: DataFrame, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding", label: str = "label") -> Coded:
    """Learns the codebooks of a table of vectors and codes all of it.

    A part's codebook starts as that part of the vectors with the least keys (of equal keys the lesser vector first; rows
    without a key last). Each round gives every part to its nearest entry, ties to the lower one, and puts each entry at
    the floored mean of its parts; entries without any stay. rows: (key, label, code, error), error being the sum of the
    parts' squared distances; each row counts, repeated ones too, and other columns, whatever their names, don't.

    Left out are null and empty vectors, ones with null or non-finite components, of another length than most, or with a
    component whose integer needs more than some 27 bits, of which sums would pass 64 bits. A length that the parts don't
    divide raises. An empty table gives no rows and no entries.

    A task sends a sum for each entry and position, whatever its rows are, and these are all that reaches the driver.
    """
    if not 1 <= settings.entries <= 256:
        raise ValueError("codes have two hexadecimal digits: 1 to 256 entries")
    rows, length = integers(vectors, settings, key, vector, label)
    with scratch(vectors.sparkSession):
        rows = saved(rows, "integers")
        first = [r.v for r in rows.orderBy(F.col("key").asc_nulls_last(), "v").limit(settings.entries).collect()]
        wide = length // settings.parts
        books = np.array(first, np.int64).reshape(len(first), settings.parts, wide).transpose(1, 0, 2).copy()
        for _ in range(settings.rounds if first else 0):
            sums = rows.mapInArrow(_summing(books), "cell long, place long, n long, s long").groupBy("cell", "place").agg(F.sum("n"), F.sum("s"))
            for cell, place, n, s in sums.collect():
                books[cell // len(first), cell % len(first), place] = s // n
        kind = T.StructType([*rows.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
        coded = rows.mapInArrow(_coding(books), kind) if first else rows.sparkSession.createDataFrame([], kind)
        return Coded(lasting(coded, "codes"), books)


def digest(books: np.ndarray) -> str:
    """SHA-256, in lowercase hex, of all components as decimal numbers with commas between."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: Coded) -> DataFrame:
    """(key, label, code, error, label_error): the errors of all rows with the same label, null labels being one, summed.

    The sums are a row for each label, written first, so that Spark knows their size: few are broadcast, many are joined
    by a shuffle whose large partitions it can split.
    """
    sums = lasting(coded.rows.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.rows.join(sums, F.col("label").eqNullSafe(F.col("_of"))).drop("_of")
