"""Helpers that all operators here share: shared storage, column names, Arrow text buffers."""

from __future__ import annotations

import ctypes
import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy pass works on; bounds the memory of a Python worker whatever the batch.
CHUNK_BYTES = 1 << 20


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under spark.checkpoint.dir, which all executors see.

    Where the setting is absent, a session on one machine (tests) uses a folder there; on a cluster this raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def seen_by_workers(spark: SparkSession) -> None:
    """Python workers on this machine import the package from where the driver has it; on a cluster it is installed."""
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


_open = threading.local()
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What saved() writes inside is deleted at the end, also after a failure; what lasting() writes stays for the caller."""
    outer, _open.paths = getattr(_open, "paths", None), []
    try:
        yield
    finally:
        mine, _open.paths = _open.paths, outer
        for path in mine:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in shared storage."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def lasting(df: DataFrame, name: str) -> DataFrame:
    """Writes df to shared storage and reads it back: cuts the lineage and survives lost executors.

    Shuffle files of the query go as soon as it has ended, as nothing reads them again; the session's setting for that
    is put back.
    """
    return _written(df, shared_dir(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before) if before is not None else spark.conf.unset(CLEAN_UP)
    return spark.read.schema(df.schema).parquet(path)


def saved(df: DataFrame, name: str) -> DataFrame:
    """As lasting(), until the end of the scratch() that it is in."""
    path = shared_dir(df.sparkSession, name)
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    return _written(df, path)


def spread(df: DataFrame) -> DataFrame:
    """df dealt over all cores where it is read in fewer parts than there are (one small file); else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def without(df: DataFrame, *names: str) -> DataFrame:
    """df less the columns whose names an operator's results take; the results win such clashes."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


@cache
def _libc():
    return ctypes.CDLL(None)


def trim() -> None:
    """In a worker: memory that is free goes back to the system, so that a worker which is used again doesn't hold what its largest batch had."""
    pa.default_memory_pool().release_unused()
    try:
        _libc().malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


_held: dict[str, Callable[[], None]] = {}


def held(name: str, release: Callable[[], None]) -> None:
    """In a worker: notes what an operator keeps for its next tasks, and how that is let go."""
    _held[name] = release


def let_go(keep: str | None = None) -> None:
    """In a worker: lets go of what other operators keep; workers are used again by whatever stage comes next."""
    for name in [x for x in _held if x != keep]:
        _held.pop(name)()


def local_path(uri: str) -> str | None:
    """The plain path of a file: URI or a bare path; None for other stores."""
    u = urlparse(uri)
    return u.path if u.scheme in ("", "file") else None


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings in a row, and the n + 1 offsets. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return body, ends - ends[0]


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES, keep: str | None = None):
    """Parts of a batch whose texts together have about `most` bytes; a longer text comes alone. After a batch free memory goes back to the system.

    keep: the operator whose kept data stay in the worker; those of others go.
    """
    let_go(keep)
    _, ends = utf8(batch.column(batch.schema.get_field_index(column)))
    start, n = 0, batch.num_rows
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop
    trim()


def binary(body: np.ndarray, ends: np.ndarray) -> pa.Array:
    """An Arrow binary column from one run of bytes and n + 1 byte offsets."""
    if len(ends) and ends[-1] >= 2**31:
        raise ValueError(f"{int(ends[-1])} bytes of results in one chunk: a single text that large must be cut before")
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends, np.int32)), pa.py_buffer(np.ascontiguousarray(body))])


def runs(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every count c, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)

