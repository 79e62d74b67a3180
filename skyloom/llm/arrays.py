"""Numpy arrays as files in shared storage: written whole by tasks, memory-mapped by workers."""

from __future__ import annotations

import json
import math
import os
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .shared import local_path


def _store(uri: str):
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(uri)


#: Files of a model that a worker keeps mapped: a system allows a process some 65,000 maps.
MAPS = 1 << 15


def _write(f, arrays: list[np.ndarray]) -> None:
    head = json.dumps([[a.dtype.str, a.shape] for a in arrays]).encode()
    f.write(len(head).to_bytes(8, "little") + head)
    at = 8 + len(head)
    for a in arrays:
        f.write(bytes(-at % 64))
        f.write(memoryview(a.reshape(-1).view(np.uint8)))
        at += -at % 64 + a.nbytes


def _cut(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """The arrays of a file; no byte of them is read."""
    at, out = 8 + int.from_bytes(data[:8].tobytes(), "little"), []
    for kind, shape in json.loads(data[8:at].tobytes()):
        at += -at % 64
        size = math.prod(shape) * np.dtype(kind).itemsize
        out.append(data[at : at + size].view(kind).reshape(shape))
        at += size
    return tuple(out)


def put(folder: str, name: str, *arrays: np.ndarray) -> None:
    """Writes arrays as one file, folder/name, under another name and renames it, so that a task that runs twice leaves one whole file."""
    arrays = [np.ascontiguousarray(a) for a in arrays]
    other = f"{name}.{uuid.uuid4().hex}"
    if (path := local_path(folder)) is not None:
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{other}", "wb") as f:
            _write(f, arrays)
        os.replace(f"{path}/{other}", f"{path}/{name}")
        return
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{other}") as f:
        _write(f, arrays)
    store.move(f"{path}/{other}", f"{path}/{name}")


_latest: list[str] = [""]


def mapped(folder: str, name: str) -> tuple[np.ndarray, ...] | None:
    """The arrays of folder/name mapped into memory; None without that file, so ask when all are written. A worker lets go of an earlier model's arrays when it meets another's folder."""
    if folder != _latest[0]:
        _map.cache_clear()
        _latest[0] = folder
    return _map(folder, name)


@lru_cache(MAPS)
def _map(folder: str, name: str) -> tuple[np.ndarray, ...] | None:
    """From a store without paths the file is first copied to an unlinked local one."""
    try:
        if (path := local_path(folder)) is not None:
            return _cut(np.memmap(f"{path}/{name}", np.uint8, "r").view(np.ndarray))
        store, path = _store(folder)
        with store.open_input_stream(f"{path}/{name}") as f, tempfile.NamedTemporaryFile() as copy:
            while part := f.read(1 << 24):
                copy.write(part)
            copy.flush()
            return _cut(np.memmap(copy.name, np.uint8, "r").view(np.ndarray))
    except FileNotFoundError:
        return None


def planes(values: np.ndarray) -> np.ndarray:
    """The bytes of sorted numbers, all first bytes, then all second bytes and so on: equal bytes stand together and compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).reshape(-1)


def unplanes(data: bytes | pa.Buffer, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def gathered(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers of all blobs of a column, one after another; each is copied once."""
    sizes = [pc.sum(pc.binary_length(c)).as_py() or 0 for c in column.chunks]
    out, at = np.empty(sum(sizes) // np.dtype(kind).itemsize, kind), 0
    for chunk in column.chunks:
        for blob in chunk:
            part = unplanes(blob.as_buffer(), kind)
            out[at : at + len(part)] = part
            at += len(part)
    return out


def by_shard(shard: np.ndarray) -> np.ndarray:
    """Stable order of small numbers from 0; up to 16 bits numpy sorts them by digits."""
    return np.argsort(shard.astype(np.uint16) if len(shard) and shard.max() < 2**16 else shard, kind="stable")


def near_order(keys: np.ndarray, group: np.ndarray | None = None, width: int = 64) -> np.ndarray:
    """Order of keys by group and then by as many of their top bits as fit beside their places in one number, which is sorted faster than places are.

    width: bits that keys have at most.
    """
    place = np.uint64(len(keys).bit_length())
    left = 0 if group is None or not len(group) else int(group.max()).bit_length()
    packed = (keys << np.uint64(64 - width)) >> np.uint64(left)
    if left:
        packed |= group.astype(np.uint64) << np.uint64(64 - left)
    packed >>= place
    packed <<= place
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= (np.uint64(1) << place) - np.uint64(1)
    return packed.view(np.int64)


def code_order(codes: np.ndarray) -> np.ndarray:
    """As np.argsort, for numbers that differ in their top bits, as codes do: what these leave open is put right."""
    order = near_order(codes)
    inner = codes[order]
    if not (inner[1:] < inner[:-1]).any():
        return order
    top = inner >> np.uint64(len(codes).bit_length())
    edges = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1], [True]]))
    wrong = np.unique(np.searchsorted(edges, np.flatnonzero(inner[1:] < inner[:-1]), "right") - 1)
    if len(wrong) > 1000:
        return np.argsort(codes)
    for a, b in zip(edges[wrong], edges[wrong + 1], strict=True):
        order[a:b] = order[a:b][np.argsort(inner[a:b])]
    return order


def different_codes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As np.unique with return_inverse."""
    order = code_order(codes)
    inner = codes[order]
    head = np.ones(len(inner), bool)
    head[1:] = inner[1:] != inner[:-1]
    which = np.empty(len(inner), np.int64)
    which[order] = np.cumsum(head) - 1
    return inner[head], which


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, and the sum of each one's counts."""
    if not len(keys):
        return keys, counts.astype(np.int64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(counts.astype(np.int64), heads)
