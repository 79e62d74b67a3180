"""Byte-level BPE encoding and decoding.

Pre-tokenisation finds the boundaries of all texts of a chunk at once and without regex: every code point gets a
class (letter, number, space, other, and what follows where that matters), each class is a function from state to
state, and a blocked scan of these functions, which compose associatively, gives the state at every code point.
Slices between boundaries go through pair merging with a cache; byte offsets of the tokens are kept for decoding.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import binary, chunks, runs, utf8, without
from .words import alike

# Classes of code points. SHORT and LONG are apostrophes that begin 's 't 'm 'd, and 'll 've 're.
# GLUE is a blank before a code point that is no space; LAST another space in that place.
LETTER, NUMBER, OTHER, SHORT, LONG, GLUE, LAST, SPACE, EDGE = range(9)
# States: between tokens, in letters, in numbers, in others, in spaces, after a blank that joins on, one or two left of a contraction.
FREE, IN_L, IN_N, IN_O, IN_S, JOINS, ONE, TWO = range(8)
#: White space of Unicode: fixed values of the pattern's \s.
WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BLOCK = 512


@cache
def code_point_classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    table[WHITE] = SPACE
    return table


@cache
def machine() -> tuple[np.ndarray, np.ndarray]:
    """(next, begins)[class, state]: the state after a code point, and whether a token begins at it."""
    step, begins = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for kind, within in ((LETTER, IN_L), (NUMBER, IN_N), (OTHER, IN_O), (SHORT, IN_O), (LONG, IN_O)):
        step[kind] = within
        begins[kind, [within, JOINS]] = False
    for kind, left in ((SHORT, ONE), (LONG, TWO)):
        step[kind, [s for s in range(8) if s not in (IN_O, JOINS)]] = left
    step[LETTER, ONE], step[LETTER, TWO] = FREE, ONE
    begins[LETTER, [ONE, TWO]] = False
    step[SPACE], begins[SPACE, IN_S] = IN_S, False
    step[GLUE], step[LAST], step[EDGE] = JOINS, FREE, FREE
    return step, begins


def states(kinds: np.ndarray) -> np.ndarray:
    """The state before every code point, starting FREE: compositions per block, their scan, then all blocks at once."""
    step, _ = machine()
    n = len(kinds)
    wide = -(-n // BLOCK)
    grid = np.full(wide * BLOCK, EDGE, np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(wide, BLOCK).T)
    flat = step.ravel()
    whole = np.broadcast_to(np.arange(8, dtype=np.uint8), (wide, 8)).copy()
    for row in grid:
        whole = flat[(row[:, None] * np.uint8(8)) + whole]
    reach = 1
    while reach < wide:  # composed[i] = all blocks up to i, doubling the reach
        whole[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), axis=1)
        reach *= 2
    now = np.concatenate([[FREE], whole[:-1, FREE]]).astype(np.uint8)
    out = np.empty_like(grid)
    for i, row in enumerate(grid):
        out[i] = now
        now = flat[row * np.uint8(8) + now]
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where tokens begin among the code points of texts; `first` marks each text's first one."""
    kinds = code_point_classes()[points]
    nxt = np.full(len(points) + 2, 0, np.uint32)
    nxt[: len(points)] = points
    last = np.ones(len(points), bool)
    last[:-1] = first[1:]
    last2 = np.ones(len(points), bool)
    last2[:-1] = last[:-1] | last[1:]
    quote = np.flatnonzero((points == 39) & ~last)
    a, b = nxt[quote + 1], nxt[quote + 2]
    short = np.isin(a, [ord(c) for c in "stmd"])
    long = ~last2[quote] & (((a == ord("l")) & (b == ord("l"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("r")) & (b == ord("e"))))
    kinds[quote[short]], kinds[quote[long]] = SHORT, LONG
    space = kinds == SPACE
    follows = np.zeros(len(points), bool)
    follows[:-1] = ~space[1:] & ~last[:-1]
    kinds[space & follows] = LAST
    kinds[space & follows & (points == 32)] = GLUE
    # an edge before each text, so that every text starts FREE
    at = np.arange(len(points)) + np.cumsum(first)
    with_edges = np.full(len(points) + int(first.sum()), EDGE, np.uint8)
    with_edges[at] = kinds
    before = states(with_edges)[at]
    return machine()[1][kinds, before]


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """The lowest-ranked adjacent pair joins, the leftmost first, until none has a rank."""
    if (known := rank.get(piece)) is not None:
        return [known]
    n = len(piece)
    if n < 100:
        parts = [piece[i : i + 1] for i in range(n)]
        pairs = [rank.get(piece[i : i + 2], 1 << 30) for i in range(n - 1)]
        while pairs:
            low = min(pairs)
            if low == 1 << 30:
                break
            i = pairs.index(low)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = rank.get(parts[i] + parts[i + 1], 1 << 30)
            if i:
                pairs[i - 1] = rank.get(parts[i - 1] + parts[i], 1 << 30)
        return [rank[p] for p in parts]
    # long pieces: a heap of pairs over a linked list
    size, left, right = [1] * n, list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(r, i, 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, span = heapq.heappop(heap)
        j = right[i] if size[i] else -1
        if j < 0 or size[i] + size[j] != span:
            continue
        size[i], size[j], right[i] = span, 0, right[j]
        if right[j] >= 0:
            left[right[j]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b >= 0 and (r := rank.get(piece[a : b + size[b]])) is not None:
                heapq.heappush(heap, (r, a, size[a] + size[b]))
    return [rank[piece[i : i + s]] for i, s in enumerate(size) if s]


class Encoder:
    """Encodes chunks of texts; pieces met before come from a cache that is emptied at `most` entries."""

    def __init__(self, path: str, most: int = 200_000):
        self.rank, self.cache, self.most = ranks(path), {}, most
        self.length = np.zeros(max(self.rank.values()) + 1, np.int32)
        for token, i in self.rank.items():
            self.length[i] = len(token)

    def pieces(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Byte offsets where pieces begin."""
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        first = np.zeros(len(data) + 1, bool)
        first[ends[:-1]] = True
        return lead[boundaries(points, first[:-1][lead])] if len(lead) else lead

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, the byte offset of each token in its text, and the n + 1 offsets of each text's tokens."""
        starts = self.pieces(data, ends)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
        stops = np.append(starts[1:], len(data))
        _, where, which = alike(data, starts, stops)
        raw, made = data.tobytes(), []
        for a, b in zip(starts[where].tolist(), stops[where].tolist(), strict=True):
            piece = raw[a:b]
            ids = self.cache.get(piece)
            if ids is None:
                if len(self.cache) >= self.most:
                    self.cache.clear()
                ids = merge(piece, self.rank)
                if b - a < 64:
                    self.cache[piece] = ids
            made.append(ids)
        counts = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter((i for ids in made for i in ids), np.uint32, int(counts.sum()))
        heads, each = np.cumsum(counts) - counts, counts[which]
        ids = flat[np.repeat(heads[which], each) + runs(each)]
        widths = self.length[ids].astype(np.int64)
        offsets = np.cumsum(widths) - widths
        bounds = np.searchsorted(offsets, ends)
        bounds[-1] = len(ids)
        return ids, offsets - np.repeat(ends[:-1], np.diff(bounds)), bounds


@cache
def encoder(path: str) -> Encoder:
    """One for each Python worker, so that its cache serves all tasks there."""
    return Encoder(path)


@cache
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, by id, with each one's first place and length."""
    table = ranks(path)
    width = np.zeros(max(table.values()) + 1, np.int64)
    for token, i in table.items():
        width[i] = len(token)
    return np.frombuffer(b"".join(sorted(table, key=table.get)), np.uint8), np.cumsum(width) - width, width


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs less its text, with `ids` and `offsets`: packed little-endian unsigned 32-bit numbers, one for each token.

    offsets hold the byte in the text where each token begins. Null texts count as empty and give empty results;
    a text of any length is encoded whole. Columns of docs called ids or offsets give way. Rows stay as they are,
    repeated ones too, and an empty table stays empty.
    """
    plain = without(docs, "ids", "offsets")
    kept = [c for c in plain.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                ids, offsets, bounds = encoder(path).encode(*utf8(part.column(part.schema.get_field_index(text))))
                packed = [binary(x.astype("<u4").view(np.uint8), bounds * 4) for x in (ids, offsets)]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), *packed], [*kept, "ids", "offsets"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema if f.name != text]
    return plain.mapInArrow(run, ", ".join([*fields, "ids binary", "offsets binary"]))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """encoded with `decoded` binary: the bytes of its packed ids. Null ids count as none; a column of that name gives way; an empty table stays empty."""
    plain = without(encoded, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body, heads, width = token_bytes(path)
        for batch in batches:
            for part in chunks(batch, ids):
                data, ends = utf8(part.column(part.schema.get_field_index(ids)))
                tokens = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
                each = width[tokens]
                text = body[np.repeat(heads[tokens], each) + runs(each)]
                yield pa.RecordBatch.from_arrays([*part.columns, binary(text, np.concatenate([[0], np.cumsum(each)])[ends // 4])], [*part.schema.names, "decoded"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema]
    return plain.mapInArrow(run, ", ".join([*fields, "decoded binary"]))
