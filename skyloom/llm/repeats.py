"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are told apart only through the first `length` bytes, by digits of falling significance; groups that are still
equal after the last digit are exactly the repeated windows.

A digit of a window is what it shares with its neighbours, so that a run of windows goes through a pass as one row.
Digit 1 is the least code among a window's short grams. Digit 2, of blocks of a run, is the bytes that all windows of
the block cover, placed by that gram. The last digits, of single windows, are two codes of all their bytes. Each pass
drops the values that no two texts share; of equal runs or blocks the first goes on, and the windows of the others are
repeats; what shares the digit but differs is opened for the next pass. All passes are sums with partial aggregation,
joined back; no group is gathered anywhere. What a text repeats of itself is found with the text at hand, in the last step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import binary, chunks, lasting, runs, saved, scratch, utf8, without
from .words import NEAR, Coder, codes_at, loads, mix, window_codes

GRAM = 32


def _bytes(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    return utf8(part.column(part.schema.get_field_index(text)))


def _least(codes: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` codes in a row, by doubling."""
    n = len(codes) - width + 1
    if n > NEAR:
        return np.concatenate([_least(codes[at : min(at + NEAR, n) + width - 1], width) for at in range(0, n, NEAR)])
    reach, low = 1, codes
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    return np.minimum(low[: len(low) - (width - reach)], low[width - reach :]) if width > reach else low


def window_runs(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Longest runs of windows of one text with the same first digit: text number, first window, number of windows, digit."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, np.uint64)
    codes = window_codes(data, gram)
    low = _least(codes, length - gram + 1)
    usable = np.zeros(len(data), bool)
    edge = np.zeros(len(low) + 1, bool)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= length:
            usable[a : b - length + 1] = True
            edge[a] = True
    edge[1:-1] |= low[1:] != low[:-1]
    starts = np.flatnonzero(edge[:-1] & usable[: len(low)])
    doc = np.searchsorted(ends, starts, "right") - 1
    stops = np.minimum(np.append(starts[1:], len(data)), ends[doc + 1] - length + 1)
    # windows within one run can be equal only where its least gram comes twice: such runs (periodic texts) are cut into windows
    wide, digit = np.arange(length - gram + 1), low[starts]
    twice = np.zeros(len(starts), bool)
    for i in range(0, len(starts), 8192):
        a, z, d = starts[i : i + 8192], stops[i : i + 8192] - 1, digit[i : i + 8192, None]
        head = (codes[a[:, None] + wide] == d).argmax(1)
        tail = (codes[z[:, None] + wide[::-1]] == d).argmax(1)
        twice[i : i + 8192] = a + head != z + wide[-1] - tail
    parts = np.where(twice, stops - starts, 1)
    back = np.repeat(np.arange(len(starts)), parts)
    return doc[back], starts[back] + runs(parts), np.where(twice, 1, stops - starts)[back], digit[back]


def _first_of_each(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places, in order, of the first row of each text with the same a and b."""
    both = mix(a * np.uint64(0x9E3779B97F4A7C15) ^ b) + mix(doc.astype(np.uint64) + np.uint64(1))
    return np.sort(np.unique(both, return_index=True)[1])


def inner_repeats(data: np.ndarray, ends: np.ndarray, coder: Coder, length: int, gram: int) -> np.ndarray:
    """Starts of the windows which the same text has had before."""
    doc, start, n, digit = window_runs(data, ends, length, gram)
    if not len(doc):
        return start
    order = np.lexsort((digit, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (digit[order][1:] == digit[order][:-1])
    some = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    some.sort()
    count = n[some]
    at = np.repeat(start[some], count) + runs(count)
    if not len(at):
        return at
    first = np.zeros(len(at), bool)
    first[_first_of_each(np.repeat(doc[some], count), codes_at(loads(data), at, length), coder.code(at, at + length))] = True
    return at[~first]


def _tag(text):
    """32 bits of each text's hash, as a column: rows with the same key but other texts stay apart."""
    return F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))


def _runs_of(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(digit, code, key, place, n): place is the first window << 32 | tag. Runs that a text has had before are left out (see inner_repeats)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                data, ends = _bytes(part, "text")
                coder = Coder(data, lower=False)
                doc, start, n, digit = window_runs(data, ends, length, gram)
                if not len(doc):
                    continue
                code = coder.code(start, start + n + length - 1)
                some = _first_of_each(doc, digit, code)
                doc, start, n, digit, code = (x[some] for x in (doc, start, n, digit, code))
                place = ((start - ends[doc]) << 32) | part.column(part.schema.get_field_index("tag")).to_numpy()[doc]
                keys = part.column(part.schema.get_field_index("key")).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([pa.array(digit.view(np.int64)), pa.array(code.view(np.int64)), keys, pa.array(place), pa.array(n.astype(np.int32))], ["digit", "code", "key", "place", "n"])

    return docs.mapInArrow(run, "digit long, code long, key long, place long, n int")


def _inside(docs: DataFrame, picked: DataFrame, length: int, make, kept: str) -> DataFrame:
    """What make(data, coder, text number, first window, number of windows) gives for the picked runs of each text.

    make returns the text number and place of its rows, and the columns `kept` in between.
    """
    pieces = F.sort_array(F.collect_set(F.struct(F.shiftright("place", 32).alias("start"), "n")))  # once for rows that are equal
    lists = saved(picked.groupBy("key", F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tag")).agg(pieces.alias("picked")), "picked")
    rows = docs.join(lists, ["key", "tag"]).select("key", "tag", "picked", "text")
    names = [c.split()[0] for c in kept.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                data, ends = _bytes(part, "text")
                coder = Coder(data, lower=False)
                tags = part.column(1).to_numpy()
                lists = part.column(2)
                edges, flat = lists.offsets.to_numpy(), lists.flatten()
                first, count = flat.field(0).to_numpy(), flat.field(1).to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), np.diff(edges))
                doc, start, columns = make(data, coder, doc, first + ends[doc], count)
                keys = part.column(0).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([keys, pa.array(((start - ends[doc]) << 32) | tags[doc]), *(pa.array(x.view(np.int64)) for x in columns)], ["key", "place", *names])

    return rows.mapInArrow(run, f"key long, place long, {kept}")


def _blocks_of(docs: DataFrame, picked: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, place, digit, code, n) of the blocks of picked runs: windows whose least gram comes at about the same place."""
    wide, block = np.arange(length - gram + 1), max(1, (length - gram + 1) // 4)

    def make(data, coder, doc, first, count):
        anchor, codes = first.copy(), window_codes(data, gram)
        for i in range(0, len(first), 8192):
            at = first[i : i + 8192, None] + wide
            anchor[i : i + 8192] += codes[at].argmin(1)
        low, high = (anchor - first - count + 1) // block, (anchor - first) // block
        parts = high - low + 1
        back = np.repeat(np.arange(len(first)), parts)
        k = low[back] + runs(parts)
        doc, first, last, anchor = doc[back], first[back], (first + count - 1)[back], anchor[back]
        core = anchor - k * block
        start, stop = np.maximum(first, core - block + 1), np.minimum(last, core)
        digit = coder.code(core, core - block + 1 + length) ^ mix(k.astype(np.uint64))
        code = mix(coder.code(start, stop + length) + mix((anchor - start).astype(np.uint64)))
        some = _first_of_each(doc, digit, code)
        return doc[some], start[some], (digit[some], code[some], (stop - start + 1)[some])

    return _inside(docs, picked, length, make, "digit long, code long, n long")


def _windows_of(docs: DataFrame, picked: DataFrame, length: int) -> DataFrame:
    """(key, place, high, low) of every different window in the picked blocks, with its two codes."""

    def make(data, coder, doc, first, count):
        at = np.repeat(first, count) + runs(count)
        doc = np.repeat(doc, count)
        high, low = codes_at(loads(data), at, length), coder.code(at, at + length)
        some = _first_of_each(doc, high, low)
        return doc[some], at[some], (high[some], low[some])

    return _inside(docs, picked, length, make, "high long, low long")


def _covered(n) -> list:
    """Columns key, tag and cover of rows with a place and n windows of `length` bytes."""
    start = F.shiftleft(F.shiftright("place", 32), 32)
    return [F.col("key"), F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tag"), start.bitwiseOR(n.cast("long")).alias("cover")]


def _pass(found: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Of rows (digit, code, key, place, n): what is covered by repeats, and the rows to open for the next digit."""
    often = saved(found.groupBy("digit").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a < b").select("digit"), "digits")
    left = saved(found.join(often, "digit").select("digit", "code", "key", "place", "n"), "runs")
    groups = saved(left.groupBy("digit", "code").agg(F.min("key").alias("first")), "groups")
    mixed = saved(groups.groupBy("digit").agg(F.count("*").alias("c")).where("c > 1").select("digit"), "mixed")
    gone = F.coalesce(F.col("first") < F.col("key"), F.lit(False)).alias("gone")
    placed = saved(left.join(groups, ["digit", "code"]).select("digit", "key", "place", "n", gone), "placed")
    return placed.where("gone").select(_covered(F.col("n") + length - 1)), placed.where("not gone").join(mixed, "digit").select("key", "place", "n")


def repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, tag, cover): for texts that repeat strings of `length` bytes of rows with smaller keys, places start << 32 | bytes.

    What a text repeats of itself is not in it (see inner_repeats). Rows with the same key don't count as earlier for
    each other, nor rows without a key for any; the latter are left out, and rows meet their finds by key and tag.
    """
    if length < 8:
        raise ValueError("strings of under 8 bytes repeat everywhere")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text")).where("key is not null").withColumn("tag", _tag("text"))
    gram = min(GRAM, length)
    runs_gone, mixed = _pass(_runs_of(rows, length, gram), length)
    blocks_gone, mixed = _pass(saved(_blocks_of(rows, mixed, length, gram), "blocks"), length)
    windows = saved(_windows_of(rows, mixed, length), "windows")
    firsts = saved(windows.groupBy("high", "low").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last").select("high", "low", "first"), "firsts")
    again = windows.join(firsts, ["high", "low"]).where("first < key").select(_covered(F.lit(length)))
    return runs_gone.unionByName(blocks_gone).unionByName(again).groupBy("key", "tag").agg(F.collect_set("cover").alias("cover"))


def without_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text", whole_characters: bool = False) -> DataFrame:
    """docs with n_bytes, spans (array of start, stop in bytes: longest removed runs) and kept (binary: the bytes left).

    With whole_characters a character of which a byte is left stays whole. Null texts count as empty; texts shorter
    than `length`, empty tables and tables without repeats lose nothing. Result columns win name clashes. Texts of any
    length are cut whole; of repeated rows the ones with the smaller key stay, those with one key lose only what they
    repeat of themselves and of smaller keys.
    """
    plain = without(docs, "n_bytes", "spans", "kept", "_tag", "_cover", "_key")
    with scratch(docs.sparkSession):
        cover = lasting(repeats(docs, length, key, text).select(F.col("key").alias("_key"), F.col("tag").alias("_tag"), F.col("cover").alias("_cover")), "cover")
    tagged = plain.withColumn("_tag", _tag(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    rows = tagged.join(cover, (F.col(f"`{key}`").cast("long") == cover["_key"]) & (tagged["_tag"] == cover["_tag"]), "left").select(*[tagged[f"`{c}`"] for c in plain.columns], "_cover")

    def cut(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, list[dict]]:
        if not len(places):
            return data, []
        mark = np.zeros(len(data) + 1, np.int32)
        np.add.at(mark, places >> 32, 1)
        np.add.at(mark, (places >> 32) + (places & 0xFFFFFFFF), -1)
        gone = np.cumsum(mark[:-1]) > 0
        if whole_characters and len(data):
            heads = np.flatnonzero((data & 0xC0) != 0x80)
            gone = np.repeat(np.logical_and.reduceat(gone, heads), np.diff(np.append(heads, len(data))))
        step = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        return data[~gone], [{"start": a, "stop": b} for a, b in zip(step[::2].tolist(), step[1::2].tolist(), strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                data, ends = _bytes(part, text)
                coder = Coder(data, lower=False)
                own = inner_repeats(data, ends, coder, length, min(GRAM, length))
                edges = np.searchsorted(own, ends)
                made, spans = [], []
                for i, found in enumerate(part.column(part.schema.get_field_index("_cover"))):
                    places = ((own[edges[i] : edges[i + 1]] - ends[i]) << 32) | length
                    mine = [found.values.to_numpy()] if found.is_valid else []
                    kept, gone = cut(data[ends[i] : ends[i + 1]], np.concatenate([places, *mine]))
                    made.append(kept)
                    spans.append(gone)
                body = binary(np.concatenate(made), np.concatenate([[0], np.cumsum([len(x) for x in made])]))
                old = part.drop_columns(["_cover"])
                yield pa.RecordBatch.from_arrays([*old.columns, pa.array(np.diff(ends)), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), body], [*old.schema.names, "n_bytes", "spans", "kept"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema]
    return rows.mapInArrow(run, ", ".join([*fields, "n_bytes long, spans array<struct<start: bigint, stop: bigint>>, kept binary"]))
