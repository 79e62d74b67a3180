"""Collocations: phrases whose words stand together oftener than their parts alone let expect, counted in tries.

A task counts phrases in a HAT-trie: paths of word ids in ranges, each range a hash container, which bursts in two when
it is full; when the trie is too large, whole subtrees leave it as sorted runs. Runs are rows that Spark sums by path.
Counting goes by length: a phrase can only be frequent if both the phrases it holds that are a word shorter are, so that
longer paths are grown from frequent ones alone. Which these are a task is told by a filter of bounded size, which may let
others pass, never holds one back, and so changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import chunks, lasting, saved, scratch, spread, utf8
from .words import LOWER, loads, mix

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
GAP = BREAK.copy()
GAP[[32, 9]] = True

_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_ODD, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Bits of a word's id in a path: three words make 63 of 64.
ID = 21
NONE = np.uint64(2**64 - 1)


@dataclass(frozen=True)
class Settings:
    """most: words of the longest phrases, 2 or 3; least: occurrences a candidate has; share: percent of its occurrences
    that, inside one longer candidate, make it go; top: phrases of a language that are returned; filter_bits, a power of
    two: size of the filter of frequent paths; paths: what a task's trie holds before subtrees leave it; ids: words it
    knows at a time.
    """

    most: int = 3
    least: int = 10
    share: int = 50
    top: int = 2000
    filter_bits: int = 1 << 27
    paths: int = 1 << 20
    ids: int = (1 << ID) - 2


class Container:
    """Counts of paths in an open-addressed hash table of arrays; all paths of a call are looked up together."""

    def __init__(self, slots: int):
        self.keys, self.counts, self.used = np.full(slots, NONE), np.zeros(slots, np.int64), 0
        self.shift, self.mask = np.uint64(64 - (slots.bit_length() - 1)), slots - 1

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds counts of different keys; the table has to have room for them."""
        slot = ((keys * _ODD) >> self.shift).astype(np.int64)
        while len(keys):
            held = self.keys[slot]
            free = held == NONE
            self.keys[slot[free]] = keys[free]  # of several that claim a slot the last one has it
            mine = self.keys[slot] == keys
            self.counts[slot[mine]] += counts[mine]
            self.used += int((mine & free).sum())
            keys, counts, slot = keys[~mine], counts[~mine], (slot[~mine] + 1) & self.mask

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.keys != NONE)
        at = at[np.argsort(self.keys[at])]
        return self.keys[at], self.counts[at]


class HatTrie:
    """Counts of paths. Its containers hold neighbouring ranges of paths: many first words, one, or a part of those after one."""

    def __init__(self, burst: int = 1 << 16):
        self.burst, self.lows, self.containers = burst, np.zeros(1, np.uint64), [Container(4 * burst)]

    def __len__(self) -> int:
        return sum(c.used for c in self.containers)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds counts of different paths in rising order."""
        for start in range(0, len(keys), self.burst):
            part = slice(start, start + self.burst)
            self._add(keys[part], counts[part])

    def _add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        edges = np.append(np.searchsorted(keys, self.lows), len(keys))
        full = []
        for i in np.flatnonzero(np.diff(edges)):
            self.containers[i].add(keys[edges[i] : edges[i + 1]], counts[edges[i] : edges[i + 1]])
            full += [i] * (self.containers[i].used > self.burst)
        for i in reversed(full):
            self._burst(i)

    def _burst(self, i: int) -> None:
        """Two containers for one, cut between words: at a first word if it has several, else at a second, else at a third."""
        keys, counts = self.containers[i].sorted()
        middle = len(keys) // 2
        for level in (2, 1, 0):
            cut = keys[middle] >> np.uint64(ID * level) << np.uint64(ID * level)
            at = int(np.searchsorted(keys, cut))
            if at:
                break
        low, high = Container(4 * self.burst), Container(4 * self.burst)
        low.add(keys[:at], counts[:at])
        high.add(keys[at:], counts[at:])
        self.containers[i : i + 1] = [low, high]
        self.lows = np.insert(self.lows, i + 1, cut)

    def spill(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Empties subtrees, those that save least first (fewest occurrences for a path), until no more than `most` paths are left; each is a sorted run."""
        left = len(self)
        for i in sorted((i for i, c in enumerate(self.containers) if c.used), key=lambda i: self.containers[i].counts.sum() / self.containers[i].used):
            if left <= most:
                return
            left -= self.containers[i].used
            yield self.containers[i].sorted()
            self.containers[i] = Container(4 * self.burst)


class Vocabulary:
    """Ids of word codes in a task, in order of arrival from 1."""

    def __init__(self):
        self.codes, self.ids, self.arrived = np.zeros(0, np.uint64), np.zeros(0, np.uint64), [np.zeros(1, np.uint64)]

    def __len__(self) -> int:
        return len(self.codes)

    def ids_of(self, codes: np.ndarray) -> np.ndarray:
        """The ids of different codes in rising order; those that are new get some."""
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), bool)
        inside = at < len(self.codes)
        known[inside] = self.codes[at[inside]] == codes[inside]
        new = codes[~known]
        if len(new):
            ids = np.arange(len(self) + 1, len(self) + 1 + len(new), dtype=np.uint64)
            self.codes, self.ids = np.insert(self.codes, at[~known], new), np.insert(self.ids, at[~known], ids)
            self.arrived.append(new)
        return self.ids[np.searchsorted(self.codes, codes)]

    def by_id(self) -> np.ndarray:
        self.arrived = [np.concatenate(self.arrived)]
        return self.arrived[0]


@dataclass
class Words:
    """Words of a batch of texts: codes (of language and word), whether the next one follows in the same piece, and where they stand."""

    codes: np.ndarray
    follows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    data: np.ndarray


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Codes of byte runs, eight bytes at a time: different ones for different runs of up to eight bytes, for longer ones but for a chance of 2^-64 a pair."""
    whole, size = loads(data), ends - starts
    out = mix((whole[starts] & _KEEP[np.minimum(size, 8)]) * _ODD + size.astype(np.uint64) * _STEP) if len(starts) else np.zeros(0, np.uint64)
    some, at = np.flatnonzero(size > 8), 8
    while len(some):
        out[some] = mix((out[some] ^ (whole[starts[some] + at] & _KEEP[np.minimum(size[some] - at, 8)])) * _ODD + _STEP)
        at += 8
        some = some[size[some] > at]
    return out


def words_of(batch: pa.RecordBatch, languages: dict[str, np.uint64]) -> Words:
    """batch: text and lang; languages: codes of those that were met, to which new ones are added."""
    body, bounds = utf8(batch.column("text"))
    data = LOWER[body]
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = GAP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(~gap[1:-1] & (gap[:-2] | edge[:-1]))
    ends = np.flatnonzero(~gap[1:-1] & (gap[2:] | edge[1:])) + 1
    breaks = np.concatenate([[0], np.cumsum(BREAK[data])])
    text = np.searchsorted(bounds, starts, "right") - 1
    follows = np.zeros(len(starts), bool)
    follows[:-1] = (breaks[starts[1:]] == breaks[ends[:-1]]) & (text[1:] == text[:-1])
    own = np.zeros(batch.num_rows, np.uint64)
    coded = batch.column("lang").dictionary_encode()
    for i, name in enumerate(coded.dictionary.to_pylist()):
        if name not in languages:
            raw = np.frombuffer(name.encode(), np.uint8)
            languages[name] = _codes(raw, np.zeros(1, np.int64), np.array([len(raw)]))[0] if len(raw) else np.uint64(0)
        own[coded.indices.to_numpy() == i] = languages[name]
    return Words(mix(_codes(data, starts, ends) + mix(own)[text] * _STEP), follows, starts, ends, text, data)


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where a filter of so many bits has keys: three places each, by row."""
    second = mix(keys ^ _STEP) | np.uint64(1)
    return np.stack([(mix(keys) + second * np.uint64(i)) & np.uint64(bits - 1) for i in range(3)], -1)


def path_key(codes: list[np.ndarray]) -> np.ndarray:
    """One number for a path of word codes, for filters only."""
    out = codes[0]
    for c in codes[1:]:
        out = mix(out * np.uint64(3)) + c
    return out


def _passes(keys: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    at = places(keys, len(frequent) * 64)
    return np.all((frequent[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1), -1)


def _counting(length: int, settings: Settings, frequent: Broadcast | None):
    """Runs of a task's phrases of so many words; those of one word come with the word and its language."""

    def rows(keys: np.ndarray, counts: np.ndarray, known: Vocabulary, spelt: list, spoken: list) -> pa.RecordBatch:
        ids = [((keys >> np.uint64(ID * (2 - i))) & np.uint64((1 << ID) - 1)).astype(np.int64) for i in range(length)]
        codes = [known.by_id()[i] for i in ids]
        order = np.lexsort(codes[::-1])
        columns = [pa.array(c[order].view(np.int64)) for c in codes] + [pa.array(counts[order])]
        if length == 1:
            columns += [pa.array([spelt[i] for i in ids[0][order]], pa.binary()), pa.array([spoken[i] for i in ids[0][order]], pa.string())]
        return pa.RecordBatch.from_arrays(columns, [*(f"w{i + 1}" for i in range(length)), "n", *(("word", "lang") if length == 1 else ())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known, languages, spelt, spoken = HatTrie(), Vocabulary(), {}, [b""], [""]
        for batch in (part for batch in batches for part in chunks(batch, "text")):
            w = words_of(batch, languages)
            begins = np.arange(len(w.codes) - length + 1)
            for i in range(length - 1):
                begins = begins[w.follows[begins + i]]
            for i in range(2 if frequent else 0):  # both shorter phrases in it have to be frequent
                begins = begins[_passes(path_key([w.codes[begins + i + j] for j in range(length - 1)]), frequent.value)]
            step = max(1, settings.ids // (2 * length))  # so that a longer text's words have ids too
            for part in (begins[at : at + step] for at in range(0, len(begins), step)):
                codes, first, which = np.unique(np.concatenate([w.codes[part + i] for i in range(length)]), return_index=True, return_inverse=True)
                if len(known) + len(codes) > settings.ids:
                    for run_of in trie.spill(0):
                        yield rows(*run_of, known, spelt, spoken)
                    trie, known, spelt, spoken = HatTrie(), Vocabulary(), [b""], [""]
                before, ids = len(known), known.ids_of(codes)
                if length == 1:
                    names, new = batch.column("lang"), np.flatnonzero(ids > before)
                    for i in part[first[new[np.argsort(ids[new])]]]:
                        spelt.append(w.data[w.starts[i] : w.ends[i]].tobytes())
                        spoken.append(names[int(w.text[i])].as_py())
                path = np.zeros(len(part), np.uint64)
                for i in range(length):
                    path |= ids[which[i * len(part) : (i + 1) * len(part)]] << np.uint64(ID * (2 - i))
                trie.add(*np.unique(path, return_counts=True))
                if len(trie) > settings.paths:
                    for run_of in trie.spill(settings.paths // 2):
                        yield rows(*run_of, known, spelt, spoken)
        for run_of in trie.spill(0):
            yield rows(*run_of, known, spelt, spoken)

    return run


def _filter(paths: DataFrame, length: int, settings: Settings) -> np.ndarray:
    """A filter that all these paths pass: 64-bit pieces, of settings.filter_bits bits at most, whatever the number of paths."""
    n = paths.count()
    bits = min(settings.filter_bits, max(1 << 12, 1 << (24 * n).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            at = places(path_key([c.to_numpy().view(np.uint64) for c in batch.columns]), bits).ravel()
            np.bitwise_or.at(own, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(own[used].view(np.int64))], ["piece", "bits"])

    pieces = paths.select(*(f"w{i + 1}" for i in range(length))).mapInArrow(run, "piece long, bits long").groupBy("piece").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[pieces.column("piece").to_numpy()] = pieces.column("bits").to_numpy().view(np.uint64)
    return out


def counted(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(sizes, words, phrases): (lang, n) of all word occurrences; (w1, n, word, lang) of the frequent words; and for each length from 2 the frequent phrases (w1, w2.., n). All written to shared storage.

    docs: text and lang. Words are known by codes of language and word (see _codes).
    """
    if settings.most not in (2, 3):
        raise ValueError("phrases have 2 or 3 words")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).cast("string").alias("lang"))
    ones = rows.mapInArrow(_counting(1, settings, None), "w1 long, n long, word binary, lang string")
    every = saved(ones.groupBy("w1", "word", "lang").agg(F.sum("n").alias("n")), "words")
    sizes = saved(every.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    words = saved(every.where(F.col("n") >= settings.least), "frequent-words")
    phrases, shorter = [], words
    for length in range(2, settings.most + 1):
        frequent = spark.sparkContext.broadcast(_filter(shorter, length - 1, settings))
        keys = [f"w{i + 1}" for i in range(length)]
        runs = rows.mapInArrow(_counting(length, settings, frequent), ", ".join(f"{k} long" for k in [*keys, "n"]))
        shorter = saved(runs.groupBy(*keys).agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least), "frequent-phrases")
        frequent.destroy()
        phrases.append(shorter)
    return sizes, words, phrases


def _named(df: DataFrame, names: DataFrame, keys: list[str], count: str, *more: tuple[str, str]) -> DataFrame:
    """df with the count that `names` has of the phrase of these columns, and others of its columns as asked."""
    own = [f"w{i + 1}" for i in range(len(keys))]
    other = names.select(*(F.col(o).alias(f"_{o}") for o in own), F.col("n").alias(count), *(F.col(c).alias(to) for c, to in more))
    on = [F.col(k) == F.col(f"_{o}") for k, o in zip(keys, own, strict=True)]
    return df.join(other, on).drop(*(f"_{o}" for o in own))


def score(a: str | Column, left: str | Column, right: str | Column) -> Column:
    """floor(1000000 * a * a / (left * right)), in decimals of 38 digits: exact for counts below 10^16."""
    wide = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")
    product = lambda x, y: (wide(x) * wide(y)).cast("decimal(38,0)")
    return F.call_function("div", product(a, a) * F.lit(1000000).cast("decimal(7,0)"), product(left, right))


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language by score, then a, then the phrase's bytes.

    docs has text and lang; A-Z become lower case, texts are cut at .,;:!? and line breaks, and words are what lies
    between blanks and tabs there. Null texts are empty, null languages `und`. Each row counts, repeated ones too; texts
    count whole; phrases don't go from one piece or text to the next. Ties are settled as said, never by chance. Other
    columns, whatever their names, aren't read, and an empty table gives no rows.
    """
    with scratch(docs.sparkSession):
        sizes, words, phrases = counted(spread(docs.select("text", "lang")), settings)
        two = _named(_named(phrases[0].withColumnRenamed("n", "a"), words, ["w1"], "l", ("word", "s1"), ("lang", "lang")), words, ["w2"], "r", ("word", "s2"))
        spelt = lambda *c: F.concat_ws(" ", *(F.decode(x, "utf-8") for x in c))
        if settings.most == 3:
            three = phrases[1].withColumnRenamed("n", "a")
            inside = three.select("w1", "w2", "a").unionByName(three.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
            longest = inside.groupBy(F.col("w1").alias("_w1"), F.col("w2").alias("_w2")).agg(F.max("a").alias("_most"))
            kept = two.join(longest, (F.col("w1") == F.col("_w1")) & (F.col("w2") == F.col("_w2")), "left")
            kept = kept.where(F.col("_most").isNull() | (F.col("_most").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * settings.share))
            full = _named(_named(three, words, ["w1"], "l1", ("word", "s1"), ("lang", "lang")), words, ["w2"], "n2", ("word", "s2"))
            full = _named(full, words, ["w3"], "r2", ("word", "s3"))
            full = _named(_named(full, phrases[0], ["w1", "w2"], "l2"), phrases[0], ["w2", "w3"], "r1")
            full = full.withColumns({"_1": score("a", "l1", "r1"), "_2": score("a", "l2", "r2")})
            early = F.col("_1") <= F.col("_2")
            both = full.select("lang", spelt("s1", "s2", "s3").alias("phrase"), "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("_1", "_2").alias("score"))
        else:
            kept, both = two, None
        pairs = kept.select("lang", spelt("s1", "s2").alias("phrase"), "a", "l", "r", score("a", "l", "r").alias("score"))
        every = pairs.unionByName(both) if both is not None else pairs
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        # a language may hold most of the phrases: first the best of many small parts, then of these
        part = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
        some = every.withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= settings.top).drop("_n")
        best = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= settings.top)
        out = best.join(sizes.select(F.col("lang").alias("_lang"), "n"), F.col("lang") == F.col("_lang")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        return lasting(out, "phrases")
