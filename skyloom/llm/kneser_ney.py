"""Interpolated modified Kneser-Ney language model over word trigrams.

It is counted in Spark. (1) Words, by 64-bit code; the codes of a range are one sorted array, and a word's id is its place
in all arrays. (2) Trigrams, summed per task and dealt to shards by their first two words; contexts that can be frequent,
as both their words are, are dealt over as many shards as these ask for. A shard is one sorted array of hashes with
counts, and one of the contexts that occur more than once. (3) Bigrams, by the number of different words before them, in
sorted arrays of two 32-bit ids, dealt by their first word likewise. (4) The number of different words before each word,
beside the word arrays. Tasks write the arrays to shared storage, one file for each shard or range, and scoring tasks map
them into memory: no array passes through the driver, which gets the words that are dealt over several shards (at most
two for each) with their counts. Scoring looks up many texts at a time, in the order of each shard's arrays, so that what
is done for each shard and not for each token stays small however many shards there are.

Texts begin with one start mark and end with one end token. The first token is judged by bigrams, counted as they occur;
the others by trigrams. A context that occurred once is not stored: it is known from its bigram.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import by_shard, code_order, different_codes, gathered, mapped, near_order, planes, put, summed
from .shared import chunks, saved, scratch, shared_dir, trim, utf8, without
from .words import Coder, mix, words

#: The code of the token that ends every text.
END = np.uint64(0x9D3A5C0E2B7F4611)
#: Tokens that a counting task gathers before it sums and sends them on.
GATHER = 1_500_000
#: Tokens that a scoring task looks up at a time; a longer text comes alone.
SLICE = 1 << 19
#: Tokens whose trigrams are sorted at a time: with the start and what is before it their words have numbers of 21 bits.
WIDEST = (1 << 21) - 8
#: Bytes of text for each shard, of which a shard's memory follows.
SHARD_BYTES = 12 << 20
#: Contexts whose words are looked up at a time.
PART = 1 << 18
_32, _LOW32 = np.uint64(32), np.uint64(2**32 - 1)


@dataclass
class Model:
    folder: str
    ranges: int
    shards: int
    tokens: int = 0
    words: int = 0
    bases: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    cuts1: np.ndarray = field(default_factory=lambda: np.zeros(4))
    cuts2: np.ndarray = field(default_factory=lambda: np.zeros(4))
    cuts3: np.ndarray = field(default_factory=lambda: np.zeros(4))
    pairs: int = 0
    shared: int = 0
    #: Sorted ids that are dealt over several shards, the start and what stands before it among them, and how often each occurs.
    frequent: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    times: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    # --- words
    def range_of(self, codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(64 - (self.ranges.bit_length() - 1))).astype(np.int64) if self.ranges > 1 else np.zeros(len(codes), np.int64)

    def ids(self, codes: np.ndarray) -> np.ndarray:
        """Ids of sorted different codes; -1 for words that were not counted."""
        out = np.full(len(codes), -1, np.int64)
        edges = np.searchsorted(self.range_of(codes), np.arange(self.ranges + 1))
        for r in np.flatnonzero(np.diff(edges)):
            if self.bases[r + 1] > self.bases[r]:
                known, part = mapped(self.folder, f"word-{r}")[0], codes[edges[r] : edges[r + 1]]
                at = np.minimum(np.searchsorted(known, part), len(known) - 1)
                out[edges[r] : edges[r + 1]] = np.where(known[at] == part, at + self.bases[r], -1)
        return out

    def by_id(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted ids of words: occurrences, and different words before them."""
        counts, before = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        edges = np.searchsorted(ids, self.bases)
        for r in np.flatnonzero(np.diff(edges)):
            rows, at = slice(edges[r], edges[r + 1]), ids[edges[r] : edges[r + 1]] - self.bases[r]
            counts[rows], before[rows] = mapped(self.folder, f"word-{r}")[1][at], mapped(self.folder, f"before-{r}")[0][at]
        return counts, before

    def counted(self, ids: np.ndarray) -> np.ndarray:
        """Occurrences of words that are dealt over several shards, 0 for others; the start, and what stands before it, count as every token does."""
        ids = ids.astype(np.int64)
        at = np.minimum(np.searchsorted(self.frequent, ids), len(self.frequent) - 1)
        return np.where(self.frequent[at] == ids, self.times[at], 0)

    # --- bigrams
    @property
    def start(self) -> int:
        """The id that stands before a text's first token."""
        return self.words

    @property
    def before(self) -> int:
        """What stands before the start."""
        return self.words + 1

    @property
    def pair_bits(self) -> int:
        """Bits of two ids as one number."""
        return 32 + self.before.bit_length()

    def shard_of(self, first: np.ndarray, second: np.ndarray, count: np.ndarray) -> np.ndarray:
        """count: how often the first word occurs; over a quarter of a shard's share, it is dealt on by the second."""
        return self._dealt(first.astype(np.uint64), second, self.ways(count))

    def ways(self, counts: np.ndarray) -> np.ndarray:
        return np.maximum(1, np.minimum(self.shards, 4 * counts * self.shards // max(1, self.tokens)))

    def _dealt(self, keys: np.ndarray, last: np.ndarray, ways: np.ndarray) -> np.ndarray:
        n, several = np.uint64(self.shards), np.flatnonzero(ways > 1)
        out = mix(keys) % n
        out[several] = (out[several] + mix(last[several].astype(np.uint64) + np.uint64(7)) % ways[several].astype(np.uint64)) % n
        return out.astype(np.int64)

    # --- trigrams
    def ways_of(self, contexts: np.ndarray, counts) -> np.ndarray:
        """Over how many shards each context (two ids) is dealt; counts: occurrences of words. Part by part, which bounds what numpy holds."""
        if len(contexts) > PART:
            return np.concatenate([self.ways_of(contexts[at : at + PART], counts) for at in range(0, len(contexts), PART)])
        return self.ways(np.minimum(counts((contexts >> _32).astype(np.int64)), counts((contexts & _LOW32).astype(np.int64))))

    def triple_shard(self, contexts: np.ndarray, last: np.ndarray, ways: np.ndarray) -> np.ndarray:
        return self._dealt(contexts, last, ways)

    def discount(self, cuts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.concatenate([[0.0], cuts[1:]])[np.minimum(counts, 3)]


def discounts(n: np.ndarray) -> np.ndarray:
    """[0, D1, D2, D3+] from the numbers of entries counted 1, 2, 3 and 4 times; 0.5, 1, 1.5 where these give none."""
    n1, n2, n3, n4 = (float(x) for x in n)
    if min(n1, n2, n3, n4) <= 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    return np.array([0, *(min(max(d, 0.05), top) for d, top in ((1 - 2 * y * n2 / n1, 0.95), (2 - 3 * y * n3 / n2, 1.95), (3 - 4 * y * n4 / n3, 2.95)))])


def tokens(part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each text's words and its end, and the n + 1 offsets."""
    data, ends = utf8(part.column(part.schema.get_field_index(text)))
    starts, stops, bounds = words(data, ends)
    codes = Coder(data).code(starts, stops) if len(starts) else np.zeros(0, np.uint64)
    return np.insert(codes, bounds[1:], END), bounds + np.arange(len(bounds))


def _narrow(counts: np.ndarray) -> np.ndarray:
    if len(counts) and counts.max() >= 2**32:
        raise OverflowError("one task has counted over 2^32 of one n-gram")
    return counts.astype("<u4")


def find_code(high: np.ndarray, low: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Places of the first 48 bits of codes among sorted ones, kept as 32 and 16 bits; -1 where they aren't there."""
    wanted, ending = (code >> _32).astype(np.uint32), (code >> np.uint64(16)).astype(np.uint16)
    at, out = np.searchsorted(high, wanted), np.full(len(code), -1, np.int64)
    some = np.flatnonzero(at < len(high))
    while (some := some[high[at[some]] == wanted[some]]).size:
        hit = low[at[some]] == ending[some]
        out[some[hit]] = at[some[hit]]
        some = some[~hit]
        at[some] += 1
        some = some[at[some] < len(high)]
    return out


def triple_code(contexts: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(mix(contexts) + last.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _triples(columns: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Codes, contexts, last words and summed counts of different trigrams, by code. columns: contexts, last words and counts; the list is emptied, so that each array goes when it isn't needed any more."""
    counts, last, contexts = (columns.pop() for _ in range(3))
    code = triple_code(contexts, last)
    order = code_order(code)
    code = code[order]
    head = np.ones(len(code), bool)
    head[1:] = code[1:] != code[:-1]
    total = np.add.reduceat(counts[order], np.flatnonzero(head), dtype=np.int64) if len(code) else np.zeros(0, np.int64)
    del counts
    order = order[head]
    code = code[head]
    contexts = contexts[order]
    return code, contexts, last[order], total


def _blobs(group: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows (part, keys, counts) of sorted keys; one row for each part."""
    order = by_shard(group)
    group, keys, counts = group[order], keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    edges = [*heads.tolist(), len(group)]
    cut = [(keys[a:b], counts[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return pa.RecordBatch.from_arrays([pa.array(group[heads].astype(np.int32)), pa.array([planes(k.astype("<u8")).tobytes() for k, _ in cut], pa.binary()), pa.array([planes(_narrow(n)).tobytes() for _, n in cut], pa.binary())], ["part", "keys", "counts"])


def _gathered(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The sums of all blobs of a part."""
    return summed(gathered(group.column("keys"), np.uint64), gathered(group.column("counts"), np.uint32))


BLOB = "part int, keys binary, counts binary"


def train(docs: DataFrame, text: str = "text") -> Model:
    """Counts a model over all texts of docs (null: empty). Without rows every word is unknown to it.

    Texts of any length count whole, repeated rows as often as they are there, and other columns are not looked at.

    The driver gets a few numbers for each range and shard, of which there is one for each SHARD_BYTES of text (and a range
    for four shards or fewer).
    """
    spark = docs.sparkSession
    texts = docs.select(text)
    size = texts.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(16, -(-int(size) // SHARD_BYTES))
    model = Model(shared_dir(spark, "ngrams"), 1 << max(4, (shards // 4).bit_length()), shards)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0

        def flush():
            codes, counts = np.unique(np.concatenate(kept), return_counts=True)
            return _blobs(model.range_of(codes), codes, counts)

        for batch in batches:
            for part in chunks(batch, text):
                codes, _ = tokens(part, text)
                kept.append(codes)
                n += len(codes)
                if n >= GATHER:
                    yield flush()
                    kept, n = [], 0
        if n:
            yield flush()

    def write_words(group: pa.Table) -> pa.Table:
        trim()
        codes, counts = _gathered(group)
        r = group.column("part")[0].as_py()
        put(model.folder, f"word-{r}", codes, counts.astype(np.uint32 if counts.max() < 2**32 else np.int64))
        return pa.table({"part": pa.array([r], pa.int32()), "n": [len(codes)], "total": [int(counts.sum())]})

    with scratch(spark):
        found = saved(texts.mapInArrow(count_words, BLOB).groupBy("part").applyInArrow(write_words, "part int, n long, total long"), "words").collect()
    sizes = np.zeros(model.ranges, np.int64)
    for r in found:
        sizes[r.part], model.tokens = r.n, model.tokens + r.total
    model.bases = np.concatenate([[0], np.cumsum(sizes)])
    model.words = int(model.bases[-1])
    if model.words >= 2**32 - 2:
        raise ValueError("over 2^32 different words: ids need wider keys")
    if not model.tokens:
        return model

    def find_frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (r for batch in batches for r in batch.column(0).to_pylist() if sizes[r]):
            counts = mapped(model.folder, f"word-{r}")[1]
            at = np.flatnonzero(model.ways(counts.astype(np.int64)) > 1)
            yield pa.RecordBatch.from_arrays([pa.array(at + model.bases[r]), pa.array(counts[at].astype(np.int64))], ["id", "n"])

    most = spark.range(0, model.ranges, 1, min(model.ranges, spark.sparkContext.defaultParallelism)).mapInArrow(find_frequent, "id long, n long").collect()
    most = sorted(tuple(x) for x in most) + [(model.start, model.tokens), (model.before, model.tokens)]
    model.frequent, model.times = np.array(most, np.int64).T.copy()

    def count_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0

        def flush():
            codes, bounds = joined(kept)
            first = np.zeros(len(codes), bool)
            first[bounds[:-1]] = True
            step = -(-len(codes) // -(-len(codes) // WIDEST))
            for at in range(0, len(codes), step):  # the two tokens before a part come along
                low = max(0, at - 2)
                yield rows(codes[low : at + step], first[low : at + step], at - low)

        def rows(codes: np.ndarray, first: np.ndarray, skip: int):
            contexts, last, counts = _different(model, codes, first, skip)
            shard = model.triple_shard(contexts, last, model.ways_of(contexts, model.counted))
            order = by_shard(shard)  # contexts stay in order: neighbours are alike, which compresses
            shard, contexts, last, counts = shard[order], contexts[order], last[order], counts[order]
            heads = np.flatnonzero(np.diff(shard, prepend=-1))
            edges = [*heads.tolist(), len(order)]
            cut = lambda x, kind: pa.array([planes(x[a:b].astype(kind, copy=False)).tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(shard[heads].astype(np.int32)), cut(contexts, "<u8"), cut(last, "<u4"), cut(counts, "<u4")], ["part", "contexts", "last", "counts"])

        for batch in batches:
            for part in chunks(batch, text):
                kept.append(tokens(part, text))
                n += len(kept[-1][0])
                if n >= GATHER:
                    yield from flush()
                    kept, n = [], 0
        if n:
            yield from flush()

    def write_triples(group: pa.Table) -> pa.Table:
        """Arrays of one shard. Out: its bigrams with the number of different words before them, its part of contexts that shards share, its numbers of counts 1 to 4."""
        trim()
        code, contexts, last, counts = _triples([gathered(group.column(c), kind) for c, kind in (("contexts", np.uint64), ("last", np.uint32), ("counts", np.uint32))])
        shard = group.column("part")[0].as_py()
        inner = contexts >> _32 != np.uint64(model.before)  # first tokens have no trigram
        opening = summed((np.uint64(model.start) << _32) | last[~inner], counts[~inner])
        code, contexts = code[inner], contexts[inner]
        last, counts = last[inner], counts[inner]
        over = np.flatnonzero(counts >= 255)
        arrays = [(code >> _32).astype(np.uint32), (code >> np.uint64(16)).astype(np.uint16), np.minimum(counts, 255).astype(np.uint8), np.stack([over, counts[over]])]
        del code, inner
        own, stats = _follow_sums(contexts, counts)
        kinds = [int((counts == i).sum()) for i in range(1, 5)]
        del counts
        lone = model.ways_of(own, model.counted) == 1
        put(model.folder, f"triple-{shard}", *arrays, *_context_arrays(own[lone], stats[:, lone]))
        shared, sums = own[~lone].astype(np.int64).tolist(), stats[:, ~lone].T.tolist()
        del arrays, own, stats
        contexts <<= _32
        contexts |= last
        pairs, times = _tallied(contexts)
        del contexts, last
        pairs, times = np.concatenate([pairs, opening[0]]), np.concatenate([times, opening[1]])  # the start's id is above all words'
        first, second = pairs >> _32, pairs & _LOW32
        rows = _blobs(model.shard_of(first, second, model.counted(first)), pairs, times)
        n = rows.num_rows
        none = lambda kind: pa.array([None] * (len(shared) + 1), kind)
        return pa.table({
            **{c: pa.concat_arrays([rows.column(c), none(rows.schema.field(c).type)]) for c in ("part", "keys", "counts")},
            "context": pa.array([*([None] * n), *shared, None], pa.int64()),
            "sums": pa.array([*([None] * n), *sums, kinds], pa.list_(pa.int64())),
        })

    shape = f"{BLOB}, context long, sums array<long>"
    triples = texts.mapInArrow(count_triples, "part int, contexts binary, last binary, counts binary").groupBy("part").applyInArrow(write_triples, shape)
    with scratch(spark):
        triples = saved(triples, "triples")
        pick = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(4)]
        one = triples.where("part is null and context is null").agg(*pick).first()
        model.cuts3 = discounts([one[i] or 0 for i in range(4)])
        both = triples.where("context is not null").groupBy("context").agg(*pick)

        def write_shared(group: pa.Table) -> pa.Table:
            trim()
            group = group.sort_by("context")
            own = group.column("context").to_numpy().view(np.uint64)
            order = np.argsort(own)
            put(model.folder, f"with-{group.column('home')[0].as_py()}", *_context_arrays(own[order], np.stack([group.column(f"s{i}").to_numpy() for i in range(4)])[:, order]))
            return pa.table({"n": [len(own)]})

        home = F.pmod(F.col("context"), F.lit(model.shards)).cast("int")
        shared_contexts = both.withColumn("home", home).groupBy("home").applyInArrow(write_shared, "n long").agg(F.sum("n").alias("n")).first()[0] or 0
        model.shared = int(shared_contexts)
        _count_pairs(spark, model, triples, sizes)
    return model


def joined(kept: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and offsets of several parts as those of one."""
    ends = np.cumsum([0, *(len(codes) for codes, _ in kept)])
    return np.concatenate([codes for codes, _ in kept]), np.concatenate([[0], *(bounds[1:] + at for (_, bounds), at in zip(kept, ends[:-1], strict=True))])


def _tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted (in place), and how often each is there."""
    keys.sort()
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.diff(np.append(heads, len(keys)))


def _different(model: Model, codes: np.ndarray, first: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, last words and counts of the different trigrams that end at the tokens from `skip` on, by context; first: whether a token begins a text.

    The words have numbers of 21 bits here, so that a trigram is one number and sorted as it is.
    """
    different, which = different_codes(codes)
    start, before, bits = len(different), len(different) + 1, np.uint64(21)
    key = np.concatenate([[start], which[:-1]]).astype(np.uint64)
    key[first] = start
    two = np.concatenate([[np.uint64(before)], key[:-1]])
    two[first] = before
    key = (two << bits | key) << bits | which.astype(np.uint64)
    del two, which
    key, counts = _tallied(key[skip:])
    ids, low = np.append(model.ids(different), [model.start, model.before]).astype(np.uint64), np.uint64((1 << 21) - 1)
    return ids[key >> (bits + bits)] << _32 | ids[key >> bits & low], ids[key & low].astype(np.uint32), counts


def _follow_sums(contexts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different contexts, sorted, of different trigrams; for each how often something follows, and how many words once, twice and more often."""
    own, kinds = _tallied(contexts.copy())
    some = np.flatnonzero(counts > 1)  # few: the others are once
    at, often = np.searchsorted(own, contexts[some]), counts[some]
    add = lambda at, n=None: np.bincount(at, n, len(own)).astype(np.int64)
    return own, np.stack([kinds + add(at, often - 1), kinds - add(at), add(at[often == 2]), add(at[often >= 3])])


def _context_arrays(contexts: np.ndarray, stats: np.ndarray) -> list[np.ndarray]:
    """Contexts that occur more than once, sorted, with their sums, twice: of small numbers and of large ones; the others are known from their bigrams."""
    small, out = stats.max(0) < 256 if stats.size else np.zeros(0, bool), []
    for kind, rows in ((np.uint8, small & (stats[0] > 1)), (np.uint32 if not stats.size or stats.max() < 2**32 else np.int64, ~small)):
        out += [contexts[rows], stats[:, rows].T.astype(kind)]
    return out


def _count_pairs(spark, model: Model, triples: DataFrame, sizes: np.ndarray) -> None:
    """Writes the arrays of bigrams and of words with their different predecessors."""

    def write_pairs(group: pa.Table) -> pa.Table:
        """Arrays of one shard. Out: its numbers of counts 1 to 4, contexts that other shards share, words with their different predecessors here."""
        trim()
        keys, counts = _gathered(group)
        shard = group.column("part")[0].as_py()
        over = np.flatnonzero(counts >= 255)
        first = (keys >> np.uint64(32)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        ids = first[heads]
        stats = np.stack([np.add.reduceat(x.astype(np.int64), heads) for x in (counts, counts == 1, counts == 2, counts >= 3)])
        lone = model.ways(model.counted(ids)) == 1
        sums = stats[:, lone].astype(np.uint32 if stats.max() < 2**32 else np.int64)
        put(model.folder, f"pair-{shard}", keys, np.minimum(counts, 255).astype(np.uint8), np.stack([over, counts[over]]), ids[lone].astype(np.uint32), sums)
        last, times = np.unique(keys & np.uint64(2**32 - 1), return_counts=True)
        rows = _blobs(np.searchsorted(model.bases, last.astype(np.int64), "right") - 1, last, times)
        many = ids[~lone].tolist()
        more = [None] * (len(many) + 1)
        return pa.table({
            **{c: pa.concat_arrays([rows.column(c), pa.array(more, rows.schema.field(c).type)]) for c in ("part", "keys", "counts")},
            "context": pa.array([*([None] * rows.num_rows), *many, None], pa.int64()),
            "sums": pa.array([*([None] * rows.num_rows), *stats[:, ~lone].T.tolist(), [int((counts == i).sum()) for i in range(1, 5)]], pa.list_(pa.int64())),
        })

    out = triples.where("part is not null").select("part", "keys", "counts").groupBy("part").applyInArrow(write_pairs, f"{BLOB}, context long, sums array<long>")
    out = saved(out, "pairs")
    pick = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(4)]
    one = out.where("part is null and context is null").agg(*pick).first()
    model.cuts2 = discounts([one[i] for i in range(4)])
    shared = out.where("context is not null").groupBy("context").agg(*pick).orderBy("context").collect()  # at most 4 for each shard
    put(model.folder, "shared", np.array([r[0] for r in shared], np.uint32), np.array([r[1:] for r in shared], np.int64).reshape(-1, 4).T)

    def write_before(group: pa.Table) -> pa.Table:
        trim()
        r = group.column("part")[0].as_py()
        ids, times = _gathered(group)
        all_ids = np.zeros(int(sizes[r]), np.uint32)
        all_ids[ids.astype(np.int64) - model.bases[r]] = times
        put(model.folder, f"before-{r}", all_ids)
        return pa.table({"n": [int(all_ids.sum())], "sums": pa.array([[int((all_ids == i).sum()) for i in range(1, 5)] + [int((all_ids >= 3).sum())]], pa.list_(pa.int64()))})

    kinds = out.where("part is not null").select("part", "keys", "counts").groupBy("part").applyInArrow(write_before, "n long, sums array<long>").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(5)]).first()
    model.pairs = int(kinds[0])
    cuts = discounts(kinds[1:5])
    rest = cuts[1] * kinds[1] + cuts[2] * kinds[2] + cuts[3] * kinds[5]
    model.cuts1 = np.array([rest / model.pairs, *cuts[1:]])


class Scorer:
    """Log10 probabilities of slices of texts under a model."""

    def __init__(self, model: Model):
        self.m = model

    def each_file(self, keys: np.ndarray, width: int, group: np.ndarray, names: Callable[[int], str]) -> Iterator[tuple[np.ndarray, tuple[np.ndarray, ...]]]:
        """Rows of each group and the arrays of its file. In a group rows come by the top bits of their keys (of `width` bits), so that each search begins near the last one. Groups to which nothing was dealt have no file."""
        order = near_order(keys, group, width)
        group = group[order]
        edges = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group)).tolist()
        for a, b in zip(edges, edges[1:], strict=False):
            if (arrays := mapped(self.m.folder, names(group[a]))) is not None:
                yield order[a:b], arrays

    def found(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Counts of pair keys."""
        out = np.zeros(len(keys), np.int64)
        for rows, (known, often, over, *_) in self.each_file(keys, self.m.pair_bits, shard, "pair-{}".format):
            wanted = keys[rows]
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            hit = np.flatnonzero(known[at] == wanted)
            out[rows[hit]] = _whole(often, over, at[hit])
        return out

    def contexts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For sorted different ids: how often something follows, and the probability that is left for the lower order."""
        m, sums = self.m, np.zeros((4, len(ids)), np.int64)
        home = np.where(m.ways(m.counted(ids)) > 1, m.shards, (mix(ids.astype(np.uint64)) % np.uint64(m.shards)).astype(np.int64))
        for rows, (*_, known, kept) in self.each_file(ids.astype(np.uint64), m.pair_bits - 32, home, lambda s: f"pair-{s}" if s < m.shards else "shared"):
            if len(known):
                at = np.minimum(np.searchsorted(known, ids[rows].astype(known.dtype)), len(known) - 1)
                sums[:, rows] = np.where(known[at] == ids[rows], kept[:, at], 0)
        rest = (m.cuts2[1:, None] * sums[1:]).sum(0)
        return sums[0], np.where(sums[0] > 0, rest / np.maximum(sums[0], 1), 1.0)

    def score(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, the unigram base, the model's log10 probability."""
        m = self.m
        different, which = different_codes(codes)
        ids = m.ids(different)
        known = np.flatnonzero(ids >= 0)
        counts, before = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        if m.tokens:
            counts[known], before[known] = m.by_id(ids[known])
            lower = (np.maximum(before - m.discount(m.cuts1, before), 0) / m.pairs) + m.cuts1[0] / (m.words + 1)
        else:
            lower = np.ones(len(ids))
        by_text = lambda x: np.add.reduceat(x, bounds[:-1]) if len(bounds) > 1 else np.zeros(0, x.dtype)
        known, base = by_text((counts > 0).astype(np.int64)[which]), by_text(np.log10((counts + 1) / (m.tokens + m.words + 1))[which])
        probability = lower[which]
        if m.tokens:
            ids = np.append(ids, m.start)
            prior = np.concatenate([[len(ids) - 1], which[:-1]])
            prior[bounds[:-1]] = len(ids) - 1
            at = self.pairs(ids, prior, which, bounds, probability)
            if len(at):
                contexts = ids[prior[at - 1]].astype(np.uint64) << _32 | ids[prior[at]].astype(np.uint64)
                last = ids[which[at]]
                del prior, which
                probability[at] = self.trigrams(contexts, last, probability[at])
        return known, base, by_text(np.log10(probability))

    def pairs(self, ids: np.ndarray, prior: np.ndarray, which: np.ndarray, bounds: np.ndarray, probability: np.ndarray) -> np.ndarray:
        """Makes probabilities by single words those by bigrams. Out: tokens whose two words before were counted, and so were followed by something.

        ids: of the different words here and the start; prior, which: places of each token and of what is before it among them.
        """
        m = self.m
        names = np.flatnonzero(ids >= 0)
        follow, rest = np.zeros(len(ids), np.int64), np.ones(len(ids))
        follow[names], rest[names] = self.contexts(ids[names])
        often = m.counted(ids)
        probability *= rest[prior]
        both = np.flatnonzero((follow > 0)[prior] & (ids >= 0)[which])
        first = prior[both]
        keys, shard = ids[first], ids[which[both]]
        keys, shard = keys.astype(np.uint64) << _32 | shard.astype(np.uint64), m.shard_of(keys, shard, often[first])
        n = self.found(keys, shard)
        probability[both] += np.maximum(n - m.discount(m.cuts2, n), 0) / follow[first]
        seen = np.zeros(len(which) + 1, bool)
        seen[both[n > 0] + 1] = True
        seen[bounds] = False
        return np.flatnonzero(seen)

    def trigrams(self, contexts: np.ndarray, last: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities by trigrams of words (-1: unknown) after contexts that were counted; lower: by bigrams."""
        m = self.m
        ways = m.ways_of(contexts, m.counted)
        total, left = self.follow(contexts, ways)
        out, whole = left * lower, np.flatnonzero(last >= 0)
        n = self.tripled(triple_code(contexts[whole], last[whole]), m.triple_shard(contexts[whole], last[whole], ways[whole]))
        out[whole] = np.maximum(n - m.discount(m.cuts3, n), 0) / total[whole] + out[whole]
        return out

    def tripled(self, codes: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Counts of trigrams by code."""
        out = np.zeros(len(codes), np.int64)
        for rows, (high, low, often, over, *_) in self.each_file(codes, 64, shard, "triple-{}".format):
            at = find_code(high, low, codes[rows])
            hit = np.flatnonzero(at >= 0)
            out[rows[hit]] = _whole(often, over, at[hit])
        return out

    def follow(self, contexts: np.ndarray, ways: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For contexts that were counted: how often something follows, and the probability that is left."""
        m = self.m
        total, left = np.ones(len(contexts), np.int64), np.full(len(contexts), m.cuts3[1])  # what isn't stored was followed once
        home = (mix(contexts) % np.uint64(m.shards)).astype(np.int64)
        shared = np.flatnonzero(ways > 1)
        home[shared] = m.shards + contexts[shared].view(np.int64) % m.shards
        for rows, arrays in self.each_file(contexts, m.pair_bits, home, lambda s: f"triple-{s}" if s < m.shards else f"with-{s - m.shards}"):
            wanted = contexts[rows]
            for known, kept in (arrays[-4:-2], arrays[-2:]):
                if len(known):
                    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                    hit = np.flatnonzero(known[at] == wanted)
                    often, once, twice, more = kept[at[hit]].T
                    total[rows[hit]], left[rows[hit]] = often, (m.cuts3[1] * once + m.cuts3[2] * twice + m.cuts3[3] * more) / often
        return total, left


def _whole(often: np.ndarray, over: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts at some places, kept as bytes and those from 255 on beside them."""
    counts = often[at].astype(np.int64)
    if (big := np.flatnonzero(counts == 255)).size:
        counts[big] = over[1][np.searchsorted(over[0], at[big])]
    return counts


def perplexity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs less its text, with n_tokens, n_known, train_tokens, base_score, score and perplexity.

    Every text ends with one end token, so that empty and null texts have a score too. Words never counted share what
    discounting leaves. Result columns win name clashes; repeated rows are scored alike, texts of any length whole, and an
    empty table stays empty.
    """
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    plain = without(docs, *names)
    columns = [c for c in plain.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, parts, kept, n = Scorer(model), [], [], 0

        def flush():
            codes, bounds = joined(kept)
            sizes, (known, base, own), at = np.diff(bounds), scorer.score(codes, bounds), 0
            for part, (_, own_bounds) in zip(parts, kept, strict=True):
                rows = slice(at, at := at + len(own_bounds) - 1)
                n_tokens, score = sizes[rows], own[rows]
                yield pa.RecordBatch.from_arrays([*part, pa.array(n_tokens), pa.array(known[rows]), pa.array(np.full(len(score), model.tokens)), pa.array(base[rows]), pa.array(score), pa.array(10 ** (-score / n_tokens))], [*columns, *names])

        for batch in batches:
            for part in chunks(batch, text):
                kept.append(tokens(part, text))
                parts.append([part.column(part.schema.get_field_index(c)) for c in columns])
                n += len(kept[-1][0])
                if n >= SLICE:
                    yield from flush()
                    parts, kept, n = [], [], 0
        if n:
            yield from flush()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema if f.name != text]
    return plain.mapInArrow(run, ", ".join([*fields, "n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"]))
