"""Packing by power-of-two decomposition: a document's tokens are cut into pieces whose lengths are powers of two,
longest first, and each piece is a sequence of its own in the bucket of its length. No sequence crosses documents and
none is padded."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import binary, chunks, held, runs, utf8, without
from .words import alike, words

# A sequence id holds the bucket (log2 of the length), the task and the task's count in that bucket.
BUCKET_BIT, TASK_BIT = 58, 34


def cuts(totals: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each total: pieces of `most`, then one for each binary digit of the rest. Document, start and length of all pieces."""
    digits = 1 << np.arange(most.bit_length() - 2, -1, -1)
    full, rest = totals // most, totals % most
    has = (rest[:, None] & digits) > 0
    counts = full + has.sum(1)
    doc = np.repeat(np.arange(len(totals)), counts)
    at = runs(counts)
    length = np.full(len(doc), most, np.int64)
    length[at >= full[doc]] = np.broadcast_to(digits, has.shape)[has]
    ends = np.cumsum(length)
    return doc, ends - length - np.repeat(np.cumsum(totals) - totals, counts), length


class Grown:
    """An array that grows at its end, by doubling."""

    def __init__(self, kind: type):
        self.room, self.n = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.room):
            self.room = np.concatenate([self.room[: self.n], np.zeros(max(len(self.room), len(more)), self.room.dtype)])
        self.room[self.n : self.n + len(more)] = more
        self.n += len(more)

    def __getitem__(self, at):
        return self.room[at]


class WordTokenizer:
    """Ids of a tokenizer whose tokens never reach over white space: every different word is encoded once.

    Words met before come from a cache that is emptied at `most` words; a word is known by its code, and its bytes are
    compared with those of the word in the cache. New ones are encoded many at a time, in one text, with a mark between
    them whose single id shows where each word's ids end; words that hold the mark, as they are or normalised, and words
    that hold a name of a special token ('<|endoftext|>', whose id the library gives by default) go alone.
    """

    MARK = "`"

    def __init__(self, path: str, most: int = 1_500_000):
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        self.inner.no_padding()
        self.inner.no_truncation()
        mark = self.inner.encode(self.MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.special = [x.content for x in self.inner.get_added_tokens_decoder().values()]
        self.special_start = {x[0] for x in self.special}
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.codes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted; a dict of a million words takes ten times the memory
        self.flat, self.heads, self.counts = Grown(np.uint32), Grown(np.int64), Grown(np.int32)
        self.body, self.at, self.size = Grown(np.uint8), Grown(np.int64), Grown(np.int32)

    def apart(self, word: str) -> bool:
        """Whether a word holds a special token, or the mark, also only after normalisation (U+1FEF becomes the mark)."""
        if self.mark is None or self.MARK in word or (not self.special_start.isdisjoint(word) and any(x in word for x in self.special)):
            return True
        return not word.isascii() and not is_normalized("NFC", word) and (self.inner.normalizer is None or self.MARK in self.inner.normalizer.normalize_str(word))

    def each(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, one after another, and how many each has."""
        made = [x.ids for x in self.inner.encode_batch_fast(found, add_special_tokens=False)]
        return np.array(list(itertools.chain.from_iterable(made)), np.uint32), np.array([len(x) for x in made], np.int64)

    def together(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As each, of words without the mark, encoded as one text."""
        ids, _ = self.each([" ".join(f"{w} {self.MARK}" for w in found)])
        ends = np.flatnonzero(ids == self.mark)
        if len(ends) != len(found):  # marks that don't tell the words apart are not relied on
            return self.each(found)
        return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1

    def new(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some words, and how many each has."""
        whole = "\n".join(found)
        plain = whole.isascii() and self.mark is not None and not any(x in whole for x in [self.MARK, *self.special])
        alone = np.zeros(len(found), bool) if plain else np.array([self.apart(w) for w in found], bool)
        rest = [w for w, x in zip(found, alone, strict=True) if not x]
        made = [self.each([found[i] for i in np.flatnonzero(alone)]), *(self.together(rest[at : at + 4096]) for at in range(0, len(rest), 4096))]
        counts = np.zeros(len(found), np.int64)
        counts[alone], counts[~alone] = made[0][1], np.concatenate([np.zeros(0, np.int64), *(c for _, c in made[1:])])
        ids, own = np.zeros(counts.sum(), np.uint32), np.repeat(alone, counts)
        ids[own], ids[~own] = made[0][0], np.concatenate([np.zeros(0, np.uint32), *(x for x, _ in made[1:])])
        return ids, counts

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Places of words in the cache by their codes; -1 for new ones."""
        if not len(self.codes):
            return np.full(len(codes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.slots[at], -1).astype(np.int64)

    def add(self, codes: np.ndarray, places: np.ndarray) -> None:
        """Makes new codes known; of words with the same code the first is found."""
        more, first = np.unique(codes, return_index=True)
        at = np.searchsorted(self.codes, more)
        self.codes, self.slots = np.insert(self.codes, at, more), np.insert(self.slots, at, places[first].astype(np.int32))

    def keep(self, ids: np.ndarray, counts: np.ndarray, body: np.ndarray, size: np.ndarray) -> None:
        """Takes words, with their ids and bytes, into the cache's arrays."""
        self.heads.add(self.flat.n + np.cumsum(counts) - counts)
        self.at.add(self.body.n + np.cumsum(size) - size)
        for held, more in ((self.flat, ids), (self.counts, counts), (self.body, body), (self.size, size)):
            held.add(more)

    def same(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Whether words have the bytes of the cached ones."""
        out = size == self.size[known]
        some = np.flatnonzero(out)
        inside = runs(size[some])
        differ = data[np.repeat(starts[some], size[some]) + inside] != self.body[np.repeat(self.at[known[some]], size[some]) + inside]
        out[np.repeat(some, size[some])[differ]] = False
        return out

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, stops, bounds = words(data, ends)
        if not len(starts):
            return np.zeros(0, np.uint32), bounds
        codes, where, which = alike(data, starts, stops)
        first, size = starts[where], (stops - starts)[where]
        if self.counts.n + len(codes) > self.most:
            self.clear()
        known = self.find(codes)
        hit = np.flatnonzero(known >= 0)
        known[hit[~self.same(data, first[hit], size[hit], known[hit])]] = -2  # another word has this code: encoded each time
        if len(miss := np.flatnonzero(known < 0)):
            raw, new = data.tobytes(), known[miss] == -1
            found = [raw[a : a + n] for a, n in zip(first[miss].tolist(), size[miss].tolist(), strict=True)]
            ids, counts = self.new([x.decode() for x in found])
            known[miss] = self.counts.n + np.arange(len(miss))
            self.add(codes[miss[new]], known[miss[new]])
            self.keep(ids, counts, np.frombuffer(b"".join(found), np.uint8), size[miss])
        own = known[which]
        each = self.counts[own]
        return self.flat[np.repeat(self.heads[own], each) + runs(each)], np.concatenate([[0], np.cumsum(each)])[bounds]


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker, so that its cache serves all tasks there, until the worker is used by another operator."""
    held("packing", word_tokenizer.cache_clear)
    return WordTokenizer(path)


def pack(docs: DataFrame, path: str, end_id: int = 2, most: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents: key, start, length, ids (packed little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document's ids are the tokenizer's for its text (null: empty) and then `end_id`, so that every row, also an
    empty one, has a piece. Repeated rows and null keys are documents like others, very long texts are encoded whole, and
    other columns are not looked at. An empty table gives no pieces. `most` must be a power of two.
    Sequence ids are unique; those of a bucket lie between bucket << 58 and (bucket + 1) << 58. Nothing is shuffled.
    """
    if most & (most - 1):
        raise ValueError("most must be a power of two")
    if key in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset"):
        raise ValueError(f"the key can't be called {key}, as a column of the result is")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        tokenizer, made = word_tokenizer(path), np.zeros(most.bit_length(), np.int64)
        for batch in batches:
            for part in chunks(batch, text, keep="packing"):
                ids, bounds = tokenizer.encode(*utf8(part.column(part.schema.get_field_index(text))))
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                totals = np.diff(bounds) + 1
                doc, start, length = cuts(totals, most)
                bucket = np.log2(length).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                tally = np.bincount(bucket, minlength=len(made))
                nth = np.empty(len(bucket), np.int64)
                nth[order] = runs(tally) + np.repeat(made, tally)
                made += tally
                numbers = (bucket << BUCKET_BIT) | (task << TASK_BIT) | nth
                packed = binary(ids.view(np.uint8), np.concatenate([[0], np.cumsum(length)]) * 4)
                keys = part.column(part.schema.get_field_index(key)).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([keys, pa.array(start), pa.array(length), packed, pa.array(totals[doc]), pa.array(numbers), pa.array(np.zeros(len(doc), np.int64))], [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder for each length, so that a reader makes batches of equal sequences."""
    pieces.write.partitionBy("length").parquet(path)
