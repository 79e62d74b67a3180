"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its lower-cased words without marks around them, and their first 4, 5 and 6 bytes, each hashed to
a slot. The machine adds a weight for each slot that occurs and, for every pair of slots, the product of their factors:
what single words don't say (an insult near the mention of a group) it learns from pairs. No term is dropped for telling
nothing alone: weights are pulled to zero by an absolute penalty (follow the regularised leader), which only terms that
go on telling something overcome, and factors by a square one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import chunks, utf8, without
from .words import Coder, words

PREFIXES = (4, 5, 6)


@dataclass(frozen=True)
class Settings:
    """most_rows bounds the labelled sample that one task fits; the smallest hashes of the keys are taken.

    A slot has a weight if it occurs in least_rows rows, and factors if it does in factor_rows: fewer rows hold no pair
    often enough. A row of label 1 weighs as much as the other label's share asks for, lean at most; sparse, in units of
    that weight, is what a slot's summed slope must exceed for its weight to differ from zero.
    """

    most_rows: int = 16_000
    slot_bits: int = 18
    factors: int = 4
    least_rows: int = 3
    factor_rows: int = 30
    epochs: int = 12
    batch: int = 128
    rate: float = 1.0
    sparse: float = 5.0
    factor_rate: float = 0.03
    shrink: float = 1e-3
    start: float = 0.005
    lean: float = 8.0
    seed: int = 11


@dataclass
class Model:
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    slots: int


_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def terms(part: pa.RecordBatch, text: str, bits: int, useful: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, slot) of every different term of each text, sorted; `useful` marks the slots that count."""
    data, ends = utf8(part.column(part.schema.get_field_index(text)))
    starts, stops, bounds = words(data, ends)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(bounds))
    for _ in range(3):  # marks before and after the word
        starts = starts + (_MARK[data[starts]] & (stops - starts > 1))
        stops = stops - (_MARK[data[stops - 1]] & (stops - starts > 1))
    coder, made = Coder(data), []
    for n in (None, *PREFIXES):
        long = slice(None) if n is None else np.flatnonzero(stops - starts > n)
        a = starts[long]
        codes = coder.code(a, stops[long] if n is None else a + n) ^ np.uint64(n or 0)
        slot = (codes >> np.uint64(64 - bits)).astype(np.int64)
        if useful is not None:
            keep = useful[slot]
            slot, owner = slot[keep], doc[long][keep]
        else:
            owner = doc[long]
        made.append((owner << bits) | slot)
    keys = np.unique(np.concatenate(made))
    return keys >> bits, keys & ((1 << bits) - 1)


def raw_scores(model: Model, doc: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
    out = model.bias + np.bincount(doc, model.weight[slot], n)
    for f in model.factor:
        v = f[slot]
        out += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
    return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_sample(label: np.ndarray, slots: list[np.ndarray], s: Settings) -> Model:
    """Weights by FTRL-proximal and factors by AdaGrad, on logistic loss over sparse rows in a fixed order."""
    size, rng = 1 << s.slot_bits, np.random.default_rng(s.seed)
    seen = np.bincount(np.concatenate(slots) if slots else np.zeros(0, np.int64), minlength=size)
    names = np.flatnonzero(seen >= s.least_rows)
    place = np.full(size, -1, np.int64)
    place[names] = np.arange(len(names))
    rows = [place[x[seen[x] >= s.least_rows]] for x in slots]
    paired = seen[names] >= s.factor_rows
    share = np.clip(label.mean() if len(label) else 0.0, 1e-3, 1 - 1e-3)
    lean = float(np.clip((1 - share) / share, 1, s.lean))
    bias, gb = float(np.log(share / (1 - share))), 1e-2
    w, pull, square = np.zeros(len(names)), np.zeros(len(names)), np.zeros(len(names))
    v = rng.normal(0, s.start, (s.factors, len(names))) * paired
    gv = np.full(v.shape, 1e-2)
    for _ in range(s.epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), s.batch):
            some = order[at : at + s.batch]
            slot, doc = np.concatenate([rows[i] for i in some]), np.repeat(np.arange(len(some)), [len(rows[i]) for i in some])
            touched, where = np.unique(slot, return_inverse=True)
            vs = v[:, slot]
            sums = np.stack([np.bincount(doc, x, len(some)) for x in vs])
            x = bias + np.bincount(doc, w[slot], len(some)) + 0.5 * (sums**2).sum(0) - 0.5 * np.bincount(doc, (vs * vs).sum(0), len(some))
            slope = (logistic(x) - label[some]) * np.where(label[some] > 0, lean, 1.0)
            each = slope[doc]
            g = np.bincount(where, each, len(touched))
            root, more = np.sqrt(square[touched]), np.sqrt(square[touched] + g * g)
            pull[touched] += g - (more - root) / s.rate * w[touched]
            square[touched] += g * g
            z = pull[touched]
            w[touched] = np.where(np.abs(z) <= s.sparse * lean, 0.0, -(z - np.sign(z) * s.sparse * lean) * s.rate / (1 + more))
            for f in range(s.factors):
                g = (np.bincount(where, each * (sums[f][doc] - vs[f]), len(touched)) / len(some) + s.shrink * v[f, touched]) * paired[touched]
                gv[f, touched] += g * g
                v[f, touched] -= s.factor_rate * g / np.sqrt(gv[f, touched])
            step = slope.mean()
            gb += step * step
            bias -= 0.2 * step / np.sqrt(gb)
    weight, factor = np.zeros(size, np.float32), np.zeros((s.factors, size), np.float32)
    weight[names], factor[:, names] = w, v
    return Model(bias, weight, factor, size)


def fit(labelled: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", label: str = "label") -> Model:
    """A model of rows (key, text, label 0 or 1). Null labels are left out; without rows every score is the prior's.

    The sample has most_rows rows at most, those with the smallest hashes of their keys, and one task fits it: texts are
    cut into terms where they are, and only their slots, as many as a text has different terms, go there. Null texts are
    empty, very long ones whole, repeated rows count each time. What goes to the driver is the model, whose size the
    settings fix.
    """
    s = settings
    rows = labelled.where(f"{label} is not null").select(F.xxhash64(key).alias("_hash"), F.xxhash64(text).alias("_tie"), F.col(label).cast("double").alias("_label"), text)

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                doc, slot = terms(part, text, s.slot_bits)
                edges = np.searchsorted(doc, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(slot.astype(np.int32)))], ["_hash", "_tie", "_label", "slots"])

    some = rows.mapInArrow(collect, "_hash long, _tie long, _label double, slots array<int>").orderBy("_hash", "_label", "_tie").limit(s.most_rows)

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_hash", "ascending"), ("_label", "ascending"), ("_tie", "ascending")])
        lists = group.column("slots").combine_chunks()
        flat, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
        m = fit_sample(group.column("_label").to_numpy(), [flat[a:b].astype(np.int64) for a, b in zip(edges, edges[1:], strict=False)], s)
        used = np.flatnonzero((m.weight != 0) | (m.factor != 0).any(0))
        return pa.table({"bias": [m.bias], "slot": [used.astype(np.int32).tobytes()], "weight": [m.weight[used].tobytes()], "factor": [m.factor[:, used].tobytes()]})

    found = some.groupBy(F.lit(0).alias("_all")).applyInArrow(learn, "bias double, slot binary, weight binary, factor binary").collect()
    size = 1 << s.slot_bits
    model = Model(-1.0, np.zeros(size, np.float32), np.zeros((s.factors, size), np.float32), size)
    for r in found:
        used = np.frombuffer(r.slot, np.int32)
        model.bias, model.weight[used] = r.bias, np.frombuffer(r.weight, np.float32)
        model.factor[:, used] = np.frombuffer(r.factor, np.float32).reshape(s.factors, -1)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """docs with `score`, 0 to 1, from the whole text, however long; null and empty texts get the score of no terms.

    Repeated rows are scored alike, an empty table gives an empty result, and a column of docs called as the score gives way.
    """
    plain, sent = without(docs, name), docs.sparkSession.sparkContext.broadcast(model)
    bits = model.slots.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        useful = (m.weight != 0) | (m.factor != 0).any(0)
        for batch in batches:
            for part in chunks(batch, text):
                doc, slot = terms(part, text, bits, useful)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(logistic(raw_scores(m, doc, slot, part.num_rows)))], [*part.schema.names, name])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema]
    return plain.mapInArrow(run, ", ".join([*fields, f"{name} double"]))
