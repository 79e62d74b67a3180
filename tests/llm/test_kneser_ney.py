"""The language model's arrays and slices: few files, opened once; parts of texts that give what whole ones do."""

import os

import numpy as np
import pyarrow as pa
import pytest
from test_text import BASE, ODD, table

from skyloom.llm import arrays, kneser_ney
from skyloom.llm.shared import local_path


def test_arrays_of_a_file_come_back_mapped(tmp_path):
    kept = [np.arange(7, dtype=np.uint16), np.zeros((0, 4), np.uint8), np.arange(8).reshape(2, 4).T, np.zeros(0, np.uint64)]
    arrays.put(f"file://{tmp_path}", "some", *kept)
    for a, b in zip(kept, arrays.mapped(f"file://{tmp_path}", "some"), strict=True):
        assert a.dtype == b.dtype and a.shape == b.shape and (a == b).all() and not b.flags.writeable
    assert arrays.mapped(f"file://{tmp_path}", "none") is None and os.listdir(tmp_path) == ["some"]


@pytest.mark.parametrize("low", [1, 2**12, 2**64 - 1])
def test_codes_are_in_order_whatever_their_low_bits(low):
    codes = np.random.default_rng(low % 7).integers(0, 2**64 - 1, 5000, np.uint64) & ~np.uint64(low) if low < 2**64 - 1 else np.arange(5000, dtype=np.uint64)[::-1].copy()
    codes[::3] = codes[7] + np.uint64(1)
    codes[1::50] = codes[7]
    assert (codes[arrays.code_order(codes)] == np.sort(codes)).all()
    for a, b in zip(arrays.different_codes(codes), np.unique(codes, return_inverse=True), strict=True):
        assert a.tolist() == b.tolist()
    group = (codes % np.uint64(5)).astype(np.int64)
    order = arrays.near_order(codes, group)
    assert sorted(order.tolist()) == list(range(5000)) and (np.diff(group[order]) >= 0).all()
    assert not len(arrays.near_order(codes[:0], group[:0])) and not len(arrays.code_order(codes[:0]))


def test_files_of_many_shards_are_opened_once(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 400)
    texts = [" ".join(f"w{(i * i + j * j * 7) % 1009}" for j in range(200)) for i in range(120)]
    model = kneser_ney.train(table(spark, texts))
    assert model.shards > 250 and len(os.listdir(local_path(model.folder))) <= 3 * model.shards + 2 * model.ranges
    scorer, (codes, bounds) = kneser_ney.Scorer(model), kneser_ney.tokens(pa.record_batch({"text": texts}), "text")
    first, opened = scorer.score(codes, bounds), arrays._map.cache_info().misses
    again = scorer.score(codes, bounds)
    assert arrays._map.cache_info().misses == opened and all((a == b).all() for a, b in zip(first, again, strict=True))


def test_parts_give_what_whole_texts_do(spark, monkeypatch):
    texts = ODD + [BASE.replace("dog", w) for w in ("cat", "owl", "cat")] + ["the end of the world " * 60, "the end of it"] * 3

    def scores():
        model = kneser_ney.train(table(spark, texts[::2]))
        return {r.doc_id: r for r in kneser_ney.perplexity(table(spark, texts), model).collect()}

    whole = scores()
    for name, most in (("GATHER", 50), ("WIDEST", 16), ("SLICE", 40)):
        monkeypatch.setattr(kneser_ney, name, most)
    assert scores() == whole
