"""Every registered query over a small folder of tables, each column of its contract against brute force."""

import glob
import hashlib
import math
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_text import BASE, BPE, ODD, WORDS, brute_cut, brute_groups, kneser_ney_of, split, thue_morse

from skyloom.llm import bpe, queries

WORD = thue_morse(512)
rng = np.random.default_rng(12)
VOCABULARY = [f"word{i}" for i in range(300)]
TEXTS = [*ODD, WORD, WORD.translate({97: "b", 98: "a"}), "x " + WORD, *(" ".join(rng.choice(VOCABULARY, 80)) for _ in range(12))]
TEXTS += [TEXTS[-1], TEXTS[-1].replace(" ", "\n", 3) + " more", TEXTS[-2][:300] + " tail", "word " * 6000, BASE + " " + TEXTS[-3]]


def sha(b):
    return hashlib.sha256(b).hexdigest()


def crc(key):
    return zlib.crc32(str(key).encode())


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("tables")
    n = len(TEXTS)
    ids = [7 * i + 3 for i in range(n)]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(TEXTS, pa.string()), "lang": ["en"] * n, "source": ["s"] * n, "n_chars": pa.array([len(t or "") for t in TEXTS], pa.int64())}), out / "documents.parquet", row_group_size=9)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "quality": pa.array([1] * n, pa.int32()), "toxic": pa.array([i % 3 == 0 for i in range(n)]).cast(pa.int32())}), out / "labels.parquet")
    hubs = rng.normal(size=(9, 16))
    vectors = [[float(v) for v in hubs[i % 9] + rng.normal(size=16) * (0.1 if i % 4 else 1)] for i in range(250)] + [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [1.0, 2.0], [None] + [1.0] * 15]
    vectors += [vectors[0], vectors[3]]
    pq.write_table(pa.table({"vec_id": pa.array(range(len(vectors)), pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())), "label": pa.array([0] * len(vectors), pa.int32())}), out / "embeddings.parquet")
    chats = [(1, 0, "user", "hi <b>"), (1, 1, "assistant", "yes\\"), (1, 2, "user", None), (2, 0, "system", "s"), (2, 1, "assistant", None), (2, 2, "assistant", "</turn>\n<turn:x>\n"), (3, 0, "user", "alone")]
    pq.write_table(pa.table({"conv_id": pa.array([c[0] for c in chats], pa.int64()), "turn": pa.array([c[1] for c in chats], pa.int32()), "role": [c[2] for c in chats], "text": pa.array([c[3] for c in chats], pa.string())}), out / "conversations.parquet")
    return str(out), dict(zip(ids, TEXTS, strict=True)), vectors, chats


def rows(spark, name, folder):
    got = queries.QUERIES[name](spark, f"file://{folder[0]}").collect()
    return got


def test_op1(spark, folder):
    got = {r.conv_id: r for r in rows(spark, "op1_chat", folder)}
    said = r"\### Assistant: </turn> ok"
    for conv in (1, 2, 3, -7):
        turns = [(r, t or "") for c, _, r, t in folder[3] if c == conv] if conv > 0 else [("user", said), ("assistant", said)]
        learnt, r = "".join(t for x, t in turns if x == "assistant"), got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), sha("".join(f"{x}\n{t}\n" for x, t in turns).encode()), len(learnt), sha(learnt.encode()))
    assert len(got) == 4


def test_op2(spark, folder):
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(BPE), special_tokens={})
    got = rows(spark, "op2_bpe", folder)
    assert sorted(r.doc_id for r in got) == sorted(folder[1])
    for r in got:
        text = folder[1][r.doc_id] or ""
        ids = own.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode()))


def test_op3(spark, folder):
    got = rows(spark, "op3_sharding", folder)
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in folder[1].items())
    places = Counter(r.shard for r in got)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)} and set(places) <= set(range(16)) and max(places.values()) - min(places[s] for s in range(16)) <= 1
    assert sorted((r.shard, r.slot) for r in got) == [(s, i) for s in range(16) for i in range(places[s])]


def test_op4(spark, folder):
    got = {r.doc_id: r for r in rows(spark, "op4_kneser_ney", folder)}
    counts, probability = kneser_ney_of([t for k, t in folder[1].items() if crc(k) % 7 != 2])
    total, kinds = sum(counts.values()), len(counts)
    for k, t in folder[1].items():
        w, r = [*split(t), None], got[k]
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(k) % 7 == 2, len(w), sum(x in counts for x in w), total) and math.isclose(r.base_score, base, rel_tol=1e-9)
        score = sum(math.log10(probability(u, v, x)) for u, v, x in zip([None, "<s>", *w], ["<s>", *w], w, strict=False))
        assert math.isclose(r.score, score, rel_tol=1e-9)


def test_op5(spark, folder):
    docs = sorted(folder[1].items())
    want = {k: (len((t or "").encode()), n, sha(kept)) for (k, t), (kept, n) in zip(docs, brute_cut(docs, 100), strict=True)}
    got = rows(spark, "op5_repeats", folder)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in got} == want and len(got) == len(docs)
    assert sum(r.n_removed for r in got) > 0 and all((r.n_spans > 0) == (r.n_removed > 0) for r in got)


def test_op6(spark, folder):
    got = rows(spark, "op6_toxicity", folder)
    assert sorted(r.doc_id for r in got) == sorted(folder[1])
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)


def test_op7(spark, folder):
    from tokenizers import Tokenizer

    t, found = Tokenizer.from_file(WORDS), {}
    got = rows(spark, "op7_packing", folder)
    for r in got:
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == set(folder[1]) and len({r.sequence_id for r in got}) == len(got)
    for k, text in folder[1].items():
        ids, at = [*t.encode(text or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(found[k], key=lambda r: r.start):
            own = np.array(ids[r.start : r.start + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.offset, r.ids_crc32) == (at, len(ids), 0, zlib.crc32(own.tobytes())) and r.length & (r.length - 1) == 0 and r.length <= 4096
            at += r.length
        assert at == len(ids)


def usable(folder):
    good = [(k, v) for k, v in enumerate(folder[2]) if v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.array([v for _, v in good], np.float32).astype(np.float64)
    return [k for k, _ in good], x / np.linalg.norm(x, axis=1, keepdims=True)


def test_op8(spark, folder):
    keys, u = usable(folder)
    score = u @ u.T
    got, hits, total = {}, 0, 0
    for r in rows(spark, "op8_postings", folder):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {k for k in keys if k % 50 == 0}
    for q, found in got.items():
        i = keys.index(q)
        best = sorted(((-round(score[i, j], 12), k) for j, k in enumerate(keys) if k != q))[:5]
        assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5] and all(abs(s - score[i, keys.index(v)]) < 1e-12 for _, v, s in found)
        hits += len({k for _, k in best} & {v for _, v, _ in found})
        total += 5
    assert hits >= 0.9 * total


def test_op9(spark, folder):
    keys, u = usable(folder)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    got = {r.vec_id: r for r in rows(spark, "op9_pivots", folder)}
    assert set(got) == set(range(len(folder[2])))
    n = dict(zip(keys, linked.sum(1).tolist(), strict=True))
    assert all(r.n_links <= n.get(k, 0) for k, r in got.items()) and sum(r.n_links for r in got.values()) >= 0.9 * sum(n.values())
    assert all(r.kept == (r.component_id == k) and (k in n or r.component_id == k) for k, r in got.items())


def test_op10(spark, folder):
    got = rows(spark, "op10_setsketch", folder)
    want = brute_groups(list(folder[1].items()), 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and sum(not r.kept for r in got) > 1


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_says_the_same(spark, name):
    """On the smallest given tables, where the indexes lose nothing."""
    data, c = "/root/testdata/sf0.001", duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        c.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = queries.QUERIES[name](spark, data)
    cursor = c.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(tuple(r[x] for x in columns) for r in df.collect()) == Counter(cursor.fetchall())


def test_nothing_stays_but_results(spark):
    """What operators write on the way is gone when they return, and the session's settings are as before."""
    from urllib.parse import urlparse

    from skyloom.llm import setsketch
    from skyloom.llm.shared import CLEAN_UP

    shared = urlparse(spark.sparkContext.getConf().get("spark.checkpoint.dir")).path
    before, setting = set(os.listdir(shared)), spark.conf.get(CLEAN_UP, None)
    got = setsketch.near_duplicates(spark.createDataFrame([(1, BASE), (2, BASE)], "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 1}
    assert len(set(os.listdir(shared)) - before) == 1 and spark.conf.get(CLEAN_UP, None) == setting
