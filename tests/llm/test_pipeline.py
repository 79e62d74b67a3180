"""Each stage of the pipeline against brute force on its own input."""

import re

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest

from skyloom.llm import toxicity
from skyloom.llm.queries import toxicity_model

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    own = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 90")
    odd = [(9000, None), (9001, ""), (9002, "scum idiot moron trash pathetic loser"), (9003, "é" * 90), (9004, "xé" + "é" * 89)]
    more = spark.createDataFrame([(i, t, None, "src", None) for i, t in odd], own.schema)
    return own.unionByName(more).repartition(3).cache()


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "packing"]


def test_toxic_documents_go_and_others_stay(spark, docs):
    kept = corpus_pipeline.drop_toxic(spark, docs, DATA)
    assert kept.columns == docs.columns
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity_model(spark, DATA)).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s < 0.7}


def test_one_document_of_each_group_stays(spark, docs):
    sets, up = {}, {}
    for i, r in rows_of(docs).items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        up[i] = i

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, DATA)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in up if top(i) == i}


def test_repeated_strings_go_and_documents_stay(spark, docs):
    got, seen = rows_of(corpus_pipeline.cut_repeats(spark, docs, DATA)), set()
    assert set(got) == set(rows_of(docs))
    for i, r in sorted(rows_of(docs).items()):
        b = (r.text or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                gone[s : s + 100] = True
            seen.add(b[s : s + 100])
        want, at = [], 0
        for c in r.text or "":
            n = len(c.encode())
            if not gone[at : at + n].all():
                want.append(c)
            at += n
        assert got[i].text == (None if r.text is None else "".join(want))
        assert got[i].n_chars == (len(want) if gone.any() else r.n_chars)


def test_pieces_hold_the_ids_of_the_texts(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {}
    for r in corpus_pipeline.pack(spark, docs, DATA).collect():
        found.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for i, r in rows_of(docs).items():
        assert [x for _, ids in sorted(found[i]) for x in ids] == [*t.encode(r.text or "", add_special_tokens=False).ids, 2]


ODD_ROWS = [(1, "é" * 90, "s", 5, "a", [1], "k", 7), (1, "é" * 90, "s", 5, "a", [1], "k", 7), (2, "é" * 90 + "end", "s", None, None, None, None, None), (None, "é" * 90, "t", 1, "b", [], "", 0), (3, None, None, None, "c", None, "z", 1), (4, "", "s", 0, "d", [2], "y", 2), (5, "long word " * 30000, "s", 9, "e", [3], "x", 3)]
ODD_SCHEMA = "doc_id long, text string, source string, n_bytes int, score string, spans array<int>, kept string, _cover int"


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_leave_other_columns_alone(spark, stage):
    """Clashing names, no n_chars, repeated rows, null keys, a very long text, and no rows at all."""
    docs = spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)
    got = stage(spark, docs, DATA)
    assert got.columns == docs.columns and got.schema.simpleString() == docs.schema.simpleString()
    others = [tuple(r)[2:] for r in got.collect()]
    assert all(o in [r[2:] for r in ODD_ROWS] for o in others) and len(others) >= 5
    empty = stage(spark, docs.where("false"), DATA)
    assert empty.columns == docs.columns and empty.count() == 0


def test_packing_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)
    got = corpus_pipeline.pack(spark, docs, DATA)
    per = {}
    for r in got.collect():
        per[r.doc_id] = per.get(r.doc_id, 0) + r.length
    assert set(per) == {1, 2, None, 3, 4, 5} and per[3] == per[4] == 1 and per[5] == 2 * 30000 + 1
    assert corpus_pipeline.pack(spark, docs.where("false"), DATA).count() == 0


def test_the_whole_pipeline_over_given_tables(spark):
    got = corpus_pipeline.run(spark, DATA)
    kept = {r.doc_id for r in got.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, DATA)
    assert kept == {r.doc_id for r in docs.collect()} and 0 < len(kept) < 200
