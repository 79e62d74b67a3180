"""Text operators against brute force on small tables that hold every odd case."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.llm import bpe, kneser_ney, packing, queries, repeats, setsketch, sharding, shared, toxicity
from skyloom.llm import words as text_words
from skyloom.llm.words import Coder, alike, codes_at, loads, shingles, window_codes, words

BPE, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
BASE = "the quick brown fox jumps over the lazy dog while seven wizards quietly brew a potion of great power and little taste near the old stone bridge at dawn before anyone else in the village wakes up to see it"
ODD = [
    None, "", " ", "\n\t ", "a", "A b", BASE, BASE, BASE.upper(), BASE.replace("lazy", "idle"), "x" * 5000, "ab " * 700, f"intro {BASE} outro", f"{BASE} {BASE}",
    "don't we'll 'tis ''s O'Neil's it's'll", "naïve café ñandú  　x ", "日本語のテキスト 123 ½ ٣", "é 🙂👩‍👩‍👧 \x1c\x1f\x00", "  lead\n\n\ntrail  \n", "` tick ` `", "<|endoftext|>", "1234567 a1b2 __init__!!",
]


def table(spark, texts=ODD, extra=True):
    rows = [(i, t, "clash", i * 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, n_bytes int") if rows else spark.createDataFrame([], "doc_id long, text string, shard string, n_bytes int")
    return df.repartition(3) if extra else df


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aZ1 '\n\t.sdmtlrve é日½\x1c")), max_size=24), min_size=1, max_size=4))
def test_boundaries_are_those_of_the_pattern(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([0] + [len(t.encode()) for t in texts])
    found = bpe.Encoder(BPE).pieces(data, ends).tolist()
    want = [int(e) + len(t[: m.start()].encode()) for t, e in zip(texts, ends, strict=False) for m in regex.finditer(public_tokenizers.PATTERN, t)]
    assert found == want


def test_bpe_is_what_the_library_gives_and_decodes(spark):
    import tiktoken

    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(BPE), special_tokens={})
    got = bpe.decode(bpe.encode(table(spark), BPE), BPE).collect()
    assert len(got) == len(ODD)
    for r in got:
        text = ODD[r.doc_id] or ""
        ids = own.encode_ordinary(text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == text.encode() and r.shard == "clash"
        at = np.frombuffer(r.offsets, "<u4").tolist()
        assert at == np.cumsum([0] + [len(own.decode_single_token_bytes(i)) for i in ids])[:-1].tolist()
    assert bpe.decode(bpe.encode(table(spark, []), BPE), BPE).count() == 0


def test_shards_are_even_whole_and_the_same_for_any_split(spark):
    df = table(spark, ODD * 20, extra=False).unionByName(spark.createDataFrame([(None, "copy", None, 1)] * 300 + [(5, ODD[5], "clash", 10)] * 40, "doc_id long, text string, shard string, n_bytes int"))
    got = sharding.shard(df, shards=7, bucket_bytes=2000).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.doc_id, r.text) for r in df.collect())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    where = Counter((r.doc_id, r.text, r.shard, r.slot) for r in got)
    for parts in (1, 5):  # the same places however the rows are split and ordered
        again = sharding.read_shards(df.orderBy(F.rand(3)).repartition(parts), shards=7, bucket_bytes=2000)
        assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in again.collect()) == where
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in sharding.shard(df, shards=7, seed=18, bucket_bytes=2000).collect()) != where
    assert max(Counter((r.shard, r.doc_id) for r in got if r.doc_id is None).values()) < 80  # copies are scattered
    assert sharding.shard(table(spark, [], False)).count() == 0
    starts = {r._bucket: r._start for r in sharding.starts_of(spark.range(10000).selectExpr("cast(id as int) as _bucket", "id % 7 as _n")).collect()}
    assert starts == {i: int(x) for i, x in enumerate(np.cumsum([i % 7 for i in range(10000)]) - np.array([i % 7 for i in range(10000)]))}


def test_written_shards_hold_slots_in_order(spark, tmp_path):
    sharding.write_shards(sharding.shard(table(spark, ODD * 9), shards=3, bucket_bytes=4000), f"file://{tmp_path}/out")
    for folder in (tmp_path / "out").glob("shard=*"):
        for file in folder.glob("*.parquet"):
            slots = spark.read.parquet(f"file://{file}").select("slot").toPandas()["slot"].tolist()
            assert slots == sorted(slots)


def test_pieces_are_powers_of_two_and_hold_all_ids(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    rows = packing.pack(table(spark, [*ODD, "word " * 9000]), WORDS).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0 for r in rows)
    for i, text in enumerate([*ODD, "word " * 9000]):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        want = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist() == want
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist() and {r.doc_tokens for r in own} == {len(want)}
    assert packing.pack(table(spark, []), WORDS).count() == 0
    doc, start, length = packing.cuts(np.array([1, 4096, 4097, 10000]), 4096)
    assert [list(length[doc == d]) for d in range(4)] == [[1], [4096], [4096, 1], [4096, 4096, 1024, 512, 256, 16]] and list(start[doc == 3])[-1] == 9984


def test_buckets_hold_sequences_of_one_length(spark, tmp_path):
    packing.write_buckets(packing.pack(table(spark), WORDS), f"file://{tmp_path}/buckets")
    back = spark.read.parquet(f"file://{tmp_path}/buckets")
    assert back.where("octet_length(ids) <> 4 * length").count() == 0 and {f"length={r.length}" for r in back.select("length").distinct().collect()} == {p.name for p in (tmp_path / "buckets").glob("length=*")}


def test_a_word_that_normalises_to_the_mark_leaves_other_words_their_ids(spark):
    from tokenizers import Tokenizer

    t, own = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS)
    texts = ["some plain words", "a\u1fefb \u1fef \u1fef\u1fef", "other plain words", "cafe\u0301 \u0300 \u212b", "`\u1fef", "last words of all"]
    for part in (texts, ["words that are new afterwards", "a\u1fefb and \u1fefmore", "the end"]):
        data = "".join(part).encode()
        ids, bounds = own.encode(np.frombuffer(data, np.uint8), np.cumsum([0] + [len(x.encode()) for x in part]))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [t.encode(x, add_special_tokens=False).ids for x in part]
    own.apart = lambda word: False  # marks that can't be trusted are noticed
    own.clear()
    ids, counts = own.new(["a", "a\u1fefb", "b"])
    assert ids.tolist() == [x for w in ("a", "a\u1fefb", "b") for x in t.encode(w, add_special_tokens=False).ids] and counts.tolist() == [1, 3, 1]


def test_names_of_special_tokens_get_the_ids_that_the_library_gives_by_default():
    from tokenizers import Tokenizer

    plain, own = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS)
    texts = ["x <|endoftext|> y", "a<|startoftext|>b c", "x <|endoftext> y", "<|endoftext|><|endoftext|>", "plain words", "` <|ENDOFTEXT|> `"]
    data = "".join(texts).encode()
    ids, bounds = own.encode(np.frombuffer(data, np.uint8), np.cumsum([0] + [len(x.encode()) for x in texts]))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [plain.encode(x, add_special_tokens=False).ids for x in texts]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [512, 2048])
def test_words_whose_polynomials_modulo_powers_of_two_are_equal_stay_apart(n):
    word = thue_morse(n)
    other = word.translate({97: "b", 98: "a"})
    data = np.frombuffer((word + " " + other).encode(), np.uint8)
    starts, stops, _ = words(data, np.array([0, len(data)]))
    assert len(set(Coder(data).code(starts, stops).tolist())) == 2
    codes, first, which = alike(data, starts, stops)
    assert len(codes) == 2 and which.tolist() in ([0, 1], [1, 0])


def test_equal_codes_of_different_words_are_noticed(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(Coder, "code", lambda self, a, b: (np.asarray(b) - np.asarray(a)).astype(np.uint64))  # words of one length collide
    plain, own, bpe_own = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS), bpe.Encoder(BPE)
    import tiktoken

    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(BPE), special_tokens={})
    for text in ("the cat saw dogs and hens, the end of it all", "abcdefghij abcdefghik and the abcdefghij", "not one new tea"):
        data = np.frombuffer(text.encode(), np.uint8)
        ends = np.array([0, len(data)])
        assert own.encode(data, ends)[0].tolist() == plain.encode(text, add_special_tokens=False).ids
        assert bpe_own.encode(data, ends)[0].tolist() == theirs.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=300), st.integers(1, 120))
def test_codes_of_windows_are_equal_where_their_bytes_are(raw, width):
    data = np.frombuffer(raw * 2, np.uint8)
    at = np.arange(max(0, len(data) - width + 1))
    whole = [data[i : i + width].tobytes() for i in at]
    kinds = [window_codes(data, width), Coder(data, lower=False).code(at, at + width)] + ([codes_at(loads(data), at, width)] if width >= 8 else [])
    for codes in kinds:
        assert len(codes) == len(at) and len(set(zip(codes.tolist(), whole, strict=True))) == len(set(codes.tolist())) == len(set(whole))


def test_codes_of_very_long_runs_come_from_their_parts(monkeypatch):
    monkeypatch.setattr(text_words, "LONGEST", 50)
    data = np.frombuffer(b"x" + b"abcdefg" * 40 + b"y" + b"abcdefg" * 40 + b"z", np.uint8)
    one, two, three = Coder(data).code(np.array([1, 282, 282]), np.array([281, 562, 563]))
    assert one == two != three


def kneser_ney_of(train):
    """Counts, and the probability of a word after two others, by the formula: trigrams, bigrams by what stands before them, words likewise."""
    c1, c3, first = Counter(), Counter(), Counter()
    for t in train:
        w = [*split(t), None]
        c1.update(w)
        first[w[0]] += 1
        c3.update(zip(["<s>", *w], w, w[1:], strict=False))
    c2 = Counter((v, x) for _, v, x in c3)
    c2.update({("<s>", x): n for x, n in first.items()})
    before = Counter(w for _, w in c2)

    def cuts(counts):
        n = Counter(counts)
        return kneser_ney.discounts([n[1], n[2], n[3], n[4]])

    d1, d2, d3 = (cuts(c.values()) for c in (before, c2, c3))
    rest = sum(d1[min(n, 3)] for n in before.values()) / len(c2)
    follow2, left2, follow3, left3 = Counter(), Counter(), Counter(), Counter()
    for (v, _), n in c2.items():
        follow2[v] += n
        left2[v] += d2[min(n, 3)]
    for (u, v, _), n in c3.items():
        follow3[u, v] += n
        left3[u, v] += d3[min(n, 3)]

    def probability(u, v, x):
        p = max(before[x] - d1[min(before[x], 3)], 0) / len(c2) + rest / (len(c1) + 1)
        if follow2[v]:
            p = max(c2[v, x] - d2[min(c2[v, x], 3)], 0) / follow2[v] + left2[v] / follow2[v] * p
        if follow3[u, v]:
            p = max(c3[u, v, x] - d3[min(c3[u, v, x], 3)], 0) / follow3[u, v] + left3[u, v] / follow3[u, v] * p
        return p

    return c1, probability


@pytest.mark.parametrize("dealt", [False, True])
def test_kneser_ney_is_the_formula(spark, monkeypatch, dealt):
    texts = ODD + [BASE.replace("dog", w) for w in ("cat", "owl", "cat")] + ["the end of the world " * 60, "the end of it"] * 3
    train, other = texts[::2], texts
    if dealt:  # even contexts that are not frequent go to several shards
        monkeypatch.setattr(kneser_ney.Model, "ways_of", lambda self, contexts, counts: (contexts % np.uint64(3) + np.uint64(1)).astype(np.int64))
    model = kneser_ney.train(table(spark, train))
    got = {r.doc_id: r for r in kneser_ney.perplexity(table(spark, other), model).collect()}
    c1, probability = kneser_ney_of(train)
    total, kinds = sum(c1.values()), len(c1)
    for i, t in enumerate(other):
        w = [*split(t), None]
        score = sum(math.log10(probability(u, v, x)) for u, v, x in zip([None, "<s>", *w], ["<s>", *w], w, strict=False))
        base = sum(math.log10((c1[x] + 1) / (total + kinds + 1)) for x in w)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in c1 for x in w), total)
        assert math.isclose(r.score, score, rel_tol=1e-9) and math.isclose(r.base_score, base, rel_tol=1e-9)
    for u, v in (("<s>", "the"), ("of", "the"), ("x" * 5000, "x" * 5000), ("never-seen", "the"), ("the", "never-seen")):
        assert math.isclose(sum(probability(u, v, x) for x in [*c1, "never-seen"]), 1, rel_tol=1e-9)  # all that can follow sums to one
    if not dealt:
        nothing = kneser_ney.perplexity(table(spark, ODD), kneser_ney.train(table(spark, [])))
        assert nothing.where("n_known > 0 or score is null").count() == 0 and nothing.count() == len(ODD)
        assert kneser_ney.perplexity(table(spark, []), model).count() == 0


def brute_cut(rows, length):
    """rows: (key, text), keys may repeat or be null."""
    first, out = {}, []
    for k, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            if k is not None:
                w = b[s : s + length]
                first[w] = min(first.get(w, k), k)
    for k, t in rows:
        b = (t or "").encode()
        gone, seen = np.zeros(len(b), bool), set()
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen or (k is not None and first[w] < k):
                gone[s : s + length] = True
            seen.add(w)
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone]), int(gone.sum())))
    return out


@pytest.mark.parametrize("length", [100, 40])
def test_repeats_are_those_of_brute_force(spark, length):
    rng = np.random.default_rng(1)
    noise = ["".join(rng.choice(list("abcdé \n"), int(n))) for n in rng.integers(0, 900, 30)]
    texts = [*ODD, *noise, *(a[:300] + b[-200:] for a, b in zip(noise, noise[1:], strict=False)), "abcde" * 60 + noise[0], "abcde" * 45, "ab" * 400, "ab" * 55]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, noise[1]), (None, noise[2]), (None, noise[2]), (5, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeats.without_repeats(df, length)
    found = Counter((r.doc_id, r.text, bytes(r.kept), sum(x.stop - x.start for x in r.spans), r.n_bytes) for r in got.collect())
    want = Counter((k, t, kept, n, len((t or "").encode())) for (k, t), (kept, n) in zip(rows, brute_cut(rows, length), strict=True))
    assert found == want
    assert repeats.without_repeats(table(spark, [])).count() == 0
    whole = repeats.without_repeats(df, length, whole_characters=True).where("decode(kept, 'utf-8') like '%�%'")
    assert whole.count() == 0


def test_rows_without_a_key_or_with_one_key_meet_only_their_own_finds(spark, monkeypatch):
    kind, read = type(spark.range(0)), []
    rng = np.random.default_rng(7)
    noise = ["".join(rng.choice(list("abcdefgh \n"), 400)) for _ in range(60)]
    rows = [(None, noise[i % 7] + noise[i]) for i in range(60)] + [(5, noise[i % 5] + noise[i]) for i in range(60)] + [(i, noise[i] + noise[i + 1] + noise[i % 7]) for i in range(40)] + [(5, noise[3] + noise[8])] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    with monkeypatch.context() as m:
        m.setattr(kind, "mapInArrow", lambda self, *a, f=kind.mapInArrow, **b: (read.append((self.count(), self.where("key is null").count() if "key" in self.columns else 0)), f(self, *a, **b))[1])
        got = repeats.without_repeats(df).collect()
    want = [(k, t, *x) for (k, t), x in zip(rows, brute_cut(rows, 100), strict=True)]
    assert Counter((r.doc_id, r.text, bytes(r.kept), sum(x.stop - x.start for x in r.spans)) for r in got) == Counter(want)
    assert len(read) == 4 and max(n for n, _ in read) == len(rows)  # counted while the operator's intermediates are there
    assert all(without_key == 0 for _, without_key in read[:3])


def brute_groups(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = split(t)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_are_those_of_brute_force(spark, k, percent):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(400)]
    base = list(rng.choice(vocabulary, 150))
    texts = list(ODD)
    for edits in [1, 1, 2, 2, 3, 4, 5, 6, 8] * 5:  # chains of copies on both sides of the threshold
        copy = list(base)
        for at in rng.choice(len(base), edits, replace=False):
            copy[at] = f"new{rng.integers(1 << 30)}"
        texts.append(" ".join(copy))
    texts += [" ".join(rng.choice(vocabulary, 60)) for _ in range(40)] + texts[25:30]
    rows = list(enumerate(texts))
    got = setsketch.near_duplicates(table(spark, texts), setsketch.Settings(shingle=k, percent=percent)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_groups(rows, k, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)
    assert setsketch.near_duplicates(table(spark, [])).count() == 0


def test_near_duplicates_with_odd_keys(spark):
    df = spark.createDataFrame([(1, BASE), (1, BASE), (None, BASE), (2, BASE), (3, None), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in setsketch.near_duplicates(df).collect())
    assert got == [("1", 1, True), ("1", 1, True), ("2", 1, False), ("3", 3, True), ("None", None, False), ("None", None, False)]
    assert setsketch.one_of_each(df).count() == 5


def test_rows_with_one_key_and_several_texts_link_by_each(spark):
    """Groups of several components whose documents hold more than one text."""
    rng = np.random.default_rng(21)
    base = list(rng.choice([f"w{i}" for i in range(400)], 150))

    def copy(edits):
        words_ = list(base)
        for at in rng.choice(len(base), edits, replace=False):
            words_[at] = f"new{rng.integers(1 << 30)}"
        return " ".join(words_)

    rows = [(i % 25, copy(int(rng.integers(1, 9)))) for i in range(50)] + [(60 + i, " ".join(rng.choice([f"v{j}" for j in range(300)], 50))) for i in range(5)]
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), setsketch.Settings(shingle=3, percent=85)).collect()
    sets, up = {}, {k: k for k, _ in rows}
    for n, (k, t) in enumerate(rows):
        w = split(t)
        sets[n] = (k, {tuple(w[j : j + 3]) for j in range(len(w) - 2)})

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, a in sets.values():
        for m, b in sets.values():
            if 100 * len(a & b) >= 85 * len(a | b):
                x, y = top(k), top(m)
                up[max(x, y)] = min(x, y)
    assert {(r.doc_id, r.component_id) for r in got} == {(k, top(k)) for k in up} and len(got) == len(rows)


def test_sketches_merge_and_estimate():
    s = setsketch.Settings(registers=256)
    maker, rng = setsketch.Sketcher(s), np.random.default_rng(3)
    a, b = (np.unique(rng.integers(0, 2**63, 3000, dtype=np.uint64)) for _ in range(2))
    assert (np.maximum(maker.registers(a), maker.registers(b)) == maker.registers(np.union1d(a, b))).all()
    c = np.concatenate([a[:2400], b[:600]])
    x, y, true = maker.registers(a), maker.registers(c), 2400 / 3600
    found = setsketch.estimate(np.array([3000.0]), np.array([3000.0]), np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([(x == y).sum()]), s.base)[0]
    assert abs(found - true) < 0.12


def test_shingles_of_short_texts_hold_all_words():
    def codes(t, k=5):
        data = np.frombuffer(t.encode(), np.uint8)
        a, b, bounds = words(data, np.array([0, len(data)]))
        return shingles(Coder(data).code(a, b), bounds, k)[0].tolist()

    assert codes("a b c") == codes("A  b\nC") and codes("a b c") != codes("a b d") != codes("a b") and codes("") == [] and len(codes("a b c d e f")) == 2


def test_toxicity_learns_words_and_pairs(spark):
    rng = np.random.default_rng(4)
    plain = [f"w{i}" for i in range(200)]

    def text(*extra):
        return " ".join([*rng.choice(plain, 30), *extra])

    rows = [(i, text("scumbag"), 1) for i in range(150)] + [(200 + i, text("folks", "vermin"), 1) for i in range(150)]
    rows += [(400 + i, text("folks") if i % 2 else text("vermin"), 0) for i in range(400)] + [(900 + i, text(), 0) for i in range(400)] + [(2000, None, 0), (2001, "", None)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.fit(labelled, toxicity.Settings(most_rows=5000, epochs=40))
    fresh = [text("scumbag") for _ in range(20)] + [text("folks", "vermin") for _ in range(20)] + [text("folks") for _ in range(20)] + [text("vermin") for _ in range(20)] + [None, ""]
    got = {r.doc_id: r.score for r in toxicity.score(table(spark, fresh), model).collect()}
    mean = lambda a, b: np.mean([got[i] for i in range(a, b)])
    assert mean(0, 20) > 0.8 and mean(20, 40) > 0.7 and mean(40, 60) < 0.4 and mean(60, 80) < 0.4 and got[80] == got[81] < 0.5
    assert toxicity.score(table(spark, []), model).count() == 0
    prior = toxicity.score(table(spark), toxicity.fit(labelled.where("false")))
    assert prior.select(F.countDistinct("score")).first()[0] == 1 and prior.count() == len(ODD)


def test_the_machine_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(8)
    model = toxicity.Model(-0.3, rng.normal(size=50).astype(np.float32), rng.normal(size=(3, 50)).astype(np.float32), 50)
    texts = [sorted(rng.choice(50, n, replace=False)) for n in (0, 1, 2, 7, 20)]
    doc, slot = np.repeat(np.arange(5), [len(t) for t in texts]), np.array([x for t in texts for x in t], np.int64)
    want = [model.bias + sum(model.weight[i] for i in t) + sum(float(model.factor[:, i] @ model.factor[:, j]) for a, i in enumerate(t) for j in t[a + 1 :]) for t in texts]
    assert np.allclose(toxicity.raw_scores(model, doc, slot, 5), want, rtol=1e-5, atol=1e-5)


def test_pairs_that_tell_nothing_alone_are_learned():
    rng = np.random.default_rng(9)
    both = rng.integers(0, 2, (6000, 2))
    label = (both[:, 0] == both[:, 1]).astype(float)  # neither term has a share that differs between the labels
    rows = [np.array([3, *([7] if a else []), *([9] if b else [])], np.int64) for a, b in both]
    model = toxicity.fit_sample(label[:4000], rows[:4000], toxicity.Settings(slot_bits=5))
    doc, slot = np.repeat(np.arange(2000), [len(x) for x in rows[4000:]]), np.concatenate(rows[4000:])
    score = toxicity.raw_scores(model, doc, slot, 2000)
    assert score[label[4000:] == 1].min() > score[label[4000:] == 0].max()


def test_held_out_toxic_documents_are_told_from_others(spark):
    got = queries.op6_toxicity(spark, "/root/testdata/sf0.1").where("held_out").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("toxic is not null").select("score", "toxic", "predicted").toPandas()
    rank = got.score.rank()
    ones = got.toxic == 1
    area = (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert area > 0.97 and got.predicted[ones].mean() > 0.7 and got.predicted[~ones].mean() < 0.01


def test_crc_of_text_is_that_of_the_contract(spark):
    from skyloom.llm.queries import remainder

    got = spark.createDataFrame([(7,), (None,)], "doc_id long").select("doc_id", remainder("doc_id", 7).alias("r")).collect()
    assert {r.doc_id: r.r for r in got} == {7: zlib.crc32(b"7") % 7, None: None} and hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_a_worker_lets_go_of_the_words_it_keeps_for_packing():
    path = queries.vocabulary("word_bpe_49k.json")
    batch = pa.RecordBatch.from_arrays([pa.array(["one two", None])], ["text"])
    list(shared.chunks(batch, "text", keep="packing"))
    kept = packing.word_tokenizer(path)
    list(shared.chunks(batch, "text", keep="packing"))
    assert packing.word_tokenizer(path) is kept
    list(shared.chunks(batch, "text"))
    assert packing.word_tokenizer(path) is not kept
    shared.let_go()


def test_ways_of_contexts_are_looked_up_part_by_part(monkeypatch):
    model, most = kneser_ney.Model("", 16, 16, tokens=1000), []
    contexts = np.arange(1, 1001, dtype=np.uint64) << np.uint64(32) | np.arange(1000, 0, -1).astype(np.uint64)

    def counts(ids):
        most.append(len(ids))
        return ids

    whole = model.ways_of(contexts, counts)
    most.clear()
    monkeypatch.setattr(kneser_ney, "PART", 64)
    assert model.ways_of(contexts, counts).tolist() == whole.tolist() and max(most) <= 128
