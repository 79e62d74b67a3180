"""Product codes, collocations and main texts against brute force, with odd rows, and the queries against their SQL."""

import hashlib
import html as markup
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from skyloom.llm import extract, phrases, queries, walsh
from skyloom.llm.pages import LABELLED

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_walsh", "op12_phrases"])
def test_queries_are_as_their_sql(spark, name):
    got = queries.QUERIES[name](spark, DATA)
    c = duckdb.connect(config={"temp_directory": ""})
    for table in ("embeddings", "documents"):
        c.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    found = c.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(found.fetchall())


# --- product codes
def brute_codes(rows, s):
    """(codebooks, {row: (code, error)}) by plain Python integers; rows: (key, vector)."""
    ints = [[math.floor(s.scale * x) for x in v] for _, v in rows]
    wide = len(ints[0]) // s.parts
    cut = [[v[p * wide : (p + 1) * wide] for p in range(s.parts)] for v in ints]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, ints[i]))[: s.entries]
    books = [[list(cut[i][p]) for i in first] for p in range(s.parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    best = lambda p, x: min(range(len(books[p])), key=lambda e: (far(x, books[p][e]), e))
    for _ in range(s.rounds):
        chosen = [[best(p, v[p]) for p in range(s.parts)] for v in cut]
        for p in range(s.parts):
            for e in range(len(first)):
                mine = [v[p] for v, c in zip(cut, chosen, strict=True) if c[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    out = []
    for v in cut:
        c = [best(p, v[p]) for p in range(s.parts)]
        out.append(("".join(f"{e:02x}" for e in c), sum(far(v[p], books[p][c[p]]) for p in range(s.parts))))
    return books, out


def test_codes_are_those_of_brute_force(spark):
    rng = np.random.default_rng(3)
    for dims, s in ((12, walsh.Settings(parts=4, entries=5, rounds=2)), (10, walsh.Settings(parts=2, entries=7, rounds=3, scale=16)), (6, walsh.Settings(parts=6, entries=200))):
        vectors = [[round(float(x), 2) for x in rng.normal(size=dims)] for _ in range(40)] + [[0.0] * dims] * 3 + [[1e5] * dims, [-1e5] * dims]
        rows = [(i * 3 if i != 7 else None, v, None if i % 4 == 0 else f"l{i % 3}") for i, v in enumerate(vectors)] + [(3, vectors[0], "l1"), (3, vectors[1], "l1")]
        odd = [(900, None, "a"), (901, [None] + [1.0] * (dims - 1), "a"), (902, [float("nan")] * dims, "a"), (903, [float("inf")] * dims, "a"), (904, [], "a"), (905, [1.0], "a"), (906, [1e12] * dims, "a")]
        df = spark.createDataFrame([(*r, i, 0) for i, r in enumerate(rows + odd)], "vec_id long, embedding array<double>, label string, code long, error int").repartition(3)
        coded = walsh.encode(df, s)
        books, want = brute_codes([(k, v) for k, v, _ in rows], s)
        assert coded.books.tolist() == books
        assert walsh.digest(coded.books) == hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        sums = defaultdict(int)
        for (_, _, label), (_, error) in zip(rows, want, strict=True):
            sums[label] += error
        got = Counter((r.key, r.label, r.code, r.error, r.label_error) for r in walsh.with_label_errors(coded).collect())
        assert got == Counter((k, label, code, error, sums[label]) for (k, _, label), (code, error) in zip(rows, want, strict=True))


def test_coefficients_hold_distances_and_no_tie_is_lost():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 4, 5, 8, 13, 16):
        x, e = rng.integers(-9, 9, (300, n)), rng.integers(-9, 9, (20, n))
        e[11] = e[3]
        near, far = walsh.nearest(walsh.sequency(walsh.padded(x)), walsh.sequency(walsh.padded(e)))
        want = ((x[:, None] - e[None]) ** 2).sum(2)
        assert (near == want.argmin(1)).all() and (far == want.min(1) * walsh.padded(x).shape[1]).all()
    changes = [(np.diff(row) != 0).sum() for row in walsh.sequency(np.eye(8, dtype=int)).T]
    assert changes == list(range(8))


def test_tables_without_vectors_and_parts_that_do_not_fit(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert walsh.with_label_errors(walsh.encode(df)).count() == 0 and walsh.digest(walsh.encode(df).books) == hashlib.sha256(b"").hexdigest()
    three = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], df.schema)
    with pytest.raises(ValueError):
        walsh.encode(three)
    with pytest.raises(ValueError):
        walsh.encode(three, walsh.Settings(parts=3, entries=257))


# --- collocations
def brute_phrases(rows, s):
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, s.most + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {g: a for g, a in counts.items() if len(g) > 1 and a >= s.least}
        found = []
        for g, a in candidates.items():
            if any(len(o) > len(g) and 100 * b >= s.share * a and any(o[i : i + len(g)] == g for i in range(len(o) - len(g) + 1)) for o, b in candidates.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(found)[: s.top])]
    return sorted(out)


SOME = ["of the", "the cat", "New York", "new york City", "é à", "x", "日本 語", "a\x00b", "thewordthatislongerthansixteenbytes again", "U V"]


def talk(n, seed):
    rng = np.random.default_rng(seed)
    return "".join(str(rng.choice(SOME)) + str(rng.choice([" ", "  ", "\t", ". ", ", ", "\n", "\x0b", "! ", " "], p=[0.4, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05])) for _ in range(n))


@pytest.mark.parametrize("s", [phrases.Settings(least=3, top=9), phrases.Settings(least=2, share=80), phrases.Settings(most=2, least=2), phrases.Settings(least=2, paths=5, ids=40, filter_bits=1 << 12)])
def test_collocations_are_those_of_brute_force(spark, s):
    rows = [(talk(60, i), ["en", "fr", None, "und", ""][i % 5]) for i in range(30)] + [(None, "en"), ("", None), (" \t\n", "en"), ("one", "xx"), ("of the cat of the cat", "yy")] + [(talk(60, 0), "en")] * 3
    df = spark.createDataFrame([(i, t, g, -1, "p") for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string").repartition(3)
    assert sorted(tuple(r) for r in phrases.collocations(df, s).collect()) == brute_phrases(rows, s)
    assert phrases.collocations(df.where("false"), s).count() == 0


def test_a_text_of_more_than_a_chunk_and_lengths_that_do_not_exist(spark):
    long = talk(120_000, 5)
    assert len(long.encode()) > 1 << 20
    rows, s = [(long, "en"), ("of the cat", "en")], phrases.Settings(least=50, top=20, ids=1000)
    assert sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, "text string, lang string"), s).collect()) == brute_phrases(rows, s)
    with pytest.raises(ValueError):
        phrases.collocations(spark.createDataFrame(rows, "text string, lang string"), phrases.Settings(most=4))


def test_tries_count_burst_and_spill_in_order():
    rng = np.random.default_rng(6)
    trie, want, runs = phrases.HatTrie(burst=16), Counter(), []
    for _ in range(40):
        w = [rng.zipf(1.4, 90).clip(1, 4000).astype(np.uint64) for _ in range(3)]
        path = (w[0] << np.uint64(42)) | (w[1] << np.uint64(21)) | w[2]
        want.update(path.tolist())
        trie.add(*np.unique(path, return_counts=True))
        if len(trie) > 300:
            runs += list(trie.spill(150))
            assert len(trie) <= 150
    assert len(trie.containers) > 8 and (np.diff(trie.lows.astype(np.int64)) > 0).all()
    runs += list(trie.spill(0))
    got = Counter()
    for keys, counts in runs:
        assert (keys[1:] > keys[:-1]).all()
        got.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    assert got == want and len(trie) == 0


# --- main texts
def test_pages_of_the_data(spark):
    got = queries.QUERIES["op13_extract"](spark, DATA).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(markup.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert (r.text, r.n_chars) == ((text := "\n".join(x for x in parts if x)), len(text))


def test_the_tree_knows_its_table_and_keeps_to_it():
    tree = extract.learned()
    right = [(tree.predict(extract.features(extract.blocks(h))), np.array([c == "+" for c in k])) for h, k in LABELLED]
    assert np.concatenate([a == b for a, b in right]).mean() > 0.97
    assert set(tree.feature[tree.feature >= 0]) > {extract.FEATURES.index("words"), extract.FEATURES.index("words_after")}


def test_blocks_of_odd_pages():
    words = lambda n: " ".join(["word"] * n)
    text = lambda h: extract.main_texts([h], extract.learned())[0]
    assert text("<article><p>x &lt;b&gt;&nbsp; y&#x41;</p><script>bad</script>tail<article>") == "x <b> yA\ntail"
    assert text('<article><p title="a > b">one</p><!-- <p>no</p> --><p>two <b>bold<br>end</p></article>') == "one\ntwo bold end"
    assert text("<article><p>a < b, 5 <6 and <3</p>") == "a < b, 5 <6 and <3"
    assert text('<article><p>kept</p><p class="x>odd</p><p>after</p></article>') == "kept\nodd\nafter"
    assert text("<article><p>kept</p><!-- never closed <p>no</p>") == "kept" == text("<article><p>kept</p><script>never closed <p>no</p>")
    assert text(f"<div class=sidebar><p>{words(80)}</p></div><div class=content><p>Hi.</p><div class=comments><p>{words(70)}</p></div></div><footer>{words(60)}</footer>") == "Hi."
    assert text(f"<header><p>{words(50)}</p></header><article><header><h1>Title</h1></header><p>Be.</p></article><form><p>{words(30)}</p></form>") == "Title\nBe."
    assert text(f"<p>{words(60)}</p>") == words(60) and text("") == "" == text("<nav>x</nav>") and text("<<<>>") == text("<")
    assert text("<article>" + "<p>a\n  b</p>" * 50_000) == "\n".join(["a b"] * 50_000)  # long, and never closed


def test_pages_that_are_null_empty_or_have_columns_of_these_names(spark):
    rows = [(1, None, "u", 5), (2, "", "u", 5), (3, "<article><p>Yes.</p></article>", None, 5), (3, "<article><p>Yes.</p></article>", None, 5)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string, _html int")
    got = Counter((r.page_id, r.html, r.text, r.n_chars, r._html) for r in extract.extract(df).collect())
    assert got == Counter({(1, None, "", 0, 5): 1, (2, "", "", 0, 5): 1, (3, rows[2][1], "Yes.", 4, 5): 2})
    assert extract.extract(df.where("false")).count() == 0
    assert extract.extract(df.select("page_id", "html").withColumnRenamed("html", "text"), html="text").where("n_chars = 4").count() == 2
