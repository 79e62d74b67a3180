"""Vector operators against brute force."""

import numpy as np

from skyloom.llm import pivots, postings
from skyloom.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def table(spark):
    rng = np.random.default_rng(0)
    hubs = rng.normal(size=(12, 16))
    rows = [hubs[i % 12] + rng.normal(size=16) * (0.1 if i % 3 else 1.0) for i in range(400)]
    rows += [rows[0]] * 30 + [np.zeros(16)]
    data = [(i, [float(x) for x in r], 0, "x") for i, r in enumerate(rows)]
    data += [(1000, None, 0, "x"), (1001, [float("nan")] * 16, 0, "x"), (1002, [None] + [1.0] * 15, 0, "x"), (1003, [1.0, 2.0], 0, "x"), (None, data[0][1], 0, "x"), (5, data[5][1], 0, "x"), (1004, [float("inf")] * 16, 0, "x"), (1005, [2 * x for x in data[7][1]], 0, "x")]
    return data, spark.createDataFrame(data, SCHEMA).repartition(3)


def usable(data):
    good = [(k, v) for k, v, *_ in data if k is not None and v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    return [k for k, _ in good], np.array([v for _, v in good], np.float32).astype(np.float64)


def test_near_duplicates_find_nearly_all_links_and_no_others(spark):
    data, df = table(spark)
    keys, x = usable(data)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    got = pivots.near_duplicates(df).collect()
    assert len(got) == len(data)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None}
    want = {}
    for k, n in zip(keys, linked.sum(1), strict=True):
        want[k] = max(int(n), want.get(k, 0))
    assert all(found[k][0] <= n for k, n in want.items()) and sum(found[k][0] for k in want) >= 0.9 * sum(want.values())
    assert all(found[k] == (0, k, True) for k in (430, 1000, 1001, 1002, 1003, 1004))
    assert [tuple(r)[1:] for r in got if r.vec_id is None] == [(0, None, False)]
    whole = pivots.near_duplicates(df, pivots.Settings(depth=64, per_root=3, recall=1.0)).collect()  # all pivots: no pair can be missed
    assert {r.vec_id: r.n_links for r in whole if r.vec_id in want} == want
    assert pivots.near_duplicates(df.where("false")).count() == 0


def test_links_at_the_threshold_are_found_among_many_pivots(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x, side, many = (rng.normal(size=(n, 64)) for n in (400, 400, 8000))
    x, many = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, many))
    side -= (side * x).sum(1)[:, None] * x
    y = 0.902 * x + (1 - 0.902**2) ** 0.5 * side / np.linalg.norm(side, axis=1, keepdims=True)
    monkeypatch.setattr(pivots, "reference_points", lambda *_: many)
    rows = [(i, [float(c) for c in v], 0, "x") for i, v in enumerate(np.concatenate([x, y]))]
    got = {r.vec_id: (r.n_links, r.component_id) for r in pivots.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(got[i] == (1, i) and got[400 + i] == (1, i) for i in range(400)) >= 0.9 * 400


def test_candidates_share_pivots_by_their_order():
    near = np.array([[5, 3, 9], [5, 9, 3], [9, 1, 7], [2, 4, 6]])
    got = pivots.counted(near, near, np.unique(near))
    assert got[0].tolist() == [14, 9 + 2 + 2, 1 * 3, 0] and got[1, 2] == 2 * 3 and (got == got.T).all()
    rng = np.random.default_rng(2)
    x, p = rng.normal(size=(300, 24)), rng.normal(size=(40, 24))
    x, p = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, p))
    orders = pivots.nearest(x, p, 7)
    assert (orders == np.argsort(-(x @ p.T), axis=1, kind="stable")[:, :7]).all()
    plan = pivots.plan_for(x, p, pivots.Settings())
    assert plan.listed <= plan.depth and plan.least > 1


def test_blocks_of_a_crowded_list_count_every_link_once(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.ones(16) + rng.normal(size=16) * 0.02], 0, "x") for i in range(300)]
    got = pivots.near_duplicates(spark.createDataFrame(rows, SCHEMA), pivots.Settings(block=32, group_rows=100)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(299, 0)}


def test_search_is_nearly_brute_force(spark):
    data, df = table(spark)
    keys, x = usable(data)
    norm = np.linalg.norm(x, axis=1)
    score = (x @ x.T) / norm[:, None] / norm[None, :]
    asked = df.where("vec_id % 10 = 0")
    got = {}
    for r in postings.search(df, asked).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = total = 0
    for i, k in enumerate(keys):
        if k % 10 or k == 5:
            continue
        best = sorted({(-round(score[i, j], 9), keys[j]) for j in range(len(keys)) if keys[j] != k})[:5]
        mine = sorted(got[k])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5] and all(abs(s - score[i, keys.index(v)]) < 1e-12 for _, v, s in mine)
        hits += sum(abs(-b[0] - m[2]) < 1e-6 for b, m in zip(best, mine, strict=True))
        total += 5
    assert hits >= 0.9 * total and not {430, 1000, None} & set(got)
    assert postings.search(df.where("false"), asked).count() == 0 == postings.search(df, df.where("false")).count()
    assert sorted(r.vec_id for r in postings.search(df.where("vec_id in (1, 2, 3)"), df.where("vec_id = 1")).collect()) == [2, 3]


def test_queries_of_another_length_take_no_part(spark):
    rng = np.random.default_rng(3)
    index = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=16)]) for i in range(300)], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(1000 + i, [float(v) for v in rng.normal(size=3)]) for i in range(40)], "vec_id long, embedding array<double>")
    assert postings.search(index, asked).count() == 0
    both = postings.search(index, asked.unionByName(index.where("vec_id < 5")))
    assert {r.query_id for r in both.collect()} == set(range(5)) and both.count() == 25


def test_scores_of_doubles_are_those_of_doubles(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8)) + 1e-9 * rng.normal(size=(60, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    for r in postings.search(df, df.where("vec_id % 20 = 0")).collect():
        a, b = x[r.query_id], x[r.vec_id]
        assert abs(r.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-15


def test_lists_are_divided_again_where_the_graph_is_full(spark):
    rng = np.random.default_rng(5)
    hubs = rng.normal(size=(40, 16))
    x = np.stack([hubs[i % 40] + rng.normal(size=16) * 0.4 for i in range(3000)])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(np.float32).astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    got, hits = {}, 0
    small = postings.Settings(least_lists=4, most_lists=8, list_rows=32, share=500, block=64)
    for r in postings.search(df, df.where("vec_id % 50 = 0"), small).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    for q in range(0, 3000, 50):
        best = [i for i in np.argsort(-(u @ u[q]), kind="stable") if i != q][:5]
        hits += len(got[q] & set(best))
        assert len(got[q]) == 5
    assert hits >= 0.9 * 300


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (103, 103), (50, 60), (60, 55), (200, 50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(41)}) == 1 and got[100] == got[101] and len({got[i] for i in (50, 60, 55, 200)}) == 1 and 103 not in got and len(set(got.values())) == 3
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
