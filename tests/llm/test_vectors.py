"""Embedding near-dedup and exact top-k search against brute force."""

import math

import numpy as np
import pytest

from areapanel.llm import embed_dedup, topk

SCHEMA = "vec_id long, label int, embedding array<float>, n_links int, score string"


def vectors(seed=1, n=120, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((6, dim))
    rows = []
    for i in range(n):
        x = base[i % 6] + rng.standard_normal(dim) * rng.choice([0.02, 0.06, 1.0])
        rows.append((i, int(i % 2), [float(v) for v in np.float32(x)], 1, "x"))
    rows += [(n, 0, rows[0][2], 1, "x"), (n + 1, 0, rows[0][2], 1, "x"), (n + 2, None, rows[0][2], 1, "x"), (n + 3, 0, None, 1, "x"), (n + 4, 0, [0.0] * dim, 1, "x")]
    rows += [(n + 5, 0, [math.nan] * dim, 1, "x"), (n + 6, 0, [None, *rows[0][2][1:]], 1, "x"), (n + 7, 0, [], 1, "x"), (n + 8, 0, [1.0, 2.0], 1, "x"), (n + 9, 0, [2.0, 4.0], 1, "x"), (n + 10, 0, [math.inf] * dim, 1, "x")]
    return rows


def brute(rows, threshold):
    good = [(i, lab, np.array(v, float)) for i, lab, v, *_ in rows if lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, *_ in rows}
    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            (i, la, x), (j, lb, y) = good[a], good[b]
            if la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        out[i] = (len(links[i]), min(seen), min(seen) == i)
    return out


@pytest.mark.parametrize("block_rows, epsilon", [(1024, None), (4, None), (1024, 6.0)])
def test_links_and_components(spark, block_rows, epsilon):
    rows = vectors()
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), block_rows=block_rows, epsilon=epsilon)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got.collect()} == brute(rows, 0.98)


def test_repeated_rows_and_empty(spark):
    rows = vectors()[:3] * 2
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.vec_id, r.n_links >= 1) for r in got.collect()) == [(0, True)] * 2 + [(1, True)] * 2 + [(2, True)] * 2
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((2000, 64)), rng.standard_normal((1, 64))
    a = a * 0.3 + b
    codes, factors = embed_dedup.encode(a, 7)
    rotated = embed_dedup.unit_rows(b) @ embed_dedup.rotation(64, 7)
    got = embed_dedup.estimate(codes, factors, rotated)[:, 0]
    true = embed_dedup.unit_rows(a) @ embed_dedup.unit_rows(b)[0]
    assert abs((got - true).mean()) < 0.01
    width = np.sqrt(1 - true**2) * np.sqrt(1 - factors**2) / factors
    assert (np.abs(got - true) <= width + 1e-4).all()
    hit = true >= 0.95
    assert (got[hit] >= embed_dedup.lower_limit(factors, 64, 0.95, None)[hit]).all()


@pytest.mark.parametrize("shard_rows, query_rows", [(512, 4096), (2, 3)])
def test_top_k(spark, shard_rows, query_rows):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.exact_top_k(df, df.where("vec_id % 5 = 0"), k=4, shard_rows=shard_rows, query_rows=query_rows)
    good = {i: [math.floor(256 * x) for x in v] for i, _, v, *_ in rows if v and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in good if i % 5 == 0):
        scored = sorted((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q and len(good[c]) == len(good[q]))
        want |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:4])}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()} == want


def test_top_k_of_huge_components_and_empty(spark):
    df = spark.createDataFrame([(0, [3e12, 1.0]), (1, [3e12, -5.0]), (2, [3e12, 2.0])], "vec_id long, embedding array<double>")
    got = topk.exact_top_k(df, df.where("vec_id = 0"), k=2)
    assert [r.vec_id for r in got.orderBy("rank").collect()] == [1, 2] or [r.score for r in got.collect()] == [2**63 - 1] * 2
    assert topk.exact_top_k(df.limit(0), df.limit(0)).count() == 0


def test_kd_tree_boxes_hold_their_points():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (1000, 5)).astype(float)
    tree = topk.KDTree(x, leaf=32)
    assert sorted(tree.order.tolist()) == list(range(1000))
    for (a, b), lo, hi in zip(tree.span, tree.lo, tree.hi, strict=True):
        part = x[tree.order[a:b]]
        assert (part.min(axis=0) == lo).all() and (part.max(axis=0) == hi).all()
