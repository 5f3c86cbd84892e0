import math

import numpy as np
import pytest

from factloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score int, rank string"


def slow(rows, k, every):
    points = {}
    for vec_id, vector in rows:
        if vec_id is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            points[vec_id] = [math.floor(64 * float(np.float32(x))) for x in vector]
    out = []
    for q, a in points.items():
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), v) for v, b in points.items() if v != q)
            out += [(q, n, v, -s) for n, (s, v) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in {"BLOCK": 16, "QUERIES": 4, "LEAF": 4, "SAMPLE": 50}.items():
            monkeypatch.setattr(topk, name, value)
    r = np.random.default_rng(2)
    vectors = [(r.normal(size=8) + 3 * (n % 3)).tolist() for n in range(200)]
    vectors[40:90] = [vectors[40]] * 50  # a hot vector: ties go to the smaller id
    vectors += [None, [1.0, None], [float("nan")] * 8, [float("inf")] * 8, [1.0, 2.0], []]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(3, vectors[3]), (None, vectors[1])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    assert sorted(tuple(x) for x in topk.top_k(frame, 5, 10).collect()) == slow(rows, 5, 10)


def test_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0], 1, "x"), (1, [2.0], 1, "x")], SCHEMA)
    assert [tuple(x) for x in topk.top_k(frame).collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(frame.where("false")).count() == 0


def test_products_stay_exact():
    a = np.array([[2.0**30, 3.0]])
    assert topk.products(a, np.array([[2.0**30, 1.0]]))[0, 0] == 2**60 + 3


def test_blocks_of_queries_and_of_data_have_inner_nodes():
    r = np.random.default_rng(1)
    for size in (topk.QUERIES, topk.BLOCK):
        tree = topk.CoverTree(np.floor(r.normal(size=(size, 8)) * 64))
        assert len(tree.children[0]) > 1 and len(tree.first) > size // topk.LEAF


@pytest.mark.parametrize("scale", [1.0, 2.0**8, 2.0**24, 2.0**40])
def test_search_over_stored_trees_against_brute_force(monkeypatch, scale):
    r = np.random.default_rng(3)
    points, queries = (np.floor((r.normal(size=(n, 6)) + 4 * r.integers(0, 3, (n, 1))) * 64 * scale) for n in (1500, 200))
    points[100:400] = points[100]
    built = [topk.CoverTree(x) for x in (queries, points)]
    monkeypatch.setattr(topk.CoverTree, "_build", None)  # a stored tree is not built again
    own, other = (topk.CoverTree(t.points, t.packed()) for t in built)
    assert own.children == built[0].children and (own.radius == built[0].radius).all()
    scores = topk.products(own.points, other.points)
    true = np.sort(scores, 1)[:, -5]
    for worst in (np.full(200, np.iinfo(np.int64).min), true - 1, true):
        i, j, s = topk.search(own, worst, other, 5)
        assert (scores[i, j] == s).all()
        want = {(a, b) for a, b in zip(*np.nonzero(scores >= true[:, None]), strict=True)}
        assert want <= set(zip(i.tolist(), j.tolist(), strict=True))
        assert len(set(zip(i.tolist(), j.tolist(), strict=True))) == len(i)
