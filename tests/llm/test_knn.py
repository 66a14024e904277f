import random

import numpy as np
import pytest
from oracle_llm import compare, connect

from filmloom.llm import knn
from filmloom.llm.knn import integer_vectors, top_products
from filmloom.llm.queries import QUERIES


def _brute(vectors, queries, k):
    """Scores by whole numbers; shorter vectors are padded with zeros."""
    width = max(len(v) for _, v in vectors)
    full = lambda v: [int(x) for x in v] + [0] * (width - len(v))
    out = []
    for i, v in sorted(set(queries)):
        found = sorted((-sum(a * b for a, b in zip(full(v), full(w), strict=True)), j) for j, w in vectors if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id bigint, v array<double>").repartition(3)


def _answers(spark, rows, asked, k, pivots=None):
    return sorted(tuple(r) for r in top_products(_frame(spark, rows), _frame(spark, asked), k, pivots).collect())


@pytest.mark.parametrize(("queries", "candidates"), [(2048, 50_000), (7, 40)])
def test_equals_brute_force_with_ties_and_a_hot_vector(spark, monkeypatch, queries, candidates):
    monkeypatch.setattr(knn, "QUERIES", queries)
    monkeypatch.setattr(knn, "CANDIDATES", candidates)
    rng = random.Random(3)
    centres = [[rng.randint(-40, 40) for _ in range(6)] for _ in range(8)]
    rows = [(i, tuple(x + rng.randint(-3, 3) for x in rng.choice(centres))) for i in range(300)]
    rows += [(1000 + i, tuple(centres[0])) for i in range(150)] + [(2000, (0,) * 6), (2001, (0,) * 6)] + [(3000, tuple(centres[1]))] * 3
    asked = [r for r in rows if r[0] % 10 == 0]
    assert _answers(spark, rows, asked, 5, 12) == _brute(rows, asked, 5)


@pytest.mark.parametrize(("repeats", "k"), [(1, 1), (2, 2), (3, 3), (4, 1), (5, 20), (6, 2), (6, 7)])
def test_repeated_ids_in_far_clusters_lose_no_neighbour(spark, repeats, k):
    rng = random.Random(10 * repeats + k)
    rows = []
    for c in range(6):
        centre = [rng.randint(-2000, 2000) for _ in range(3)]
        for i in range(5):
            row = (10 * c + i, tuple(x + rng.randint(-2, 2) for x in centre))
            rows += [row] * (repeats if i < 2 else rng.randint(1, repeats))
    asked = [r for r in rows if r[0] % 2 == 0]
    assert _answers(spark, rows, asked, k, len(rows)) == _brute(rows, asked, k)


def test_a_tripled_query_far_from_the_rest(spark):
    rows = [(0, (100, 0))] * 3 + [(1, (50, 1)), (2, (40, 2)), (3, (-10, 5))]
    assert _answers(spark, rows, rows[:1], 2, 6) == [(0, 1, 1, 5000), (0, 2, 2, 4000)]


@pytest.mark.parametrize("size", [1 << 27, 1 << 30, 1 << 40])
def test_products_beyond_doubles_and_longs(spark, size):
    rng = random.Random(size)
    rows = [(i, tuple(rng.randint(-size, size) for _ in range(4))) for i in range(30)] + [(100, (size, size, size, size - 1)), (101, (size, size, size, size))]
    want = _brute(rows, rows, 3)
    most = (1 << 63) - 1
    if max(abs(r[3]) for r in want) <= most:
        assert _answers(spark, rows, rows, 3) == want
    else:
        held = [(q, v, max(-most, min(most, s))) for q, _, v, s in _brute(rows, rows, len(rows))]
        best = {}
        for q, v, s in sorted(held, key=lambda x: (x[0], -x[2], x[1])):
            best.setdefault(q, []).append((q, len(best.get(q, [])) + 1, v, s))
        assert _answers(spark, rows, rows, 3) == sorted(r for found in best.values() for r in found[:3])


def test_rings_rule_out_far_candidates(spark):
    rng = np.random.default_rng(5)
    centres = rng.integers(-5000, 5000, (20, 4))
    rows = [(i, tuple(int(x) for x in centres[i % 20] + rng.integers(-5, 6, 4))) for i in range(1000)]
    data = _frame(spark, rows).selectExpr("id", "v", "id as r")
    most = max(sum(x * x for x in v) for _, v in rows)
    places = np.unique(knn._augmented(np.array([rows[i][1] for i in range(20)], float), most), axis=0)
    near = data.mapInArrow(lambda it: knn._nearest(it, places, most), "id bigint, v array<double>, r bigint, cell int, far double")
    sought = data.filter("id < 20").drop("r").mapInArrow(lambda it: knn._nearest(it, places, None), "id bigint, v array<double>, cell int, far double")
    copied, _ = knn.needed_copies(near, sought.filter("id = 3"), places, most, 5, 4, 1 << 40)
    assert copied.count() < 500
    assert _answers(spark, rows, rows[:20], 5, 20) == _brute(rows, rows[:20], 5)


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, (1, 2)), (1, (3, 4)), (2, (0, 0))]
    assert _answers(spark, rows, rows[:1], 20) == [(0, 1, 1, 11), (0, 2, 2, 0)]
    assert _answers(spark, rows[:1], rows[:1], 20) == []


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.01]), (1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, [1.0, -inf])]
    found = integer_vectors(spark.createDataFrame([(*r, "v") for r in rows], "vec_id bigint, embedding array<float>, v string"))
    assert [tuple(r) for r in found.collect()] == [(0, [32.0, -1.0])]


def test_shorter_vectors_are_zero_in_what_they_lack(spark):
    rows = [(0, (3, 4, 5)), (1, (1,)), (2, (1, 2)), (3, (0, 0, 7)), (4, (-2, 1, 1, 9))]
    assert _answers(spark, rows, rows, 3) == _brute(rows, rows, 3)


def test_empty_tables(spark):
    some, none = _frame(spark, [(1, (1, 2))]), _frame(spark, [(1, (1, 2))]).limit(0)
    assert top_products(none, some).collect() == [] and top_products(some, none).collect() == []


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    compare(QUERIES["op9_top_k"](spark, sf), connect(sf), "op9_top_k")
