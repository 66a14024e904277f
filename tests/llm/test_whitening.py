import numpy as np
import pytest
from pyspark.sql import functions as F

from filmloom.llm import whitening
from filmloom.llm.queries import QUERIES
from filmloom.llm.whitening import integer_rows, long_deviation, through, whiten


def _frame(spark, rows):
    return spark.createDataFrame([(i, [int(x) for x in v]) for i, v in enumerate(rows)], "id bigint, v array<bigint>").repartition(3)


def _brute(rows, k=8):
    """Eigenvectors of the covariance, in extended precision as far as numpy's sums go."""
    x = np.array(rows, np.longdouble)
    c = (x - x.mean(0)).astype(np.float64)
    value, axis = np.linalg.eigh(c.T @ c / len(c))
    value, axis = value[::-1], axis[:, ::-1]
    kept = min(k, int((value > value[0] * 1e-13).sum()))
    return c @ axis[:, :kept] / np.sqrt(value[:kept]), value[:kept] / value.sum()


def _check(spark, rows, tolerance=1e-8):
    rows = np.asarray(rows)
    got = whiten(_frame(spark, rows)).toPandas()
    want, share = _brute(rows)
    wide = got.pivot(index="id", columns="component", values="whitened").to_numpy()
    assert wide.shape == want.shape
    signs = np.sign((wide * want).sum(0))
    assert np.abs(wide * signs - want).max() < tolerance
    assert np.abs(got.groupby("component")["explained"].first() - share).max() < 1e-10
    assert (got["n"] == len(rows)).all() and got["identity_error"].max() < 1e-9
    total = [int(t) for t in rows.astype(object).sum(0)]
    exact = [sum((len(rows) * int(x) - t) ** 2 for x, t in zip(r, total, strict=True)) for r in rows]
    assert [int(d) for d in got.groupby("id")["deviation"].first()] == exact
    return got


def test_equals_eigenvectors_of_the_covariance(spark):
    rng = np.random.default_rng(1)
    _check(spark, np.floor(rng.normal(size=(500, 12)) @ np.diag(10.0 ** np.linspace(4, 1, 12))).astype(np.int64) + 100_000)


def test_fewer_dimensions_than_components(spark):
    _check(spark, np.random.default_rng(2).integers(-50, 50, (40, 3)) * [1, 10, 100])


def test_directions_without_variance_are_left_out(spark):
    base = np.random.default_rng(3).integers(-1000, 1000, (60, 3)) * [1, 7, 40]
    got = _check(spark, np.concatenate([base, base[:, :1] + base[:, 1:2], np.full((60, 1), 7)], axis=1))
    assert got["component"].max() == 3
    # Fewer rows than dimensions.
    assert _check(spark, np.random.default_rng(4).integers(-1000, 1000, (4, 9)) * (1 + np.arange(9))).component.max() == 3


def test_nearly_dependent_columns_keep_their_digits(spark):
    """Spreads 10^9 apart: the eigenvalues of a covariance matrix in doubles would lose the least one."""
    rng = np.random.default_rng(6)
    a = rng.integers(-(10**9), 10**9, 400)
    b = rng.integers(-3, 4, 400)
    rows = np.stack([a, a + b], 1)
    got = whiten(_frame(spark, rows)).toPandas().pivot(index="id", columns="component", values="whitened").to_numpy()
    assert got.shape[1] == 2
    # The second axis is along (1, -1) but for 10^-9, so it's b without what of it lies along a.
    c = a - a.mean()
    second = b - b.mean() - c * (c @ (b - b.mean())) / (c @ c)
    second /= second.std()
    assert min(np.abs(got[:, 1] - second).max(), np.abs(got[:, 1] + second).max()) < 1e-5
    assert np.abs(got.T @ got / 400 - np.eye(2)).max() < 1e-7


def test_rows_without_any_variance(spark):
    kind = "id bigint, v array<bigint>"
    for rows in ([], [(1, [3, 4])], [(1, [5, 5])] * 4, [(1, []), (2, [])]):
        assert whiten(spark.createDataFrame(rows, kind)).collect() == []


def test_numbers_beyond_a_long(spark):
    rng = np.random.default_rng(5)
    rows = rng.integers(-(1 << 40), 1 << 40, (30, 3))
    got = _check(spark, rows)
    assert got["deviation"].max() > 1 << 63
    cast = whiten(_frame(spark, rows)).select(long_deviation().alias("deviation"))
    assert cast.filter("deviation is not null").count() < cast.count()


def test_short_vectors_repeated_rows_and_null_ids(spark):
    rows = [(1, [3, 4, 8]), (1, [3, 4, 8]), (None, [9, 1, 2]), (2, [7]), (3, [1, 2, 5]), (4, [])]
    got = whiten(spark.createDataFrame(rows, "id bigint, v array<bigint>"), fill=10).toPandas()
    full = [[3, 4, 8], [3, 4, 8], [9, 1, 2], [7, 10, 10], [1, 2, 5], [10, 10, 10]]
    want, _ = _brute(full)
    assert len(got) == 18 and got["id"].isna().sum() == 3
    assert np.allclose(sorted(np.abs(got["whitened"])), sorted(np.abs(want).ravel()))


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.01]), (1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (7, [1e30, -1e30])]
    made = integer_rows(spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<float>, id string, v int"))
    got = {r["id"]: r["v"] for r in made.collect()}
    assert set(got) == {0, 2, None, 7} and got[0] == [100_512, 99_989] and got[2] == [] and got[None] == [101_024, 101_024]
    assert abs(got[7][0]) >= 1 << 62


def test_triangular_solve():
    rng = np.random.default_rng(7)
    r = np.triu(rng.normal(size=(6, 6))) + 3 * np.eye(6)
    x = rng.normal(size=(10, 6))
    assert np.allclose(through(x, r) @ r, x)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op13_whitening"](spark, sf).toPandas()
    v = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    x = np.floor(1024 * np.stack([np.asarray(e, np.float64) for e in v["embedding"]])) + 100_000
    want, share = _brute(x)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[v["vec_id"]].to_numpy()
    assert np.abs(np.abs(wide) - np.abs(want)).max() < 1e-8 and got["identity_error"].max() <= 1e-4
    deviation = got.groupby("vec_id")["deviation"].first().loc[v["vec_id"]].to_numpy()
    assert (deviation == ((len(x) * x - x.sum(0)) ** 2).sum(1)).all()


@pytest.mark.parametrize("passes", [1, 6])
def test_passes_are_few(spark, monkeypatch, passes):
    """Full rank needs three factors at most; with one, the Gram matrix of what is left makes up for it."""
    monkeypatch.setattr(whitening, "PASSES", passes)
    rows = np.random.default_rng(8).normal(size=(300, 5)) * 1000
    data = _frame(spark, rows).persist()
    factors, gram = whitening.triangular_factors(data, whitening.centre_of(data))
    assert len(factors) <= min(passes, 3)
    _check(spark, rows.astype(np.int64))
    data.unpersist()


def test_extra_columns(spark):
    made = _frame(spark, [[1, 2], [4, 3], [7, 9]]).withColumn("component", F.lit("x")).withColumn("place", F.lit(1))
    assert whiten(made).count() == 6
