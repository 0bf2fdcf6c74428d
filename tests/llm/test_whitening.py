import math
from fractions import Fraction

import numpy as np
import pytest

from tallyloom.llm import queries, whitening


def plain(rows):
    """Plain version: exact sums, float64 eigenvectors of the exact covariance."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept]
    n, dim = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(dim)]
    deviation = [sum((n * r[j] - s[j]) ** 2 for j in range(dim)) for r in x]
    y = np.array([[float(Fraction(n * r[j] - s[j], n)) for j in range(dim)] for r in x])
    values, axes = np.linalg.eigh(y.T @ y / n)
    return [i for i, _ in kept], n, deviation, y, values[::-1], axes[:, ::-1]


def check(got, rows, k):
    ids, n, deviation, y, values, axes = plain(rows)
    k = min(k, y.shape[1])
    assert len(got) == len(ids) * k
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    white = np.zeros((len(ids), k))
    for at, key in enumerate(ids):
        own = sorted(by_id[key], key=lambda r: r["component"])
        assert [r["component"] for r in own] == list(range(1, k + 1))
        assert {r["n"] for r in own} == {n} and {int(r["deviation"]) for r in own} == {deviation[at]}
        white[at] = [np.nan if r["whitened"] is None else r["whitened"] for r in own]
    live = values[:k] > 1e-9 * values[0]
    assert np.isnan(white[:, ~live]).all() and not np.isnan(white[:, live]).any()
    want = (y @ axes[:, :k])[:, live] / np.sqrt(values[:k][live])
    w = white[:, live]
    clear = [j for j in range(w.shape[1]) if min(abs(values[j] - v) for i, v in enumerate(values) if i != j) > 1e-6 * values[0]] if y.shape[1] > 1 else [0]
    for j in clear:
        assert min(np.abs(w[:, j] - want[:, j]).max(), np.abs(w[:, j] + want[:, j]).max()) < 1e-8
    error = np.abs(w.T @ w / n - np.eye(w.shape[1])).max()
    assert error < 1e-9 and all(abs(r["identity_error"] - error) < 1e-9 for r in got)
    explained = {r["component"]: r["explained"] for r in got}
    assert all(abs(explained[j + 1] - values[j] / values.sum()) < 1e-9 for j in range(k))


def frame_of(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>")


def test_the_whole_table_against_the_plain_version(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = queries.op11_whitening(spark, folder).collect()
    check(got, rows, 32)
    assert got[0]["identity_error"] <= 0.0001


def test_invalid_repeated_and_constant(spark):
    r = np.random.default_rng(2)
    rows = [(i, [float(a), float(b), 7.0, float(a)]) for i, (a, b) in enumerate(r.normal(size=(60, 2)))]
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 2.0, 3.0]), (103, [float("inf"), 0.0, 0.0, 0.0]), (104, [])]
    zero = [(105, [0.0, 0.0, 0.0, 0.0])]
    check(whitening.whiten(frame_of(spark, rows + odd + zero)).collect(), rows + zero, 32)
    twice = whitening.whiten(frame_of(spark, rows + rows), 2).collect()
    assert len(twice) == 240 and {x["n"] for x in twice} == {120}


@pytest.mark.parametrize("scale", [1e-3, 1e5, 1e12, 1e14])
def test_entries_of_any_size(spark, scale):
    r = np.random.default_rng(3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(r.normal(size=(50, 5)) * scale + scale)]
    if scale >= 1:
        check(whitening.whiten(frame_of(spark, rows, "double"), 5).collect(), rows, 5)
    else:  # most entries fall on one integer
        assert len(whitening.whiten(frame_of(spark, rows, "double"), 5).collect()) == 250


def test_defined_results_at_the_edges(spark):
    assert whitening.whiten(frame_of(spark, [(1, None)])).collect() == []
    one = whitening.whiten(frame_of(spark, [(None, [1.0, 2.0])])).collect()
    assert [(x["vec_id"], x["component"], x["n"], int(x["deviation"]), x["whitened"], x["explained"], x["identity_error"]) for x in one] == [
        (None, 1, 1, 0, None, None, None), (None, 2, 1, 0, None, None, None)]
    with pytest.raises(ValueError, match="2 to 3"):
        whitening.whiten(frame_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])]))
    named = spark.createDataFrame([("a", [1.0, 0.0], 9), ("b", [0.0, 3.0], 9)], "`my id` string, n array<double>, whitened int")
    assert whitening.whiten(named, 1, "my id", "n").count() == 2
    with pytest.raises(ValueError, match="cannot be called"):
        whitening.whiten(named, 1, "whitened", "n")


def test_results_do_not_depend_on_the_split(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    a, b = (whitening.fit(whitening.integer_vectors(d, "vec_id", "embedding")) for d in (df.coalesce(1), df.repartition(7)))
    assert (a.products == b.products).all() and (a.rest == b.rest).all() and a.n == b.n


def matrix(values, seed=1):
    r, d = np.random.default_rng(seed), len(values)
    q = np.linalg.qr(r.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(d) - q.T @ q / 2)
    a = (q * np.asarray(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize("values", [
    np.linspace(100, 1, 40), np.r_[5 + np.arange(9, -1, -1) * 1e-8, np.linspace(4, 1, 30)], np.r_[np.full(8, 5.0), np.full(8, 2.0), 1.0],
    np.r_[np.linspace(4, 1, 4), np.zeros(30)], np.zeros(3), np.array([3.0]),
], ids=["apart", "clustered", "equal", "rank 4", "zero", "one"])
def test_eigenvectors_to_double_precision(values):
    a, q = matrix(values)
    got, x = whitening.eigen(a)
    assert np.abs(got - values).max() < 1e-14 * max(values[0], 1)
    assert np.abs(x.T @ x - np.eye(len(x))).max() < 4e-15 and np.abs(a @ x - x * got).max() < 4e-15 * max(values[0], 1)
    for j, v in enumerate(values):  # one by one where the value stands alone
        gap = min((abs(v - u) for i, u in enumerate(values) if i != j), default=1)
        if gap > 1e-9:
            assert min(np.abs(x[:, j] - q[:, j]).max(), np.abs(x[:, j] + q[:, j]).max()) < max(1e-15, 1e-17 / gap)


def test_clusters_need_the_sub_solve(monkeypatch):
    """Without it vectors of values 1e-8 apart stay as mixed as float32 left them."""
    values = np.r_[5 + np.arange(3, -1, -1) * 1e-8, 1.0]
    a, q = matrix(values)
    assert np.abs(np.abs((whitening.eigen(a)[1] * q).sum(0)) - 1).max() < 1e-12
    called = []
    solve = whitening._sub_solve
    monkeypatch.setattr(whitening, "_sub_solve", lambda *args: called.append(1) or solve(*args))
    whitening.eigen(a)
    assert called
