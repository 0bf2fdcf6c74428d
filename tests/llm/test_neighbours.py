import numpy as np
import pytest

from tallyloom.llm import neighbours, queries

SCHEMA = "vec_id bigint, embedding array<double>, hash string"


def exact(rows, asked, k):
    out = {}
    for q in asked:
        v = dict(rows)[q]
        scored = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_odd_vectors_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)] + [(i, [1.0] * 8) for i in range(60, 90)]
    bad = [(100, None), (101, [0.0] * 8), (102, [1.0] * 7 + [None]), (103, [float("nan")] * 8), (104, [float("inf")] * 8), (105, [1.0, 2.0]), (None, [1.0] * 8), (106, [])]
    df = spark.createDataFrame([(*r, "x") for r in [*rows, *bad, rows[3]]], SCHEMA)
    found = got(neighbours.search(df, df.filter("vec_id % 10 = 0 or vec_id > 100"), 7))
    want = exact(rows, range(0, 90, 10), 7)
    assert found.keys() == want.keys()
    for q in want:
        assert [i for i, _ in found[q]] == [i for i, _ in want[q]]  # so few vectors are all candidates; ties to the smaller id
        np.testing.assert_allclose([s for _, s in found[q]], [s for _, s in want[q]], rtol=1e-12)


def test_few_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], ""), (2, [0.0, 2.0], "")], SCHEMA)
    assert got(neighbours.search(df, df, 5)) == {1: [(2, 0.0)], 2: [(1, 0.0)]}
    assert neighbours.search(df.limit(0), df, 5).collect() == []
    assert neighbours.search(df, df.limit(0), 5).collect() == []


def test_recall_when_the_forest_leaves_most_out(spark):
    """Clusters, lengths that differ, a third of all vectors equal, small blocks."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    x *= rng.uniform(0.5, 2, size=(3000, 1))
    x[:1000] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    f = neighbours.Forest(least=0, share=0.6, rows=200, queries=16)
    asked = [*range(0, 3000, 100)]
    found, want = got(neighbours.search(df, df.filter("vec_id % 100 = 0"), 10, f=f)), exact(rows, asked, 10)
    reached = [sum(s >= want[q][-1][1] - 1e-9 for _, s in found[q]) / 10 for q in asked]  # equal vectors stand for each other
    assert np.mean(reached) >= 0.9


def test_query_recall(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    asked = [i for i, _ in rows if i % 20 == 0]
    found, want = got(queries.op1_nearest_neighbours(spark, folder)), exact(rows, asked, 20)
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in asked]) >= 0.9


@pytest.mark.parametrize("kind", ["gaussian", "uneven lengths", "a third equal"])
def test_nothing_is_left_out(spark, kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 32))
    if kind == "uneven lengths":
        x *= rng.lognormal(0, 0.5, size=(6000, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "a third equal":
        x[:2000] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    f = neighbours.Forest(rows=700, queries=16)
    found, want = got(neighbours.search(df, df.filter("vec_id % 100 = 7"), 10, f=f)), exact(rows, range(7, 6000, 100), 10)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in want.items()} or kind == "a third equal"
    for q in want:
        np.testing.assert_allclose([s for _, s in found[q]], [s for _, s in want[q]], rtol=1e-9)


def test_opposite_long_and_repeated_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [-1.0, 0.01]), (3, [0.0, 1000.0]), *[(i, [-1.0, -0.01 * i]) for i in range(4, 20)]]
    df = spark.createDataFrame([(*r, "") for r in [*rows, *[(1, [0.5, 0.0])] * 50, *[rows[1]] * 50]], SCHEMA)
    found, want = got(neighbours.search(df, df.filter("hash = '' and vec_id <> 1"), 30)), exact(rows, range(2, 20), 30)
    want = {q: sorted([(i, max(s, 0.5 * dict(rows)[q][0]) if i == 1 else s) for i, s in v], key=lambda p: (-p[1], p[0])) for q, v in want.items()}
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(len(v) == len(rows) - 1 for v in found.values())
