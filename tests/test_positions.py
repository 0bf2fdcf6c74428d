import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom.operators import rows as op
from tallyloom.operators import selection
from tallyloom.plans.learning import train_test_split


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share one key."""
    rng = random.Random(5)
    data = [(rng.choice([7, rng.randrange(100)]), i) for i in range(5000)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "k int, id int").repartition(13)


def test_positions_are_those_of_the_sorted_rows(skewed):
    data, df = skewed
    got = rows(op.with_position(df, "k", "id", total="n").select("k", "id", "position", "n"), "position")
    assert got == [(k, i, p, 5000) for p, (k, i) in enumerate(sorted(data))]


def test_positions_in_descending_order(skewed):
    data, df = skewed
    got = rows(op.with_position(df, F.col("k").desc(), "id"), "position")
    assert [r[:2] for r in got] == sorted(data, key=lambda r: (-r[0], r[1]))


def test_slices_near_the_top_and_far_down(skewed):
    data, df = skewed
    assert rows(op.slice_rows(df, 0, 3, "k", "id"), "k", "id") == sorted(data)[:3]
    got = rows(op.slice_rows(df, 1990, 2010, "k", "id"), "k", "id")
    assert got == sorted(data)[1990:2010]
    assert rows(op.slice_rows(df, 4998, 6000, "k", "id"), "k", "id") == sorted(data)[4998:]


@pytest.fixture
def fine(monkeypatch):
    """Small tables go through the rounds that large ones need."""
    monkeypatch.setattr(selection, "_FEW", 30)
    monkeypatch.setattr(selection, "_BINS", 5)
    monkeypatch.setattr(selection, "_SAMPLE", 4)


def test_slices_found_by_counting(skewed, fine):
    data, df = skewed
    want = sorted(data)
    for start, stop in [(0, 1), (0, 5000), (17, 18), (100, 140), (350, 4700), (2500, 2501), (4999, 5000), (4990, 9000), (5000, 5001), (7, 7)]:
        assert sorted(rows(op.slice_rows(df, start, stop, "k", "id"))) == want[start:stop], (start, stop)


def test_slices_through_ties(skewed, fine):
    """The order column does not tell rows apart: the keys are those of the sorted rows, no row comes twice."""
    data, df = skewed
    keys = sorted(k for k, _ in data)
    for start, stop in [(0, 10), (200, 2000), (1000, 1001), (100, 4000), (4500, 5000)]:
        got = rows(op.slice_rows(df, start, stop, "k"))
        assert sorted(k for k, _ in got) == keys[start:stop] and len(set(got)) == stop - start and set(got) <= set(data)


def test_ranks_and_how_many_share_them(skewed, fine):
    data, df = skewed
    keys = sorted(k for k, _ in data)
    places = selection.keys_at(df, ["k"], [0, 1234, 4999, 5000])
    assert places[5000] is None
    for rank in (0, 1234, 4999):
        k = keys[rank]
        assert (places[rank].key["k0"], places[rank].before, places[rank].equal) == (k, keys.index(k), keys.count(k))


def test_slices_of_texts_and_nulls(spark, fine):
    values = [None] * 50 + ["", "é", "z"] * 30 + [f"t{i % 40}" for i in range(400)]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(values)], "`a.b` string, x double")
    want = sorted(((v is None, v or "", float(i), v) for i, v in enumerate(values)))
    for start, stop in [(0, 30), (100, 400), (480, 530), (520, 600)]:
        got = rows(op.slice_rows(df, start, stop, "a.b", "x"))
        assert sorted(got, key=lambda r: r[1]) == sorted([(v, x) for _, _, x, v in want[start:stop]], key=lambda r: r[1])


def test_a_slice_neither_sorts_nor_writes_the_table(skewed):
    _, df = skewed
    plan = op.slice_rows(df, 1000, 3000, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan and "FileScan" not in plan


def test_head_and_tail(skewed):
    data, df = skewed
    assert sorted(rows(op.head_n(df, 5, "k", "id"))) == sorted(data)[:5]
    assert sorted(rows(op.tail_n(df, 5, "k", "id"))) == sorted(data)[-5:]


def test_nulls_are_last_everywhere(frame):
    df = frame("`k.1` int", (2,), (None,), (1,))
    assert rows(op.head_n(df, 2, "k.1")) == [(1,), (2,)] == rows(op.slice_rows(df, 0, 2, "k.1"), "`k.1`")
    assert rows(op.tail_n(df, 1, "k.1")) == [(None,)]
    assert dict(rows(op.with_position(df, "k.1"))) == {1: 0, 2: 1, None: 2}
    sheet = frame("label string", ("Total",), (None,), ("b",), ("a",))
    assert [r[0] for r in op.totals_last(sheet, "label").collect()] == ["a", "b", None, "Total"]


def test_empty_input(frame):
    assert rows(op.with_position(frame("k int"), "k")) == []


@pytest.mark.parametrize("n", [1, 2, 7, 10, 999])
def test_split_is_exact_and_repeatable(spark, n):
    df = spark.range(n)
    first = dict(rows(train_test_split(df, "id")))
    again = dict(rows(train_test_split(df.repartition(5), "id")))
    assert first == again and len(first) == n
    assert sum(v == "train" for v in first.values()) == int(n * 0.75 + 0.5)
