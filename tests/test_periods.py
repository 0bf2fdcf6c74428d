import datetime as dt
import random

import pytest
from conftest import rows

from tallyloom.operators import periods as op


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def plain(points, spans, left):
    out = []
    for i, g, p in points:
        hit = [(g, i, p, n, a, b) for n, h, a, b in spans if None not in (g, p, a, b) and g == h and a <= p <= b]
        out += hit or ([(g, i, p, None, None, None)] if left else [])
    return sorted(out, key=str)


def tables(spark, seed, few=None):
    r = random.Random(seed)
    points = [(i, r.choice(["a", "b", None]), r.choice([None, 5, r.randrange(-400, 400)])) for i in range(600)]
    spans = [(k, r.choice(["a", "b", None]), a, None if k % 11 == 0 else a + r.choice([-2, 0, 1, 3, 7, 64, 500])) for k in range(80) for a in [r.randrange(-300, 300)]]
    p = spark.createDataFrame([(i, g, day(x)) for i, g, x in points], "id int, g string, at date")
    s = spark.createDataFrame([(k, g, day(a), day(b)) for k, g, a, b in spans], "k int, g string, first date, last date")
    return p, s, [(i, g, day(x)) for i, g, x in points], [(k, g, day(a), day(b)) for k, g, a, b in spans]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("few", [100_000, 10])
def test_uneven_overlapping_and_missing(spark, monkeypatch, how, few):
    """With few = 10 the bins are measured, and those with more than 20 points split."""
    monkeypatch.setattr(op, "_FEW", few)
    p, s, points, spans = tables(spark, 1)
    got = op.join_periods(p, s, "at", "first", "last", by=["g"], how=how, split=20)
    assert got.columns == ["g", "id", "at", "k", "first", "last"]
    assert sorted(rows(got), key=str) == plain(points, spans, how == "left")


def test_numbers_times_and_no_groups(frame, spark):
    p = frame("x double, `a.b` int", (1.5, 1), (-0.5, 2), (9.0, 3), (None, 4))
    s = frame("lo double, hi double, name string", (-1.0, 1.49, "low"), (1.5, 1.5, "one"), (0.0, 100.0, "wide"), (5.0, 2.0, "turned"))
    got = op.join_periods(p, s, "x", "lo", "hi")
    assert sorted((r["a.b"], r["name"]) for r in got.collect()) == [(1, "one"), (1, "wide"), (2, "low"), (3, "wide")]
    times = spark.sql("SELECT timestamp '2024-01-01 00:00:01' AS t"), spark.sql("SELECT timestamp '2024-01-01 00:00:01' AS a, timestamp '2024-02-01 00:00:00' AS b")
    assert op.join_periods(*times, "t", "a", "b").count() == 1
    assert op.join_periods(p, s.limit(0), "x", "lo", "hi", how="left").count() == 4
    with pytest.raises(ValueError):
        op.join_periods(p, s.withColumnRenamed("name", "x"), "x", "lo", "hi")


def test_equi_join_in_the_plan(spark):
    p, s, _, _ = tables(spark, 2)
    plan = op.join_periods(p, s, "at", "first", "last", by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
