import pytest
from tools import check

from tallyloom.llm import mixing, queries

SCHEMA = "doc_id bigint, text string, source string, size string"


def water(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Targets by dealing and dealing again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, set(names)
    while True:
        rest = share * sum(sizes.values()) - sum(full.values())
        level = rest / sum(weight[s] for s in left) if left else 0
        over = {s for s in left if level * weight[s] > cap * sizes[s]}
        if not over:
            return full | {s: level * weight[s] for s in left}
        full |= {s: cap * sizes[s] for s in over}
        left -= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 50}, {"a": 10}, {"a": 0, "b": 7}, {f"s{i}": i * i for i in range(30)}, {"a": 0}])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    assert got == pytest.approx(water(sizes))


def test_copies_come_near_the_target(spark):
    rows = [(i, "w " * (i % 7), "abc"[i % 3] if i % 5 else None, "clash") for i in range(6000)] + [(6000, None, "a", ""), (None, "x y", "b", ""), (6001, "", "zz", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(rows)
    taken, targets = {}, {}
    for r in plan:
        assert r["taken"] <= 2 * r["size"] and r["size"] == len((r["text"] or "").split())
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        targets[r["source"]] = r["target"]
    for s, t in targets.items():
        assert taken[s] == pytest.approx(t, rel=0.08, abs=3)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in plan)
    again = {(r["doc_id"], r["copies"]) for r in mixing.mix_plan(docs.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in plan}


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_plan(docs).collect() == [] and mixing.mix(docs).collect() == []


def test_equal_rows_share_a_coin(spark):
    docs = spark.createDataFrame([(1, "a b", "s", "")] * 4 + [(2, "c", "t", "")], SCHEMA)
    assert len({r["copies"] for r in mixing.mix_plan(docs).filter("doc_id = 1").collect()}) == 1


@pytest.mark.parametrize("key", list(queries.ORACLES))
def test_queries_agree_with_sql(spark, folder, key):
    assert check.differences(spark, check.connect(folder), folder, key) == []
