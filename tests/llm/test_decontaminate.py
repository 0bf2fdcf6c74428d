import pytest
from plain import contamination

from tallyloom.llm import decontaminate, queries

SCHEMA = "doc_id bigint, text string, n_words string"
LONG = " ".join(f"w{i}" for i in range(40))
ITEMS = [(1, LONG), (10, " ".join(f"w{i}" for i in range(20, 40))), (2, "Two words"), (2, "Two words"), (3, ""), (4, None), (None, "nobody knows this")]
TEXTS = [
    "before " + LONG + " after", " ".join(f"W{i}" for i in range(3, 16)) + " x" * 300, " ".join(f"w{i}" for i in range(12)),
    "Two, WORDS and two-words", None, "", "??? !!!", "x " * 50_000 + LONG, "nobody KNOWS this", " ".join(f"w{i}" for i in range(13)) * 2, "Éa two éa words",
]


def got(df):
    return {r["doc_id"]: tuple(r[c] for c in decontaminate.ADDED) for r in df.collect()}


def test_agrees_with_plain_python(spark):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert got(decontaminate.decontaminate(docs, items)) == contamination(dict(enumerate(TEXTS)), ITEMS)


def test_repeated_rows_null_ids_and_clashing_names(spark):
    docs = spark.createDataFrame([(None, LONG, "a"), (5, LONG, "b"), (5, LONG, "b"), (5, "other", "c")], SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    out = decontaminate.decontaminate(docs, items).collect()
    assert sorted((r["doc_id"] is None, r["text"] == LONG, r["n_hit"]) for r in out) == [(False, False, 0), (False, True, 40), (False, True, 40), (True, True, 40)]


@pytest.mark.parametrize("texts, items", [([], ITEMS), (TEXTS, []), (TEXTS, [(1, None), (2, "")])])
def test_empty_tables(spark, texts, items):
    docs = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], SCHEMA)
    out = got(decontaminate.decontaminate(docs, spark.createDataFrame(items, "item_id bigint, text string")))
    assert out == contamination(dict(enumerate(texts)), items)


def test_query_on_the_test_tables(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert got(queries.op4_decontaminate(spark, folder)) == contamination(texts, items)
