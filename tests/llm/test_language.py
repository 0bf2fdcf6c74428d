import pytest
from pyspark.sql import functions as F

from tallyloom.llm import language, queries

WORDS = {
    "de": "der die und nicht sich mit ist auch werden haben straße über schön groß".split(),
    "en": "the of and that with have this from which would there their about thing".split(),
    "ja": "これ それ は です ます から まで 日本 言葉 文章 世界 時間 人間 今日".split(),
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, " ".join(WORDS[lang][(i * 7 + k * (i % 5 + 1)) % 14] for k in range(i % 12 + 3)), lang) for i in range(900) for lang in [sorted(WORDS)[i % 3]]]
    docs = spark.createDataFrame(rows + [(None, None, "en"), (-1, "x", None), (-2, "", "de")], "doc_id bigint, text string, lang string")
    return language.fit(docs, F.col("doc_id") % 10 == 0), docs


def test_learns_and_rejects_nothing_clean(spark, model):
    out = language.predict(model[1], model[0]).filter("lang is not null and text <> ''")
    n, right, rejected, low, high = out.agg(F.count("*"), F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.sum(F.col("rejected").cast("int")), F.min("score"), F.max("score")).first()
    assert n == 900 and right > 0.97 and rejected < 10 and 0 <= low <= high <= 1


def test_odd_texts(spark, model):
    texts = [None, "", "  \n", "123 !!! ---", "the", "und " * 400_000, "日本"]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id int, text string, score int")
    got = {r["doc_id"]: r for r in language.predict(docs, model[0]).collect()}
    assert [got[i]["lang_pred"] for i in range(7)] == ["und"] * 4 + ["en", "de", "ja"]
    assert all(got[i]["score"] == 0 and got[i]["rejected"] for i in range(4))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    empty = language.fit(docs)
    assert [(r["lang_pred"], r["rejected"]) for r in language.predict(docs, empty).collect()] == [("und", True)]
    assert language.predict(docs.limit(0), empty).collect() == []


def test_query_holds_out_and_is_right(spark, folder):
    out = queries.op9_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    held = out.filter("held_out")
    assert held.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1).isEmpty()
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.9


def test_large_languages_and_long_texts_are_learned(spark):
    """A language with 1,200,000 rows for each one that is wanted, and one with long texts only."""
    many = spark.range(1_200_000).selectExpr("id AS doc_id", "'the of and that with have this' AS text", "'en' AS lang")
    long = spark.createDataFrame([(-i, "der die und nicht sich mit " * 3000, "de") for i in range(1, 4)], "doc_id bigint, text string, lang string")
    model = language.fit(many.unionByName(long), s=language.Settings(sample_docs=2))
    assert model.langs == ["de", "en"]
