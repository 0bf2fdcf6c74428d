import pytest
from plain import contamination, near_duplicates
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import mixing, tokens


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), "stage")
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mix_sources", "token_output"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_language_stage_keeps_what_has_letters(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert len(after) >= 0.99 * sum(any(c.isalpha() for c in t) for t in before.values())


def test_near_dedup_keeps_one_of_each_group(stages):
    before, after = texts(stages[1]), texts(stages[2])
    assert after.keys() == {c for _, c in near_duplicates(before).values()}


def test_decontamination_drops_benchmark_text_only(spark, folder, stages):
    before, after = texts(stages[2]), texts(stages[3])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert after.keys() == {k for k, v in contamination(before, items).items() if not v[-1]}


def test_mix_and_tokens(stages):
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(stages[3]).collect()}
    mixed = {r["doc_id"]: r["n"] for r in stages[4].groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert mixed == {d: n for d, n in plan.items() if n}
    last = stages[5].orderBy("start").collect()
    assert len(last) == sum(mixed.values()) and last[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] and a["doc_id"] <= b["doc_id"] for a, b in zip(last, last[1:]))
    assert tokens.END_ID == 1


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty texts, repeated ids and rows, and columns called like those that stages add."""
    said = "the quick brown fox jumps over the lazy dog again and again "
    rows = [
        (1, said, "en", "a"), (1, said + "but not here", "en", "a"), (1, said, "en", "a"), (None, None, None, None), (None, "", "en", None),
        (2, None, "en", "b"), (3, "", "en", "b"), (4, "1234 !?", "en", "b"), (None, said * 3, None, None), (5, "word " * 30_000, "en", "c"),
    ]
    clash = ["n_words", "n_hit", "contaminated", "score", "lang_pred", "rejected", "size", "target", "copies", "taken", "kept", "_row", "_key", "a.b"]
    schema = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in clash)
    return spark.createDataFrame([(*r, *[f"own {c}" for c in clash]) for r in rows], schema), clash


@pytest.mark.parametrize("at", range(4))
def test_stages_take_odd_rows_and_keep_columns_of_their_own(spark, folder, odd, at):
    docs, clash = odd
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, docs, folder)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"own {c}" for r in rows for c in clash)
    before = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert {(r["doc_id"], r["text"]) for r in rows} <= before
    assert stage(spark, docs.limit(0), folder).collect() == []
    if name == "language_id":
        assert all(r["text"] and any(c.isalpha() for c in r["text"]) for r in rows)
    if name == "near_dedup":
        assert len({(r["doc_id"], r["text"]) for r in rows}) == len(rows) and {(4, "1234 !?"), (2, None), (3, "")} <= {(r["doc_id"], r["text"]) for r in rows}
    if name == "decontamination":
        assert len(rows) == docs.count()


def test_the_last_stage_takes_odd_rows(spark, folder, odd):
    docs, _ = odd
    rows = corpus_pipeline.STAGES[4][1](spark, docs, folder).orderBy("start").collect()
    assert len(rows) == docs.count() and rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
    assert corpus_pipeline.STAGES[4][1](spark, docs.limit(0), folder).collect() == []
