import random

import numpy as np
import pytest
from plain import groups, near_duplicates
from pyspark.sql import functions as F

from tallyloom.llm import common, near_dup, queries


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def family(n, length, edits, seed):
    """A text and n copies of it, each with some words replaced."""
    rng = random.Random(seed)
    base = [f"{rng.choice('abcdefgh')}{rng.randrange(5000)}" for _ in range(length)]
    out = [" ".join(base)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(length)] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("rule", [near_dup.Rule(), near_dup.Rule(words=3, percent=85, block=16)])
def test_agrees_with_all_pairs(spark, rule):
    texts = family(60, 150, 12, 1) + family(3, 40, 2, 2) + family(5, 2000, 60, 3) + [None, "", " \t\n", "one", "ONE", "one two", "x " * 200_000] + ["same text again and again"] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert got(near_dup.near_duplicates(docs, rule)) == near_duplicates(dict(enumerate(texts)), rule.words, rule.percent)


def test_estimate_follows_the_similarity():
    rng = np.random.default_rng(0)
    rule = near_dup.Rule()
    a, b = near_dup._family(128)
    x = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    for share in (0, 0.5, 0.8, 1):
        n = int(2000 * share / (1 + share))  # common to both sets
        y = np.concatenate([x[:n], rng.integers(0, 1 << 63, 1000 - n, dtype=np.uint64)])
        p = near_dup._packed(near_dup._minima([x, y], a, b), rule.bits)
        assert abs(near_dup.estimated(near_dup._equal(p[:1], p[1], rule.bits, 128)[0], 128, rule.bits) - share) < 0.16
    assert 0.55 < rule.least < 0.8


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e f", 1), (None, "a b c d e f", 2), (4, "a b c d e f", 3), (4, "a b c d e f", 4), (3, "a b c d e f", 5), (9, "else entirely", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept int")
    assert got(near_dup.near_duplicates(docs)) == {3: (2, 3), 4: (2, 3), 9: (1, 9)}
    out = near_dup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["kept"]) for r in out.collect()) == [(3, 5), (9, 6)]


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_rows_are_told_apart_by_id_and_text(spark, kind):
    """Rows that share an id keep their own texts; null ids, and ids that are no numbers, are compared like others."""
    same, other = "one two three four five six seven", "quite another text than that one is"
    rows = [(5, same), (5, other), (5, other), (None, same), (None, None), (None, ""), (6, None), (6, None), (7, other)]
    docs = spark.createDataFrame([(k, t, "mine") for k, t in rows], "doc_id bigint, text string, _key string").withColumn("doc_id", F.col("doc_id").cast(kind))
    if kind == "string":
        docs = docs.unionByName(spark.createDataFrame([("x1", same, "mine"), ("05", same, "mine")], docs.schema))
    out = near_dup.drop_near_duplicates(docs).collect()
    assert {r["_key"] for r in out} == {"mine"}
    kept = [(r["doc_id"] and str(r["doc_id"]), r["text"]) for r in out]
    assert sorted(t for _, t in kept if t and t.startswith("quite")) == [other] and ("7", other) in kept
    assert len([t for _, t in kept if t and t.startswith("one")]) == 1
    assert sorted((k for k, t in kept if not t), key=str) == ["6", None, None]


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_dup.near_duplicates(docs).collect() == []
    assert near_dup.drop_near_duplicates(docs).collect() == []


def test_query_on_the_test_tables(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert got(queries.op8_minhash_near_dup(spark, folder)) == near_duplicates(texts, 3, 85)


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(50), rng.randrange(50)) for _ in range(30)] + [(7, 7), (500, 400)] * 2
    out = common.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    nodes = {x for e in edges for x in e}
    want = {k: v for k, v in groups(nodes, edges).items() if any(k in e and e[0] != e[1] for e in edges)}
    assert {r["node"]: r["component"] for r in out.collect()} == want
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_words_are_the_same_wherever_they_stand():
    text = ("Alpha  beta\tGAMMA delta " * 90_000).encode()
    starts, hashes = common.hashed_words(text)
    assert len(starts) == 360_000 and len(set(hashes.tolist())) == 4
    assert set(common.hashed_words(b"gamma beta delta alpha")[1].tolist()) == set(hashes.tolist())
    assert len(common.hashed_words(b"x" * 3_000_000)[0]) == 1
