import random

import regex

from tallyloom.llm import lines, queries

LINE = "the quick brown fox jumps over the lazy dog and then runs far away into the deep dark forest near the old stone bridge"
SCHEMA = "doc_id bigint, text string, n_kept string"


def run(spark, texts):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in texts], SCHEMA)
    return {r["doc_id"]: (r["n_lines"], r["n_kept"], r["text"]) for r in lines.dedup_lines(docs).collect()}


def test_equal_and_fuzzy_lines_stay_once(spark):
    near = LINE.replace("brown", "brwn")
    got = run(spark, [(3, f"{LINE.upper()}!\nown line here"), (1, f"first words\n{LINE}"), (2, f"{near}\n***\n\n***\nlast"), (4, None), (5, ""), (6, "last\nLast.")])
    assert got == {
        1: (2, 2, f"first words\n{LINE}"), 2: (5, 4, "***\n\n***\nlast"), 3: (2, 1, "own line here"), 4: (0, 0, None), 5: (1, 1, ""), 6: (2, 0, ""),
    }


def test_null_ids_repeated_rows_and_none(spark):
    docs = spark.createDataFrame([(None, "a b c", ""), (7, "a b c\nd", ""), (7, "a b c\nd", "")], SCHEMA)
    got = sorted((r["doc_id"] or 0, r["n_kept"], r["text"]) for r in lines.dedup_lines(docs).collect())
    assert got == [(0, 1, "a b c"), (7, 1, "d"), (7, 1, "d")]
    assert lines.dedup_lines(docs.limit(0)).collect() == []


def test_a_very_long_line(spark):
    got = run(spark, [(1, "word " * 60_000), (2, "Word, " * 60_000 + "\nx")])
    assert (got[1][1], got[2][1:]) == (1, (1, "x"))


def test_query_keeps_every_line_that_is_new(spark, folder):
    """On the test tables: nothing without an equal or similar predecessor goes, and all equal lines do."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = {r["doc_id"]: r for r in queries.op3_fuzzy_lines(spark, folder).collect()}
    assert out.keys() == docs.keys()

    def norm(line):
        return regex.sub(r"[^\p{L}\p{N}\n]+", " ", line.lower()).strip(" ")

    kept = [norm(x) for d in sorted(docs) for x in (out[d]["text"].split("\n") if out[d]["n_kept"] else []) if norm(x)]
    assert len(kept) == len(set(kept))  # equal lines stay once
    gone = {norm(x) for t in docs.values() for x in t.split("\n") if norm(x)} - set(kept)
    for line in gone:  # each line that is not kept at all resembles another line
        assert any(abs(len(x) - len(line)) <= 0.2 * max(len(x), len(line)) and set(x.split()) & set(line.split()) for x in {*kept, *(gone - {line})})
    assert all(r["n_lines"] == docs[d].count("\n") + 1 for d, r in out.items())


def _edits(x, y):
    row = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        before, row[0] = row[0], i
        for j, d in enumerate(y, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (c != d))
    return row[-1]


def test_recall_against_all_pairs(spark):
    """Lines of 3 to 50 words with replaced words or scattered edits, at 0.8 to 0.9 similarity."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9)))
    pairs = []
    while len(pairs) < 240:
        words = [word() for _ in range(rng.choice([3, 5, 8, 10, 15, 20, 30, 50]))]
        line = " ".join(words)
        if len(pairs) % 3:
            near = list(words)
            for i in rng.sample(range(len(words)), max(1, len(words) // 6)):
                near[i] = word()
            near = " ".join(near)
        else:
            near = "".join(rng.choice("xyz") if c != " " and rng.random() < 0.12 else c for c in line)
        if 0.1 <= _edits(line, near) / max(len(line), len(near)) <= 0.2:
            pairs.append((line, near))
    got = run(spark, [(2 * i + k, x) for i, p in enumerate(pairs) for k, x in enumerate(p)])
    assert all(got[2 * i][1] == 1 for i in range(len(pairs)))
    assert sum(got[2 * i + 1][1] == 0 for i in range(len(pairs))) >= 0.95 * len(pairs)


def test_large_buckets_in_blocks(spark):
    """Variants of two lines that only link through each other, in buckets larger than a block."""
    rng = random.Random(5)
    words = LINE.split()
    texts = []
    for i in range(150):
        near = list(words)
        near[rng.randrange(len(words))] = f"new{i}"
        texts.append(" ".join(near))
    docs = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r["n_kept"] for r in lines.dedup_lines(docs, lines.Rule(block=16)).collect()}
    assert got == {i: int(i == 0) for i in range(150)}


def test_long_words_and_scripts_without_spaces(spark):
    base = "".join(chr(0x4E00 + (i * 37) % 3000) for i in range(70))
    code = "".join("abcdefghijklmnop"[(i * i * 7 + i) % 16] for i in range(90))
    got = run(spark, [(1, base), (2, "\u5000" + base[1:]), (3, code), (4, "zzz" + code[3:])])
    assert {k: v[1] for k, v in got.items()} == {1: 1, 2: 0, 3: 1, 4: 0}
