import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import queries, tokens
from tallyloom.session import new_path


@pytest.mark.parametrize("counts", [[5], [1, 1], [0, 3, 0, 9, 1], [1 << i for i in range(40)], list(range(5000))])
def test_codes_are_prefix_free_within_the_limit_and_decode(counts):
    counts = np.array(counts)
    lengths = tokens.code_lengths(counts)
    used = np.flatnonzero(counts)
    assert (lengths > 0).tolist() == (counts > 0).tolist() and lengths.max() <= max(tokens.MAX_BITS, 13)
    assert sum(2.0 ** -int(n) for n in lengths[used]) <= 1
    ids = np.random.default_rng(1).choice(used, 1000)
    payload, checkpoints = tokens.pack(ids, lengths, tokens.canonical_codes(lengths))
    assert tokens.Decoder(lengths).unpack(payload, checkpoints, 1000).tolist() == ids.tolist()
    part = tokens.Decoder(lengths).unpack(payload, checkpoints[3:4], 64)  # one run on its own, from its checkpoint
    assert part.tolist() == ids[192:256].tolist()


def test_lengths_are_those_of_huffman_without_a_limit():
    import heapq

    counts = np.array([7, 1, 30, 4, 4, 12, 2])
    heap, total = counts.tolist(), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    assert int((tokens.code_lengths(counts) * counts).sum()) == total


TEXTS = [
    "Hello, world", None, "", "  \n ", "don't I'll 's o'clock", "a<|endoftext|>b <|startoftext|>", "İstanbul ΣΑΣ éa ÉA ﬁ ß ẞ Å",
    "x y z\x1cq", "日本語 テキスト 👍🏽ok", "--word-- (Word) _x_ x_y a1b2 ４th", "word " * 70_000, "Ünïcödé,ÉÇ!!", "\x00a \x7f",
]


def expected(rows):
    tokenizer = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    at, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def got(df):
    return sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()), key=lambda r: r[1])


def test_round_trip_of_odd_texts(spark):
    rows = [(i * 3 % 13, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (4, "again"), (4, "again"), (4, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, ids string").repartition(5)
    found, want = got(queries.token_digest(docs)), expected(rows)
    assert sorted((r[0] or -1, *r[2:]) for r in found) == sorted((r[0] or -1, *r[2:]) for r in want)
    assert [r[0] for r in found] == [r[0] for r in want]  # the order of rows with one doc_id is free
    assert all(a[1] + a[2] == b[1] for a, b in zip(found, found[1:]))


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert queries.token_digest(docs).collect() == []


def test_reading_does_not_depend_on_the_split(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, id % 90), x -> concat('w', x * id % 97))) as text")
    path = new_path(spark, "tokens")
    tokens.write_token_files(docs, path, queries.tokenizer_path("word_bpe_49k.json"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4000)
    try:
        read = tokens.read_token_files(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    at = 0
    for r in sorted(read, key=lambda r: r["doc_id"]):
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]


def test_query_on_the_test_tables(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert got(queries.op10_token_output(spark, folder)) == expected(rows)


def test_a_word_is_one_entry_however_it_is_written():
    path = queries.tokenizer_path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        own = tokens.Encoder(f.read())
    own.ids(["Straße straße, (STRASSE) straße; Ça ça!\tÇA"], 1)
    assert set(own) == {"straße", ",", "(", "strasse", ")", ";", "ça", "!"}


def test_pieces_of_plain_texts_equal_the_library():
    path = queries.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        own = tokens.Encoder(f.read())
    plain = [chr(c) for c in range(0x2100) if not tokens._PLAIN_ODD.search(chr(c))]
    rng = np.random.default_rng(5)
    texts = [f"a{c}b {c}{c} {c}'s" for c in plain] + ["".join(rng.choice(plain, 40)) for _ in range(1000)]
    texts += ["".join(rng.choice(list("aZß'strevmdl0 9\t<|>.’"), 30)) for _ in range(2000)]
    for text, ids in zip(texts, own.ids(texts, 1), strict=True):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], repr(text)


def test_distinct_words_of_a_group_are_looked_up_once(monkeypatch):
    """Plain and odd texts in turn, groups that end between them, and a cache that is emptied on the way."""
    path = queries.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        own = tokens.Encoder(f.read())
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdeéß"), rng.integers(1, 9))) + m for m in ["", ",", "'s", "!?", "2", " \t"] for _ in range(60)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 90))) + ("" if i % 5 else " 日本　x") for i in range(300)] + ["", " \n", " a ", "<|endoftext|>"]
    for chars, cache in ((1 << 21, 64 << 20), (700, 40_000)):
        monkeypatch.setattr(tokens, "GROUP_CHARS", chars)
        monkeypatch.setattr(tokens, "CACHE_BYTES", cache)
        for text, ids in zip(texts, own.ids(texts, 1), strict=True):
            assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1], repr(text)
    monkeypatch.undo()
    asked, packed = [], own._packed
    monkeypatch.setattr(own, "_packed", lambda found: asked.extend(found) or packed(found))
    own.ids(["A word, a WORD,", "a\tword, b"], 1)
    assert sorted(asked) == ["a", "b", "word,"]


def test_ids_between_the_stages_are_narrow(spark):
    docs = spark.createDataFrame([(1, "Hello, world"), (2, None)], "doc_id bigint, text string")
    path = queries.tokenizer_path("word_bpe_49k.json")
    for end, width in ((1, 2), (1 << 16, 4)):
        found = tokens.encode_documents(docs, path, end).filter("ids is not null").collect()
        assert {r["doc_id"]: (r["n"], len(r["ids"])) for r in found} == {1: (4, 4 * width), 2: (1, width)}
        assert {int.from_bytes(r["ids"][-width:], "little") for r in found} == {end}
    out = new_path(spark, "tokens")
    tokens.write_token_files(docs, out, path, 1 << 16)
    assert {r["doc_id"]: r["ids"][-4:] for r in tokens.read_token_files(spark, out).collect()} == dict.fromkeys((1, 2), b"\0\0\1\0")


def test_common_words_only_save_work(spark, monkeypatch):
    path = queries.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = spark.createDataFrame([("The straße, the STRASSE! İI ŒUVRE œuvre",), (None,), ("the end 12 12 " + "long" * 50,), ("日本 日本",)], "text string")
    common = tokens.common_words(docs, path)
    assert set(common[0].split()) == {"the", "œuvre", "i"} and tokens.common_words(docs.limit(0), path) == ("", b"", b"")
    with open(path, encoding="utf-8") as f:
        own = tokens.Encoder(f.read(), common)
    assert set(own) == set(common[0].split())
    asked, mapped = [], own._mapped
    monkeypatch.setattr(own, "_mapped", lambda word: asked.append(word) or mapped(word))
    texts = ["The the ŒUVRE", "i the", "日本 The"]
    assert [x.tolist() for x in own.ids(texts, 1)] == [[*library.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert asked == ["日本"]  # the model is not asked for words that are known
    own._start()
    assert set(own) == set(common[0].split())
