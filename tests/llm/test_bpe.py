import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(open(PATH, encoding="utf-8").read())


TEXTS = [
    "Hello, world", None, "", "  \n ", "don't I'll 's o'clock'd", "a<|endoftext|>b <|endoftext|><|endoftext|> c<|endoftext", "é ß 日本語 👍🏽ok  \t x",
    "word " * 70_000, "\x00a \x7f\x1c\x85\xa0", "a  b   c \n\n d", "x" * 3000, "Hello, world", "1234567 ４th ²½", "'S 'RE we'VE",
]


def library_ids(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def encode(own, text):
    return memoryview(bpe.Encoder(own).ids(text)).cast("i").tolist()


def test_all_code_points_are_cut_as_the_library_does(library, own):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for pattern in ("a{0}a b1{0}1 {0}{0} !{0}", " {0} x  {0} \n{0}"):
        texts = ["".join(pattern.format(c) for c in points[i:i + 64]) for i in range(0, len(points), 64)]
        for text, want in zip(texts, library_ids(library, texts), strict=True):
            assert encode(own, text) == want


@pytest.mark.parametrize("alphabet", ["a", "ab", "abc é", "aeiou rst", "0129 .", "ÀÿΩ日"])
@pytest.mark.parametrize("size", [7, bpe.SHORT - 1, bpe.SHORT + 40, 6000])
def test_random_words_short_and_long(library, own, alphabet, size):
    r = random.Random(size)
    text = "".join(r.choice(alphabet) for _ in range(size))
    assert encode(own, text) == library_ids(library, [text])[0]


def test_the_heap_and_the_array_agree(own):
    r = random.Random(3)
    for _ in range(300):
        word = "".join(r.choice("abcdehilnorst") for _ in range(r.randrange(1, bpe.SHORT)))
        assert own.word(word) == own._long([own.first[b] for b in word.encode()])


def test_ids_to_text_as_the_library(library, own):
    r = random.Random(4)
    for _ in range(2000):
        ids = [r.randrange(50257) for _ in range(20)]
        assert own.text(ids) == library.decode(ids, skip_special_tokens=False)
    assert own.text([-1, 60_000]) == ""


def test_long_texts_are_cut_between_words_only(library, own, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 20)
    text = "one two  three\nfour don't 12 3 é à , x " * 40
    assert len(list(bpe.pieces(text))) > 10 and "".join(bpe.pieces(text)) == text
    assert encode(own, text) == library_ids(library, [text])[0]


def test_a_full_cache_starts_afresh(library, own, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 40_000)
    text = " ".join(f"w{i} common" for i in range(2000))
    e = bpe.Encoder(own)
    assert memoryview(e.ids(text)).cast("i").tolist() == library_ids(library, [text])[0]
    assert 0 < len(e) < 300


def test_operator_round_trip(spark, library):
    docs = spark.createDataFrame([(i, t, f"s{i}", [i]) for i, t in enumerate(TEXTS)], "doc_id bigint, text string, `x.y` string, ids array<int>")
    encoded = bpe.encode(docs, PATH)
    assert encoded.columns == ["doc_id", "x.y", "ids"]
    got = {r["doc_id"]: (r["ids"], r["x.y"]) for r in encoded.collect()}
    assert got == {i: (ids, f"s{i}") for i, ids in enumerate(library_ids(library, TEXTS))}
    back = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, PATH).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 72, 99_999])], "k int, ids array<int>")
    assert [tuple(r) for r in bpe.decode(odd, PATH).orderBy("k").collect()] == [(1, ""), (2, ""), (3, library.decode([72]))]
    assert bpe.encode(docs.limit(0), PATH).collect() == []


def test_query_over_the_whole_table(spark, folder, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_byte_bpe(spark, folder).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for (key, text), ids in zip(docs.items(), library_ids(library, docs.values()), strict=True):
        want[key] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    assert got == want


def test_other_definitions_are_refused():
    with pytest.raises(ValueError):
        bpe.Bpe(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
