import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from plain import LOWER

from tallyloom.llm import queries, spelling
from tools import check

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain(docs, rule):
    """{word: (form, root, n, n_near, form_n)} by the texts that words leave when one code point is taken out."""
    counts = Counter()
    for doc_id, text in docs:
        for w in RUN.findall(text or ""):
            w = w.translate(LOWER)
            if rule.thin and doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{w}".encode())
                if h % rule.thin == 0:
                    w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    words = {w: n for w, n in counts.items() if len(w) >= rule.least and n >= rule.often}
    near, cuts = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1:]
            cuts[rest, i].add(w)
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    for same in cuts.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= rule.times * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_sql_and_plain_agree_on_the_whole_table(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = plain(rows, spelling.Rule(thin=199))
    assert found(queries.op13_spelling_variants(spark, folder)) == want
    sql = check.connect(folder).execute(queries.ORACLES["op13_spelling_variants"]).fetchall()
    assert {r[0]: r[1:] for r in sql} == want


def typos(seed, base, letters):
    r = random.Random(seed)
    for _ in range(400):
        w = r.choice(base)
        i = r.randrange(len(w) + 1)
        yield r.choice([w, w[:i] + w[i + 1:], w[:i] + r.choice(letters) + w[i:], w[:i] + r.choice(letters) + w[i + 1:]])


@pytest.mark.parametrize("split", [1, 2000])
def test_dense_small_alphabet(spark, split):
    """Nearly all words are near to others, edits fall on every place, and nodes are split."""
    r = random.Random(5)
    base = ["".join(r.choice("ab") for _ in range(r.randrange(3, 9))) for _ in range(60)]
    rows = [(i, w) for i, w in enumerate(typos(1, base, "abÀ"))]
    rule = spelling.Rule(least=3, often=1, times=2, split=split)
    assert found(spelling.variants(docs_of(spark, rows), rule)) == plain(rows, rule)


def test_short_words(spark):
    rows = [(1, "a b ab ba aab x"), (2, "a ab abc bc c ca")]
    rule = spelling.Rule(least=1, often=1, times=2)
    assert found(spelling.variants(docs_of(spark, rows), rule)) == plain(rows, rule)
    with pytest.raises(ValueError):
        spelling.variants(docs_of(spark, rows), spelling.Rule(times=1))


def test_chains_ties_and_roots(spark):
    text = "colour " * 125 + "colours " * 25 + "colourss " * 5 + "colouro " * 25 + "lonely " * 7
    rows = [(1, text)]
    got = found(spelling.variants(docs_of(spark, rows)))
    assert got == plain(rows, spelling.Rule())
    assert got["colourss"] == ("colours", "colour", 5, 1, 25) and got["lonely"] == (None, "lonely", 7, 0, None)


def test_letters_and_thinning(spark):
    rows = [(i, "ÉCOLE École naïveté NAÏVETÉ straße×xyz ab_cdefgh") for i in range(40)] + [(None, "naïvete") for _ in range(6)]
    rule = spelling.Rule(thin=7, often=1)
    assert found(spelling.variants(docs_of(spark, rows), rule)) == plain(rows, rule)


def test_edges(spark):
    long = "x" * 20_000
    rows = [(1, None), (2, ""), (3, "short"), (3, "short")] + [(4, f"{long} {long}y abcdefg")] * 5
    df = docs_of(spark, rows).selectExpr("*", "doc_id AS word", "text AS n")
    got = found(spelling.variants(df))
    assert got == plain(rows, spelling.Rule()) and got[long][3] == 1
    assert found(spelling.variants(df.filter("false"))) == {}
    assert found(spelling.variants(docs_of(spark, [(1, "alone " * 0 + "single " * 5)]))) == {"single": (None, "single", 5, 0, None)}
