"""Fuzzy line deduplication (native): minima of hashed character 5-grams find line pairs, edit similarity confirms them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import components, materialize, without

ADDED = ("n_lines", "n_kept")

# Characters of a gram; bits kept of a minimum, and minima to a long, for the estimate.
_GRAM = 5
_BITS, _PER = 5, 12
_ONES = sum(1 << (_BITS * i) for i in range(_PER))
_MASK = (1 << 63) - 1


@dataclass(frozen=True)
class Rule:
    """Lines are linked if 100 * (1 - edits / length of the longer) >= percent, on normalised lines.

    Candidates share one of ``bands`` pairs of minima and agree in ``agree`` of 36 minima.  Buckets above ``block`` lines
    are cut into pairs of blocks.
    """

    percent: int = 80
    bands: int = 24
    agree: int = 5
    block: int = 512


def normalised(text: Column) -> Column:
    """Lower case, runs of anything but letters and digits as one space; line ends stay."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, a, b, line) for every line that has a word; (a, b) is the line's 128-bit hash."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split(normalised(F.col("text")), "\n")).alias("line_no", "line"))
    line = F.trim("line")
    return lines.select("doc_id", "text_hash", "line_no", F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"), line.alias("line")).filter("line <> ''")


def grams(line: Column, kind: Column) -> Column:
    """Character 5-grams: of kind 1 those at the start of a word, of kinds 0 and 2 all."""
    every = F.regexp_extract_all(F.concat(F.lit("    "), line, F.lit("    ")), F.lit("(?=(.{5}))"), F.lit(1))
    starts = F.regexp_extract_all(F.concat(F.lit(" "), line, F.lit("     ")), F.lit("(?<= )(?=(.{5}))"), F.lit(1))
    return F.when(kind == 1, starts).otherwise(every)


def kinds(line: Column) -> Column:
    """Which grams sign a line: all (0) to 60 characters, word starts (1) from 48, and all again (2) if words are long.

    The lengths overlap by more than two linked lines can differ, so both lines of a pair have a kind in common.
    """
    n = F.length(line)
    words = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    some = F.array(F.when(n <= 60, 0), F.when(n >= 48, 1), F.when((n >= 48) & (12 * words < n), 2))
    return F.array_compact(some)


def signatures(texts: DataFrame, rule: Rule) -> DataFrame:
    """(a, n, kind, w0, w1, w2, keys): length, low bits of 36 minima, and band keys of every line and kind.

    A minimum is that of the gram hashes xor a constant, so the chance that two lines agree in it is the share of
    grams they have in common.  All grams of a line are summed up in the task that holds the line.
    """
    count = 2 * rule.bands
    rows = texts.repartition("a").withColumn("kind", F.explode(kinds(F.col("line"))))
    rows = rows.select("a", F.length("line").alias("n"), "kind", F.explode(grams(F.col("line"), F.col("kind"))).alias("gram"))
    rows = rows.withColumn("h", F.xxhash64("gram").bitwiseAND(F.lit(_MASK)))
    least = [F.min(F.col("h").bitwiseXOR(F.lit((i * 0x9E3779B97F4A7C15) & _MASK))).alias(f"m{i}") for i in range(count)]
    out = rows.groupBy("a", "kind").agg(F.first("n").alias("n"), *least)
    low = [F.shiftleft(F.col(f"m{i}").bitwiseAND(F.lit((1 << _BITS) - 1)), _BITS * (i % _PER)) for i in range(3 * _PER)]
    words = []
    for i in range(3):
        word = low[i * _PER]
        for x in low[i * _PER + 1:(i + 1) * _PER]:
            word = word.bitwiseOR(x)
        words.append(word.alias(f"w{i}"))
    keys = [F.xxhash64("kind", F.lit(i), f"m{i}", f"m{i + rule.bands}") for i in range(rule.bands)]
    return out.select("a", "n", "kind", *words, F.array(*keys).alias("keys"))


def _agree(left: str, right: str) -> Column:
    """How many of the 36 minima have equal low bits."""
    total = F.lit(0)
    for i in range(3):
        d = F.col(f"{left}w{i}").bitwiseXOR(F.col(f"{right}w{i}"))
        folded = d
        for j in range(1, _BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(d, j))
        total = total + _PER - F.bit_count(folded.bitwiseAND(F.lit(_ONES)))
    return total


def _close(left: str, right: str, rule: Rule) -> Column:
    x, y = F.col(f"{left}n"), F.col(f"{right}n")
    return (100 * F.least(x, y) >= rule.percent * F.greatest(x, y)) & (_agree(left, right) >= rule.agree)


def linked_lines(texts: DataFrame, rule: Rule) -> DataFrame:
    """(node, component) over the hashes ``a`` of distinct lines that are linked to others.

    In a bucket every line is first paired with one hub, so a bucket gives a pair a line.  Confirmed pairs
    make components; then only lines of one bucket that are still in different components are paired, block by block.
    """
    signed = materialize(signatures(texts, rule), "line_signatures")
    about = ["n", "w0", "w1", "w2"]
    keys = signed.select("a", "kind", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("a").alias("hub")).filter("size > 1")
    members = materialize(keys.join(shared, "key"), "line_buckets")

    def side(name: str) -> DataFrame:
        return signed.select(F.col("a").alias(name), "kind", *[F.col(c).alias(f"{name}_{c}") for c in about])

    first = members.filter("a <> hub").select(F.col("hub").alias("x"), F.col("a").alias("y"), "kind").distinct()
    first = first.join(side("x"), ["x", "kind"]).join(side("y"), ["y", "kind"]).filter(_close("x_", "y_", rule))
    first = materialize(first.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "line_pairs")

    def confirmed(pairs: DataFrame) -> DataFrame:
        near = pairs.join(texts.select(F.col("a").alias("x"), F.col("line").alias("p")), "x").join(texts.select(F.col("a").alias("y"), F.col("line").alias("q")), "y")
        longer, shorter = F.greatest(F.length("p"), F.length("q")), F.least(F.length("p"), F.length("q"))
        near = near.filter(100 * shorter >= rule.percent * longer).withColumn("most", F.floor(longer * (100 - rule.percent) / 100).cast("int"))
        return near.filter(F.expr("levenshtein(p, q, most) >= 0")).select(F.col("x").alias("a"), F.col("y").alias("b"))

    links = materialize(confirmed(first), "line_links")
    labels = components(links, "line_labels")
    own = members.join(labels.withColumnRenamed("node", "a"), "a", "left").select("key", "a", "kind", "size", F.coalesce("component", "a").alias("c"))
    spread = own.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("key")
    own = own.join(spread, "key", "left_semi").join(signed.drop("keys"), ["a", "kind"])
    own = materialize(_blocked(own, rule), "line_open")
    l = own.select(F.col("group"), F.col("side"), *[F.col(c).alias(f"l_{c}") for c in ("a", "c", *about)])
    r = own.select(F.col("group").alias("group_r"), F.col("side").alias("side_r"), *[F.col(c).alias(f"r_{c}") for c in ("a", "c", *about)])
    apart = (F.col("group") == F.col("group_r")) & (F.col("l_c") < F.col("r_c")) & ((F.col("side") == 0) | (F.col("side") != F.col("side_r"))) & _close("l_", "r_", rule)
    second = l.join(r, apart).select(F.least("l_a", "r_a").alias("x"), F.greatest("l_a", "r_a").alias("y")).distinct()
    later = materialize(confirmed(second.join(first, ["x", "y"], "left_anti")), "line_links")
    return labels if later.isEmpty() else components(links.unionByName(later), "line_labels")


def _blocked(members: DataFrame, rule: Rule) -> DataFrame:
    """Members by ``group``, a pair of blocks of their bucket; side 0 is a block with itself, 1 and 2 are two blocks."""
    m = members.withColumn("blocks", F.ceil(F.col("size") / rule.block)).withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return m.withColumn("group", group).withColumn("side", side).drop("key", "size", "blocks", "own", "other", "kind")


def dedup_lines(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Documents with n_lines, n_kept and text, in which each group of linked lines is kept once.

    Lines are compared as normalised; of a group (equal lines, and lines joined by links) the occurrence with the
    smallest doc_id, then line number, stays.  Lines without letter or digit always stay.  Null texts stay null with
    0 lines, an empty text is one empty line; rows with equal doc_id and text are one document, a null doc_id comes
    before others; present columns with the added names are replaced.
    """
    found = occurrences(docs)
    signed = materialize(found.drop("line"), "line_hashes")
    texts = materialize(found.groupBy("a").agg(F.first("line").alias("line")), "line_texts")
    labels = linked_lines(texts, rule)
    # Groups by component, or by the line's own hash; of those with more than one occurrence all but the first go.
    marked = signed.join(labels.withColumnRenamed("node", "a"), "a", "left")
    marked = marked.select("doc_id", "text_hash", "line_no", F.coalesce("component", "a").alias("group"), F.when(F.col("component").isNull(), F.col("b")).alias("b"))
    by = ["group", "b"]
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    heads = marked.groupBy(*by).agg(F.min(order).alias("head"), F.count("*").alias("n")).filter("n > 1")
    heads = materialize(heads.select(F.col("group").alias("g"), F.col("b").alias("h"), "head"), "line_heads")
    many = marked.join(heads, (F.col("group") == F.col("g")) & F.col("b").eqNullSafe(F.col("h")))
    start = many.filter(order == F.col("head")).groupBy("g", "h").agg(F.min("line_no").alias("keep_no"))
    start = start.select(F.col("g").alias("g2"), F.col("h").alias("h2"), "keep_no")
    gone = many.join(start, (F.col("g") == F.col("g2")) & F.col("h").eqNullSafe(F.col("h2"))).filter((order != F.col("head")) | (F.col("line_no") != F.col("keep_no")))
    gone = gone.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.collect_set("line_no").alias("_gone"))
    base = without(docs, *ADDED).withColumn("_t", F.xxhash64("text"))
    out = base.join(gone, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("_t").eqNullSafe(F.col("_h")), "left")
    parts = F.split("text", "\n")
    kept = F.filter(parts, lambda _, i: ~F.coalesce(F.array_contains("_gone", i), F.lit(False)))
    return out.withColumns({
        "n_lines": F.coalesce(F.size(parts), F.lit(0)).cast("bigint"),
        "n_kept": F.coalesce(F.size(parts), F.lit(0)).cast("bigint") - F.coalesce(F.size("_gone"), F.lit(0)),
        "text": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
    }).drop("_d", "_h", "_t", "_gone")
