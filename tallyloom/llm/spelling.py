"""Spelling variants: words one edit apart, found by walking a trie that is a table of edges, level by level."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import frugal, lower_ascii, materialize, mixed

# Fixed value: what a run of letters is made of.
LETTERS = r"A-Za-zÀ-ÿ"

_BASE = 0x9E3779B97F4A7C15
_TOP = "^"  # before every word as it is read, so that words may differ in their first letter


@dataclass(frozen=True)
class Rule:
    """Words have at least ``least`` code points and ``often`` occurrences; a form has ``times`` its word's number.

    With ``thin``, a run loses one code point in those documents where the crc32 of '<id>:<run>' is a multiple of it.  A trie
    node with more than ``split`` words below is kept in several copies, its states dealt over them.
    """

    least: int = 6
    often: int = 5
    times: int = 5
    thin: int | None = None
    split: int = 2000


def thinned(run: Column, doc_id: Column, one_in: int) -> Column:
    """The run without code point h % length where ``one_in`` divides h, the crc32 of '<doc_id>:<run>'."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run))
    n = F.length(run)
    at = (h % n).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, n))).otherwise(run)


def word_counts(docs: DataFrame, rule: Rule = Rule(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n) over all texts.  Counted in the tasks that read the texts before anything is shuffled."""
    runs = F.regexp_extract_all(lower_ascii(F.col(text_column)), F.lit(f"[{LETTERS}]{{{rule.least},}}"), F.lit(0))
    words = docs.select(F.col(id_column).alias("id"), F.explode(runs).alias("word"))
    if rule.thin:
        words = words.select(thinned(F.col("word"), F.col("id"), rule.thin).alias("word")).filter(F.length("word") >= rule.least)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= rule.often)


# The trie.  Words are read forwards (side 0) and backwards (side 1); each side has its own nodes.

def _prefixes(words: DataFrame, top: int) -> DataFrame:
    """(wid, side, depth, h, next): every prefix of ``top`` or more code points by its hash, and the code point after it (0 at the end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for side in (0, 1):
                texts = [_TOP + (w[::-1] if side else w) for w in batch.column("word").to_pylist()]
                size = np.array([len(t) for t in texts], np.int64)
                code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
                ends = np.cumsum(size)
                start = np.repeat(ends - size, size)
                place = np.arange(len(code)) - start
                power = np.multiply.accumulate(np.array([1] + [_BASE] * int(size.max(initial=0)), np.uint64))
                sums = np.concatenate([[np.uint64(0)], np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power[place])])
                depth = place + 1
                h = mixed(sums[1:] - sums[start] + mixed(depth.astype(np.uint64) * np.uint64(2) + np.uint64(side)))
                after = np.concatenate([code[1:], [0]]).astype(np.int32) if len(code) else np.zeros(0, np.int32)
                after[ends - 1] = 0
                keep = depth >= top
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(batch.column("wid").to_numpy(), size)[keep]), pa.array(np.full(int(keep.sum()), side, np.int32)),
                    pa.array(depth[keep].astype(np.int32)), pa.array(h[keep].view(np.int64)), pa.array(after[keep]),
                ], ["wid", "side", "depth", "h", "next"])

    return words.select("wid", "word").mapInArrow(frugal(run), "wid bigint, side int, depth int, h bigint, next int")


def _paths(words: DataFrame, rule: Rule) -> DataFrame:
    """(wid, side, r, path): each word as read and its nodes from the top, as (depth, h, copies, mask).

    A node is a prefix after which words go on differently, the prefix of the least depth, or a whole word; so chains of
    single children are one edge.  ``mask`` has a bit for each code point, modulo 64, that may follow.
    """
    top = len(_TOP) + rule.least // 2
    rows = materialize(_prefixes(words, top), "prefixes")
    bit = F.expr("CASE WHEN next > 0 THEN shiftleft(1L, next % 64) ELSE 0L END")
    nodes = rows.groupBy("h").agg(
        F.min("next").alias("lo"), F.max("next").alias("hi"), F.min("depth").alias("d"), F.count("*").alias("weight"), F.bit_or(bit).alias("mask")
    )
    nodes = nodes.filter((F.col("lo") != F.col("hi")) | (F.col("d") == top)).select("h", F.ceil(F.col("weight") / rule.split).cast("int").alias("copies"), "mask")
    on_path = rows.join(nodes, "h", "left").filter(F.col("copies").isNotNull() | (F.col("next") == 0))
    node = F.struct("depth", "h", F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask"))
    path = on_path.groupBy("wid", "side").agg(F.sort_array(F.collect_list(node)).alias("path"))
    read = F.concat(F.lit(_TOP), F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")))
    return materialize(path.join(words.select("wid", "word"), "wid").select("wid", "side", read.alias("r"), "path"), "paths")


def _edges(paths: DataFrame) -> DataFrame:
    """(level, parent, salt, label, child, copies, mask, word): the trie, an edge in as many copies as its parent has.

    A node has at most one edge for each letter.  ``word`` is the word that ends at the child, if one does.
    """
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("path") - 2),
        lambda i: F.struct(i.alias("level"), F.get("path", i).alias("up"), F.get("path", i + 1).alias("down")),
    )
    e = paths.filter(F.size("path") > 1).select("wid", "r", F.explode(pairs).alias("e"))
    e = e.select(
        "e.level", F.col("e.up.h").alias("parent"), F.col("e.up.copies").alias("times"),
        F.substring("r", F.col("e.up.depth") + 1, F.col("e.down.depth") - F.col("e.up.depth")).alias("label"),
        F.col("e.down.h").alias("child"), F.col("e.down.copies").alias("copies"), F.col("e.down.mask").alias("mask"),
        F.when(F.col("e.down.depth") == F.length("r"), F.col("wid")).alias("word"),
    )
    e = e.groupBy("level", "parent", "times", "label", "child", "copies", "mask").agg(F.max("word").alias("word"))
    return materialize(e.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("times") - 1))).drop("times"), "edges")


def _half(size: Column) -> Column:
    """How much of a word, read as it is, has to be behind before the edit; what one side leaves out is the other's."""
    letters = size - len(_TOP)
    first = F.floor(letters / 2)
    return len(_TOP) + F.when(F.col("side") == 0, first).otherwise(letters - first)


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """All ways of states over one edge; (word, position, node, edits) and the word found, if one ends there.

    A state without edits goes on along its own word, or spends its edit in the edge's label: a replaced code point, or
    one of its own left out.  Edits wait until half of the word is behind, as the other side sees to that half.
    """
    n, size = F.length("label"), F.length("r")
    own = F.substring("r", F.col("pos") + 1, n)
    longer = F.substring("r", F.col("pos") + 1, n + 1)
    half = _half(size)
    to, fresh = F.col("pos") + n, F.col("edits") == 0

    def goes_on(at: Column) -> Column:
        code = F.ascii(F.substring("r", at + 1, F.lit(1)))
        return F.when(at == size, F.col("word").isNotNull()).otherwise(F.call_function("shiftright", F.col("mask"), code % 64).bitwiseAND(F.lit(1)) == 1)

    same = (own == F.col("label")) & (fresh & (to < size) | ~fresh & goes_on(to))
    replaced = fresh & (to > half) & (to <= size) & (own != F.col("label")) & goes_on(to) & (F.levenshtein(own, "label", 1) == 1)
    left_out = fresh & (to >= half) & (to < size) & goes_on(to + 1) & (F.levenshtein(longer, "label", 1) == 1)

    def way(when: Column, at: Column, edits: Column) -> Column:
        return F.when(when, F.struct(at.alias("pos"), edits.cast("int").alias("edits")))

    spread = states.withColumn("salt", F.pmod(F.xxhash64("wid"), F.col("times")).cast("int"))
    met = spread.join(edges, (F.col("node") == F.col("parent")) & (spread["salt"] == edges["salt"]) & (same | replaced | left_out))
    ways = F.array_compact(F.array(way(same, to, F.col("edits")), way(replaced, to, F.lit(1)), way(left_out, to + 1, F.lit(1))))
    out = met.select("wid", "side", "r", "child", "copies", "word", F.explode(ways).alias("w"))
    return out.select(
        "wid", "side", "r", "w.pos", F.col("child").alias("node"), F.col("copies").alias("times"), "w.edits",
        F.when((F.col("w.pos") == F.length("r")) & (F.col("w.edits") == 1), F.col("word")).alias("found"),
    )


def near_words(words: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(a, b): the wids of every two words one edit apart, both ways round, from (wid, word).

    The frontier of all words goes down the trie one level a round: joined with the level's edges, written, and read by
    the next round, so there are as many rounds as nodes lie on the longest way down.  A word may change one code point or
    leave one out; that the other one then has it too much is the same pair seen from there.  Words read forwards keep
    their first half, backwards their last, so all walk far down before the ways part.  Nodes are known by hashes;
    pairs are confirmed on the words at the end.
    """
    paths = _paths(words, rule)
    edges = _edges(paths)
    # Above the end of any word that the last letter left out would give.
    start = F.greatest(F.least(_half(F.length("r")), F.length("r") - 2), F.lit(len(_TOP)))
    at = F.size(F.filter("path", lambda p: p["depth"] <= start)) - 1
    seeds = paths.select("wid", "side", "r", at.alias("level"), F.get("path", at).alias("p")).select(
        "wid", "side", "r", F.col("p.depth").alias("pos"), F.col("p.h").alias("node"), F.col("p.copies").alias("times"), F.lit(0).alias("edits"), "level"
    )
    seeds = materialize(seeds, "seeds")
    last = edges.agg(F.max("level")).first()[0]
    frontier, found = None, []
    for level in range(0 if last is None else last + 1):
        states = seeds.filter(F.col("level") == level).drop("level")
        states = states if frontier is None else states.unionByName(frontier)
        reached = materialize(_step(states, edges.filter(F.col("level") == level)), "frontier")
        frontier = reached.filter((F.col("pos") < F.length("r")) & F.col("found").isNull()).drop("found")
        found.append(reached.filter("found is not null").select(F.col("wid").alias("a"), F.col("found").alias("b")))
    if not found:
        return words.sparkSession.createDataFrame([], "a bigint, b bigint")
    one_way = reduce(DataFrame.unionByName, found)
    pairs = one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    left, right = (words.select(F.col("wid").alias(c), F.col("word").alias(f"w{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").filter(F.levenshtein("wa", "wb", 1) == 1).select("a", "b")


def _roots(forms: DataFrame) -> DataFrame:
    """(wid, root): the last word that forms lead to, by pointer jumping; a form is more frequent, so there are no circles."""
    now = materialize(forms, "forms")
    while True:
        onward = now.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        now = materialize(now.join(onward, "root", "left").select("wid", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(docs: DataFrame, rule: Rule = Rule(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the texts that is long and frequent enough.

    Words are runs of letters with A-Z in lower case.  A word's form is the most frequent of the words one inserted,
    deleted or replaced code point away (ties: smallest in code-point order), if it is ``times`` as frequent; its root is
    where forms lead in the end, itself without a form.  Null and empty texts have no words; a null id never thins a run;
    repeated rows count again; very long texts and runs are taken whole.  No words give no rows.  Other columns are not read.
    """
    if rule.least < 1 or rule.times <= 1:
        raise ValueError("words need a letter, and forms have to be more frequent")
    words = materialize(word_counts(docs, rule, id_column, text_column).withColumn("wid", F.monotonically_increasing_id()), "words")
    pairs = near_words(words, rule)
    other = words.select(F.col("wid").alias("b"), F.col("word").alias("near"), F.col("n").alias("m"))
    best = pairs.join(other, "b").groupBy(F.col("a").alias("wid")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near", "b")).alias("best")
    )
    fits = -F.col("best.less") >= rule.times * F.col("n")
    linked = words.join(best, "wid", "left").select(
        "wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"), F.when(fits, F.col("best.b")).alias("to"),
    )
    linked = materialize(linked, "linked")
    ends = _roots(linked.filter("to is not null").select("wid", F.col("to").alias("root")))
    named = ends.join(words.select(F.col("wid").alias("root"), F.col("word").alias("last")), "root").select("wid", "last")
    return linked.join(named, "wid", "left").select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n")
