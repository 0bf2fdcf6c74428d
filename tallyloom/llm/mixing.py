"""Mixing sources to target weights (native)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import SPACE, materialize, quoted, without

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = "mix-1"

ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, take the weights in turn.  ``share`` of all sizes is dealt out by
    weight; no source gets more than ``cap`` times its size, and what it can't take is dealt to the others by
    weight again.  The sources that fill up are those with the least size per weight, so one running sum in
    that order gives the level at which the rest settle.  One row per source: the windows hold no documents.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    each = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("weight", F.element_at(each, (place % len(weights) + 1).cast("int")))
    s = s.withColumn("limit", F.lit(float(cap)) * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    s = s.withColumn("level", left / F.sum("weight").over(rest)).withColumn("row", F.row_number().over(order))
    s = s.withColumn("settled", F.min(F.when(F.col("level") <= F.col("ratio"), F.col("row"))).over(every))
    s = s.withColumn("final", F.min(F.when(F.col("row") == F.col("settled"), F.col("level"))).over(every))
    target = F.when(F.col("final").isNull() | (F.col("row") < F.col("settled")), F.col("limit")).otherwise(F.col("final") * F.col("weight"))
    return s.select("source", "source_size", target.alias("target"))


def coin(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the hash of a key: 52 bits of its md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """Every document with size, source_size, target of its source, copies and taken words.

    copies = floor(rate) plus one more with the probability of the fraction, rate being target / source_size; the
    coin is a hash of doc_id, so reruns agree and rows that repeat a doc_id agree too.  A null doc_id is a value
    like any other.  Sizes are summed per source before anything is shuffled, and the sums (one row per source)
    are written, so that Spark joins them by their measured size: broadcast, or shuffled with the skewed source
    split.  Empty texts and sources of size 0 take nothing: rate 0.  Columns named like the added ones are replaced.
    """
    sized = without(docs, *ADDED).withColumn("size", word_count(F.col("text")))
    # Sizes come from a scan of the two columns that they need.
    sums = docs.select("source", word_count(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sums, weights, share, cap).withColumnRenamed("source", "_source"), "targets")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    more = F.when(coin(F.col("doc_id"), seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn("copies", (F.floor(rate) + more).cast("bigint")).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as often as ``mix_plan`` says, with the columns it came with, whatever they are called."""
    rows = docs.select("doc_id", "source", "text", F.struct(*[quoted(c) for c in docs.columns]).alias("_row"))
    planned = mix_plan(rows, **options).filter("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return planned.select("_row.*")
