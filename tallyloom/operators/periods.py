"""Joins of points with any table of periods, by bins instead of comparisons of everything with everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import quoted
from tallyloom.session import materialize

# More periods than this may not fit a broadcast, so bins with many points are measured and split.
_FEW = 100_000


def _number(c: Column, kind: T.DataType) -> Column:
    """A point of time or a number as a long that keeps the order."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, (T.IntegralType, T.DecimalType, T.FractionalType)):
        return F.floor(c).cast("bigint")
    raise TypeError(f"periods of {kind.simpleString()} are not supported")


def join_periods(
    points: DataFrame, periods: DataFrame, point: str, start: str, end: str, by: Sequence[str] = (), how: str = "inner", split: int = 1_000_000
) -> DataFrame:
    """Points with every period of their ``by`` group that they lie in, first and last day included.

    Periods may be uneven, overlap and leave gaps: a point in several gets a row for each, one in none is left out, or
    kept with nulls where ``how`` is 'left'.  Null points and bounds, and periods that end before they start, match nothing;
    null ``by`` values match nothing.  ``by`` columns appear once, in front.

    A period lies in the two bins at most of the first power of two that is not below its length, so it is two rows however long it is.
    A point looks into one bin per size that occurs (at most 63).  Both meet in an equi-join on group, size and bin, and
    the bounds are checked there.  The periods are written first, so Spark broadcasts them if they are small; with more
    of them, bins with more than ``split`` points are measured, and their points dealt over copies of their periods.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    kind = periods.schema[start].dataType
    by = list(by)
    own = [c for c in periods.columns if c not in by]
    own_names = [c for c in points.columns if c not in by]
    if clash := set(own) & set(points.columns):
        raise ValueError(f"both sides have {sorted(clash)}")
    a, b = _number(F.col(quoted(start)), kind), _number(F.col(quoted(end)), periods.schema[end].dataType)
    sized = periods.filter(F.col(quoted(start)) <= F.col(quoted(end))).withColumns({"_a": a, "_b": b})
    sized = sized.withColumn("_size", F.ceil(F.log2(F.greatest(F.col("_b") - F.col("_a"), F.lit(1)).cast("double"))).cast("int"))
    sized = sized.withColumns({"_lo": F.expr("shiftright(_a, _size)"), "_hi": F.expr("shiftright(_b, _size)")})
    binned = materialize(sized.withColumn("_bin", F.explode(F.sequence("_lo", "_hi"))).drop("_a", "_b", "_lo", "_hi"), "periods")
    sizes = [r["_size"] for r in binned.groupBy("_size").count().collect()]  # at most 63 numbers
    n = binned.count()
    rows = points if how == "inner" else materialize(points.withColumn("_rid", F.monotonically_increasing_id()), "points")
    at = _number(F.col(quoted(point)), points.schema[point].dataType)
    bins = F.array(*[F.struct(F.lit(s).alias("_size"), F.expr("shiftright(_at, %d)" % s).alias("_bin")) for s in sorted(sizes)])
    looking = rows.withColumn("_at", at).filter("_at is not null")
    looking = looking.select("*", F.inline(bins)).drop("_at") if sizes else looking.limit(0).drop("_at").withColumns({"_size": F.lit(0), "_bin": F.lit(0).cast("bigint")})
    keys = [*by, "_size", "_bin"]
    if n > _FEW:
        full = looking.groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("_n")).filter(F.col("_n") > split)
        full = materialize(full.select(*[quoted(k) for k in keys], F.ceil(F.col("_n") / split).cast("int").alias("_copies")), "full_bins")
        binned = binned.join(full, keys, "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1))).drop("_copies")
        own_copy = F.pmod(F.xxhash64(*[quoted(c) for c in rows.columns]), F.coalesce("_copies", F.lit(1)))
        looking = looking.join(full, keys, "left").withColumn("_copy", own_copy.cast("int")).drop("_copies")
        keys.append("_copy")
    met = looking.join(binned, keys).filter(F.col(quoted(point)).between(F.col(quoted(start)), F.col(quoted(end))))
    columns = [quoted(c) for c in [*by, *own_names, *own]]
    if how == "inner":
        return met.select(*columns)
    lone = rows.join(met.select("_rid").distinct(), "_rid", "left_anti")
    lone = lone.withColumns({c: F.lit(None).cast(periods.schema[c].dataType) for c in own})
    return met.select(*columns).unionByName(lone.select(*columns))
