"""Rows by rank without sorting the table: exact counts between splitters, refined until the rank's own key is known."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tallyloom.functions.text import quoted

_BINS = 64  # splitters of a round
_SAMPLE = 40  # sampled rows a splitter
_TIE = "_tie"
_FEW = 20_000  # so few rows of a range are looked through at once


@dataclass(frozen=True)
class Place:
    """The key at a rank: ``before`` rows have smaller keys, ``equal`` rows have this one."""

    key: Row
    before: int
    equal: int


def _key(order: Sequence[str]) -> Column:
    """The order columns as one value, nulls last."""
    return F.struct(*[x for i, c in enumerate(order) for x in (F.col(quoted(c)).isNull().alias(f"n{i}"), F.col(quoted(c)).alias(f"k{i}"))])


def _literal(df: DataFrame, order: Sequence[str], row: Row) -> Column:
    parts = []
    for i, c in enumerate(order):
        parts += [F.lit(row[f"n{i}"]).alias(f"n{i}"), F.lit(row[f"k{i}"]).cast(df.schema[c].dataType).alias(f"k{i}")]
    return F.struct(*parts)


def _inside(df: DataFrame, order: Sequence[str], above: Row | None, below: Row | None) -> DataFrame:
    """Rows with keys strictly between two.  Bounds on the first column alone come first: a scan can skip by them."""
    key, first = _key(order), F.col(quoted(order[0]))
    kind = df.schema[order[0]].dataType
    if below is not None:
        if not below["n0"]:
            df = df.filter(first <= F.lit(below["k0"]).cast(kind))
        df = df.filter(key < _literal(df, order, below))
    if above is not None:
        if not above["n0"]:
            df = df.filter((first >= F.lit(above["k0"]).cast(kind)) | first.isNull())
        df = df.filter(key > _literal(df, order, above))
    return df


def _bin(key: Column, splitters: list[Column], lo: int, hi: int) -> Column:
    """Index of a key among splitters: 2 i between number i - 1 and number i, 2 i + 1 equal to number i; by halving."""
    if lo == hi:
        return F.lit(2 * lo)
    mid = (lo + hi) // 2
    return (
        F.when(key < splitters[mid], _bin(key, splitters, lo, mid))
        .when(key > splitters[mid], _bin(key, splitters, mid + 1, hi))
        .otherwise(F.lit(2 * mid + 1))
    )


def keys_at(df: DataFrame, order: Sequence[str], ranks: Sequence[int]) -> dict[int, Place | None]:
    """The place of each rank 0, 1, 2, ... in the order of the columns, nulls last; None beyond the last row.

    A round samples the rows that may still hold a rank, takes some of their keys as splitters, and counts exactly
    how many rows lie between and on them: one aggregate of 129 numbers at most.  A rank that falls on a splitter is settled, one
    that falls between two goes on with those rows only, a small share of them.  So the table is read a few times,
    in the order columns alone, and neither sorted nor written.  Each round depends on a sample, the result does not.
    """
    places: dict[int, Place | None] = {}
    key = _key(order)
    open_ranges = {(None, None, 0, df.count()): sorted(set(ranks))}
    while open_ranges:
        (above, below, before, n), wanted = open_ranges.popitem()
        for r in [r for r in wanted if r - before >= n]:
            places[r] = None  # only the first range is open above
            wanted = [x for x in wanted if x != r]
        if not wanted:
            continue
        inside = _inside(df.select(*[quoted(c) for c in dict.fromkeys(order)]), order, above, below)
        if n <= _FEW:
            counted = inside.groupBy(key.alias("key")).agg(F.count("*").alias("n")).orderBy("key").collect()
            for r in wanted:
                at = before
                for row in counted:
                    if r < at + row["n"]:
                        places[r] = Place(row["key"], at, row["n"])
                        break
                    at += row["n"]
            continue
        sample = inside.sample(fraction=min(1.0, _BINS * _SAMPLE / n), seed=11).select(key.alias("key")).orderBy("key").limit(4 * _BINS * _SAMPLE).collect()
        keys = [r["key"] for r in sample]
        if not keys:
            keys = [inside.select(key.alias("key")).first()["key"]]
        splitters = list(dict.fromkeys(keys[(i + 1) * len(keys) // (_BINS + 1)] for i in range(_BINS)))
        place = _bin(key, [_literal(df, order, s) for s in splitters], 0, len(splitters))
        counts = {r["bin"]: r["n"] for r in inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n")).collect()}
        at = before
        for b in range(2 * len(splitters) + 1):
            size = counts.get(b, 0)
            mine = [r for r in wanted if at <= r < at + size]
            if mine and b % 2:
                places |= {r: Place(splitters[b // 2], at, size) for r in mine}
            elif mine:
                up = splitters[b // 2 - 1] if b else above
                down = splitters[b // 2] if b // 2 < len(splitters) else below
                open_ranges[(up, down, at, size)] = mine
            at += size
    return places


def rows_between(df: DataFrame, order: Sequence[str], start: int, stop: int) -> DataFrame:
    """Rows start ... stop - 1 in the order of the columns, nulls last, by the keys at both ends.

    All rows with keys between these two, and as many of those that share the first or the last key as the slice has room
    for: where order columns do not tell rows apart, a hash of the whole row does, so that a cut through many equal keys
    is found by counting too.
    """
    if stop <= start:
        return df.limit(0)
    start = max(start, 0)
    found = keys_at(df, order, [start, stop - 1])
    first, last = found[start], found[stop - 1]
    if first is None:
        return df.limit(0)
    key = _key(order)
    if last is not None and last.before == first.before:  # both ends share a key
        return _some(df.filter(key == _literal(df, order, first.key)), first.equal, min(stop, first.before + first.equal) - start)
    out = _inside(df, order, first.key, last.key if last else None)
    for end, wanted in ((first, first.before + first.equal - start), (last, stop - last.before if last else 0)):
        if end is not None:
            out = out.unionByName(_some(df.filter(key == _literal(df, order, end.key)), end.equal, wanted))
    return out


def _some(rows: DataFrame, n: int, wanted: int) -> DataFrame:
    """``wanted`` of n rows: the first ones by a hash of the row; rows that are equal throughout stand in for each other."""
    if wanted >= n:
        return rows
    if n <= _FEW or _TIE in rows.columns:
        return rows.limit(wanted)
    marked = rows.withColumn(_TIE, F.xxhash64(*[F.col(quoted(c)) for c in rows.columns]))
    return rows_between(marked, [_TIE], 0, wanted).drop(_TIE)
