"""Long to wide and back."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import quoted


def pivot_sum(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], measure: str) -> DataFrame:
    """One column per listed value; the list is given so that no extra job looks for it."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(F.sum(measure))


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def stack_column_groups(df: DataFrame, ids: Sequence[str], words: Sequence[str]) -> DataFrame:
    """Repeated column groups to rows: Daypart.1, Start.1, ..., Daypart.2, Start.2, ... -> Daypart, Start, ...

    Columns belong to a word when their name contains it.  Names that all end in a number pair up by it, others in
    column order; the last word, the measure, may have surplus columns in front, such as a total.  Any other mismatch
    raises.  Rows with a gap in the group drop out.
    """
    found = [[c for c in df.columns if w.lower() in c.lower()] for w in words]
    ends = [[re.search(r"(\d+)$", c) for c in f] for f in found]
    if all(e for f in ends for e in f):
        by_number = [{int(e[1]): c for e, c in zip(es, f, strict=True)} for es, f in zip(ends, found, strict=True)]
        wanted = sorted(by_number[0])
        surplus = set(by_number[-1]) - set(wanted)
        if any(set(n) != set(wanted) for n in by_number[:-1]) or set(wanted) - set(by_number[-1]) or any(len(n) != len(f) for n, f in zip(by_number, found, strict=True)) or surplus & set(wanted):
            raise ValueError(f"column groups do not match: {found}")
        found = [[n[i] for i in wanted] for n in by_number]
    else:
        groups = len(found[0])
        if any(len(f) != groups for f in found[:-1]) or len(found[-1]) < groups:
            raise ValueError(f"column groups do not match: {found}")
        found[-1] = found[-1][-groups:] if groups else []
    if not found[0]:
        raise ValueError(f"no columns for {list(words)}")
    records = [F.struct(*[F.col(quoted(f[g])).alias(w) for w, f in zip(words, found, strict=True)]) for g in range(len(found[0]))]
    long = df.select(*ids, F.explode(F.array(*records)).alias("_record")).select(*ids, "_record.*")
    return long.dropna(subset=list(words))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Append; columns match by name and missing ones are null."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
