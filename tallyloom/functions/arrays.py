"""Positional access on array columns, counted from 0 and from -1 backwards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def item(arr: Column, index: int) -> Column:
    return F.try_element_at(arr, F.lit(index + 1 if index >= 0 else index))


def items(arr: Column, start: int, stop: int, step: int = 1) -> Column:
    """Elements start, start+step, ... before stop; shorter arrays simply give fewer."""
    return F.filter(arr, lambda x, i: (i >= start) & (i < stop) & ((i - start) % step == 0))


def set_item(arr: Column, index: int, value: Column) -> Column:
    """Replace one element; an index outside the array leaves it unchanged."""
    if index < 0:
        return F.reverse(set_item(F.reverse(arr), -index - 1, value))
    return F.transform(arr, lambda x, i: F.when(i == index, value).otherwise(x))


def append(arr: Column, value: Column) -> Column:
    return F.array_append(arr, value)
