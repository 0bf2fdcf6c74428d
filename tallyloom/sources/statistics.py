"""Facts about Parquet tables from their footers, without reading a column."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import quoted
from tallyloom.session import materialize

# The newer Parquet reader, the only one that answers aggregates from footers.
_FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def footers(spark: SparkSession) -> Iterator[None]:
    """Plans made inside answer counts, minima and maxima from Parquet footers; the session's settings come back."""
    before = {k: spark.conf.get(k, None) for k in _FROM_FOOTERS}
    for k, v in _FROM_FOOTERS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _facts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    sums = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        sums += [F.count(quoted(c)).alias(f"n{i}"), F.min(quoted(c)).alias(f"lo{i}"), F.max(quoted(c)).alias(f"hi{i}")]
    return df.agg(*sums)


def table_facts(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(column, rows, n, lo, hi): per column the table's rows, its values that are not null, the least and the largest, as text.

    Counts and bounds come from the row groups' statistics.  Where these do not tell (texts may be cut short in them, NaN is
    left out of them, some writers have none), the columns are read instead, with the same result.  An empty table has 0 rows and null bounds.
    """
    exact = {f.name for f in spark.read.parquet(path).schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "date", "boolean")}
    facts = None
    if set(columns) <= exact:
        try:
            with footers(spark):
                facts = materialize(_facts(spark.read.parquet(path), columns), "facts")
        except PySparkException as e:
            if "aggregatePushdown" not in str(e) and "statistics" not in str(e).lower():
                raise
    if facts is None:
        facts = materialize(_facts(spark.read.parquet(path), columns), "facts")
    none = F.lit(0).cast("bigint")  # a file without row groups has no counts either
    parts = F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce("rows", none).alias("rows"), F.coalesce(f"n{i}", none).alias("n"), F.col(f"lo{i}").cast("string").alias("lo"), F.col(f"hi{i}").cast("string").alias("hi"))
        for i, c in enumerate(columns)
    ])
    return facts.select(F.inline(parts))
