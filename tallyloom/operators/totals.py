"""Total rows of the canonical fact: (feature_value, brand, impressions, mvpd, data_type)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.aggregates import exact_sum, group_sum, keyed

FACT = ["feature_value", "brand", "impressions", "mvpd", "data_type"]
SUMMARY = "Summary"


def cuts_of(names: tuple[str, str] = ("data_type", "feature_value"), **features: Column | str):
    """Generator column giving one (data_type, feature_value) row per cut, e.g. ``cuts_of(Day=day)``."""
    cut_name, feature_name = names
    return F.inline(
        F.array(*[
            F.struct(F.lit(cut).alias(cut_name), (F.lit(f) if isinstance(f, str) else f).alias(feature_name))
            for cut, f in features.items()
        ])
    )


def feature_totals(fact: DataFrame) -> DataFrame:
    """Per cut and feature, over all providers."""
    return group_sum(fact, ["data_type", "feature_value", "brand"]).withColumn("mvpd", F.lit("Total")).select(*FACT)


def cut_totals(fact: DataFrame) -> DataFrame:
    """Per provider and cut, over all features."""
    return group_sum(fact, ["mvpd", "data_type", "brand"]).withColumn("feature_value", F.lit("Total")).select(*FACT)


def with_totals(fact: DataFrame) -> DataFrame:
    """The fact and all of its total rows from one pass and one shuffle.

    Grouping sets give each (cut, provider, feature), the sum over providers, over features and over
    both.  The summary cut consists of totals already, so it gets no further row over its features.
    """
    rows = keyed(fact, ["data_type", "mvpd", "feature_value", "brand"])
    t, m, f, b = (F.col(c) for c in ("data_type", "mvpd", "feature_value", "brand"))
    sums = rows.groupingSets([[b, t, m, f], [b, t, f], [b, t, m], [b, t]], b, t, m, f).agg(
        exact_sum("impressions").alias("impressions"),
        F.grouping("mvpd").alias("_all_mvpd"),
        F.grouping("feature_value").alias("_all_features"),
    )
    return sums.filter((F.col("_all_features") == 0) | (F.col("data_type") != SUMMARY)).select(
        F.when(F.col("_all_features") == 1, "Total").otherwise(F.col("feature_value")).alias("feature_value"),
        "brand",
        "impressions",
        F.when(F.col("_all_mvpd") == 1, "Total").otherwise(F.col("mvpd")).alias("mvpd"),
        "data_type",
    )


def append_total_row(df: DataFrame, label_column: str, *measures: str, label: str = "Total", by: tuple[str, ...] = ()) -> DataFrame:
    """Add a row (one per ``by`` group) with the sums of the measures."""
    sums = df.groupBy(*by).agg(*[exact_sum(m).alias(m) for m in measures]).withColumn(label_column, F.lit(label))
    return df.unionByName(sums)
