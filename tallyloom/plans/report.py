"""The merged fact of all providers and the report cuts made from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar as cal
from tallyloom.operators.joins import lookup
from tallyloom.operators.reshape import pivot_sum
from tallyloom.operators.totals import SUMMARY, with_totals
from tallyloom.plans.reach import REACH_TYPE
from tallyloom.session import materialize

METRICS = ["feature_value", "brand", "metric", "mvpd", "data_type", "metric_type", "column_name"]
TOTAL = "Total"
# Cut name -> data type of its rows.
FEATURE_CUTS = {"Dayparts": "Daypart", "Networks": "Network", "Market": "Market", "Day of Week": "Day", "Week": "Week"}


def merged_fact(fact: DataFrame, reach: DataFrame | None = None) -> DataFrame:
    """Provider rows with all totals, reach and frequency rows, and the report column each belongs to."""
    rows = with_totals(fact).select(
        "feature_value", "brand", F.col("impressions").cast("double").alias("metric"), "mvpd", "data_type",
        F.lit("Impressions").alias("metric_type"),
    )
    if reach is not None:
        rows = rows.unionByName(reach)
    return rows.withColumn("column_name", F.concat("mvpd", F.lit(" "), "metric_type")).select(*METRICS)


def report_columns(providers: Sequence[str], metric_types: Sequence[str] = ("Impressions", "Reach", "Frequency")) -> list[str]:
    return [f"{p} {m}" for m in metric_types for p in [*providers, TOTAL]]


def report_cuts(fact: DataFrame, dma_codes: DataFrame, providers: Sequence[str]) -> dict[str, DataFrame]:
    """The six report tables, one column per provider and metric.

    All cuts are pivoted in one aggregate whose result, one row per feature and brand, is written once;
    each cut then reads its own rows instead of going back to the inputs.
    """
    columns = report_columns(providers)
    impressions = report_columns(providers, ["Impressions"])
    wide = materialize(pivot_sum(fact, ["data_type", "feature_value", "brand"], "column_name", columns, "metric"), "cuts")

    summary = wide.filter((F.col("feature_value") == TOTAL) & (F.col("data_type") != SUMMARY)).select(
        F.col("data_type").alias("cut"), "brand", *columns
    ).fillna(0.0, subset=columns)
    cuts = {"Summary": summary}
    for cut, data_type in FEATURE_CUTS.items():
        cuts[cut] = wide.filter(F.col("data_type") == data_type).select("feature_value", "brand", *impressions)
    codes = dma_codes.select("corrected_dma", "dma_code").distinct()
    cuts["Market"] = lookup(cuts["Market"], codes, "feature_value", "corrected_dma")
    return cuts


def in_report_order(name: str, cut: DataFrame) -> DataFrame:
    """Reach last in the summary, weekdays Monday to Sunday, total rows at the end."""
    if name == "Summary":
        return cut.orderBy("brand", F.col("cut") == REACH_TYPE, "cut")
    if name == "Day of Week":
        return cut.orderBy("brand", cal.day_rank(F.col("feature_value")).asc_nulls_last())
    return cut.orderBy("brand", F.col("feature_value") == TOTAL, "feature_value")


def report_totals_only(fact: DataFrame, dma_codes: DataFrame) -> dict[str, DataFrame]:
    """The same tables without the single providers."""
    return report_cuts(fact.filter(F.col("mvpd") == TOTAL), dma_codes, [])
