"""Reach and frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import AMOUNT, contains_word, parse_number, quoted
from tallyloom.operators.aggregates import group_sum
from tallyloom.operators.columns import columns_with, ratio, row_sum
from tallyloom.operators.reshape import union_by_name
from tallyloom.operators.totals import append_total_row
from tallyloom.plans.providers import brand_of
from tallyloom.sources.sheets import cell_named, classify_file, clean_records, promote_header

REACH_TYPE = "Reach and Frequency"


def file_owner(file: Column, words: dict[str, str], default: str | None) -> tuple[Column, Column]:
    """Provider and brand of a reach file: by the first word its lower-cased name contains, else the default provider.

    The brand is what stands in front of that word, or in front of 'reach', or the whole name without its ending.
    """
    role = classify_file(file, words)
    mvpd = F.coalesce(role, F.lit(default).cast("string"))
    front = F.regexp_extract(file, r"(?i)^(.*?)\s*(?:\breach\b.*|\.\w+)?$", 1)
    for word in reversed(list(words)):
        front = F.when(F.lower(file).contains(word), F.substring(file, F.lit(1), F.instr(F.lower(file), word) - 1)).otherwise(front)
    return mvpd, F.trim(front)


def read_reach(
    rows: DataFrame, providers: list[str], brand: str | None = None, line: str = "line_no", words: dict[str, str] | None = None, default: str | None = None
) -> DataFrame:
    """Reach reports to one row per brand and provider: impressions and reached households.

    A file counts for the provider that its name contains, or for that of one of ``words`` ({word: provider}), else for
    ``default``; without a default, files that name none count for no provider and drop out.

    Household columns contain 'hh' but not 'book', impressions columns 'impression' and 'deliver' (or
    are named 'imp').  Of each file the first Total segment counts, in the order of ``line``, or its only row; the
    files of a brand and provider then add up.  A file with several segments and no Total counts as nothing.
    """
    households = columns_with(rows, "hh", without="book")
    amounts = [c for c in columns_with(rows, "impression") if "deliver" in c.lower()]
    amounts += [c for c in rows.columns if c.lower() == "imp"]
    mvpd, front = file_owner(F.col("file"), {p.lower(): p for p in providers} | (words or {}), default)
    clean = rows.select(
        F.col("file").alias("_file"),
        F.col(line).alias("_line"),
        (front if brand is None else F.lit(brand)).alias("brand"),
        mvpd.alias("mvpd"),
        contains_word(F.col("segment"), "Total").alias("is_total"),
        row_sum(*[parse_number(F.col(quoted(c)), AMOUNT) for c in households]).alias("reach"),
        row_sum(*[parse_number(F.col(quoted(c)), AMOUNT) for c in amounts]).alias("impressions"),
    )
    first_total = F.min(F.when(F.col("is_total"), F.col("_line")))
    chosen = clean.groupBy("_file").agg(F.coalesce(first_total, F.when(F.count("*") == 1, F.min("_line"))).alias("_line"))
    return group_sum(clean.join(chosen, ["_file", "_line"]), ["brand", "mvpd"], "impressions", "reach")


def read_reach_sheets(
    lines: DataFrame, sheet: str, provider: str, columns: list[str], brand: str | None = None, headers: DataFrame | None = None
) -> DataFrame:
    """One provider's reach sheets of a sheet set: brand, mvpd and the named columns, total rows left out."""
    file = F.col("file")
    own = lines.filter((F.col("sheet") == sheet) & F.coalesce(classify_file(file, {provider.lower(): provider}).isNotNull(), F.lit(False)))
    records = clean_records(promote_header(own, headers=headers))
    picked = [cell_named(c).alias(c) for c in columns]
    return records.select(brand_of(file, F.lit(provider), brand).alias("brand"), F.lit(provider).alias("mvpd"), *picked)


def reach_from_frequency(rows: DataFrame, households: str, frequency: str) -> DataFrame:
    """Reach of a provider that reports households and frequency: impressions are their product."""
    hh, times = parse_number(F.col(households), "decimal(18,0)"), parse_number(F.col(frequency), "decimal(18,6)")
    return _summed(rows, (hh * times).cast(AMOUNT), hh.cast(AMOUNT))


def reach_from_summary(rows: DataFrame, impressions: str, households: str) -> DataFrame:
    """Reach of a provider that reports impressions and households in its order summary."""
    return _summed(rows, parse_number(F.col(impressions), AMOUNT), parse_number(F.col(households), AMOUNT))


def reach_from_campaigns(long: DataFrame, brand: str, mvpd: str) -> DataFrame:
    """Reach from the campaign rows of a dimension-tagged report."""
    rows = long.filter((F.col("dimension_name") == "Campaign") & (F.col("dimension_value") != "Total"))
    rows = rows.withColumns({"brand": F.lit(brand), "mvpd": F.lit(mvpd)})
    return reach_from_summary(rows, "impressions_text", "uniques_text")


def _summed(rows: DataFrame, impressions: Column, reach: Column) -> DataFrame:
    amounts = rows.select("brand", "mvpd", impressions.alias("impressions"), reach.alias("reach"))
    return group_sum(amounts, ["brand", "mvpd"], "impressions", "reach")


def combine_reach(*parts: DataFrame) -> DataFrame:
    """The reach tables that are present, one row per brand and provider; several of one provider add up."""
    return group_sum(union_by_name(*parts), ["brand", "mvpd"], "impressions", "reach")


def reach_frequency(reach: DataFrame) -> DataFrame:
    """Add a Total provider and the frequency, and turn the metrics into rows of the fact."""
    whole = append_total_row(reach, "mvpd", "impressions", "reach", by=("brand",))
    metrics = whole.select(
        "brand",
        "mvpd",
        F.col("impressions").cast("double").alias("Impressions"),
        F.col("reach").cast("double").alias("Reach"),
        F.bround(ratio(F.col("impressions").cast("double"), F.col("reach").cast("double")), 2).alias("Frequency"),
    )
    return metrics.unpivot(["brand", "mvpd"], ["Impressions", "Reach", "Frequency"], "metric_type", "metric").withColumns(
        {"data_type": F.lit(REACH_TYPE), "feature_value": F.lit("Total")}
    )
