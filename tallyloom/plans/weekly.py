"""Weeks shared by all providers, and daily rows summed into them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar as cal
from tallyloom.operators.aggregates import group_sum


def provider_spans(daily: DataFrame, date: str = "event_date", days: int = 1) -> DataFrame:
    """First and last day per brand and provider; ``days`` is the length of the period a row stands for."""
    return daily.groupBy("brand", "mvpd").agg(
        F.min(date).alias("start"), F.date_add(F.max(date), days - 1).alias("end")
    )


def week_anchor(spans: DataFrame, anchor: str | None) -> DataFrame:
    """Per brand, the first day of week 1 and the last day of all.

    Weeks follow the anchor provider's own weeks; if another provider starts earlier they begin as
    many whole weeks before.  Without the anchor provider they begin with the first day of all.
    """
    firsts = spans.groupBy("brand").agg(
        F.min("start").alias("_first"),
        F.min(F.when(F.col("mvpd") == anchor, F.col("start"))).alias("_anchor"),
        F.max("end").alias("last"),
    )
    start = F.coalesce(cal.anchor_start(F.col("_anchor"), F.col("_first")), F.col("_first"))
    return firsts.select("brand", start.alias("first"), "last")


def week_calendar(anchors: DataFrame) -> DataFrame:
    """One row per brand and week: first_date, last_date, 'Week n'; a last day on a week start counts."""
    starts = F.sequence("first", "last", F.expr("interval 7 days"))
    weeks = anchors.select("brand", F.posexplode(starts).alias("_i", "first_date"))
    return weeks.select(
        "brand",
        "first_date",
        F.date_add("first_date", 6).alias("last_date"),
        F.concat(F.lit("Week "), (F.col("_i") + 1).cast("string")).alias("week_num"),
    )


def with_week(daily: DataFrame, anchors: DataFrame, date: str = "event_date") -> DataFrame:
    """Each day's week start and name, by date arithmetic instead of a range join.

    When the days are many rows, hand in anchors that were written (``session.materialize``): Spark then
    knows how small they are and does not shuffle the days.
    """
    rows = daily.join(anchors.select("brand", F.col("first").alias("_first")), "brand")
    index = cal.week_index(F.col(date), F.col("_first"))
    return rows.withColumns(
        {
            "week": cal.week_start(F.col(date), F.col("_first")),
            "week_num": F.concat(F.lit("Week "), (index + 1).cast("string")),
        }
    ).drop("_first")


def weekly(daily: DataFrame, anchor: str | None, date: str = "event_date", anchor_weeks: DataFrame | None = None) -> DataFrame:
    """Impressions per brand, provider and week.

    Daily rows are first summed per day, so what is joined to the anchors is one row per provider and
    day.  ``anchor_weeks`` are rows of a provider that reports whole weeks, by first day.
    """
    per_day = group_sum(daily, ["brand", "mvpd", date])
    spans = provider_spans(per_day, date)
    if anchor_weeks is not None:
        per_week = group_sum(anchor_weeks, ["brand", "mvpd", date])
        spans = spans.unionByName(provider_spans(per_week, date, days=7))
    weeks = group_sum(with_week(per_day, week_anchor(spans, anchor), date), ["brand", "mvpd", "week"])
    if anchor_weeks is not None:
        weeks = weeks.unionByName(per_week.withColumnRenamed(date, "week"))
    return weeks
