"""Day, daypart and reach tables merged from three sources of label / impressions sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar as cal
from tallyloom.functions.text import AMOUNT, parse_number
from tallyloom.operators.aggregates import global_sum, sum_complete
from tallyloom.operators.columns import row_sum
from tallyloom.operators.joins import combine_scalars, merge_inner


def merge_sources(a: DataFrame, b: DataFrame, c: DataFrame, c_label: str) -> DataFrame:
    """Join three (display_by, impressions_text) sheets by label; the total is null if any part is."""
    merged = merge_inner(merge_inner(a, b, "display_by"), c, "display_by", c_label)
    parts = [parse_number(F.col(x), AMOUNT) for x in ("impressions_text_x", "impressions_text_y", "impressions_text")]
    return merged.select("display_by", row_sum(*parts).alias("total_impressions"))


def day_impressions(day_a: DataFrame, day_b: DataFrame, day_c: DataFrame, c_label: str = "day_of_week") -> DataFrame:
    """Total impressions per weekday, Monday to Sunday, then Total.  Source c writes 'Sun' for Sunday."""
    names = F.create_map(*[F.lit(x) for pair in cal.DAY_ABBREVIATIONS.items() for x in pair])
    day_c = day_c.withColumn(c_label, F.coalesce(names[F.col(c_label)], F.col(c_label)))
    merged = merge_sources(day_a, day_b, day_c, c_label).withColumnRenamed("display_by", "day_of_week")
    return merged.withColumn("order_key", cal.day_rank(F.col("day_of_week"), "Total")).orderBy(
        F.col("order_key").asc_nulls_last()
    )


def daypart_impressions(hour_a: DataFrame, hour_b: DataFrame, hour_c: DataFrame, c_label: str = "time_of_day") -> DataFrame:
    """Total impressions per daypart, plus the Total row."""
    merged = merge_sources(hour_a, hour_b, hour_c, c_label)
    return sum_complete(
        merged.withColumn("daypart", cal.daypart_of_label(F.col("display_by"))), ["daypart"], "total_impressions"
    )


def total_reach(reach_1: DataFrame, summary_2: DataFrame, dayparts: DataFrame) -> DataFrame:
    """The Total row of the daypart table with the reach of both sources next to it."""
    first = global_sum(
        reach_1.select(row_sum(*[parse_number(F.col(c), AMOUNT) for c in reach_1.columns]).alias("_reach_1")), "_reach_1"
    )
    second = global_sum(summary_2.select(parse_number(F.col("reach"), AMOUNT).alias("_reach_2")), "_reach_2")
    reach = combine_scalars(first, second).select(
        F.lit("Total").alias("cut"), (F.col("_reach_1") + F.col("_reach_2")).alias("total_reach")
    )
    total = dayparts.withColumnRenamed("daypart", "cut").filter(F.col("cut") == "Total")
    # Both are single rows with the same label; grouping them together avoids a join on a constant.
    both = total.unionByName(reach, allowMissingColumns=True)
    return both.groupBy("cut").agg(F.max("total_impressions").alias("total_impressions"), F.max("total_reach").alias("total_reach"))
