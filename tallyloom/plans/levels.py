"""Change of benchmark level between two screening windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.joins import merge_inner

# ---- fixed values: benchmark categories and their levels ----
LEVELS = {
    "Urgent Intervention": 1,
    "Intervention": 2,
    "On Watch": 3,
    "At/Above Benchmark": 4,
}
FALL, WINTER = "Fall Window", "FALL_WINTER"
# ---- end of fixed values ----


def level_of(category: Column) -> Column:
    """Level of a category; null where there is no score."""
    chain = F.when(F.lit(False), F.lit(None).cast("bigint"))
    for name, level in LEVELS.items():
        chain = chain.when(category == name, F.lit(level).cast("bigint"))
    return chain


def fall_and_winter(screening: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct rows of each window, without the column that picked them."""
    rows = screening.withColumn("level", level_of(F.col("benchmark_category")))
    fall = rows.filter(F.col("window_name") == FALL).drop("sgp_vector").distinct()
    winter = rows.filter(F.col("sgp_vector") == WINTER).drop("window_name").distinct()
    return fall, winter


def level_change(screening: DataFrame) -> DataFrame:
    """One row per pair of a student's fall and winter results, with the change in level.

    Repeated rows collapse before the join, so only truly different results of a student pair up.
    """
    fall, winter = fall_and_winter(screening)
    both = merge_inner(fall, winter, "student_id").drop("first_name_y", "last_name_y", "grade_y", "activity_type_y")
    return both.withColumn("status", F.col("level_y") - F.col("level_x"))
