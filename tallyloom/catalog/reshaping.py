"""Long to wide, wide to long, set operations."""

from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import calendar as cal
from tallyloom.operators import reshape as op
from tallyloom.operators.aggregates import exact_sum, group_sum

_PIVOT = ", ".join(f"sum(imp) FILTER (mvpd = '{p}')::DOUBLE AS \"{p}\"" for p in fx.PROVIDERS)


@query("pivot_sum", f"SELECT daypart, brand, {_PIVOT} FROM dayparted GROUP BY daypart, brand")
def _(t):
    rows = fx.measured(t).withColumn("daypart", cal.daypart(F.col("hour")))
    wide = op.pivot_sum(rows, ["daypart", "brand"], "mvpd", fx.PROVIDERS, "impressions")
    return wide.withColumns({p: F.col(p).cast("double") for p in fx.PROVIDERS})


@query("unpivot_metrics", """
SELECT mvpd, 'Impressions' AS metric_type, sum(imp)::DOUBLE AS metric FROM delivery GROUP BY mvpd
UNION ALL SELECT mvpd, 'Reach', count(DISTINCT user_id)::DOUBLE FROM delivery GROUP BY mvpd
UNION ALL SELECT mvpd, 'Frequency', round_even(sum(imp)::DOUBLE / count(DISTINCT user_id)::DOUBLE, 2) FROM delivery GROUP BY mvpd""")
def _(t):
    wide = fx.measured(t).groupBy("mvpd").agg(
        exact_sum("impressions").cast("double").alias("Impressions"), F.countDistinct("user_id").cast("double").alias("Reach")
    ).withColumn("Frequency", F.bround(F.try_divide("Impressions", "Reach"), 2))
    return op.unpivot_columns(wide, ["mvpd"], ["Impressions", "Reach", "Frequency"], "metric_type", "metric")


@query("stack_column_groups", """
SELECT mvpd, CASE WHEN hour < 2 THEN 'LF' WHEN hour < 6 THEN 'ON' WHEN hour < 9 THEN 'EM' WHEN hour < 16 THEN 'DA' WHEN hour < 20 THEN 'EF' ELSE 'PR' END AS "Daypart",
  CAST(hour AS VARCHAR) AS "Start", CAST(hour + 1 AS VARCHAR) AS "End", coalesce(sum(imp), 0)::DOUBLE AS "Impressions"
FROM delivery GROUP BY mvpd, hour""")
def _(t):
    long = op.stack_column_groups(fx.wide_hourly(t), ["mvpd"], ["Daypart", "Start", "End", "Impressions"])
    long = long.withColumn("Impressions", F.col("Impressions").try_cast("decimal(18,2)"))
    sums = group_sum(long, ["mvpd", "Daypart", "Start", "End"], "Impressions")
    return sums.withColumn("Impressions", F.col("Impressions").cast("double"))


@query("union_by_name", """
SELECT event_id, raw_network AS name, mvpd, NULL AS brand FROM delivery
UNION ALL SELECT event_id, raw_market, NULL, brand FROM delivery""")
def _(t):
    d = fx.delivery(t)
    return op.union_by_name(
        d.select("event_id", F.col("raw_network").alias("name"), "mvpd"),
        d.select("brand", F.col("raw_market").alias("name"), "event_id"),
    )


@query("union_all", 'SELECT "from", "to", gender_from FROM both_edges')
def _(t):
    return op.union_by_name(fx.best_friends(t), fx.gets_on_with(t)).drop("edge_id")
