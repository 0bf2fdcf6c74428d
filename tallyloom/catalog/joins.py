"""Joins and lookups."""

from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import calendar as cal
from tallyloom.operators import joins as op
from tallyloom.operators.aggregates import global_sum
from tallyloom.operators.periods import join_periods
from tallyloom.plans.weekly import provider_spans, week_anchor, with_week
from tallyloom.session import materialize


@query("join_inner_suffix", """
SELECT a.display_by, a.impressions_text AS impressions_text_x, b.impressions_text AS impressions_text_y
FROM day_sheet a JOIN day_sheet b USING (display_by) WHERE a.mvpd IN ('Comcast', 'Cox') AND b.mvpd IN ('Spectrum', 'Verizon')""")
def _(t):
    days = fx.day_sheet(t)
    a = days.filter("mvpd IN ('Comcast', 'Cox')").drop("mvpd")
    b = days.filter("mvpd IN ('Spectrum', 'Verizon')").drop("mvpd")
    return op.merge_inner(a, b, "display_by")


@query("join_inner_diff_keys", "SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    orders = t.orders.select("o_orderkey", "o_custkey")
    return op.merge_inner(orders, t.customer.select("c_custkey", "c_mktsegment"), "o_custkey", "c_custkey")


@query("join_left_lookup", """
SELECT event_id, raw_network, corrected_network FROM delivery LEFT JOIN net_map ON raw_network = feature_value""")
def _(t):
    return op.lookup(fx.delivery(t).select("event_id", "raw_network"), fx.net_map(t), "raw_network", "feature_value")


@query("map_or_unassigned", """
SELECT network AS feature_value, brand, mvpd, coalesce(sum(imp), 0)::DOUBLE AS impressions, 'Network' AS data_type FROM mapped GROUP BY ALL
UNION ALL SELECT market, brand, mvpd, coalesce(sum(imp), 0)::DOUBLE, 'Market' FROM mapped GROUP BY ALL""")
def _(t):
    rows = fx.measured(t)
    keys = ["brand", "mvpd"]
    networks = op.map_or_unassigned(rows, fx.net_map(t), "raw_network", "feature_value", "corrected_network", keys)
    markets = op.map_or_unassigned(rows, fx.dma_map(t), "city", "geography", "corrected_dma", keys, fold_case=True)
    networks = networks.withColumnRenamed("raw_network", "feature_value").withColumn("data_type", F.lit("Network"))
    markets = markets.withColumnRenamed("city", "feature_value").withColumn("data_type", F.lit("Market"))
    return networks.unionByName(markets).withColumn("impressions", F.col("impressions").cast("double"))


@query("anti_unmapped", """
SELECT event_id, raw_network FROM delivery WHERE raw_network NOT IN (SELECT feature_value FROM net_map)""")
def _(t):
    return op.anti_unmapped(fx.delivery(t).select("event_id", "raw_network"), fx.net_map(t), "raw_network", "feature_value")


@query("cross_join_scalars", """
SELECT (SELECT sum(imp)::DOUBLE FROM delivery) AS impressions, (SELECT count(DISTINCT user_id) FROM delivery) AS households""")
def _(t):
    rows = fx.measured(t)
    impressions = global_sum(rows, "impressions").withColumn("impressions", F.col("impressions").cast("double"))
    return op.combine_scalars(impressions, rows.agg(F.countDistinct("user_id").alias("households")))


@query("join_range_week", """
SELECT event_id, mvpd, event_date, first_date AS week, week_num FROM delivery d JOIN (
  SELECT brand, CAST(unnest(generate_series(first, last, INTERVAL 7 DAY)) AS DATE) AS first_date,
    'Week ' || unnest(range(1, CAST(floor((last - first) / 7) AS BIGINT) + 2)) AS week_num FROM week_first) w
ON d.brand = w.brand AND d.event_date BETWEEN w.first_date AND w.first_date + 6""")
def _(t):
    daily = fx.delivery(t).select("event_id", "brand", "mvpd", "event_date")
    weeks = fx.anchor_weeks(t)
    spans = provider_spans(daily.filter(F.col("mvpd") != "Comcast")).unionByName(provider_spans(weeks, days=7))
    anchors = materialize(week_anchor(spans, "Comcast"), "anchors")
    return with_week(daily, anchors).drop("brand")


@query("day_abbrev_to_name", """
SELECT event_id, day AS feature_value FROM delivery""")
def _(t):
    days = fx.delivery(t).select("event_id", F.date_format("event_date", "E").alias("day_abc"))
    named = op.literal_lookup(days, cal.DAY_ABBREVIATIONS, "day_abc", "full_name")
    return named.select("event_id", F.coalesce("full_name", "day_abc").alias("feature_value"))


@query("daypart_alias", """
SELECT event_id, daypart AS feature_value, custom_daypart AS custom_value FROM dayparted""")
def _(t):
    rows = fx.short_dayparts(t).select("event_id", "alias", fx.daypart_code(F.col("hour")).alias("code"))
    named = op.literal_lookup(rows, cal.DAYPART_ALIASES, "alias", "feature_value")
    named = op.literal_lookup(named, cal.CUSTOM_DAYPART_CODES, "code", "custom_value")
    return named.select("event_id", "feature_value", "custom_value")


@query("join_range_periods", """
SELECT event_id, d.brand, event_date, flight, first_date, last_date FROM delivery d LEFT JOIN flights f
ON d.brand = f.brand AND d.event_date BETWEEN f.first_date AND f.last_date""")
def _(t):
    days = fx.delivery(t).select("event_id", "brand", "event_date")
    return join_periods(days, fx.flights(t), "event_date", "first_date", "last_date", by=["brand"], how="left")
