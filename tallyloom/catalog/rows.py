"""Filters, row selection and ordering."""

from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import calendar as cal
from tallyloom.functions.text import contains_word
from tallyloom.operators import rows as op
from tallyloom.operators.aggregates import group_sum
from tallyloom.operators.joins import attach_order_key
from tallyloom.operators.reshape import union_by_name


@query("filter_eq", "SELECT * FROM indicators WHERE year_end = 1996")
def _(t):
    return fx.indicators(t).filter(F.col("year_end") == 1996)


@query("filter_and", "SELECT show_id, title, release_year FROM titles WHERE country = 'ECONOMY' AND type = 'Movie'")
def _(t):
    titles = fx.titles(t)
    kept = titles.filter((F.col("country") == "ECONOMY") & (F.col("type") == "Movie"))
    return kept.select("show_id", "title", "release_year")


@query("filter_or_of_ands", """
SELECT row_id, year_start, location_desc, topic FROM indicators
WHERE (year_start = 1996 AND location_desc = 'NATION_4' AND topic = '5-LOW')
   OR (year_start = 1995 AND location_desc = 'NATION_7' AND topic = '2-HIGH')""")
def _(t):
    y, loc, topic = F.col("year_start"), F.col("location_desc"), F.col("topic")
    kept = fx.indicators(t).filter(
        ((y == 1996) & (loc == "NATION_4") & (topic == "5-LOW")) | ((y == 1995) & (loc == "NATION_7") & (topic == "2-HIGH"))
    )
    return kept.select("row_id", "year_start", "location_desc", "topic")


@query("remove_total_rows", """
SELECT mvpd, display_by, impressions_text, 'contains' AS mode FROM day_sheet WHERE display_by NOT LIKE '%Total%'
UNION ALL SELECT mvpd, display_by, impressions_text, 'equals' FROM hour_sheet WHERE display_by <> 'Total'""")
def _(t):
    days = op.remove_total_rows(fx.day_sheet(t), "display_by").withColumn("mode", F.lit("contains"))
    hours = op.remove_total_rows(fx.hour_sheet(t), "display_by", mode="equals").withColumn("mode", F.lit("equals"))
    return days.unionByName(hours)


@query("drop_any_null", "SELECT * FROM titles WHERE rating IS NOT NULL AND country IS NOT NULL")
def _(t):
    return op.drop_any_null(fx.titles(t))


@query("drop_empty_columns", "SELECT event_id, mvpd, imp::DOUBLE AS impressions FROM delivery")
def _(t):
    sheet = fx.measured(t).select(
        "event_id", "mvpd", F.when(F.col("event_id") < 0, "note").alias("note"), F.col("impressions").cast("double")
    )
    return op.drop_empty_columns(sheet)


@query("filter_is_null", "SELECT show_id, title FROM titles WHERE country IS NULL")
def _(t):
    return fx.titles(t).filter(F.col("country").isNull()).select("show_id", "title")


@query("filter_contains", "SELECT show_id, country FROM titles WHERE country LIKE '%ON%'")
def _(t):
    return fx.titles(t).filter(contains_word(F.col("country"), "ON")).select("show_id", "country")


@query("slice_rows", """
SELECT row_id, topic, data_value FROM (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS i FROM indicators)
WHERE i BETWEEN 1000 AND 1004""")
def _(t):
    return op.slice_rows(fx.indicators(t).select("row_id", "topic", "data_value"), 1000, 1005, "row_id")


@query("lookup_rows_by_label", "SELECT rating, release_year FROM titles WHERE show_id IN (2, 4)")
def _(t):
    return op.lookup_rows_by_label(fx.titles(t), "show_id", [2, 4], "rating", "release_year")


@query("drop_rows_by_label", "SELECT * FROM titles WHERE show_id <> 4")
def _(t):
    return op.drop_rows_by_label(fx.titles(t), "show_id", 4)


@query("head_n", "SELECT * FROM titles ORDER BY show_id LIMIT 5")
def _(t):
    return op.head_n(fx.titles(t), 5, "show_id")


@query("tail_n", "SELECT * FROM titles ORDER BY show_id DESC LIMIT 5")
def _(t):
    return op.tail_n(fx.titles(t), 5, "show_id")


@query("sort_by", """
SELECT "from", "to", gender_from, row_number() OVER (ORDER BY "from", edge_id) - 1 AS position FROM both_edges""")
def _(t):
    rows = union_by_name(fx.best_friends(t), fx.gets_on_with(t))
    return op.with_position(rows, "from", "edge_id").drop("edge_id")


@query("sort_by_category", """
SELECT mvpd, display_by, row_number() OVER (PARTITION BY mvpd ORDER BY
  CASE display_by WHEN 'Monday' THEN 0 WHEN 'Tuesday' THEN 1 WHEN 'Wednesday' THEN 2 WHEN 'Thursday' THEN 3 WHEN 'Friday' THEN 4
    WHEN 'Saturday' THEN 5 WHEN 'Sunday' THEN 6 ELSE 7 END) - 1 AS position FROM day_sheet""")
def _(t):
    sheet = fx.day_sheet(t)
    ranked = attach_order_key(sheet, cal.day_rank(F.col("display_by"), "Total"))
    return op.with_position_by(ranked, ["mvpd"], "order_key").select("mvpd", "display_by", "position")


@query("attach_order_key", """
SELECT day, coalesce(sum(imp), 0)::DOUBLE AS impressions, day_num::BIGINT AS order_key FROM delivery GROUP BY day, day_num""")
def _(t):
    rows = fx.measured(t).withColumn("day", cal.day_name(F.col("event_date")))
    sums = group_sum(rows, ["day"]).withColumn("impressions", F.col("impressions").cast("double"))
    return attach_order_key(sums, cal.day_rank(F.col("day")))


@query("totals_last", """
SELECT mvpd, display_by, row_number() OVER (PARTITION BY mvpd ORDER BY display_by = 'Total', display_by) - 1 AS position FROM day_sheet""")
def _(t):
    return op.with_position_by(
        op.totals_last(fx.day_sheet(t), "display_by"), ["mvpd"], F.col("display_by") == "Total", "display_by"
    ).select("mvpd", "display_by", "position")
