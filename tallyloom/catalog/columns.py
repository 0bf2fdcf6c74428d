"""Projections and schema edits."""

from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.operators import columns as op


@query("select_columns", "SELECT type, duration, rating FROM titles")
def _(t):
    return op.select_columns(fx.titles(t), "type", "duration", "rating")


@query("select_by_position", "SELECT title, release_year, show_id FROM titles")
def _(t):
    return op.select_by_position(fx.titles(t), 2, 5, 0)


@query("select_by_name_pattern", "SELECT year_start, year_end FROM indicators")
def _(t):
    return op.select_by_name_pattern(fx.indicators(t), "Year")


@query("drop_columns", "SELECT show_id, type, title, rating, country, release_year FROM titles")
def _(t):
    return op.drop_columns(fx.titles(t), "duration", "no_such_column")


@query("rename_columns", "SELECT l_orderkey AS a, l_linenumber AS b, l_quantity AS eyes, l_returnflag AS flag FROM lineitem")
def _(t):
    picked = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    named = op.rename_columns(picked, {"l_quantity": " eyes ", "l_returnflag": "flag"})
    return op.rename_columns(op.trim_names(named), ["a", "b", "eyes", "flag"])


@query("detect_measure_column", 'SELECT event_id, mvpd, impressions_text AS "Impressions" FROM delivery')
def _(t):
    report = fx.delivery(t).select("event_id", "mvpd", F.col("impressions_text").alias("Total Imps Delivered"))
    return op.detect_measure_column(report)


@query("add_constant", "SELECT event_id, raw_network, 'BrandA' AS brand, 'Cox' AS mvpd FROM delivery")
def _(t):
    return op.add_constant(fx.delivery(t).select("event_id", "raw_network"), brand="BrandA", mvpd="Cox")


@query(
    "derive_arith",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice - l_quantity AS difference, l_quantity * l_tax AS product,
         CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS ratio FROM lineitem""",
)
def _(t):
    c = F.col
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (c("l_extendedprice") - c("l_quantity")).alias("difference"),
        (c("l_quantity") * c("l_tax")).alias("product"),
        op.ratio(c("l_tax"), c("l_discount")).alias("ratio"),
    )


@query(
    "row_sum",
    "SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity + l_extendedprice + l_tax) AS total FROM lineitem",
)
def _(t):
    total = op.row_sum(F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", total.alias("total"))


@query(
    "cast_type",
    "SELECT event_id, CAST(hour AS VARCHAR) AS hour, TRY_CAST(impressions_text AS BIGINT) AS impressions_text FROM delivery",
)
def _(t):
    picked = fx.delivery(t).select("event_id", "hour", "impressions_text")
    return op.cast_type(picked, hour="string", impressions_text="bigint")


@query(
    "infer_numeric_column",
    "SELECT event_id, CAST(hour AS DOUBLE) AS hour_text, impressions_text, raw_network FROM delivery",
)
def _(t):
    texts = fx.delivery(t).select("event_id", F.col("hour").cast("string").alias("hour_text"), "impressions_text", "raw_network")
    return op.infer_numeric_columns(texts)


@query("literal_table", """
SELECT new_fv, coalesce(sum(imp), 0)::DOUBLE AS impressions FROM (
  SELECT imp, CASE WHEN hour < 6 THEN 'Overnight' WHEN hour < 9 THEN 'Early Morning' WHEN hour < 12 THEN 'AM Day' WHEN hour < 16 THEN 'PM Day'
    WHEN hour < 18 THEN 'Early Fringe' WHEN hour < 20 THEN 'Access' WHEN hour < 23 THEN 'Prime Time' ELSE 'Late Fringe' END AS alias FROM delivery) d
JOIN (VALUES ('Overnight','Overnight - Midnight-6AM'), ('Early Morning','Early Morning - 6AM-9AM'), ('AM Day','Daytime - 9AM-4PM'),
  ('PM Day','Daytime - 9AM-4PM'), ('Early Fringe','Early Fringe - 4PM-6PM'), ('Access','Prime Access - 6PM-8PM'),
  ('Prime Time','Prime - 8PM-11PM'), ('Late Fringe','Late Fringe - 11PM-12AM')) AS m(alias, new_fv) USING (alias)
GROUP BY new_fv""")
def _(t):
    from tallyloom.functions.calendar import DAYPART_ALIASES
    from tallyloom.operators.aggregates import group_sum
    from tallyloom.operators.joins import literal_lookup

    named = literal_lookup(fx.short_dayparts(t), DAYPART_ALIASES, "alias", "new_fv")
    return group_sum(named, ["new_fv"]).withColumn("impressions", F.col("impressions").cast("double"))
