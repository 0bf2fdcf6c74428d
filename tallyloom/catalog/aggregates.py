"""Aggregations and profiles."""

from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import calendar as cal
from tallyloom.operators import aggregates as op
from tallyloom.operators import totals as tot
from tallyloom.sources.statistics import table_facts


def as_double(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names or ("impressions",)})


@query("group_sum", """
SELECT raw_network, mvpd, coalesce(sum(imp), 0)::DOUBLE AS impressions FROM delivery WHERE raw_network IS NOT NULL GROUP BY ALL
UNION ALL SELECT country, NULL, coalesce(sum(release_year), 0)::DOUBLE FROM titles WHERE country IS NOT NULL GROUP BY country""")
def _(t):
    sums = op.group_sum(fx.measured(t), ["raw_network", "mvpd"])
    years = fx.titles(t).withColumn("impressions", F.col("release_year").cast("decimal(18,2)"))
    years = op.group_sum(years, ["country"]).withColumnRenamed("country", "raw_network")
    return as_double(sums.unionByName(years, allowMissingColumns=True))


@query("count_by", "SELECT grade, count(*) AS n FROM screening GROUP BY grade")
def _(t):
    return op.count_by(fx.screening(t), "grade")


@query("value_counts_topn", """
SELECT rating, count(*) AS n FROM titles WHERE rating IS NOT NULL GROUP BY rating ORDER BY n DESC, rating LIMIT 10""")
def _(t):
    return op.value_counts(fx.titles(t), "rating", 10)


_TITLE_COLUMNS = ["show_id", "type", "title", "rating", "country", "release_year", "duration"]


@query("count_non_null", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null FROM titles" for c in _TITLE_COLUMNS))
def _(t):
    return op.count_non_null(fx.titles(t))


@query("table_shape", "SELECT count(*) AS n_rows, 7::BIGINT AS n_columns FROM titles")
def _(t):
    return op.table_shape(fx.titles(t))


@query("profile_table", " UNION ALL ".join(
    f"SELECT {i}::BIGINT AS position, '{c}' AS column_name, '{d}' AS dtype, count({c}) AS non_null FROM indicators"
    for i, (c, d) in enumerate([
        ("row_id", "bigint"), ("year_start", "bigint"), ("year_end", "bigint"), ("location_desc", "string"),
        ("topic", "string"), ("question", "string"), ("data_value", "double"),
    ])))
def _(t):
    return op.profile_table(fx.indicators(t))


@query("global_sum", "SELECT coalesce(sum(imp), 0)::DOUBLE AS impressions FROM delivery")
def _(t):
    return as_double(op.global_sum(fx.measured(t), "impressions"))


@query("min_max_by", "SELECT mvpd, min(event_date) AS start, max(event_date) AS \"end\" FROM delivery GROUP BY mvpd")
def _(t):
    return op.min_max_by(fx.delivery(t), "mvpd", "event_date", "start", "end")


_CUT_ROWS = """
SELECT network AS feature_value, brand, imp, mvpd, 'Network' AS data_type FROM mapped
UNION ALL SELECT daypart, brand, imp, mvpd, 'Daypart' FROM mapped
UNION ALL SELECT 'Total', brand, imp, mvpd, 'Summary' FROM mapped"""
_CUTS = f"(SELECT feature_value, brand, coalesce(sum(imp), 0) AS imp, mvpd, data_type FROM ({_CUT_ROWS}) GROUP BY ALL)"
_FEATURE_TOTALS = f"SELECT feature_value, brand, sum(imp) AS imp, 'Total' AS mvpd, data_type FROM {_CUTS} GROUP BY feature_value, brand, data_type"
_CUT_TOTALS = f"SELECT 'Total' AS feature_value, brand, sum(imp) AS imp, mvpd, data_type FROM ({{}}) WHERE data_type <> 'Summary' GROUP BY brand, mvpd, data_type"
_OUT = "SELECT feature_value, brand, imp::DOUBLE AS impressions, mvpd, data_type FROM ({})"


def cut_fact(t):
    """Network, daypart and summary rows per provider, all from one pass over delivery."""
    from tallyloom.plans.providers import map_features

    cuts = tot.cuts_of(Network=F.col("raw_network"), Daypart=cal.daypart(F.col("hour")), Summary="Total")
    rows = fx.measured(t).select("brand", "mvpd", "impressions", cuts)
    return map_features(rows, fx.net_map(t), fx.dma_map(t))


@query("feature_totals", _OUT.format(_FEATURE_TOTALS))
def _(t):
    return as_double(tot.feature_totals(cut_fact(t)))


@query("cut_totals", _OUT.format(_CUT_TOTALS.format(f"SELECT * FROM {_CUTS} UNION ALL {_FEATURE_TOTALS}")))
def _(t):
    fact = cut_fact(t).filter(F.col("data_type") != tot.SUMMARY)
    return as_double(tot.cut_totals(fact.unionByName(tot.feature_totals(fact))))


@query("grouping_sets_totals", _OUT.format(
    f"SELECT feature_value, brand, imp, mvpd, data_type FROM {_CUTS} UNION ALL {_FEATURE_TOTALS} UNION ALL "
    + _CUT_TOTALS.format(f"SELECT * FROM {_CUTS} UNION ALL {_FEATURE_TOTALS}")))
def _(t):
    return as_double(tot.with_totals(cut_fact(t)))


@query("append_total_row", """
SELECT coalesce(mvpd, 'Total') AS mvpd, sum(imp)::DOUBLE AS impressions, sum(hh)::DOUBLE AS reach FROM (
  SELECT mvpd, sum(imp) AS imp, count(DISTINCT user_id) AS hh FROM delivery GROUP BY mvpd) GROUP BY ROLLUP (mvpd)""")
def _(t):
    per_provider = fx.measured(t).groupBy("mvpd").agg(
        op.exact_sum("impressions").alias("impressions"), F.countDistinct("user_id").cast(op.TOTAL).alias("reach")
    )
    return as_double(tot.append_total_row(per_provider, "mvpd", "impressions", "reach"), "impressions", "reach")


@query("distinct_rows", "SELECT DISTINCT raw_network, mvpd, brand FROM delivery")
def _(t):
    return fx.delivery(t).select("raw_network", "mvpd", "brand").distinct()


@query("unique_values", "SELECT DISTINCT raw_market FROM delivery")
def _(t):
    return op.unique_values(fx.delivery(t), "raw_market")


_CORR = ["l_quantity", "l_extendedprice", "l_discount"]


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(_CORR) for b in _CORR[i:]))
def _(t):
    return op.corr_matrix(t.lineitem, *_CORR).withColumn("corr", F.round("corr", 6))


@query("table_facts", """
SELECT 'o_orderkey' AS "column", count(*) AS "rows", count(o_orderkey) AS n, min(o_orderkey)::VARCHAR AS lo, max(o_orderkey)::VARCHAR AS hi FROM orders
UNION ALL SELECT 'o_custkey', count(*), count(o_custkey), min(o_custkey)::VARCHAR, max(o_custkey)::VARCHAR FROM orders""")
def _(t):
    return table_facts(t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_custkey"])
