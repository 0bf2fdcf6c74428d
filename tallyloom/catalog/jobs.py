"""The composite jobs."""

from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions.text import comma_text
from tallyloom.operators.aggregates import group_sum
from tallyloom.operators.reshape import union_by_name
from tallyloom.operators.totals import cuts_of
from tallyloom.plans import graph, learning, levels, providers, reach, report, sources_merge, weekly
from tallyloom.session import materialize
from tallyloom.sources import sheets as sh


def as_double(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names or ("impressions",)})


def _three_sources(t, sheet, label):
    """Platform a, platform b and the other source's (label, impressions_text) sheets.

    The other source is both remaining providers together, with its own label column name.
    """
    sheets = materialize(sheet(t), "sheets")
    a = sheets.filter("mvpd = 'Comcast'").drop("mvpd")
    b = sheets.filter("mvpd = 'Spectrum'").drop("mvpd")
    rest = sheets.filter("mvpd in ('Cox', 'Verizon')").groupBy("display_by").agg(
        F.sum(F.regexp_replace("impressions_text", ",", "").cast("decimal(18,2)")).alias("n")
    )
    c = rest.select(F.col("display_by").alias(label), comma_text(F.col("n")).alias("impressions_text"))
    return a, b, c


def _day_c(c):
    short = F.when(F.col("day_of_week") == "Total", "Total").otherwise(F.substring("day_of_week", 1, 3))
    return c.withColumn("day_of_week", short)


_MERGED = "SELECT display_by, sum(n) AS n FROM {0} GROUP BY display_by HAVING count(DISTINCT CASE WHEN mvpd = 'Verizon' THEN 'Cox' ELSE mvpd END) = 3"


@query("job_day_impressions", f"""
SELECT display_by AS day_of_week, n::DOUBLE AS total_impressions, CASE display_by WHEN 'Monday' THEN 0 WHEN 'Tuesday' THEN 1 WHEN 'Wednesday' THEN 2
  WHEN 'Thursday' THEN 3 WHEN 'Friday' THEN 4 WHEN 'Saturday' THEN 5 WHEN 'Sunday' THEN 6 ELSE 7 END::BIGINT AS order_key
FROM ({_MERGED.format('day_sheet')})""")
def _(t):
    a, b, c = _three_sources(t, fx.day_sheet, "day_of_week")
    return as_double(sources_merge.day_impressions(a, b, _day_c(c)), "total_impressions")


_DAYPART_SQL = f"""
SELECT CASE WHEN display_by = 'Total' THEN 'Total' ELSE daypart END AS daypart, sum(n)::DOUBLE AS total_impressions
FROM ({_MERGED.format('hour_sheet')}) LEFT JOIN (SELECT DISTINCT clock, daypart FROM dayparted) ON display_by = clock GROUP BY 1"""


@query("job_daypart_impressions", _DAYPART_SQL)
def _(t):
    return as_double(_dayparts(t), "total_impressions")


def _dayparts(t):
    return sources_merge.daypart_impressions(*_three_sources(t, fx.hour_sheet, "time_of_day"))


@query("job_total_reach", f"""
SELECT 'Total' AS cut, total_impressions, (SELECT sum(hh)::DOUBLE FROM (SELECT mvpd, count(DISTINCT user_id) AS hh FROM delivery GROUP BY mvpd)) AS total_reach
FROM ({_DAYPART_SQL}) WHERE daypart = 'Total'""")
def _(t):
    users = materialize(fx.delivery(t).groupBy("mvpd").agg(F.countDistinct("user_id").alias("hh")), "users")
    reach_1 = users.agg(*[
        comma_text(F.sum(F.when(F.col("mvpd") == p, F.col("hh")))).alias(f"{p} only unique households")
        for p in ("Comcast", "Spectrum")
    ])
    summary_2 = users.filter("mvpd in ('Cox', 'Verizon')").select(comma_text(F.col("hh")).alias("reach"))
    return as_double(sources_merge.total_reach(reach_1, summary_2, _dayparts(t)), "total_impressions", "total_reach")


_SIDE = "SELECT DISTINCT student_id, first_name, last_name, grade, activity_type, {0}, benchmark_category, level FROM screening WHERE {1}"


@query("job_level_change", f"""
SELECT x.student_id, x.first_name AS first_name_x, x.last_name AS last_name_x, x.grade AS grade_x, x.activity_type AS activity_type_x,
  window_name, x.benchmark_category AS benchmark_category_x, x.level AS level_x,
  y.benchmark_category AS benchmark_category_y, sgp_vector, y.level AS level_y, y.level - x.level AS status
FROM ({_SIDE.format('window_name', "window_name = 'Fall Window'")}) x JOIN ({_SIDE.format('sgp_vector', "sgp_vector = 'FALL_WINTER'")}) y
ON x.student_id = y.student_id""")
def _(t):
    return levels.level_change(fx.screening(t))


@query("job_provider_long_cuts", """
SELECT feature_value, brand, imp::DOUBLE AS impressions, 'Comcast' AS mvpd, data_type FROM tagged_fact""")
def _(t):
    return as_double(providers.long_cuts(fx.dimension_long(t), fx.net_map(t), fx.dma_map(t), "BrandA", "Comcast"))


AGENCY = "Agency"
REPORTED = [*fx.PROVIDERS, AGENCY]
YEAR = 2024  # of the test tables, for dates that come without one


def workbooks(t):
    """Lines and headers of all sheets, read once for all that starts from them."""
    lines = sh.read_sheet_set(t.spark, fx.provider_files(t))
    return lines, materialize(sh.sheet_headers(lines), "headers")


def provider_fact(t, books=None):
    lines, headers = books or workbooks(t)
    return providers.sheet_cuts(lines, fx.net_map(t), fx.dma_map(t), year=YEAR, headers=headers)


@query("job_provider_sheets", "SELECT feature_value, brand, imp::DOUBLE AS impressions, mvpd, data_type FROM provider_fact")
def _(t):
    return as_double(provider_fact(t))


@query("job_summary_from_daily", """
SELECT 'Total' AS feature_value, brand, coalesce(sum(imp), 0)::DOUBLE AS impressions, mvpd, 'Summary' AS data_type FROM delivery GROUP BY brand, mvpd""")
def _(t):
    return as_double(providers.summary_from_daily(fx.measured(t)))


@query("job_weekly", """
SELECT brand, mvpd, CAST(feature_value AS DATE) AS week, imp::DOUBLE AS impressions FROM provider_fact WHERE data_type = 'Week'""")
def _(t):
    daily = fx.measured(t).filter(F.col("mvpd") != providers.ANCHOR)
    return as_double(weekly.weekly(daily, providers.ANCHOR, anchor_weeks=fx.anchor_weeks(t)))


# Fixed value: the word in the names of one provider's reach files.
REACH_WORDS = {"parallel": "Comcast"}


def reach_rows(t, books=None):
    sums = materialize(fx.reach_sums(t), "reach_sums")
    lines, headers = books or workbooks(t)
    return reach.reach_frequency(reach.combine_reach(
        reach.read_reach(fx.reach_file(sums), fx.PROVIDERS, words=REACH_WORDS, default="Comcast"),
        reach.reach_from_frequency(reach.read_reach_sheets(lines, "Reach-Frequency", "Cox", ["Households", "Frequency"], headers=headers), "Households", "Frequency"),
        reach.reach_from_summary(reach.read_reach_sheets(lines, "Order Summary", "Verizon", ["Impressions", "Households"], headers=headers), "Impressions", "Households"),
        reach.reach_from_campaigns(fx.dimension_long(t), "BrandA", "Comcast"),
    ))


@query("job_reach_frequency", """
SELECT brand, mvpd, metric_type, metric, 'Reach and Frequency' AS data_type, 'Total' AS feature_value FROM reach_metrics""")
def _(t):
    return reach_rows(t)


# Delivery rows carry network, market, hour and date; one provider reports whole weeks besides.
_ROLES = (("Network", ""), ("Market", ""), ("Hour", ""), ("Date", ""))
_DELIVERY = tuple(
    providers.Provider(p, _ROLES + ((("Week", ""),) if p == providers.ANCHOR else ())) for p in fx.PROVIDERS
)


def delivery_fact(t, dayparts="standard"):
    """The same fact as from the provider sheets, straight from the delivery rows.

    One pass sums each row under its network, its market and its date with hour, which stay few however
    many rows there are; hours, dates and weeks are then made from the sums per date and hour.
    """
    roles = cuts_of(
        ("role", "label"),
        Network=F.col("raw_network"),
        Market=F.col("city"),
        Time=F.concat_ws(" ", F.col("event_date").cast("string"), F.lpad(F.col("hour").cast("string"), 2, "0")),
    )
    keys = ["brand", "mvpd", "role", "label"]
    sums = group_sum(fx.measured(t).select("brand", "mvpd", "impressions", roles), keys)
    date, hour = F.split("label", " ")[0], F.split("label", " ")[1]
    role, is_time = F.col("role"), F.col("role") == "Time"
    parts = cuts_of(
        ("part", "value"),
        Network=F.when(role == "Network", F.col("label")),
        Market=F.when(role == "Market", F.col("label")),
        Hour=F.when(is_time, F.concat(hour, F.lit(":00:00"))),
        Date=F.when(is_time, date),
        Week=F.when(is_time & (F.col("mvpd") == providers.ANCHOR), F.trunc(date.try_cast("date"), "week").cast("string")),
    )
    parts_of_sums = sums.select("brand", "mvpd", "impressions", parts)
    records = group_sum(parts_of_sums.withColumnsRenamed({"part": "role", "value": "label"}), keys)
    return providers.provider_cuts(records, fx.net_map(t), fx.dma_map(t), _DELIVERY, dayparts)


def fact(t):
    """From the workbooks, a fifth provider's dimension-tagged report, and the reach reports; ``delivery_fact`` is what the
    tests hold the workbooks against."""
    tagged = providers.long_cuts(fx.dimension_long(t), fx.net_map(t), fx.dma_map(t), "BrandA", AGENCY)
    books = workbooks(t)
    return report.merged_fact(provider_fact(t, books).unionByName(tagged), reach_rows(t, books))


@query("job_comingle_fact", """
SELECT feature_value, brand, metric, mvpd, data_type, metric_type, mvpd || ' ' || metric_type AS column_name FROM fact""")
def _(t):
    return fact(t)


def all_cuts(cuts):
    """All report tables in one, as cut_name, feature_value, brand, dma_code and the metric columns."""
    tables = []
    for name, cut in cuts.items():
        if name == "Summary":
            cut = cut.withColumnRenamed("cut", "feature_value")
        tables.append(cut.withColumn("cut_name", F.lit(name)))
    return union_by_name(*tables)


def _report_sql(names):
    metric_types = ["Impressions", "Reach", "Frequency"]
    columns = [(f"{p} {m}", p, m) for m in metric_types for p in names]
    pick = "max(metric) FILTER (mvpd = '{1}' AND metric_type = '{2}')"
    summary = ", ".join(f"coalesce({pick.format(*c)}, 0) AS \"{c[0]}\"" for c in columns)
    others = ", ".join((pick.format(*c) if c[2] == "Impressions" else "NULL::DOUBLE") + f' AS "{c[0]}"' for c in columns)
    return f"""
SELECT 'Summary' AS cut_name, data_type AS feature_value, brand, NULL::BIGINT AS dma_code, {summary}
FROM fact WHERE feature_value = 'Total' AND data_type <> 'Summary' GROUP BY data_type, brand
UNION ALL
SELECT c.cut_name, feature_value, brand, max(CASE WHEN data_type = 'Market' THEN m.dma_code END), {others}
FROM fact JOIN (VALUES ('Dayparts','Daypart'), ('Networks','Network'), ('Market','Market'), ('Day of Week','Day'), ('Week','Week')) AS c(cut_name, dt)
  ON data_type = dt LEFT JOIN dma_map m ON feature_value = corrected_dma GROUP BY c.cut_name, feature_value, brand"""


REPORT_SQL = _report_sql([*REPORTED, "Total"])


@query("job_report_cuts", REPORT_SQL)
def _(t):
    return all_cuts(report.report_cuts(fact(t), fx.dma_map(t), REPORTED))


@query("job_report_totals_only", _report_sql(["Total"]))
def _(t):
    return all_cuts(report.report_totals_only(fact(t), fx.dma_map(t)))


@query("job_graph_edges", """
SELECT src, dst, CASE WHEN src IN (SELECT "from" FROM both_edges) THEN CASE WHEN src % 2 = 0 THEN 'blue' ELSE 'orange' END END AS src_color,
  CASE WHEN dst IN (SELECT "from" FROM both_edges) THEN CASE WHEN dst % 2 = 0 THEN 'blue' ELSE 'orange' END END AS dst_color
FROM (SELECT DISTINCT least("from", "to") AS src, greatest("from", "to") AS dst FROM both_edges WHERE "from" <> "to")""")
def _(t):
    return graph.graph_edges(fx.best_friends(t), fx.gets_on_with(t))



@query("job_train_test_split", """
SELECT event_id, user_id, event_type, CASE WHEN i <= round(0.75 * n) THEN 'train' ELSE 'test' END AS split
FROM (SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS i, count(*) OVER () AS n FROM events)""")
def _(t):
    return learning.train_test_split(t.events.select("event_id", "user_id", "event_type"), "event_id")


@query("job_neural_net", """
SELECT h AS hidden, attention, true AS learned, count(*) AS n FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)),
  l_orderkey, l_linenumber, l_partkey, l_suppkey) AS i, count(*) OVER () AS c FROM attention), (VALUES (1::BIGINT), (5::BIGINT)) AS v(h)
WHERE i > round(0.75 * c) GROUP BY ALL""")
def _(t):
    return learning.net_fits(fx.attention(t), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
