"""Scalar functions, each over a whole table."""

from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.functions import arrays as arr
from tallyloom.functions import calendar as cal
from tallyloom.functions import text as tx
from tallyloom.operators.columns import ratio
from tallyloom.plans import levels
from tallyloom.plans.graph import vertex_color
from tallyloom.plans.weekly import provider_spans, week_anchor, week_calendar


@query("str_lower_upper", "SELECT event_id, lower(raw_network) AS low, upper(raw_network) AS up FROM delivery")
def _(t):
    return fx.delivery(t).select("event_id", F.lower("raw_network").alias("low"), F.upper("raw_network").alias("up"))


@query("str_trim", "SELECT event_id, raw_network AS trimmed FROM delivery")
def _(t):
    padded = F.concat(F.lit("  "), F.col("raw_network"), F.lit(" \t\n"))
    return fx.delivery(t).select("event_id", tx.strip(padded).alias("trimmed"))


@query("str_contains", """
SELECT event_id, contains(raw_network, 'ew') AS has_word, regexp_matches(lower(raw_network), 'view|sign') AS fits FROM delivery""")
def _(t):
    name = F.col("raw_network")
    return fx.delivery(t).select(
        "event_id", tx.contains_word(name, "ew").alias("has_word"), tx.matches(name, "view|sign").alias("fits")
    )


@query("str_replace_chain", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN day ELSE left(day, 3) END AS raw, day AS anchored,
  CASE WHEN event_id % 2 = 0 THEN day || substr(day, 4) ELSE day END AS loose FROM delivery""")
def _(t):
    # Half of the rows have short names, half have long ones, which the loose chain lengthens again.
    names = {k: v for k, v in cal.DAY_ABBREVIATIONS.items() if len(k) == 3}
    date = F.col("event_date")
    raw = F.when(F.col("event_id") % 2 == 0, cal.day_name(date)).otherwise(F.date_format(date, "E"))
    rows = fx.delivery(t).select("event_id", raw.alias("raw"))
    return rows.select(
        "*",
        tx.replace_chain(F.col("raw"), names).alias("anchored"),
        tx.replace_chain(F.col("raw"), names, anchored=False).alias("loose"),
    )


@query("parse_number_text", "SELECT event_id, imp::DOUBLE + 0.12345::DOUBLE AS impressions FROM delivery")
def _(t):
    priced = F.concat(F.lit("$"), F.col("impressions_text"), F.lit(".12345"))  # 'n/a.12345' is no number either
    return fx.delivery(t).select("event_id", tx.parse_number(priced).cast("double").alias("impressions"))


@query("to_numeric_coerce", """
SELECT event_id, TRY_CAST(impressions_text AS DOUBLE) AS impressions, TRY_CAST(impressions_text || 'e15' AS DOUBLE) AS large FROM delivery""")
def _(t):
    text = F.col("impressions_text")
    return fx.delivery(t).select("event_id", tx.try_number(text).alias("impressions"), tx.try_number(F.concat(text, F.lit("e15"))).alias("large"))


@query("str_split_first", "SELECT event_id, city FROM delivery")
def _(t):
    return fx.delivery(t).select("event_id", tx.split_first(F.col("raw_market"), ", ").alias("city"))


@query("str_split_two", """
SELECT n_nationkey::BIGINT AS n_nationkey, e.event_id, 'R-' || n_name AS name, (500 + n_nationkey) || '|x' AS code
FROM events e JOIN nation ON e.user_id % 25 = n_nationkey""")
def _(t):
    joined = t.events.join(t.nation, F.col("user_id") % 25 == F.col("n_nationkey"))
    both = F.concat(F.lit("R-"), F.col("n_name"), F.lit("|"), (F.lit(500) + F.col("n_nationkey")).cast("string"), F.lit("|x"))
    name, code = tx.split_into(both, "|", 2)
    return joined.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "event_id", name.alias("name"), code.alias("code"))


@query("str_split_tokens", """
SELECT event_id, brand AS token_1, mvpd AS token_2, 'end of campaign report' AS token_3 FROM delivery""")
def _(t):
    file = F.concat_ws(" ", "brand", "mvpd", F.lit("end of campaign report"))
    tokens = tx.split_into(file, " ", 3)
    return fx.delivery(t).select("event_id", *[c.alias(f"token_{i}") for i, c in enumerate(tokens, start=1)])


@query("str_concat", """
SELECT show_id, rating || '|' || country AS rated_country, type || ' ' || duration AS label FROM titles""")
def _(t):
    return fx.titles(t).select(
        "show_id",
        F.concat("rating", F.lit("|"), "country").alias("rated_country"),
        F.concat("type", F.lit(" "), "duration").alias("label"),
    )


@query("str_last_n", "SELECT event_id, right(raw_market, 8) AS ending, raw_network[-40:] AS whole FROM delivery")
def _(t):
    return fx.delivery(t).select(
        "event_id", tx.last_n(F.col("raw_market"), 8).alias("ending"), tx.last_n(F.col("raw_network"), 40).alias("whole")
    )


@query("join_to_text", "SELECT doc_id, array_to_string(items, ',') AS items_text FROM document_words")
def _(t):
    return fx.document_words(t).select("doc_id", tx.join_items(F.col("items")).alias("items_text"))


@query("quote_in_list", r"""
SELECT doc_id, '(' || array_to_string(list_transform(string_split(text, ','),
  lambda x: '''' || regexp_replace(x, '^\s+|\s+$', '', 'g') || ''''), ',') || ')' AS in_list FROM documents""")
def _(t):
    return t.documents.select("doc_id", tx.quote_in_list(F.col("text")).alias("in_list"))


@query("title_case", """
SELECT p_partkey, array_to_string(list_transform(range(1, length(s) + 1),
  lambda i: CASE WHEN i > 1 AND regexp_matches(substr(s, i - 1, 1), '[A-Za-z]') THEN lower(substr(s, i, 1)) ELSE upper(substr(s, i, 1)) END), '') AS header
FROM (SELECT p_partkey, p_name || ' 9am-' || p_type || ' it''s' AS s FROM part)""")
def _(t):
    raw = F.concat("p_name", F.lit(" 9am-"), "p_type", F.lit(" it's"))
    return t.part.select("p_partkey", tx.title_case(raw).alias("header"))


@query("case_when_levels", "SELECT student_id, window_name, benchmark_category, level FROM screening")
def _(t):
    return fx.screening(t).select(
        "student_id", "window_name", "benchmark_category", levels.level_of(F.col("benchmark_category")).alias("level")
    )


@query("case_when_binary", "SELECT edge_id, CASE WHEN gender_from = 'male' THEN 'blue' ELSE 'orange' END AS color FROM both_edges")
def _(t):
    from tallyloom.plans.graph import gender_code

    edges = fx.best_friends(t).unionByName(fx.gets_on_with(t))
    return edges.select("edge_id", vertex_color(gender_code(F.col("gender_from"))).alias("color"))


@query("daypart_standard", "SELECT event_id, hour, daypart FROM dayparted")
def _(t):
    return fx.delivery(t).select("event_id", "hour", cal.daypart(F.col("hour")).alias("daypart"))


@query("daypart_custom", "SELECT event_id, hour, custom_daypart AS daypart FROM dayparted")
def _(t):
    return fx.delivery(t).select("event_id", "hour", cal.daypart(F.col("hour"), "custom").alias("daypart"))


@query("daypart_from_label", """
SELECT mvpd, display_by, CASE WHEN display_by = 'Total' THEN 'Total' ELSE daypart END AS daypart FROM hour_sheet
LEFT JOIN (SELECT DISTINCT clock, daypart FROM dayparted) ON display_by = clock""")
def _(t):
    return fx.hour_sheet(t).select("mvpd", "display_by", cal.daypart_of_label(F.col("display_by")).alias("daypart"))


@query("fill_null", "SELECT show_id, coalesce(rating, 'Unassigned') AS rating, coalesce(country, 'Unassigned') AS country FROM titles")
def _(t):
    return fx.titles(t).select("show_id", "rating", "country").fillna("Unassigned", subset=["rating", "country"])


@query("round_half_even", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount <> 0 THEN round_even(l_quantity / l_discount, 2) END AS ratio FROM lineitem""")
def _(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.bround(ratio(F.col("l_quantity"), F.col("l_discount")), 2).alias("ratio")
    )


@query("date_parse_no_year", "SELECT event_id, event_date AS parsed FROM delivery")
def _(t):
    text = F.date_format("event_date", "d-MMM")
    return fx.delivery(t).select("event_id", cal.date_without_year(text, 2024).alias("parsed"))


@query("time_parse", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN hour END AS hour, CASE WHEN event_id % 2 = 0 THEN '2020-01-01' END AS day FROM delivery""")
def _(t):
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00:00"))).otherwise("later")
    time = cal.time_on(text)
    return fx.delivery(t).select(
        "event_id", F.hour(time).cast("bigint").alias("hour"), F.date_format(time, "yyyy-MM-dd").alias("day")
    )


@query("day_of_week", "SELECT event_id, day_num, day AS day_name FROM delivery")
def _(t):
    date = F.col("event_date")
    return fx.delivery(t).select(
        "event_id", cal.day_number(date).cast("bigint").alias("day_num"), cal.day_name(date).alias("day_name")
    )


@query("date_add_days", "SELECT event_id, event_date + 6 AS plus_6, event_date + 7 AS plus_7 FROM delivery")
def _(t):
    return fx.delivery(t).select("event_id", F.date_add("event_date", 6).alias("plus_6"), F.date_add("event_date", 7).alias("plus_7"))


@query("date_format", "SELECT event_id, strftime(event_date, '%Y-%m-%d') AS week FROM delivery")
def _(t):
    return fx.delivery(t).select("event_id", F.date_format("event_date", "yyyy-MM-dd").alias("week"))


@query("week_calendar", """
SELECT brand, CAST(unnest(generate_series(first, last, INTERVAL 7 DAY)) AS DATE) AS first_date,
  CAST(unnest(generate_series(first, last, INTERVAL 7 DAY)) AS DATE) + 6 AS last_date,
  'Week ' || unnest(range(1, CAST(floor((last - first) / 7) AS BIGINT) + 2)) AS week_num
FROM (SELECT brand, min(first) AS first, max(last) AS last FROM spans GROUP BY brand)""")
def _(t):
    return week_calendar(week_anchor(provider_spans(fx.delivery(t)), anchor=None))


@query("week_anchor", """
SELECT brand, CASE WHEN a IS NULL THEN f ELSE a - CAST(7 * ceil(greatest(a - f, 0) / 7) AS INTEGER) END AS first, last FROM (
  SELECT brand, min(first) AS f, min(CASE WHEN mvpd IN ('Comcast', 'Verizon') THEN first END) AS a, max(last) AS last FROM (
    SELECT brand, mvpd, CASE WHEN mvpd IN ('Comcast', 'Verizon') THEN first + 10 ELSE first END AS first,
      CASE WHEN mvpd IN ('Comcast', 'Verizon') THEN last + 10 ELSE last END AS last FROM spans) GROUP BY brand)""")
def _(t):
    # One provider of each brand starts ten days late and still sets the rhythm of the weeks.
    late = F.col("mvpd").isin("Comcast", "Verizon")
    rows = fx.delivery(t).select(
        "brand",
        F.when(late, "anchor").otherwise(F.col("mvpd")).alias("mvpd"),
        F.when(late, F.date_add("event_date", 10)).otherwise(F.col("event_date")).alias("event_date"),
    )
    return week_anchor(provider_spans(rows), "anchor")


@query("array_element_slice", """
SELECT doc_id, items[1] AS first_item, items[-1] AS last_item, array_to_string(items[2:5], ',') AS items_1_5,
  array_to_string(items[1:6:2], ',') AS items_0_6_2 FROM document_words""")
def _(t):
    a = F.col("items")
    return fx.document_words(t).select(
        "doc_id",
        arr.item(a, 0).alias("first_item"),
        arr.item(a, -1).alias("last_item"),
        F.array_join(arr.items(a, 1, 5), ",").alias("items_1_5"),
        F.array_join(arr.items(a, 0, 6, 2), ",").alias("items_0_6_2"),
    )


@query("array_update", """
SELECT doc_id, len(items) AS n_items, array_to_string(list_append(list_transform(items,
  lambda x, i: CASE WHEN i = len(items) THEN 'LAST' WHEN i = 1 THEN 'FIRST' ELSE x END), 'added'), ',') AS changed FROM document_words""")
def _(t):
    a = F.col("items")
    changed = arr.set_item(arr.set_item(a, 0, F.lit("FIRST")), -1, F.lit("LAST"))
    return fx.document_words(t).select(
        "doc_id", F.size(a).cast("bigint").alias("n_items"),
        F.array_join(arr.append(changed, F.lit("added")), ",").alias("changed"),
    )
