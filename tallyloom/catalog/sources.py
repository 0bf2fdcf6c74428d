"""Scans.  The files are written by Spark from the given tables, once per session, and read back."""

from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog.registry import query
from tallyloom.plans.providers import PROVIDERS
from tallyloom.sinks.reports import write_csv
from tallyloom.session import materialize
from tallyloom.sinks.workbooks import write_workbooks
from tallyloom.sources import sheets as sh
from tallyloom.sources.tables import read_csv, read_many_csv
from tallyloom.sources.workbooks import read_workbooks

TITLES = "show_id bigint, type string, title string, rating string, country string, release_year bigint, duration string"


def titles_csv(t):
    return t.once("titles_csv", lambda p: write_csv(fx.titles(t).select(*reversed(fx.titles(t).columns)).withColumn("surplus", F.lit("x")), p))


def networks_csv(t):
    rows = fx.delivery(t).select(
        "event_id", F.concat(F.lit("Réseau "), F.col("raw_network")).alias("network"), "impressions_text"
    )
    return t.once("networks_latin1", lambda p: write_csv(rows, p, encoding="ISO-8859-1"))


def delivery_csv(t):
    note = F.concat(F.lit('first, of "'), F.col("raw_network"), F.lit('",\n"second", of '), F.col("event_id").cast("string"))
    rows = fx.delivery(t).select("event_id", "raw_network", F.when(F.col("event_id") % 3 == 1, note).alias("note"), "impressions_text", "mvpd")
    return t.once("delivery_csv", lambda p: write_csv(rows, p, partition_by=["mvpd"], escape='"'))


def write_files(t):
    """All files that queries read back, so that a clock can start after they are there."""
    for written in (titles_csv, networks_csv, delivery_csv, fx.source_files, fx.latin_files, fx.provider_files, source_books):
        written(t)


@query("read_csv", "SELECT * FROM titles")
def _(t):
    return read_csv(t.spark, titles_csv(t), TITLES)  # the file has other columns, in another order


@query("read_csv_encoded", "SELECT event_id, 'Réseau ' || raw_network AS network FROM delivery")
def _(t):
    return read_csv(
        t.spark, networks_csv(t), "event_id bigint, network string, impressions_text string", "ISO-8859-1", ["event_id", "network"]
    )


@query("read_many_csv", """
SELECT mvpd AS source, event_id, raw_network, impressions_text,
  CASE WHEN event_id % 3 = 1 THEN 'first, of "' || raw_network || '",' || chr(10) || '"second", of ' || event_id END AS note
FROM delivery""")
def _(t):
    return read_many_csv(t.spark, delivery_csv(t), "event_id bigint, raw_network string, impressions_text string, note string")


def source_lines(t):
    return sh.read_sheet_set(t.spark, fx.source_files(t))


def provider_lines(t):
    return sh.read_sheet_set(t.spark, fx.provider_files(t))


def first_cells(lines, n):
    return lines.select("file", "sheet", *[sh.cell_at(i).alias(f"c{i}") for i in range(n)])


@query("read_sheet_set", """
SELECT file, sheet, c0, c1, NULL::VARCHAR AS c9 FROM source_lines
UNION ALL SELECT file, 'Reach-Frequency', c0, c6, c9 FROM frequency_lines
UNION ALL SELECT file, sheet, c0, c1, NULL FROM latin_lines""")
def _(t):
    # The two-column sheets, one set in another encoding, and the ten-column one, whose lines are of different length.
    latin = sh.read_sheet_set(t.spark, fx.latin_files(t), sep=";", encoding="ISO-8859-1")
    narrow = first_cells(source_lines(t).unionByName(latin), 2).withColumn("c9", F.lit(None).cast("string"))
    wide = provider_lines(t).filter("sheet = 'Reach-Frequency'")
    return narrow.unionByName(wide.select("file", "sheet", sh.cell_at(0).alias("c0"), sh.cell_at(6).alias("c1"), sh.cell_at(9).alias("c9")))


@query("skip_rows", "SELECT file, sheet, c0, c1 FROM source_lines WHERE c1 IS NOT NULL")
def _(t):
    return first_cells(sh.skip_rows(source_lines(t), 4), 2)  # two of them are blank


@query("list_sheets", "SELECT DISTINCT file, sheet FROM source_cells")
def _(t):
    return sh.list_sheets(source_lines(t)).drop("position")


@query("promote_header", "SELECT file, sheet, c0 AS display_by, c1 AS impressions FROM source_cells")
def _(t):
    picked = sh.promote_header(source_lines(t), ["Display By", fx.SPLIT_HEADER])
    return picked.select("file", "sheet", F.col("Display By").alias("display_by"), F.col(fx.SPLIT_HEADER).alias("impressions"))


@query("classify_files", """
SELECT CASE WHEN event_id % 10 IN (0, 1) THEN 'none' ELSE mvpd END AS role, coalesce(sum(imp), 0)::DOUBLE AS impressions, count(*) AS n
FROM delivery GROUP BY 1""")
def _(t):
    # Each row names the file it came from; a fifth of them are temp files or reach reports.
    kind = F.col("event_id") % 10
    name = (
        F.when(kind == 0, F.concat(F.lit("~$"), F.col("mvpd"), F.lit(" report.xlsx")))
        .when(kind == 1, F.concat("mvpd", F.lit(" Reach.xlsx")))
        .otherwise(F.concat("brand", F.lit(" "), F.upper("mvpd"), F.lit(" report.xlsx")))
    )
    words = {p.name.lower(): p.name for p in PROVIDERS}
    role = F.coalesce(sh.classify_file(name, words, exclude=["reach"]), F.lit("none"))
    rows = fx.measured(t).withColumn("role", role)
    n = rows.groupBy("role").agg(F.sum("impressions").cast("double").alias("impressions"), F.count("*").alias("n"))
    return n.fillna(0.0, subset=["impressions"])


# Words of sheet names.
_ROLE_RULES = [
    ("Date", "daily|date"), ("Market", "geo|market|dma"), ("Network", "net"), ("Hour", "hour"),
    ("Day of Week", "day|dow"), ("Creative", "creative"), ("Reach", "reach|summary"),
]
_FITS = [f"CASE WHEN regexp_matches(lower(p.sheet), '{p}') THEN '{r}' END" for r, p in _ROLE_RULES]
_FIRST = " UNION ALL ".join(
    f"SELECT file, arg_min(sheet, position) AS sheet, '{r}' AS role FROM provider_sheets WHERE regexp_matches(lower(sheet), '{p}') GROUP BY file"
    for r, p in _ROLE_RULES)


@query("resolve_sheet_role", f"""
SELECT p.file, p.sheet, coalesce({', '.join(reversed(_FITS))}) AS role, f.first_for
FROM provider_sheets p LEFT JOIN (SELECT file, sheet, string_agg(role, ',' ORDER BY role) AS first_for FROM ({_FIRST}) GROUP BY file, sheet) f
ON p.file = f.file AND p.sheet = f.sheet""")
def _(t):
    sheets = materialize(sh.list_sheets(provider_lines(t)), "sheets")
    first = sh.first_sheet_per_role(sheets, _ROLE_RULES).groupBy("file", "sheet").agg(
        F.array_join(F.sort_array(F.collect_set("role")), ",").alias("first_for")
    )
    last_wins = sheets.withColumn("role", sh.sheet_role(F.col("sheet"), _ROLE_RULES, precedence="last"))
    return last_wins.drop("position").join(first, ["file", "sheet"], "left")


def _types_sql():
    """Every column of every sheet with its type, by the rules that the fixture's sheets are written by."""
    columns = []
    for mvpd, dimension, sheet, *headers, _ in fx.LAYOUTS:
        dated = dimension == "week" or (dimension == "date" and mvpd != "Spectrum")  # one provider writes every other date without its year
        columns += [(mvpd, sheet, i, h, t) for i, (h, t) in enumerate(zip(headers, ["date" if dated else "text", "text", "integer"], strict=True))]
    reach = ["Display By", "Line", "Start", "End", "Market", "Audience", "Households", "Frequency", "Share", "Note"]
    columns += [("Cox", "Reach-Frequency", i, h, {6: "integer", 7: "decimal"}.get(i, "text")) for i, h in enumerate(reach)]
    columns += [("Verizon", "Order Summary", i, h, t) for i, (h, t) in enumerate([("Order", "integer"), ("Impressions", "text"), ("Households", "integer")])]
    values = ", ".join(f"('{m}', '{s}', {i}, '{h}', '{t}')" for m, s, i, h, t in columns)
    return f"""
SELECT p.file, p.sheet, v.i::INTEGER AS "column", v.name, v.type FROM provider_sheets p
JOIN (VALUES {values}) AS v(mvpd, sheet, i, name, type) ON p.sheet = v.sheet AND p.file LIKE '% ' || v.mvpd || ' report'"""


@query("infer_sheet_types", _types_sql())
def _(t):
    lines = provider_lines(t)
    return sh.sheet_types(sh.clean_records(sh.promote_header(lines))).drop("n")


def source_books(t):
    """The day and hour sheets as workbooks, one a provider."""
    return t.once("source_books", lambda path: write_workbooks(source_lines(t).withColumn("position", F.when(F.col("sheet") == "Day", 1).otherwise(2)), path))


@query("read_workbooks", "SELECT file, sheet, CASE sheet WHEN 'Day' THEN 1 ELSE 2 END AS position, c0, c1 FROM source_lines")
def _(t):
    rows = materialize(read_workbooks(t.spark, source_books(t)), "workbook_rows")
    return rows.select("file", "sheet", "position", sh.cell_at(0).alias("c0"), sh.cell_at(1).alias("c1"))
