"""Inputs of the jobs, derived from the star-schema and event tables by fixed rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import calendar as cal
from tallyloom.functions.text import AMOUNT, comma_text, parse_number, split_first
from tallyloom.operators.aggregates import exact_sum, group_sum
from tallyloom.operators.joins import literal_table
from tallyloom.operators.totals import cuts_of
from tallyloom.session import materialize, new_path

PROVIDERS = ["Comcast", "Spectrum", "Cox", "Verizon"]

_written: dict[tuple[str, str, str], str] = {}


# Explicit schemas, so that no job has to open files before the query itself starts.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class Tables:
    """The Parquet tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def once(self, name: str, write) -> str:
        """Path of a derived file set; ``write(path)`` runs on the first request of an application only."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _written:
            path = new_path(self.spark, name)
            write(path)
            _written[key] = path
        return _written[key]


def delivery(t: Tables) -> DataFrame:
    """One row per delivered event, with dirty number text, mixed-case networks and 'City, ST' markets."""
    n = F.round(F.col("value") * 100).cast("bigint")
    uid = F.col("user_id")
    return t.events.select(
        "event_id",
        "user_id",
        F.when(uid % 4 == 0, "Comcast").when(uid % 4 == 1, "Spectrum").when(uid % 4 == 2, "Cox").otherwise("Verizon").alias("mvpd"),
        F.when(uid % 2 == 0, "BrandA").otherwise("BrandB").alias("brand"),
        F.when(F.col("event_id") % 3 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("raw_network"),
        F.concat(F.lit("NATION_"), (uid % 25).cast("string"), F.lit(", XX")).alias("raw_market"),
        F.to_date("ts").alias("event_date"),
        F.hour("ts").cast("bigint").alias("hour"),
        F.when(F.col("event_id") % 97 == 0, "n/a")
        .when(F.col("event_id") % 5 == 0, comma_text(n))
        .otherwise(n.cast("string"))
        .alias("impressions_text"),
    )


def measured(t: Tables) -> DataFrame:
    """Delivery with the impressions as numbers and the market's city."""
    return delivery(t).withColumns(
        {"impressions": parse_number(F.col("impressions_text"), AMOUNT), "city": split_first(F.col("raw_market"), ", ")}
    )


def net_map(t: Tables) -> DataFrame:
    """Raw network names, as written and in capitals, to clean ones; 'error' is unknown."""
    names = {"signup": "Net S", "purchase": "Net P", "view": "Net V", "click": "Net C"}
    rows = [(spelling, clean) for raw, clean in names.items() for spelling in (raw, raw.upper())]
    return literal_table(t.spark, [("feature_value", "string"), ("corrected_network", "string")], rows)


def dma_map(t: Tables) -> DataFrame:
    """Geography to market name and code; four nations are unknown."""
    known = t.nation.filter(~F.col("n_nationkey").isin(3, 22, 23, 24))
    return known.join(t.region, known.n_regionkey == F.col("r_regionkey")).select(
        F.col("n_name").alias("geography"),
        F.concat_ws("-", "r_name", "n_name").alias("corrected_dma"),
        (F.lit(500) + F.col("n_nationkey")).cast("bigint").alias("dma_code"),
    )


def titles(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.select(
        key.alias("show_id"),
        F.when(key % 3 > 0, "Movie").otherwise("TV Show").alias("type"),
        F.col("p_name").alias("title"),
        F.when(key % 50 != 0, F.col("p_brand")).alias("rating"),
        F.when(key % 11 != 0, F.col("p_type")).alias("country"),
        (F.lit(1970) + F.col("p_size")).cast("bigint").alias("release_year"),
        F.concat(F.col("p_size").cast("string"), F.lit(" min")).alias("duration"),
    )


def indicators(t: Tables) -> DataFrame:
    year = F.year("o_orderdate").cast("bigint")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.col("o_orderkey").alias("row_id"),
        year.alias("year_start"),
        year.alias("year_end"),
        F.col("n_name").alias("location_desc"),
        F.col("o_orderpriority").alias("topic"),
        F.col("c_mktsegment").alias("question"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("data_value"),
    )


def screening(t: Tables) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return t.orders.select(
        F.col("o_custkey").alias("student_id"),
        F.concat(F.lit("First"), F.col("o_custkey").cast("string")).alias("first_name"),
        F.concat(F.lit("Last"), F.col("o_custkey").cast("string")).alias("last_name"),
        (F.col("o_custkey") % 12).cast("bigint").alias("grade"),
        F.lit("Screening").alias("activity_type"),
        F.when(status == "F", "Fall Window").otherwise("Other Window").alias("window_name"),
        F.when(priority == "1-URGENT", "Urgent Intervention")
        .when(priority == "2-HIGH", "Intervention")
        .when(priority == "3-MEDIUM", "On Watch")
        .when(priority == "4-NOT SPECIFIED", "At/Above Benchmark")
        .otherwise("Not Screened")
        .alias("benchmark_category"),
        F.when(status == "O", "FALL_WINTER").otherwise("OTHER").alias("sgp_vector"),
    )


def edges(t: Tables, half: int) -> DataFrame:
    """One of the two edge lists; together they hold every event."""
    return t.events.filter(F.col("event_id") % 2 == half).select(
        F.col("user_id").alias("from"),
        (F.col("event_id") % 150).alias("to"),
        F.when(F.col("user_id") % 2 == 0, "male").otherwise("female").alias("gender_from"),
        F.col("event_id").alias("edge_id"),
    )


def best_friends(t: Tables) -> DataFrame:
    return edges(t, 0)


def gets_on_with(t: Tables) -> DataFrame:
    return edges(t, 1)


def attention(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (F.col("l_quantity") / 50).alias("eyes"),
        (F.col("l_discount") * 10).alias("face_forward"),
        (F.col("l_tax") * 10).alias("chin_up"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("attention"),
    )


def document_words(t: Tables) -> DataFrame:
    """The words of each whole text, as an array per row."""
    return t.documents.select("doc_id", "text", F.split("text", " ").alias("items"))


def dimension_long(t: Tables) -> DataFrame:
    """One provider's report as (dimension_name, dimension_value, impressions, uniques) text rows.

    All dimensions come from one pass; each dimension also has a Total row.
    """
    dimensions = cuts_of(
        ("dimension_name", "dimension_value"),
        **{
            "Network": F.col("raw_network"),
            "Market": F.col("raw_market"),
            "Day of Week": cal.day_name(F.col("event_date")),
            "Hour": F.col("hour").cast("string"),
            "Week": F.trunc("event_date", "week").cast("string"),
            "Campaign": F.col("brand"),
        },
    )
    sums = materialize(
        group_sum(measured(t).select("impressions", dimensions), ["dimension_name", "dimension_value"]), "dimensions"
    )
    households = measured(t).groupBy("brand").agg(F.countDistinct("user_id").alias("uniques"))
    parts = sums.join(
        households, (F.col("dimension_name") == "Campaign") & (F.col("dimension_value") == F.col("brand")), "left"
    ).drop("brand")
    totals = parts.groupBy("dimension_name").agg(
        exact_sum("impressions").alias("impressions"), F.sum("uniques").alias("uniques")
    ).withColumn("dimension_value", F.lit("Total"))
    whole = parts.unionByName(totals)
    return whole.select(
        "dimension_name",
        "dimension_value",
        F.col("impressions").cast("bigint").cast("string").alias("impressions_text"),
        F.col("uniques").cast("string").alias("uniques_text"),
    )


def _label_sums(t: Tables, label) -> DataFrame:
    """Impressions per provider and label, as comma text, with a Total row per provider."""
    sums = group_sum(measured(t).withColumn("display_by", label), ["mvpd", "display_by"])
    totals = group_sum(sums, ["mvpd"]).withColumn("display_by", F.lit("Total"))
    return sums.unionByName(totals).select("mvpd", "display_by", comma_text(F.col("impressions")).alias("impressions_text"))


def day_sheet(t: Tables) -> DataFrame:
    """mvpd, display_by ('Monday' ... 'Total'), impressions_text ('1,234')."""
    return _label_sums(t, cal.day_name(F.col("event_date")))


def clock_label(hour):
    return F.concat(
        F.when(hour % 12 == 0, 12).otherwise(hour % 12).cast("string"), F.lit(":00 "), F.when(hour < 12, "AM").otherwise("PM")
    )


def hour_sheet(t: Tables) -> DataFrame:
    """mvpd, display_by ('12:00 AM' ... 'Total'), impressions_text."""
    return _label_sums(t, clock_label(F.col("hour")))


def source_files(t: Tables) -> str:
    """A sheet set of day and hour sheets per provider, each with four rows above its header: a title, a blank row, a note
    that goes over two lines, another blank row.  The header goes over two lines too."""
    return t.once("source_files", lambda path: _write_lines(_source_lines(t), path))


# Cells with line breaks, separators and quotes in them.
SPLIT_NOTE = 'All dates,\nas "agreed"'
SPLIT_HEADER = "Imp\nressions"


def _source_lines(t: Tables) -> DataFrame:
    def body(sheet: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.concat("mvpd", F.lit(" report")).alias("file"), F.lit(sheet).alias("sheet"),
            F.when(F.col("display_by") == "Total", 6).otherwise(5).alias("rank"), F.col("display_by").alias("c0"),
            F.col("impressions_text").alias("c1"),
        )

    rows = body("Day", day_sheet(t)).unionByName(body("Hour", hour_sheet(t)))
    none = F.lit(None).cast("string")
    top = F.inline(F.array(*[
        F.struct(F.lit(rank).alias("rank"), c0.alias("c0"), c1.alias("c1"))
        for rank, (c0, c1) in enumerate([
            (F.lit("Delivery report"), none), (none, none), (F.lit(SPLIT_NOTE), none), (none, none), (F.lit("Display By"), F.lit(SPLIT_HEADER)),
        ])
    ]))
    return rows.unionByName(rows.select("file", "sheet").distinct().select("file", "sheet", top))


def _write_lines(lines: DataFrame, path: str) -> None:
    """Write report sheets as plain text, rows without any cell as blank lines."""
    cells = [c for c in lines.columns if c.startswith("c")]
    quoted = F.array(*[F.when(F.col(c).rlike('[",\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(c, F.lit(""))) for c in cells])
    line = F.when(F.coalesce(*cells).isNotNull(), F.array_join(quoted, ",")).otherwise("")
    rows = lines.repartition("file", "sheet").sortWithinPartitions("file", "sheet", "rank", "c0")
    rows.select("file", "sheet", line.alias("value")).write.partitionBy("file", "sheet").text(path)


def latin_files(t: Tables) -> str:
    """A workbook with one sheet in ISO-8859-1, semicolons between its cells."""
    sums = measured(t).groupBy("raw_network").agg(exact_sum("impressions").cast("bigint").cast("string").alias("c1"))
    rows = sums.select(F.lit(1).alias("rank"), F.concat(F.lit("Réseau "), F.col("raw_network")).alias("c0"), "c1")
    header = rows.limit(1).select(F.lit(0).alias("rank"), F.lit("Réseau").alias("c0"), F.lit("Total;\ndélivré").alias("c1"))
    lines = rows.unionByName(header).withColumns({"file": F.lit("Agence rapport"), "sheet": F.lit("Réseaux")})
    return t.once("latin_files", lambda path: _write_sheets(lines, path, sep=";", encoding="ISO-8859-1"))


def _write_sheets(lines: DataFrame, path: str, mode: str = "error", sep: str = ",", encoding: str = "UTF-8") -> None:
    """Write report sheets.  A sheet has one line per day, hour, market or network, so it fits a task."""
    cells = [c for c in lines.columns if c.startswith("c")]
    (
        lines.repartition("file", "sheet")
        .sortWithinPartitions("file", "sheet", "rank", "c0")
        .select("file", "sheet", *cells)
        .write.mode(mode).partitionBy("file", "sheet")
        .option("sep", sep).option("encoding", encoding).option("escape", '"')
        .csv(path)
    )


def provider_files(t: Tables) -> str:
    """Workbooks 'Brand Provider report' with each provider's own sheet names, headers and formats."""
    def write(path: str) -> None:
        _write_sheets(_provider_lines(t), path)
        sums = materialize(reach_sums(t), "reach_sums")
        for lines in (_frequency_lines(sums), _order_lines(sums)):
            _write_sheets(lines, path, "append")

    return t.once("provider_files", write)


def _two_lines(rows: DataFrame, header: list[str], cells: list) -> DataFrame:
    """A header and one line of cells for each (file, sheet)."""
    lines = [
        F.struct(F.lit(rank).alias("rank"), *[c.alias(f"c{i}") for i, c in enumerate(row)])
        for rank, row in enumerate([[F.lit(h) for h in header], cells])
    ]
    return rows.select("file", "sheet", F.inline(F.array(*lines)))


def _frequency_lines(sums: DataFrame) -> DataFrame:
    """The ten-column reach sheet of one provider: households in the seventh column, frequency in the eighth."""
    rows = reach_sheet(sums, "Cox").select(F.concat("brand", F.lit(" Cox report")).alias("file"), F.lit("5. Reach-Frequency").alias("sheet"), "households", "frequency")
    header = ["Display By", "Line", "Start", "End", "Market", "Audience", "Households", "Frequency", "Share", "Note"]
    cells = [F.lit(x) for x in ("Campaign", "all", "-", "-", "all", "all")] + [F.col("households"), F.col("frequency"), F.lit("100%"), F.lit("end")]
    return _two_lines(rows, header, cells)


def _order_lines(sums: DataFrame) -> DataFrame:
    """The order summary of one provider: impressions with commas, and households."""
    rows = reach_sheet(sums, "Verizon").select(F.concat("brand", F.lit(" Verizon report")).alias("file"), F.lit("6. Order Summary").alias("sheet"), "impressions", "households")
    return _two_lines(rows, ["Order", "Impressions", "Households"], [F.lit("1"), F.col("impressions"), F.col("households")])


# Clock hour to the short daypart names one provider uses.
_SHORT_DAYPARTS = {
    "Overnight": (0, 5), "Early Morning": (6, 8), "AM Day": (9, 11), "PM Day": (12, 15),
    "Early Fringe": (16, 17), "Access": (18, 19), "Prime Time": (20, 22), "Late Fringe": (23, 23),
}
_SHORT_DAYS = ["Mon", "Tue", "Wed", "Thur", "Fri", "Sat", "Sun"]


def _short_daypart():
    short = F.lit(None).cast("string")
    for name, (first, last) in _SHORT_DAYPARTS.items():
        short = F.when(F.col("hour").between(first, last), name).otherwise(short)
    return short


def short_dayparts(t: Tables) -> DataFrame:
    """Delivery with the short daypart names, as ``alias``."""
    return measured(t).withColumn("alias", _short_daypart())


def provider_sums(t: Tables) -> DataFrame:
    """Impressions per brand, provider and each single dimension, all from one pass."""
    date = F.col("event_date")
    dimensions = cuts_of(
        ("dimension", "label"),
        network=F.col("raw_network"),
        market=F.col("city"),
        date=date.cast("string"),
        week=F.trunc("event_date", "week").cast("string"),
        hour=F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00:00")),
        daypart=_short_daypart(),
        day=cal.day_name(date),
        campaign=F.col("brand"),
    )
    sums = group_sum(measured(t).select("brand", "mvpd", "impressions", dimensions), ["brand", "mvpd", "dimension", "label"])
    return sums.withColumn("amount", F.col("impressions").cast("bigint").cast("string")).drop("impressions")


# The sheets of each provider: dimension, sheet name, its three header cells, lines above the header.
LAYOUTS = [
    ("Comcast", "network", "Network", "Display By", "Line", "Impressions", 2),
    ("Comcast", "market", "DMA", "Display By", "Line", "Impressions", 2),
    ("Comcast", "week", "Week", "Display By", "Line", "Impressions", 2),
    ("Comcast", "hour", "Week Hour", "Display By", "Line", "Impressions", 2),
    ("Comcast", "day", "Day of Week", "Display By", "Line", "Impressions", 2),
    ("Comcast", "campaign", "Summary", "Campaign", "Line", "Impressions", 2),
    ("Comcast", "network", "Network by Week", "Display By", "Line", "Impressions", 2),
    ("Spectrum", "network", "Networks", "Network", "Line", "Impressions", 0),
    ("Spectrum", "market", "Geography", "DMA", "DMA Code", "Impressions", 0),
    ("Spectrum", "date", "Daily Delivery", "Date", "Line", "Impressions", 0),
    ("Spectrum", "daypart", "Daypart", "Daypart", "Line", "Impressions", 0),
    ("Spectrum", "day", "Day of Week", "Day", "Line", "Impressions", 0),
    ("Cox", "network", "VOD Network", "Network", "Line", "Net Counted Ads", 0),
    ("Cox", "market", "Geo", "Delivered DMA", "Line", "Imps Delivered", 0),
    ("Cox", "date", "Daily", "Event Date", "Placement Name", "Impressions", 0),
    ("Cox", "hour", "Hourly", "Hour", "Line", "Delivered Impressions", 0),
    ("Verizon", "network", "Network", "Network", "Line", "Total Impressions", 0),
    ("Verizon", "market", "Market", "DMA", "Line", "Total Impressions", 0),
    ("Verizon", "date", "Date", "Date", "Line", "Total Impressions", 0),
    ("Verizon", "hour", "Hourly", "Hour", "Line", "Total Impressions", 0),
    ("Verizon", "day", "DOW", "Day", "Line", "Total Impressions", 0),
]


def _provider_lines(t: Tables) -> DataFrame:
    """Sheet lines for all providers: (file, sheet, rank, c0, c1, c2), written as each provider writes them."""
    names = ["mvpd", "dimension", "sheet", "h0", "h1", "h2"]
    place: dict[str, int] = {}
    rows = []
    for mvpd, dimension, sheet, *rest in LAYOUTS:  # a sheet's name begins with its place in the workbook
        place[mvpd] = place.get(mvpd, 0) + 1
        rows.append((mvpd, dimension, f"{place[mvpd]}. {sheet}", *rest))
    layout = literal_table(t.spark, [(n, "string") for n in names] + [("n_top", "int")], rows)
    sums = provider_sums(t).join(F.broadcast(layout), ["mvpd", "dimension"])
    mvpd, dimension, label = F.col("mvpd"), F.col("dimension"), F.col("label")
    short_day = F.get(F.array(*[F.lit(d) for d in _SHORT_DAYS]), cal.day_rank(label).cast("int"))
    text = (
        F.when((mvpd == "Comcast") & (dimension == "market"), F.upper(label))
        .when((mvpd == "Comcast") & (dimension == "hour"), F.concat(F.lit("Hour "), label))
        .when((mvpd == "Spectrum") & (dimension == "date") & (F.dayofmonth(label.try_cast("date")) % 2 == 0), F.date_format(label.try_cast("date"), "d-MMM"))
        .when((mvpd == "Verizon") & (dimension == "day"), short_day)
        .otherwise(label)
    )
    rows = sums.select(
        F.concat_ws(" ", "brand", "mvpd", F.lit("report")).alias("file"), "sheet", "h0", "h1", "h2", "n_top",
        F.lit(3).alias("rank"), text.alias("c0"), F.lit("all").alias("c1"), F.col("amount").alias("c2"),
    )
    body = materialize(rows, "provider_rows")
    none = F.lit(None).cast("string")
    sheets = body.groupBy("file", "sheet", "h0", "h1", "h2", "n_top").agg(
        F.sum(F.col("c2").cast("decimal(18,2)")).cast("bigint").cast("string").alias("total")
    )
    extra = F.inline(F.array(*[
        F.struct(F.lit(rank).alias("rank"), c0.alias("c0"), c1.alias("c1"), c2.alias("c2"))
        for rank, c0, c1, c2 in [
            (0, F.lit("Campaign report"), none, none),
            (1, F.lit("Prepared for review"), none, none),
            (2, F.col("h0"), F.col("h1"), F.col("h2")),
            (4, F.lit("Total"), none, F.col("total")),
        ]
    ]))
    extras = sheets.select("file", "sheet", "n_top", extra).filter("rank >= 2 - n_top").drop("n_top")
    return body.select("file", "sheet", "rank", "c0", "c1", "c2").unionByName(extras)


def daypart_code(hour):
    """Two-letter daypart codes of the provider that reports hour groups side by side."""
    code = F.lit(None).cast("string")
    for name, first, last in [("LF", 0, 1), ("ON", 2, 5), ("EM", 6, 8), ("DA", 9, 15), ("EF", 16, 19), ("PR", 20, 23)]:
        code = F.when(hour.between(first, last), name).otherwise(code)
    return code


def anchor_weeks(t: Tables) -> DataFrame:
    """Rows of the provider that reports whole weeks, by the first day of the week."""
    return measured(t).filter(F.col("mvpd") == "Comcast").select(
        "brand", "mvpd", F.trunc("event_date", "week").alias("event_date"), "impressions"
    )


def flights(t: Tables) -> DataFrame:
    """Periods of campaigns per brand: uneven, overlapping, with days that none covers, one that ends before it starts,
    one without an end, and one that goes over years."""
    k = F.col("n_nationkey")
    first = F.date_add(F.lit("2024-01-03").cast("date"), (k * 7) % 23)
    last = F.date_add(first, (k * k) % 5 - 1)
    return t.nation.select(
        F.when(k % 2 == 0, "BrandA").otherwise("BrandB").alias("brand"), F.concat(F.lit("flight "), k.cast("string")).alias("flight"),
        F.when(k == 11, F.lit("2021-05-01").cast("date")).otherwise(first).alias("first_date"),
        F.when(k == 11, F.lit("2024-01-12").cast("date")).when(k != 6, last).alias("last_date"),
    )


def wide_hourly(t: Tables) -> DataFrame:
    """One row per provider and hour of the half day; two groups of Daypart, Start, End, Impressions."""
    hourly = measured(t).groupBy("mvpd", "hour").agg(exact_sum("impressions").alias("n"))
    hourly = hourly.withColumn("code", daypart_code(F.col("hour")))
    shown = F.struct(
        F.col("code").alias("d"), F.col("hour").cast("string").alias("s"), (F.col("hour") + 1).cast("string").alias("e"),
        F.col("n").cast("bigint").cast("string").alias("i"),
    )
    pairs = hourly.groupBy("mvpd", (F.col("hour") % 12).alias("pair")).agg(
        F.max(F.when(F.col("hour") < 12, shown)).alias("a"), F.max(F.when(F.col("hour") >= 12, shown)).alias("b")
    )
    groups = []
    for i, g in enumerate(["a", "b"], start=1):
        groups += [
            F.col(f"{g}.d").alias(f"Daypart_{i}"), F.col(f"{g}.s").alias(f"Start_{i}"),
            F.col(f"{g}.e").alias(f"End_{i}"), F.col(f"{g}.i").alias(f"Impressions_{i}"),
        ]
    return pairs.select("mvpd", *groups)


def reach_sums(t: Tables) -> DataFrame:
    """Households and impressions per brand, provider and segment, with a Total segment each.

    Both kinds of rows start from the same sums per household, which Spark computes once.
    """
    households = group_sum(measured(t), ["brand", "mvpd", "city", "user_id"])
    counts = [F.countDistinct("user_id").alias("hh"), exact_sum("impressions").alias("n")]
    total = households.groupBy("brand", "mvpd").agg(*counts).withColumn("segment", F.lit("Total"))
    return total.unionByName(households.groupBy("brand", "mvpd", F.col("city").alias("segment")).agg(*counts))


def reach_file(sums: DataFrame) -> DataFrame:
    """Reach reports of two providers, by file and line.

    A file has a Total segment row and one row per market segment; one provider has a Sub Total further down, the
    other a second file with a single row.  Two more files for each brand name no provider.
    """
    own = sums.filter(F.col("mvpd").isin("Comcast", "Spectrum"))
    file = F.concat_ws(" ", "brand", "mvpd", F.lit("reach.csv")).alias("file")
    is_total = F.col("segment") == "Total"
    whole = own.select(file, F.when(is_total, 1).otherwise(2).cast("bigint").alias("line_no"), "segment", "hh", "n")
    again = own.filter(is_total & (F.col("mvpd") == "Spectrum")).select(file, F.lit(3).cast("bigint").alias("line_no"), F.lit("Sub Total").alias("segment"), "hh", "n")
    second = own.filter(is_total & (F.col("mvpd") == "Comcast")).select(
        F.concat_ws(" ", "brand", "mvpd", F.lit("reach 2.csv")).alias("file"), F.lit(1).cast("bigint").alias("line_no"),
        F.lit("West").alias("segment"), F.lit(1000).cast("bigint").alias("hh"), F.lit(5000).cast(own.schema["n"].dataType).alias("n"),
    )
    nameless = F.inline(F.array(
        F.struct(F.concat("brand", F.lit(" Parallel RF.csv")).alias("file"), F.lit(700).alias("hh"), F.lit(2100).alias("n")),
        F.struct(F.concat("brand", F.lit(" reach.csv")).alias("file"), F.lit(30).alias("hh"), F.lit(90).alias("n")),
    ))
    others = sums.select("brand").distinct().select(nameless).select(
        "file", F.lit(1).cast("bigint").alias("line_no"), F.lit("Total").alias("segment"), F.col("hh").cast("bigint").alias("hh"), F.col("n").cast(own.schema["n"].dataType).alias("n"),
    )
    return whole.unionByName(again).unionByName(second).unionByName(others).select(
        "file",
        "line_no",
        "segment",
        F.concat(F.lit("$"), comma_text(F.col("hh"))).alias("addressable_hh"),
        F.concat(F.lit("$"), comma_text(F.col("hh") * 2)).alias("hh_booked"),
        comma_text(F.col("n")).alias("delivered_impressions"),
    )


def reach_sheet(sums: DataFrame, mvpd: str) -> DataFrame:
    """Reach as two other providers report it: brand, mvpd, impressions, households and frequency texts."""
    frequency = F.bround(F.col("n").cast("double") / F.col("hh"), 2).cast("decimal(18,2)")
    return sums.filter((F.col("mvpd") == mvpd) & (F.col("segment") == "Total")).select(
        "brand", "mvpd", comma_text(F.col("n")).alias("impressions"), F.col("hh").cast("string").alias("households"),
        frequency.cast("string").alias("frequency"),
    )
