"""Provider reports to the canonical fact (feature_value, brand, impressions, mvpd, data_type)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import calendar as cal
from tallyloom.functions.text import AMOUNT, parse_number, split_first, try_number
from tallyloom.operators.aggregates import group_sum
from tallyloom.operators.joins import UNASSIGNED, literal_lookup
from tallyloom.operators.reshape import stack_column_groups
from tallyloom.operators.totals import FACT, cuts_of
from tallyloom.plans.weekly import provider_spans, week_anchor, with_week
from tallyloom.session import materialize
from tallyloom.sources import sheets as sh


@dataclass(frozen=True)
class Provider:
    """How one provider's workbook is to be read.

    ``roles`` are (role, regex) rules on the lower-cased sheet name, most specific first.  Roles are
    Summary, Network, Market, Day, Hour, Daypart, Date and Week.
    """

    name: str
    roles: tuple[tuple[str, str], ...]

    def has(self, role: str) -> bool:
        return any(r == role for r, _ in self.roles)


# Words of each provider's sheet names.
PROVIDERS = (
    Provider(
        "Comcast",
        (("Summary", "summary"), ("Network", "net"), ("Market", "geo|market|dma"), ("Day", "day of week|dow"), ("Hour", "hour"), ("Week", "week"), ("Day", "day")),
    ),
    Provider(
        "Spectrum",
        (("Date", "daily|date"), ("Market", "geo|market|dma"), ("Network", "net"), ("Daypart", "daypart"), ("Day", "day of week")),
    ),
    Provider("Cox", (("Date", "daily|date"), ("Market", "geo|market|dma"), ("Network", "net"), ("Hour", "hour"))),
    Provider(
        "Verizon",
        (("Date", "daily|date"), ("Market", "geo|market|dma"), ("Network", "net"), ("Hour", "hour"), ("Day", "day|dow")),
    ),
)
ANCHOR = "Comcast"  # the provider whose own weeks the others follow


def long_cuts(
    long: DataFrame, net_map: DataFrame, dma_map: DataFrame, brand: str, mvpd: str, dayparts: str = "standard"
) -> DataFrame:
    """Normalise one dimension-tagged report: dimension_name, dimension_value, impressions_text."""
    name, value = F.col("dimension_name"), F.col("dimension_value")
    is_total = value == "Total"
    data_type = (
        F.when(name.isin("Network", "Market", "Week") & ~is_total, name)
        .when((name == "Day of Week") & ~is_total, "Day")
        .when((name == "Hour") & ~is_total, "Daypart")
        .when((name == "Campaign") & is_total, "Summary")
    )
    feature = (
        F.when(name == "Hour", cal.daypart(value.try_cast("int"), dayparts))
        .when(name == "Market", split_first(value, ", "))
        .otherwise(value)
    )
    rows = long.select(
        feature.alias("feature_value"),
        F.lit(brand).alias("brand"),
        parse_number(F.col("impressions_text"), AMOUNT).alias("impressions"),
        F.lit(mvpd).alias("mvpd"),
        data_type.alias("data_type"),
    )
    return map_features(rows, net_map, dma_map, fold_market_case=False)


def map_features(rows: DataFrame, net_map: DataFrame, dma_map: DataFrame, fold_market_case: bool = True) -> DataFrame:
    """Clean network and market names of fact rows, all cuts together.

    The rows are summed per raw name first; one join against both mappings follows, then the sum per
    clean name.  Unknown networks and markets become 'Unassigned'; other cuts keep their names.
    """
    def fold(c: Column) -> Column:
        return F.lower(c) if fold_market_case else c

    networks = net_map.select(
        F.lit("Network").alias("_type"), F.col("feature_value").alias("_raw"), F.col("corrected_network").alias("_clean")
    )
    markets = dma_map.select(
        F.lit("Market").alias("_type"), fold(F.col("geography")).alias("_raw"), F.col("corrected_dma").alias("_clean")
    )
    mapping = networks.unionByName(markets).distinct()
    raw_sums = group_sum(rows, FACT[:2] + FACT[3:])
    raw = F.when(F.col("data_type") == "Market", fold(F.col("feature_value"))).otherwise(F.col("feature_value"))
    named = raw_sums.withColumn("_raw_name", raw).join(
        mapping, (F.col("data_type") == F.col("_type")) & (F.col("_raw_name") == F.col("_raw")), "left"
    )
    clean = F.when(F.col("data_type").isin("Network", "Market"), F.coalesce("_clean", F.lit(UNASSIGNED)))
    named = named.withColumn("feature_value", F.coalesce(clean, "feature_value"))
    return group_sum(named, FACT[:2] + FACT[3:]).select(*FACT)


def brand_of(file: Column, mvpd: Column, brand: str | None = None) -> Column:
    """The given brand, or what a workbook's name has in front of its provider's: 'Acme Motors Cox report' -> 'Acme Motors'."""
    if brand is not None:
        return F.lit(brand)
    return F.trim(F.substring(file, F.lit(1), F.instr(F.lower(file), F.lower(mvpd)) - 1))


def provider_sheets(lines: DataFrame, providers: Sequence[Provider] = PROVIDERS) -> DataFrame:
    """(file, sheet, mvpd, role): per workbook the first sheet of each role, in workbook order."""
    words = {p.name.lower(): p.name for p in providers}
    sheets = sh.list_sheets(lines).withColumn("mvpd", sh.classify_file(F.col("file"), words, exclude=["reach"]))
    role = F.lit(None).cast("string")
    for p in providers:
        role = F.when(F.col("mvpd") == p.name, sh.sheet_role(F.col("sheet"), p.roles)).otherwise(role)
    place = F.struct(F.col("position").isNull(), "position", "sheet")
    fits = sheets.withColumn("role", role).filter("role is not null")
    return materialize(fits.groupBy("file", "mvpd", "role").agg(F.min_by("sheet", place).alias("sheet")), "roles")


def sheet_records(
    lines: DataFrame, providers: Sequence[Provider] = PROVIDERS, brand: str | None = None, headers: DataFrame | None = None
) -> DataFrame:
    """Lines of all workbooks to sums per (brand, mvpd, role, label).

    The workbook name 'Brand Provider ...' gives provider and, if none is given, brand; the sheet name gives the
    role, of which each workbook's first sheet counts, and the header the impressions column; every provider goes
    through the same single pass.
    """
    tagged = lines.join(provider_sheets(lines, providers), ["file", "sheet"])
    records = sh.clean_records(sh.promote_header(tagged, headers=headers)).select(
        brand_of(F.col("file"), F.col("mvpd"), brand).alias("brand"),
        "mvpd",
        "role",
        sh.cell_at(0).alias("label"),
        try_number(sh.measure_cell(), AMOUNT).alias("impressions"),
    )
    return group_sum(records, ["brand", "mvpd", "role", "label"])


def daily_rows(records: DataFrame, year: int | None = None, role: str = "Date") -> DataFrame:
    """Records of the date (or week) sheets by date; ``year`` completes dates that come without one."""
    date = cal.date_of_label(F.col("label"), year)
    return records.filter(F.col("role") == role).select("brand", "mvpd", date.alias("event_date"), "impressions")


def unparsed_labels(records: DataFrame, year: int | None = None) -> DataFrame:
    """Records of hour, date and week sheets whose label is no time or date, so that they are in no cut."""
    role, label = F.col("role"), F.col("label")
    lost = (role == "Hour") & cal.hour_of_label(label).isNull() | role.isin("Date", "Week") & cal.date_of_label(label, year).isNull()
    return records.filter(lost)


def sheet_cuts(
    lines: DataFrame,
    net_map: DataFrame,
    dma_map: DataFrame,
    providers: Sequence[Provider] = PROVIDERS,
    dayparts: str = "standard",
    anchor: str | None = ANCHOR,
    year: int | None = None,
    brand: str | None = None,
    headers: DataFrame | None = None,
) -> DataFrame:
    """All cuts of all providers from their sheet sets; ``headers`` as in ``sheets.promote_header``."""
    return provider_cuts(sheet_records(lines, providers, brand, headers), net_map, dma_map, providers, dayparts, anchor, year)


def provider_cuts(
    records: DataFrame,
    net_map: DataFrame,
    dma_map: DataFrame,
    providers: Sequence[Provider] = PROVIDERS,
    dayparts: str = "standard",
    anchor: str | None = ANCHOR,
    year: int | None = None,
) -> DataFrame:
    """All cuts from sums per (brand, mvpd, role, label).

    These sums, as many as there are labels, are written once; every cut and the span of weeks then
    start from them instead of the inputs.  Summary, weekday and week rows of providers that have no
    such sheet come from their dates.
    """
    records = materialize(records, "label_sums")
    label = F.col("label")
    aliases = cal.DAYPART_ALIASES if dayparts == "standard" else cal.CUSTOM_DAYPART_CODES
    long_day = F.coalesce(_from_literals(cal.DAY_ABBREVIATIONS, label), label)
    role = F.col("role")
    feature = (
        F.when(role == "Hour", cal.daypart(cal.hour_of_label(label), dayparts))
        .when(role == "Daypart", _from_literals(aliases, label))
        .when(role == "Day", long_day)
        .when(role == "Summary", "Total")
        .when(role.isin("Network", "Market"), label)
    )
    data_type = F.when(role == "Hour", "Daypart").otherwise(role)
    direct = records.select(feature.alias("feature_value"), "brand", "impressions", "mvpd", data_type.alias("data_type"))

    def without(sheet: str) -> Column:
        return F.col("mvpd").isin([p.name for p in providers if not p.has(sheet)])

    daily = group_sum(daily_rows(records, year), ["brand", "mvpd", "event_date"])
    weeks = daily_rows(records, year, role="Week")
    spans = provider_spans(daily.filter(without("Week"))).unionByName(provider_spans(weeks, days=7))
    placed = with_week(daily, week_anchor(spans, anchor))
    cuts = cuts_of(
        Week=F.when(without("Week"), F.col("week").cast("string")),
        Day=F.when(without("Day"), cal.day_name(F.col("event_date"))),
        Summary=F.when(without("Summary"), F.lit("Total")),
    )
    dated = placed.select("brand", "mvpd", "impressions", cuts)  # cuts without a feature drop out below
    own_weeks = weeks.select(
        F.col("event_date").cast("string").alias("feature_value"), "brand", "impressions", "mvpd", F.lit("Week").alias("data_type")
    )
    whole = direct.select(*FACT).unionByName(dated.select(*FACT)).unionByName(own_weeks)
    return map_features(whole, net_map, dma_map)


def wide_hour_dayparts(wide: DataFrame, brand: str, mvpd: str) -> DataFrame:
    """The custom daypart cut of a provider that reports Daypart, Start, End, Impressions side by side."""
    words = ["Daypart", "Start", "End", "Impressions"]
    long = stack_column_groups(wide, [], words).withColumn("impressions", try_number(F.col("Impressions"), AMOUNT))
    sums = group_sum(long, words[:3])
    named = literal_lookup(sums, cal.CUSTOM_DAYPART_CODES, "Daypart", "feature_value")
    constants = {"brand": F.lit(brand), "mvpd": F.lit(mvpd), "data_type": F.lit("Daypart")}
    return group_sum(named, ["feature_value"]).withColumns(constants).select(*FACT)


def replace_cut(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """Put rows in place of the same providers' cut of the same kind."""
    same = ["brand", "mvpd", "data_type"]
    return fact.join(rows.select(*same).distinct(), same, "left_anti").select(*FACT).unionByName(rows)


def summary_from_daily(daily: DataFrame) -> DataFrame:
    """The summary cut of providers that only report days."""
    return (
        group_sum(daily, ["brand", "mvpd"])
        .withColumns({"feature_value": F.lit("Total"), "data_type": F.lit("Summary")})
        .select(*FACT)
    )


def _from_literals(pairs: dict[str, str], key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
    return table[key]
