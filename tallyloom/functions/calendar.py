"""Days, weeks, hours and dayparts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: names that must appear exactly like this in the reports ----
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_ABBREVIATIONS = {
    "Mon": "Monday",
    "Tue": "Tuesday",
    "Wed": "Wednesday",
    "Thur": "Thursday",
    "Thu": "Thursday",
    "Fri": "Friday",
    "Sat": "Saturday",
    "Sun": "Sunday",
}
STANDARD_DAYPARTS = {  # name: first and last hour
    "Overnight - Midnight-6AM": (0, 5),
    "Early Morning - 6AM-9AM": (6, 8),
    "Daytime - 9AM-4PM": (9, 15),
    "Early Fringe - 4PM-6PM": (16, 17),
    "Prime Access - 6PM-8PM": (18, 19),
    "Prime - 8PM-11PM": (20, 22),
    "Late Fringe - 11PM-12AM": (23, 23),
}
CUSTOM_DAYPARTS = {
    "Late Fringe - 12AM-2AM": (0, 1),
    "Overnight – 2AM-6AM": (2, 5),
    "Early Morning - 6AM-9AM": (6, 8),
    "Daytime - 9AM-4PM": (9, 15),
    "Early Fringe - 4PM-8PM": (16, 19),
    "Prime - 8PM-12AM": (20, 23),
}
DAYPART_ALIASES = {
    "Overnight": "Overnight - Midnight-6AM",
    "Early Morning": "Early Morning - 6AM-9AM",
    "Daytime": "Daytime - 9AM-4PM",
    "Early Fringe": "Early Fringe - 4PM-6PM",
    "Prime Access": "Prime Access - 6PM-8PM",
    "Prime": "Prime - 8PM-11PM",
    "Prime Time": "Prime - 8PM-11PM",
    "Late Fringe": "Late Fringe - 11PM-12AM",
    "Access": "Prime Access - 6PM-8PM",
    "AM Day": "Daytime - 9AM-4PM",
    "PM Day": "Daytime - 9AM-4PM",
}
CUSTOM_DAYPART_CODES = {
    "DA": "Daytime - 9AM-4PM",
    "EF": "Early Fringe - 4PM-8PM",
    "EM": "Early Morning - 6AM-9AM",
    "LF": "Late Fringe - 12AM-2AM",
    "ON": "Overnight – 2AM-6AM",
    "PR": "Prime - 8PM-12AM",
}
# ---- end of fixed values ----

DAYPART_SETS = {"standard": STANDARD_DAYPARTS, "custom": CUSTOM_DAYPARTS}


def daypart(hour: Column, dayparts: str = "standard") -> Column:
    """Hour of day (0-23) to its daypart; null for anything else."""
    chain = None
    for name, (first, last) in DAYPART_SETS[dayparts].items():
        inside = hour.between(first, last)
        chain = F.when(inside, name) if chain is None else chain.when(inside, name)
    return chain


_CLOCK = r"(?:^|\s)(\d{1,2}):([0-5]\d)(?::[0-5]\d)?(?:\s*([AaPp])\.?[Mm]\.?)?\s*$"


def hour_of_label(label: Column) -> Column:
    """The hour of the clock time a label ends with: '9:00 AM', '09:00 AM', 'Hour 21:00:00', '21:00'; null if there is
    none, or no such time."""
    hour = F.regexp_extract(label, _CLOCK, 1).try_cast("int")
    half = F.lower(F.regexp_extract(label, _CLOCK, 3))
    twelve = hour.between(1, 12)
    return (
        F.when(half == "", F.when(hour.between(0, 23), hour))
        .when(half == "a", F.when(twelve, hour % 12))
        .when(half == "p", F.when(twelve, hour % 12 + 12))
    )


def daypart_of_label(label: Column, dayparts: str = "standard", total: str = "Total") -> Column:
    """Clock label to daypart; the total row keeps its name."""
    return F.when(label == total, label).otherwise(daypart(hour_of_label(label), dayparts))


def time_on(text: Column, day: str = "2020-01-01", pattern: str = "HH:mm:ss") -> Column:
    """Clock text placed on a fixed date; null when it does not parse."""
    return F.try_to_timestamp(F.concat(F.lit(f"{day} "), text), F.lit(f"yyyy-MM-dd {pattern}"))


def date_of_label(label: Column, year: int | None = None) -> Column:
    """The date a label holds: written in full, or without a year, which then is ``year``; else null."""
    text = F.trim(label)
    full = F.to_date(text.try_cast("date"))
    for pattern in ("d-MMM-yyyy", "M/d/yyyy"):
        full = F.coalesce(full, F.to_date(F.try_to_timestamp(text, F.lit(pattern))))
    return full if year is None else F.coalesce(full, date_without_year(text, year))


def date_without_year(text: Column, year: int) -> Column:
    """'5-Jan' -> date in the given year; null when it does not parse."""
    return F.to_date(F.try_to_timestamp(F.concat(text, F.lit(f"-{year}")), F.lit("d-MMM-yyyy")))


def day_number(date: Column) -> Column:
    """Monday 0 ... Sunday 6."""
    return F.weekday(date)


def day_name(date: Column) -> Column:
    return F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(date))


def day_rank(name: Column, total: str | None = None) -> Column:
    """Position of a weekday name in the week, an optional total label behind Sunday, else null."""
    order = WEEKDAYS + ([total] if total else [])
    place = F.array_position(F.array(*[F.lit(d) for d in order]), name)
    return F.when(place > 0, place - 1)


def week_index(date: Column, anchor: Column) -> Column:
    """Whole weeks between the anchor date and the date; the bucket a range join would find."""
    return F.floor(F.date_diff(date, anchor) / 7).cast("int")


def week_start(date: Column, anchor: Column) -> Column:
    return F.date_add(anchor, week_index(date, anchor) * 7)


def anchor_start(anchor_first: Column, overall_first: Column) -> Column:
    """The anchor's first day, moved back by whole weeks until nothing starts before it."""
    weeks_back = F.ceil(F.greatest(F.date_diff(anchor_first, overall_first), F.lit(0)) / 7).cast("int")
    return F.date_sub(anchor_first, weeks_back * 7)
