import datetime as dt
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from tallyloom.plans.weekly import provider_spans, week_anchor, week_calendar, weekly, with_week

D = dt.date
SPAN = "brand string, mvpd string, start date, end date"


def test_weeks_step_back_until_nothing_starts_before(frame):
    spans = frame(SPAN, ("b", "A", D(2024, 1, 15), D(2024, 1, 28)), ("b", "B", D(2024, 1, 2), D(2024, 2, 3)))
    assert rows(week_anchor(spans, "A")) == [("b", D(2024, 1, 1), D(2024, 2, 3))]
    # The anchor itself is first, or is not there.
    assert rows(week_anchor(spans, "B")) == [("b", D(2024, 1, 2), D(2024, 2, 3))]
    assert rows(week_anchor(spans, None)) == [("b", D(2024, 1, 2), D(2024, 2, 3))]


def test_last_day_on_a_week_start_gets_its_week(frame):
    spans = frame(SPAN, ("b", "A", D(2024, 1, 1), D(2024, 1, 15)))
    got = rows(week_calendar(week_anchor(spans, "A")), "first_date")
    assert got == [
        ("b", D(2024, 1, 1), D(2024, 1, 7), "Week 1"),
        ("b", D(2024, 1, 8), D(2024, 1, 14), "Week 2"),
        ("b", D(2024, 1, 15), D(2024, 1, 21), "Week 3"),
    ]


def test_arithmetic_agrees_with_the_range_join(spark, frame):
    days = spark.range(60).select(
        F.lit("b").alias("brand"), F.lit("A").alias("mvpd"), F.expr("date_add(date'2024-01-03', cast(id as int))").alias("event_date")
    )
    anchors = week_anchor(provider_spans(days), None)
    bucketed = with_week(days, anchors).select("event_date", "week", "week_num")
    joined = days.join(week_calendar(anchors), "brand").filter("event_date between first_date and last_date").select(
        "event_date", F.col("first_date").alias("week"), "week_num"
    )
    assert rows(bucketed, "event_date") == rows(joined, "event_date") and bucketed.count() == 60


def test_weekly_keeps_every_impression(frame):
    schema = "brand string, mvpd string, event_date date, impressions decimal(18,2)"
    daily = frame(schema, *[("b", "B", D(2024, 1, 1) + dt.timedelta(days=i), Decimal(i)) for i in range(15)])
    whole_weeks = frame(schema, ("b", "A", D(2024, 1, 4), Decimal(10)), ("b", "A", D(2024, 1, 11), Decimal(20)))
    got = rows(weekly(daily, "A", anchor_weeks=whole_weeks), "mvpd", "week")
    assert [(m, w, float(v)) for _, m, w, v in got] == [
        ("A", D(2024, 1, 4), 10.0), ("A", D(2024, 1, 11), 20.0),
        ("B", D(2023, 12, 28), 3.0), ("B", D(2024, 1, 4), 42.0), ("B", D(2024, 1, 11), 50.0 + 10.0),
    ]
    assert sum(float(v) for _, m, _, v in got if m == "B") == sum(range(15))
