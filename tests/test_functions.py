import datetime as dt

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import arrays as arr
from tallyloom.functions import calendar as cal
from tallyloom.functions import text as tx

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(st.lists(st.text(alphabet="aB9 -'é_\t", max_size=12), min_size=1, max_size=40))
def test_title_case_and_strip_behave_as_for_plain_strings(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = rows(df.select(tx.title_case(F.col("x")), tx.strip(F.col("x"))))
    assert got == [(t.title(), t.strip()) for t in texts]


@SLOW
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), min_size=1, max_size=30))
def test_array_access(spark, lists):
    df = spark.createDataFrame([(x,) for x in lists], "x array<string>")
    a = F.col("x")
    got = rows(df.select(arr.item(a, 0), arr.item(a, -1), arr.items(a, 1, 5), arr.items(a, 0, 6, 2),
                         arr.set_item(a, 0, F.lit("Z")), arr.set_item(a, -1, F.lit("Z")), arr.append(a, F.lit("t"))))
    for x, r in zip(lists, got):
        assert r == (
            x[0] if x else None, x[-1] if x else None, x[1:5], x[0:6:2],
            ["Z", *x[1:]] if x else [], [*x[:-1], "Z"] if x else [], [*x, "t"],
        )


def test_splits(frame):
    df = frame("x string", ("a|b|c",), ("a",), (None,))
    got = rows(df.select(*tx.split_into(F.col("x"), "|", 2)))
    assert got == [("a", "b|c"), ("a", None), (None, None)]
    df = frame("x string", ("New York, NY",), ("Denver",))
    assert rows(df.select(tx.split_first(F.col("x"), ", "))) == [("New York",), ("Denver",)]


def test_short_text_is_kept_whole(frame):
    df = frame("x string", ("Hour 13:00:00",), ("9:00",))
    assert rows(df.select(tx.last_n(F.col("x"), 8))) == [("13:00:00",), ("9:00",)]


def test_loose_replacement_lengthens_long_names_and_anchored_does_not(frame):
    df = frame("x string", ("Sun",), ("Sunday",))
    names = {"Sun": "Sunday"}
    got = rows(df.select(tx.replace_chain(F.col("x"), names), tx.replace_chain(F.col("x"), names, anchored=False)))
    assert got == [("Sunday", "Sunday"), ("Sunday", "Sundayday")]


def test_quoted_list(frame):
    assert rows(frame("x string", ("a, b ,c",)).select(tx.quote_in_list(F.col("x")))) == [("('a','b','c')",)]


def test_concat_keeps_nulls_null(frame):
    assert rows(frame("a string, b string", ("x", None)).select(F.concat("a", F.lit("|"), "b"))) == [(None,)]


def test_four_pm_is_early_fringe_and_minutes_are_covered(frame):
    df = frame("x string", ("4:00 PM",), ("12:00 AM",), ("12:00 PM",), ("5:30 AM",), ("Total",), ("?",))
    got = [r[0] for r in rows(df.select(cal.daypart_of_label(F.col("x"))))]
    assert got == [
        "Early Fringe - 4PM-6PM", "Overnight - Midnight-6AM", "Daytime - 9AM-4PM", "Overnight - Midnight-6AM", "Total", None,
    ]


def test_every_hour_has_exactly_one_daypart():
    for dayparts in cal.DAYPART_SETS.values():
        hours = [h for first, last in dayparts.values() for h in range(first, last + 1)]
        assert sorted(hours) == list(range(24))


def test_dates(frame):
    df = frame("x string", ("5-Jan",), ("29-Feb",), ("soon",))
    got = [r[0] for r in rows(df.select(cal.date_without_year(F.col("x"), 2023)))]
    assert got == [dt.date(2023, 1, 5), None, None]
    df = frame("d date", (dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),))
    assert rows(df.select(cal.day_number(F.col("d")), cal.day_name(F.col("d")))) == [(0, "Monday"), (6, "Sunday")]
