import os
from decimal import Decimal

from conftest import rows

from tallyloom.sinks import reports as sink
from tallyloom.sources.tables import read_csv

FACT = "raw_network string, raw_market string, brand string, mvpd string, impressions decimal(18,2)"


def test_csv_keeps_text_with_commas_quotes_and_accents(spark, frame, tmp_path):
    data = [(1, 'a, "b"'), (2, "Café"), (3, None)]
    path = sink.write_csv(frame("k int, v string", *data), str(tmp_path / "t"), encoding="ISO-8859-1")
    assert rows(read_csv(spark, path, "k int, v string", "ISO-8859-1"), "k") == data


def test_a_cut_is_a_directory_per_brand(spark, frame, tmp_path):
    cuts = {"Week": frame("w string, brand string, n double", ("1", "A", 1.0), ("1", "B", 2.0)), "Day": frame("d string, brand string", ("Mon", "A"))}
    folder = sink.write_report_cuts(cuts, str(tmp_path / "r"))
    assert sorted(os.listdir(folder)) == ["Day", "Week"]
    assert [d for d in sorted(os.listdir(folder + "/Week")) if "=" in d] == ["brand=A", "brand=B"]
    back = sink.read_report_cuts(spark, folder, cuts)
    assert back["Week"].columns == ["w", "brand", "n"] and rows(back["Week"], "brand") == [("1", "A", 1.0), ("1", "B", 2.0)]
    assert "PartitionFilters: [isnotnull(brand" in back["Week"].filter("brand = 'A'")._jdf.queryExecution().executedPlan().toString()


def test_unmapped_kinds_without_rows_leave_no_directory(frame, tmp_path):
    nets = frame("feature_value string, corrected_network string", ("espn", "ESPN"))
    dmas = frame("geography string, corrected_dma string", ("Denver", "D"))
    fact = frame(FACT, ("ESPN", "DENVER", "b", "Cox", Decimal(2)), ("ESPN", "denver", "b", "Cox", Decimal(3)), ("espn", "Denver", "b", "Cox", Decimal(1)))
    unmapped = sink.unmapped_names(fact, nets, dmas)
    assert [(k, n, float(v)) for k, n, _, _, v in rows(unmapped)] == [("network", "ESPN", 5.0)]
    path = sink.write_unmapped(unmapped, str(tmp_path / "u"))
    assert [d for d in os.listdir(path) if "=" in d] == ["kind=network"]
    empty = sink.write_unmapped(unmapped.filter("kind = 'x'"), str(tmp_path / "e"))
    assert [d for d in os.listdir(empty) if "=" in d] == []
