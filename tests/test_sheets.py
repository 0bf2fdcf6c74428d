"""Sheet sets written as plain files, the way people keep them."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog import jobs
from tallyloom.plans import providers as pv
from tallyloom.sources import sheets as sh
from tallyloom.sources.tables import read_csv, read_many_csv


@pytest.fixture
def root(tmp_path):
    def write(files):
        for name, text in files.items():
            path = tmp_path / name
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def test_names_of_workbooks_and_sheets(spark, root):
    path = root({"Brand A+B Cox report/Day of Week.csv": "a,b\n", "Größe 100%/x=y.csv": "a,b\n"})
    got = rows(sh.list_sheets(sh.read_sheet_set(spark, path)), "file")
    assert got == [("Brand A+B Cox report", "Day of Week", None), ("Größe 100%", "y", None)]


@pytest.fixture
def splits(spark):
    """splits(bytes, files) changes how later scans cut the files."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")
    old = [spark.conf.get(n, None) for n in names]

    def cut(*values):
        for n, v in zip(names, values, strict=True):
            spark.conf.set(n, v)

    yield cut
    for n, v in zip(names, old, strict=True):
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_numbers_do_not_depend_on_how_scans_are_split(spark, root, splits):
    files = {"w/long.csv": "".join(f"row {i},{i}\n" for i in range(4000)), "w/short.csv": "x,1\ny,2\n"}
    files |= {f"v/s{k}.csv": "Title\n\nName,Imps,Note\n" + "".join(f"n{i},{i},\n" for i in range(200)) + "Total,9,all\n" for k in range(5)}
    path = root(files)
    splits(5000, 2)
    lines = sh.read_sheet_set(spark, path)
    skipped, named = sh.skip_rows(lines, 3998), sh.promote_header(lines, ["Name", "Imps"])
    splits(700, 16)
    got = rows(lines.filter("sheet = 'long'").select("line_no", sh.cell_at(1)), "line_no")
    assert got == [(i, str(i)) for i in range(4000)]
    assert rows(skipped.select("sheet", sh.cell_at(0).alias("c0")), "c0") == [("long", "row 3998"), ("long", "row 3999")]
    splits(100_000, 1)
    assert rows(named.filter("file = 'v'").groupBy("sheet").count(), "sheet") == [(f"s{k}", 201) for k in range(5)]
    assert rows(named.filter("sheet = 'short'").select("Name")) == [(None,)]


def test_lines_keep_all_their_cells(spark, root):
    wide = ",".join(f"c{i}" for i in range(10))
    lines = sh.read_sheet_set(spark, root({"w/2. Wide.csv": wide + '\n"a ""b"", c",,"",x\n', "w/1. Narrow.csv": "one\n"}))
    got = rows(lines.select("sheet", "position", "line_no", "cells"), "sheet", "line_no")
    assert got == [("Narrow", 1, 0, ["one"]), ("Wide", 2, 0, wide.split(",")), ("Wide", 2, 1, ['a "b", c', None, "", "x"])]


def test_header_is_the_first_full_line(spark, root):
    path = root({"w/a.csv": "Report,\nFrom,Friday,\nName, Impressions ,Extra\nx,1,\ny,2,\nTotal,3,\n"})
    lines = sh.read_sheet_set(spark, path)
    got = rows(sh.promote_header(lines, ["Name", "Impressions"]).select("Name", "Impressions"), "Name")
    assert got == [("Total", "3"), ("x", "1"), ("y", "2")]


def test_gaps_count_only_in_columns_that_are_used(spark, root):
    path = root({
        "w/a.csv": "Name,Note,Imps\nx,,1\ny,,2\nTotal,all,3\n",  # Note is used by the total row alone
        "w/b.csv": "Name,Note,Imps\nx,seen,1\ny,,2\nSubTotal East,seen,3\n",
    })
    records = sh.clean_records(sh.promote_header(sh.read_sheet_set(spark, path)))
    got = rows(records.select("sheet", sh.cell_at(0).alias("name"), sh.measure_cell().alias("imps")), "sheet", "name")
    assert got == [("a", "x", "1"), ("a", "y", "2"), ("b", "x", "1")]


def test_measure_cell_follows_the_column_rules(spark, root):
    path = root({
        "w/one.csv": "Network,Total Imps\nn,1\n",
        "w/ads.csv": "Network,Net Counted Ads\nn,2\n",
        "w/two.csv": "Network,Imps Booked,Imps Delivered\nn,3,4\n",
        "w/none.csv": "Network,Views\nn,5\n",
    })
    records = sh.promote_header(sh.read_sheet_set(spark, path))
    assert dict(rows(records.select("sheet", sh.measure_cell()))) == {"one": "1", "ads": "2", "two": "4", "none": None}


def test_roles(frame):
    df = frame("x string", ("Daypart",), ("Daily",), ("Geo by net",), ("zzz",))
    rules = [("Date", "daily|date"), ("Market", "geo|market|dma"), ("Network", "net"), ("Daypart", "daypart"), ("Day", "day|dow")]
    got = rows(df.select(sh.sheet_role(F.col("x"), rules), sh.sheet_role(F.col("x"), rules, "last")))
    assert got == [("Daypart", "Day"), ("Date", "Date"), ("Market", "Network"), (None, None)]
    sheets = frame("file string, sheet string, position int", ("w", "Net 2", 1), ("w", "Geo by net", 2), ("w", "A net", None))
    assert rows(sh.first_sheet_per_role(sheets, rules), "role") == [("w", "Market", "Geo by net"), ("w", "Network", "Net 2")]


def test_file_roles(frame):
    df = frame("x string", ("My COX report.xlsx",), ("~$cox.xlsx",), ("Cox Reach.xlsx",), ("other.xlsx",))
    role = sh.classify_file(F.col("x"), {"cox": "Cox"}, exclude=["reach"])
    assert [r[0] for r in rows(df.select(role))] == ["Cox", None, None, None]


def test_csv_readers(spark, root, tmp_path):
    path = root({"t/a.csv": "k,v\n1,x\n", "t/b.csv": "v,extra,k\n,9,2\n", "t/notes.txt": "k,v\n7,z\n"})
    assert rows(read_csv(spark, path + "/t/b.csv", "k bigint, v string")) == [(2, None)]
    with pytest.raises(ValueError):
        read_csv(spark, path + "/t/a.csv", "k bigint, extra int").collect()
    assert rows(read_many_csv(spark, path + "/t", "k bigint, v string"), "k") == [(1, "x", "a"), (2, None, "b")]
    latin = tmp_path / "latin.csv"
    latin.write_bytes("Network,clean,extra\nCafé,C,1\n".encode("latin-1"))
    got = read_csv(spark, str(latin), "Network string, clean string, extra int", "ISO-8859-1", ["Network", "clean"])
    assert rows(got) == [("Café", "C")]


def test_provider_without_year_and_with_short_days(spark, root, frame):
    path = root({
        "B1 Spectrum report/Daily.csv": "Date,Impressions\n1-Jan,5\n2024-01-08,7\nTotal,12\n",
        "B1 Spectrum report/Networks.csv": "Network,Impressions\nespn,4\nESPN,3\n???,5\n",
        "B1 Verizon report/DOW.csv": "Day,Total Impressions\nThur,1\nFri,2\nMonday,3\n",
        "B1 Verizon report/Date.csv": "Date,Total Impressions\n2024-01-02,6\n",
        "B1 Spectrum reach/Networks.csv": "Network,Impressions\nespn,1000\n",
    })
    nets = frame("feature_value string, corrected_network string", ("espn", "ESPN"))
    dmas = frame("geography string, corrected_dma string", ("x", "X"))
    fact = pv.sheet_cuts(sh.read_sheet_set(spark, path), nets, dmas, year=2024)
    got = sorted((m, t, f, float(v)) for f, _, v, m, t in rows(fact))
    assert got == sorted([
        ("Spectrum", "Network", "ESPN", 4.0), ("Spectrum", "Network", "Unassigned", 8.0), ("Spectrum", "Summary", "Total", 12.0),
        ("Spectrum", "Week", "2024-01-01", 5.0), ("Spectrum", "Week", "2024-01-08", 7.0),
        ("Verizon", "Day", "Thursday", 1.0), ("Verizon", "Day", "Friday", 2.0), ("Verizon", "Day", "Monday", 3.0),
        ("Verizon", "Summary", "Total", 6.0), ("Verizon", "Week", "2024-01-01", 6.0),
    ])


@pytest.mark.parametrize("dayparts", ["standard", "custom"])
def test_sheets_and_delivery_rows_give_the_same_fact(spark, folder, dayparts):
    t = fx.Tables(spark, folder)
    lines = sh.read_sheet_set(spark, fx.provider_files(t))
    sheet_fact = pv.sheet_cuts(lines, fx.net_map(t), fx.dma_map(t), dayparts=dayparts, year=jobs.YEAR)
    keep = "data_type <> 'Daypart' or mvpd <> 'Spectrum'" if dayparts == "custom" else "true"  # one provider has fixed names
    direct = jobs.delivery_fact(t, dayparts)
    assert set(rows(sheet_fact.filter(keep))) == set(rows(direct.filter(keep)))


def test_roles_brands_and_labels_of_a_workbook(spark, root):
    path = root({
        "Acme Motors Comcast report/1. Week Hour.csv": "Hour,Impressions\n09:00 AM,1\n9:00:00,2\nHour 21:00,4\n25:00,8\n",
        "Acme Motors Comcast report/2. Day of Week.csv": "Day,Impressions\nMonday,5\n",
        "Acme Motors Comcast report/3. Week.csv": "Week,Impressions\n2024-01-01,6\nsoon,7\n",
        "Acme Motors Comcast report/4. Network.csv": "Network,Impressions\nespn,9\n",
        "Acme Motors Comcast report/5. Network by Week.csv": "Network,Impressions\nespn,9\n",
    })
    records = pv.sheet_records(sh.read_sheet_set(spark, path))
    assert {r["brand"] for r in records.collect()} == {"Acme Motors"}
    sums = rows(records.groupBy("role").agg(F.sum("impressions").cast("int")), "role")
    assert sums == [("Day", 5), ("Hour", 15), ("Network", 9), ("Week", 13)]
    assert rows(pv.unparsed_labels(records).select("role", "label"), "role") == [("Hour", "25:00"), ("Week", "soon")]
    hours = pv.cal.hour_of_label(F.col("label"))
    assert sorted(rows(records.filter("role = 'Hour'").select(hours)), key=str) == [(21,), (9,), (9,), (None,)]
    assert {r["brand"] for r in pv.sheet_records(sh.read_sheet_set(spark, path), brand="Acme").collect()} == {"Acme"}


def test_types_per_sheet_and_typed_tables(spark, root):
    path = root({
        "w/a.csv": "Day,N,Part,Rate,Mixed,,Gap,N\n2024-01-02,1,1.5,1e3,7,x,,12345678901234567890\n2024-02-30x,-2,2,nan,2024-01-01,y,,3\nT,0,3,2,9,z,,\n",
        "w/b.csv": "Day,N,Part\n2024-01-02,1d,0x1F\n2024-01-03,2,3\n",
    })
    records = sh.promote_header(sh.read_sheet_set(spark, path))
    types = sh.sheet_types(records)
    got = {(s, c): t for s, c, t in rows(types.select("sheet", "column", "type"))}
    assert [got["a", i] for i in range(8)] == ["text", "integer", "decimal", "double", "text", "text", "empty", "decimal"]
    assert [got["b", i] for i in range(3)] == ["date", "text", "text"]
    a = sh.typed_sheet(records, types, "w", "a")
    assert [(f.name, f.dataType.simpleString()) for f in a.schema] == [
        ("Day", "string"), ("N", "bigint"), ("Part", "decimal(38,10)"), ("Rate", "double"), ("Mixed", "string"), ("column 5", "string"), ("Gap", "string"), ("N 7", "decimal(38,10)")]
    assert sorted(r["N"] for r in a.collect()) == [-2, 0, 1]
    assert rows(sh.typed_sheet(records, types, "w", "b").select(F.year("Day")), "year(Day)") == [(2024,), (2024,)]
