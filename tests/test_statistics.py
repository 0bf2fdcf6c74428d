import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tallyloom.sources import statistics as st


def written(spark, tmp_path, df, **options):
    path = str(tmp_path / "t")
    df.write.options(**options).parquet(path)
    return path


def test_facts_come_from_footers(spark, tmp_path):
    path = written(spark, tmp_path, spark.range(1000).repartition(4).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("x"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d")))
    with st.footers(spark):
        plan = st._facts(spark.read.parquet(path), ["id", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(" in plan.replace("COUNT(1)", "COUNT(*)") and "ReadSchema: struct<count" in plan.lower().replace("readschema", "ReadSchema")
    last = str(dt.date(2024, 1, 1) + dt.timedelta(days=999))
    assert rows(st.table_facts(spark, path, ["id", "d"]), "column") == [("d", 1000, 1000, "2024-01-01", last), ("id", 1000, 1000, "0", "999")]
    assert rows(st.table_facts(spark, path, ["id", "x", "d"]), "column") == [("d", 1000, 1000, "2024-01-01", last), ("id", 1000, 1000, "0", "999"), ("x", 1000, 666, "1.0", "998.0")]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false" and "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_texts_and_empty_tables_are_read(spark, tmp_path, frame):
    path = written(spark, tmp_path, frame("s string, k int", ("b" * 90, 1), (None, 2), ("a", None)))
    assert rows(st.table_facts(spark, path, ["s", "k"]), "column") == [("k", 3, 2, "1", "2"), ("s", 3, 2, "a", "b" * 90)]
    empty = written(spark, tmp_path / "e", frame("k int"))
    assert rows(st.table_facts(spark, empty, ["k"])) == [("k", 0, 0, None, None)]
