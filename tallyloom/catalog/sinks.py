"""Sinks, checked by reading back what was written."""

from pyspark.sql import functions as F

from tallyloom import fixtures as fx
from tallyloom.catalog.jobs import REPORT_SQL, REPORTED, all_cuts, fact
from tallyloom.catalog.registry import query
from tallyloom.operators.aggregates import group_sum
from tallyloom.plans.report import report_cuts
from tallyloom.session import new_path
from tallyloom.sinks import reports as sink
from tallyloom.sources.tables import read_csv


@query("write_csv", "SELECT raw_network, mvpd, coalesce(sum(imp), 0)::DOUBLE AS impressions FROM delivery GROUP BY ALL")
def _(t):
    sums = group_sum(fx.measured(t), ["raw_network", "mvpd"]).withColumn("impressions", F.col("impressions").cast("double"))
    path = sink.write_csv(sums, new_path(t.spark, "sums_csv"))
    return read_csv(t.spark, path, "raw_network string, mvpd string, impressions double")


@query("write_report_cuts", REPORT_SQL)
def _(t):
    cuts = report_cuts(fact(t), fx.dma_map(t), REPORTED)
    folder = sink.write_report_cuts(cuts, new_path(t.spark, "report"))
    return all_cuts(sink.read_report_cuts(t.spark, folder, cuts))


@query("write_unmapped", """
SELECT 'network' AS kind, raw_network AS name, brand, mvpd, coalesce(sum(imp), 0)::DOUBLE AS impressions FROM delivery
WHERE raw_network NOT IN (SELECT feature_value FROM net_map) GROUP BY ALL
UNION ALL SELECT 'market', city, brand, mvpd, coalesce(sum(imp), 0)::DOUBLE FROM delivery
WHERE lower(city) NOT IN (SELECT lower(geography) FROM dma_map) GROUP BY ALL""")
def _(t):
    unmapped = sink.unmapped_names(fx.measured(t), fx.net_map(t), fx.dma_map(t), market="city")
    path = sink.write_unmapped(unmapped, new_path(t.spark, "unmapped"))
    back = t.spark.read.schema(unmapped.schema).parquet(path)
    return back.select("kind", "name", "brand", "mvpd", F.col("impressions").cast("double").alias("impressions"))
