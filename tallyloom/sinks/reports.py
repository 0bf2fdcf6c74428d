"""Sinks.  Every write is a distributed one; nothing is brought to the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.joins import anti_unmapped
from tallyloom.operators.aggregates import group_sum


def write_csv(df: DataFrame, path: str, encoding: str | None = None, partition_by: Sequence[str] = (), escape: str = "\\") -> str:
    """``escape`` stands before a quote inside a cell; a quote there doubles it."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", escape)
    if encoding:
        writer = writer.option("encoding", encoding)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
    return path


def write_report_cuts(cuts: Mapping[str, DataFrame], folder: str, partition_by: str = "brand") -> str:
    """One Parquet table per cut, split by brand so that one brand's report reads only its own files."""
    for name, cut in cuts.items():
        cut.write.mode("overwrite").partitionBy(partition_by).parquet(f"{folder}/{name}")
    return folder


def read_report_cuts(spark: SparkSession, folder: str, cuts: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of ``write_report_cuts`` with the schemas they were written with."""
    return {
        name: spark.read.schema(cut.schema).parquet(f"{folder}/{name}").select(*cut.columns)
        for name, cut in cuts.items()
    }


def unmapped_names(
    fact: DataFrame, net_map: DataFrame, dma_map: DataFrame, network: str = "raw_network", market: str = "raw_market"
) -> DataFrame:
    """Networks and markets that no mapping knows, with their impressions: kind, name, brand, mvpd.

    Networks are looked up as written, markets ignoring case.
    """
    parts = [
        ("network", network, net_map, "feature_value", False),
        ("market", market, dma_map, "geography", True),
    ]
    found = None
    for kind, column, mapping, key, fold in parts:
        sums = group_sum(fact, [column, "brand", "mvpd"])
        left = anti_unmapped(sums, mapping, column, key, fold).select(
            F.lit(kind).alias("kind"), F.col(column).alias("name"), "brand", "mvpd", "impressions"
        )
        found = left if found is None else found.unionByName(left)
    return found


def write_unmapped(unmapped: DataFrame, path: str) -> str:
    """A directory per kind; a kind without rows leaves none, so nothing has to be counted first."""
    unmapped.write.mode("overwrite").partitionBy("kind").parquet(path)
    return path
