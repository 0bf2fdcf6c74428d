"""Simple undirected graph from directed edge lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize


def gender_code(gender: Column) -> Column:
    return F.when(gender == "male", 1).when(gender == "female", 0).cast("bigint")


def vertex_color(code: Column) -> Column:
    return F.when(code == 1, "blue").otherwise("orange")


def union_edges(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both lists with the sender's gender as a number and its colour; repeats are kept."""
    rows = a.unionByName(b).withColumn("gender_code", gender_code(F.col("gender_from")))
    return rows.withColumn("color", vertex_color(F.col("gender_code"))).drop("gender_from")


def simplify(edges: DataFrame, src: str = "from", dst: str = "to") -> DataFrame:
    """Undirected edges without loops and repeats; duplicates collapse before the shuffle."""
    return (
        edges.filter(F.col(src) != F.col(dst))
        .select(F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst"))
        .distinct()
    )


def vertices(edges: DataFrame, src: str = "from", dst: str = "to") -> DataFrame:
    """Every endpoint with the gender code it has as a sender; endpoints that never send have none.

    Both ends of an edge come from one row, and codes are numbers, so this is one hash aggregate over one scan.
    """
    ends = F.array(
        F.struct(F.col(src).alias("vertex"), F.col("gender_code").alias("code"), F.lit(1).alias("sends")),
        F.struct(F.col(dst).alias("vertex"), F.lit(None).cast("bigint").alias("code"), F.lit(0).alias("sends")),
    )
    return edges.select(F.inline(ends)).groupBy("vertex").agg(F.max("code").alias("code"), F.max("sends").alias("sends"))


def graph_edges(a: DataFrame, b: DataFrame) -> DataFrame:
    """The simple graph of both lists, each edge with the colours of its ends.

    Vertices, one row each, are written before they are joined to both ends.
    """
    rows = union_edges(a, b)
    nodes = materialize(vertices(rows), "vertices")
    nodes = nodes.select("vertex", F.when(F.col("sends") == 1, vertex_color(F.col("code"))).alias("color"))
    ends = simplify(rows)
    for end in ("src", "dst"):
        side = nodes.select(F.col("vertex").alias(end), F.col("color").alias(f"{end}_color"))
        ends = ends.join(side, end, "left")
    return ends.select("src", "dst", "src_color", "dst_color")
