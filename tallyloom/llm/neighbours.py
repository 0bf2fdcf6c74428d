"""Nearest neighbours by inner product: every query meets every vector, in blocks of bounded size."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize


@dataclass(frozen=True)
class Forest:
    """``rows`` vectors by ``queries`` queries are a task's block.

    The other fields steered a forest of hash prefixes that left vectors out; they are accepted and no longer used.
    """

    trees: int = 32
    bits: int = 24
    root: int = 3
    share: float = 0.6
    least: int = 4000
    rows: int = 8192
    queries: int = 1024
    seed: int = 5


def valid_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v) with v an array of doubles, without null ids and vectors that are null, zero, or not finite throughout."""
    v = F.col(vector_column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id_column).cast("bigint").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0)
    )


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding", f: Forest = Forest()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best by inner product, exact, ties to the smaller vec_id; all if there are fewer.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do those whose dimension is
    not the most frequent one; a query never finds its own id; of repeated ids the better row counts.  No valid
    vector gives no rows.  A task holds about ``rows`` vectors and ``queries`` queries, dealt by a hash, and returns the k best
    of its block for each query.  The work is queries times vectors.
    """
    spark = vectors.sparkSession
    everything = valid_vectors(vectors, id_column, vector_column).withColumn("is_query", F.lit(False))
    asked = valid_vectors(queries, id_column, vector_column).withColumn("is_query", F.lit(True))
    both = materialize(everything.unionByName(asked).withColumn("dim", F.size("v")), "vectors")
    about = both.groupBy("dim").agg(F.sum((~F.col("is_query")).cast("int")).alias("n"), F.sum(F.col("is_query").cast("int")).alias("q")).filter("n > 0").orderBy(F.desc("n"), "dim").first()
    if about is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = about["dim"]
    parts, turns = max(1, -(-about["n"] // f.rows)), max(1, -(-about["q"] // f.queries))
    spread = F.xxhash64("id", "v")
    own = F.pmod(spread, F.when(F.col("is_query"), F.lit(turns)).otherwise(F.lit(parts)))
    others = F.sequence(F.lit(0), F.when(F.col("is_query"), F.lit(parts)).otherwise(F.lit(turns)) - 1).cast("array<bigint>")
    dealt = both.filter(F.col("dim") == dim).drop("dim").withColumn("own", own).withColumn("other", F.explode(others))
    dealt = dealt.select(
        "id", "is_query", "v", F.when(F.col("is_query"), F.col("other")).otherwise(F.col("own")).alias("part"), F.when(F.col("is_query"), F.col("own")).otherwise(F.col("other")).alias("turn")
    )

    def score(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy()
        rows, asks = table.filter(pa.array(~is_query)), table.filter(pa.array(is_query))
        ids, q_ids = rows.column("id").to_numpy(), asks.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        heads = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, int)
        x, q = _matrix(rows.column("v"), dim)[order], _matrix(asks.column("v"), dim)
        ids = ids[heads]
        out = []
        for at in range(0, len(q) if len(ids) else 0, 128):
            s = np.maximum.reduceat(q[at:at + 128] @ x.T, heads, axis=1)
            other = q_ids[at:at + 128][:, None] != ids
            for r in range(len(s)):
                mine, those = s[r][other[r]], ids[other[r]]
                best = np.flatnonzero(mine >= np.partition(mine, -k)[-k]) if len(mine) > k else np.arange(len(mine))
                best = best[np.lexsort((those[best], -mine[best]))][:k]
                out.append((np.full(len(best), q_ids[at + r]), those[best], mine[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    found = dealt.groupBy("part", "turn").applyInArrow(score, "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
