"""Helpers shared by the operators: scratch tables, column hygiene, components, hashed words."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import materialize

# White space that ends a word, as a Java class and as bytes.
SPACE = r"\x20\x09-\x0D"
SPACE_BYTES = b"\x20\x09\x0a\x0b\x0c\x0d"

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_SEGMENT = 1 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without columns that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500) -> Iterator[None]:
    """Hand whole texts to Python a few at a time while an operator's own jobs run; the session's setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def frugal(work):
    """A generator over batches that gives Arrow's unused memory back when it ends."""

    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def lower_ascii(text):
    """Lower-case A-Z alone.  ``lower`` does the same, faster, where a text has no other letters."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of an undirected graph, the component being its smallest node.

    Edges are rows (a, b) of longs.  Alternates large-star and small-star steps until nothing changes;
    each step is two aggregates and two joins on nodes, and is written, so lineage stays short and no
    component is ever gathered.  Nodes without edges do not occur.  Loops and nulls are dropped.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = materialize(e, name)
    if e.isEmpty():
        return spark.createDataFrame([], "node long, component long")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        e = materialize(small.select("e.*").filter("u <> v").distinct(), name)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.max("v")).first()
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


# Words as 64-bit hashes, straight from the bytes of a batch of texts.

def _byte_table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_IS_SPACE = _byte_table(SPACE_BYTES)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and _BASE ** -i modulo 2 ** 64, for i below n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, _SEGMENT + 4096)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers[:] = [np.multiply.accumulate(np.array([1] + [b] * (size - 1), np.uint64)) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start of every word of a byte string and the hash of its bytes, A-Z lower-cased.

    Works through segments that end at white space, so memory does not grow with long texts.
    """
    raw = np.frombuffer(data, np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(raw):
        to = min(len(raw), at + _SEGMENT)
        while to < len(raw) and not _IS_SPACE[raw[to]]:  # a word that crosses the end is taken whole
            more = np.flatnonzero(_IS_SPACE[raw[to:to + 4096]])
            to = to + int(more[0]) if len(more) else min(len(raw), to + 4096)
        part = raw[at:to]
        word = np.concatenate([[False], ~_IS_SPACE[part], [False]])
        turns = np.flatnonzero(word[1:] != word[:-1])
        first, last = turns[::2], turns[1::2]
        power, inverse = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((_LOWER[part].astype(np.uint64) + np.uint64(1)) * power[:len(part)], out=sums[1:])
        starts.append(first + at)
        hashes.append(mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)))
        at = to
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def text_groups(column: pa.Array, limit: int = _SEGMENT) -> Iterator[tuple[int, list[bytes]]]:
    """Rows of a text column in runs of about ``limit`` bytes: first row and texts, null as empty."""
    kept, size, first = [], 0, 0
    for i in range(len(column)):
        text = column[i].as_py()
        text = b"" if text is None else text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
        if kept and size + len(text) > limit:
            yield first, kept
            kept, size, first = [], 0, i
        kept.append(text)
        size += len(text)
    if kept:
        yield first, kept


def shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its k-word shingles; a shorter text is one shingle."""
    starts, words = hashed_words(b"\n".join(texts))
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    cuts = np.searchsorted(starts, bounds)
    rolled = words[: max(0, len(words) - k + 1)].copy()
    for j in range(1, k):
        rolled = mixed(rolled * np.uint64(_BASE) + words[j:len(words) - k + 1 + j])
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a:b - k + 1]))
        elif b > a:
            whole = words[a:a + 1]
            for j in range(a + 1, b):
                whole = mixed(whole * np.uint64(_BASE) + words[j:j + 1])
            out.append(mixed(whole + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
