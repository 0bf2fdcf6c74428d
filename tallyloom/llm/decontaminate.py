"""Benchmark decontamination (native): prefix-filtered set join of benchmark windows with documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import lower_ascii, materialize, without

WINDOW = 13
SHINGLE = 5

# The words of a lower-cased text, and the same words of a text as it is.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_ANY_CASE)), F.lit(0)).cast("bigint")


def _shingle_hash(of: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(of, at + j) for j in range(k)])


def _shingle_text(of: Column, at: Column, k: int) -> Column:
    return F.array_join(F.slice(of, at + 1, F.lit(k)), " ")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(window, len, k, n, off, sid, shingle, item_id): every shingle of every item-sized window.

    A window is ``window`` consecutive words of an item, or all words of a shorter item that has any; its
    shingles have k words, fewer only in windows of fewer.  A window is known by its text.
    """
    w = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(size - window, F.lit(0)))
    w = w.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s") + 1, F.lit(window)).alias("w"))
    w = w.withColumns({"window": F.array_join("w", " "), "len": F.size("w"), "k": F.least(F.size("w"), F.lit(shingle))})
    w = w.withColumn("n", F.col("len") - F.col("k") + 1).withColumn("off", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    parts = [(k, F.col("k") == k) for k in range(1, shingle + 1)]
    sid, text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    for k, is_k in parts:
        sid = F.when(is_k, _shingle_hash(F.col("w"), F.col("off"), k)).otherwise(sid)
        text = F.when(is_k, _shingle_text(F.col("w"), F.col("off"), k)).otherwise(text)
    return w.select("window", "len", "k", "n", "off", sid.alias("sid"), text.alias("shingle"), "item_id")


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, start, len, window): every place of a document where a benchmark window occurs.

    1. Every shingle of every document meets the distinct benchmark shingles (hash, then text); the few matches are
       written.  The benchmark table is written first, so Spark broadcasts it only if its measured size allows.
    2. The matches give each shingle's rarity in the whole corpus.  Full containment needs a prefix of one token,
       so each window keeps the rarest of its shingles (ties to the smaller hash); a window with a shingle that
       occurs nowhere is dropped.
    3. Matches of that shingle give the window's only possible start; starts before or beyond the text go.
    4. A candidate is an occurrence if each of its shingles matches at its own place, which is exact.

    Rows are told apart by doc_id and a hash of the text, so repeated rows are the same document.
    """
    spark = docs.sparkSession
    parts = materialize(benchmark_windows(benchmark, window, shingle).distinct(), "windows")
    lengths = [r["k"] for r in parts.select("k").distinct().collect()]  # at most ``shingle`` numbers
    if not lengths:
        return spark.createDataFrame([], "doc_id bigint, text_hash bigint, start int, len int, window string")
    probes = materialize(parts.select("k", "sid", "shingle").distinct(), "probes")
    w = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    found = None
    for k in sorted(lengths):
        at = w.filter(F.size("w") >= k).select("doc_id", "text_hash", "w", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("pos"))
        at = at.select("doc_id", "text_hash", "pos", F.size("w").alias("n_words"), _shingle_hash(F.col("w"), F.col("pos"), k).alias("h"), _shingle_text(F.col("w"), F.col("pos"), k).alias("t"))
        own = probes.filter(F.col("k") == k).select("sid", "shingle")
        hits = at.join(own, (F.col("h") == F.col("sid")) & (F.col("t") == F.col("shingle"))).select("doc_id", "text_hash", "pos", "n_words", "sid")
        found = hits if found is None else found.unionByName(hits)
    # A document listed twice matches twice; what follows counts places, so repeats are dropped where they matter.
    matches = materialize(found, "matches")
    rarity = matches.groupBy("sid").agg(F.count("*").alias("seen"))
    windows = parts.drop("item_id", "shingle").distinct().join(rarity, "sid", "left")
    rarest = windows.groupBy("window", "len", "n").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "sid", "off")).alias("r"))
    prefix = materialize(rarest.filter("r.seen > 0").select("window", "len", "n", "r.sid", "r.off"), "prefix")
    start = F.col("pos") - F.col("off")
    candidates = matches.join(prefix, "sid").filter((start >= 0) & (start + F.col("len") <= F.col("n_words")))
    candidates = candidates.select("doc_id", "text_hash", start.alias("start"), "window", "len", "n").distinct()
    rest = windows.select("window", F.col("off"), F.col("sid").alias("want"))
    needed = candidates.join(rest, "window").withColumn("place", F.col("start") + F.col("off"))
    there = matches.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.col("pos").alias("p"), F.col("sid").alias("s")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_hash").eqNullSafe(F.col("t")) & (F.col("place") == F.col("p")) & (F.col("want") == F.col("s"))
    whole = needed.join(there, same).groupBy("doc_id", "text_hash", "start", "window", "len", "n").agg(F.count("*").alias("got"))
    return whole.filter(F.col("got") == F.col("n")).select("doc_id", "text_hash", "start", "len", "window")


def _covered(spans: Column) -> Column:
    """Words under sorted (start, len) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total"))

    def step(acc, s):
        end = F.greatest(acc["end"], s["start"] + s["len"])
        return F.struct(end.alias("end"), (acc["total"] + end - F.greatest(acc["end"], s["start"])).alias("total"))

    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc["total"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document that holds any window: doc_id, text_hash, n_hit, item_ids (sorted strings)."""
    found = materialize(occurrences(docs, benchmark, window, shingle), "occurrences")
    hit = found.groupBy("doc_id", "text_hash").agg(_covered(F.collect_set(F.struct("start", "len"))).alias("n_hit"))
    items = benchmark_windows(benchmark, window, shingle).select("window", "item_id").filter("item_id is not null").distinct()
    held = found.select("doc_id", "text_hash", "window").distinct().join(items, "window").select("doc_id", "text_hash", "item_id").distinct()
    held = held.groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("t")).agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_hash").eqNullSafe(F.col("t"))
    return hit.join(held, same, "left").drop("d", "t")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, one_in: int = 20) -> DataFrame:
    """Documents with n_words, n_hit, n_items, items_sha256 and contaminated.

    contaminated: hit words are at least one in ``one_in``.  Null and empty texts have no words and are clean;
    an empty benchmark leaves all clean; items with a null item_id count as hits, not as items; present columns
    with the added names are replaced, others stay as they are.
    """
    base = without(docs, *ADDED).withColumns({"n_words": n_words(F.col("text")), "_t": F.xxhash64("text")})
    hits = materialize(contamination(docs, benchmark, window, shingle), "hits").select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("n_hit").alias("_n"), F.col("item_ids").alias("_i")
    )
    out = base.join(hits, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("_t").eqNullSafe(F.col("_h")), "left")
    ids = F.coalesce("_i", F.array().cast("array<string>"))
    return out.withColumns({
        "n_hit": F.coalesce("_n", F.lit(0)).cast("bigint"),
        "n_items": F.size(ids).cast("bigint"),
        "items_sha256": F.sha2(F.array_join(ids, ","), 256),
    }).withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))).drop("_d", "_h", "_n", "_i", "_t")
