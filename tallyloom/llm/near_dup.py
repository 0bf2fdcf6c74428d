"""Near-duplicate documents by b-bit MinHash."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import components, frugal, materialize, mixed, quoted, shingles, small_batches, text_groups, without

ADDED = ("n_shingles", "component_id", "kept")


@dataclass(frozen=True)
class Rule:
    """Texts are linked if 100 * intersection >= percent * union of their sets of words-word shingles.

    A pair at the threshold shares no band with probability (1 - s ** rows) ** bands: 5e-11 at 0.85, 5e-8 at 0.8.
    ``slack`` is the margin of the bit estimate, in its standard deviations, below the threshold.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    bits: int = 4
    slack: float = 5.0
    block: int = 512

    @property
    def least(self) -> float:
        """Estimates below this are no candidates."""
        s, c = self.percent / 100, 0.5**self.bits
        p = c + (1 - c) * s
        return s - self.slack * (p * (1 - p) / (self.bands * self.rows)) ** 0.5 / (1 - c)


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def _minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full((len(sets), len(a)), 0xFFFFFFFF, np.uint32)
    for i, s in enumerate(sets):
        low = (s >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(low), 2048):
            np.minimum(out[i], (low[at:at + 2048, None] * a + b).min(0), out=out[i])
    return out


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def _packed(minima: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of every minimum, packed into 64-bit words."""
    low = (_spread(minima) & np.uint32((1 << bits) - 1)).astype(np.uint64)
    per = 64 // bits
    low = np.pad(low, ((0, 0), (0, -low.shape[1] % per))).reshape(len(low), -1, per)
    return np.bitwise_or.reduce(low << (np.arange(per, dtype=np.uint64) * np.uint64(bits)), axis=2)


def _equal(x: np.ndarray, y: np.ndarray, bits: int, n: int) -> np.ndarray:
    """How many of the n packed values agree, by counting the bits of folded differences."""
    d = x ^ y
    folded = d.copy()
    for j in range(1, bits):
        folded |= d >> np.uint64(j)
    ones = sum(1 << i for i in range(0, 64 - 64 % bits, bits))
    return n - np.bitwise_count(folded & np.uint64(ones)).sum(-1, dtype=np.int64)


def estimated(agree: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Similarity behind a share of agreeing values: those of different minima agree by chance in 1 of 2 ** bits."""
    c = 0.5**bits
    return (agree / n - c) / (1 - c)


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, n, fa, fb, bands, packed): size and fingerprint of each shingle set, band keys, packed bits."""
    a, b = _family(rule.bands * rule.rows)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_groups(batch.column("text")):
                sets = shingles(texts, rule.words)
                minima = _minima(sets, a, b)
                keys = np.zeros((len(texts), rule.bands), np.uint64)
                for j in range(rule.rows):
                    keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + minima[:, j::rule.rows].astype(np.uint64) + np.uint64(1))
                keys = mixed(keys + np.arange(rule.bands, dtype=np.uint64)).view(np.int64)
                packed = _packed(minima, rule.bits)
                n = np.array([len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, len(texts)),
                    pa.array(n, pa.int64()),
                    pa.array(np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                    pa.array(np.array([mixed(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)),
                    pa.array([k if m else None for k, m in zip(keys, n, strict=True)], pa.list_(pa.int64())),
                    pa.array([p.tobytes() for p in packed], pa.binary()),
                ], ["doc_id", "n", "fa", "fb", "bands", "packed"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(frugal(sign), "doc_id bigint, n bigint, fa bigint, fb bigint, bands array<bigint>, packed binary")


def _columns(batch: pa.RecordBatch | pa.Table, width: int) -> tuple[np.ndarray, ...]:
    ints = [batch.column(c).to_numpy() for c in ("key", "id", "size", "label")]
    packed = np.frombuffer(b"".join(batch.column("packed").to_pylist()), np.uint64).reshape(-1, width)
    return (*ints, packed)


def _pairs_within(ids, sizes, labels, packed, side, rule: Rule) -> np.ndarray:
    """All (i, j, estimate) of a block pair that may be linked, in order of estimate; side: which half a row is of."""
    n = rule.bands * rule.rows
    out = []
    for i in range(len(ids) - 1):
        j = np.arange(i + 1, len(ids))
        if side is not None:
            j = j[side[i + 1:] != side[i]]
        j = j[(labels[j] != labels[i]) & (100 * np.minimum(sizes[j], sizes[i]) >= rule.percent * np.maximum(sizes[j], sizes[i])) & (ids[j] != ids[i])]
        e = estimated(_equal(packed[j], packed[i], rule.bits, n), n, rule.bits)
        keep = e >= rule.least
        out.append(np.stack([np.full(keep.sum(), i), j[keep], e[keep]], 1))
    pairs = np.concatenate(out) if out else np.zeros((0, 3))
    return pairs[np.argsort(-pairs[:, 2], kind="stable")]


def _forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """The pairs of a spanning forest of highest estimates."""
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    keep = []
    for k, (i, j) in enumerate(pairs[:, :2].astype(int)):
        a, b = top(i), top(j)
        if a != b:
            root[a] = b
            keep.append(k)
    return pairs[keep]


def _blocked(members: DataFrame, rule: Rule) -> DataFrame:
    """Members of buckets by (bucket, pair of blocks), as ``key``; side 0 is a block with itself, 1 and 2 are two blocks."""
    blocks = F.ceil(F.col("n_bucket") / rule.block)
    m = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    many = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    other = F.when(F.col("blocks") > 1, many).otherwise(F.array(F.lit(0).cast("bigint")))
    m = m.withColumn("other", F.explode(other))
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return m.withColumn("key", group).withColumn("side", side)


def candidate_pairs(members: DataFrame, rule: Rule, forest: bool) -> DataFrame:
    """(a, b, estimate) among documents of one bucket.

    members: key, id, size (of the set), label (component), packed, n_bucket.  Buckets above ``rule.block`` members are
    cut into blocks by a hash of the id, and every pair of blocks is a task's work of its own; nothing is left out.
    With ``forest`` only the best-estimated spanning forest of a block pair comes back, otherwise all candidates.
    """
    width = -(-rule.bands * rule.rows // (64 // rule.bits))
    m = _blocked(members, rule).select("key", "id", "size", "label", "packed", "side")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups(part: tuple, last: bool) -> tuple[list[np.ndarray], tuple]:
            key = part[0]
            cuts = np.flatnonzero(np.diff(key)) + 1
            bounds = np.concatenate([[0], cuts, [len(key)]]) if len(key) else np.zeros(1, int)
            done = len(bounds) - 1 if last else len(bounds) - 2
            found = []
            lengths = np.diff(bounds[: done + 1]) if done > 0 else np.zeros(0, int)
            two = np.flatnonzero(lengths == 2)
            if len(two):  # most buckets hold two documents: all of them at once
                i = bounds[two]
                _, ids, sizes, labels, packed, _ = part
                n = rule.bands * rule.rows
                e = estimated(_equal(packed[i], packed[i + 1], rule.bits, n), n, rule.bits)
                ok = (e >= rule.least) & (ids[i] != ids[i + 1]) & (labels[i] != labels[i + 1])
                ok &= 100 * np.minimum(sizes[i], sizes[i + 1]) >= rule.percent * np.maximum(sizes[i], sizes[i + 1])
                found.append(np.stack([ids[i][ok], ids[i + 1][ok], (e[ok] * 1e6).astype(np.int64)], 1))
            for g in np.flatnonzero(lengths > 2):
                rows = slice(bounds[g], bounds[g + 1])
                _, ids, sizes, labels, packed, side = (x[rows] for x in part)
                pairs = _pairs_within(ids, sizes, labels, packed, None if (side == 0).all() else side, rule)
                if forest:
                    pairs = _forest(pairs, len(ids))
                i, j = pairs[:, 0].astype(int), pairs[:, 1].astype(int)
                found.append(np.stack([ids[i], ids[j], (pairs[:, 2] * 1e6).astype(np.int64)], 1))
            tail = tuple(x[bounds[max(done, 0)]:] for x in part)
            return found, tail

        def rows_of(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if found and sum(map(len, found)):
                f = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(f[:, 0], f[:, 1])), pa.array(np.maximum(f[:, 0], f[:, 1])), pa.array(f[:, 2] / 1e6)], ["a", "b", "estimate"])

        part = None
        for batch in batches:
            new = (*_columns(batch, width), batch.column("side").to_numpy())
            part = new if part is None else tuple(np.concatenate([x, y]) for x, y in zip(part, new, strict=True))
            found, part = groups(part, False)
            yield from rows_of(found)
        if part is not None:
            yield from rows_of(groups(part, True)[0])

    ordered = m.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(frugal(solve), "a bigint, b bigint, estimate double")


def confirmed_links(members: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): links on full sets that join documents of one bucket whose labels differ.

    members: as for ``candidate_pairs``, with shingles, bands and the number of the bucket's band.  A task holds two blocks
    with their sets; it looks at each pair in the first bucket the pair shares, leaves out pairs that are already joined,
    confirms the others on their sets, and returns the links that join something: fewer than it has documents.
    """
    width = -(-rule.bands * rule.rows // (64 // rule.bits))
    n = rule.bands * rule.rows
    m = _blocked(members, rule).select("key", "id", "size", "label", "packed", "side", "band", "bands", "shingles")

    def links(rows: list[pa.RecordBatch]) -> np.ndarray:
        t = pa.Table.from_batches(rows).combine_chunks()
        _, ids, sizes, labels, packed = _columns(t, width)
        side, band = t.column("side").to_numpy(), int(t.column("band")[0].as_py())
        bands = t.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        sets = t.column("shingles").combine_chunks()
        _, token = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        present = np.zeros(int(token.max(initial=-1)) + 1, bool)
        root = np.unique(labels, return_inverse=True)[1]
        out = []
        for i in range(len(ids) - 1):
            j = np.arange(i + 1, len(ids))
            if not (side == 0).all():
                j = j[side[i + 1:] != side[i]]
            j = j[(root[j] != root[i]) & (100 * np.minimum(sizes[j], sizes[i]) >= rule.percent * np.maximum(sizes[j], sizes[i]))]
            j = j[estimated(_equal(packed[j], packed[i], rule.bits, n), n, rule.bits) >= rule.least]
            j = j[(bands[j, :band] != bands[i, :band]).all(1)]
            if not len(j):
                continue
            own = token[ends[i]:ends[i + 1]]
            present[own] = True
            both = np.array([np.count_nonzero(present[token[ends[k]:ends[k + 1]]]) for k in j])
            present[own] = False
            for k in j[100 * both >= rule.percent * (sizes[i] + sizes[j] - both)]:
                if root[k] != root[i]:
                    out.append((ids[i], ids[k]))
                    root[root == root[k]] = root[i]
        return np.array(out, np.int64).reshape(-1, 2)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def result() -> pa.RecordBatch:
            f = links(kept)
            return pa.RecordBatch.from_arrays([pa.array(f.min(1, initial=1 << 62)), pa.array(f.max(1, initial=-(1 << 62)))], ["a", "b"])

        for batch in batches:
            keys = batch.column("key").to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if kept and kept[0].column("key")[0].as_py() != keys[a]:
                    yield result()
                    kept = []
                if b > a:
                    kept.append(batch.slice(a, b - a))
        if kept:
            yield result()

    return m.repartition("key").sortWithinPartitions("key").mapInArrow(frugal(solve), "a bigint, b bigint")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(id, shingles) with the sorted distinct shingle hashes of whole texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_groups(batch.column("text")):
                sets = [s.view(np.int64) for s in shingles(texts, words)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(texts)), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(frugal(cut), "id bigint, shingles array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    exact = 100 * both >= rule.percent * (F.size("x") + F.size("y") - both)
    return pairs.select("a", "b").join(left, "a").join(right, "b").filter(exact).select("a", "b")


def linked(docs: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """(signed, labels): every document with the representative of its exact set, and (node, component) of the linked.

    1. Documents with equal sets are one representative, the smallest doc_id, so copies never meet in a bucket.
    2. Band keys shared by two or more representatives are buckets; small ones give all candidates, large ones
       the spanning forest of highest bit estimates.  First each document's best candidate and the forests are
       confirmed on full sets and joined into components.
    3. Then all remaining candidates between different components are confirmed, those of large buckets inside the
       task that finds them, block by block.  A pair inside one component cannot change it, so no link that matters is lost, and a
       group of thousands of near copies costs a few pairs for each copy.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        signed = materialize(signatures(docs.filter("doc_id is not null"), rule), "signatures")
    # Null and empty texts have no set; documents without one are never grouped.
    full = signed.filter("n > 0")
    heads = full.groupBy("n", "fa", "fb").agg(F.min("doc_id").alias("rep"))
    heads = materialize(heads, "heads")
    reps = full.join(heads.select(F.col("rep").alias("doc_id"), "n", "fa", "fb"), ["doc_id", "n", "fa", "fb"]).dropDuplicates(["doc_id"])
    # The keys alone are counted and shuffled; signatures follow for members of shared buckets only.
    keys = reps.select(F.col("doc_id").alias("id"), F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n_bucket")).filter("n_bucket > 1")
    inside = materialize(keys.join(shared, "key"), "buckets")
    about = reps.select(F.col("doc_id").alias("id"), F.col("n").alias("size"), "packed")
    members = inside.join(about.join(inside.select("id").distinct(), "id", "left_semi"), "id")
    members = materialize(members.withColumn("label", F.col("id")), "members")
    small, large = members.filter("n_bucket <= 16"), members.filter("n_bucket > 16")
    near = materialize(candidate_pairs(small, rule, False).distinct(), "near")
    trees = materialize(candidate_pairs(large, rule, True).select("a", "b").distinct(), "trees")
    ends = near.select("a", "b").unionByName(trees).select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    ends = materialize(ends, "ends")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(ends, "doc_id").dropDuplicates(["doc_id"])
    with small_batches(spark):
        sets = materialize(shingle_sets(texts, rule.words), "sets")
    sides = near.select(F.col("a").alias("id"), "a", "b", "estimate").unionByName(near.select(F.col("b").alias("id"), "a", "b", "estimate"))
    best = sides.groupBy("id").agg(F.max(F.struct("estimate", F.col("a"), F.col("b"))).alias("m")).select("m.a", "m.b")
    first = best.unionByName(trees).distinct()
    links = materialize(confirmed(first, sets, rule), "links")
    labels = components(links, "labels")

    def labelled(df: DataFrame, side: str) -> DataFrame:
        return df.join(labels.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}")), side, "left").withColumn(f"c_{side}", F.coalesce(f"c_{side}", side))

    between = labelled(labelled(near.select("a", "b"), "a"), "b").filter("c_a <> c_b").select("a", "b")
    split = labelled(large.withColumnRenamed("id", "a").drop("label"), "a").withColumnRenamed("a", "id").withColumnRenamed("c_a", "label")
    # Buckets whose members are all in one component have nothing left to find.
    open_keys = split.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key")
    whole = split.join(open_keys, "key", "left_semi").join(sets, "id").join(reps.select(F.col("doc_id").alias("id"), "bands"), "id")
    with small_batches(spark):
        wide = materialize(confirmed_links(whole, rule), "links")
    second = between.distinct().join(first, ["a", "b"], "left_anti")
    later = materialize(confirmed(second, sets, rule).unionByName(wide), "links")
    if not later.isEmpty():
        labels = components(links.unionByName(later), "labels")
    # Components of representatives; a component's smallest representative is its smallest doc_id.
    marked = signed.join(heads, ["n", "fa", "fb"], "left")
    return marked.select("doc_id", "n", "rep"), labels


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per distinct doc_id.

    component_id is the smallest doc_id reachable over links, the document itself if it has none; kept marks one
    document of each group.  Null or empty texts have no shingles and no links.  A doc_id listed more than once
    takes the text of one of its rows (they should agree); a null doc_id takes no part and has no row here.
    """
    marked, labels = linked(docs, rule)
    marked = marked.groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("rep").alias("rep"))
    out = marked.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    whole: Column = F.coalesce("component", "rep", "doc_id")
    return out.select("doc_id", "n_shingles", whole.alias("component_id"), (F.col("doc_id") == whole).alias("kept"))


# Keys of rows that no doc_id of their own tells apart begin here.
_OWN = 1 << 62


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with ``_key``: the doc_id if it is a long that one text alone has, else one from a hash of doc_id and text."""
    number = F.col("doc_id").try_cast("bigint") if dict(docs.dtypes)["doc_id"] == "string" else F.col("doc_id").cast("bigint")
    text = F.xxhash64("text", F.col("text").isNull())
    marked = docs.withColumns({"_number": F.when(number.cast("string") == F.col("doc_id").cast("string"), number), "_hash": text})
    shared = marked.groupBy("_number").agg(F.min("_hash").alias("lo"), F.max("_hash").alias("hi")).filter("_number is not null and lo <> hi")
    shared = materialize(shared.select("_number", F.lit(True).alias("_shared")), "shared_ids")
    own = F.xxhash64(F.col("doc_id").cast("string"), F.col("doc_id").isNull(), "_hash").bitwiseAND(F.lit(_OWN - 1)) + F.lit(_OWN)
    key = F.when(F.col("_shared").isNotNull() | F.col("_number").isNull(), own).otherwise(F.col("_number"))
    return marked.join(shared, "_number", "left").withColumn("_key", key).drop("_number", "_hash", "_shared")


def drop_near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One document of each group, with the columns it came with.

    Rows are told apart by doc_id and text: rows that share a doc_id with different texts are documents of their own, as are
    rows with a null doc_id or one that is no number, and all are compared; of rows that repeat both one stays.  Null and
    empty texts have no duplicates but rows that repeat their doc_id.  Of a group the smallest doc_id stays that is one
    text's own, if there is any.
    """
    keyed = _keyed(docs.select("doc_id", "text", F.struct(*[quoted(c) for c in docs.columns]).alias("_row")))
    found = near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text"), rule)
    keep = materialize(found.filter("kept").select(F.col("doc_id").alias("_key")), "kept")
    stay = keyed.join(keep, "_key", "left_semi").dropDuplicates(["_key"])
    return stay.select("_row.*")
