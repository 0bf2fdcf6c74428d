"""Language identification: averaged hashed subword embeddings under a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import text_groups, without

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """The sample is bounded: about ``sample_docs`` labelled texts, ``sample_chars`` characters of each at most."""

    sample_docs: int = 2400
    sample_chars: int = 50_000
    buckets: int = 1 << 15
    dim: int = 16
    epochs: int = 4
    rate: float = 0.6
    seed: int = 11
    reject_below: float = 0.5
    max_langs: int = 1000  # the most frequent languages are learned, each gets its share of the sample


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # bucket x language: embedding times output weights, since both are linear
    bias: np.ndarray
    sharpness: float  # calibrated on texts the training did not see
    buckets: int


# Letters keep their bytes in lower case, other ASCII is a word boundary.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def subwords(data: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of every byte 2-, 3- and 4-gram that lies in one word, its boundaries being marked by a space."""
    out = []
    if not len(data):
        return np.zeros(0, np.int64)
    b = _FOLD[np.concatenate([[32], data, [32]])].astype(np.uint32)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    for n in (2, 3, 4):
        if len(b) < n:
            break
        m = len(b) - n + 1
        code = np.zeros(m, np.uint32)
        inside = np.ones(m, bool)
        for j in range(n):
            code = (code << np.uint32(8)) | b[j:j + m]
            if 0 < j < n - 1:
                inside &= b[j:j + m] != 32
        inside &= ~((b[:m] == 32) & (b[n - 1:n - 1 + m] == 32))
        hashed = (code[inside] ^ np.uint32(n * 0x51ED27)) * np.uint32(0x9E3779B1)
        hashed ^= hashed >> np.uint32(15)
        out.append((hashed * np.uint32(0x85EBCA77)) >> shift)
    return np.concatenate(out).astype(np.int64)


def _counted(text: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    ids, n = np.unique(subwords(np.frombuffer(text, np.uint8), buckets), return_counts=True)
    return ids, n / max(1, n.sum())


def train(texts: list[bytes], labels: list[str], s: Settings = Settings()) -> Model:
    """Stochastic gradient descent over whole texts and over random spans of words, so that short texts count too.

    A tenth of the texts is kept back; the temperature of the softmax is the one that makes them most likely.
    """
    langs = sorted(set(labels))
    if not langs:
        return Model([], np.zeros((s.buckets, 0), np.float32), np.zeros(0), 1.0, s.buckets)
    rng = np.random.default_rng(s.seed)
    where = {x: i for i, x in enumerate(langs)}
    y = np.array([where[x] for x in labels])
    table = rng.normal(0, 0.1, (s.buckets, s.dim))
    weights, bias = np.zeros((s.dim, len(langs))), np.zeros(len(langs))
    order = rng.permutation(len(texts))
    held = order[: len(texts) // 10]
    rest = order[len(held):] if len(order) > len(held) else order
    whole = {int(i): _counted(texts[i], s.buckets) for i in rest}
    tempered = 1 / np.maximum(1, np.bincount(y[rest], minlength=len(langs)))
    tempered = np.minimum(5.0, tempered / tempered[tempered > 0].min())  # rare languages weigh more, within bounds
    words = {int(i): texts[i].split() for i in rest}
    steps, at = s.epochs * 2 * len(rest), 0
    for _ in range(s.epochs):
        for i in rng.permutation(rest):
            for span in (False, True):
                rate = s.rate * (1 - at / steps)
                at += 1
                if span:
                    w = words[int(i)]
                    k = int(rng.integers(1, 16))
                    a = int(rng.integers(0, max(1, len(w) - k + 1)))
                    ids, share = _counted(b" ".join(w[a:a + k]), s.buckets)
                else:
                    ids, share = whole[int(i)]
                if not len(ids):
                    continue
                h = share @ table[ids]
                z = h @ weights + bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y[i]] -= 1
                p *= rate * tempered[y[i]]
                table[ids] -= np.outer(share * len(ids) ** 0.5, weights @ p)
                weights -= np.outer(h, p) * 5
                bias -= p * 0.05
    model = Model(langs, table @ weights, bias, 1.0, s.buckets)
    short = [b" ".join(texts[i].split()[:12]) for i in held]
    z = np.array([logits(model, np.frombuffer(t, np.uint8)) for t in [*[texts[i] for i in held], *short]])
    if len(z):
        truth = np.concatenate([y[held], y[held]])

        def loss(k: float) -> float:
            v = z * k
            v = v - v.max(1, keepdims=True)
            return float((np.log(np.exp(v).sum(1)) - v[np.arange(len(v)), truth]).mean())

        model.sharpness = min(np.geomspace(0.1, 10, 41), key=loss)
    return model


def logits(model: Model, data: np.ndarray, segment: int = 1 << 20) -> np.ndarray:
    """Average score of a text's subwords; long texts are counted in overlapping segments."""
    counts = np.zeros(model.buckets)
    for a in range(0, len(data), segment):
        counts += np.bincount(subwords(data[max(0, a - 3):a + segment], model.buckets), minlength=model.buckets)
    total = counts.sum()
    return (counts @ model.scores / total if total else np.zeros(len(model.langs))) + model.bias


def fit(docs: DataFrame, held_out: Column | None = None, s: Settings = Settings()) -> Model:
    """Train on a bounded sample of the labelled documents that are not held out, spread over the languages.

    Counts per language set the share of each that is drawn by a hash of doc_id and text, with a margin, of which the
    smallest hashes stay; only that sample (sizes in ``Settings``) comes to the driver, where numpy trains.  Of long texts
    the beginning teaches.  Rows with null text or lang teach nothing.
    """
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0)
    if held_out is not None:
        usable &= ~F.coalesce(held_out, F.lit(False))
    labelled = docs.filter(usable).select("doc_id", "text", F.col("lang").alias("lang"))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(s.max_langs).collect()}
    if not counts:
        return train([], [], s)
    each = max(1, s.sample_docs // len(counts))
    draw = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text", F.lit(s.seed)), 1) / F.lit(float(1 << 63))
    # Twice ``each`` and 40 rows are expected, so that a language hardly ever comes out short of ``each``.
    shares = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, (2 * each + 40) / n))])
    rows = labelled.withColumn("draw", draw).filter(F.col("draw") < F.element_at(shares, F.col("lang")))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    rows = rows.withColumn("text", F.substring("text", 1, s.sample_chars)).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= each)
    rows = rows.orderBy("doc_id", "lang").select("text", "lang").collect()
    return train([r["text"].encode("utf-8", "surrogatepass") for r in rows], [r["lang"] for r in rows], s)


def predict(docs: DataFrame, model: Model, s: Settings = Settings()) -> DataFrame:
    """Adds lang_pred, score (calibrated probability, 0 to 1) and rejected; a present column of these names is replaced.

    A text that is null or without a letter is ``und`` with score 0 and rejected.  Others get the best language;
    they are rejected if it is, after calibration, more likely wrong than right.  Without any learned language
    every text is ``und``.  Whole texts are read; only the text goes through Python, in batches.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets times languages

    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for column in batches:
            best, sure = [], []
            for _, texts in text_groups(column):
                for t in texts:
                    z = logits(model, np.frombuffer(t, np.uint8)) * model.sharpness if model.langs else np.zeros(1)
                    p = np.exp(z - z.max())
                    best.append(model.langs[int(z.argmax())] if model.langs else UNKNOWN)
                    sure.append(float(p.max() / p.sum()) if model.langs else 0.0)
            yield pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(sure, pa.float64())], ["lang", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    guess = F.arrow_udf(_typed(label), "struct<lang:string,score:double>")
    out = without(docs, "lang_pred", "score", "rejected").withColumn("_guess", guess(F.col("text"))).withColumn("_lettered", lettered)
    return out.withColumns({
        "lang_pred": F.when(F.col("_lettered"), F.col("_guess.lang")).otherwise(UNKNOWN),
        "score": F.when(F.col("_lettered"), F.col("_guess.score")).otherwise(0.0),
        "rejected": ~F.col("_lettered") | (F.col("_guess.score") < s.reject_below),
    }).drop("_guess", "_lettered")


def _typed(f):
    f.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return f
