"""Token ids of a corpus in files of length-limited canonical Huffman codes."""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import frugal, materialize, small_batches

END_ID = 1
MAX_BITS = 18
BLOCK_IDS = 1 << 16
CHECKPOINT_IDS = 64
COMMON_DOCUMENTS, COMMON_WORDS = 1 << 12, 1 << 17  # rows that are asked for common words, about, and how many are kept
CACHE_BYTES = 64 << 20  # what a task remembers of words, about
GROUP_CHARS = 1 << 21  # characters whose words are told apart at once, about; a longer text is a group

# White space that str.split also takes but that is left to the tokenizer here.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ASCII_SPACE = re.compile("[\x09-\x0d\x20]+")
# Fixed value: ASCII marks that are a piece of their own beside letters; the apostrophe is not, it may join some.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# The pieces that ``word_bpe_49k.json`` cuts a lower-cased text into, for texts without characters that are
# odd here: what lower-cases to other letters, composes, or is a letter, number or space outside ASCII and Latin letters.
_PLAIN_ODD = re.compile("[^\x00-\x1b\x20-\x7e\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e]")
_PIECES = re.compile(r"[a-z\xdf-\xf6\xf8-\u017f]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\sa-z\xdf-\xf6\xf8-\u017f0-9]+", re.ASCII)

_ID = attrgetter("id")


def _four_bytes(ids) -> bytes:
    packed = array("i", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _byte_alphabet() -> str:
    """Byte-level BPE writes a byte as itself where it is a visible Latin-1 character, else as the next one after 255."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
    written = {b: 256 + i for i, b in enumerate(hidden)}
    return "".join(chr(written.get(b, b)) for b in range(256))


class Encoder(dict):
    """Words to the bytes of their ids (little-endian, 32 bits), by the tokenizers library; unknown words are encoded
    when they are first asked for.

    A text's ids are those of its words in turn: ``word_bpe_49k.json`` drops white space and never joins what it
    parts.  Texts of ASCII and Latin letters are lower-cased, their words told apart by Arrow, a group of texts at once, and
    each distinct word is cut into its pieces, so that a piece is one entry however it is written and whatever marks
    follow.  Other texts are cut at white space, word by word.  ``common`` words are known from the start.  The tokenizer
    lower-cases and cuts letters from marks, so a word of letters between marks is looked up by its parts, and a run of
    letters in lower case goes to the BPE model itself.  Anything else takes the library's whole path.
    """

    def __init__(self, definition: str, common: tuple[str, bytes, bytes] = ("", b"", b"")):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        self.common = common
        self._start()

    def _start(self) -> None:
        """Nothing is known but the common words: words, sizes of their ids in bytes, ids."""
        self.clear()
        words, sizes, ids = self.common
        ends = np.cumsum(np.frombuffer(sizes, "<i4")).tolist()
        self.update(zip(words.split(), map(ids.__getitem__, map(slice, [0, *ends[:-1]], ends))))
        self.held = 180 * len(self) + 2 * len(words) + len(ids)

    def __missing__(self, word: str) -> bytes:
        return self._kept(word, self._encoded(word))

    def _kept(self, word: str, packed: bytes) -> bytes:
        size = 180 + 2 * len(word) + len(packed)
        if size < CACHE_BYTES >> 6:
            if self.held + size > CACHE_BYTES:  # frequent words come back at once
                self._start()
            self[word] = packed
            self.held += size
        return packed

    def _mapped(self, letters: str) -> str:
        return letters if letters.isascii() else charmap_decode(letters.encode(), "strict", self.alphabet)[0]

    def _encoded(self, word: str) -> bytes:
        letters = word.strip(_MARKS)
        lower = letters.lower()
        if lower.isalpha() and "<|" not in word and "\u03a3" not in letters and (letters.isascii() or unicodedata.is_normalized("NFC", letters)):
            if letters != word or lower != letters:
                at = word.find(letters)
                return b"".join(self[x] for x in (word[:at], lower, word[at + len(letters):]) if x)
            return _four_bytes(map(_ID, self.model.tokenize(self._mapped(lower))))
        return _four_bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _packed(self, words: list[str]) -> list[bytes]:
        """The ids of distinct lower-cased words of plain texts."""
        tokenize, out = self.model.tokenize, [*map(self.get, words)]
        fresh = [i for i, packed in enumerate(out) if packed is None]
        runs = [i for i in fresh if words[i].isalpha()]
        ids = [[t.id for t in tokenize(self._mapped(words[i]))] for i in runs]
        raw, at = np.fromiter(chain.from_iterable(ids), "<i4").tobytes(), 0
        for i, own in zip(runs, ids, strict=True):
            out[i] = self._kept(words[i], raw[at:(at := at + 4 * len(own))])
        for i in fresh:
            if out[i] is None:
                out[i] = b"".join(map(self.__getitem__, _PIECES.findall(words[i])))
        return out

    def _plain_ids(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Ids of lower-cased plain texts: every distinct word is looked up once, its ids are then put wherever it stands."""
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        found = words.flatten().dictionary_encode()
        packed = [*self._packed(found.dictionary.to_numpy(zero_copy_only=False).tolist()), _four_bytes([end])]
        table = np.frombuffer(b"".join(packed), "<i4")
        n = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
        first = np.cumsum(n) - n
        bounds = words.offsets.to_numpy()[1:].astype(np.int64)
        at = np.insert(found.indices.to_numpy().astype(np.int64), bounds, len(packed) - 1)
        n, first = n[at], first[at]
        ends = np.cumsum(n)
        flat = table[np.repeat(first - (ends - n), n) + np.arange(int(ends[-1]))]
        return np.split(flat, ends[bounds + np.arange(len(bounds))][:-1])

    def ids(self, texts: list[str], end: int) -> list[np.ndarray]:
        last, out, group, size = _four_bytes([end]), [], [], 0

        def put() -> None:
            for i, own in zip(group, self._plain_ids([texts[i].lower() for i in group], end) if group else (), strict=True):
                out[i] = own

        for i, t in enumerate(texts):
            out.append(None)
            if "<|" not in t and not _PLAIN_ODD.search(t):
                if size + len(t) > GROUP_CHARS:
                    put()
                    group, size = [], 0
                group.append(i)
                size += len(t)
            else:
                words = t.split() if not _ODD_SPACE.search(t) else [w for w in _ASCII_SPACE.split(t) if w]
                out[i] = np.frombuffer(b"".join([*map(self.__getitem__, words), last]), "<i4")
        put()
        return out


# Huffman codes

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge); 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    limit = max(max_bits, int(n - 1).bit_length())
    levels, row = [], weights
    leaf = np.ones(n, bool)
    for _ in range(limit - 1):
        levels.append(leaf)
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([weights, pairs])
        at = np.argsort(merged, kind="stable")
        row, leaf = merged[at], at < n
    levels.append(leaf)
    take = 2 * n - 2
    for leaf in reversed(levels):
        singles = int(leaf[:take].sum())
        lengths[order[:singles]] += 1
        take = 2 * (take - singles)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    code, last = 0, 0
    used = order[lengths[order] > 0]
    for n in np.unique(lengths[used]):
        at = used[lengths[used] == n]
        code <<= int(n) - last
        codes[at] = np.arange(code, code + len(at), dtype=np.uint64)
        code, last = code + len(at), int(n)
    return codes


def pack(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of a block and the bit offset of every CHECKPOINT_IDS-th id."""
    n = lengths[ids].astype(np.int64)
    at = np.concatenate([[0], np.cumsum(n)])
    start = at[:-1]
    shifted = codes[ids] << (64 - (start & 31) - n).astype(np.uint64)
    word = start >> 5
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(ids) else np.zeros(0, np.int64)
    out = np.zeros((int(at[-1]) + 31 >> 5) + 1, np.uint32)
    if len(ids):
        out[word[first]] = np.bitwise_or.reduceat((shifted >> np.uint64(32)).astype(np.uint32), first)
        out[word[first] + 1] |= np.bitwise_or.reduceat(shifted.astype(np.uint32), first)
    return out.astype(">u4").tobytes()[: int(at[-1]) + 7 >> 3], start[::CHECKPOINT_IDS]


class Decoder:
    """A table of 2 ** bits entries gives id and length for any window; checkpointed runs decode side by side."""

    def __init__(self, lengths: np.ndarray):
        self.bits = int(lengths.max(initial=1))
        codes = canonical_codes(lengths)
        used = np.flatnonzero(lengths)
        used = used[np.argsort(codes[used] << (self.bits - lengths[used]).astype(np.uint64))]
        spans = np.int64(1) << (self.bits - lengths[used]).astype(np.int64)
        size = 1 << self.bits
        self.id = np.zeros(size, np.int32)
        self.length = np.ones(size, np.int64)
        self.id[: spans.sum()] = np.repeat(used, spans)
        self.length[: spans.sum()] = np.repeat(lengths[used], spans)

    def unpack(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        b = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        windows = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
        out = np.zeros((CHECKPOINT_IDS, len(checkpoints)), np.int32)
        at, mask, last = checkpoints.astype(np.int64), np.uint32((1 << self.bits) - 1), len(windows) - 1
        for k in range(CHECKPOINT_IDS):
            byte = np.minimum(at >> 3, last)  # lanes past the end of the block read padding
            w = (windows[byte] >> (32 - self.bits - (at & 7)).astype(np.uint32)) & mask
            out[k] = self.id[w]
            at += self.length[w]
        return out.T.reshape(-1)[:n]


def _codebook(counts: dict[int, int]) -> np.ndarray:
    table = np.zeros(max(counts, default=0) + 1, np.int64)
    for i, n in counts.items():
        table[i] = n
    return code_lengths(table)


# Files

def common_words(docs: DataFrame, tokenizer: str) -> tuple[str, bytes, bytes]:
    """Common runs of Latin letters with their ids, for ``Encoder``, so that tasks need not encode them again each.

    They come from a sample of COMMON_DOCUMENTS rows, which only decides what is known early, not any result; at most
    COMMON_WORDS reach the driver.
    """
    share = min(1.0, COMMON_DOCUMENTS / max(1, docs.count()))
    runs = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u017f]{1,64}+(?![a-z\u00df-\u017f])"), F.lit(0)))
    found = docs.select("text").sample(share, seed=1).select(runs.alias("word")).groupBy("word").count()
    words = [r["word"] for r in found.filter("count > 1").orderBy(F.desc("count"), "word").limit(COMMON_WORDS).collect() if r["word"] == r["word"].lower()]
    with open(tokenizer, encoding="utf-8") as f:
        packed = Encoder(f.read())._packed(words)
    return " ".join(words), np.array([len(x) for x in packed], "<i4").tobytes(), b"".join(packed)


def encode_documents(docs: DataFrame, tokenizer: str, end: int = END_ID) -> DataFrame:
    """(part, start, doc_id, n, ids, used, counts) in ascending doc_id order, written; start counts the ids before it in its part.
    A row has n ids, little-endian, in two bytes each where that is enough for all of them, else in four.

    Rows are range-partitioned and sorted by doc_id, then a hash of the text (null as empty, null doc_ids first), and
    encoded in that order; rows that repeat a doc_id all stay.  The last row of a part has no ids, but which ids the part
    used and how often, so that counting does not read the ids again.
    """
    names = ["part", "start", "doc_id", "n", "ids", "used", "counts"]
    with open(tokenizer, encoding="utf-8") as f:
        given = docs.sparkSession.sparkContext.broadcast((f.read(), common_words(docs, tokenizer)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(*given.value)  # what it remembers goes with the task
        part, start, total = TaskContext.get().partitionId(), 0, np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                ids = own.ids([t or "" for t in piece.column("text").to_pylist()], end)
                n = np.array([len(x) for x in ids], np.int64)
                ends = np.concatenate([[0], np.cumsum(n)])
                flat = np.concatenate(ids)
                seen = np.bincount(flat, minlength=len(total))
                seen[: len(total)] += total
                total = seen
                none = [None] * len(ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(start + ends[:-1]),
                    piece.column("doc_id"),
                    pa.array(n),
                    pa.array([x.astype("<u2" if x.max(initial=0) < 1 << 16 else "<u4").tobytes() for x in ids], pa.binary()),
                    pa.array(none, pa.list_(pa.int32())),
                    pa.array(none, pa.list_(pa.int64())),
                ], names)
                start += int(ends[-1])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([start]), pa.array([None], pa.int64()), pa.array([None], pa.int64()), pa.array([None], pa.binary()),
            pa.array([used.astype(np.int32)], pa.list_(pa.int32())), pa.array([total[used]], pa.list_(pa.int64())),
        ], names)

    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return materialize(ordered.drop("tie").mapInArrow(frugal(encode), "part int, start bigint, doc_id bigint, n bigint, ids binary, used array<int>, counts array<bigint>"), "ids")


def id_counts(encoded: DataFrame) -> dict[int, int]:
    """Occurrences of every id, from the parts' own counts, added up in each task and then over tasks.  One row per id
    of the vocabulary reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            used, counts = (batch.column(c).flatten().to_numpy() for c in ("used", "counts"))
            size = max(len(total), int(used.max(initial=-1)) + 1)
            total = np.concatenate([total, np.zeros(size - len(total), np.int64)])
            np.add.at(total, used, counts)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    parts = encoded.filter("used is not null").select("used", "counts").mapInArrow(frugal(add), "id bigint, n bigint")
    return {r["id"]: r["n"] for r in parts.groupBy("id").agg(F.sum("n").alias("n")).collect()}


BLOCK_SCHEMA = "part int, start bigint, doc_ids array<bigint>, n_ids array<int>, checkpoints array<bigint>, payload binary"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int = END_ID) -> None:
    """Write a corpus below ``path``: ``codebook`` (id, bits), ``parts`` (part, first id) and ``blocks``.

    A block holds whole documents of about BLOCK_IDS ids (one longer document is a block), coded on its own with the
    global code, and the bit offset of every 64th id.  Parts follow the order of doc_id.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        encoded = encode_documents(docs, tokenizer, end)
        lengths = _codebook(id_counts(encoded))
    codes = canonical_codes(lengths)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, doc_ids, ids, size = None, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            payload, checkpoints = pack(np.concatenate(ids), lengths, codes)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([[len(x) for x in ids]], pa.list_(pa.int32())), pa.array([checkpoints], pa.list_(pa.int64())), pa.array([payload], pa.binary()),
            ], ["part", "start", "doc_ids", "n_ids", "checkpoints", "payload"])

        for batch in batches:
            for part_here, start_here, doc_id, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(raw, f"<u{len(raw) // n}")
                if ids and (part_here != part or size + len(own) > BLOCK_IDS or start_here != start + size):
                    yield flush()
                    doc_ids, ids, size = [], [], 0
                if not ids:
                    part, start = part_here, start_here
                doc_ids.append(doc_id)
                ids.append(own)
                size += len(own)
        if ids:
            yield flush()

    with small_batches(spark):
        encoded.filter("ids is not null").select("part", "start", "doc_id", "n", "ids").mapInArrow(frugal(block), BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    # One row per part and per id of the vocabulary.
    totals = encoded.filter("used is not null").select("part", F.col("start").alias("n")).orderBy("part").collect()
    firsts, at = [], 0
    for r in totals:
        firsts.append((r["part"], at))
        at += r["n"]
    spark.createDataFrame(firsts, "part int, first bigint").coalesce(1).write.parquet(f"{path}/parts")
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; ids are little-endian unsigned 32-bit integers."""
    book = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/codebook").collect()}
    first = {r["part"]: r["first"] for r in spark.read.parquet(f"{path}/parts").collect()}
    lengths = np.zeros(max(book, default=0) + 1, np.uint8)
    for i, bits in book.items():
        lengths[i] = bits

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Decoder(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                n = np.array(batch.column("n_ids")[row].as_py(), np.int64)
                checkpoints = batch.column("checkpoints")[row].values.to_numpy()
                ids = table.unpack(batch.column("payload")[row].as_py(), checkpoints, int(n.sum())).astype("<u4")
                ends = np.concatenate([[0], np.cumsum(n)])
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array(batch.column("doc_ids")[row].as_py(), pa.int64()),
                    pa.array(first[batch.column("part")[row].as_py()] + batch.column("start")[row].as_py() + ends[:-1]),
                    pa.array(n),
                    pa.array([raw[4 * a:4 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                ], ["doc_id", "start", "n_tokens", "ids"])

    return spark.read.parquet(f"{path}/blocks").mapInArrow(frugal(decode), "doc_id bigint, start bigint, n_tokens bigint, ids binary")
