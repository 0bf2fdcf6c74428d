"""Byte-level BPE: texts to ids and back, each word merged in one contiguous array of ranks."""

from __future__ import annotations

import functools
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import frugal, quoted

# Fixed value: how byte-level BPE cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# The same for ASCII texts, which the standard module cuts in half the time.
_ASCII_WORDS = re.compile(
    WORDS.replace(r"\s\p{L}\p{N}", r" \t-\rA-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]").replace(r"\S", r"[^ \t-\r]").replace(r"\s", r"[ \t-\r]")
)

# Words above this many bytes are merged over a heap, with the same result.
SHORT = 256
# What a task remembers of words, about; then it starts afresh.
CACHE_BYTES = 96 << 20
# Longer texts are cut between words, so that their list of words stays small.
PIECE = 1 << 20

_NONE = 1 << 40
_CUT = regex.compile(r"(?<=\p{L}) (?=\p{L})")


class Bpe:
    """Tables of a tokenizer definition (JSON) with a byte-level pre-tokenizer and decoder."""

    def __init__(self, definition: str):
        d = json.loads(definition)
        model, parts = d["model"], (d["pre_tokenizer"] or {}, d["decoder"] or {})
        plain = all(p.get("type") == "ByteLevel" for p in parts) and parts[0].get("use_regex", True) and not parts[0].get("add_prefix_space")
        if model["type"] != "BPE" or not plain or d.get("normalizer") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("not a byte-level BPE definition that cuts words by the usual pattern")
        byte_of = self._alphabet()
        vocab = model["vocab"]
        self.width = max(vocab.values()) + 1
        self.rank: dict[int, int] = {}  # pair of ids to the rank of its merge
        self.merged: list[int] = []  # rank to id
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank.setdefault(vocab[left] * self.width + vocab[right], len(self.merged))
            self.merged.append(vocab[left + right])
        self.first = [vocab.get(c, -1) for c in sorted(byte_of, key=byte_of.get)]  # byte to id
        self.special = {t["content"]: t["id"] for t in d.get("added_tokens", [])}
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in d.get("added_tokens", [])):
            raise ValueError("added tokens that take white space are not supported")
        self.bytes = [b""] * (max(self.width - 1, *self.special.values(), 0) + 1)  # id to bytes
        for token, i in [*vocab.items(), *self.special.items()]:
            mapped = [byte_of.get(c) for c in token]
            self.bytes[i] = token.encode() if None in mapped else bytes(mapped)
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.words = regex.compile(WORDS)

    @staticmethod
    def _alphabet() -> dict[str, int]:
        """Characters that stand for bytes: visible Latin-1 ones for themselves, then those from 256 on for the rest."""
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        hidden = [b for b in range(256) if b not in set(shown)]
        return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def word(self, word: str) -> list[int]:
        """Ids of one word: the pair of lowest rank is merged, leftmost first, until no adjacent pair has a rank."""
        ids = [self.first[b] for b in word.encode()]
        if -1 in ids:  # bytes that the vocabulary lacks have no id
            ids = [i for i in ids if i >= 0]
        if len(ids) > SHORT:
            return self._long(ids)
        rank, width, merged = self.rank.get, self.width, self.merged
        ranks = [rank(a * width + b, _NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == _NONE:
                break
            at = ranks.index(low)
            ids[at] = own = merged[low]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank(ids[at - 1] * width + own, _NONE)
            if at < len(ranks):
                ranks[at] = rank(own * width + ids[at + 1], _NONE)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """The same merges for a long word: a heap of (rank, place) over linked parts."""
        rank, width, n = self.rank.get, self.width, len(ids)
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i) for i in range(n - 1) if (r := rank(ids[i] * width + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if not live[i] or j >= n or rank(ids[i] * width + ids[j]) != r:
                continue
            ids[i], live[j], after[i] = self.merged[r], False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (new := rank(ids[a] * width + ids[after[a]])) is not None:
                    heapq.heappush(heap, (new, a))
        return [x for x, keep in zip(ids, live) if keep]

    def text(self, ids: list[int]) -> str:
        """Bytes of the ids in turn, as UTF-8; broken sequences become U+FFFD, unknown ids nothing."""
        known = len(self.bytes)
        return b"".join([self.bytes[i] for i in ids if 0 <= i < known]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def tables(definition: str) -> Bpe:
    """The tables of the last definition, about 15 MB for 50,000 merges, kept by a worker for its next task."""
    return Bpe(definition)


class Encoder(dict):
    """Words to their ids as packed bytes, for one task; holds at most about CACHE_BYTES."""

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe, self.held = bpe, 0

    def __missing__(self, word: str) -> bytes:
        packed = array("i", self.bpe.word(word)).tobytes()
        size = 180 + 2 * len(word) + len(packed)
        if size < CACHE_BYTES >> 6:
            if self.held + size > CACHE_BYTES:
                self.clear()
                self.held = 0
            self[word] = packed
            self.held += size
        return packed

    def ids(self, text: str) -> bytes:
        parts = self.bpe.specials.split(text) if self.bpe.specials else [text]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(array("i", [self.bpe.special[part]]).tobytes())
                continue
            for piece in pieces(part):
                words = _ASCII_WORDS if piece.isascii() else self.bpe.words
                out.append(b"".join(map(self.__getitem__, words.findall(piece))))
        return b"".join(out)


def pieces(text: str) -> Iterator[str]:
    """A long text in parts that start with the space before a letter: no word of the pattern crosses such a place."""
    at = 0
    while len(text) - at > PIECE and (cut := _CUT.search(text, at + PIECE)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def _definition(df: DataFrame, tokenizer: str):
    with open(tokenizer, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, of fixed size


def _replaced(df: DataFrame, column: str, new: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    """The frame with ``column`` as its last one, under plain names (mapInArrow takes no others), and its schema with ``new`` in that one's place."""
    others = [f for f in df.schema.fields if f.name.lower() not in (column.lower(), new.lower())]
    plain = [F.col(quoted(name)).alias(f"c{i}") for i, name in enumerate([*(f.name for f in others), column])]
    return df.select(*plain), T.StructType([*others, T.StructField(new, kind)])


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Documents with their text replaced by the array of its ids, equal to those of the tokenizers library without
    special tokens added; strings of added tokens inside a text are those tokens, as there.

    Null and empty texts have no ids.  Texts are encoded whole whatever their length; repeated rows all stay; a column
    already called ``ids`` is replaced, all others stay as they are.  ``tokenizer`` is the path of a definition that
    the driver reads.  Rows stay in their partitions, no shuffle.
    """
    spread, schema = _replaced(docs, text, ids, T.ArrayType(T.IntegerType()))
    definition = _definition(docs, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Encoder(tables(definition.value))
        for batch in batches:
            packed = [own.ids(t) if t else b"" for t in batch.column(batch.num_columns - 1).to_pylist()]
            ends = np.cumsum([0, *map(len, packed)]) // 4
            flat = pa.array(np.frombuffer(b"".join(packed), np.int32))
            arrays = [*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return spread.mapInArrow(frugal(run), schema)


def decode(docs: DataFrame, tokenizer: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The reverse: rows with their ids replaced by the text that they stand for, added tokens written out.

    Null or empty ids give an empty text, null elements and ids outside the vocabulary give nothing, bytes that are
    not UTF-8 give U+FFFD; a column already called ``text`` is replaced, all others stay as they are.
    """
    spread, schema = _replaced(docs, ids, text, T.StringType())
    definition = _definition(docs, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tables(definition.value)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            texts = [own.text([i for i in row if i is not None]) if row else "" for row in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], schema.names)

    return spread.mapInArrow(frugal(run), schema)
