"""WARC archives: writing records, and reading them back from any cut of the files by boundary chains."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import materialize

DATE = "2024-01-01T00:00:00Z"
LEAST_SHARED = 100
CHUNK = 4 << 20
# What a task reads of archives, about.
TASK_BYTES = 64 << 20

# What a record begins with, compressed as a gzip member of its own or plain.
GZIP_MAGIC = b"\x1f\x8b\x08"
PLAIN_MAGIC = b"WARC/1."


def page_records(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to per page.

    The payload is the html in UTF-8 (null: empty).  Of rows with equal payloads of at least ``least`` bytes those with
    the smallest page_id are responses, the others revisits of it; a null page_id is never referred to.  Only the
    digests that occur more than once are joined back; their table is written, so Spark knows its size.
    """
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).withColumn("payload_digest", F.sha2("payload", 256))
    groups = p.filter(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("head"), F.count("*").alias("n"))
    shared = materialize(groups.filter("n > 1 and head is not null").drop("n"), "shared")
    p = p.join(shared, "payload_digest", "left")
    again = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return p.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("head")).alias("refers_to"),
    )


def _record(page_id, url, payload: bytes, size: int, digest: str, kind: str, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_warc(records: DataFrame, path: str, compress: bool = True, date: str = DATE) -> None:
    """Write records as WARC files, one a task.  Bytes go through Spark's text writer and so through its commit.

    The writer ends every row with a separator.  A gzip member of under 16 MiB ends with a zero byte, which is left to
    it; a larger one is followed by a zero byte, padding that readers of gzip skip.  A plain record ends with \\n.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out = []
                for r in batch.slice(at, 64).to_pylist():
                    raw = _record(r["page_id"], r["url"], r["payload"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], date)
                    if compress:
                        z = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = z.compress(raw) + z.flush()
                        out.append(member[:-1] if member[-1] == 0 else member)
                    else:
                        out.append(raw[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    rows = records.mapInArrow(render, "value binary").select(F.col("value").cast("string").alias("value"))
    rows.write.option("lineSep", "\0" if compress else "\n").option("compression", "none").text(path)


def _open(path: str):
    if path.startswith("file:"):
        return open("/" + path[5:].lstrip("/"), "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return store.open_input_file(inner)


class _Archive:
    """A file of records, read at any offset."""

    def __init__(self, path: str):
        self.file = _open(path)
        self.gzip = self.at(0, 3) == GZIP_MAGIC
        self.magic = GZIP_MAGIC if self.gzip else PLAIN_MAGIC

    def at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def candidates(self, start: int, end: int) -> Iterator[int]:
        data = self.at(start, end - start + len(self.magic) - 1)
        at = data.find(self.magic)
        while at >= 0:
            yield start + at
            at = data.find(self.magic, at + 1)

    def record(self, offset: int, body: bool) -> tuple[bytes | None, int]:
        """A record's bytes (if asked for) and the offset after it; (None, -1) if there is no record at the offset."""
        return self._member(offset, body) if self.gzip else self._plain(offset, body)

    def _member(self, offset: int, body: bool) -> tuple[bytes | None, int]:
        z, kept, at, first = zlib.decompressobj(31), [], offset, True
        try:
            while not z.eof:
                data = self.at(at, 1 << 16)
                if not data:
                    return None, -1
                at += len(data)
                while data and not z.eof:
                    out = z.decompress(data, 1 << 20)
                    data = z.unconsumed_tail
                    if first and out:
                        first = False
                        if not out.startswith(PLAIN_MAGIC):
                            return None, -1
                    if body:
                        kept.append(out)
        except zlib.error:
            return None, -1
        end = at - len(z.unused_data)
        while (pad := self.at(end, 1)) == b"\0":
            end += len(pad)
        return b"".join(kept), end

    def _plain(self, offset: int, body: bool) -> tuple[bytes | None, int]:
        head = b""
        while b"\r\n\r\n" not in head and len(head) < 1 << 20:
            more = self.at(offset + len(head), 4096)
            if not more:
                return None, -1
            head += more
        cut = head.find(b"\r\n\r\n")
        length = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", head[:cut]) if cut >= 0 and head.startswith(PLAIN_MAGIC) else None
        if not length:
            return None, -1
        end = offset + cut + 4 + int(length[1]) + 4
        if self.at(end - 4, 4) != b"\r\n\r\n":
            return None, -1
        return (self.at(offset, end - offset) if body else b""), end


def _archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of every file that is not empty, without its content."""
    return spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")


def parts_for(spark: SparkSession, path: str, chunk: int) -> int:
    """Into how many tasks archives are read: about TASK_BYTES each, a chunk at least, and all cores where there are so many.

    Rows of ranges are tiny however much they stand for, so the number is set here and not left to their size."""
    told = _archives(spark, path).agg(F.sum("length").alias("bytes"), F.sum(F.ceil(F.col("length") / chunk)).alias("chunks")).first()
    chunks = int(told["chunks"] or 0)
    return max(1, min(chunks, max(spark.sparkContext.defaultParallelism, -(-int(told["bytes"] or 0) // TASK_BYTES))))


def _ranges(spark: SparkSession, path: str, chunk: int) -> DataFrame:
    """(path, length, start, end) of every chunk of every file.  Cut by bytes, so each scan sees the same chunks."""
    files = _archives(spark, path)
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(chunk).cast("bigint")))
    ranges = files.select("path", "length", starts.alias("start"))
    return ranges.withColumn("end", F.least("length", F.col("start") + chunk)).repartition(parts_for(spark, path, chunk), "path", "start")


def chunk_exits(ranges: DataFrame) -> DataFrame:
    """(path, length, offset, exit): for every candidate in a chunk, where its chain of records leaves the chunk.

    Candidates are places that look like the start of a record; some lie inside payloads.  A candidate that is no
    record, or whose chain breaks inside the chunk, has exit -1.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                archive = _Archive(r["path"])
                after = {at: archive.record(at, False)[1] for at in archive.candidates(r["start"], r["end"])}
                exits: dict[int, int] = {}
                for at in sorted(after, reverse=True):
                    to = after[at]
                    exits[at] = to if to >= r["end"] or to < 0 else exits.get(to, -1)
                n = len(exits)
                yield pa.RecordBatch.from_arrays([pa.array([r["path"]] * n, pa.string()), pa.array([r["length"]] * n, pa.int64()), pa.array(list(exits), pa.int64()), pa.array(list(exits.values()), pa.int64())], ["path", "length", "offset", "exit"])

    return ranges.mapInArrow(follow, "path string, length bigint, offset bigint, exit bigint")


def verified_entries(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """(path, offset, end): the first record of every chunk in which one starts, reached from the start of its file.

    Only candidates that some chain leads to count as entries, about one a chunk.  Pointer jumping doubles the
    chunks each entry looks ahead, so all entries reached from offset 0 are marked after log2(chunks) rounds.
    Raises if the chain of a file does not lead to its end.
    """
    ranges = _ranges(spark, path, chunk)
    exits = materialize(chunk_exits(ranges).filter("exit >= 0"), "exits")
    targets = exits.select("path", F.col("exit").alias("offset")).distinct()
    entries = exits.join(targets, ["path", "offset"], "left_semi").unionByName(exits.filter("offset = 0")).distinct()
    jumps = materialize(entries.select("path", "offset", F.col("exit").alias("to")), "jumps")
    reached = materialize(jumps.filter("offset = 0").select("path", "offset"), "reached")
    known = reached.count()
    while True:
        reached = reached.unionByName(reached.join(jumps, ["path", "offset"]).select("path", F.col("to").alias("offset"))).distinct()
        reached = materialize(reached, "reached")
        now = reached.count()
        if now == known:
            break
        known = now
        further = jumps.select("path", F.col("offset").alias("to"), F.col("to").alias("beyond"))
        jumps = materialize(jumps.join(further, ["path", "to"], "left").select("path", "offset", F.coalesce("beyond", "to").alias("to")), "jumps")
    lengths = ranges.select("path", "length").distinct()
    ends = reached.select("path", F.col("offset").alias("length"))
    broken = lengths.join(ends, ["path", "length"], "left_anti")
    if (bad := broken.first()) is not None:
        raise ValueError(f"{bad['path']}: its records do not lead to its end")
    alive = lengths.join(reached, "path").filter("offset < length")
    return alive.select("path", "offset", F.least("length", (F.floor(F.col("offset") / chunk) + 1) * chunk).alias("end"))


RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def read_warc(spark: SparkSession, path: str, chunk: int = CHUNK, with_payload: bool = True) -> DataFrame:
    """The response and revisit records of the archives below a path.

    Each verified entry is read on to the end of its chunk.  A response's size and digest come from its payload, and its
    digest must be the one in its header; a revisit has those of its header.  An empty folder gives no rows.
    """

    def number(value: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
        return int(found[1]) if found else None

    def parse(raw: bytes) -> dict | None:
        head, _, block = raw.partition(b"\r\n\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}
        kind = fields.get("warc-type")
        if kind not in ("response", "revisit"):
            return None
        block = block[: int(fields["content-length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        said = fields.get("warc-payload-digest", "").removeprefix("sha256:")
        if kind == "response":
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            if said and said != digest:
                raise ValueError(f"{fields.get('warc-record-id')}: payload and digest differ")
        else:
            size, digest = int(re.search(rb"(?i)content-length:\s*(\d+)", http)[1]), said
        return {
            "page_id": number(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind, "refers_to": number(fields.get("warc-refers-to")),
            "payload_bytes": size, "payload_digest": digest, "payload": payload if with_payload and kind == "response" else None,
        }

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for r in batch.to_pylist():
                archive, at, rows = _Archive(r["path"]), r["offset"], []
                while at < r["end"]:
                    raw, at = archive.record(at, True)
                    if (row := parse(raw)) is not None:
                        rows.append(row)
                    if len(rows) == 64:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    entries = verified_entries(spark, path, chunk)
    return entries.repartition(parts_for(spark, path, chunk), "path", "offset").mapInArrow(walk, RECORD)
