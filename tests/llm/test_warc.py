import gzip
import hashlib
import random

import pytest

from pyspark.sql import functions as F

from tallyloom.llm import warc
from tallyloom.session import new_path

RNG = random.Random(2)
NOISE = bytes(RNG.randrange(256) for _ in range(3000)).decode("latin-1")
INNER = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [
    (1, "http://a/1", "x" * 100), (2, "http://a/2", "x" * 100), (3, None, "x" * 99), (4, "http://a/4", "x" * 99), (5, "u\r\nv", None), (6, "", ""),
    (7, "http://a/7", INNER * 40), (8, "http://a/8", NOISE), (9, "http://a/9", "é" * 200_000), (10, "http://a/2", "x" * 100), (None, "http://a/0", "x" * 100),
    (11, "http://b", gzip.compress(INNER.encode()).decode("latin-1") * 30), (12, "http://c", NOISE), (12, "http://c", NOISE),
]


def expected(pages):
    heads = {}
    for page_id, _, html in pages:
        payload = (html or "").encode()
        if page_id is not None and len(payload) >= 100:
            heads[payload] = min(page_id, heads.get(payload, page_id))
    out = []
    for page_id, _, html in pages:
        payload = (html or "").encode()
        head = heads.get(payload)
        revisit = head is not None and page_id != head
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("chunk", [500, 1 << 22])
def test_round_trip_from_any_cut(spark, compress, chunk):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id bigint, url string, html string, payload string").repartition(3)
    path = new_path(spark, "warc")
    warc.write_warc(warc.page_records(pages), path, compress)
    rows = warc.read_warc(spark, path, chunk).collect()
    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in rows), key=str) == expected(PAGES)
    assert {r["page_id"]: r["payload"].decode() for r in rows if r["page_id"] in (8, 9)} == {8: NOISE, 9: "é" * 200_000}


def test_records_in_payloads_are_candidates_but_never_records(spark):
    pages = spark.createDataFrame([(1, "u", INNER * 40), (2, "v", "tail")], "page_id bigint, url string, html string").coalesce(1)
    path = new_path(spark, "warc")
    warc.write_warc(warc.page_records(pages), path, False)
    assert warc.chunk_exits(warc._ranges(spark, path, 700)).count() > 30
    assert sorted(r["page_id"] for r in warc.read_warc(spark, path, 700).collect()) == [1, 2]


def test_files_are_plain_gzip_members(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 50) for i in range(20)], "page_id bigint, url string, html string").coalesce(1)
    path = str(tmp_path / "out")
    warc.write_warc(warc.page_records(pages), path)
    [file] = [f for f in (tmp_path / "out").iterdir() if f.name.startswith("part-")]
    raw = gzip.decompress(file.read_bytes())
    assert raw.count(b"WARC/1.1\r\n") == 20 and raw.endswith(b"\r\n\r\n")


def test_a_cut_off_file_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50) for i in range(20)], "page_id bigint, url string, html string").coalesce(1)
    warc.write_warc(warc.page_records(pages), str(tmp_path / "out"))
    [file] = [f for f in (tmp_path / "out").iterdir() if f.name.startswith("part-")]
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.warc.gz").write_bytes(file.read_bytes()[:-30])
    with pytest.raises(ValueError, match="lead to its end"):
        warc.read_warc(spark, str(tmp_path / "cut"), 300)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    path = new_path(spark, "warc")
    warc.write_warc(warc.page_records(pages), path)
    assert warc.read_warc(spark, path).collect() == []


def test_ranges_are_read_in_several_tasks(spark, tmp_path):
    """Rows of ranges are tiny; their number of tasks follows the bytes they stand for."""
    (tmp_path / "a.warc").write_bytes(b"x" * 20_000)
    (tmp_path / "b.warc").write_bytes(b"y" * 500)
    parts = warc.parts_for(spark, str(tmp_path), 1000)
    assert parts == min(21, spark.sparkContext.defaultParallelism)
    ranges = warc._ranges(spark, str(tmp_path), 1000)
    used = ranges.select(F.spark_partition_id().alias("p")).distinct().count()
    assert ranges.count() == 21 and used > parts // 2
    assert warc.parts_for(spark, str(tmp_path), 1 << 30) == 2
