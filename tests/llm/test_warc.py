"""Operator 10: exact round trips, predicates and skipping."""

import gzip
import hashlib
import io
import random
from collections import Counter

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

from lakestar.llm import warc
from lakestar.session import work_dir

ROWS = [
    (1, "http://a.org/1", "x" * 1500),
    (2, "http://a.org/2", "x" * 1500),
    (9, None, "x" * 1500),
    (3, "http://b.org/\r\nX: y", "short"),
    (4, "http://b.org/é", "short"),
    (5, "u", None),
    (6, "u", ""),
    (7, "u", "é" * 499),
    (8, "u", "é" * 500),
    (10, "u", "é" * 500),
    (11, "u", "WARC/1.1\r\n\r\nfake\r\n\r\n" * 200),
    (12, "long", "payload " * 400_000),
    (9, None, "x" * 1500),
    (None, "no id", "x" * 1500),
    (None, "no id", "alone" * 500),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "a", "b") for r in ROWS], "page_id long, url string, html string, payload string, record_type string")


def expected(rows, least=1000):
    groups = {}
    for k, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= least and k is not None:
            groups[raw] = max(k, groups.get(raw, k))
    out = Counter()
    for k, _, html in rows:
        raw = (html or "").encode()
        first = groups.get(raw)
        revisit = first is not None and first != k
        out[(k, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None)] += 1
    return out


def test_round_trip(pages, spark, sf_small, monkeypatch):
    assert Counter(map(tuple, warc.round_trip(pages).collect())) == expected(ROWS)
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert Counter(map(tuple, warc.round_trip(pages).collect())) == expected(ROWS)
    table = spark.read.parquet(f"{sf_small}/pages.parquet")
    assert Counter(map(tuple, warc.round_trip(table).collect())) == expected([(r["page_id"], r["url"], r["html"]) for r in table.collect()])
    assert warc.round_trip(pages.where("false")).count() == 0


@pytest.fixture(scope="module")
def archive(spark, pages):
    warc.register(spark)
    folder = f"{work_dir(spark)}/test-warc"
    warc.records(pages).repartition(3).write.format("warc").mode("append").save(folder)
    return folder


def test_archive_holds_payloads_and_headers(spark, archive):
    rows = {r["record_id"]: r for r in spark.read.format("warc").load(archive).collect()}
    assert rows["12"]["payload"] == b"payload " * 400_000 and rows["12"]["payload_bytes"] == 3_200_000
    assert rows["3"]["target_uri"] == "http://b.org/%0D%0AX: y" and rows["4"]["target_uri"] == "http://b.org/é"
    assert rows["1"]["record_type"] == "revisit" and rows["1"]["refers_to"] == "9" and rows["1"]["payload"] == b""
    assert rows["9"]["target_uri"] is None and None in rows


def test_standard_readers_can_read_it(archive, spark):
    fs, folder = warc.file_system(archive)
    total = 0
    for f in fs.get_file_info(warc.pafs.FileSelector(folder)):
        if f.path.endswith(".warc.gz"):
            with fs.open_input_file(f.path) as source:
                total += gzip.decompress(source.read()).count(b"WARC/1.1\r\nWARC-Type: re")
    assert total == len(ROWS)


def test_predicates_are_pushed_down(spark, archive):
    load = lambda: spark.read.format("warc").load(archive)
    assert {r["record_id"] for r in load().where("record_type = 'revisit'").select("record_id").collect()} == {"1", "2", "8", None}
    assert load().where("record_id in ('3', '4', 'none')").count() == 2
    assert load().where("target_uri like 'http://a.org/%' and payload_bytes = 1500").count() == 2
    assert load().where("payload_bytes > 2000 or record_type = 'x'").count() == 3
    plan = load().where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan.replace("isnotnull", "")  # nothing is left for Spark to filter
    narrow = spark.read.format("warc").schema("record_id string, record_type string").load(archive)
    assert narrow.count() == len(ROWS) and narrow.columns == ["record_id", "record_type"]


def test_unwanted_payloads_are_not_decoded(archive):
    reader = warc.WarcReader(archive, ["record_id"])
    rest = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("record_id",), ("3", "5")), StringStartsWith(("target_uri",), "u"), GreaterThan(("payload_bytes",), 1)]))
    assert len(rest) == 1
    assert [r for p in reader.partitions() for b in reader.read(p) for r in b.column("record_id").to_pylist()] == ["5"]
    rnd = random.Random(1)
    raw = b"".join(warc.member(warc.record({"record_id": str(i), "record_type": "response", "target_uri": "u", "refers_to": None, "date": None, "payload_bytes": None, "payload_digest": None, "payload": rnd.randbytes(300_000)})) for i in range(20))
    stream = warc.Stream(io.BytesIO(raw), len(raw))
    assert [warc.columns_of(e.headers)["record_id"] for e in stream] == [str(i) for i in range(20)]
    assert stream.inflated < 20 * 70_000 < 20 * 300_000
    assert [e.payload_bytes() for e in warc.Stream(io.BytesIO(raw), len(raw))] == [300_000] * 20


def test_other_writers_files(spark, tmp_path):
    """Members without skip-lengths, and uncompressed records."""
    rows = [{"record_id": str(i), "record_type": "response", "target_uri": None, "refers_to": None, "date": None, "payload_bytes": None, "payload_digest": None, "payload": b"p" * (i * 40_000)} for i in range(6)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(warc.record(r)) for r in rows))
    (tmp_path / "b.warc").write_bytes(b"".join(warc.record(r) for r in rows))
    warc.register(spark)
    got = Counter((r["record_id"], len(r["payload"])) for r in spark.read.format("warc").load(str(tmp_path)).collect())
    assert got == Counter({(str(i), i * 40_000): 2 for i in range(6)})
    assert spark.read.format("warc").load(str(tmp_path)).where("record_id = '3'").count() == 2


def test_files_outside_a_manifest_are_not_read(archive, spark):
    fs, folder = warc.file_system(archive)
    with fs.open_output_stream(f"{folder}/stray.warc", compression=None) as out:
        out.write(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    assert spark.read.format("warc").load(archive).count() == len(ROWS)
