"""Operator 5: files, manifest and records read back."""

import base64
import gzip
import hashlib
from pathlib import Path

import duckdb
from pyspark.sql import functions as F

from errlens.llm import warc
from errlens.llm.queries import ORACLE, QUERIES
from errlens.session import scratch_path
from tests.llm.conftest import prose

ROWS = [(1, "http://a/1", "same"), (2, None, "same"), (3, "http://a/3\r\nX: y", "other"), (4, "u", None), (5, "u", ""),
        (None, "u", "same"), (6, "u", "é" * 3000), (7, "u", prose(1, 4000)), (7, "v", prose(1, 4000)), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n")]
SCHEMA = "page_id long, url string, html string, id string, digest string, payload int, Shard int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], SCHEMA)


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def write(spark, rows, **kw):
    folder = scratch_path(spark, "warc-test")
    return folder, warc.write_archives(pages(spark, rows), folder, **kw)


def test_round_trip_with_revisits(spark):
    _, manifest = write(spark, ROWS, shard_bytes=4000, file_bytes=900)
    assert manifest.count() > 3
    got = warc.read_archives(manifest).collect()
    assert len(got) == len(ROWS)
    last = {}
    for i, _, t in ROWS:
        last[t or ""] = max(last.get(t or "", -1), -1 if i is None else i)
    seen = sorted((repr(r["id"]), r["payload_digest"], r["payload_bytes"]) for r in got)
    assert seen == sorted((repr(i), digest(t), len((t or "").encode())) for i, _, t in ROWS)
    for t, top in last.items():
        own = [r for r in got if r["payload_digest"] == digest(t)]
        assert [r["id"] for r in own if r["record_type"] == "response"] == [top]
        assert all(r["refers_to"] == top for r in own if r["record_type"] == "revisit")
        assert [bytes(r["payload"]).decode() for r in own if r["record_type"] == "response"] == [t]


def test_small_payloads_are_all_responses(spark):
    _, manifest = write(spark, ROWS, min_revisit=100)
    kinds = {(r["payload_bytes"], r["record_type"]) for r in warc.read_archives(manifest).collect()}
    assert all(k == "response" for n, k in kinds if n < 100) and any(k == "revisit" for _, k in kinds)


def test_files_do_not_depend_on_partitions(spark):
    rows = [(k, f"http://h/{k}", prose(k % 17, 200)) for k in range(200)]
    sums = []
    for n in (1, 7):
        folder = scratch_path(spark, "warc-test")
        m = warc.write_archives(pages(spark, rows).repartition(n), folder, shard_bytes=30_000, file_bytes=4000)
        sums.append(sorted((r["name"], r["records"], r["bytes"], r["sha1"]) for r in m.collect()))
        root = Path(folder.removeprefix("file://"))
        assert {p.name for p in root.iterdir()} == {r[0] for r in sums[-1]}       # nothing temporary stays
        for name, _, size, sha in sums[-1]:
            data = (root / name).read_bytes()
            assert len(data) == size and hashlib.sha1(data).hexdigest() == sha and size <= 4000
            assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
    assert sums[0] == sums[1] and len({n[:12] for n, *_ in sums[0]}) > 3


def test_records_are_sorted_by_id(spark):
    rows = [(k * 37 % 101, "u", f"text {k}") for k in range(101)]
    _, manifest = write(spark, rows, shard_bytes=10_000)
    order = []
    for r in sorted(manifest.collect(), key=lambda r: r["name"]):
        raw = gzip.decompress(Path(r["path"].removeprefix("file://")).read_bytes()).decode()
        order += [int(x.split("\r\n")[0]) for x in raw.split("X-Page-ID: ")[1:]]
    assert order == sorted(order) and len(order) == 101


def test_null_and_hot_ids_span_shards(spark):
    """A third of the rows without id, a third of one id: no shard is much larger than another, and order holds."""
    rows = [(None if k % 3 == 0 else 1000 if k % 3 == 1 else k, "u", f"{k} " + prose(k, 400)) for k in range(900)]
    _, manifest = write(spark, rows, shard_bytes=60_000)
    files = sorted(manifest.collect(), key=lambda r: r["name"])
    records = sorted(r["records"] for r in files)
    assert len(files) > 9 and records[-1] < 2 * records[len(records) // 2] and sum(records) == 900
    order = []
    for r in files:
        raw = gzip.decompress(Path(r["path"].removeprefix("file://")).read_bytes()).decode()
        order += [int(x.split("X-Page-ID: ")[1].split("\r\n")[0]) if "X-Page-ID: " in x else -1 for x in raw.split("WARC-Record-ID: ")[1:]]
    assert order == sorted(order) and order.count(-1) == order.count(1000) == 300
    got = warc.read_archives(manifest).collect()
    assert sorted(bytes(r["payload"]).decode() for r in got) == sorted(t for *_, t in rows)


def test_large_inputs_have_large_shards(spark):
    sized = spark.range(300).select("id", F.lit("0" * 15).alias("digest"), F.lit(1 << 32).alias("bytes"))
    assert len(warc.shard_cuts(sized, warc.SHARD_BYTES)) == 299       # of 1.2 TB a shard has 300 MB, and a record is never cut
    sized = spark.range(40960).select("id", F.lit("0" * 15).alias("digest"), F.lit(1 << 27).alias("bytes"))
    assert len(warc.shard_cuts(sized, warc.SHARD_BYTES)) == 5119      # of 5 TB a shard has 1 GiB


def test_damaged_record_is_refused():
    m = gzip.decompress(warc.record(1, "u", b"payload", digest("payload"), None, False))
    assert warc.parse(m)["payload"] == b"payload"
    try:
        warc.parse(m.replace(b"payload\r\n", b"pAyload\r\n"))
    except ValueError:
        return
    raise AssertionError("a wrong digest went through")


def test_empty_table(spark):
    _, manifest = write(spark, [])
    assert manifest.count() == 0 and warc.read_archives(manifest).count() == 0


def test_query_matches_sql(spark, sf_small):
    df = QUERIES["op5_warc"](spark, sf_small)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_small}/pages.parquet')")
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE['op5_warc']})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, want))
