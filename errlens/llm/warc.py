"""Deterministic sharded WARC writer and reader (operator 5).

Method

* Payload digests group equal payloads.  Of a group the record with the
  largest id is the response, the others revisit it.
* Records are sorted by id (null first) and digest.  Shards are ranges of
  (id, digest) of about equal bytes, cut by a prefix sum of record sizes over
  all rows, so the cuts depend on the rows only, not on sampling or
  partitions, and a null or repeated id spans as many shards as its bytes
  need.
* Each shard is a task of its own, which writes it record by record (one gzip member each, headers
  and digests made anew) and rolls to the next file of the shard when the
  compressed size would pass the limit.
* Files get temporary names that no other attempt uses.  The manifest rows
  of successful attempts name the files that count; a second job moves
  those to their final names (it may run again: a file already moved is
  left), and the written final manifest is the commit.  Readers take only
  files of the manifest.

Files go to the shared folder through pyarrow's file systems, by URI.

Cases: a null payload is empty; a null URL has no target line; a null id
sorts first; records with the same id and payload are one response and
revisits of that id, side by side in one shard, so that rows which repeat
both make a shard larger than others; a payload of any size is one record of
its own; an empty table gives an empty manifest and no file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from errlens.llm.common import group_stats, out_batch, pick, salt, stored

SHARD_BYTES = 16 << 20      # records of a shard before compression, at least
LARGE_SHARD = 1 << 30       # and at most (if not less than the former); between them, a 4096th of all bytes
SHARES = 4096
FILE_BYTES = 1 << 30        # compressed size at which a shard rolls to its next file
READ_BYTES = 8 << 20        # compressed bytes of a reading task, where files are smaller
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_RECORD = 600               # bytes of headers, about


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page}/{digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool,
           level: int = 6) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_record_id(page, digest + ('/r' if revisit else ''))}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page is not None:
        head.append(f"X-Page-ID: {page}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_record_id(refers_to, digest)}")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    head += [f"WARC-Payload-Digest: sha1:{digest}",
             "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
             f"X-Payload-Length: {len(payload)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


# ---------------------------------------------------------------- shards

def _place(page: int | None, digest: str) -> tuple[int, int]:
    """Where a record sorts: null ids first, then the first 60 bits of the digest."""
    return -(1 << 63) - 1 if page is None else page, int(digest[:15], 16)


def shard_cuts(sized: DataFrame, shard_bytes: int) -> list[tuple[int, int]]:
    """Smallest place of each shard after the first, from a prefix sum of ``bytes`` in order of ``id`` and ``digest``."""
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    per_shard = min(max(shard_bytes, total // SHARES), max(shard_bytes, LARGE_SHARD))
    # equal ids with equal digests are summed first, so that they lie in one shard
    key = ["id", "digest"]
    summed = sized.groupBy(*key).agg(F.sum("bytes").alias("bytes"))
    ordered = stored(summed.repartitionByRange(*key).withColumn("part", F.spark_partition_id()), "warc-sizes")
    parts = ordered.groupBy("part").agg(F.sum("bytes").alias("own"))
    before = parts.select("part", (F.sum("own").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("own")).alias("base"))
    running = F.sum("bytes").over(Window.partitionBy("part").orderBy(*key).rowsBetween(Window.unboundedPreceding, 0))
    at = (ordered.withColumn("upto", running).join(before, "part")
          .select(F.struct(F.col("id").isNotNull().alias("known"), *key).alias("key"),
                  F.floor((F.col("base") + F.col("upto") - F.col("bytes")) / per_shard).alias("shard")))
    first = at.groupBy("shard").agg(F.min("key").alias("key")).select("key.id", "key.digest").collect()
    return sorted(_place(*r) for r in first)[1:]


# ---------------------------------------------------------------- writing

class _Files:
    """The files that one task writes, one open at a time."""

    def __init__(self, folder: str, limit: int):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.attempt, self.limit = uuid.uuid4().hex, limit
        self.fs.create_dir(f"{self.root}/_temporary/{self.attempt}")
        self.done: list[dict] = []
        self.out, self.shard = None, None

    def add(self, shard: int, member: bytes) -> None:
        if self.out and (shard != self.shard or self.row["bytes"] + len(member) > self.limit):
            self.close()
        if not self.out:
            self.roll = self.roll + 1 if shard == self.shard else 0
            self.shard = shard
            name = f"shard-{shard:06d}-{self.roll:04d}.warc.gz"
            temp = f"_temporary/{self.attempt}/{name}"
            self.row = {"shard": shard, "name": name, "temp": temp, "records": 0, "bytes": 0}
            self.sha = hashlib.sha1()
            self.out = self.fs.open_output_stream(f"{self.root}/{temp}", compression=None)
        self.out.write(member)
        self.sha.update(member)
        self.row["records"] += 1
        self.row["bytes"] += len(member)

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.done.append(self.row | {"sha1": self.sha.hexdigest()})
            self.out = None

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.done:
            yield pa.RecordBatch.from_pylist(self.done, schema=pa.schema(
                [("shard", pa.int32()), ("name", pa.string()), ("temp", pa.string()), ("records", pa.int64()),
                 ("bytes", pa.int64()), ("sha1", pa.string())]))
            self.done = []


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_revisit: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all rows below ``folder``; the committed manifest (``name``, ``path``, ``shard``, ``records``, ``bytes``, ``sha1``).

    ``id`` is an integer; payloads of ``min_revisit`` bytes or more take
    part in revisits.
    """
    rows = pick(pages, id=id_col, url=url_col, html=payload_col).select(
        F.col("id").cast("long").alias("id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    narrow = stored(rows.select("id", "digest", F.octet_length("payload").cast("long").alias("n"),
                                salt(F.monotonically_increasing_id()).alias("salt")), "warc-digests")
    cuts = shard_cuts(narrow.select("id", F.substring("digest", 1, 15).alias("digest"), (F.col("n") + _RECORD).alias("bytes")), shard_bytes)
    shared = group_stats(narrow.filter(F.col("n") >= min_revisit), ["digest"], "id").filter("group_size > 1")
    notes = narrow.join(shared, ["digest", "salt"]).select("id", "digest", F.col("highest").alias("response"))
    both = (rows.select("id", "digest", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("response"))
            .unionByName(notes.select("id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                                      F.lit(None).cast("binary").alias("payload"), "response")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [bisect_right(cuts, _place(*k)) for k in zip(b.column("id").to_pylist(), b.column("digest").to_pylist())]
            yield out_batch(**{n: b.column(n) for n in b.schema.names}, shard=pa.array(at, pa.int32()))

    fields = "id long, digest string, kind int, url string, payload binary, response long"
    # shard s is task s, so no two shards meet in a task
    dealt = (both.mapInArrow(place, fields + ", shard int").repartitionById(len(cuts) + 1, F.col("shard"))
             .sortWithinPartitions("shard", "id", "digest", "kind", "url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = None
        note, seen = None, None
        for b in batches:
            files = files or _Files(folder, file_bytes)
            columns = [b.column(n).to_pylist() for n in ("shard", "id", "digest", "kind", "url", "payload", "response")]
            for shard, page, digest, kind, url, payload, response in zip(*columns):
                key = (page, digest)
                if kind == 0:
                    note = (key, response)
                    continue
                shared_ = note is not None and note[0] == key
                revisit = shared_ and (note[1] != page or seen == key)
                seen = key
                files.add(shard, record(page, url, payload, base32(digest), note[1] if revisit else None, revisit))
            yield from files.rows()
        if files:
            files.close()
            yield from files.rows()

    schema = "shard int, name string, temp string, records long, bytes long, sha1 string"
    written = stored(dealt.mapInArrow(write, schema), "warc-written")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for temp, name in zip(b.column("temp").to_pylist(), b.column("name").to_pylist()):
                if store.get_file_info(f"{root}/{temp}").type != pafs.FileType.NotFound:
                    store.move(f"{root}/{temp}", f"{root}/{name}")
                elif store.get_file_info(f"{root}/{name}").type == pafs.FileType.NotFound:
                    raise FileNotFoundError(f"{name}: neither its temporary nor its final file is there")
            yield b

    moved = written.repartition("name").mapInArrow(move, schema)
    manifest = stored(moved.select("name", F.concat(F.lit(folder.rstrip("/") + "/"), "name").alias("path"),
                                   "shard", "records", "bytes", "sha1"), "warc-manifest")
    store, root = pafs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{root}/_temporary").type != pafs.FileType.NotFound:
        store.delete_dir(f"{root}/_temporary")
    return manifest


# ---------------------------------------------------------------- reading

def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one after the other."""
    data = stream.read(chunk)
    while data:
        z = zlib.decompressobj(31)
        parts = [z.decompress(data)]
        while not z.eof:
            data = stream.read(chunk)
            if not data:
                raise EOFError("the archive ends inside a record")
            parts.append(z.decompress(data))
        yield b"".join(parts)
        data = z.unused_data or stream.read(chunk)


def parse(member: bytes) -> dict:
    """Headers and payload of a record; its digests are checked."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if base64.b32encode(hashlib.sha1(block).digest()).decode() != fields["WARC-Block-Digest"][5:]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} is wrong")
    digest, kind = fields["WARC-Payload-Digest"][5:], fields["WARC-Type"]
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload digest of {fields['WARC-Record-ID']} is wrong")
    page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
    return {"id": None if page is None else int(page), "url": fields.get("WARC-Target-URI"), "record_type": kind,
            "refers_to": None if refers is None else int(refers), "payload_digest": digest,
            "payload_bytes": len(payload) if payload is not None else int(fields["X-Payload-Length"]), "payload": payload}


def read_archives(manifest: DataFrame, payloads: bool = True, batch: int = 500) -> DataFrame:
    """One row per record of the manifest's files: ``id``, ``url``, ``record_type``, ``refers_to``, ``payload_digest``, ``payload_bytes`` and ``payload``."""
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), *([("payload", pa.binary())] if payloads else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for b in batches:
            for path in b.column("path").to_pylist():
                store, name = pafs.FileSystem.from_uri(path)
                with store.open_input_stream(name, compression=None) as f:
                    for m in members(f):
                        rows.append(parse(m))
                        if len(rows) >= batch:
                            yield pa.RecordBatch.from_pylist([{k: r[k] for k in schema.names} for r in rows], schema=schema)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in schema.names} for r in rows], schema=schema)

    n, size = manifest.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    files = manifest.select("path").repartition(max(1, min(n, -(-(size or 0) // READ_BYTES))))
    return files.mapInArrow(run, "id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"
                            + (", payload binary" if payloads else ""))
