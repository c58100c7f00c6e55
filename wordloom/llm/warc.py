"""Deterministic sharded WARC archives.

Records are dealt to shards by ranges of their id (and of a hash of the payload, for rows of one id)
that hold about equal bytes; the cuts follow from a running sum over all rows, not from a sample, so
equal rows always give equal files. Each shard is one task, sorted and written as one gzip member per
record; a file is closed when its compressed size reaches ``roll``. Files get
temporary names of their attempt; a manifest of what successful tasks wrote is staged, and only what it
lists is renamed. A failed or repeated attempt leaves nothing that a reader sees.

Any URI that ``pyarrow.fs`` opens will do as a target (a mounted or local path, hdfs, s3).
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.decontam import small
from wordloom.operators.sharding import shard_by_bytes
from wordloom.session import stage_table

#: Compressed bytes after which a file is closed, and bytes of payload per shard.
ROLL = 16 << 20
SHARD = 64 << 20
#: Most shards; larger inputs have larger ones.
MAX_SHARDS = 1 << 16
#: Bytes of a record besides its payload, about.
OVERHEAD = 512
#: Rows of one payload that may meet in one task.
HOT_COPIES = 1 << 16
LEVEL = 6
#: Records of smaller payloads are never revisits.
MIN_REVISIT = 0
#: Fixed value: the date in every record, so that files repeat byte by byte.
DATE = "2000-01-01T00:00:00Z"

FILES = "shard bigint, file string, temporary string, records bigint, bytes bigint, first_id bigint, last_id bigint, sha1 string"
#: Order of the records: by id (null first), then by a hash of the payload.
PLACE = ["coalesce(page_id, -9223372036854775807L - 1L) AS key", "xxhash64(coalesce(html, '')) AS mark"]
RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def described(pages: DataFrame) -> DataFrame:
    """(key, mark, page_id, sha1, length) per row, staged: the place of a row in the order of ids, the digest and length of its payload.

    ``key`` is the page_id with the least number for null, ``mark`` a hash of the payload, which orders the rows of one id.
    """
    payload = "coalesce(html, '')"
    return stage_table(pages.selectExpr(*PLACE, "page_id", f"sha1(encode({payload}, 'UTF-8')) AS sha1", f"octet_length({payload}) AS length"), "warc-rows")


def references(rows: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """(key, mark, page_id, sha1, refers_to) of the described ``rows`` that revisit: ``refers_to`` is the smallest page_id of an equal payload.

    Payloads are told apart by their digest. Groups of more than ``HOT_COPIES`` rows are few (counted before they are broadcast)
    and are looked up where their rows are; the others are joined by digest.
    """
    rows = rows.where(F.col("length") >= least)
    groups = stage_table(rows.groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1"), "warc-copies")
    hot = small(groups.where(F.col("n") > HOT_COPIES).select("sha1", F.lit(True).alias("hot"), F.col("first_id").alias("hot_first")))
    looked = rows.join(hot, "sha1", "left")
    rest = looked.where("hot is null").join(groups.where(F.col("n") <= HOT_COPIES).select("sha1", "first_id"), "sha1")
    found = looked.where("hot").withColumn("first_id", F.col("hot_first")).unionByName(rest, allowMissingColumns=True)
    return found.where("page_id <> first_id").select("key", "mark", "page_id", "sha1", F.col("first_id").alias("refers_to")).distinct()


def shard_cuts(rows: DataFrame, shard: int) -> list[tuple[int, int]]:
    """The first (key, mark) of every shard but the first, from a sum of bytes over all described ``rows`` in order.

    Shards hold about ``shard`` bytes each, whatever the ids: far, dense and repeated ones too. Only rows of one id with equal
    payloads stay together. Beyond ``MAX_SHARDS`` they hold as many times more, so the list is bounded.
    """
    sizes = stage_table(rows.groupBy("key", "mark").agg(F.sum(F.col("length") + OVERHEAD).alias("bytes")), "warc-sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    n = min(MAX_SHARDS, -(-total // shard))
    if n < 2:
        return []
    cut = shard_by_bytes(sizes, ["key", "mark"], F.col("bytes"), n).groupBy("shard_id").agg(F.min(F.struct("key", "mark")).alias("first"))
    return sorted(tuple(r[0]) for r in cut.select("first").collect())[1:]  # at most MAX_SHARDS rows


def shard_of(key: Column, mark: Column, cuts: list[tuple[int, int]]) -> Column:
    """The number of cuts at or before (key, mark), by halving."""
    if not cuts:
        return F.lit(0)
    # one constant each, not one expression per cut
    keys, marks = (F.split(F.lit(",".join(map(str, side))), ",").cast("array<bigint>") for side in zip(*cuts, strict=True))

    def step(at: Column, by: Column) -> Column:
        cut_key, cut_mark = F.get(keys, at + by - 1), F.get(marks, at + by - 1)
        return F.when((cut_key < key) | ((cut_key == key) & (cut_mark <= mark)), at + by).otherwise(at)

    halves = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, halves)), F.lit(0), step)


def _header(kind: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record with headers and digests made anew."""
    digest = base32_sha1(payload)
    name = lambda key: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{key}')}>"
    uri = "".join(c for c in (url or "") if c.isprintable() and c != " ")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    fields: list[tuple[str, object]] = [
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Page-ID", "" if page_id is None else page_id),
        ("WARC-Source-URL", json.dumps(url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", len(payload)),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if refers_to is None:
        return _header("response", fields, block)
    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", name(refers_to)), ("WARC-Refers-To-Page-ID", refers_to)]
    return _header("revisit", fields, block)


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else f"file:///{uri}" if ":" not in uri else uri.replace("file:/", "file:///", 1))


def _write(batches: Iterator[pa.RecordBatch], target: str, roll: int) -> Iterator[pa.RecordBatch]:
    """Writes the sorted records of one task; yields one row per closed file.

    The references of a page_id and mark come right before their pages, so pages are shuffled only once.
    """
    system, root = _open(target)
    attempt, sink, now, revisits, at = uuid.uuid4().hex, None, {}, {}, None

    def closed() -> pa.RecordBatch:
        sink.close()
        row = now | {"sha1": now["sha1"].hexdigest()}
        return pa.RecordBatch.from_pylist([row], FILE_SCHEMA)

    part = 0
    for batch in batches:
        for shard, page_id, mark, page_row, sha1, refers_to, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (page_id, mark) != at:
                revisits, at = {}, (page_id, mark)
            if not page_row:
                revisits[sha1] = refers_to
                continue
            payload = (page or "").encode()
            if sink is not None and (shard != now["shard"] or now["bytes"] >= roll):
                part = part + 1 if shard == now["shard"] else 0
                yield closed()
                sink = None
            elif sink is None:
                part = 0
            if sink is None:
                name = f"part-{shard:08d}-{part:05d}.warc.gz"
                now = {"shard": shard, "file": name, "temporary": f"_temporary/{attempt}-{name}", "records": 0, "bytes": 0, "first_id": page_id, "last_id": page_id, "sha1": hashlib.sha1()}
                sink = system.open_output_stream(f"{root}/{now['temporary']}", compression=None)
            packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            packed = packer.compress(record(page_id, url, payload, revisits.get(hashlib.sha1(payload).hexdigest()) if revisits else None)) + packer.flush()
            sink.write(packed)
            now["sha1"].update(packed)
            now |= {"records": now["records"] + 1, "bytes": now["bytes"] + len(packed), "last_id": page_id}
    if sink is not None:
        yield closed()


FILE_SCHEMA = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (c.split() for c in FILES.split(", "))])


def _commit(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    """Moves listed files to their names; a repeated attempt finds them moved."""
    system, root = _open(target)
    for batch in batches:
        for row in batch.to_pylist():
            here, there = f"{root}/{row['temporary']}", f"{root}/{row['file']}"
            if system.get_file_info(here).type != pafs.FileType.NotFound:
                system.move(here, there)
            if system.get_file_info(there).size != row["bytes"]:
                raise OSError(f"{there} is not what the manifest lists")
        yield batch


def write(pages: DataFrame, target: str, roll: int = ROLL, shard: int = SHARD, least: int = MIN_REVISIT) -> DataFrame:
    """Writes ``pages`` (page_id, url, html, any other columns) below ``target`` and returns the manifest.

    A null page is an empty payload, a null page_id sorts first and stays without one, a null URL is
    kept as null. Repeated rows are records each; the first by id is the response, and rows that share
    its id are responses too. An empty table writes no file. ``target`` must be new.
    """
    system, root = _open(target)
    system.create_dir(f"{root}/_temporary", recursive=True)
    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    known = described(rows)
    cuts = shard_cuts(known, shard)
    notes = references(known, least).selectExpr("key", "mark", "page_id", "0 AS page_row", "sha1", "refers_to", "string(null) AS url", "string(null) AS html")
    records = rows.selectExpr(*PLACE, "page_id", "1 AS page_row", "string(null) AS sha1", "bigint(null) AS refers_to", "url", "html")
    placed = notes.unionByName(records).withColumn("shard", shard_of(F.col("key"), F.col("mark"), cuts)).drop("key")
    dealt = placed.repartitionById(len(cuts) + 1, "shard").sortWithinPartitions("page_id", "mark", "page_row", "url", "html")
    dealt = dealt.select(F.col("shard").cast("bigint"), "page_id", "mark", "page_row", "sha1", "refers_to", "url", "html")
    files = dealt.mapInArrow(partial(_write, target=target, roll=roll), FILES)
    manifest = stage_table(files, "warc-manifest")
    return stage_table(manifest.mapInArrow(partial(_commit, target=target), FILES), "warc-committed")


def records_of(stream: io.RawIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of one archive, member by member."""
    unpack, raw = zlib.decompressobj(31), b""
    data = bytearray()
    while True:
        if not raw:
            raw = stream.read(1 << 20)
            if not raw:
                break
        data += unpack.decompress(raw)
        raw = b""
        if unpack.eof:
            raw = unpack.unused_data
            unpack = zlib.decompressobj(31)
            end = data.index(b"\r\n\r\n")
            lines = data[:end].decode().split("\r\n")
            headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
            yield headers, bytes(data[end + 4 : end + 4 + int(headers["Content-Length"])])
            data.clear()
    if data:
        raise ValueError("an archive ends inside a record")


def _read(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    system, root = _open(target)
    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (c.split() for c in RECORDS.split(", "))])
    for batch in batches:
        for name in batch.column(0).to_pylist():
            rows = []
            with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                for headers, block in records_of(stream):
                    if headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
                        raise ValueError(f"block digest of {headers['WARC-Record-ID']} in {name}")
                    kind, digest, length = headers["WARC-Type"], headers["WARC-Payload-Digest"][5:], int(headers["WARC-Payload-Length"])
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    if kind == "response" and (len(payload), base32_sha1(payload)) != (length, digest):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} in {name}")
                    number = lambda key, h=headers: int(h[key]) if h.get(key) else None
                    rows.append((number("WARC-Page-ID"), json.loads(headers["WARC-Source-URL"]), length, digest, kind, number("WARC-Refers-To-Page-ID")))
                    if len(rows) == 1 << 13:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def read(manifest: DataFrame, target: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record, digests checked."""
    files = manifest.select("file")
    return files.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism), "file").mapInArrow(partial(_read, target=target), RECORDS)
