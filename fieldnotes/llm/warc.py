"""WARC archives with one Zstandard frame per record and a dictionary per file.

A task gathers records up to ``FILE_BYTES`` of payload, trains a dictionary on
them (on evenly spaced ones, up to ``SAMPLE_BYTES``), and writes the file: a
leading skippable frame (magic 0x184D2A5D) that holds the dictionary, then each
record compressed as a frame of its own. Too few or too small records to train
on (zstd refuses them) give a file without that frame.

Equal payloads of ``LEAST`` bytes or more are stored once. The page with the
largest id has the ``response`` record; the others get ``revisit`` records,
which keep the digest and the HTTP header (with the payload's length) and
refer to it. Equal means equal SHA-1, length and 64-bit XXH64.

A file gets a name of its own and counts only once it is in the manifest,
which Spark writes with its commit protocol; files of lost or repeated tasks
are left unread. Files go through ``pyarrow.fs``, into the shared folder.

Defined cases: NULL html is an empty payload; NULL url writes no target URI;
NULL ids are kept and read back as NULL, and never are the largest id; rows
that repeat the largest id with an equal payload are responses too; an empty
table writes no file and reads back no row; other columns are ignored. A record
larger than ``FILE_BYTES`` has a file of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnotes.llm.util import table
from fieldnotes.session import scratch_path

LEAST = 1000  # bytes of a payload that may be revisited
FILE_BYTES = 8 << 20  # payload bytes in a file
SAMPLE_BYTES = 4 << 20  # of its records, for the dictionary
DICTIONARY_BYTES = 64 << 10
LEVEL = 6
DICTIONARY_MAGIC = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture date
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload (binary), digest (SHA-1 hex), record_type, refers_to for every row."""
    payload = F.coalesce(F.encode(F.col(html_col).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "n": F.octet_length("payload"), "x": F.xxhash64("payload")})
    shared = rows.where(F.col("n") >= LEAST).groupBy("digest", "n", "x").agg(F.count("*").alias("copies"), F.max("page_id").alias("first"))
    shared = shared.where("copies > 1").drop("copies")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, ["digest", "n", "x"], "left").select(
        "page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def record(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record. The block is an HTTP response; a revisit's stops after the header."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary trained on evenly spaced records, or None if there is too little to train on."""
    every = -(-sum(map(len, records)) // SAMPLE_BYTES)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records[:: max(1, every)], level=LEVEL)
    except zstandard.ZstdError:
        return None


def archive(records: list[bytes]) -> bytes:
    """The bytes of one file."""
    known = dictionary(records)
    head = b""
    if known:
        data = zstandard.ZstdCompressor(level=LEVEL).compress(known.as_bytes())
        head = struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data
        known.precompute_compress(level=LEVEL)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=True)
    return head + b"".join(map(packer.compress, records))


def frames(data: memoryview, known: zstandard.ZstdCompressionDict | None, step: int = 64 << 10) -> Iterator[bytes]:
    """The content of each frame, one record's at a time."""
    opener, at = zstandard.ZstdDecompressor(dict_data=known), 0
    while at < len(data):
        frame, out = opener.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("a WARC record is cut short")
            part = data[at : at + step]
            out.append(frame.decompress(part))
            at += len(part) - len(frame.unused_data)
        yield b"".join(out)


def open_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of a file."""
    known, rest = None, memoryview(data)
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        rest = rest[8 + size :]
    for one in frames(rest, known):
        head, _, block = one.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        header = dict(x.split(": ", 1) for x in lines[1:])
        if lines[0] != "WARC/1.1" or len(block) != int(header["Content-Length"]) + 4:
            raise ValueError("not a whole WARC record")
        yield header, block[:-4]


def write_archives(pages: DataFrame, folder: str, **columns: str) -> DataFrame:
    """Writes the archives into ``folder``; the manifest (file, n_records, n_bytes), itself written there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(f"{folder}/archives")
        held: list[bytes] = []

        def put() -> pa.RecordBatch:
            store.create_dir(root, recursive=True)
            name, data = f"{uuid.uuid4().hex}.warc.zst", archive(held)
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            done = pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([len(held)], pa.int64()), "n_bytes": pa.array([len(data)], pa.int64())})
            held.clear()
            return done

        size = 0
        for b in batches:
            cols = [b.column(c) for c in ("page_id", "url", "payload", "digest", "record_type", "refers_to")]
            for i in range(b.num_rows):
                row = [c[i].as_py() for c in cols]
                if held and size + len(row[2]) > FILE_BYTES:
                    yield put()
                    size = 0
                held.append(record(*row))
                size += len(row[2])
        if held:
            yield put()

    manifest = with_types(pages, **columns).mapInArrow(run, "file string, n_records long, n_bytes long")
    manifest.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/manifest")


ID = re.compile(r"<urn:page:(.*)>")


def read_archives(spark: SparkSession, folder: str, *, id_type: T.DataType = T.LongType(), payloads: bool = True) -> DataFrame:
    """The records of the manifest's files: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and payload
    (NULL for a revisit) if ``payloads``. Every response's payload is checked against its digest."""
    manifest = spark.read.schema("file string, n_records long, n_bytes long").parquet(f"{folder}/manifest")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payloads]
    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    schema = T._parse_datatype_string(schema + ", payload binary" * payloads)
    if manifest.isEmpty():  # no archive was written
        return spark.createDataFrame([], schema).withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
    files = spark.read.format("binaryFile").load(f"{folder}/archives").select(
        F.substring_index("path", "/", -1).alias("file"), "content")
    files = files.join(manifest.select("file"), "file", "left_semi").select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = []
                for header, block in open_archive(b.column("content")[i].as_py()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
                    digest = base64.b32decode(header["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    kind = header["WARC-Type"]
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{header['WARC-Record-ID']}: the payload does not match its digest")
                    refers = ID.fullmatch(header["WARC-Refers-To"])[1] if kind == "revisit" else None
                    rows.append((ID.fullmatch(header["WARC-Record-ID"])[1] or None, header.get("WARC-Target-URI"), size, digest, kind, refers,
                                 payload if kind == "response" else None)[: len(names)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    return files.mapInArrow(run, schema).withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def op8_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "warc")
    write_archives(pages, folder)
    found = read_archives(spark, folder, id_type=pages.schema["page_id"].dataType, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def sql() -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, payload_bytes, max(page_id) AS first_id FROM d
      WHERE payload_bytes >= {LEAST} GROUP BY ALL HAVING count(*) > 1),
j AS (SELECT d.*, f.first_id, f.first_id IS NOT NULL AND d.page_id IS DISTINCT FROM f.first_id AS again
      FROM d LEFT JOIN f USING (payload_digest, payload_bytes))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to FROM j"""
