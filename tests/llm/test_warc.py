import hashlib
import struct

import duckdb
import zstandard

from fieldnotes.llm import warc
from fieldnotes.session import scratch_path


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, first string").repartition(3)


BIG, OTHER, EXACT = "é" * 600, "z" * 1500, "q" * 1000
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2 b", BIG), (3, None, BIG), (3, None, BIG), (4, "u\r\nv", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
        (None, "u", BIG), (None, "u", OTHER), (None, "u", OTHER), (8, "u", EXACT), (9, "u", EXACT), (10, "u", EXACT[1:]), (11, "u", EXACT[1:]),
        (12, "u", "\r\n\r\nWARC/1.1\r\n" * 100), (13, "u", "long " * 2_000_000)]


def test_round_trip(spark):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(pages(spark, ROWS), folder).collect()
    assert sum(r["n_records"] for r in manifest) == len(ROWS)
    back = warc.read_archives(spark, folder).collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back), key=str)
    want = []
    for i, _, html in ROWS:
        data = (html or "").encode()
        ids = [j for j, _, h in ROWS if (h or "") == (html or "") and j is not None]
        again = len(data) >= 1000 and bool(ids) and i != max(ids)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", max(ids) if again else None))
    assert got == sorted(want, key=str)
    html = {i: (h or "").encode() for i, _, h in ROWS}
    for r in back:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        if r["payload"] is not None and r["page_id"] is not None:
            assert bytes(r["payload"]) == html[r["page_id"]]
    assert {r["url"] for r in back if r["page_id"] in (2, 3, 4)} == {"http://a/2%20b", None, "u%0D%0Av"}


def test_sql_agrees(spark):
    table = pages(spark, ROWS[:12])
    con = duckdb.connect()
    con.register("pages", table.select("page_id", "html").toArrow())
    folder = scratch_path(spark, "warc-test")
    warc.write_archives(table, folder)
    back = warc.read_archives(spark, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(con.sql(warc.sql()).fetchall(), key=str)


def test_format(spark, sf_dir):
    """A leading skippable frame with the dictionary, one frame per record, each of which opens alone."""
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    records = [warc.record(i, u, h.encode(), hashlib.sha1(h.encode()).hexdigest(), "response", None) for i, u, h in rows]
    data = warc.archive(records)
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D and size < len(data)
    known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    assert known.dict_id() and list(warc.frames(memoryview(data)[8 + size :], known)) == records
    plain = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in records)
    assert len(data) - 8 - size < plain  # the dictionary helps
    few = warc.archive(records[:1])  # too few to train on
    assert struct.unpack_from("<I", few)[0] != 0x184D2A5D and [h["WARC-Record-ID"] for h, _ in warc.open_archive(few)] == [f"<urn:page:{rows[0][0]}>"]


def test_files_outside_the_manifest_do_not_count(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write_archives(pages(spark, ROWS[:6]), folder)
    lost = folder.removeprefix("file:") + "/archives/lost.warc.zst"
    with open(lost, "wb") as out:  # as a task that was lost after writing leaves it
        out.write(warc.archive([warc.record(99, None, b"x", hashlib.sha1(b"x").hexdigest(), "response", None)]))
    assert 99 not in {r["page_id"] for r in warc.read_archives(spark, folder).collect()}


def test_empty(spark):
    folder = scratch_path(spark, "warc-test")
    assert warc.write_archives(pages(spark, []), folder).count() == 0
    back = warc.read_archives(spark, folder)
    assert back.count() == 0 and back.schema["page_id"].dataType.simpleString() == "bigint"
