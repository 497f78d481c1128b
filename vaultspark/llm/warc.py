"""Dictionary-compressed WARC archives.

Every page becomes a WARC/1.1 record.  A Zstandard dictionary is trained on a
bounded sample of the records; each archive starts with a skippable frame (magic
0x184D2A5D) that holds the dictionary, followed by one Zstandard frame per record, so
any record can be read alone.  Of equal payloads of at least ``revisit_from`` bytes
the one with the largest page_id is written in full, the others as revisit records.

Scale: which payloads repeat is one aggregate over (digest, largest id); only
digests that occur twice or more are kept, and the pages meet them in a join whose
plan Spark takes from that table's size (a digest's copies may be split over tasks).
Each task streams its rows into archives in the shared folder, under a name of its
partition, through a temporary file that is renamed when complete: a lost task is
written again, a second attempt replaces the same rows.  Reading back streams frame by frame.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import struct
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm.common import scratch, small_batches, stored, texts

#: Skippable frame that holds the dictionary (fixed value of the format).
DICT_MAGIC = 0x184D2A5D
REVISIT_FROM = 1000
DICT_BYTES = 64 << 10
SAMPLE_RECORDS = 500
SAMPLE_BYTES = 16 << 10
ARCHIVE_BYTES = 512 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A header block is never longer than this when an archive is read.
CHUNK = 1 << 20


def _uri(url: str | None) -> str:
    """The URL with white space, control and non-ASCII characters percent-encoded; empty for none."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "")


def record(page_id: Any, url: str | None, payload: bytes, digest: str, size: int, refers_to: Any = None) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) holds the HTTP header alone."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = "" if page_id is None else page_id
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", DATE)]
    if url:
        fields.append(("WARC-Target-URI", _uri(url)))
    fields.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(binascii.unhexlify(digest)).decode()))
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict[str, Any]:
    """Header fields, HTTP header and payload of one record; raises ValueError if it is broken."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC header")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("record length differs from Content-Length")
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    web = dict(x.split(": ", 1) for x in http.decode("ascii").split("\r\n")[1:])
    return {"fields": fields, "http": web, "payload": payload}


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A Zstandard dictionary; raw content of the samples where they are too few to train on; empty for none."""
    total = sum(map(len, samples))
    if total == 0:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def archive_head(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary


def _open(path: str):
    """(file system, path in it): any store that pyarrow knows, by URI or absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def read_archive(stream) -> Iterator[bytes]:
    """Records of an archive, one at a time."""
    head = stream.read(8)
    magic, n = struct.unpack("<II", head)
    if magic != DICT_MAGIC:
        raise ValueError("no dictionary frame")
    dictionary = stream.read(n)
    kind = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    context, one, out = zstandard.ZstdDecompressor(**kind), None, []
    pending = b""
    while True:
        if not pending:
            pending = stream.read(CHUNK)
            if not pending:
                break
        one = one or context.decompressobj()
        out.append(one.decompress(pending))
        pending = one.unused_data if one.eof else b""
        if one.eof:
            yield b"".join(out)
            one, out = None, []
    if one is not None:
        raise ValueError("archive ends inside a record")


def _writer(root: str, dictionary: bytes, roll: int, level: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files, base = _open(root)
        kind = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, **kind)
        out, done, n, size = None, [], 0, 0

        def names(k: int) -> tuple[str, str]:
            name = f"pages-{task.partitionId():06d}-{k:04d}.warc.zst"
            return f"{base}/_open-{task.taskAttemptId()}-{name}", f"{base}/{name}"

        def close() -> None:
            out.close()
            part, final = names(len(done))
            if files.get_file_info(final).type.name != "NotFound" and files.type_name != "local":
                files.delete_file(final)  # of an attempt that was lost; local renames replace
            files.move(part, final)
            done.append((final if "://" not in root else root.split("://")[0] + "://" + root.split("://")[1].split("/")[0] + final, n))

        for b in small_batches(it, "html", 8 << 20):
            cols = [b.column(c).to_pylist() for c in ("page_id", "url", "payload_digest", "payload_bytes", "refers_to")]
            for page, url, digest, length, ref, body in zip(*cols, texts(b.column("html"))):
                if out is None:
                    files.create_dir(base, recursive=True)
                    out, n, size = files.open_output_stream(names(len(done))[0]), 0, 0
                    out.write(archive_head(dictionary))
                frame = compressor.compress(record(page, url, body, digest, length, ref))
                out.write(frame)
                n, size = n + 1, size + len(frame)
                if size >= roll:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())],
                                         ["path", "records"])

    return run


def write_archives(spark: SparkSession, pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", revisit_from: int = REVISIT_FROM, roll: int = ARCHIVE_BYTES, level: int = 3) -> DataFrame:
    """Archive every row of ``pages`` under ``root`` and return (path, records) of the archives.

    A null payload is empty; a null URL has no target field; a null id is an empty
    name and never the full copy of others.  Rows repeated under one id and payload are
    written alike (all in full if that id is the largest).  An empty table writes no
    archive; other columns are not read."""
    body = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    src = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), body.alias("html"))
    src = src.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha1(F.col("html").cast("binary"))})
    again = (src.filter(F.col("payload_bytes") >= revisit_from).groupBy(F.col("payload_digest").alias("_digest"))
             .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1 and _first is not null").drop("_n"))
    again = stored(spark, again, "repeated-payloads")
    found = src.join(again, (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= revisit_from), "left")
    found = found.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))).drop("_first", "_digest")
    # a bounded sample, for the dictionary alone: its hashes are found first, so a partition sends numbers and no texts
    place = F.xxhash64("payload_digest", "page_id")
    first = src.select(place.alias("place")).distinct().orderBy("place").limit(SAMPLE_RECORDS).agg(F.max("place")).first()[0]
    few = src.select(place.alias("place"), "page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html"), "payload_digest", "payload_bytes")
    few = few.filter(F.col("place") <= F.lit(first)).dropDuplicates(["place"]).orderBy("place").collect() if first is not None else []
    few = [record(r["page_id"], r["url"], r["html"].encode("utf-8", "replace"), r["payload_digest"], r["payload_bytes"]) for r in few]
    task = _writer(root, train_dictionary(few), roll, level)
    cols = ["page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to"]
    return stored(spark, found.select(*cols).mapInArrow(task, "path string, records bigint"), "archives")


def read_archives(spark: SparkSession, archives: DataFrame, id_type: str = "bigint", payload: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]): every
    record of the archives in ``archives(path, records)``.  The digest of a payload is
    checked; a broken record, or an archive with another number of records, raises."""
    columns = f"page_id {id_type}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {id_type}"
    columns += ", payload binary" if payload else ""
    kind = pa.int64() if id_type == "bigint" else pa.string()
    name = (lambda x: int(x)) if id_type == "bigint" else str

    def ident(x: str | None):
        x = (x or "")[len("<urn:page:"):-1]
        return name(x) if x else None

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [kind, pa.string(), pa.int64(), pa.string(), pa.string(), kind] + [pa.binary()] * payload
        heads = [c.split()[0] for c in columns.split(", ")]

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(types), types)], heads)

        for b in it:
            for path, count in zip(b.column("path").to_pylist(), b.column("records").to_pylist()):
                files, place = _open(path)
                rows, held, n = [], 0, 0
                with files.open_input_stream(place) as stream:
                    for raw in read_archive(stream):
                        r = parse(raw)
                        f = r["fields"]
                        digest = base64.b32decode(f["WARC-Payload-Digest"].partition(":")[2]).hex()
                        if f["WARC-Type"] == "response" and hashlib.sha1(r["payload"]).hexdigest() != digest:
                            raise ValueError(f"payload digest differs in {path}, {f['WARC-Record-ID']}")
                        row = (ident(f["WARC-Record-ID"]), f.get("WARC-Target-URI"), int(r["http"]["Content-Length"]), digest,
                               f["WARC-Type"], ident(f.get("WARC-Refers-To")))
                        rows.append(row + ((r["payload"],) if payload else ()))
                        n, held = n + 1, held + (len(raw) if payload else 200)
                        if held > 8 << 20:
                            yield out(rows)
                            rows, held = [], 0
                if n != count:
                    raise ValueError(f"{path} has {n} records, {count} were written")
                yield out(rows)

    tasks = max(1, archives.count())
    return archives.repartition(tasks, "path").mapInArrow(run, columns)


def archive(spark: SparkSession, pages: DataFrame, root: str | None = None, **kw) -> DataFrame:
    """Write ``pages`` to archives in the shared folder (or ``root``) and read every record back."""
    id_type = pages.schema[kw.get("id_col", "page_id")].dataType.simpleString()
    written = write_archives(spark, pages, root or scratch(spark, "warc"), **kw)
    return read_archives(spark, written, "string" if id_type == "string" else "bigint")
