"""WARC archives: written as records, indexed first, then read by byte ranges.

Archives are gzip files of one member a record, so a record can be read from its offset
alone.  An index pass over an archive yields (file, offset, length, url, digest) a
record.  Selected records are sorted by file and offset, neighbouring ranges are read in
one request, and each record is cut out and checked against the index.  Files are reached
through ``pyarrow.fs``, by URI, so any shared file system it knows will do.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.text import small_batches
from marketlake.session import materialize, scratch_path

#: Payloads shorter than this are always stored.
REVISIT_BYTES = 1000
#: An archive is closed beyond this size.
ARCHIVE_BYTES = 256 << 20
#: Ranges closer than the gap are read together, up to the size of one request.
READ_GAP, READ_BYTES = 64 << 10, 8 << 20
#: Archive bytes that one task reads.
TASK_BYTES = 64 << 20
_END = b"\r\n\r\n"
_RECORD = "record_id string, url string, record_type string, payload_digest string, refers_to string"
INDEX_SCHEMA = f"file string, offset long, length long, {_RECORD}"


def plan_records(pages: DataFrame, record_id: Column, url: Column, payload: Column) -> DataFrame:
    """(record_id, url, payload, payload_digest, record_type, refers_to) for rows to archive.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` bytes the largest id is the
    response and the others revisit it; rows tied at the largest id are all responses, as
    are rows of payloads that only null ids hold.  A null payload is an empty one.
    """
    body = F.coalesce(payload, F.lit(""))
    rows = pages.select(record_id.alias("record_id"), url.alias("url"), body.alias("payload"),
                        F.sha1(body.cast("binary")).alias("payload_digest"))
    # Only payloads held twice, written: small tables are broadcast by their size, and a
    # join with a large one deals out a very common payload over several tasks.
    repeated = materialize(
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("payload_digest").agg(
            F.count(F.lit(1)).alias("n"), F.max("record_id").alias("origin")).filter("n > 1").select(
            F.col("payload_digest").alias("shared"), "origin"), "repeated-payloads")
    joined = rows.join(repeated, rows["payload_digest"] == repeated["shared"], "left")
    revisit = F.col("origin").isNotNull() & ~F.col("record_id").eqNullSafe(F.col("origin"))
    return joined.select(
        "record_id", "url", "payload", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("origin")).alias("refers_to"))


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _one_line(value) -> str:
    """A header value; line breaks cannot stand in a header and become spaces."""
    return str(value).replace("\r", " ").replace("\n", " ")


def _encode(row) -> bytes:
    body = b"" if row.record_type == "revisit" else row.payload.encode("utf-8")
    head = ["WARC/1.1", f"WARC-Type: {row.record_type}", f"WARC-Payload-Digest: sha1:{row.payload_digest}"]
    if row.record_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{_one_line(row.record_id)}>")
    if row.url is not None:
        head.append(f"WARC-Target-URI: {_one_line(row.url)}")
    if row.refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{_one_line(row.refers_to)}>")
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    record = "\r\n".join(head).encode("utf-8") + _END + body + _END
    return packer.compress(record) + packer.flush()


def _decode(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(_END)
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if not lines[0].startswith("WARC/") or rest[size:] != _END:
        raise ValueError("not a whole WARC record")
    return fields, rest[:size]


def _urn(value: str | None) -> str | None:
    return value[len("<urn:page:"):-1] if value else None


def _described(fields: dict[str, str]) -> dict:
    return {
        "record_id": _urn(fields.get("WARC-Record-ID")), "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": _urn(fields.get("WARC-Refers-To")),
    }


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write records to archives in ``folder``; returns the written (file, records, bytes).

    Every task writes to names of its own and reports them when it is done, so a task
    that is run again leaves files that no list names.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        out, name, done, size, count = None, "", [], 0, 0
        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                packed = _encode(row)
                out.write(packed)
                size, count = size + len(packed), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", count, size))
        yield pd.DataFrame(done, columns=["file", "records", "bytes"])

    plain = records.withColumns({c: F.col(c).cast("string") for c in ("record_id", "refers_to")})
    return materialize(plain.mapInPandas(run, "file string, records long, bytes long"), "archives")


def _members(read: Callable[[int], bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of the gzip members of a stream, one at a time."""
    offset, waiting = 0, b""
    while True:
        waiting = waiting or read(1 << 20)
        if not waiting:
            return
        unpack, parts, used = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            waiting = waiting or read(1 << 20)
            if not waiting:
                raise ValueError("the archive ends inside a record")
            parts.append(unpack.decompress(waiting))
            used += len(waiting) - len(unpack.unused_data)
            waiting = unpack.unused_data
        yield offset, used, b"".join(parts)
        offset += used


def index_archives(files: DataFrame) -> DataFrame:
    """The index of the archives in ``files`` (file): a row a record, written once.

    An archive is one unit of work and is read as a stream; memory is one record's.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
        for batch in batches:
            for file in batch["file"]:
                fs, path = _open(file)
                rows = []
                with fs.open_input_stream(path, compression=None) as stream:
                    for offset, length, record in _members(stream.read):
                        fields, _ = _decode(record)
                        rows.append({"file": file, "offset": offset, "length": length, **_described(fields)})
                        if len(rows) >= 5000:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                yield pd.DataFrame(rows, columns=names)

    # A task a file: the rows are names, so their own size says nothing about the work.
    spread = files.select("file").repartition(max(files.count(), 1))
    return materialize(spread.mapInPandas(run, INDEX_SCHEMA), "warc-index")


def read_records(index: DataFrame, columns: str = "payload string",
                 make: Callable[[dict, bytes], dict] | None = None) -> DataFrame:
    """Records of the selected index rows, read by coalesced byte ranges.

    ``make`` turns the header fields and the block into the values of ``columns``; by
    default the block as text.  A record that does not match its index row, or whose
    block does not have its digest, fails the job.
    """
    make = make or (lambda fields, block: {"payload": block.decode("utf-8")})
    schema = f"{_RECORD}, {columns}"
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(group: list) -> Iterator[dict]:
        fs, path = _open(group[0].file)
        begin = group[0].offset
        with fs.open_input_file(path) as source:
            source.seek(begin)
            data = source.read(group[-1].offset + group[-1].length - begin)
        for row in group:
            fields, block = _decode(zlib.decompress(data[row.offset - begin: row.offset - begin + row.length], 31))
            found = _described(fields)
            stored = found["record_type"] != "revisit"
            if found["payload_digest"] != row.payload_digest or (
                    stored and hashlib.sha1(block).hexdigest() != row.payload_digest):
                raise ValueError(f"{row.file} at {row.offset}: the record is not the one indexed")
            yield {**found, **make(fields, block)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group: list = []
        rows: list[dict] = []
        for batch in batches:
            for row in batch.itertuples(index=False):
                if group and (row.file != group[0].file
                              or row.offset > group[-1].offset + group[-1].length + READ_GAP
                              or row.offset + row.length - group[0].offset > READ_BYTES):
                    rows.extend(cut(group))
                    group = []
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
                group.append(row)
        if group:
            rows.extend(cut(group))
        yield pd.DataFrame(rows, columns=names)

    placed = index.select("file", "offset", "length", "payload_digest")
    # Tasks by the bytes to be read, which the few bytes of an index row do not show.
    total = placed.agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-total // TASK_BYTES), index.sparkSession.sparkContext.defaultParallelism)
    near = placed.repartitionByRange(int(tasks), "file", "offset").sortWithinPartitions("file", "offset")
    return near.mapInPandas(run, schema)


def archive_pages(pages: DataFrame, spark: SparkSession) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) read back from archives.

    Every row of ``pages`` becomes a record.  A revisit stores no payload: its size is that
    of the response it refers to, found by joining the two, so a revisit whose response is
    missing would show a null.  Repeated rows give repeated records; an empty table gives
    no archives and no rows.
    """
    small_batches(spark)
    records = plan_records(pages, F.col("page_id"), F.col("url"), F.col("html"))
    files = write_archives(records, scratch_path(spark, "warc"))
    index = index_archives(files)
    read = materialize(
        read_records(index, "block_bytes long", lambda fields, block: {"block_bytes": len(block)}), "warc-read")
    stored = read.filter("record_type = 'response'").groupBy(
        F.col("record_id").alias("origin"), F.col("payload_digest").alias("digest")).agg(
        F.max("block_bytes").alias("stored_bytes"))
    revisits = read.filter("record_type = 'revisit'")
    resolved = revisits.join(
        stored, (revisits["refers_to"] == stored["origin"]) & (revisits["payload_digest"] == stored["digest"]),
        "left").drop("origin", "digest", "block_bytes")
    whole = read.filter("record_type = 'response'").withColumnRenamed("block_bytes", "stored_bytes")
    id_type = pages.schema["page_id"].dataType
    return whole.unionByName(resolved).select(
        F.col("record_id").cast(id_type).alias("page_id"), "url", F.col("stored_bytes").alias("payload_bytes"),
        "payload_digest", "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))


SQL = r"""with p as (
 select page_id, url, coalesce(html, '') as body from pages
), d as (
 select page_id, url, octet_length(encode(body)) as payload_bytes, sha1(body) as payload_digest from p
), o as (
 select *, max(page_id) over (partition by payload_digest) as origin from d
)
select page_id, url, payload_bytes, payload_digest,
 case when payload_bytes >= 1000 and page_id <> origin then 'revisit' else 'response' end as record_type,
 case when payload_bytes >= 1000 and page_id <> origin then origin end as refers_to from o"""
