"""WARC archives in which repeated payloads are revisit records.

Headers (identifier, address, payload digest and length) are shuffled by digest, without
payloads; each record that repeats a payload is joined to its original response. The
archives are then written with fresh headers, and can be read back.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rainlane.llm.common import place_in_files
from rainlane.staging import new_folder, stage

# Fixed values of the WARC 1.1 format, RFC 4648 and HTTP.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEXTETS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# Where a record comes from; the format lets archives have fields of their own.
SOURCE = "X-Source-Id"


def base32_sha1(content: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary or string column."""
    digits = F.sha1(content)
    parts = [
        F.lpad(F.conv(F.substring(digits, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)
    ]
    return F.translate(F.concat(*parts), HEXTETS, BASE32)


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Original of each record whose payload an earlier record has already.

    ``headers`` has id, tag, digest, length and more columns; a tag is unique to a row
    and orders rows with the same id. Of equal payloads of at least ``min_bytes`` the
    record with the smallest id (null: largest) is the original. Only groups with more
    than one record take part in the join, and groups are counted before the shuffle.
    """
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "tag")
    originals = (
        headers.where(F.col("length") >= min_bytes)
        .groupBy("digest", "length")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "length", F.col("first.tag").alias("original"))
    )
    return headers.join(originals, ["digest", "length"]).where("tag <> original").select(
        "tag", "original"
    )


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _one_line(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _record_id(tag: Column) -> Column:
    digits = F.md5(tag)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *[digits.substr(*cut) for cut in cuts]), F.lit(">")
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    captured: str = "2024-01-01T00:00:00Z",
    min_bytes: int = 0,
    records_per_file: int = 2000,
    file_bytes: int = 64 << 20,
) -> None:
    """Write a record per row of ``pages``, a table read from files, into archives at ``path``.

    A null payload counts as empty, a null address is left out, a null id is larger than
    all others. Repeated rows are records of their own: all but the first are revisits.
    Line ends in addresses are percent-encoded. Other columns are not read.

    The payloads of a file come to about ``file_bytes``, or to one payload that is larger: those
    larger than their share of a file of ``records_per_file`` are in files of their own, with as
    many as the largest of them leaves room for.
    """
    file, row = place_in_files(pages)
    located = pages.select(
        F.col(id_column).alias("id"),
        _one_line(F.col(url_column)).alias("url"),
        F.coalesce(F.col(payload_column).cast("string"), F.lit("")).alias("payload"),
        F.concat_ws("#", file, F.lpad(row.cast("string"), 19, "0")).alias("tag"),
    )
    headers = stage(
        located.select(
            "id",
            "url",
            "tag",
            base32_sha1(F.col("payload")).alias("digest"),
            F.octet_length("payload").cast("long").alias("length"),
        ),
        "warc-headers",
    )
    revisits = resolve_revisits(headers, min_bytes)
    targets = headers.select(F.col("tag").alias("original"), F.col("url").alias("original_url"))
    revisits = stage(revisits.join(targets, "original"), "warc-revisits")

    digest = base32_sha1(F.col("payload"))
    repeated = F.col("original").isNotNull()
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END),
    )
    block = F.when(repeated, head).otherwise(F.concat(head, F.col("payload")))
    fields = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _field("WARC-Type", F.when(repeated, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _record_id(F.col("tag"))),
        _field("WARC-Date", F.lit(captured)),
        F.coalesce(_field("WARC-Target-URI", F.col("url")), F.lit("")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        _field("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("block")))),
        F.when(repeated, _field("WARC-Profile", F.lit(PROFILE))).otherwise(""),
        F.when(repeated, _field("WARC-Refers-To", _record_id(F.col("original")))).otherwise(""),
        F.coalesce(_field("WARC-Refers-To-Target-URI", F.col("original_url")), F.lit("")),
        F.when(repeated, _field("WARC-Refers-To-Date", F.lit(captured))).otherwise(""),
        F.coalesce(_field(SOURCE, _one_line(F.col("id").cast("string"))), F.lit("")),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    records = located.join(revisits, "tag", "left").withColumn("block", block)
    share = file_bytes // records_per_file
    longest = headers.agg(F.max("length")).first()[0] or 0
    large = F.octet_length("payload") > share
    parts = [(records, records_per_file)]
    if longest > share:
        parts = [(records.where(~large), records_per_file), (records.where(large), max(1, file_bytes // longest))]
    for part, most in parts:
        (
            part.select(F.concat(fields, F.col("block")).alias("record"))
            .write.mode("append")
            .option("lineSep", END)
            .option("maxRecordsPerFile", most)
            .text(path)
        )


RECORD = (
    "record_id string, type string, source_id string, url string, payload_digest string, "
    "payload_bytes bigint, refers_to string"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives at ``path``.

    Lengths and digests of blocks and payloads are worked out anew from the bytes that
    are there and compared with the headers; a difference raises. A revisit has the
    digest of the payload it stands for, and no payload_bytes.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = list(_records(memoryview(content.as_buffer())))
                columns = zip(*rows) if rows else [[]] * 7
                kinds = [pa.string()] * 5 + [pa.int64(), pa.string()]
                arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=RECORD_NAMES)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parsed, RECORD)


RECORD_NAMES = [part.split()[0] for part in RECORD.split(", ")]


def _records(content: memoryview) -> Iterator[tuple]:
    data, at = content.obj if isinstance(content.obj, bytes) else bytes(content), 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"no record at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines)
        start = end + 4
        stop = start + int(fields["Content-Length"])
        block = memoryview(data)[start:stop]
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length than it says")
        _compare(block, fields["WARC-Block-Digest"], at)
        size = None
        if fields["WARC-Type"] == "response":
            payload = block[data.index(b"\r\n\r\n", start) + 4 - start :]
            _compare(payload, fields["WARC-Payload-Digest"], at)
            size = len(payload)
        yield (
            fields["WARC-Record-ID"],
            fields["WARC-Type"],
            fields.get(SOURCE),
            fields.get("WARC-Target-URI"),
            fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            size,
            fields.get("WARC-Refers-To"),
        )
        at = stop + 4


def _compare(content: memoryview, said: str, at: int) -> None:
    found = base64.b32encode(hashlib.sha1(content).digest()).decode()
    if said != f"sha1:{found}":
        raise ValueError(f"the record at byte {at} has another digest than it says")


def resolved_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives at ``path``, revisits joined to their responses: source_id,
    type, payload_digest, payload_bytes and refers_to, the source_id of the response."""
    records = stage(read_archives(spark, path), "warc-records")
    responses = records.where("type = 'response'")
    revisits = records.where("type = 'revisit'").drop("payload_bytes").join(
        responses.select(
            F.col("record_id").alias("refers_to"),
            F.col("source_id").alias("refers_to_source"),
            "payload_bytes",
        ),
        "refers_to",
        "left",
    )
    columns = ["source_id", "type", "payload_digest", "payload_bytes"]
    return responses.select(*columns, F.lit(None).cast("string").alias("refers_to")).unionByName(
        revisits.select(*columns, F.col("refers_to_source").alias("refers_to"))
    )


def archive_round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write archives of ``pages`` to the shared folder and give their resolved records."""
    spark = pages.sparkSession
    path = new_folder(spark, "archives")
    write_archives(pages, path, **options)
    return resolved_records(spark, path)
