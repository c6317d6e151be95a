"""WARC archives: written by Spark, read by a Python data source with pushed predicates."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from tickloom.llm.common import file_system
from tickloom.session import shared_folder, staged

#: Format names, fixed by the standard.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ("record_id string, record_type string, target_uri string, date string, "
          "refers_to string, payload_digest string, http_length long, payload binary")
#: Columns that are header fields, and so can be tested before a payload is touched.
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type",
           "target_uri": "warc-target-uri", "date": "warc-date",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
_BATCH = 8 << 20
_FIRST = re.compile(rb"WARC/\d")


def write_archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 100,
                  date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id",
                  url_col: str = "url", html_col: str = "html") -> str:
    """Write one WARC record per row and return the folder: a response, or a revisit of the row
    with the smallest id whose payload is equal, if it has ``min_bytes`` or more.

    Digests of repeated payloads are counted apart from the pages, combined before the shuffle;
    then each page is joined with the first holder of its digest. Records are text in UTF-8 and
    end with two line ends, so Spark's text writer makes the archives on any of its file systems,
    and the writer's commit leaves whole files only.

    Defined cases: null html is an empty payload; a null id is written as ``null`` and is always
    a response that nobody refers to; rows with the same id and payload are all responses. A null
    URL is an empty field; control characters and blanks in one become %20.
    """
    folder = folder or shared_folder(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        payload.alias("payload"), F.octet_length(payload).alias("bytes"),
        F.sha2(payload.cast("binary"), 256).alias("digest"))
    first = staged(
        rows.where((F.col("bytes") >= min_bytes) & F.col("id").isNotNull()).groupBy("digest")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where(F.col("first") < F.col("last")).drop("last"), "repeated_payloads")
    joined = rows.join(first, "digest", "left")
    revisit = F.col("id") > F.col("first")
    url = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("id")),
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), url,
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "),
                                 _record_id(F.col("first")))).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block)
    joined.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").text(folder)
    return folder


def _record_id(number):
    return F.concat(F.lit("<urn:page:"), F.coalesce(number.cast("string"), F.lit("null")),
                    F.lit(">"))


def record_number(record_id):
    """The id that a record's address holds."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")


def read_archive(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Records of all archives of a folder. Without ``payload`` that column is null and no
    payload is decoded; equality filters on header columns skip other records' payloads.

    Defined cases: bytes of a header that are no UTF-8 become U+FFFD; a record without a length,
    or whose head is not one, is skipped up to the next line that begins a record; a payload that
    the file's end cuts off is returned as far as it goes; an HTTP head without a length gives a
    null ``http_length``; empty archives have no record.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "WarcReader":
        return WarcReader(self.options["path"], self.options.get("payload", "true") == "true")


@dataclass
class Archive(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    """One partition per archive file. ``wanted`` maps a header field to the values that pass."""

    def __init__(self, folder: str, payload: bool):
        self.folder, self.payload, self.wanted = folder, payload, {}

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 \
                else None
            if column in HEADERS and isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                field = HEADERS[column]
                self.wanted[field] = self.wanted.get(field, values) & values
            else:
                yield f

    def partitions(self):
        store, path = file_system(self.folder)
        files = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return [Archive(f.path) for f in sorted(files, key=lambda f: f.path)
                if f.is_file and f.size and not f.base_name.startswith(("_", "."))] or [Archive("")]

    def read(self, partition):
        if not partition.path:
            return
        store, _ = file_system(self.folder)
        rows, held = [], 0
        with store.open_input_file(partition.path) as file:
            for row in self.records(io.BufferedReader(file, 1 << 20)):
                rows.append(row)
                held += len(row[-1] or b"") + 200
                if held >= _BATCH:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)

    def records(self, file: io.BufferedReader) -> Iterator[tuple]:
        """The records that pass. One whose head is broken (no first line, no length that is a
        number) cannot be stepped over by length, so the next one is sought by its first line."""
        while line := file.readline():
            if not _FIRST.match(line):
                continue
            head = _fields(file)
            size = _number(head.get("content-length"))
            if size is None:
                continue
            end = file.tell() + size
            if all(head.get(field) in values for field, values in self.wanted.items()):
                http, length, payload = {}, None, None
                if head.get("content-type", "").startswith("application/http"):
                    file.readline()
                    http = _fields(file)
                    length = _number(http.get("content-length"))
                if self.payload and head.get("warc-type") != "revisit":
                    payload = file.read(end - file.tell())
                yield (*(head.get(field) or None for field in HEADERS.values()), length, payload)
            file.seek(end)


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdigit() else None


def _fields(file: io.BufferedReader) -> dict[str, str]:
    found = {}
    while (line := file.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [*HEADERS, "http_length", "payload"]
    types = [*[pa.string()] * len(HEADERS), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
