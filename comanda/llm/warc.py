"""WARC archives written from pages, and captures assembled from archives.

A page becomes three records: the response (or a revisit, if another page holds the same payload), its request
and its metadata, tied by ``WARC-Concurrent-To``. Spark's text sink writes them: a record ends in two line
breaks, which is the sink's line separator, so files appear by Spark's commit protocol on whatever storage the
path names. Reading frames records by ``Content-Length``, one bounded file at a time, and joins request, response
and metadata on the concurrent-to identifiers, whichever of the records states the link.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import math
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm.common import map_rows
from comanda.staging import stage

BREAK = "\r\n"
# Payloads below this size are stored in every record, never as revisits.
MIN_REVISIT_BYTES = 1_000
# Payload bytes in one file, before compression: bounds what a reading task holds. Pages are written by classes of
# size, each up to ``CLASS_FACTOR`` times the one before, with as many records a file as their size allows.
FILE_BYTES = 256 * 1024**2
CLASS_BYTES, CLASS_FACTOR, CLASSES = 64 * 1024, 8, 6
RECORDS_PER_PAGE = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = ("response", "revisit")


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without the final two line breaks; headers with a null value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)) for name, value in headers]
    size = F.octet_length(block).cast("string")
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        *[F.coalesce(line, F.lit("")) for line in lines],
        F.lit("Content-Length: "),
        size,
        F.lit(BREAK + BREAK),
        block,
    )


def _new_id() -> Column:
    return F.concat(F.lit("<urn:uuid:"), F.expr("uuid()"), F.lit(">"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Writes the records of every page as compressed archives under ``path``.

    Of pages with equal payloads of at least ``MIN_REVISIT_BYTES`` bytes, those with the largest id are responses
    and the others revisit them. A null page is an empty payload. A null id revisits if some page with an id has
    its payload, else it is a response. Rows that repeat an id each get their records. A null url leaves the
    target out; line breaks in a url are percent-encoded. Small pages share files of ``FILE_BYTES`` of payload at
    most; a larger page has a file of its own.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("string").alias("_id"),
        F.col(id_col).alias("_page"),
        F.replace(F.replace(F.col(url_col), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("_url"),
        html.alias("_html"),
        F.octet_length(html).alias("_bytes"),
        F.sha1(html).alias("_sha1"),
    )
    limits = [CLASS_BYTES * CLASS_FACTOR**n for n in range(CLASSES)]
    size_class = F.lit(CLASSES)
    for n, limit in reversed(list(enumerate(limits))):
        size_class = F.when(F.col("_bytes") <= limit, n).otherwise(size_class)
    rows = rows.withColumn("_class", size_class)
    thin = stage(rows.select("_page", "_bytes", "_sha1", "_class"), "payload-digests").df
    held = sorted(r["_class"] for r in thin.select("_class").distinct().collect()) or [0]
    repeated = (
        thin.where(F.col("_bytes") >= MIN_REVISIT_BYTES)
        .groupBy("_sha1")
        .agg(F.max("_page").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1) & F.col("_first").isNotNull())
        .select(F.col("_sha1").alias("_of"), "_first")
    )
    repeated = stage(repeated, "payloads").df
    rows = rows.join(repeated, F.col("_sha1") == F.col("_of"), "left").withColumn("_capture", _new_id())
    revisits = F.col("_first").isNotNull() & ~F.col("_page").eqNullSafe(F.col("_first"))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.col("_bytes").cast("string"),
        F.lit(BREAK + BREAK),
    )
    rest = F.regexp_extract("_url", r"(?s)^[^/]*//[^/?#]*([^#]*)", 1)
    target = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    asked = F.concat(
        F.lit("GET "),
        F.coalesce(target, F.lit("/")),
        F.lit(f" HTTP/1.1{BREAK}Host: "),
        F.coalesce(F.regexp_extract("_url", r"(?s)^[^/]*//([^/?#]*)", 1), F.lit("")),
        F.lit(BREAK + BREAK),
    )
    fields = F.concat(
        F.coalesce(F.concat(F.lit("page-id: "), F.col("_id"), F.lit(BREAK)), F.lit("")),
        F.when(revisits, F.concat(F.lit("refers-to-page: "), F.col("_first").cast("string"), F.lit(BREAK))).otherwise(
            ""
        ),
    )
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", F.col("_url"))]
    capture = _record(
        [
            ("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
            ("WARC-Record-ID", F.col("_capture")),
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_sha1"))),
            ("WARC-Profile", F.when(revisits, PROFILE)),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        F.when(revisits, head).otherwise(F.concat(head, F.col("_html"))),
    )
    companions = [
        _record(
            [
                ("WARC-Type", F.lit(kind)),
                ("WARC-Record-ID", _new_id()),
                ("WARC-Concurrent-To", F.col("_capture")),
                *common,
                ("Content-Type", F.lit(content)),
            ],
            block,
        )
        for kind, content, block in (
            ("request", "application/http; msgtype=request", asked),
            ("metadata", "application/warc-fields", fields),
        )
    ]
    records = rows.select("_class", F.array(capture, *companions).alias("_records"))
    for turn, n in enumerate(held):
        pages_a_file = max(1, FILE_BYTES // limits[n]) if n < CLASSES else 1
        own = records.where(F.col("_class") == n) if len(held) > 1 else records
        own.select(F.explode("_records")).write.mode("append" if turn else "errorifexists").option(
            "lineSep", BREAK + BREAK
        ).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_PAGE * pages_a_file).text(path)


def parse_records(content: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Headers (names in lower case) and block of every record of an archive, plain or compressed.

    A record that the file cuts short is not returned.
    """
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers.get("content-length", ["0"])[0])
        block = stream.read(size)
        if len(block) < size:
            return
        yield headers, block


def _row(headers: dict[str, list[str]], block: bytes, with_payload: bool) -> tuple:
    only = lambda name: headers.get(name, [None])[0]
    kind = only("warc-type")
    size = digest = payload = text = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    elif kind == "revisit":
        sizes = [
            value.strip()
            for name, _, value in (line.partition(b":") for line in block.split(b"\r\n"))
            if name.strip().lower() == b"content-length"
        ]
        size = int(sizes[0]) if sizes else None
        digest = (only("warc-payload-digest") or "").rpartition(":")[2] or None
    else:
        text = block.decode("utf-8", "replace")
    links = headers.get("warc-concurrent-to", [])
    found = (only("warc-record-id"), kind, links, only("warc-target-uri"), only("warc-date"), size, digest, text)
    return (*found, payload) if with_payload else found


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; one file at a time in a task."""

    def start() -> Callable[[list[dict]], Iterable[tuple]]:
        def work(files: list[dict]) -> Iterable[tuple]:
            for file in files:
                for headers, block in parse_records(file["content"]):
                    yield _row(headers, block, with_payload)

        return work

    schema = (
        "record_id string, record_type string, concurrent_to array<string>, target_uri string, date string, "
        "payload_bytes bigint, payload_digest string, block string"
    )
    files = spark.read.format("binaryFile").load(path).select("content")
    return map_rows(files, schema + (", payload binary" if with_payload else ""), start, chunk=1)


def assemble_captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: its own fields, ``request`` and ``metadata`` (a sorted array).

    Links count in either direction. A capture without a request has a null one, without metadata an empty
    array; of several requests the greatest stays. Requests and metadata that no capture is linked to give no
    row, nor do records without an id or a type. Repeated links count once.

    The records are stored once, so archives are read and parsed once; read them without payloads if those are
    not needed. Runs a job.
    """
    records = stage(records, "records").df
    known = records.where(F.col("record_id").isNotNull() & F.col("record_type").isNotNull())
    captures = known.where(F.col("record_type").isin(*CAPTURED))
    others = known.where(~F.col("record_type").isin(*CAPTURED)).select(
        "record_type", "concurrent_to", F.struct("record_id", "target_uri", "block").alias("_record")
    )
    forward = others.select(F.explode("concurrent_to").alias("_of"), "record_type", "_record")
    back = captures.select(F.col("record_id").alias("_of"), F.explode("concurrent_to").alias("_member"))
    backward = back.join(others, F.col("_member") == F.col("_record.record_id")).select(
        "_of", "record_type", "_record"
    )
    linked = (
        forward.unionByName(backward)
        .groupBy("_of")
        .agg(
            F.max(F.when(F.col("record_type") == "request", F.col("_record"))).alias("request"),
            F.sort_array(F.collect_set(F.when(F.col("record_type") == "metadata", F.col("_record")))).alias(
                "metadata"
            ),
        )
    )
    return (
        captures.drop("concurrent_to", "block")
        .join(linked, F.col("record_id") == F.col("_of"), "left")
        .withColumn("metadata", F.coalesce("metadata", F.array().cast(linked.schema["metadata"].dataType)))
        .drop("_of")
    )


def metadata_field(name: str) -> Column:
    """The value of a field in the metadata records of an assembled capture; null if there is none."""
    whole = F.array_join(F.transform("metadata", lambda m: m["block"]), BREAK)
    value = F.regexp_extract(whole, rf"(?m)^{name}: (.*?)\r?$", 1)
    return F.when(value != "", value)
