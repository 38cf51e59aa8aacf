"""Content-addressed WARC archive.

An archive is two tables in one folder. ``payloads`` holds the bytes of each payload once,
under their SHA-256; ``headers`` holds one exact record header per capture, with the fields
that WARC 1.1 asks for. Records are put together again by a join on the digest, and the digests
of what was stored and of what was put together are computed anew while reading; a missing
payload is an error. Both tables are written and read by Spark alone.

An address with a line break can't stand in a header line: its line breaks are percent-coded,
and the exact address is in a field of its own (``X-Target-URI``).

Defined results: NULL payload is empty, NULL ids and addresses are written as absent header
fields, payloads under ``min_revisit`` bytes are always responses, of repeated rows with the
smallest id the first written is the response, extra columns are ignored, an empty table
gives an empty archive.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from railcadence.llm.common import staged

MIN_REVISIT = 100
CRLF = "\r\n"


def _line(name: str, value: Column) -> Column:
    """A header line; absent when the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _one_line(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _exact(value: Column) -> Column:
    """On one line and reversible; see :func:`_plain`."""
    return _one_line(F.replace(value, F.lit("%"), F.lit("%25")))


def _plain(value: Column) -> Column:
    return F.replace(F.replace(F.replace(value, F.lit("%0A"), F.lit("\n")), F.lit("%0D"), F.lit("\r")), F.lit("%25"), F.lit("%"))


def _read_field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.contains(header, F.lit(f"{CRLF}{name}: ")), found)


def _record_id(archive: str, at: Column) -> Column:
    h = F.md5(F.concat(F.lit(f"{archive}:"), at.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    min_revisit: int = MIN_REVISIT, date_col: str | None = None,
) -> None:
    """Write one record per row. Equal payloads of ``min_revisit`` bytes or more: the one
    with the smallest id is the response, the others are revisits that refer to it.
    ``date_col`` has the instants of capture; rows without one carry the time of writing."""
    archive, now = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    date = F.lit(now)
    if date_col:
        utc = F.to_utc_timestamp(F.col(date_col).cast("timestamp"), F.current_timezone())
        date = F.coalesce(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"), date)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("n"), date.alias("date"),
    )
    # Equal payloads meet once per task already, before anything is sent.
    rows.groupBy("digest").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")

    captures = staged(
        rows.select("id", "url", "digest", "n", "date", F.monotonically_increasing_id().alias("at")), "captures"
    )
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("at"))
    first = (
        captures.where(F.col("n") >= min_revisit).groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("copies")).where("copies > 1")
        .select("digest", "first")
    )
    revisit = F.coalesce(F.col("first.at") != F.col("at"), F.lit(False))
    headers = captures.join(first, "digest", "left").select(
        F.concat(
            F.lit(f"WARC/1.1{CRLF}"),
            _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            _line("WARC-Record-ID", _record_id(archive, F.col("at"))),
            _line("WARC-Date", F.col("date")),
            _line("WARC-Target-URI", _one_line(F.col("url"))),
            F.when(F.col("url").rlike(r"[\r\n]"), _line("X-Target-URI", _exact(F.col("url")))).otherwise(""),
            _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            F.when(revisit, _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(""),
            F.when(revisit, _line("WARC-Refers-To", _record_id(archive, F.col("first.at")))).otherwise(""),
            F.when(revisit, _line("X-Refers-To-Page", _exact(F.col("first.id").cast("string")))).otherwise(""),
            _line("X-Page", _exact(F.col("id").cast("string"))),
            F.when(revisit, "").otherwise(_line("Content-Type", F.lit("text/html; charset=utf-8"))),
            _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string")),
            F.lit(CRLF),
        ).alias("header"),
    )
    headers.write.parquet(f"{path}/headers")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """The record headers with their fields parsed."""
    h = F.col("header")
    return spark.read.schema("header string").parquet(f"{path}/headers").select(
        h,
        _plain(_read_field(h, "X-Page")).alias("page"),
        F.coalesce(_plain(_read_field(h, "X-Target-URI")), _read_field(h, "WARC-Target-URI")).alias("url"),
        _read_field(h, "WARC-Type").alias("record_type"), _plain(_read_field(h, "X-Refers-To-Page")).alias("refers_to"),
        F.replace(_read_field(h, "WARC-Payload-Digest"), F.lit("sha256:"), F.lit("")).alias("digest"),
        _read_field(h, "Content-Length").cast("long").alias("content_length"),
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads; reading stops with an error where bytes and digest disagree."""
    stored = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    found = F.sha2("payload", 256)
    checked = F.when(found == F.col("digest"), found).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest")))
    )
    return stored.select(checked.alias("digest"), "payload")


def _with_payloads(headers: DataFrame, stored: DataFrame, found: str) -> DataFrame:
    """The record headers, each beside column ``found`` of its payload; reading stops with an
    error where a header's payload isn't stored."""
    lost = F.raise_error(F.concat(F.lit("missing payload "), F.coalesce("digest", F.lit(""))))
    kind = stored.schema[found].dataType
    return headers.join(stored, "digest", "left").withColumn(
        found, F.when(F.col(found).isNull(), lost.cast(kind)).otherwise(F.col(found))
    )


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record with the size of its full payload; payload bytes don't move."""
    sizes = read_payloads(spark, path).select("digest", F.octet_length("payload").cast("long").alias("payload_bytes"))
    return _with_payloads(read_headers(spark, path), sizes, "payload_bytes")


def _records(headers: DataFrame, stored: DataFrame) -> DataFrame:
    end = F.lit(b"\r\n\r\n")
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    header = F.encode("header", "UTF-8")
    return _with_payloads(headers, stored, "payload").select(
        "page", "url", "record_type", "refers_to", "digest", "content_length",
        F.octet_length(header).alias("header_bytes"), F.concat(header, body, end).alias("record"), "payload",
    )


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """Whole records as bytes (``record``): a revisit has a header only, and the payload it
    stands for beside it (``payload``). The header has ``header_bytes``."""
    return _records(read_headers(spark, path), read_payloads(spark, path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record put together again, with size and digest of its full payload as
    found there. A response's is cut out of its record by the lengths. A revisit has no
    payload: it takes what was found in the response it stands for, so payloads move to
    responses only. Reading stops with an error where a record differs from its header."""
    headers = read_headers(spark, path)
    names = ["page", "url", "record_type", "refers_to", "payload_bytes", "digest"]
    body = F.expr("substring(record, header_bytes + 1, octet_length(record) - header_bytes - 4)")
    fits = (F.octet_length("body") == F.col("content_length")) & (F.col("found") == F.col("digest"))
    whole = _records(headers.where("record_type = 'response'"), read_payloads(spark, path))
    responses = staged(whole.withColumn("body", body).withColumn("found", F.sha2("body", 256)).select(
        "page", "url", "record_type", "refers_to", F.octet_length("body").cast("long").alias("payload_bytes"),
        F.when(fits, F.col("found")).otherwise(
            F.raise_error(F.concat(F.lit("damaged record of payload "), F.col("digest")))
        ).alias("digest"),
    ), "responses")
    sizes = responses.groupBy("digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = headers.where("record_type = 'revisit'").withColumn(
        "content_length", F.when(F.col("content_length") == 0, F.lit(0)).otherwise(F.raise_error(F.lit("a revisit has content")))
    ).where("content_length = 0")
    return responses.select(*names).union(_with_payloads(revisits, sizes, "payload_bytes").select(*names))
