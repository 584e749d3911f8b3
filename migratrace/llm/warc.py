"""A content-addressed archive of WARC records: payloads once by digest, exact headers apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from migratrace.session import materialize

MIN_BYTES = 0
#: Fixed values of the file format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: The digits that Spark's conv and the base32 alphabet use.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: 160 bits are four groups of 40 bits, eight digits each."""
    hexes = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexes, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def _line(name: str, value: Column) -> Column:
    """A header line; no line where the value is null.  Line breaks in it are escaped, as a URI has none."""
    clean = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_archive(
    pages: DataFrame,
    folder: str,
    *,
    key: str = "page_id",
    uri: str = "url",
    body: str = "html",
    min_bytes: int = MIN_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Archive a WARC record per row of ``pages`` under ``folder``.

    ``folder/payloads`` holds (address, payload): the UTF-8 bytes of ``body``
    (null: empty), once per SHA-256.  ``folder/records`` holds (key, header,
    address, carries): the exact bytes of the record before its payload, and
    whether the payload stands in the record.  Of the records with equal
    payloads of at least ``min_bytes`` bytes, that with the largest key is a
    response and the others revisit it; smaller payloads are all responses.

    An address is verified: all payloads under it must agree in length, SHA-1
    and a third hash, else the write stops.  Copies are reduced before the
    shuffle, and headers are joined by digests only, so a payload that a third
    of the rows share moves once per task.  A null key is smaller than all
    others; rows that repeat key and payload are the same kind of record; an
    empty table gives an empty archive; other columns are not read.
    """
    payload = F.coalesce(pages[body].cast("binary"), F.lit(b""))
    rows = pages.select(pages[key].cast("long").alias("key"), pages[uri].cast("string").alias("uri"), payload.alias("payload"))
    addressed = rows.withColumn("address", F.unhex(F.sha2("payload", 256)))
    addressed.select("address", "payload").dropDuplicates(["address"]).write.parquet(f"{folder}/payloads")

    sums = addressed.select(
        "key", "uri", "address", F.octet_length("payload").cast("long").alias("bytes"),
        base32_sha1(F.col("payload")).alias("sha1"), F.xxhash64("payload").alias("third"),
    )
    sums = materialize(sums, "digests")
    facts = F.struct("bytes", "sha1", "third")
    owners = sums.groupBy("address").agg(F.max("key").alias("owner"), F.min(facts).alias("low"), F.max(facts).alias("high"))
    checked = F.when(F.col("low") == F.col("high"), F.col("owner")).otherwise(F.raise_error(F.lit("payloads of one digest differ")))
    owners = materialize(owners.select("address", checked.alias("owner")), "owners")
    records = sums.join(owners, "address")
    carries = (F.col("bytes") < min_bytes) | F.col("owner").isNull() | F.coalesce(F.col("key") == F.col("owner"), F.lit(False))
    records = records.withColumn("carries", carries)
    size = F.lit(len(_HTTP)) + F.when(F.col("carries"), F.col("bytes")).otherwise(0)
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", F.when(F.col("carries"), "response").otherwise("revisit")),
        _line("WARC-Record-ID", _record_id(F.col("key"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Profile", F.when(~F.col("carries"), F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(~F.col("carries"), _record_id(F.col("owner")))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", size.cast("string")),
        F.lit("\r\n"),
        F.lit(_HTTP),
    )
    records.select("key", header.cast("binary").alias("header"), "address", "carries").write.parquet(f"{folder}/records")


def _record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("none")), F.lit(">"))


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """(address, payload) of an archive; a payload that does not match its address stops the read."""
    stored = spark.read.schema("address binary, payload binary").parquet(f"{folder}/payloads")
    fits = F.unhex(F.sha2("payload", 256)) == F.col("address")
    return stored.select("address", F.when(fits, F.col("payload")).otherwise(F.raise_error(F.lit("a payload is damaged"))).alias("payload"))


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """(key, header, address, carries) and what the header says: record_type, payload_digest, refers_to."""
    records = spark.read.schema("key long, header binary, address binary, carries boolean").parquet(f"{folder}/records")
    text = F.col("header").cast("string")

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))

    refers = F.regexp_extract(F.coalesce(field("WARC-Refers-To"), F.lit("")), r"^<urn:page:(-?\d+)>$", 1)
    return records.select(
        "*",
        field("WARC-Type").alias("record_type"),
        F.regexp_extract(field("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("payload_digest"),
        F.nullif(refers, F.lit("")).cast("long").alias("refers_to"),
    )


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The archive's records: key, record (the original bytes), payload (a revisit's is that it refers to)."""
    joined = read_headers(spark, folder).join(read_payloads(spark, folder), "address")
    inner = F.when(F.col("carries"), F.col("payload")).otherwise(F.lit(b""))
    record = F.concat(F.col("header"), inner, F.lit(END.encode()))
    return joined.select("key", "record_type", "payload_digest", "refers_to", record.alias("record"), "payload")


def export_warc(spark: SparkSession, folder: str, out: str) -> None:
    """Write the archive as plain WARC files; each record ends with two line breaks, which separate the rows."""
    body = F.expr(f"substring(record, 1, octet_length(record) - {len(END)})")
    read_records(spark, folder).select(body.cast("string").alias("value")).write.option("lineSep", END).text(out)


def archive_report(spark: SparkSession, folder: str, *, key: str = "page_id") -> DataFrame:
    """Per record: key, payload_bytes and payload_digest of the full stored payload, record_type, refers_to.

    Stored payloads are digested once each and joined to the records by
    address; a record whose header names another digest stops the read.
    """
    facts = read_payloads(spark, folder).select(
        "address", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("found")
    )
    joined = read_headers(spark, folder).join(facts, "address")
    digest = F.when(F.col("found") == F.col("payload_digest"), F.col("found")).otherwise(
        F.raise_error(F.lit("a header names another payload"))
    )
    return joined.select(F.col("key").alias(key), "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
