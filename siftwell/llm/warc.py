"""A content-addressed WARC archive.

An archive is two Parquet tables in the shared folder: ``payloads`` (each distinct payload's bytes
once, under its SHA-256) and ``headers`` (every record's exact header bytes and the address of its
payload).  Reading joins them, and verifies each payload against its address before anything is
derived from it; a mismatch fails the read.

Of records with equal payloads of at least ``least`` bytes, that with the largest page_id is the
response and the others are revisits that refer to it; smaller ones are all responses.  All rows that
repeat that page_id are responses.  Null html is the empty payload; a null url an empty one; control
characters can't enter a header.  Extra columns are ignored.

A page_id may repeat with different payloads: what is stored goes by page_id and address.  Reading
fails where a record's payload is missing.

Only addresses are aggregated and joined with headers (a group of copies is one address, combined
before the shuffle); payload bytes move once, to drop those that are stored already, and not at all
when the list of those is small enough to broadcast.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siftwell.llm.common import let, shared_dir, stored

DATE = "2000-01-01T00:00:00Z"
#: Rows (of a page_id and an address) that may be broadcast.
BROADCAST = 200_000


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of 40 hex digits: five of them are four base32 digits."""
    parts = [F.lpad(F.conv(F.substring(hexadecimal, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


@dataclass
class Archive:
    path: str

    @property
    def headers(self) -> str:
        return f"{self.path}/headers"

    @property
    def payloads(self) -> str:
        return f"{self.path}/payloads"


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))


def write(pages: DataFrame, least: int = 0, path: str | None = None) -> Archive:
    """Archive the rows (page_id, url, html) of ``pages``."""
    spark = pages.sparkSession
    archive = Archive(path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    keyed = stored(rows.select("page_id", "url", F.sha2("payload", 256).alias("address"), base32(F.sha1("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("n")), "addresses")
    first = keyed.groupBy("address").agg(F.max("page_id").alias("response_id"), F.count("*").alias("copies"))

    known = keyed.join(first, "address")
    revisit = (F.col("n") >= least) & (F.col("page_id") < F.col("response_id"))
    clean = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))

    def header(http: Column) -> Column:
        lines = [
            F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
            F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
            F.lit(f"WARC-Date: {DATE}"),
            F.concat(F.lit("WARC-Target-URI: "), clean),
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
            F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("response_id")))),
            F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            F.lit("Content-Type: application/http; msgtype=response"),
            F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("n"))).cast("string")),
        ]
        return F.concat(F.lit("WARC/1.1\r\n"), F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), http).cast("binary")

    known.select("page_id", "url", "address", let(http, header).alias("header")).write.option("compression", "zstd").parquet(archive.headers)

    # payloads of rows that another row of the same address stores are left out
    spare = stored(known.where(F.col("page_id") < F.col("response_id")).select("page_id", "address").distinct(), "spare")
    if spare.count() <= BROADCAST:
        spare = F.broadcast(spare)
    addressed = rows.select("page_id", F.sha2("payload", 256).alias("address"), "payload")
    kept = addressed.join(spare, ["page_id", "address"], "left_anti").select("address", "payload")
    kept.write.option("compression", "zstd").parquet(archive.payloads)
    return archive


def verified_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """(address, payload), each checked against its address."""
    stored_payloads = spark.read.schema("address string, payload binary").parquet(archive.payloads)
    sound = F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload does not match its address "), F.col("address"))))
    return stored_payloads.select("address", sound.alias("payload"))


def read_headers(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record's header, parsed from its bytes."""
    headers = spark.read.schema("page_id long, url string, address string, header binary").parquet(archive.headers)
    text = F.decode("header", "UTF-8")
    line = lambda name: F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    page = lambda name: F.regexp_extract(line(name), r"^<urn:page:(-?\d+)>$", 1)
    return headers.select(
        page("WARC-Record-ID").try_cast("long").alias("page_id"), "url", "address", "header",
        line("WARC-Type").alias("record_type"),
        F.regexp_extract(line("WARC-Payload-Digest"), "^sha1:(.*)$", 1).alias("header_digest"),
        F.nullif(page("WARC-Refers-To"), F.lit("")).try_cast("long").alias("refers_to"),
    )


def _held(found: Column, value: Column) -> Column:
    """``value`` where the record's payload was found; the read fails where it wasn't."""
    return F.when(found.isNotNull(), value).otherwise(F.raise_error(F.concat(F.lit("no payload is stored under the address "), F.col("address"))))


def read(spark: SparkSession, archive: Archive) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every record; length
    and digest are those of the stored payload's bytes."""
    facts = verified_payloads(spark, archive).select("address", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest")).distinct()
    found = read_headers(spark, archive).join(facts, "address", "left")
    same = F.when(F.col("payload_digest") == F.col("header_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record's digest is not its payload's")))
    return found.select("page_id", "url", "payload_bytes", _held(F.col("payload_digest"), same).alias("payload_digest"), "record_type", "refers_to")


def records(spark: SparkSession, archive: Archive) -> DataFrame:
    """(page_id, record): the original records, header and block; a revisit's block is its HTTP
    header alone.  Each record ends with two line ends, as in a WARC file."""
    payloads = verified_payloads(spark, archive).dropDuplicates(["address"])
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return read_headers(spark, archive).join(payloads, "address", "left").select("page_id", F.concat("header", _held(F.col("payload"), block), F.lit(b"\r\n\r\n")).alias("record"))
