"""WARC archive with content-addressed payloads.

``write_archive`` stores a crawl as two Parquet tables in one folder:

* ``payloads``: each distinct payload's bytes once, under its SHA-256;
* ``heads``: per page the exact bytes that precede the payload in its WARC
  record (record header, blank line and, for the HTTP block, the HTTP header).

Of pages with equal payloads of at least ``min_revisit`` bytes, those with the
smallest page_id are ``response`` records and the others ``revisit`` records
that refer to it; shorter payloads are always ``response``. ``read_archive``
parses the heads, recomputes every stored payload's digest and length, and
joins the two; ``records`` rebuilds the original records byte for byte.

Scale: payloads collapse map-side before their one shuffle, so a payload that a
third of all pages share costs one row per input task. The joins put one row
per page against one small row per payload (digest, first page), which Spark
can split when one digest is hot; payload bytes are joined only by ``records``.

Defined results: a null html is an empty payload; a null url has no
WARC-Target-URI line (control characters and blanks in a url are percent
encoded). Rows that repeat the smallest page_id and its payload are all
responses. A null page_id is never the first of a group unless all are null.
A digest that does not match its payload, or a head whose payload is missing,
raises an error. Only the three named columns are read. Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally.session import scratch_dir

MIN_REVISIT = 100
# Fixed values of the WARC 1.1 format.
CRLF = "\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRAWL_DATE = "2024-01-01T00:00:00Z"  # the tables carry no capture time; a parameter of write_archive


def _payloads(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    return pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("bigint"))


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _head(date: str) -> Column:
    """Everything of a record that precedes its payload."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    safe_url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"),
                                r"[\x00-\x20\x7F]", "%20")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    return F.concat(
        F.lit(VERSION + CRLF), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_id(F.col("page_id"))), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", safe_url), F.lit("")),
        F.when(revisit, F.concat(line("WARC-Refers-To", _record_id(F.col("first_id"))),
                                 line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")), F.lit(CRLF), http)


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  min_revisit: int = MIN_REVISIT, date: str = CRAWL_DATE) -> str:
    """Write ``pages`` as an archive below ``path``."""
    spark = pages.sparkSession
    rows = _payloads(pages, page_id, url, html)
    (rows.groupBy("digest")
     .agg(F.first("payload").alias("payload"), F.min("page_id").alias("first_id"))
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))
    stored = spark.read.parquet(f"{path}/payloads").select("digest", "first_id")
    first = (F.col("bytes") < min_revisit) | F.col("page_id").eqNullSafe(F.col("first_id"))
    (rows.select("page_id", "url", "digest", "bytes").join(stored, "digest")
     .withColumn("record_type", F.when(first, "response").otherwise("revisit"))
     .select(F.encode(_head(date), "UTF-8").alias("head"))
     .write.option("compression", "zstd").parquet(f"{path}/heads"))
    return path


def _field(name: str) -> Column:
    return F.regexp_extract("text", rf"(?:^|\n){name}: ([^\r]*)\r", 1)


def read_heads(spark: SparkSession, path: str) -> DataFrame:
    """The parsed record heads: ``page_id, record_type, refers_to, digest, http_bytes, content_length, head``."""
    # Only the record header is parsed, so nothing in a HTTP header can be mistaken for it.
    text = F.substring_index(F.decode("head", "UTF-8"), CRLF + CRLF, 1)
    heads = spark.read.parquet(f"{path}/heads").select("head", F.concat(text, F.lit(CRLF)).alias("text"))
    parsed = heads.select(
        "head", _field("WARC-Type").alias("record_type"), _field("WARC-Record-ID").alias("_id"),
        _field("WARC-Refers-To").alias("_ref"), _field("WARC-Payload-Digest").alias("_digest"),
        _field("Content-Length").alias("_length"), F.octet_length("text").alias("_head"))
    return parsed.select(
        F.regexp_extract("_id", r"^<urn:x-page:(-?\d+)>$", 1).try_cast("bigint").alias("page_id"), "record_type",
        F.regexp_extract("_ref", r"^<urn:x-page:(-?\d+)>$", 1).try_cast("bigint").alias("refers_to"),
        F.regexp_extract("_digest", r"^sha256:([0-9a-f]{64})$", 1).alias("digest"),
        F.col("_length").try_cast("bigint").alias("content_length"),
        (F.octet_length("head") - F.col("_head") - 2).cast("bigint").alias("http_bytes"), "head")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads with their length; raises when a digest does not match its bytes."""
    true = F.sha2("payload", 256)
    checked = F.when(true == F.col("digest"), F.octet_length("payload").cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest"))).cast("bigint"))
    return spark.read.parquet(f"{path}/payloads").select("digest", "payload", checked.alias("payload_bytes"))


def _resolved(heads: DataFrame, payloads: DataFrame) -> DataFrame:
    """Heads joined to their payloads; every record's lengths must fit its payload."""
    block = F.col("http_bytes") + F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    fits = F.col("payload_bytes").isNotNull() & (F.col("content_length") == block)
    return heads.join(payloads, "digest", "left").withColumn("payload_bytes", F.when(
        fits, F.col("payload_bytes")).otherwise(F.raise_error(
            F.concat(F.lit("record without its payload: "), F.col("digest"))).cast("bigint")))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` per record, verified."""
    rows = _resolved(read_heads(spark, path).drop("head"), read_payloads(spark, path).drop("payload"))
    return rows.select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


def records(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record, payload``: the exact bytes of each WARC record, and the page's full
    payload (a revisit's record holds none of it)."""
    rows = _resolved(read_heads(spark, path), read_payloads(spark, path))
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    end = F.encode(F.lit(CRLF + CRLF), "UTF-8")
    return rows.select("page_id", F.concat("head", body, end).alias("record"), "payload")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a fresh archive in the shared folder and read it back."""
    spark = pages.sparkSession
    return read_archive(spark, write_archive(pages, scratch_dir(spark, "warc")))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 100 OR page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM f
"""
