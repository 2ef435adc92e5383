"""WARC: content-addressed archive.

An archive is two Parquet tables in a shared folder: `payloads` keeps the bytes of every distinct payload once under
their SHA-256, `headers` the exact header bytes of every record.  `read_archive` checks each stored payload against its
digest and joins both to the original records.  Equal payloads of `revisit_bytes` or more have one response
record, the one with the smallest id; the others are revisit records that refer to it and carry no block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

REVISIT_BYTES = 100

# Record format of WARC/1.1 (ISO 28500:2017).
END = "\r\n"
ID_PREFIX = "urn:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(END))


def _record_id(key: Column) -> Column:
    return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def _header(date: str) -> Column:
    """Header bytes from key, url, digest, bytes and first, the key of the response (null: none)."""
    revisit = F.col("revisits")
    # a target is one header line: line ends in it are written as %0D and %0A
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("key"))),
        F.when(F.col("url").isNotNull(), _line("WARC-Target-URI", target)).otherwise(F.lit("")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(
            _line("WARC-Refers-To", _record_id(F.col("first"))), _line("WARC-Profile", F.lit(REVISIT_PROFILE))
        )).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(END),
    ).cast("binary")


def write_archive(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html",
    revisit_bytes: int = REVISIT_BYTES, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write both tables below `path`.

    A null body is an empty payload, a null url writes no target line, records with a null key are written with an
    empty id and revisit like any other.  Rows repeated with the same key and body are each a response.  Other
    columns, whatever their names, are not archived.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit("").cast("binary"))
    records = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), payload.alias("payload")).withColumns({
        "digest": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long")
    })
    # equal digests are equal bytes, so the first payload stands for all; combined before the shuffle
    stored = records.groupBy("digest").agg(F.min("key").alias("first"), F.first("payload").alias("payload"))
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")
    first = pages.sparkSession.read.schema(stored.schema).parquet(f"{path}/payloads").select("digest", "first")
    revisits = (F.col("bytes") >= revisit_bytes) & F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    headers = records.drop("payload").join(first, "digest").withColumn("revisits", revisits)
    headers.select("digest", _header(date).alias("header")).write.option("compression", "zstd").parquet(f"{path}/headers")


def _field(name: str) -> Column:
    return F.regexp_extract("text", rf"\r\n{name}: ([^\r]*)\r\n", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: record_id, record_type, target_uri, refers_to, payload_digest, payload_bytes, intact,
    header, payload and `record`, the record's original bytes.

    `payload_digest` and `payload_bytes` are computed from the stored bytes; `intact` tells whether they agree with the
    header.  Revisit records have the payload of the record they refer to, their `record` has no block.
    """
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads").select(
        "digest", "payload", F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    headers = spark.read.schema("digest string, header binary").parquet(f"{path}/headers")
    identity = rf"<{ID_PREFIX}([^>]*)>"
    parsed = headers.withColumn("text", F.decode("header", "UTF-8")).select(
        "digest", "header",
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract(_field("WARC-Record-ID"), identity, 1).alias("record_id"),
        _field("WARC-Target-URI").alias("target_uri"),
        F.nullif(F.regexp_extract(_field("WARC-Refers-To"), identity, 1), F.lit("")).alias("refers_to"),
        _field("WARC-Payload-Digest").alias("claimed"), _field("Content-Length").cast("long").alias("length"),
    )
    responds = F.col("record_type") == "response"
    block = F.when(responds, F.col("payload")).otherwise(F.lit("").cast("binary"))
    return parsed.join(payloads, "digest").select(
        "record_id", "record_type", "target_uri", "refers_to", "payload_digest", "payload_bytes",
        ((F.col("claimed") == F.concat(F.lit("sha256:"), F.col("payload_digest")))
         & (F.col("length") == F.when(responds, F.col("payload_bytes")).otherwise(0))).alias("intact"),
        "header", "payload", F.concat("header", block, F.lit(END * 2).cast("binary")).alias("record"),
    )
