"""A content-addressed web archive.

Every record has an exact WARC header block of its own; payloads are stored once, under a strong
digest (SHA-256) that is verified when they are written and again when they are read. Records are put
together from both by a join on the digest. Of records with equal payloads, the one with the largest
page_id is the response and the others are revisits that refer to it.

The archive is a folder of two Parquet tables: `headers` (page_id, store_key, header) and `payloads`
(store_key, payload).
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreflow.llm.common import stored, table
from scoreflow.session import scratch_path

MIN_PAYLOAD_BYTES = 0
RECORD_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DIGESTS = T.StructType([
    T.StructField("store_key", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("size", T.LongType()),
])


def _digests(payload: pa.Array) -> pa.Array:
    rows = []
    for value in payload.cast(pa.binary()):
        data = memoryview(value.as_buffer()) if value.is_valid else b""
        rows.append((hashlib.sha256(data).hexdigest(), base64.b32encode(hashlib.sha1(data).digest()).decode(), len(data)))
    columns = list(zip(*rows)) or [[], [], []]
    kinds = (pa.string(), pa.string(), pa.int64())
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], DIGESTS.names)


def digests(payload: Column) -> Column:
    """SHA-256 in hex, SHA-1 in base32 and the number of bytes of each payload; null is empty."""
    return F.arrow_udf(_digests, DIGESTS)(payload)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def _header(kind: Column) -> Column:
    """The header block, down to its empty line, in the order of the format's own examples."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    is_revisit = kind == "revisit"
    # A header line ends at its line break, so an address with one in it is percent-encoded there.
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(RECORD_DATE)),
        F.when(target.isNotNull(), line("WARC-Target-URI", target)).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(is_revisit, line("WARC-Refers-To", _record_id(F.col("owner")))).otherwise(""),
        F.when(is_revisit, line("WARC-Profile", F.lit(REVISIT_PROFILE))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(is_revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
    )


def write_archive(pages: DataFrame, path: str, min_payload_bytes: int = MIN_PAYLOAD_BYTES) -> None:
    """Writes one record for each row of `pages` (page_id, url, html).

    A null html is the empty payload; a null url gives no WARC-Target-URI; rows that repeat a page_id
    are records of their own; a null page_id is never a reason to revisit. Other columns are ignored.
    """
    plain = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    digested = stored(plain.select("page_id", "url", digests(F.col("html")).alias("d")).select("page_id", "url", "d.*"), "digests")
    owners = stored(digested.groupBy("store_key").agg(
        F.max("page_id").alias("owner"), F.min("digest").alias("low"), F.max("digest").alias("high"),
        F.min("size").alias("least"), F.max("size").alias("most"),
    ), "owners")
    if not owners.where("low <> high or least <> most").isEmpty():
        raise ValueError("two payloads have the same SHA-256")
    joined = digested.join(owners.select("store_key", "owner"), "store_key")
    kind = F.when((F.col("size") >= min_payload_bytes) & (F.col("page_id") < F.col("owner")), "revisit").otherwise("response")
    joined.select("page_id", "store_key", F.encode(_header(kind), "utf-8").alias("header")).write.parquet(f"{path}/headers")
    # The digest is computed where the payload is, and copies meet before the shuffle.
    payloads = plain.select(digests(F.col("html")).getField("store_key").alias("store_key"), F.coalesce("html", F.lit("")).alias("html"))
    payloads.groupBy("store_key").agg(F.first("html").alias("html")).select(
        "store_key", F.encode("html", "utf-8").alias("payload")
    ).write.parquet(f"{path}/payloads")


def _field(name: str) -> Column:
    return F.regexp_extract(F.decode("header", "utf-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """store_key, payload, digest, size of the stored payloads, each verified against its key."""
    payloads = spark.read.parquet(f"{path}/payloads")
    checked = payloads.withColumn("d", digests(F.col("payload")))
    valid = F.when(F.col("d.store_key") != F.col("store_key"), F.raise_error(F.lit("a stored payload does not match its digest")))
    return checked.select(F.coalesce(valid.cast("string"), F.col("store_key")).alias("store_key"), "payload", "d.digest", "d.size")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, header, payload: the original records, revisits with the payload they refer to."""
    headers = spark.read.parquet(f"{path}/headers")
    return headers.join(read_payloads(spark, path).select("store_key", "payload"), "store_key").drop("store_key")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, from headers and verified payloads."""
    headers = spark.read.parquet(f"{path}/headers")
    joined = headers.join(read_payloads(spark, path).drop("payload"), "store_key")
    said = F.substring_index(_field("WARC-Payload-Digest"), "sha1:", -1)
    digest = F.when(said == F.col("digest"), said).otherwise(F.raise_error(F.lit("header and payload have different digests")).cast("string"))
    refers = F.regexp_extract(_field("WARC-Refers-To"), "<urn:page:([^>]*)>", 1)
    id_type = headers.schema["page_id"].dataType
    return joined.select(
        "page_id", F.col("size").alias("payload_bytes"), digest.alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers).cast(id_type).alias("refers_to"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_index(spark, path)
