"""Content-addressed WARC archive.

An archive is two tables in one folder. ``payloads`` holds the bytes of each
distinct payload once, under its SHA-256; ``headers`` holds the exact header
block of every record, with the digest of the payload it belongs to. A
record is rebuilt by joining the two: header block, blank line, block (the
payload of a response, nothing for a revisit), two line ends.

Equal payloads are put together before the shuffle, so a payload that a third
of all records share crosses it once for each task. Reading verifies each
stored payload once against its address.

Defined results: a null payload counts as the empty one; a null id is
smaller than any other and becomes an empty field; of repeated rows with the
largest id all are responses, stored once; payloads shorter than the revisit
bound are responses each; an empty table makes an empty archive; only the
named columns are read, so others cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelink.session import scratch_dir

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LINE = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_REVISIT_BYTES = 0
# Records carry this date unless a date column is given.
NO_DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: eight groups of four letters, 20 bits each."""
    digest = F.sha1(payload)
    groups = [F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int") for k in range(8)]
    letters = [F.substring(F.lit(BASE32), F.shiftright(g, s).bitwiseAND(31) + 1, F.lit(1))
               for g in groups for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def record_uri(record_id: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">"))


@dataclass(frozen=True)
class Archive:
    """Where an archive's two tables are."""

    path: str

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/payloads")

    def headers(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/headers")


def write_archive(records: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", date_col: str | None = None,
                  min_revisit_bytes: int = MIN_REVISIT_BYTES) -> Archive:
    """Write one record per row; the folder is a fresh shared one by default."""
    spark = records.sparkSession
    archive = Archive(path or scratch_dir(spark, "warc"))
    date = F.col(date_col).cast("string") if date_col else F.lit(None).cast("string")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = records.select(
        F.col(id_col).alias("record_id"), F.coalesce(F.col(url_col), F.lit("")).alias("uri"),
        F.coalesce(date, F.lit(NO_DATE)).alias("date"), payload.alias("payload"))
    facts = rows.select("record_id", "uri", "date", F.sha2("payload", 256).alias("address"),
                        F.octet_length("payload").cast("long").alias("length"), base32_sha1(F.col("payload")).alias("sha1"))
    facts.write.parquet(f"{archive.path}/facts")
    facts = spark.read.parquet(f"{archive.path}/facts")
    # equal payloads meet as one row of each task: one passage of distinct
    # payloads, which also finds the largest id of each
    (rows.groupBy(F.sha2("payload", 256).alias("address"))
     .agg(F.max("record_id").alias("keeper"), F.first("payload").alias("payload"))
     .write.option("compression", "zstd").parquet(f"{archive.path}/payloads"))
    keepers = archive.payloads(spark).select("address", "keeper")

    judged = facts.join(keepers, "address")
    revisit = (F.col("length") >= min_revisit_bytes) & ~F.col("record_id").eqNullSafe(F.col("keeper"))
    refers = F.when(revisit, F.col("keeper"))
    # a line break in a field would end it: such fields are percent-encoded
    target = F.replace(F.replace("uri", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.when(revisit, F.lit(0)).otherwise(F.col("length"))
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), record_uri(F.col("record_id"))),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Date: "), F.col("date")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(F.lit("WARC-Profile: "), F.lit(REVISIT_PROFILE))),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), record_uri(refers))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    header = F.concat(F.concat_ws(LINE, *fields), F.lit(LINE)).cast("binary")
    judged.select("record_id", "address", header.alias("header")).write.parquet(f"{archive.path}/headers")
    return archive


def _field(header: Column, name: str) -> Column:
    """A header field's value; null if the block has no such line."""
    found = F.regexp_extract(header, f"\r\n{name}: ?([^\r\n]*)\r\n", 1)
    return F.when(F.contains(header, F.lit(f"{LINE}{name}:")), found)


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record of an archive, rebuilt by joins and parsed.

    Columns: record_id, record_type, refers_to, target_uri, payload_digest,
    payload_bytes, payload, record (the exact bytes). A stored payload whose
    bytes do not have the SHA-256 it is filed under, a digest that is not the
    header's, or a record without its payload stops the job.
    """
    sound = F.sha2("payload", 256) == F.col("address")
    payloads = archive.payloads(spark).select(
        F.col("address").alias("_a"),
        F.when(sound, F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("damaged payload "), F.col("address")))).alias("payload"))
    payloads = payloads.select("_a", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"),
                               base32_sha1(F.col("payload")).alias("_sha1"))
    headers = archive.headers(spark).withColumn("_h", F.col("header").cast("string"))
    headers = headers.select(
        "record_id", "address", "header", _field(F.col("_h"), "WARC-Type").alias("record_type"),
        F.regexp_extract(_field(F.col("_h"), "WARC-Refers-To"), "<urn:record:(.*)>", 1).alias("refers_to"),
        _field(F.col("_h"), "WARC-Target-URI").alias("target_uri"),
        F.regexp_extract(_field(F.col("_h"), "WARC-Payload-Digest"), "sha1:(.*)", 1).alias("_digest"))
    joined = headers.join(payloads, F.col("address") == F.col("_a"), "left")
    digest = F.when(F.col("_digest") == F.col("_sha1"), F.col("_digest")).otherwise(
        F.raise_error(F.concat(F.lit("no payload with the digest of record "), F.coalesce(F.col("record_id").cast("string"), F.lit("null")))))
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select(
        "record_id", "record_type", F.when(F.col("record_type") == "revisit", F.col("refers_to")).alias("refers_to"),
        "target_uri", digest.alias("payload_digest"), "payload_bytes", "payload",
        F.concat(F.col("header"), F.lit(LINE.encode()), block, F.lit((LINE * 2).encode())).alias("record"))


def block_of(record: Column) -> Column:
    """The block of a record's exact bytes: what stands between its header and
    the two line ends that close it."""
    head = F.octet_length(F.substring_index(record.cast("string"), LINE * 2, 1)) + F.lit(len(LINE * 2))
    return F.substring(record, head + 1, F.octet_length(record) - head - F.lit(len(LINE * 2)))
