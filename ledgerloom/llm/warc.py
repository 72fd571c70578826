"""Content-addressed WARC archive.

An archive is two stored tables. ``payloads`` has the bytes of each different payload once,
under their SHA-256. ``records`` has one row per record: its exact header block (the WARC
header and the HTTP header), its digest and nothing of the payload. ``restore`` checks the
stored bytes against their digests and joins both into the original records; ``write_warc``
lays restored records out as WARC files.

Records with equal payloads of at least ``LEAST`` bytes are one response, that of the largest
page_id, and revisits that refer to it. Which record that is comes from maxima over digests and
page ids alone. A payload that is there once goes straight to its place; the list of digests
that are there more often goes to the payloads while it is short, and payloads move to it, once,
when it is long. Equal payloads never meet: only the keeper's goes on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.shared import broadcast_if_few
from ledgerloom.sources.tables import fresh_folder, store

LEAST = 1000

#: The date in all record headers, as pages carry none.
DATE = "2024-01-01T00:00:00Z"

CRLF = "\r\n"
RECORD_ID = "<urn:x-page:{}>"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _id(page_id: Column) -> Column:
    return F.format_string(RECORD_ID.replace("{}", "%s"), F.coalesce(page_id.cast("string"), F.lit("none")))


def _header(date: str) -> Column:
    """The exact header block of a record, from WARC version to the empty line after the HTTP header."""
    revisit = F.col("record_type") == "revisit"
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            revisit, F.concat(line("WARC-Refers-To", _id(F.col("refers_to"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))
        ).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit(CRLF),
        http,
    )


def _digested(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).select(
        "page_id",
        "url",
        "payload",
        F.unhex(F.sha2("payload", 256)).alias("digest"),
        F.sha1("payload").alias("sha1"),
        F.length("payload").cast("long").alias("payload_bytes"),
    )


class Archive:
    """The stored tables ``records`` and ``payloads`` below a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @property
    def records(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/records")

    @property
    def payloads(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/payloads")

    def restore(self) -> DataFrame:
        """One row per record: ``digest, header, payload, payload_bytes, sha1`` of the payload as stored.

        Stored bytes are digested anew; a payload that is not what its key says, or a record
        whose payload is missing, ends the job.
        """
        checked = self.payloads.select(
            "digest",
            "payload",
            F.length("payload").cast("long").alias("payload_bytes"),
            F.sha1("payload").alias("sha1"),
            (F.unhex(F.sha2("payload", 256)) == F.col("digest")).alias("whole"),
        )
        found = self.records.join(checked, "digest", "left")
        wrong = F.raise_error(F.concat(F.lit("payload missing or damaged: "), F.hex("digest")))
        return found.select(
            "digest",
            F.when(F.coalesce("whole", F.lit(False)), F.col("header")).otherwise(wrong).alias("header"),
            "payload",
            "payload_bytes",
            "sha1",
        )


def write_archive(pages: DataFrame, folder: str | None = None, *, least: int = LEAST, date: str = DATE) -> Archive:
    """Archives one record per row of ``pages`` (page_id, url, html; a null html is empty).

    Rows with equal page_id are records of their own with the same record id; if they have
    equal payloads with the largest page_id, all of them are responses. A null page_id is
    smaller than any other, a null url has no target in its header. Payloads of any length are
    stored whole; no pages give an empty archive. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or fresh_folder(spark, "warc")
    digested = _digested(pages)
    light = digested.select("page_id", "url", "digest", "sha1", "payload_bytes")
    # Most payloads occur once; only the others have a keeper to look up. Counted first and stored,
    # so a payload of many records is split like any other.
    keepers = light.groupBy(F.col("digest").alias("key")).agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    several = broadcast_if_few(store(keepers.where("n > 1").select("key", "keeper"), fresh_folder(spark, "warc-several")))
    response = (F.col("payload_bytes") < least) | F.col("key").isNull() | F.col("page_id").eqNullSafe(F.col("keeper"))
    records = light.join(several, F.col("digest") == F.col("key"), "left").withColumn(
        "record_type", F.when(response, "response").otherwise("revisit")
    )
    records = records.withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("keeper")))
    records.select("digest", _header(date).alias("header")).write.mode("overwrite").option("compression", "zstd").parquet(
        f"{folder}/records"
    )
    # Of digests that occur more often, the keeper's row brings the payload (its first, if rows repeat).
    rows = digested.select("page_id", "digest", "payload")
    found = rows.join(several, F.col("digest") == F.col("key"), "left")
    alone = found.where("key IS NULL").select("digest", "payload")
    if several.limit(1).count():
        kept = found.where(F.col("key").isNotNull() & F.col("page_id").eqNullSafe(F.col("keeper")))
        alone = alone.union(kept.select("digest", "payload").dropDuplicates(["digest"]))
    alone.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/payloads")
    return Archive(spark, folder)


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_archive(archive: Archive) -> DataFrame:
    """Records read back: what their headers say, and size and digest of the payloads as stored.

    A record whose header does not give the stored payload's digest ends the job.
    """
    page = r"^<urn:x-page:(-?\d+)>$"
    restored = archive.restore()
    declared = F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:([0-9a-f]{40})$", 1)
    return restored.select(
        F.regexp_extract(_field("WARC-Record-ID"), page, 1).try_cast("long").alias("page_id"),
        "payload_bytes",
        F.when(declared == F.col("sha1"), F.col("sha1"))
        .otherwise(F.raise_error(F.concat(F.lit("digest differs: "), declared)))
        .alias("payload_digest"),
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract(_field("WARC-Refers-To"), page, 1).try_cast("long").alias("refers_to"),
    )


def write_warc(archive: Archive, folder: str) -> None:
    """Restored records as WARC files, a file for each partition.

    A response is its header and payload, a revisit its header alone; each record ends with
    two line ends, as the format has it.
    """
    body = F.when(_field("WARC-Type") == "revisit", "").otherwise(F.col("payload").cast("string"))
    archive.restore().select(F.concat("header", body).alias("value")).write.mode("overwrite").option(
        "lineSep", CRLF + CRLF
    ).text(folder)
