"""WARC archives with revisit resolution.

Archives are written by Spark's text writer with the record terminator as line separator, one gzip
stream a file, so writes are committed like any table's and survive lost executors. They are read as
binary files and parsed by the lengths in the headers, in a stream. Files hold a bounded number of
records.

Resolution shuffles headers only: the smallest id of each payload digest is the response, the others
revisit it. Payloads are then fetched by record id for the records that stay responses, and archives
are written anew with fresh headers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import keep, lookup, query, table
from clickfeat.workspace import new_path

#: Payloads below this many bytes are always stored.
LEAST_REVISIT_BYTES = 100
RECORDS_PER_FILE = 4000
#: Bytes of payloads that a task hands on at once.
BATCH_BYTES = 4_000_000
TERMINATOR = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORD = (
    "record_id string, record_type string, target_uri string, refers_to string,"
    " payload_digest string, payload_length bigint"
)


def _header(record_type: Column, record_id: Column, uri: Column, digest: Column, extra: Column,
            length: Column) -> Column:
    # A line break in a header field would end it.
    clean = F.regexp_replace(F.coalesce(uri, F.lit("")), r"[\r\n]+", " ")
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), record_type,
        F.lit("\r\nWARC-Record-ID: "), record_id,
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), clean,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), digest,
        extra,
        F.lit("\r\nContent-Type: text/html;charset=utf-8\r\nContent-Length: "),
        length.cast("string"), F.lit("\r\n\r\n"),
    )


def write_archives(records: DataFrame, path: str) -> None:
    """Write ``record_id, record_type, target_uri, refers_to, payload_digest, payload`` to ``path``.

    A revisit has no payload; its header names the record it refers to. Null payloads are empty.
    """
    revisit = F.col("record_type") == "revisit"
    payload = F.when(revisit, "").otherwise(F.coalesce("payload", F.lit("")))
    extra = F.when(
        revisit,
        F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), F.col("refers_to")),
    ).otherwise("")
    record = F.concat(
        _header(
            F.col("record_type"), F.col("record_id"), F.col("target_uri"), F.col("payload_digest"),
            extra, F.octet_length(payload),
        ),
        payload,
    )
    records.select(record.alias("value")).write.option("lineSep", TERMINATOR).option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


class _Stream:
    """Bytes of a gzip file (any number of members) as they are asked for."""

    def __init__(self, content: bytes):
        self.left, self.at = memoryview(content), 0
        self.inflate = zlib.decompressobj(31)
        self.ready = bytearray()

    def _fill(self) -> bool:
        if self.inflate.eof:
            rest = self.inflate.unused_data
            self.left = memoryview(rest + bytes(self.left[self.at :]))
            self.at, self.inflate = 0, zlib.decompressobj(31)
        if self.at >= len(self.left):
            return False
        self.ready += self.inflate.decompress(self.left[self.at : self.at + (1 << 18)])
        self.at += 1 << 18
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the next ``mark``, which is skipped; None at the end."""
        start = 0
        while (found := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark) + 1)
            if not self._fill():
                return None
        got = bytes(self.ready[:found])
        del self.ready[: found + len(mark)]
        return got

    def take(self, n: int) -> bytes:
        while len(self.ready) < n and self._fill():
            pass
        got = bytes(self.ready[:n])
        if len(got) < n:
            raise ValueError("a record is cut off")
        del self.ready[:n]
        return got


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and payload of each record of a gzip archive."""
    stream = _Stream(content)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        version, *fields = head.decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        pairs = (f.partition(":") for f in fields)
        header = {name.lower(): value.strip() for name, _, value in pairs}
        yield header, stream.take(int(header["content-length"]))
        stream.take(4)


def _reader(with_payload: bool):
    columns = [part.split()[0] for part in RECORD.split(", ")] + (["payload"] if with_payload else [])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for header, payload in parse_archive(content):
                    kind = header["warc-type"]
                    rows.append(
                        (
                            header["warc-record-id"],
                            kind,
                            header.get("warc-target-uri"),
                            header.get("warc-refers-to"),
                            header["warc-payload-digest"].partition(":")[2],
                            None if kind == "revisit" else len(payload),
                        )
                        + ((payload.decode("utf-8"),) if with_payload else ())
                    )
                    size += len(payload) + 200
                    if size > BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return read


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives at ``path``: :data:`RECORD`, and ``payload`` if asked."""
    # One file in a batch: a task holds a compressed archive and a few payloads.
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = RECORD + (", payload string" if with_payload else "")
    return files.mapInPandas(_reader(with_payload), schema)


def page_records(
    pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """A response record for each row: the id as a URN, null html as an empty payload.

    Ids should tell rows apart. Rows with a null or repeated id share a record id; of those, records with
    equal payloads are resolved alike, so each still has its record.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    return pages.select(
        F.format_string(
            "<urn:page:%s>", F.coalesce(F.col(id_col).cast("string"), F.lit(""))
        ).alias("record_id"),
        F.lit("response").alias("record_type"),
        F.col(uri_col).alias("target_uri"),
        F.lit(None).cast("string").alias("refers_to"),
        F.sha2(payload, 256).alias("payload_digest"),
        payload.alias("payload"),
    )


def page_id(record_id: Column) -> Column:
    """The number in a record id of :func:`page_records`; null where there is none."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")


def resolve_revisits(headers: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """``record_id, payload_digest, record_type, refers_to``: what each record should be.

    One row for each pair of id and digest. Only digests that occur twice with ``least`` bytes or more are looked up, and a digest with many
    records does not gather in one task.
    """
    order = F.struct(page_id(F.col("record_id")).alias("n"), F.col("record_id").alias("r"))
    headers = keep(
        headers.select("record_id", "payload_digest", "payload_length").dropDuplicates(
            ["record_id", "payload_digest"]
        ),
        "distinct-headers",
    )
    long = headers.filter(F.col("payload_length") >= least)
    originals = keep(
        long.groupBy("payload_digest")
        .agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .select(F.col("payload_digest").alias("_key"), F.col("_first.r").alias("_original"), "_n"),
        "originals",
    )
    tagged = headers.select(
        "record_id",
        "payload_digest",
        F.when(F.col("payload_length") >= least, F.col("payload_digest"))
        .otherwise(F.concat(F.lit("short "), F.col("record_id")))
        .alias("_key"),
    )
    found = lookup(tagged, originals, ["_key"], "_n")
    again = F.col("_original") != F.col("record_id")
    return found.select(
        "record_id",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_original")).alias("refers_to"),
    )


def deduplicate_archives(
    spark: SparkSession, source: str, target: str, least: int = LEAST_REVISIT_BYTES
) -> None:
    """Read the archives at ``source`` and write them to ``target`` with revisits resolved."""
    headers = keep(read_archives(spark, source, with_payload=False), "headers")
    decided = resolve_revisits(headers, least)
    records = read_archives(spark, source).drop("record_type", "refers_to")
    write_archives(records.join(decided, ["record_id", "payload_digest"]), target)


def full_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Headers of the archives at ``path``, with a revisit's ``payload_length`` that of its response.

    A revisit whose response isn't there keeps a null length.
    """
    headers = keep(read_archives(spark, path, with_payload=False), "headers")
    responses = headers.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("payload_length").alias("_length")
    )
    referred = (
        headers.filter("record_type = 'revisit'").groupBy("refers_to").agg(F.count("*").alias("_n"))
    )
    responses = responses.dropDuplicates(["refers_to"])
    known = keep(referred.join(responses, "refers_to", "left"), "referred")
    revisits = lookup(headers.filter("record_type = 'revisit'"), known, ["refers_to"], "_n")
    whole = revisits.withColumn("payload_length", F.col("_length")).select(headers.columns)
    return headers.filter("record_type <> 'revisit'").unionByName(whole)


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM s)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM f""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured, resolved = new_path(spark, "captured"), new_path(spark, "resolved")
    write_archives(page_records(table(spark, sf_dir, "pages")), captured)
    deduplicate_archives(spark, captured, resolved)
    return full_payloads(spark, resolved).select(
        page_id(F.col("record_id")).alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page_id(F.col("refers_to")).alias("refers_to"),
    )
