"""Content-addressed WARC archive.

Two Parquet tables make an archive: ``payloads`` holds every distinct payload
once under its SHA-256 (compressed, as WARC files usually are), ``headers`` the
exact header text of every record with the digest of its payload. Original
records come back through a join of the two.
"""

import base64
import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm.frames import scratch_folder

_DATE = "1970-01-01T00:00:00Z"
_LIGHT = "page_id long, url string, digest binary, sha1 string, payload_bytes long"
_LIGHT_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.binary()), ("sha1", pa.string()), ("payload_bytes", pa.int64())]
)
_BODY_SCHEMA = pa.schema([("digest", pa.binary()), ("sha1", pa.string()), ("body", pa.binary())])
_HEADERS = "header string, digest binary"
_PAYLOADS = "digest binary, body binary"
_RECORDS = "header string, payload binary"
_READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _payloads(batch):
    for html in batch.column("html"):
        yield b"" if not html.is_valid else html.as_buffer().to_pybytes()


def _light(batches):
    for batch in batches:
        payloads = list(_payloads(batch))
        columns = [
            batch.column("page_id"),
            batch.column("url"),
            pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()),
            pa.array([_sha1(p) for p in payloads], pa.string()),
            pa.array([len(p) for p in payloads], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_LIGHT_SCHEMA)


def _bodies(batches):
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        payloads = list(_payloads(batch))
        columns = [
            pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary()),
            pa.array([_sha1(p) for p in payloads], pa.string()),
            pa.array([packer.compress(p) for p in payloads], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_BODY_SCHEMA)


def _unpacked(batches):
    """(header, payload) of every record, each payload checked against its digest."""
    reader = zstandard.ZstdDecompressor()
    for batch in batches:
        headers, digests, bodies = (batch.column(n).to_pylist() for n in ("header", "digest", "body"))
        for start in range(0, len(headers), 64):
            payloads = [reader.decompress(b) for b in bodies[start : start + 64]]
            for payload, digest in zip(payloads, digests[start:]):
                if hashlib.sha256(payload).digest() != digest:
                    raise ValueError(f"payload {digest.hex()} differs from its digest")
            yield pa.RecordBatch.from_arrays(
                [pa.array(headers[start : start + 64], pa.string()), pa.array(payloads, pa.binary())],
                names=["header", "payload"],
            )


def _page_of(field: str | None):
    name = field.removeprefix("<urn:page:").removesuffix(">") if field else "null"
    return None if name == "null" else int(name)


def _parsed(batches):
    """What each record says of itself, size and digest taken from its payload."""
    for batch in batches:
        rows = []
        for header, payload in zip(batch.column("header").to_pylist(), batch.column("payload")):
            payload = payload.as_buffer().to_pybytes()
            fields = dict(line.split(": ", 1) for line in header.split("\r\n")[1:] if line)
            if int(fields["Content-Length"]) != len(payload):
                raise ValueError(f"{fields['WARC-Record-ID']}: payload of another length")
            kind, digest = fields["WARC-Type"], _sha1(payload)
            if fields["WARC-Payload-Digest"] != f"sha1:{digest}":
                raise ValueError(f"{fields['WARC-Record-ID']}: payload of another digest")
            refers = _page_of(fields.get("WARC-Refers-To")) if kind == "revisit" else None
            rows.append((_page_of(fields["WARC-Record-ID"]), len(payload), digest, kind, refers))
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        columns = zip(*rows) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _header(kind, refers) -> Column:
    """Header text; line ends inside a URL are percent-encoded, a null URL is left out."""
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", name(F.col("page_id"))),
        line("WARC-Date", F.lit(_DATE)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(kind == "revisit", line("WARC-Refers-To", name(refers))).otherwise(""),
        line("Content-Length", F.col("payload_bytes").cast("string")),
    )


def write_archive(pages: DataFrame, folder: str, min_payload: int = 0) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) below ``folder``.

    Among records with equal payloads of at least ``min_payload`` bytes the one
    with the largest page_id is a response and the others revisit it; smaller
    payloads are all responses. A null html is an empty payload. Rows repeated
    under the largest page_id are all responses; a null page_id is the smallest,
    and a group of null ids only is all responses. Other columns are ignored.
    """
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html"
    )
    bodies = pages.select("html").mapInArrow(_bodies, "digest binary, sha1 string, body binary")
    stored_once = bodies.groupBy("digest").agg(
        F.first("body").alias("body"), F.min("sha1").alias("one"), F.max("sha1").alias("other")
    )
    # Equal SHA-256 must mean equal SHA-1, or two payloads share one address.
    checked = F.when(F.col("one") == F.col("other"), F.col("body")).otherwise(
        F.raise_error(F.lit("two payloads under one digest")).cast("binary")
    )
    stored_once.select("digest", checked.alias("body")).write.mode("overwrite").option(
        "compression", "uncompressed"
    ).parquet(f"{folder}/payloads")

    light = pages.mapInArrow(_light, _LIGHT)
    largest = light.groupBy("digest").agg(F.max("page_id").alias("largest"))
    records = light.join(largest, "digest")
    alone = (F.col("payload_bytes") < min_payload) | F.col("largest").isNull()
    response = alone | F.col("page_id").eqNullSafe(F.col("largest"))
    kind = F.when(response, "response").otherwise("revisit")
    header = _header(kind, F.col("largest"))
    records.select(header.alias("header"), "digest").write.mode("overwrite").option(
        "compression", "zstd"
    ).parquet(f"{folder}/headers")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """header and payload of every record, rebuilt by a join and verified."""
    headers = spark.read.schema(_HEADERS).parquet(f"{folder}/headers")
    payloads = spark.read.schema(_PAYLOADS).parquet(f"{folder}/payloads")
    return headers.join(payloads, "digest", "left").mapInArrow(_unpacked, _RECORDS)


def record_digests(records: DataFrame) -> DataFrame:
    """Page, size, digest, type and target of records as ``read_archive`` gives them."""
    return records.mapInArrow(_parsed, _READ)


def archive_round_trip(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    spark = pages.sparkSession
    folder = scratch_folder(spark, "warc")
    write_archive(pages, folder, min_payload)
    return record_digests(read_archive(spark, folder))
