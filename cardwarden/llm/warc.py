"""WARC archives with revisit records: write, deduplicate by payload digest, read back.

Writing: headers (id, digest, length) are combined per payload digest before any
shuffle; only digests that occur more than once are joined back to the pages, so
a digest that a third of all pages share is one row on the joined side and the
pages are split at will. The page with the largest id of equal payloads becomes
the response, the others become revisit records that name it and carry no
payload. All columns are computed by Spark's own functions.

Files are written by Spark's text writer, one record per row, with the blank
lines that end a record as line separator, and gzip: any store Spark can write
will do. Reading streams each file's pieces in order, joins them again and cuts
records by their Content-Length, so a payload may hold any text, record
boundaries included, and a task holds one record at a time. A gzip file is never
split among tasks.

Defined results: null and empty payloads are the empty payload; repeated rows of
the id that is the response are responses too; a null id is written as
`null`, revisits any page of the same payload that has an id, and is a response
if there is none; a null or broken url is written without its line breaks.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.session import new_folder

END = "\r\n\r\n"
VERSION = "WARC/1.1"
ID = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: four groups of ten hex digits are eight base32 digits each."""
    digest = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """The pages with __bytes, __digest and __refers (null for responses); payloads not null."""
    body = F.coalesce(F.col(payload), F.lit(""))
    told = pages.withColumn(payload, body).withColumn("__bytes", F.octet_length(payload).cast("long"))
    told = told.withColumn("__digest", base32_sha1(F.col(payload).cast("binary")))
    originals = (
        told.filter(F.col("__bytes") >= min_bytes)
        .groupBy("__digest")
        .agg(F.max(key).alias("__first"), F.count(F.lit(1)).alias("__copies"))
        .filter("__copies > 1")
        .select(F.col("__digest").alias("__same"), "__first")
    )
    joined = told.join(originals, F.col("__digest") == F.col("__same"), "left")
    other = F.col("__first").isNotNull() & ~F.col(key).eqNullSafe(F.col("__first"))
    return joined.select(
        *[told[c] for c in pages.columns], "__bytes", "__digest", F.when(other, F.col("__first")).alias("__refers")
    )


def record(key: Column, url: Column, payload: Column, size: Column, digest: Column, refers: Column, date: str) -> Column:
    """The text of one record, without the blank lines that end it."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        size.cast("string"),
        F.lit(END),
    )
    revisit = refers.isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, payload))
    target = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]+", "%20")
    return F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"\r\nWARC-Record-ID: <{ID}"),
        F.coalesce(key.cast("string"), F.lit("null")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        target,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:"),
        digest,
        F.when(
            revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <{ID}"), refers.cast("string"), F.lit(">"))
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )


def write_warc(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    date: str = "2026-01-01T00:00:00Z",
) -> None:
    """Write deduplicated archives (.gz) to a folder any reader of Spark can reach."""
    rows = resolve_revisits(pages, key, payload, min_bytes)
    value = record(
        F.col(key), F.col(url), F.col(payload), F.col("__bytes"), F.col("__digest"), F.col("__refers"), date
    )
    rows.select(value.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(folder)


class RecordCutter:
    """Cuts the byte stream of one archive, which comes in pieces, into records."""

    def __init__(self) -> None:
        self.pieces: list[bytes] = []
        self.size = 0
        self.need = 0

    def add(self, piece: bytes) -> Iterator[dict]:
        self.pieces.append(piece)
        self.size += len(piece)
        while self.size >= max(1, self.need):
            data = b"".join(self.pieces)
            self.pieces, self.need = [data], 0
            head = data.find(END.encode())
            if head <= 0:  # at 0 only behind the last record, where the reader adds a separator
                return
            fields = {}
            for line in data[:head].decode("utf-8").split("\r\n")[1:]:
                name, _, value = line.partition(": ")
                fields[name] = value
            start = head + len(END)
            stop = start + int(fields["Content-Length"])
            if len(data) < stop + len(END):
                self.need = stop + len(END)
                return
            if data[stop : stop + len(END)] != END.encode():
                raise ValueError("a record does not end where its length says")
            block = data[start:stop]
            http, _, payload = block.partition(END.encode())
            fields["payload"] = payload
            fields["http"] = http.decode("utf-8")
            rest = data[stop + len(END) :]
            self.pieces, self.size = [rest], len(rest)
            yield fields


def _id_of(value: str | None) -> int | None:
    bare = value[len(ID) + 1 : -1] if value else "null"
    return None if bare == "null" else int(bare)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload).

    The payload is null for revisits; the digest of every response is checked.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.string()),
        ]
    )

    def row(fields: dict) -> tuple:
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        whole = fields["WARC-Type"] == "response"
        if whole and base64.b32encode(hashlib.sha1(fields["payload"]).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
        return (
            _id_of(fields["WARC-Record-ID"]),
            fields["WARC-Target-URI"],
            fields["WARC-Type"],
            int(fields["http"].rpartition("Content-Length: ")[2]),
            digest,
            _id_of(fields.get("WARC-Refers-To")),
            fields["payload"].decode("utf-8") if whole else None,
        )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, cutter = None, RecordCutter()
        for batch in batches:
            rows, held = [], 0
            for piece, path in zip(batch.column(0), batch.column(1)):
                if (at := path.as_py()) != file:
                    file, cutter = at, RecordCutter()
                for fields in cutter.add(piece.as_py().encode("utf-8") + END.encode()):
                    rows.append(row(fields))
                    held += len(fields["payload"])
                if held > 16 << 20:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                    rows, held = [], 0
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    lines = spark.read.option("lineSep", END).text(folder).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.mapInArrow(
        cut,
        "page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
        "refers_to long, payload string",
    )


def op9_warc(pages: DataFrame) -> DataFrame:
    """Write all pages as archives into the shared folder and read them back."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_warc(pages.select("page_id", "url", "html"), folder)
    return read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_BASE32_SQL = " || ".join(
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"1 + ((('0x' || substr(sha1(t), {1 + i // 8 * 10}, 10))::BIGINT >> {35 - 5 * (i % 8)}) & 31)::INT, 1)"
    for i in range(32)
)
OP9_SQL = (
    "WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages), "
    "q AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS m FROM p) "
    f"SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes, {_BASE32_SQL} AS payload_digest, "
    "CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, "
    "CASE WHEN page_id = m THEN NULL ELSE m END AS refers_to FROM q"
)
