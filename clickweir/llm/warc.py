"""Web archives: written with an index, read back by coalesced byte ranges.

Writing: each task streams its pages into one archive file of gzip members, one
member per record, and returns an index row per record (file, offset, length,
URL, digest). The index is stored before anything else uses it, so a task that
is run again leaves at most a file that no index row names. Of the records with
equal payloads the one with the smallest page id is a response, the others
revisit it; payloads below ``revisit_from`` bytes are always responses.

Reading starts from (a selection of) the index. Records are dealt out by file
and range of the file, sorted by offset, and neighbours are fetched with one
read as long as the gap between them and the size of the read stay small.

Files are opened through the file system of their URI, so the folder may be on
any store that pyarrow knows; it must be one all executors share.

Defined results: a null html is an empty payload, a null URL an empty one; a
null page id is a record without an id, and is a response only where all equal
payloads lack one; rows repeated with the same id and payload are the same
record written twice, and both are responses if theirs is the smallest id; an
empty table gives an empty index; other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm.common import send_code

send_code(__name__)

INDEX = (
    "file string, offset bigint, length bigint, url string, payload_digest string, "
    "page_id bigint, record_type string"
)
_INDEX = pa.schema(
    [
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("url", pa.string()),
        ("payload_digest", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
    ]
)
_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
_BATCH = 2000


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def digest_text(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _header(lines: list[tuple[str, object]]) -> bytes:
    kept = [f"{k}: {v}" for k, v in lines if v is not None]
    return "\r\n".join(["WARC/1.1", *kept, "", ""]).encode()


def _urn(page_id: int | None) -> str | None:
    return None if page_id is None else f"<urn:page:{page_id}>"


def build_record(
    page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, date: str
) -> bytes:
    """One record: a response with its payload, or a revisit without."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    head = _header(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", _urn(page_id)),
            ("WARC-Date", date),
            ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("WARC-Refers-To", _urn(refers_to)),
            ("WARC-Profile", profile if revisit else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(block)),
        ]
    )
    return head + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def _id(urn: str | None) -> int | None:
    return None if urn is None else int(urn.removeprefix("<urn:page:").removesuffix(">"))


def parse_record(record: bytes) -> tuple:
    """The row of ``_RECORD`` for one record; a response's payload must match its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and digest_text(hashlib.sha1(payload).hexdigest()) != digest:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    return (
        _id(fields.get("warc-record-id")),
        fields["warc-target-uri"],
        int(_fields(http)["content-length"]),
        digest,
        kind,
        _id(fields.get("warc-refers-to")),
        payload if kind == "response" else None,
    )


def _with_first(pages: DataFrame, revisit_from: int) -> DataFrame:
    """Each page with the id its payload is a revisit of, or null.

    Digests are compared on rows of a few bytes, merged in the map tasks; the
    pages themselves are then joined by id and digest, which no hot payload
    skews.
    """
    keyed = pages.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    ids = keyed.where(F.octet_length("html") >= revisit_from).select("page_id", "digest").distinct()
    firsts = ids.groupBy("digest").agg(F.min("page_id").alias("first"))
    again = ids.join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("first")))
    again = again.select(F.col("page_id").alias("id"), F.col("digest").alias("d"), "first")
    on = keyed["page_id"].eqNullSafe(again["id"]) & (keyed["digest"] == again["d"])
    return keyed.join(again.hint("merge"), on, "left").select(
        "page_id", "url", "html", "digest", "first"
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_from: int = 0,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write every page as a record below ``folder``; the stored index comes back."""
    given = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(f"{root}/archives", recursive=True)
        name = f"archives/{uuid.uuid4().hex}.warc.gz"
        rows, offset = [], 0
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                for row in zip(*(batch.column(i) for i in range(5))):
                    i, target, text, sha1, first = (x.as_py() for x in row)
                    digest = digest_text(sha1)
                    record = build_record(i, target, text.encode(), digest, first, date)
                    member = zlib.compress(record, level=6, wbits=31)
                    out.write(member)
                    kind = "response" if first is None else "revisit"
                    rows.append((name, offset, len(member), target, digest, i, kind))
                    offset += len(member)
        for k in range(0, len(rows), _BATCH):
            yield _rows(_INDEX, rows[k : k + _BATCH])

    path = f"{folder}/index"
    _with_first(given, revisit_from).mapInArrow(write, INDEX).write.parquet(path)
    return pages.sparkSession.read.schema(INDEX).parquet(path)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(
    selected: DataFrame, folder: str, range_bytes: int = 8 << 20, gap_bytes: int = 64 << 10
) -> DataFrame:
    """The records of the selected index rows, fetched in few large reads.

    A revisit has no payload of its own (null); its length and digest are those
    of the payload it refers to.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            wanted = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            k = 0
            while k < len(wanted):
                name, begin, length = wanted[k]
                end, last = begin + length, k + 1
                while (
                    last < len(wanted)
                    and wanted[last][0] == name
                    and wanted[last][1] - end <= gap_bytes
                    and wanted[last][1] + wanted[last][2] - begin <= range_bytes
                ):
                    end = max(end, wanted[last][1] + wanted[last][2])
                    last += 1
                with store.open_input_file(f"{root}/{name}") as archive:
                    data = archive.read_at(end - begin, begin)
                for first in range(k, last, 500):
                    yield _rows(
                        _RECORD,
                        [
                            parse_record(
                                zlib.decompress(data[o - begin : o - begin + n], wbits=31)
                            )
                            for _, o, n in wanted[first : min(first + 500, last)]
                        ],
                    )
                k = last

    dealt = (
        selected.select(
            "file",
            "offset",
            "length",
            F.floor(F.col("offset") / range_bytes).alias("range"),
        )
        .repartition("file", "range")
        .sortWithinPartitions("file", "offset")
    )
    return dealt.select("file", "offset", "length").mapInArrow(
        read,
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint, payload binary",
    )
