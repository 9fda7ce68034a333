"""WARC archives with an index that is read first.

Writing: each task appends records to archive files of bounded size in the
shared folder and returns an index row per record: page, URL, digest, file,
offset and length.  A record is one gzip member, so any record can be read alone.
Equal payloads are stored once: the smallest page id is the response, the others
are revisit records that name it.

Reading: the wanted index rows are sorted by file and offset, neighbours with
small gaps are joined to one byte range (of bounded size), and each range is
read once and cut into records.

Files of a failed task attempt are not in the index, so they are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm import words as W
from reviewlens.llm.store import open_folder, share_code, shared_folder, stored

#: An archive is closed at this size.
ARCHIVE_BYTES = 256 << 20
#: Gap between records that is read over, and size at which a range ends.
GAP_BYTES = 64 << 10
RANGE_BYTES = 4 << 20
#: Shared payloads that every task knows by name, at most.
MOST_COMMON = 10_000
DATE = "1970-01-01T00:00:00Z"
INDEX = (
    "page_id bigint, url string, payload_digest string, payload_bytes bigint, "
    "record_type string, refers_to bigint, file string, offset bigint, length bigint"
)
_INDEX = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("file", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)


def digest(payload: bytes) -> str:
    """Base32 SHA-1, upper case, without a label."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def page_of(identifier: str) -> int | None:
    name = identifier.strip("<>").rsplit(":", 1)[1]
    return None if name == "none" else int(name)


def _header_text(value: str) -> str:
    """A header value on one line; percent signs and controls are percent-encoded."""
    if value.isprintable() and "%" not in value:
        return value
    return "".join(c if c.isprintable() and c != "%" else f"%{ord(c):06X}" for c in value)


def _header_value(text: str) -> str:
    parts = text.split("%")
    return parts[0] + "".join(chr(int(p[:6], 16)) + p[6:] for p in parts[1:])


def record(page, url, payload: bytes, own_digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    body = b"" if kind == "revisit" else payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    lines += [f"WARC-Payload-Digest: sha1:{own_digest}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
        ]
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}", "", ""]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + body + b"\r\n\r\n") + packer.flush()


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of a record."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def _digests(batches):
    for batch in batches:
        for part in W.slices(batch, "html"):
            payloads = [(t or "").encode() for t in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("page_id"),
                    pa.array([digest(p) for p in payloads], pa.string()),
                    pa.array([len(p) for p in payloads], pa.int64()),
                ],
                ["page_id", "payload_digest", "payload_bytes"],
            )


def originals(pages: DataFrame, minimum: int = 0) -> DataFrame:
    """``payload_digest, first_page, n`` of payloads that several rows share."""
    share_code(pages.sparkSession)
    rows = pages.select("page_id", "html").mapInArrow(
        _digests, "page_id bigint, payload_digest string, payload_bytes bigint"
    )
    return (
        rows.where(F.col("payload_bytes") >= minimum)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_page"), F.count("*").alias("n"))
        .where("n > 1")
    )


def _write(folder: str, archive_bytes: int, common):
    def run(batches):
        system, path = open_folder(folder)
        out, name, at = None, "", 0
        for batch in batches:
            for part in W.slices(batch, "html"):
                rows = []
                for r in part.to_pylist():
                    payload = (r["html"] or "").encode()
                    own = digest(payload)
                    first = common.value.get(own, r["first_page"])
                    kind = "response" if first is None or first == r["page_id"] else "revisit"
                    refers = first if kind == "revisit" else None
                    data = record(r["page_id"], r["url"], payload, own, kind, refers)
                    if out is None:
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{path}/{name}", compression=None)
                    out.write(data)
                    rows.append((r["page_id"], r["url"], own, len(payload), kind, refers, name, at, len(data)))
                    at += len(data)
                    if at >= archive_bytes:
                        out.close()
                        out = None
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _INDEX)], schema=_INDEX
                )
        if out is not None:
            out.close()

    return run


def _with_digest(batches):
    for batch in batches:
        for part in W.slices(batch, "html"):
            own = [digest((t or "").encode()) for t in part.column("html").to_pylist()]
            yield part.append_column("payload_digest", pa.array(own, pa.string()))


def write_archives(
    pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html",
    minimum: int = 0, archive_bytes: int = ARCHIVE_BYTES,
) -> tuple[str, DataFrame]:
    """Folder of the archives and the index.

    A null html is an empty payload.  Payloads shorter than ``minimum`` bytes are
    all responses.  Rows that repeat the smallest page id of a payload are all
    responses.  Null page ids are never the smallest; pages that share a payload
    and have no id at all are responses.  A page without URL has no target
    header.  An empty table gives an empty index.  Other columns are ignored.
    """
    spark = pages.sparkSession
    share_code(spark)
    rows = pages.select(
        F.col(page).cast("bigint").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    shared = stored(originals(rows, minimum), "warc-originals").where("first_page is not null")
    # At most MOST_COMMON digests go to every task by name, those with the most rows; rows of any other
    # shared payload meet their original in a shuffle join, where no key is frequent any more.
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    frequent = F.col("n") * MOST_COMMON >= total
    common = {r["payload_digest"]: r["first_page"] for r in shared.where(frequent).collect()}
    rare = shared.where(~frequent).select("payload_digest", "first_page")
    if rare.take(1):
        marked = rows.mapInArrow(_with_digest, "page_id bigint, url string, html string, payload_digest string")
        rows = marked.join(rare, "payload_digest", "left").drop("payload_digest")
    else:
        rows = rows.withColumn("first_page", F.lit(None).cast("bigint"))
    folder = shared_folder(spark, "warc")
    writer = _write(folder, archive_bytes, spark.sparkContext.broadcast(common))
    return folder, stored(rows.mapInArrow(writer, INDEX), "warc-index")


def byte_ranges(index: DataFrame, gap: int = GAP_BYTES, size: int = RANGE_BYTES) -> DataFrame:
    """Coalesced reads: ``file, start, stop, cuts`` (offset and length of each record).

    Records join a range when the gap to the one before is small and they begin
    in the same stretch of ``size`` bytes, so a range is bounded.
    """
    order = Window.partitionBy("file").orderBy("offset")
    end = F.lag(F.col("offset") + F.col("length")).over(order)
    apart = (
        end.isNull()
        | (F.col("offset") - end > gap)
        | (F.floor(F.col("offset") / size) != F.floor(F.lag("offset").over(order) / size))
    )
    number = F.sum(F.col("apart").cast("int")).over(order)
    return (
        index.select("file", "offset", "length")
        .withColumn("apart", apart)
        .withColumn("number", number)
        .groupBy("file", "number")
        .agg(
            F.min("offset").alias("start"),
            F.max(F.col("offset") + F.col("length")).alias("stop"),
            F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("cuts"),
        )
        .drop("number")
    )


def _read(folder: str, payloads: bool):
    kind = [("html", pa.string())] if payloads else []
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = pa.schema(
        [*((n, _INDEX.field(n).type) for n in names), ("stored_digest", pa.string()), *kind]
    )

    def run(batches):
        system, path = open_folder(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with system.open_input_file(f"{path}/{r['file']}") as file:
                    data = file.read_at(r["stop"] - r["start"], r["start"])
                rows = []
                for cut in r["cuts"]:
                    at = cut["offset"] - r["start"]
                    headers, body = parse(data[at : at + cut["length"]])
                    full = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = headers["WARC-Type"] == "response"
                    if response and digest(body) != full:
                        raise ValueError(f"damaged record in {r['file']} at {cut['offset']}")
                    refers = headers.get("WARC-Refers-To")
                    url = headers.get("WARC-Target-URI")
                    row = [
                        page_of(headers["WARC-Record-ID"]),
                        None if url is None else _header_value(url),
                        len(body) if response else int(headers["X-Payload-Length"]),
                        full,
                        headers["WARC-Type"],
                        None if refers is None else page_of(refers),
                        digest(body),
                    ]
                    rows.append([*row, body.decode()] if payloads else row)
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def read_records(folder: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the given index rows; ``html`` is what the record holds.

    A response is checked against its digest.  A revisit holds no payload: its
    length and digest are those of the page it refers to.
    """
    spark = index.sparkSession
    share_code(spark)
    shape = (
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, stored_digest string" + (", html string" if payloads else "")
    )
    ranges = byte_ranges(index).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "start")
    return ranges.mapInArrow(_read(folder, payloads), shape)
