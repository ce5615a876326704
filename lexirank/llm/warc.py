"""WARC archives: written with an index of every record, read back by coalesced byte ranges of the records selected."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sieve import may_be_among
from .storage import materialize, new_path

#: Payloads of fewer bytes are always stored, not revisited.
REVISIT_BYTES = 100
#: Bytes of an archive file before the next one is begun.
ARCHIVE_BYTES = 1 << 30
#: Ranges with at most so many bytes between them are read at once, up to a span of SPAN_BYTES.
GAP_BYTES, SPAN_BYTES = 64 << 10, 8 << 20

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, path string, offset long, length long, url string, digest string, payload_bytes long, record_type string, refers_to long"
RECORD = "page_id long, url string, record_type string, refers_to long, stated_digest string, payload binary"


def _record_id(page_id: int | None) -> str:
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page/{page_id}") if page_id is not None else uuid.uuid4()
    return f"<urn:uuid:{name}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record, a gzip member of its own; with refers_to a revisit, which has no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of a record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _file_system(uri: str):
    """Arrow's file system of a place, and its path there; s3a is Hadoop's name of what Arrow calls s3."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub("^s3a:", "s3:", uri))


def _writer(folder: str, date: str):
    def write_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, root = _file_system(folder)
        fs.create_dir(root, recursive=True)
        out, path, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, digest, refers_to in zip(*(batch.column(k).to_pylist() for k in range(5))):
                    if out is None or offset >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"part-{task.partitionId() if task else 0:05d}-{uuid.uuid4().hex}.warc.gz"
                        out, path, offset = fs.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0
                    payload = html.encode()
                    member = record_bytes(page_id, url, payload, digest, refers_to, date)
                    out.write(member)
                    rows.append((page_id, path, offset, len(member), url, digest, len(payload), "response" if refers_to is None else "revisit", refers_to))
                    offset += len(member)
                if rows:
                    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                    names = [f.split()[0] for f in INDEX.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)
        finally:
            if out is not None:
                out.close()

    return write_batches


def write_archives(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """Write a record for every page; the index of INDEX, a row for each record, read from a written table.

    The payload is the text in UTF-8, a null one empty. Of pages with equal payloads of at least REVISIT_BYTES
    the one with the smallest id is stored, the others are revisits of it (rows that repeat that id are stored
    again; where all ids are null, all are stored). Only pages whose payload may repeat are shuffled, and AQE can
    split those of a payload that very many have. Each task writes files of its own names and the index tells
    those of the tasks that counted, so tasks that run again, or twice, do no harm. Other columns are not read;
    a null url has no header; an empty table gives an empty index.
    """
    folder = folder or new_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("html")
    ).withColumn("digest", F.sha2("html", 256))
    first = (
        rows.filter(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("first_id").isNotNull())
        .select("digest", "first_id")
    )
    first = materialize(first, "warc-first")
    among = may_be_among(first, "digest")
    rows = rows.withColumn("_may", among(F.col("digest")))
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    asked = rows.filter("_may").join(first.hint("merge"), "digest", "left").select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))
    stored = rows.filter("not _may").select("page_id", "url", "html", "digest", F.lit(None).cast("long").alias("refers_to")).unionByName(asked)
    return materialize(stored.mapInArrow(_writer(folder, date), INDEX), "warc-index")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    handles: dict = {}

    def spans() -> Iterator[tuple[str, list[tuple[int, int]]]]:
        path, ranges = "", []
        for batch in batches:
            for p, offset, length in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if ranges and (p != path or offset - sum(ranges[-1]) > GAP_BYTES or offset + length - ranges[0][0] > SPAN_BYTES):
                    yield path, ranges
                    ranges = []
                path = p
                ranges.append((offset, length))
        if ranges:
            yield path, ranges

    for path, ranges in spans():
        if path not in handles:
            for f in handles.values():
                f.close()
            fs, place = _file_system(path)
            handles = {path: fs.open_input_file(place)}
        start = ranges[0][0]
        data = handles[path].read_at(max(o + n for o, n in ranges) - start, start)
        rows = []
        for offset, length in ranges:
            headers, payload = parse_record(data[offset - start : offset - start + length])
            number = lambda k: int(headers[k]) if k in headers else None
            rows.append((number("x-page-id"), headers.get("warc-target-uri"), headers["warc-type"], number("x-refers-to-page-id"), headers["warc-payload-digest"].removeprefix("sha256:"), payload))
            if headers["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != rows[-1][4]:
                raise ValueError(f"{path} at {offset}: the payload is not what its digest says")
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=[f.split()[0] for f in RECORD.split(", ")])


def _bytes(size: str) -> int:
    """A size as Spark's settings give it, such as 128MB, 16m or 134217728b."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return max(1, int(number) << 10 * " kmgtp".index(unit or " "))


def read_records(index: DataFrame) -> DataFrame:
    """The records that the rows of an index (or some of them) name: columns of RECORD.

    Rows are sorted by file and offset, and near ranges are read at once: as many bytes of archives to a task as the
    session's scans give it. The payload of a response is held against its digest; a revisit has an empty one:
    payload_facts() finds it.
    """
    size = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    share = _bytes(index.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    near = F.floor(F.col("offset") / SPAN_BYTES).alias("near")
    ranges = index.select("path", "offset", "length", near).repartition(max(1, -(-size // share)), "path", "near").sortWithinPartitions("path", "offset")
    return ranges.select("path", "offset", "length").mapInArrow(_reader, RECORD)


def payload_facts(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of records, a revisit's from the response it refers to.

    Facts of responses are taken from what was read. A revisit whose response isn't among the records has nulls.
    """
    read = records.select("page_id", "record_type", "refers_to", "stated_digest", F.octet_length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("digest"))
    read = materialize(read, "warc-read")
    answers = read.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), F.col("digest").alias("stated_digest")).agg(F.first("bytes").alias("there"))
    answers = materialize(answers, "warc-answers")  # a written table, so that the revisits of one page are split
    revisits = read.filter("record_type = 'revisit'").join(answers.hint("merge"), ["refers_to", "stated_digest"], "left")
    digest = F.when(F.col("there").isNotNull(), F.col("stated_digest"))
    return (
        read.filter("record_type = 'response'")
        .select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
        .unionByName(revisits.select("page_id", F.col("there").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to"))
    )
