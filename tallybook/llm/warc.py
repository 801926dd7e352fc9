"""WARC archives of pages, with a two-level capture index.

Tasks write archive files of one gzip member per record into the shared folder. Captures (key, row,
file, offset, length) are sorted by the reversed host and path of their URL and cut into blocks of
lines that are compressed: the index. A directory keeps each block's first line. A look-up finds its
block by the directory, its line by binary search in the block, and reads that range of the archive
file; look-ups are sorted, so that each block is opened once and each file is read by one task in
order.

Of records with equal payloads of some size, one is a response and the others revisit it: they have
the payload's digest and length, not the payload.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallybook.llm.blocks import partitions, small_batches, written_table
from tallybook.plans.ordering import OFFSET_IN_SEGMENT, SEGMENT, in_ranges
from tallybook.session import new_location

BLOCK_LINES = 1000
FILE_BYTES = 64 << 20

# Record and header names of the format, and the profile of a revisit.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def key_of(url: str | None) -> str:
    """A URL's key: host labels from the last to the first, then path and query."""
    host, path = re.match(r"(?:[^:/?#]*://)?([^/?#]*)(.*)", url or "", re.S).groups()
    return ",".join(reversed(host.lower().split("."))) + ")" + path.replace("\n", "%0A").replace("\t", "%09")


def _name(page_id, row: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{row}>"


def record(page_id, row: int, url: str | None, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record; the block is an HTTP response, without its body in a revisit."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (b"" if revisit else payload)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id, row)}",
        f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers (lower-cased names), and the payload, of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["http-length"] = re.search(rb"Content-Length: (\d+)", http)[1].decode()
    fields["payload"] = payload
    return fields


def _files(spark, location: str) -> tuple[str, str]:
    """(URI of a folder as Arrow's file systems know it, its path there)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri)), location


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def judged(pages: DataFrame, least: int = 1000, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``html``, ``refers_to``: null for a response, else the id it revisits."""
    small_batches(pages)
    pages = pages.select(
        F.col(f"`{id_column}`").cast("bigint").alias("page_id"), F.col(f"`{url_column}`").alias("url"),
        F.coalesce(F.col(f"`{html_column}`"), F.lit("")).alias("html"),
    )
    size, digest = F.octet_length("html"), F.sha1(F.encode("html", "UTF-8"))
    # Only payloads that occur again matter; there are few, and one row of each.
    again = pages.where(size >= least).groupBy(digest.alias("digest"), size.alias("size")).agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    again = written_table(again.where("n > 1").select("digest", "size", "first"), "again")
    same = (digest == F.col("digest")) & (size == F.col("size"))
    later = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return pages.join(again, same, "left").select("page_id", "url", "html", later.alias("refers_to"))


def write_archives(pages: DataFrame, location: str) -> DataFrame:
    """Write ``judged`` pages; ``key``, ``row``, ``file``, ``offset``, ``length`` of every record.

    A task that is run again writes files of its own; only those it returned are ever read.
    """
    folder, _ = _files(pages.sparkSession, location)

    def run(batches):
        files, path = _open(folder)
        files.create_dir(path, recursive=True)
        out, at = None, 0
        try:
            for batch in batches:
                rows = {"key": [], "row": [], "file": [], "offset": [], "length": []}
                for page, url, html, refers_to, row in zip(*[batch.column(c) for c in ("page_id", "url", "html", "refers_to", "row")]):
                    if out is None or at > FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{path}/{name}", compression=None)
                    found = refers_to.as_py()
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = record(page.as_py(), row.as_py(), url.as_py(), html.as_py().encode(), found, found is not None)
                    data = squeeze.compress(data) + squeeze.flush()
                    out.write(data)
                    for column, value in zip(rows, (key_of(url.as_py()), row.as_py(), name, at, len(data))):
                        rows[column].append(value)
                    at += len(data)
                yield pa.RecordBatch.from_pydict(rows)
        finally:
            if out is not None:
                out.close()

    numbered = pages.withColumn("row", F.monotonically_increasing_id())
    written = numbered.mapInArrow(run, "key string, row long, file string, offset long, length long")
    return written_table(written, "captures")


def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES, ranges: int | None = None) -> DataFrame:
    """``key``, ``row`` (of a block's first line), ``block``, ``data`` (compressed lines), sorted by range."""
    order = [F.col("key"), F.col("row")]
    spread = captures.repartitionByRange(ranges, *order) if ranges else captures.repartitionByRange(*order)

    def run(batches):
        held: list[tuple] = []

        def block(lines):
            text = "\n".join("\t".join(map(str, line)) for line in lines)
            return pa.RecordBatch.from_pydict({
                "key": [lines[0][0]], "row": [lines[0][1]], "block": [uuid.uuid4().hex], "data": [zlib.compress(text.encode())],
            })

        for batch in batches:
            held += zip(*[batch.column(c).to_pylist() for c in ("key", "row", "file", "offset", "length")])
            while len(held) >= block_lines:
                yield block(held[:block_lines])
                del held[:block_lines]
        if held:
            yield block(held)

    blocks = spread.sortWithinPartitions(*order).mapInArrow(run, "key string, row long, block string, data binary")
    return written_table(blocks, "index")


def find(index: DataFrame, wanted: DataFrame, ranges: int | None = None) -> DataFrame:
    """``key``, ``row``, ``file``, ``offset``, ``length`` for the captures ``wanted(key, row)``.

    The directory is the blocks' first lines, swept together with what is wanted, in ranges of keys.
    """
    wanted = wanted.select("key", "row").distinct()
    swept = in_ranges(
        index.select("key", "row", "block").unionByName(wanted.withColumn("block", F.lit(None).cast("string"))),
        [F.col("key"), F.col("row"), F.col("block").desc_nulls_last()], "directory", ranges,
    )
    within = Window.partitionBy(SEGMENT).orderBy(OFFSET_IN_SEGMENT)
    local = swept.withColumn("last", F.last("block", ignorenulls=True).over(within))
    ends = swept.groupBy(SEGMENT).agg(F.max_by("block", F.when(F.col("block").isNotNull(), F.col(OFFSET_IN_SEGMENT))).alias("end"))
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(SEGMENT, F.last("end", ignorenulls=True).over(before).alias("carried"))
    asks = local.where("block IS NULL").join(carried, SEGMENT).select(
        F.coalesce("last", "carried").alias("block"), "key", "row"
    )
    found = pa.schema([("key", pa.string()), ("row", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def run(asked: pa.Table, blocks: pa.Table) -> pa.Table:
        rows: dict[str, list] = {c: [] for c in found.names}
        for data in blocks.column("data").to_pylist():
            lines = [line.split("\t") for line in zlib.decompress(data).decode().split("\n")]
            places = [(line[0], int(line[1])) for line in lines]
            for key, row in zip(asked.column("key").to_pylist(), asked.column("row").to_pylist()):
                at = bisect.bisect_left(places, (key, row))
                if at < len(places) and places[at] == (key, row):
                    line = lines[at]
                    for column, value in zip(rows, (key, row, line[2], int(line[3]), int(line[4]))):
                        rows[column].append(value)
        return pa.table(rows, schema=found)

    return asks.groupBy("block").cogroup(index.select("block", "data").groupBy("block")).applyInArrow(
        run, "key string, row long, file string, offset long, length long"
    )


_READ = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def read_records(found: DataFrame, location: str, payloads: bool = False) -> DataFrame:
    """The records at the given ranges, each file read in order by one task.

    ``payload_bytes`` and ``payload_digest`` (bare hexadecimal SHA-1) are those of the full payload;
    for a response they are taken from the bytes read. ``payload`` is null unless asked for.
    """
    folder, _ = _files(found.sparkSession, location)

    def run(table: pa.Table) -> pa.Table:
        files, path = _open(folder)
        rows: dict[str, list] = {c: [] for c in _READ.names}
        table = table.sort_by("offset")
        with files.open_input_file(f"{path}/{table.column('file')[0].as_py()}") as archive:
            for offset, length in zip(table.column("offset").to_pylist(), table.column("length").to_pylist()):
                fields = parse(zlib.decompress(archive.read_at(length, offset), 31))
                page = fields["warc-record-id"].split(":")[2]
                told = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                revisit = fields["warc-type"] == "revisit"
                refers = fields["warc-refers-to"].rstrip(">").split(":")[2] if revisit else None
                body = fields["payload"]
                read = (
                    int(page) if page else None, int(fields["http-length"]) if revisit else len(body),
                    told if revisit else hashlib.sha1(body).hexdigest(), fields["warc-type"],
                    int(refers) if refers else None, body if payloads else None,
                )
                for column, value in zip(rows, read):
                    rows[column].append(value)
        return pa.table(rows, schema=_READ)

    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    # Spread by number: the places are a few bytes each, and merged by their size they would be read by one task.
    places = found.select("file", "offset", "length").repartition(partitions(found), "file")
    return places.groupBy("file").applyInArrow(run, kinds)


def archive_pages(
    pages: DataFrame, least: int = 1000, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
    location: str | None = None,
) -> DataFrame:
    """Write one record per page, and read all back through the index.

    Returns ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``. Of equal
    payloads of ``least`` bytes or more the one with the largest id is the response; smaller ones
    are all responses. A null payload is empty; a null URL has a key of its own. Rows without an id
    are written too: they revisit a page with one where there is one, and are responses otherwise;
    rows that repeat the response's id are responses as well. Other columns are ignored; an empty
    table gives no rows.
    """
    spark = pages.sparkSession
    location = location or new_location(spark, "warc")
    captures = write_archives(judged(pages, least, id_column, url_column, html_column), location)
    index = build_index(captures, ranges=partitions(pages))
    found = find(index, captures.select("key", "row"))
    return read_records(found, location).drop("payload")
