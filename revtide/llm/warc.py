"""WARC archives with Zstandard: a dictionary in front, one frame per record.

An archive begins with a skippable frame that holds the dictionary; each record after it
is one frame. Tasks write archives of bounded size into the shared folder and report them
in a table; an attempt that dies leaves a file that the table does not name. The reader
takes one archive at a time, streams its frames and checks versions, headers, lengths and
digests.

A page whose payload (the html in UTF-8; null is empty) has MIN_REVISIT bytes or more and
equals that of others is written once, as the response of the smallest page_id; the rest
are revisits of it. Null ids come after all others. Rows that repeat both the id and the
payload are one response and revisits of it. Only page_id, url and html are read. An empty
table makes no archive and no rows.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revtide.llm.base import smallest_hashes, stored, utf8
from revtide.session import work_folder

MIN_REVISIT = 100
#: Bytes of records in an archive before the next is begun, and read at once.
ARCHIVE_BYTES, READ_BYTES = 64 << 20, 1 << 20
#: The dictionary's size, and the pages it is trained on: so many, of at most so many bytes.
DICTIONARY_BYTES, SAMPLE_PAGES, SAMPLE_PAGE_BYTES = 64 << 10, 400, 32 << 10
# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


# --- records --------------------------------------------------------------

def _id(page_id, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def record(page_id, url, payload: bytes, digest: str, revisit: bool, refers_to) -> bytes:
    """One record: version, headers, a blank line, the block and two line ends."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _id(page_id, digest),
        "WARC-Date": DATE, "WARC-Target-URI": " ".join((url or "").split()),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    if revisit:
        headers |= {"WARC-Refers-To": _id(refers_to, digest), "WARC-Profile": REVISIT_PROFILE}
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items() if value)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = [line.decode().partition(":") for line in lines]
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page(uri: str) -> int | None:
    scheme, kind, page, _ = uri.strip("<>").split(":")
    if (scheme, kind) != ("urn", "page"):
        raise ValueError(f"record id {uri}")
    return int(page) if page else None


def parse(data: bytes) -> dict:
    """The parts of a record; ValueError where version, headers, lengths or digests are wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version != VERSION or not gap:
        raise ValueError(f"not a {VERSION.decode()} record")
    fields = _fields(lines)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing:
        raise ValueError(f"headers missing: {sorted(missing)}")
    size = int(fields["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, Content-Length {size}")
    if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    length, digest = int(_fields(http.split(b"\r\n")[1:])["content-length"]), fields["warc-payload-digest"]
    revisit = fields["warc-type"] == "revisit"
    if revisit:
        payload = None
    elif len(payload) != length or digest != f"sha256:{hashlib.sha256(payload).hexdigest()}":
        raise ValueError("payload differs from its length or digest")
    return {
        "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"], "payload_bytes": length,
        "payload_digest": digest.removeprefix("sha256:"),
        "refers_to": _page(fields["warc-refers-to"]) if revisit else None, "payload": payload,
    }


# --- archives -------------------------------------------------------------

def _file_system(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder)


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of pages; empty where there are too few."""
    few = smallest_hashes(pages.select("page_id", "html"), SAMPLE_PAGES, "page_id", F.xxhash64("html"))
    few = few.filter((F.octet_length("html") <= SAMPLE_PAGE_BYTES) & (F.octet_length("html") > 0))
    samples = [row.html.encode() for row in few.toLocalIterator()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:  # the library needs more, or more varied, samples
        return b""


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, and `revisit` and `refers_to` of each page.

    Payloads are grouped by digest, without their bytes.
    """
    html = F.coalesce("html", F.lit(""))
    source = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    light = source.filter(F.octet_length("html") >= MIN_REVISIT).select("digest", "page_id")
    own = light.groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    firsts = own.groupBy("digest").agg(
        F.min("page_id").alias("first"), F.sum("n").alias("rows"), F.sum(F.isnull("page_id").cast("long") * F.col("n")).alias("nulls"),
        F.min_by("n", F.struct(F.isnull("page_id"), "page_id")).alias("n_first")).filter("rows > 1")
    groups = stored(firsts.select("digest", "first", "n_first"), "revisits")
    joined = source.join(groups, "digest", "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first"))
    in_group = F.col("n_first").isNotNull()
    columns = ["page_id", "url", "html", "digest", "first"]
    plain = joined.select(*columns, (in_group & ~is_first).alias("revisit"), (is_first & (F.col("n_first") > 1)).alias("tied"))
    if not groups.filter("n_first > 1").head(1):
        return plain.drop("tied").withColumn("revisit", F.coalesce("revisit", F.lit(False)))
    nth = F.row_number().over(W.partitionBy("digest", "page_id").orderBy("url"))
    tied = plain.filter("tied").withColumn("revisit", nth > 1)
    return plain.filter("tied is not true").union(tied).drop("tied").withColumn("revisit", F.coalesce("revisit", F.lit(False)))


def write_archives(pages: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Write the pages as archives below the folder; a row (path, records, bytes) for each."""
    rows = planned(pages)

    def run(batches):
        system, root = _file_system(folder)
        system.create_dir(root, recursive=True)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True, write_checksum=True)
        out, path, count, size = None, None, 0, 0

        def close():
            out.close()
            system.move(path + ".open", path)
            return pa.RecordBatch.from_pylist([{"path": path, "records": count, "bytes": size}])

        for batch in batches:
            columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))]
            columns += [batch.column(k).to_pylist() for k in (3, 4, 5)]
            for page_id, url, payload, digest, first, revisit in zip(*columns):
                if out is None:
                    path, count, size = f"{root}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = system.open_output_stream(path + ".open", compression=None)
                    if dictionary:
                        out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
                data = record(page_id, url, payload, digest, revisit, first)
                out.write(squeeze.compress(data))
                count, size = count + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return stored(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")


def _frames(stream, first: bytes, squeezed: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    data = first
    while data or (data := stream.read(READ_BYTES)):
        frame, parts = squeezed.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                break
            data = stream.read(READ_BYTES)
            if not data:
                raise ValueError("the archive ends within a frame")
        data = frame.unused_data
        yield b"".join(parts)


def records_of(stream) -> Iterator[dict]:
    """The records of an open archive, with the dictionary of its leading frame."""
    head = stream.read(8)
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == DICTIONARY_FRAME:
        size = struct.unpack("<I", head[4:])[0]
        data = stream.read(size)
        if len(data) != size:
            raise ValueError("the archive ends within its dictionary")
        if not data.startswith(DICTIONARY_MAGIC):  # it may be compressed itself
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        squeezed, head = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data)), b""
    else:
        squeezed = zstandard.ZstdDecompressor()
    for data in _frames(stream, head, squeezed):
        yield parse(data)


def read_archives(archives: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """The records of the archives named in `path`, those of one archive in one task."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
              ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema(fields + [("payload", pa.binary())] * payload)
    ddl = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"
           + ", payload binary" * payload)

    def run(batches):
        system, _ = _file_system(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for found in records_of(stream):
                        held.append(found)
                        size += len(found["payload"] or b"") if payload else 100
                        if size >= READ_BYTES:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    # As a number, since Spark would merge so few small rows into one task.
    n, cores = archives.count(), archives.sparkSession.sparkContext.defaultParallelism
    spread = archives.select("path").repartition(max(1, min(n, 4 * cores), n // 16))
    return spread.mapInArrow(run, ddl)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives of the pages in the shared folder, read back; what each record says."""
    folder = work_folder(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, train_dictionary(pages))
    return read_archives(archives, folder, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""with p as (
  select page_id, coalesce(html, '') as html, sha256(coalesce(html, '')) as digest from pages
), g as (
  select *, strlen(html) as size, min(page_id) over (partition by digest) as first from p
)
select page_id, size as payload_bytes, digest as payload_digest,
  case when size >= {MIN_REVISIT} and page_id <> first then 'revisit' else 'response' end as record_type,
  case when size >= {MIN_REVISIT} and page_id <> first then first end as refers_to
from g"""
