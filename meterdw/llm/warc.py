"""Web archives: writing, normalising and reading WARC files.

Some writers compress a whole archive as one gzip stream; no record of it can then be read without inflating all that
lies before it. The normaliser inflates such a stream once, record by record, writes every record as a gzip member of
its own and notes each member's place in an index beside the archive, so that records are read by place from then on.

Archives are files in a folder that all executors share (any that pyarrow can open). A task writes under a name of its
own and reports it; only names reported by tasks that ended well are used, so a lost or repeated task leaves nothing
that is read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm.common import mapped, small, staged, text_slices
from meterdw.session import scratch_dir

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CHUNK = 1 << 20
ARCHIVE_BYTES = 256 << 20
INDEX = "archive string, offset bigint, length bigint, record string, kind string, uri string, digest string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(number: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A response record, or a revisit of another; a revisit has the HTTP header but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")
    lines = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{number}>", f"WARC-Target-URI: {uri}", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    return {name.lower(): value for name, value in pairs}


class Inflated:
    """Bytes of a gzip file of one or many members, inflated as they are asked for."""

    def __init__(self, source):
        self.source, self.held = source, b""
        self.inflate = zlib.decompressobj(31)
        self.ended = False

    def _more(self) -> bool:
        while not self.ended:
            data = self.inflate.unconsumed_tail or (self.inflate.unused_data if self.inflate.eof else b"")
            if self.inflate.eof:
                data = data or self.source.read(CHUNK)
                if not data:
                    self.ended = True
                    break
                self.inflate = zlib.decompressobj(31)
            data = data or self.source.read(CHUNK)
            if not data:
                raise EOFError("archive ends inside a gzip member")
            if out := self.inflate.decompress(data, CHUNK):
                self.held += out
                return True
        return False

    def upto(self, mark: bytes) -> bytes | None:
        """Everything up to and with the mark; None at the end."""
        while (at := self.held.find(mark)) < 0:
            if not self._more():
                if self.held.strip():
                    raise EOFError("archive ends inside a record")
                return None
        out, self.held = self.held[:at + len(mark)], self.held[at + len(mark):]
        return out

    def take(self, count: int) -> Iterator[bytes]:
        while count:
            if not self.held and not self._more():
                raise EOFError("archive ends inside a record")
            out, self.held = self.held[:count], self.held[count:]
            count -= len(out)
            yield out


def normalise(source, target, archive: str) -> Iterator[tuple]:
    """Copies an archive record by record, each as a member; yields an index row for each. One chunk is in memory."""
    stream, place = Inflated(source), 0
    while (head := stream.upto(b"\r\n\r\n")) is not None:
        named = headers(head)
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        size = target.write(pack.compress(head)) or 0
        for part in stream.take(int(named["content-length"]) + 4):
            size += target.write(pack.compress(part)) or 0
        size += target.write(pack.flush()) or 0
        yield (archive, place, size, named["warc-record-id"], named["warc-type"], named.get("warc-target-uri"),
               named.get("warc-payload-digest"))
        place += size


def _open(path: str):
    return pafs.FileSystem.from_uri(path)


def _index_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in INDEX.split(", ")]
    kinds = [pa.int64() if "bigint" in part else pa.string() for part in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)


def write_monolithic(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                     least_bytes: int = 0) -> DataFrame:
    """Writes a record per row into archives that are one gzip stream each; returns their paths (archive).

    Of rows with equal payloads of `least_bytes` or more, that with the least key is a response and the others are
    revisits of it; rows that repeat the least key are responses too, and a null key counts as the largest. Null
    payloads are empty. An empty table writes no archive.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), payload.alias("html"),
                        F.sha1(payload.cast("binary")).alias("sha"))
    repeated = (rows.where(F.octet_length("html") >= least_bytes).groupBy("sha")
                .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
                .select("sha", "first"))
    repeated = small(staged(repeated, "repeated"), 96)
    copy = F.col("first").isNotNull() & (F.col("key").isNull() | (F.col("key") > F.col("first")))
    rows = rows.join(repeated, "sha", "left").select(
        F.col("key").cast("string").alias("key"), "url", "html",
        F.when(copy, F.col("first")).cast("string").alias("refers_to"))

    def run(batches):
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        name = target = pack = None
        size = 0
        for batch in text_slices(batches, "html"):
            for number, address, page, other in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if target is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    target, pack, size = system.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(
                        6, zlib.DEFLATED, 31), 0
                raw = record(quote(number or ""), address, page.encode(), None if other is None else quote(other))
                target.write(pack.compress(raw))
                size += len(raw)
                if size >= ARCHIVE_BYTES:
                    target.write(pack.flush())
                    target.close()
                    target = None
                    yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"]})
        if target is not None:
            target.write(pack.flush())
            target.close()
            yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"]})

    return staged(mapped(rows, run, "archive string"), "archives")


def normalised(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrites every archive into `folder`, with an index file beside each; returns the index as rows."""

    def run(batches):
        for batch in batches:
            for path in batch.column("archive").to_pylist():
                system, source = _open(path)
                out_system, base = _open(folder)
                out_system.create_dir(base, recursive=True)
                name = f"{path.rsplit('/', 1)[-1].removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.warc.gz"
                rows: list[tuple] = []
                with (system.open_input_stream(source, compression=None) as inside,
                      out_system.open_output_stream(f"{base}/{name}", compression=None) as outside,
                      out_system.open_output_stream(f"{base}/{name}.cdx", compression=None) as index):
                    for row in normalise(inside, outside, f"{folder}/{name}"):
                        index.write("\t".join("" if v is None else str(v) for v in row[1:]).encode() + b"\n")
                        rows.append(row)
                        if len(rows) == 4096:
                            yield _index_rows(rows)
                            rows = []
                if rows:
                    yield _index_rows(rows)

    # a task per archive: a path is a short row, and rows would be put together by their size
    return staged(mapped(archives.repartition(max(1, archives.count()), "archive"), run, INDEX), "index")


def read_records(index: DataFrame, part_bytes: int = 4 << 20) -> DataFrame:
    """record (page), uri, kind, payload, payload_bytes, payload_digest, refers_to of every indexed record.

    Records are read by place, neighbours in an archive by one task. The payload of a response is checked against its
    digest; that of a revisit is null, and its size and digest are those its headers tell.
    """

    def run(batches):
        path = source = None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if archive != path:
                    system, name = _open(archive)
                    path, source = archive, system.open_input_file(name)
                source.seek(offset)
                raw = zlib.decompress(source.read(length), 31)
                head, _, rest = raw.partition(b"\r\n\r\n")
                named = headers(head)
                http, _, payload = rest[:int(named["content-length"])].partition(b"\r\n\r\n")
                told = named["warc-payload-digest"].removeprefix("sha1:")
                revisit = named["warc-type"] == "revisit"
                if not revisit and digest(payload) != told:
                    raise ValueError(f"{archive} at {offset}: payload and digest differ")
                page = lambda n: unquote(named[n].removeprefix("<urn:page:").removesuffix(">")) or None
                out.append((page("warc-record-id"), named["warc-target-uri"], named["warc-type"],
                            None if revisit else payload, int(headers(http)["content-length"]), told,
                            page("warc-refers-to") if revisit else None))
                if sum(len(r[3] or b"") for r in out[-64:]) > CHUNK or len(out) == 512:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

    def batch_of(out):
        kinds = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
                                          ["record", "uri", "kind", "payload", "payload_bytes", "payload_digest",
                                           "refers_to"])

    place = index.withColumn("part", F.expr(f"offset div {part_bytes}"))
    parts = max(1, place.select("archive", "part").distinct().count())
    dealt = (place.repartition(parts, "archive", "part")
             .sortWithinPartitions("archive", "offset").select("archive", "offset", "length"))
    return mapped(dealt, run, "record string, uri string, kind string, payload binary, payload_bytes bigint, "
                              "payload_digest string, refers_to string")


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes `pages` as monolithic archives, normalises them, and returns the records read back by place."""
    folder = scratch_dir(pages.sparkSession, "llm-warc")
    archives = write_monolithic(pages, f"{folder}/monolithic", key, url, html)
    return read_records(normalised(archives, f"{folder}/records"))
