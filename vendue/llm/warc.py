"""WARC archives: a writer with one gzip member per record and a sequential, verifying reader."""

from __future__ import annotations

import base64
import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendue.llm.common import raw_bytes, shared_folder, small_batches, stored

#: A new archive file begins when one has this many bytes.
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 16

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


class WarcError(ValueError):
    """An archive that doesn't keep to the format, or a digest that doesn't fit its content."""


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_value(text: str) -> str:
    """A header value on one line: controls and % become percent escapes."""
    return re.sub(r"[\x00-\x1f\x7f%\u0085  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), text)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record as a gzip member. A revisit has the HTTP head alone as its block."""
    block = HTTP_HEAD % len(payload) + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", header_value(url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[4:4] = [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + b"\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head + block + b"\r\n\r\n") + pack.flush()


def open_file(path: str, mode: str) -> BinaryIO:
    """A file of a local or mounted path, or of any store that pyarrow knows by its scheme."""
    scheme, _, rest = path.partition(":")
    if "/" in scheme or not rest or scheme == "file":
        path = re.sub("^file:/*", "/", path)
        if mode == "wb":
            os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path)
    if mode == "rb":
        return store.open_input_stream(place, compression=None)
    store.create_dir(os.path.dirname(place), recursive=True)
    return store.open_output_stream(place, compression=None)


class Members:
    """The decompressed bytes of consecutive gzip members, one member at a time."""

    def __init__(self, file: BinaryIO):
        self.file, self.rest, self.inflate = file, b"", None

    def begin(self) -> bool:
        """Go to the next member; false at the end of the file."""
        self.rest = self.rest or self.file.read(CHUNK)
        if not self.rest:
            return False
        self.inflate, self.out = zlib.decompressobj(31), bytearray()
        return True

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.rest or self.file.read(CHUNK)
        if not data:
            raise WarcError("the archive ends inside a record")
        self.rest = b"" if data is self.rest else self.rest
        try:
            self.out += self.inflate.decompress(data, CHUNK)
        except zlib.error as err:
            raise WarcError(f"not a gzip member: {err}") from err
        if self.inflate.eof:
            self.rest = self.inflate.unused_data or self.rest
        return True

    def until(self, mark: bytes) -> bytes:
        """Bytes up to a mark, which is taken as well."""
        seen = 0
        while (at := self.out.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.out)
            if not self._more():
                raise WarcError("a header without an end")
        data = bytes(self.out[:at])
        del self.out[: at + len(mark)]
        return data

    def exactly(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces of bounded size."""
        while n:
            if not self.out and not self._more():
                raise WarcError("a record shorter than its Content-Length")
            data = bytes(self.out[:n])
            del self.out[: len(data)]
            n -= len(data)
            if data:
                yield data

    def end(self) -> bytes:
        """What is left in the member."""
        while self._more():
            if len(self.out) > 4 * CHUNK:
                break
        data = bytes(self.out)
        self.out.clear()
        return data


def read_records(file: BinaryIO, with_payload: bool = True) -> Iterator[dict]:
    """Records of an archive in order, each framed by its Content-Length and verified.

    The block streams through the digests in pieces; only with ``with_payload`` is it kept.
    Raises ``WarcError`` for a broken frame or a block or payload digest that doesn't fit.
    """
    members = Members(file)
    while members.begin():
        lines = members.until(b"\r\n\r\n").split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise WarcError("a record without a version line")
        fields = {k.strip().lower().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines[1:])}
        n, revisit = int(fields["content-length"]), fields["warc-type"] == "revisit"
        of_block, of_payload = hashlib.sha1(), hashlib.sha1()
        http, body, payload_bytes = bytearray(), [], 0
        in_body = not fields.get("content-type", "").startswith("application/http")
        for data in members.exactly(n):
            of_block.update(data)
            if not in_body:
                http += data
                at = http.find(b"\r\n\r\n")
                if at < 0:
                    continue
                in_body, data = True, bytes(http[at + 4 :])
                del http[at:]
            of_payload.update(data)
            payload_bytes += len(data)
            if with_payload:
                body.append(data)
        if members.end() != b"\r\n\r\n":
            raise WarcError("a record longer than its Content-Length")
        length = re.search(rb"(?i)\r\ncontent-length: *(\d+)", http)
        told = {k: fields.get(f"warc-{k}-digest", "").removeprefix("sha1:") for k in ("block", "payload")}
        if told["block"] and told["block"] != base64.b32encode(of_block.digest()).decode():
            raise WarcError(f"block digest of {fields.get('warc-record-id')}")
        if told["payload"] and not revisit and told["payload"] != base64.b32encode(of_payload.digest()).decode():
            raise WarcError(f"payload digest of {fields.get('warc-record-id')}")
        yield {
            "page_id": page_of(fields.get("warc-record-id")),
            "url": fields.get("warc-target-uri"),
            "record_type": fields["warc-type"],
            "refers_to": page_of(fields.get("warc-refers-to")),
            "payload_digest": told["payload"],
            "payload_bytes": int(length[1]) if revisit and length else payload_bytes,
            "payload": b"".join(body) if with_payload and not revisit else None,
        }


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages`` (``page_id, url, html``); returns the archives' ``path, records, bytes``.

    Payload is the html in UTF-8, a null one is empty. Of rows with equal payloads of at least
    ``min_revisit_bytes`` bytes the one with the largest page_id is a response, the others
    are revisits that refer to it; rows that share that largest id are all responses, a null
    id is the smallest. Other columns are not archived. Only digests and ids are grouped; a payload that
    a third of all rows share is reduced before the shuffle and joined by a splittable join.
    A task that runs again writes files of its own; the returned table names those that count.
    """
    small_batches(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"))
    # the digest is taken where rows are read, the text itself is moved only once
    keyed = pages.withColumn("key", F.sha2("html", 256))
    same = (
        keyed.where(F.octet_length("html") >= min_revisit_bytes)
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
        .where("n > 1")
        .select("key", "first")
    )
    rows = keyed.join(same.withColumn("shared", F.lit(True)), "key", "left").select(
        "page_id", "url", "html", "first", (F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit")
    )

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context, number, file, path, n, size = TaskContext.get(), 0, None, "", 0, 0
        done = []
        for part in parts:
            for page_id, url, html, first, revisit in part.itertuples(index=False, name=None):
                if file is None:
                    path = f"{folder}/pages-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.warc.gz"
                    file, n, size, number = open_file(path, "wb"), 0, 0, number + 1
                own = None if pd.isna(page_id) else int(page_id)
                data = record(own, url, raw_bytes(html), None if pd.isna(first) else int(first), bool(revisit), date)
                file.write(data)
                n, size = n + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    file.close()
                    file = None
                    done.append((path, n, size))
        if file is not None:
            file.close()
            done.append((path, n, size))
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    rows = rows.withColumn("page_id", F.col("page_id").cast("decimal(20,0)")).withColumn("first", F.col("first").cast("decimal(20,0)"))
    return stored(rows.mapInPandas(write, "path string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives named in ``path``, one task for several archives, each read in sequence.

    Returns ``page_id, url, record_type, refers_to, payload_digest, payload_bytes`` and, with
    ``with_payload``, ``payload`` (null for revisits). A broken archive fails the job.
    """
    fields = RECORDS + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in fields.split(", ")]

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path in part["path"]:
                with open_file(path, "rb") as file:
                    rows, size = [], 0
                    for found in read_records(file, with_payload):
                        rows.append([found[c] for c in names])
                        size += found["payload_bytes"]
                        if len(rows) >= 5000 or size > 32 << 20:
                            yield frame(rows)
                            rows, size = [], 0
                    yield frame(rows)

    def frame(rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names, dtype=object)
        return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": np.int64})

    spark = archives.sparkSession
    tasks = max(1, 2 * spark.sparkContext.defaultParallelism)
    paths = archives.select("path").repartition(tasks, "path")
    return paths.mapInPandas(read, fields)


def round_trip(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write the archives to a folder all executors share, read them back without payloads."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    archives = write_archives(pages, folder, min_revisit_bytes)
    return read_archives(archives, with_payload=False)
