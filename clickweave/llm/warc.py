"""WARC archives: a writer, and a sequential reader.

Every record is a gzip member of its own. The reader inflates a file piece by
piece, so its memory is bound by the longest record, takes each block's length
from ``Content-Length``, checks that a member ends where its record ends, and
compares block and payload with their digests.

Of records with equal payloads the one with the smallest id is the response; the
others are revisits that carry headers alone and refer to it.

Defined results: null payloads are empty ones; a null url leaves out the target;
a null id is never the smallest, and is null again after reading; rows that
repeat the smallest id are responses too; an empty table writes no archive and
reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clickweave.llm.common import record_batch
from clickweave.llm.files import new_file, old_file, partition_name
from clickweave.operators.skew import skew_join
from clickweave.session import materialize, scratch_path, ship_package

FILE_BYTES = 64 << 20
PIECE = 1 << 16
URN = "urn:record:"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
READ_SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, "
               "payload_bytes long, payload_digest string, payload binary")


class WarcError(ValueError):
    """An archive that doesn't keep to the format, or whose digests don't hold."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# --- writing ---------------------------------------------------------------------------------

def record(identity: str, url: str | None, payload: bytes, refers_to: str | None,
           date: str) -> bytes:
    """One record as a gzip member."""
    head = HTTP % len(payload)
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", f"<{identity}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{refers_to}>"),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/"
                                    "identical-payload-digest")]
    fields += [("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
               ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
               ("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def first_of_equal(pages: DataFrame, min_payload_bytes: int) -> DataFrame:
    """(id, url, payload, first): ``first`` is the id that a revisit refers to, else null.

    Digests are counted before they travel. Only payloads that occur more than
    once are joined back, by a join that copes with one payload on very many rows.
    """
    keyed = pages.withColumn("digest", F.sha1("payload"))
    copied = (keyed.where(F.octet_length("payload") >= min_payload_bytes)
              .groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 AND first IS NOT NULL").select("digest", "first"))
    joined = skew_join(keyed, materialize(copied, "payloads"), ["digest"], "left")
    return joined.select("id", "url", "payload",
                         F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
                         .alias("first"))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_payload_bytes: int = 0,
               file_bytes: int = FILE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives into ``folder``; (path, n_records, n_bytes) of each, as a stored table."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{payload_col}`").cast("binary"),
                                   F.lit(b"")).alias("payload"))

    def name_of(value) -> str:
        return URN if value is None else f"{URN}{value}"

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for row in batch.to_pylist():
                refers_to = None if row["first"] is None else name_of(row["first"])
                yield record(name_of(row["id"]), row["url"], row["payload"], refers_to, date)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, number = records(batches), 0
        waiting = next(queue, None)
        while waiting is not None:
            name = partition_name("pages", number, "warc.gz")
            count = size = 0
            with new_file(folder, name) as stream:
                while waiting is not None and (not size or size + len(waiting) <= file_bytes):
                    stream.write(waiting)
                    count, size = count + 1, size + len(waiting)
                    waiting = next(queue, None)
            number += 1
            yield record_batch({"path": ([f"{folder}/{name}"], pa.string()),
                                "n_records": ([count], pa.int64()),
                                "n_bytes": ([size], pa.int64())})

    marked = first_of_equal(rows, min_payload_bytes)
    return materialize(marked.mapInArrow(run, "path string, n_records long, n_bytes long"), "warcs")


# --- reading ---------------------------------------------------------------------------------

class Member:
    """The inflated bytes of one gzip member, on demand."""

    def __init__(self, stream, rest: bytes) -> None:
        self.stream, self.raw, self.ready = stream, rest, bytearray()
        self.inflater = zlib.decompressobj(31)

    def _more(self) -> bool:
        """Inflate another piece; False at the member's end."""
        if self.inflater.eof:
            return False
        self.raw = self.raw or self.stream.read(PIECE)
        try:
            made = self.inflater.decompress(self.raw, PIECE)
        except zlib.error as error:
            raise WarcError(f"broken gzip member: {error}") from error
        if not self.raw and not made and not self.inflater.eof:
            raise WarcError("the file ends inside a record")
        self.ready += made
        self.raw = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if not self._more():
                raise WarcError("a record has no end of header")
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.ready) < n and self._more():
            pass
        if len(self.ready) < n:
            raise WarcError("a record is shorter than its Content-Length")
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def close(self) -> bytes:
        """Bytes that follow the member; nothing of it may be left."""
        while not self.ready and self._more():
            pass
        if self.ready:
            raise WarcError("a member goes on behind its record")
        return self.raw


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record, verified."""
    rest = stream.read(PIECE)
    while rest:
        member = Member(stream, rest)
        version, *lines = member.until(b"\r\n\r\n")[:-4].decode("utf-8").split("\r\n")
        if not version.startswith("WARC/"):
            raise WarcError(f"not a record: {version[:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        if not fields.get("content-length", "").isdigit():
            raise WarcError("a record has no Content-Length")
        block = member.take(int(fields["content-length"]))
        if member.take(4) != b"\r\n\r\n":
            raise WarcError("a record doesn't end with two line ends")
        rest = member.close() or stream.read(PIECE)
        if fields.get("warc-block-digest") not in (None, f"sha1:{sha1_base32(block)}"):
            raise WarcError(f"wrong block digest in {fields.get('warc-record-id')}")
        yield fields, block


def _length_of(head: bytes) -> int:
    for line in head.split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == b"content-length":
            return int(value)
    raise WarcError("an HTTP head has no Content-Length")


def parse(fields: dict[str, str], block: bytes) -> tuple:
    """The values of READ_SCHEMA; of a revisit, size and digest are those of the full payload."""
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, size = fields.get("warc-type"), _length_of(head)
    said = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != said):
        raise WarcError(f"wrong payload in {fields.get('warc-record-id')}")
    bare = [None if fields.get(k) is None else fields[k].strip("<>")
            for k in ("warc-record-id", "warc-refers-to")]
    return (bare[0], kind, fields.get("warc-target-uri"), bare[1], size, said,
            payload if kind == "response" else None)


def read_warc(spark: SparkSession, archives: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the files in column ``path``, as READ_SCHEMA; ``payload`` can be left out."""
    ship_package(spark)
    n = max(1, archives.count())
    wanted = READ_SCHEMA if payload else READ_SCHEMA.removesuffix(", payload binary")
    names = [x.split()[0] for x in wanted.split(", ")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with old_file(path) as stream:
                    rows, size = [], 0
                    for fields, block in read_records(stream):
                        rows.append(parse(fields, block)[:len(names)])
                        size += len(block) if payload else 0
                        if len(rows) >= 1000 or size >= 8 << 20:
                            yield pack(rows)
                            rows, size = [], 0
                    if rows:
                        yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return record_batch({k: (list(v), kinds.get(k, pa.string()))
                             for k, v in zip(names, zip(*rows))})

    slices = min(n, 10_000)
    return archives.select("path").repartition(slices).mapInArrow(run, wanted)


def fresh_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "archive")
