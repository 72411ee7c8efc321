"""WARC archives by way of a chunked record table: payloads travel as (record, chunk number) rows."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import store
from eventmart.session import shared_folder

CHUNK = 1 << 16
CHUNK_TYPE = ("record_id string, record_type string, target string, refers_to string, declared_digest string, declared_bytes long, "
              "chunk_no long, n_bytes long, bytes_so_far long, digest_so_far string, last boolean, data binary")


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1: five hexadecimal digits are four of base32."""
    part = [F.lpad(F.conv(F.substring(hex_digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*part), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def chunked(payload: Column, size: int = CHUNK) -> Column:
    """The payload as an array of pieces; an empty payload is one empty piece."""
    last = F.greatest(F.ceil(F.octet_length(payload) / F.lit(size)).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(payload, k * size + 1, F.lit(size)))


def records(pages: DataFrame, record: str, payload: Column, target: Column, min_revisit: int = 0) -> DataFrame:
    """Chunk rows of the records to write, in order: (record, target, digest, length, refers_to, chunk_no, data).

    Of records with equal payloads (digest and length) of at least `min_revisit` bytes, the one with the largest
    record number holds the payload, the others refer to it and carry no data. A null payload is empty.
    """
    rows = pages.select(F.col(record).cast("long").alias("record"), target.alias("target"), F.coalesce(payload, F.lit(b"")).alias("payload")).select(
        "record", "target", "payload", base32(F.sha1("payload")).alias("digest"), F.octet_length("payload").cast("long").alias("length"))
    copies = rows.where(F.col("length") >= min_revisit).groupBy("digest", "length").agg(F.max("record").alias("keeper"), F.count("*").alias("_n"))
    copies = copies.where("_n > 1 and keeper is not null").select(F.col("digest").alias("_d"), F.col("length").alias("_l"), "keeper")
    again = rows.select("record", "digest", "length").join(copies, (F.col("digest") == F.col("_d")) & (F.col("length") == F.col("_l")))
    again = again.where("record is null or record <> keeper").select(F.col("record").alias("_r"), "_d", "keeper").distinct()
    again = store(again, "revisits")
    rows = rows.join(again, F.col("record").eqNullSafe(F.col("_r")) & (F.col("digest") == F.col("_d")), "left")
    data = F.when(F.col("keeper").isNull(), chunked(F.col("payload"))).otherwise(F.array(F.lit(b"")))
    return rows.select("record", "target", "digest", "length", F.col("keeper").alias("refers_to"), F.posexplode(data).alias("chunk_no", "data"))


def record_name(number: int | None) -> str:
    return f"<urn:record:{'-' if number is None else number}>"


def header(kind: str, fields: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *fields]).encode() + b"\r\n"


def write_archives(chunks: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", max_bytes: int = 1 << 28) -> DataFrame:
    """Write WARC 1.1 files, a gzip member per record, into a folder that all executors share; one row per file written.

    A task streams its records chunk by chunk into files of its own, named at random, and closes one after
    `max_bytes`. Only the files of tasks that ended well are in the result, so a repeated task does no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, packer, path, n, size = None, None, "", 0, 0
        member = lambda: zlib.compressobj(6, zlib.DEFLATED, 31)

        def finish() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [path], "records": [n], "bytes": [size]})

        def put(data: bytes) -> None:
            nonlocal size
            size += len(data)
            out.write(data)

        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk_no"] == 0:
                    if packer:
                        put(packer.compress(b"\r\n\r\n") + packer.flush())
                        packer = None
                    if out and size >= max_bytes:
                        yield finish()
                        out = None
                    if not out:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        path, n, size = f"{root}/{name}", 0, 0
                        out = system.open_output_stream(path, compression=None)
                        info, packer = b"format: WARC File Format 1.1\r\n", member()
                        put(packer.compress(header("warcinfo", [
                            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields"),
                            ("Content-Length", str(len(info)))]) + info + b"\r\n\r\n") + packer.flush())
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['length']}\r\n\r\n".encode()
                    copy = row["refers_to"] is not None
                    extra = [("WARC-Refers-To", record_name(row["refers_to"])),
                             ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if copy else []
                    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in row["target"] or "")
                    packer = member()
                    n += 1
                    put(packer.compress(header("revisit" if copy else "response", [
                        ("WARC-Record-ID", record_name(row["record"])), ("WARC-Date", date), *([("WARC-Target-URI", uri)] if uri else []),
                        ("WARC-Payload-Digest", f"sha1:{row['digest']}"), *extra, ("Content-Type", "application/http; msgtype=response"),
                        ("Content-Length", str(len(http) + (0 if copy else row["length"])))]) + http))
                put(packer.compress(row["data"]))
        if packer:
            put(packer.compress(b"\r\n\r\n") + packer.flush())
        if out:
            yield finish()

    return store(chunks.mapInArrow(run, "file string, records long, bytes long"), "archives")


class Stream:
    """Bytes of a gzip file, member after member, held a block at a time."""

    def __init__(self, source: pa.NativeFile, block: int) -> None:
        self.source, self.block, self.held, self.unpack = source, block, bytearray(), None

    def more(self) -> bool:
        rest = self.unpack.unconsumed_tail or self.unpack.unused_data if self.unpack else b""
        if self.unpack is None or self.unpack.eof:
            self.unpack = zlib.decompressobj(31)
        rest = rest or self.source.read(self.block)
        if not rest:
            return False
        self.held += self.unpack.decompress(rest, 4 * self.block)
        return True

    def take(self, n: int) -> bytes:
        """Up to n bytes: fewer only at the end."""
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (at := self.held.find(mark, start)) < 0:
            start = max(0, len(self.held) - len(mark))
            if not self.more():
                return None
        return self.take(at + len(mark))


def fields(block: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in block.decode().split("\r\n")[1:]) if k}


def chunk_rows(stream: Stream, size: int, with_data: bool) -> Iterator[tuple]:
    while (head := stream.until(b"\r\n\r\n")) is not None:
        h = fields(head)
        left, kind = int(h["content-length"]), h["warc-type"]
        if kind in ("response", "revisit"):
            http = stream.until(b"\r\n\r\n")
            left -= len(http)
            declared = int(fields(http)["content-length"])
            digest, so_far, k = hashlib.sha1(), 0, 0
            while True:
                data = stream.take(min(size, left))
                left, so_far = left - len(data), so_far + len(data)
                digest.update(data)
                last = left == 0 or not data
                yield (h["warc-record-id"], kind, h.get("warc-target-uri"), h.get("warc-refers-to"), h["warc-payload-digest"].removeprefix("sha1:"),
                       declared, k, len(data), so_far, base64.b32encode(digest.digest()).decode(), last, data if with_data else None)
                k += 1
                if last:
                    break
        while left > 0 and (skipped := stream.take(min(size, left))):
            left -= len(skipped)
        stream.take(4)


def read_archives(archives: DataFrame, folder: str, chunk: int = CHUNK, with_data: bool = True, block: int = 1 << 18) -> DataFrame:
    """The chunked record table of the files named in `archives`: a row per record and chunk of its payload.

    Each row carries its number of bytes, and the bytes and the SHA-1 of the payload up to its end; the last
    one of a record so has the digest of all. A revisit has one empty chunk. A task holds a few blocks,
    whatever the size of a record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(folder)
        names = [x.split()[0] for x in CHUNK_TYPE.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[x.split()[1]] for x in CHUNK_TYPE.split(", ")]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with system.open_input_stream(path, compression=None) as source:
                    rows = []
                    for row in chunk_rows(Stream(source, block), chunk, with_data):
                        rows.append(row)
                        if len(rows) >= 64:
                            yield out(rows)
                            rows = []
                    if rows:
                        yield out(rows)

    # one file a task: a few names are no work to deal out
    files = archives.select("file").repartition(max(1, min(10_000, archives.count())))
    return files.mapInArrow(run, CHUNK_TYPE)


def archive_folder(spark) -> str:
    return f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): `pages` written to WARC files, read back and checked.

    Null html is an empty payload, a null url leaves out the target. Records equal in payload and page_id
    are of one kind; where the largest page_id occurs more than once, each of these is a response. A null
    page_id is written as "-" and read back as null; it revisits the page that holds its payload. Digests are
    those computed while reading (for a revisit, the one in its header); a response whose payload does not
    agree with its header raises an error. An empty table gives no files and an empty result.
    """
    folder = archive_folder(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    archives = write_archives(records(pages, "page_id", payload, F.col("url")), folder)
    last = read_archives(archives, folder, with_data=False).where("last")
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:record:(.*)>', 1) as long)")
    revisit = F.col("record_type") == "revisit"
    wrong = ~revisit & ((F.col("digest_so_far") != F.col("declared_digest")) | (F.col("bytes_so_far") != F.col("declared_bytes")))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("payload differs from its header: "), F.col("record_id")))).otherwise(F.col("declared_digest"))
    return last.select(number("record_id").alias("page_id"), F.col("declared_bytes").alias("payload_bytes"), checked.alias("payload_digest"),
                       "record_type", number("refers_to").alias("refers_to"))
