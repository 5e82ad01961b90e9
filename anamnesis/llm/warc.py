"""WARC archives written and read as chunked record tables."""

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, partitions, scratch_path

#: Payload bytes of one chunk row; no step holds more than a few chunks of a record besides its input row.
CHUNK = 1 << 18
#: Payloads below are never revisits.
LEAST = 100
#: Bytes of an archive file after which the next record opens another.
FILE_BYTES = 1 << 28
RECORD_ID = b"<urn:page:%s>"
CRLF = b"\r\n"
LEVEL = 3


def chunk_rows(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``pages`` (with binary ``payload``) as rows (record columns, chunk_no, n_chunks, data), in order.

    An empty payload is one empty chunk. The numbers of the chunks are spread out
    and each row's ``data`` is cut from the payload by itself, so a record's chunks
    follow each other in one partition and never stand in one array.
    """
    n_chunks = F.greatest(F.ceil(F.octet_length("payload") / chunk).cast("int"), F.lit(1))
    others = [c for c in pages.columns if c != "payload"]
    spread = pages.select(*others, "payload", n_chunks.alias("n_chunks"), F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("chunk_no"))
    return spread.select(*others, "n_chunks", "chunk_no", F.substring(F.col("payload"), F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data"))


def _named(pages: DataFrame) -> DataFrame:
    return pages.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))


def marks(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, payload_digest, refers_to, repeated): what is said of records besides plain responses.

    The first pass over ``pages`` (page_id, url, payload): it carries ids and digests
    alone. Of equal payloads (by SHA-256) of at least ``least`` bytes, the rows of the
    smallest page_id are responses and the others revisit it; null page_ids come
    after all others. ``repeated`` marks page_ids that stand more than once. The
    smallest ids and the counts are aggregated before they are shuffled.
    """
    narrow = _named(pages).select("page_id", "payload_digest", "payload_bytes")
    narrow = materialize(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("n")), "warc-digests")
    firsts = (
        narrow.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.sum("n").alias("n")).where("n > 1")
        .select(F.col("payload_digest").alias("of"), "refers_to")
    )
    again = narrow.groupBy("page_id").agg(F.sum("n").alias("n")).where("n > 1").select(F.col("page_id").alias("id"), F.lit(True).alias("repeated"))
    both = narrow.join(firsts, F.col("payload_digest") == F.col("of"), "left").join(again, F.col("page_id").eqNullSafe(F.col("id")), "left")
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("refers_to"))
    marked = both.select("page_id", "payload_digest", F.when(later, F.col("refers_to")).alias("refers_to"), F.coalesce("repeated", F.lit(False)).alias("repeated"))
    return materialize(marked.where("refers_to is not null or repeated"), "warc-marks")


def record_chunks(pages: DataFrame, least: int = LEAST, chunk: int = CHUNK) -> DataFrame:
    """Chunk rows of every record, with record_type, refers_to and record_id.

    The second pass cuts chunks straight from the scan; they meet the marks one by
    one, so no shuffle or sort holds more of a payload than a chunk. A revisit
    keeps one chunk without data. ``place`` keeps the chunks of a row together where
    page_ids or whole rows are repeated, and makes their record ids unlike.
    """
    found = marks(pages, least)
    found = found.select(F.col("page_id").alias("of_id"), F.col("payload_digest").alias("of_digest"), "refers_to", "repeated")
    rows = chunk_rows(_named(pages).withColumn("place", F.monotonically_increasing_id()), chunk)
    both = rows.join(found, rows["page_id"].eqNullSafe(found["of_id"]) & (rows["payload_digest"] == found["of_digest"]), "left")
    revisit = F.col("refers_to").isNotNull()
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
    unlike = F.concat(name, F.lit(":"), F.col("payload_digest"), F.lit(":"), F.col("place").cast("string"))
    both = both.where(~revisit | (F.col("chunk_no") == 0))
    return both.select(
        "page_id", "url", "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), "refers_to",
        F.when(F.coalesce("repeated", F.lit(False)), unlike).otherwise(name).alias("record_id"), "place", "chunk_no",
        F.when(revisit, 1).otherwise(F.col("n_chunks")).alias("n_chunks"), F.when(revisit, F.lit(b"")).otherwise(F.col("data")).alias("data"),
    ).sortWithinPartitions("page_id", "payload_digest", "place", "chunk_no")


def _refers_to(page_id) -> bytes:
    return RECORD_ID % str(page_id).encode()


def _http_head(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def _head(row: dict, date: str) -> bytes:
    http = _http_head(row["payload_bytes"])
    revisit = row["record_type"] == "revisit"
    fields = [
        b"WARC/1.1", b"WARC-Type: " + row["record_type"].encode(), b"WARC-Record-ID: <" + row["record_id"].encode() + b">",
        b"WARC-Date: " + date.encode(),
        b"WARC-Payload-Digest: sha256:" + row["payload_digest"].encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % (len(http) + (0 if revisit else row["payload_bytes"])),
    ]
    if row["url"]:
        fields.append(b"WARC-Target-URI: " + b"".join(row["url"].encode().split()))
    if revisit:
        fields += [b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                   b"WARC-Refers-To: " + _refers_to(row["refers_to"])]
    return CRLF.join(fields) + CRLF + CRLF + http


class _Writer:
    """Records into files of a folder, each record a gzip member; data passes through in chunks."""

    def __init__(self, folder: str, date: str, file_bytes: int):
        self.uri = folder
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.date, self.file_bytes = date, file_bytes
        self.out, self.path, self.written, self.records = None, None, 0, 0

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.written += len(data)

    def begin(self, row: dict) -> None:
        if self.out is None:
            name = f"{uuid.uuid4().hex}.warc.gz"  # an attempt of a task never meets another's file
            self.path = f"{self.uri}/{name}"
            self.out, self.written, self.records = self.fs.open_output_stream(f"{self.folder}/{name}"), 0, 0
        self.packed = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        self.digest, self.length = hashlib.sha256(), 0
        self._put(self.packed.compress(_head(row, self.date)))

    def chunk(self, data: bytes) -> None:
        self.digest.update(data)
        self.length += len(data)
        self._put(self.packed.compress(data))

    def end(self, row: dict) -> dict | None:
        """A finished file, if this record filled it."""
        if row["record_type"] == "response" and (self.digest.hexdigest(), self.length) != (row["payload_digest"], row["payload_bytes"]):
            raise ValueError(f"chunks of page {row['page_id']} do not make up its payload")
        self._put(self.packed.compress(CRLF + CRLF))
        self._put(self.packed.flush())
        self.records += 1
        return self.close() if self.written >= self.file_bytes else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        return {"path": self.path, "bytes": self.written, "records": self.records}


def write(chunks: DataFrame, folder: str, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``record_chunks`` to WARC files in ``folder``; returns its manifest (path, bytes, records).

    ``folder`` is a URI that all executors reach. Files are named at random per
    attempt of a task, and the manifest lists only those of attempts that
    succeeded, so a lost executor's files are never read. Revisits carry
    headers alone.
    """
    wanted = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
    rows = chunks.select(*wanted, "chunk_no", "n_chunks", "data")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = _Writer(folder, date, file_bytes), []
        for batch in batches:
            heads = batch.select([*wanted, "chunk_no", "n_chunks"]).to_pylist()
            data = batch.column(batch.schema.get_field_index("data"))
            for row, part in zip(heads, data):
                if row["chunk_no"] == 0:
                    writer.begin(row)
                writer.chunk(part.as_py())
                if row["chunk_no"] + 1 == row["n_chunks"]:
                    done.append(writer.end(row))
        done = [x for x in (*done, writer.close()) if x]
        yield pa.RecordBatch.from_pylist(done, pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    return materialize(rows.mapInArrow(written, "path string, bytes bigint, records bigint"), "warc-manifest")


class _Stream:
    """The unpacked bytes of a file of gzip members, in bounded pieces."""

    def __init__(self, raw, piece: int):
        self.raw, self.piece, self.unpack, self.rest, self.held = raw, piece, zlib.decompressobj(31), b"", b""

    def _more(self) -> bytes:
        while True:
            if not self.rest:
                self.rest = self.raw.read(self.piece)
                if not self.rest:
                    return b""
            data = self.unpack.decompress(self.rest, self.piece)
            if self.unpack.eof:
                self.rest, self.unpack = self.unpack.unused_data, zlib.decompressobj(31)
            else:
                self.rest = self.unpack.unconsumed_tail
            if data:
                return data

    def head(self) -> bytes | None:
        """Up to and without an empty line; None at the end of the file."""
        while (at := self.held.find(CRLF + CRLF)) < 0:
            data = self._more()
            if not data:
                if self.held.strip():
                    raise ValueError("archive ends within a header")
                return None
            self.held += data
        found, self.held = self.held[:at], self.held[at + 4:]
        return found

    def take(self, size: int) -> Iterator[bytes]:
        """The next ``size`` bytes, in pieces."""
        while size:
            data = self.held or self._more()
            if not data:
                raise ValueError("archive ends within a record")
            part, self.held = data[:size], data[size:]
            size -= len(part)
            yield part


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _rechunked(pieces: Iterable[bytes], chunk: int) -> Iterator[bytes]:
    """Pieces of ``chunk`` bytes, the last with the rest; nothing is one empty piece."""
    held, given = bytearray(), False
    for piece in pieces:
        held += piece
        while len(held) >= chunk:
            yield bytes(held[:chunk])
            del held[:chunk]
            given = True
    if held or not given:
        yield bytes(held)


def records(stream: _Stream, chunk: int) -> Iterator[dict]:
    """Chunk rows of an archive: the last of a record carries the digest of all of it."""
    while (head := stream.head()) is not None:
        warc = _fields(head)
        length = int(warc["content-length"])
        http = stream.head()
        told = int(_fields(http)["content-length"])
        numeral = lambda name: warc.get(name, "<urn:page:null>")[len("<urn:page:"):-1].partition(":")[0]
        number = lambda name: None if numeral(name) == "null" else int(numeral(name))
        row = {"page_id": number("warc-record-id"), "record_type": warc["warc-type"], "url": warc.get("warc-target-uri"),
               "refers_to": number("warc-refers-to") if warc["warc-type"] == "revisit" else None, "payload_bytes": told}
        digest, seen, ready = hashlib.sha256(), 0, None
        for chunk_no, data in enumerate(_rechunked(stream.take(length - len(http) - 4), chunk)):
            if ready:
                yield ready
            digest.update(data)
            seen += len(data)
            ready = {**row, "chunk_no": chunk_no, "data": data, "running_digest": digest.hexdigest(), "running_bytes": seen, "is_last": False}
        stored = warc["warc-payload-digest"].partition(":")[2]
        if row["record_type"] == "response" and (ready["running_digest"], seen) != (stored, told):
            raise ValueError(f"record {warc['warc-record-id']} does not match its digest")
        yield {**ready, "is_last": True, "payload_digest": stored}
        if b"".join(stream.take(4)) != CRLF + CRLF:
            raise ValueError("record without its end")


ROWS = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
    ("chunk_no", pa.int64()), ("data", pa.binary()), ("running_digest", pa.string()), ("running_bytes", pa.int64()),
    ("is_last", pa.bool_()), ("payload_digest", pa.string()),
])


def read(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The archives of a manifest as chunk rows.

    (page_id, record_type, url, refers_to, payload_bytes, chunk_no, data,
    running_digest, running_bytes, is_last, payload_digest): digest and length
    run along a record's chunks; the row marked ``is_last`` carries the stored
    digest, which for a response has been compared with what was read. A file is
    unpacked piece by piece; batches are bounded by bytes.
    """
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = pafs.FileSystem.from_uri(path)
                with fs.open_input_stream(name) as raw:
                    held, size = [], 0
                    for row in records(_Stream(raw, CHUNK), chunk):
                        held.append(row)
                        size += len(row["data"]) + 200
                        if size >= 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(held, ROWS)
                            held, size = [], 0
                    yield pa.RecordBatch.from_pylist(held, ROWS)

    spread = manifest.select("path").repartition(partitions(manifest.sparkSession), "path")
    return spread.mapInArrow(unpacked, ", ".join(
        f"{f.name} {dict(int64='bigint', string='string', binary='binary', bool='boolean')[str(f.type)]}" for f in ROWS))


def _payload(pages: DataFrame) -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def archive(pages: DataFrame, folder: str | None = None, least: int = LEAST, chunk: int = CHUNK, **settings) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as WARC files, by default in the shared folder; returns the manifest.

    Records are named by page_id, and where a page_id stands more than once by digest
    and place too, so that no two records of an archive share a name. A null html
    is empty, a null or empty url is left out, a null page_id is the record id null
    and comes last in order. Rows that share the smallest page_id of a payload are
    all responses; revisits name that page_id. Extra columns are ignored; an empty
    table gives an empty manifest.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    # The folder is made by a table of one file, through the same store that Spark writes to.
    pages.sparkSession.range(1).coalesce(1).write.mode("ignore").parquet(f"{folder}/made")
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", _payload(pages).alias("payload"))
    return write(record_chunks(named, least, chunk), folder, **settings)


def digests(chunks: DataFrame) -> DataFrame:
    """One row per record read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    return chunks.where("is_last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return digests(read(archive(pages)))


#: The check of the contract.
SQL = f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= {LEAST} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= {LEAST} AND page_id > first THEN first END AS refers_to
    FROM f
"""
