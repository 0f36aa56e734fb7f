"""WARC archives compressed record by record with a dictionary of their own.

An archive file begins with a skippable frame that holds a Zstandard dictionary, built from records
of that same archive; every record follows as a frame of its own, so that one record can be read
without those before it. Of records with equal payloads one is a response and the others are revisits
that name it. Archives are written to a shared folder by the tasks, each under the name of its
partition, number and attempt. A table lists them; it is written by the same tasks and holds those of
one attempt each, so what an attempt left behind that was lost or overtaken is never read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows
from orderlens.session import scratch_dir

ARCHIVE_BYTES = 16_000_000
"""Uncompressed bytes of records after which an archive is closed; a task holds one at a time."""

DICTIONARY_BYTES = 64 * 1024
SAMPLE_BYTES = 2_000_000
"""Bytes of evenly spread records that a dictionary is built from."""

LEVEL = 3
LEAST_PAYLOAD = 100
"""Payloads shorter than this are never revisits."""

READERS = 10_000
"""Tasks that read archives, at most; more archives are several to a task."""

MAGIC = 0x184D2A5D
"""Fixed value: the skippable frame that holds a WARC dictionary."""

DATE = "1970-01-01T00:00:00Z"
"""The tables hold no capture time."""

WRITTEN = "archive string, records long, bytes long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit of ``refers_to`` without."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + payload if refers_to is None else http
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{kind}:{page_id}:{digest}")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{name}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "" if url is None else quote(url, safe="!#$&'()*+,/:;=?@[]~%")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
    ]
    if refers_to is not None:
        target = uuid.uuid5(uuid.NAMESPACE_URL, f"response:{refers_to}:{digest}")
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{target}>"),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v != "") + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary of records taken at even steps; of so few that none can be trained, their bytes."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r[:SAMPLE_BYTES] for r in records[::step]]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(total // 8, 1024)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def pack(records: list[bytes]) -> bytes:
    """An archive: the dictionary in a leading skippable frame, then a frame for each record."""
    dictionary = build_dictionary(records)
    writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
    frames = [writer.compress(r) for r in records]
    return b"".join([struct.pack("<II", MAGIC, len(dictionary)), dictionary, *frames])


def unpack(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, in order."""
    magic, size = struct.unpack_from("<II", archive)
    if magic != MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(archive[8 : 8 + size]))
    rest = memoryview(archive)[8 + size :]
    while len(rest):
        stream = reader.decompressobj()
        yield stream.decompress(rest)
        rest = rest[len(rest) - len(stream.unused_data) :]


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record's length is not the stated one")
    return fields, block.partition(b"\r\n\r\n")[2]


def with_referrals(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest`` and ``refers_to``, null for what is to be a response.

    The smallest id of a payload is found on digests alone, counted in part before they are moved.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    digested = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"))
    long_ = F.octet_length(payload) >= LEAST_PAYLOAD
    repeated = (
        pages.where(long_)
        .groupBy(F.sha2(payload, 256).alias("digest"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    revisit = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    revisit = F.when(F.col("page_id").isNull(), F.col("first")).otherwise(revisit)
    joined = digested.join(repeated, "digest", "left")
    return joined.select("page_id", "url", "html", "digest", revisit.alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives of ``pages`` under ``folder`` now; their names, numbers of records and bytes.

    ``folder`` must be one that all executors reach, by any scheme pyarrow knows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        task = TaskContext.get()
        store.create_dir(root, recursive=True)

        def close(records: list[bytes], number: int) -> pa.RecordBatch:
            name = f"{task.partitionId():06d}-{number:05d}-{task.taskAttemptId()}.warc.zst"
            data = pack(records)
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            return pa.record_batch([[name], [len(records)], [len(data)]], names=["archive", "records", "bytes"])

        records, size, number = [], 0, 0
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                records.append(record(page_id, url, (html or "").encode(), digest, refers_to))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield close(records, number)
                    records, size, number = [], 0, number + 1
        if records:
            yield close(records, number)

    with_referrals(pages).mapInArrow(run, WRITTEN).write.parquet(f"{folder}-written")
    return written(pages.sparkSession, folder)


def _store(folder: str):
    """The file system of a folder, and the folder's path there."""
    from pyarrow import fs

    # Hadoop's names of the object store's scheme.
    if folder.startswith(("s3a://", "s3n://")):
        folder = "s3" + folder[3:]
    return fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")


def written(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of ``folder`` that were written to the end: name, number of records and bytes."""
    return spark.read.parquet(f"{folder}-written")


def _read(content: bytes) -> Iterator[tuple]:
    for data in unpack(content):
        fields, payload = parse(data)
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        kind, size = fields["WARC-Type"], int(fields["X-Payload-Length"])
        if kind == "response" and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not the one that was written")
        page_id, refers_to = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
        yield (
            page_id and int(page_id),
            size,
            digest,
            kind,
            refers_to and int(refers_to),
            fields.get("WARC-Target-URI"),
        )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per record of the archives that ``written`` lists: page_id, payload_bytes, payload_digest,
    record_type, refers_to and url. Payloads of responses are decompressed and checked against their
    digests. An archive is read by one task, and a task reads a few; other files are not looked at."""
    listed = written(spark, folder).select("archive")
    tasks = max(1, min(listed.count(), READERS))

    def run(name: str) -> Iterator[tuple]:
        store, root = _store(folder)
        with store.open_input_stream(f"{root}/{name}") as source:
            yield from _read(source.read())

    return map_rows(listed.repartition(tasks, "archive"), run, READ)


def archive(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in a new shared folder and read them back, one row a page.

    A null html is an empty payload, and a null url an empty one. Of equal payloads of at least 100
    bytes the rows of the smallest page_id are responses (all of them where rows repeat) and the
    others revisits; a null page_id is never the smallest, and where all are null all are responses.
    Empty tables give no archives and no rows. Further columns are not written.
    """
    spark = pages.sparkSession
    folder = f"{scratch_dir(spark)}/warc-{uuid.uuid4()}"
    if write(pages, folder).isEmpty():
        return spark.createDataFrame([], READ)
    return read(spark, folder)
