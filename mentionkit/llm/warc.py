"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

The writer puts a record per page into archives of bounded size. Of equal payloads of ``LEAST`` bytes or more the one with the largest page id is stored
as a response, the others as revisits that name it; they carry the HTTP header only. Each archive has a dictionary of its own, trained on its first records.
The reader loads that dictionary, decodes frame by frame and validates version, mandatory fields, lengths, record ends and digests.

Archives are rows of name and content, which Spark writes and commits like any table; ``save`` puts such a table out as files and ``load`` reads
files. A task holds one archive. Defined results: NULL html is an empty payload; a NULL url leaves the target out; line ends in a url are percent-encoded;
rows that share both page id and payload are all responses if that id is the largest; a payload whose pages have no id refers to none and is a
response; no pages give no archives; very long payloads stay whole, in an archive of their own; other columns, whatever their names, are not read. Ids of all
64 bits come back unchanged, also beside NULL.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionkit.llm.common import small_batches
from mentionkit.sources.shared import store

LEAST = 1000
"""Bytes from which equal payloads are stored once."""
ARCHIVE_BYTES = 4 << 20
"""Bytes of records after which an archive ends; one record may be larger."""
DICTIONARY_BYTES, DICTIONARY_SAMPLES = 16 << 10, 128
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the formats
VERSION = b"WARC/1.1"
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_ID = "urn:page:"


class BadArchive(ValueError):
    """An archive that does not hold what its headers say."""


def record(page_id, url, payload: bytes, n_bytes: int, sha1_hex: str, refers_to) -> bytes:
    """One WARC record; ``refers_to`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_ID}{refers_to}>")]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return head + b"\r\n" + block + _END


def archive(records: list[bytes]) -> bytes:
    """Records as one archive."""
    out, options = [], {}
    samples = [r[:DICTIONARY_BYTES] for r in records[:DICTIONARY_SAMPLES]]
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:  # too little to learn from
        trained = b""
    if trained:
        packed = zstandard.ZstdCompressor(level=9).compress(trained)
        out.append(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        options["dict_data"] = zstandard.ZstdCompressionDict(trained)
    pack = zstandard.ZstdCompressor(level=3, write_checksum=True, **options)
    out.extend(pack.compress(r) for r in records)
    return b"".join(out)


def frames(content: bytes):
    """The decoded frames of an archive, one by one."""
    at, options = 0, {}
    view = memoryview(content)
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", content, 4)[0]
        at = 8 + size
        if at > len(content):
            raise BadArchive("the dictionary's frame is cut off")
        packed = bytes(view[8:at])
        if len(packed) >= 4 and struct.unpack_from("<I", packed)[0] == FRAME:
            packed = zstandard.ZstdDecompressor().decompress(packed)
        options["dict_data"] = zstandard.ZstdCompressionDict(packed)
    unpack = zstandard.ZstdDecompressor(**options)
    while at < len(content):
        one = unpack.decompressobj()
        parts, used = [], at
        try:
            # fed in steps, so that what follows a frame is not copied for every record
            while not one.eof:
                if used >= len(content):
                    raise BadArchive(f"the frame at {at} is cut off")
                step = view[used : used + 65536]
                parts.append(one.decompress(step))
                used += len(step)
        except zstandard.ZstdError as e:
            raise BadArchive(f"the frame at {at}: {e}") from e
        at = used - len(one.unused_data)
        yield b"".join(parts)


def parse(raw: bytes) -> dict:
    """A record's fields after validation, names in lower case, with ``block``."""
    head, found, rest = raw.partition(_END)
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise BadArchive("no WARC version line or header end")
    fields: dict = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise BadArchive(f"not a header field: {line[:80]!r}")
        fields[name.decode().lower()] = value.strip().decode()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise BadArchive(f"field {name} is missing")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + len(_END) or rest[-4:] != _END:
        raise BadArchive("the block is not as long as its header says")
    fields["block"] = rest[:-4]
    return fields


def page_of(fields: dict) -> dict:
    """What a page's record says: id, payload, its size and digest, type and reference."""

    def number(name: str):
        value = fields.get(name)
        if value is None:
            return None
        if not value.startswith(f"<{_ID}") or not value.endswith(">"):
            raise BadArchive(f"{name} is no page: {value[:80]}")
        value = value[len(_ID) + 1 : -1]
        return int(value) if value else None

    head, found, payload = fields["block"].partition(_END)
    sizes = [v for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:]) if k.lower() == b"content-length"]
    if not found or len(sizes) != 1 or not sizes[0].strip().isdigit():
        raise BadArchive("the HTTP header has no length")
    size = int(sizes[0])
    label, _, code = fields.get("warc-payload-digest", "").partition(":")
    if label != "sha1" or len(code) != 32:
        raise BadArchive("no SHA-1 digest of the payload")
    digest = base64.b32decode(code).hex()
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise BadArchive("the payload does not agree with its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise BadArchive("a revisit with a payload or without a reference")
    if kind not in ("response", "revisit"):
        raise BadArchive(f"type {kind}")
    return {
        "page_id": number("warc-record-id"), "url": fields.get("warc-target-uri"), "payload": payload if kind == "response" else None,
        "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number("warc-refers-to"),
    }


def records(pages: DataFrame) -> DataFrame:
    """Pages to ``page_id, url, payload, n_bytes, sha1, refers_to``; a revisit has no payload.

    Copies are found on digests alone; the pages themselves meet their group's row in a join whose hot keys adaptive execution splits.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha1("payload").alias("sha1"))
    groups = rows.where(F.col("n_bytes") >= LEAST).groupBy("sha1").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    # small payloads have no group: they go by page, so that equal ones, such as all empty pages, do not meet in one task
    key = F.when(F.col("n_bytes") >= LEAST, F.col("sha1")).otherwise(F.concat_ws(" ", F.lit("page"), "page_id", "url"))
    joined = rows.withColumn("key", key).join(groups.where("n > 1").select(F.col("sha1").alias("key"), "kept"), "key", "left")
    again = F.col("kept").isNotNull() & ~F.col("kept").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "n_bytes", "sha1", F.when(again, F.col("kept")).alias("refers_to")
    )


def _write(batches):
    waiting, size, number = [], 0, 0
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    for batch in batches:
        for row in batch.itertuples(index=False):
            waiting.append(record(row.page_id, row.url, row.payload, int(row.n_bytes), row.sha1, row.refers_to))
            size += len(waiting[-1])
            if size >= ARCHIVE_BYTES:
                yield pd.DataFrame({"name": [f"pages-{part:06d}-{number:06d}.warc.zst"], "content": [archive(waiting)]})
                waiting, size, number = [], 0, number + 1
    if waiting:
        yield pd.DataFrame({"name": [f"pages-{part:06d}-{number:06d}.warc.zst"], "content": [archive(waiting)]})


def write_archives(pages: DataFrame) -> DataFrame:
    """Pages to archives, ``name, content``."""
    small_batches(pages.sparkSession)
    # ids travel as text: a column of numbers with NULL would pass through floats
    rows = records(pages).withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return rows.mapInPandas(_write, "name string, content binary")


_PAGES = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
_FLUSH = 8 << 20


def _reader(payloads: bool, strict: bool):
    names = [c.split()[0] for c in _PAGES.split(", ")] + ["archive", "problem"]

    numbers = ("page_id", "payload_bytes", "refers_to")

    def frame(rows):
        columns = {n: [r[k] for r in rows] for k, n in enumerate(names)}
        return pd.DataFrame({n: pd.array(v, dtype="Int64" if n in numbers else object) for n, v in columns.items()})

    def read(batches):
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                rows, size = [], 0
                try:
                    for raw in frames(content):
                        page = page_of(parse(raw))
                        if not payloads:
                            page["payload"] = None
                        rows.append([*page.values(), name, None])
                        size += len(raw)
                        if size >= _FLUSH:
                            yield frame(rows)
                            rows, size = [], 0
                except BadArchive as e:
                    if strict:
                        raise BadArchive(f"{name}: {e}") from e
                    # what follows a bad frame cannot be told apart
                    rows.append([None] * 7 + [name, str(e)])
                yield frame(rows)

    return read


def read_archives(archives: DataFrame, payloads: bool = True, strict: bool = True) -> DataFrame:
    """Archives, ``name, content``, to a row per record. Not ``strict``: a bad archive gives a row with its ``problem``."""
    small_batches(archives.sparkSession)
    return archives.select("name", "content").mapInPandas(_reader(payloads, strict), f"{_PAGES}, archive string, problem string")


def save(archives: DataFrame, folder: str) -> None:
    """Put a stored table of archives out as files; a repeated task writes the same bytes under the same name."""

    def put(rows):
        from pyarrow import fs

        target, base = fs.FileSystem.from_uri(folder)
        target.create_dir(base, recursive=True)
        for row in rows:
            # the content is compressed already, whatever the name says
            with target.open_output_stream(f"{base}/{row['name']}", compression=None) as out:
                out.write(bytes(row["content"]))

    archives.select("name", "content").foreachPartition(put)


def load(spark: SparkSession, folder: str) -> DataFrame:
    """Archive files as ``name, content``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def archive_report(pages: DataFrame) -> DataFrame:
    """Write archives to the shared folder and read them back."""
    archives = store(write_archives(pages), "warc")
    return read_archives(archives, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
