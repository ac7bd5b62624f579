"""WARC archives in Zstandard with a dictionary built from the archived records.

An archive is a skippable frame (magic 0x184D2A5D) that holds the dictionary, then one Zstandard frame
per record, so any record can be read alone. The dictionary is trained on at most SAMPLE_BYTES of the
archive's own first records; where these are too few to train on, their bytes are the dictionary. A payload that
several records share is stored once, in the response with the largest id; the others are revisit
records that refer to it and carry its digest and length.

Archives go to a folder that all executors share. Every attempt of a task writes new names and the
manifest lists only what successful attempts wrote, so a lost executor leaves no broken archive in
it; the manifest is kept in the shared folder, and so archives are not written twice.

Defined cases: a null payload is empty; payloads under `least` bytes are never revisited; repeated rows
of one id are all responses if theirs is the largest id of the payload; a null id writes a record
without one, which is read back as null and is never referred to; a null URL becomes one made of the
id, and control characters in a URL are percent-encoded; an empty table writes no archive. Columns
other than id, URL and payload are not read. Payloads that cannot be revisited, so all empty ones, meet no
others. A writer holds one archive and its longest record, a reader one record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isarithm.llm import words as W
from isarithm.llm.storage import cut, fresh_dir

LEAST = 1000
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
LEVEL = 3
#: Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"
MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One response record, or a revisit record where refers_to is given."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    safe = quote(url, safe="%:/?#[]@!$&'()*+,;=~-._") if url else f"{_ID}{'' if page_id is None else page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        VERSION,
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {safe}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: {digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(text: str) -> int | None:
    digits = text.strip("<>").removeprefix(_ID)
    return int(digits) if digits else None


def parse(raw: bytes) -> dict:
    """The fields of a record; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != VERSION:
        raise ValueError(f"not a record: {first[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(body) != length or hashlib.sha1(body).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": _number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "record_type": kind,
        "refers_to": _number(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload": body if kind == "response" else None, "payload_bytes": length, "payload_digest": digest,
    }


def archive(records: list[bytes]) -> bytes:
    """The records as one archive, with a dictionary trained on the first of them."""
    sample, held = [], 0
    for r in records:
        if held >= SAMPLE_BYTES:
            break
        sample.append(r[: 128 << 10])
        held += len(sample[-1])
    try:
        dictionary = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, held // 8)), sample, k=256, d=8)
    except zstandard.ZstdError:  # too little to train on
        dictionary = zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    lead = struct.pack("<II", SKIPPABLE, len(dictionary.as_bytes())) + dictionary.as_bytes()
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    return lead + b"".join(packer.compress(r) for r in records)


def records_in(stream, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The records of an open archive, one after the other."""
    held = stream.read(8)
    dictionary = None
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == SKIPPABLE:
        dictionary = zstandard.ZstdCompressionDict(stream.read(struct.unpack("<I", held[4:])[0]))
        held = b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        held = held or stream.read(chunk)
        if not held:
            return
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if not held:
                held = stream.read(chunk)
                if not held:
                    raise ValueError("archive ends within a record")
            parts.append(frame.decompress(held))
            held = frame.unused_data if frame.eof else b""
        yield b"".join(parts)


def _writer(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        scheme = folder[: len(folder) - len(base)] if folder.endswith(base) else ""
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size
            name = f"{base}/{uuid.uuid4().hex}.warc.zst"
            data = archive(held)
            with fs.open_output_stream(name + ".part", compression=None) as out:
                out.write(data)
            fs.move(name + ".part", name)
            row = pa.RecordBatch.from_pydict({"path": [scheme + name], "records": pa.array([len(held)], pa.int64()), "bytes": pa.array([len(data)], pa.int64())})
            held, size = [], 0
            return row

        fs.create_dir(base, recursive=True)
        for batch in batches:
            ids, urls, refers = (batch.column(k).to_pylist() for k in (1, 2, 3))
            data, at = W.flat(batch.column(0))
            for i, (page, url, ref) in enumerate(zip(ids, urls, refers, strict=True)):
                held.append(record(page, url, data[at[i] : at[i + 1]].tobytes(), ref, date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield flush()
        if held:
            yield flush()

    return run


def write(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives, now, and returns their manifest: path, records, bytes."""
    folder = folder or fresh_dir(pages.sparkSession, "warc")
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(html.alias("payload"), F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"))
    # Payloads of at least two records, by digest and length: only digests are shuffled for this.
    able = (F.octet_length("payload") >= least) & F.col("page_id").isNotNull()
    keys = rows.where(able).select(F.sha1("payload").alias("k"), F.octet_length("payload").alias("n"), "page_id")
    heads = keys.groupBy("k", "n").agg(F.count("*").alias("c"), F.max("page_id").alias("head")).where("c > 1").drop("c")
    marked = rows.where(able).withColumns({"k": F.sha1("payload"), "n": F.octet_length("payload")}).join(heads, ["k", "n"], "left")
    refers = F.when(F.col("head") != F.col("page_id"), F.col("head")).alias("refers_to")
    ready = marked.select("payload", "page_id", "url", refers).unionByName(rows.where(~able).select("payload", "page_id", "url", F.lit(None).cast("long").alias("refers_to")))
    return cut(ready.mapInArrow(_writer(folder, date), MANIFEST))


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the archives in the manifest; without payloads only their digests and lengths come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = pyarrow.fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
                out, size = [], 0
                with fs.open_input_stream(name, compression=None) as stream:
                    for raw in records_in(stream):
                        row = parse(raw)
                        if not payloads:
                            row["payload"] = None
                        out.append(row)
                        size += len(raw) if payloads else 200
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(out, kind)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, kind)

    return manifest.select("path").repartition(F.col("path")).mapInArrow(run, RECORD)
