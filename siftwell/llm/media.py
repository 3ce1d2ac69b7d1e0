"""Operator 5: media columns. Content-addressed payloads in tar shards.

A payload is a text's UTF-8 bytes with zero bytes appended up to a positive multiple of 64. It is stored as a
lossless greyscale image of 8-bit samples, 64 to a row (PNG, filter 0, so equal payloads give equal files), as a
member of a tar shard whose name is the payload's SHA-256. Rows carry the digest, the shard, and the offset and
length of the member's data; metadata columns come from range reads of the image header alone, features from
range reads of the whole member.

Each task writes its own shards: under a name of its own first, then renamed to the digest of the shard's bytes.
A task that is run again writes the same shard, so lost executors leave nothing half-written under a final name;
readers only follow the rows. Within a shard a payload is stored once. Shards go through pyarrow's filesystems
(local paths, hdfs, s3 and others), in the folder that the caller names; the default is the shared scratch folder.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried_columns, fields_of, materialize, scratch_path, texts_of

WIDTH = 64
HEADER_BYTES = 33  # signature and IHDR chunk
SHARD_BYTES = 32 << 20
SIGNATURE = b"\x89PNG\r\n\x1a\n"
MANIFEST = "n_bytes long, digest string, shard string, offset long, length long"
METADATA = "width long, height long, bit_depth int"
FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def payload_of(text: bytes) -> bytes:
    size = max(WIDTH, -(-len(text) // WIDTH) * WIDTH)
    return text.ljust(size, b"\0")


def to_png(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    filtered = np.zeros((len(rows), WIDTH + 1), np.uint8)
    filtered[:, 1:] = rows

    def part(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + part(b"IHDR", head) + part(b"IDAT", zlib.compress(filtered.tobytes(), 4)) + part(b"IEND", b"")


def png_header(data: bytes) -> tuple[int, int, int]:
    """Width, height and bits per sample from the first bytes of a file."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR":
        raise ValueError("not a PNG file")
    width, height, depth = struct.unpack(">IIB", data[16:25])
    return width, height, depth


def from_png(data: bytes) -> bytes:
    """The samples of a file that ``to_png`` made."""
    width, height, _ = png_header(data)
    at, body = 8, []
    while at < len(data):
        (size,) = struct.unpack_from(">I", data, at)
        kind = data[at + 4 : at + 8]
        content = data[at + 8 : at + 8 + size]
        if zlib.crc32(kind + content) != struct.unpack_from(">I", data, at + 8 + size)[0]:
            raise ValueError("a chunk of the PNG file is damaged")
        if kind == b"IDAT":
            body.append(content)
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("only filter 0 is read")
    return rows[:, 1:].tobytes()


def feature_of(payload: bytes) -> str:
    """Mean and variance of the samples and a 64-bit pattern of the 8 by 8 block means above their mean, in integers."""
    a = np.frombuffer(payload, np.uint8)
    total, squares = int(a.sum(dtype=np.int64)), int((a.astype(np.int64) ** 2).sum())
    n = len(a)
    rows = np.add.reduceat(a.reshape(-1, WIDTH // 8, 8).sum(axis=2, dtype=np.int64), np.arange(8) * (n // WIDTH) // 8, axis=0)
    bits = "".join("1" if x * 64 > total else "0" for x in rows.ravel())
    return f"{WIDTH}x{n // WIDTH};mean={total * 1000 // n};var={(squares * n - total * total) * 1000 // (n * n)};hash={int(bits, 2):016x}"


def _open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _store_uri(folder: str) -> str:
    return "file://" + folder[len("file:") :] if folder.startswith("file:/") and not folder.startswith("file://") else folder


def _write(batches, folder: str, carry: list[str]):
    fs, base = _open_store(folder)
    fs.create_dir(base, recursive=True)
    buffer, tar, places, waiting = io.BytesIO(), None, {}, []

    def flush():
        nonlocal buffer, tar, places, waiting
        if tar is None:
            return
        tar.close()
        data = buffer.getvalue()
        name = f"{hashlib.sha256(data).hexdigest()}.tar"
        own = f"{base}/.{uuid.uuid4().hex}"
        with fs.open_output_stream(own) as out:
            out.write(data)
        fs.move(own, f"{base}/{name}")
        for rest, rows in waiting:
            n, digest, offset, length = (list(x) for x in zip(*rows, strict=True))
            columns = [*rest.columns, pa.array(n, pa.int64()), pa.array(digest), pa.array([name] * len(n)), pa.array(offset, pa.int64()), pa.array(length, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "n_bytes", "digest", "shard", "offset", "length"])
        buffer, tar, places, waiting = io.BytesIO(), None, {}, []

    for batch in batches:
        rest, first, rows = batch.select(range(1, batch.num_columns)), 0, []
        for at, text in enumerate(texts_of(batch.column(0))):
            payload = payload_of(text or b"")
            digest = hashlib.sha256(payload).hexdigest()
            if tar is None:
                tar = tarfile.open(fileobj=buffer, mode="w", format=tarfile.USTAR_FORMAT)
            if digest not in places:
                media = to_png(payload)
                info = tarfile.TarInfo(f"{digest}.png")
                info.size = len(media)
                tar.addfile(info, io.BytesIO(media))
                places[digest] = (buffer.tell() - -(-len(media) // 512) * 512, len(media))
            rows.append((len(text or b""), digest, *places[digest]))
            if buffer.tell() > SHARD_BYTES:
                waiting.append((rest.slice(first, len(rows)), rows))
                first, rows = at + 1, []
                yield from flush()
        if rows:
            waiting.append((rest.slice(first, len(rows)), rows))
    yield from flush()


class _Ranges:
    """Range reads from shards; one shard is open at a time."""

    def __init__(self, folder: str):
        self.fs, self.base = _open_store(folder)
        self.name, self.file = None, None

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if shard != self.name:
            self.close()
            self.name, self.file = shard, self.fs.open_input_file(f"{self.base}/{shard}")
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.name = self.file = None


def _read(batches, folder: str, kind: str):
    ranges = _Ranges(folder)
    for batch in batches:
        found, known = [], {}
        for digest, shard, offset, length in zip(*(batch.column(c).to_pylist() for c in ("digest", "shard", "offset", "length")), strict=True):
            if digest not in known:
                if kind == "header":
                    known[digest] = png_header(ranges.read(shard, offset, min(HEADER_BYTES, length)))
                else:
                    media = ranges.read(shard, offset, length)
                    payload = from_png(media)
                    known[digest] = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(media), hashlib.sha256(media).hexdigest(), feature_of(payload))
                    if known[digest][1] != digest:
                        raise ValueError(f"{shard} at {offset}: another payload than {digest}")
            found.append(known[digest])
        names = ("width", "height", "bit_depth") if kind == "header" else ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
        types = {"bit_depth": pa.int32(), "payload_sha256": pa.string(), "media_sha256": pa.string(), "feature": pa.string()}
        columns = [pa.array([f[i] for f in found], types.get(n, pa.int64())) for i, n in enumerate(names)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])
    ranges.close()


def store_media(docs: DataFrame, folder: str | None = None, text_col: str = "text", carry: list[str] | None = None) -> tuple[DataFrame, str]:
    """Writes every text's payload into tar shards under ``folder`` and returns the rows that point into them.

    The rows have the columns ``carry`` (unset: all but the text), ``n_bytes`` (unpadded), ``digest``, ``shard``,
    ``offset`` and ``length``. A null or empty text is a payload of 64 zero bytes; repeated rows of one shard share
    a member; null ids and other columns pass; a column named as a result is is dropped; an empty table writes no
    shard; a long text is one member, whole. The rows are written once, so shards are not written again by later
    reads of them.
    """
    folder = _store_uri(folder or scratch_path(docs.sparkSession, "media"))
    results = ["n_bytes", "digest", "shard", "offset", "length", "width", "height", "bit_depth", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    carry = carried_columns(docs, text_col, results) if carry is None else carry
    slim = docs.select(F.col(text_col).cast("string").alias("__text"), *[F.col(f"`{c}`") for c in carry])
    return materialize(slim.mapInArrow(lambda b: _write(b, folder, carry), fields_of(docs, carry, MANIFEST)), "manifest"), folder


def read_metadata(manifest: DataFrame, folder: str) -> DataFrame:
    """Adds ``width``, ``height`` and ``bit_depth``, reading headers only."""
    return manifest.mapInArrow(lambda b: _read(b, folder, "header"), fields_of(manifest, manifest.columns, METADATA))


def read_features(manifest: DataFrame, folder: str) -> DataFrame:
    """Reads the members back, checks them against their digest, and adds sizes, digests and features."""
    return manifest.mapInArrow(lambda b: _read(b, folder, "whole"), fields_of(manifest, manifest.columns, FEATURES))
