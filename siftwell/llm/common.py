"""What the operators of this subpackage share: scratch tables, packed arrays, chunks of text and word hashes.

Shuffling arrays
----------------
Several operators need an exchange of a few bytes for nearly every word or byte of the corpus. A Spark row
for each would cost 30 bytes and a microsecond, so such exchanges move *packed arrays*: a chunk (some
megabytes of whole documents) sends each bucket one binary row of sorted, narrow, compressed numpy arrays,
and a bucket sends each chunk one row back. The number of buckets is the session's shuffle partitions, so it
follows the size of the job as any other exchange does.
"""

from __future__ import annotations

import atexit
import contextlib
import gc
import struct
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

U64 = np.uint64
#: Whole documents go into chunks of about this many bytes of text; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Words are parted by these ASCII bytes alone: space, tab, newline, vertical tab, form feed, carriage return.
SPACES = (32, 9, 10, 11, 12, 13)
WORD = r"[^\x20\x09-\x0D]+"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# --------------------------------------------------------------------------------------- scratch tables


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="siftwell-")
        spark.conf.set("spark.checkpoint.dir", root)
        _remove_at_exit(spark, root)
    return root.rstrip("/")


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    def remove() -> None:
        with contextlib.suppress(Exception):
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)

    atexit.register(remove)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark)}/siftwell-{uuid.uuid4().hex}/{name}"
    _remove_at_exit(spark, path.rpartition("/")[0])
    return path


@contextlib.contextmanager
def exchanges_dropped(spark: SparkSession):
    """A table that is written within deletes the files of its exchanges as soon as it is there: nothing else reads
    them. (Otherwise they stay until the driver's collector finds that nothing refers to them.)"""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared scratch folder and reads it back: this cuts the lineage, and what was written
    outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with exchanges_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables of ``materialize`` whose every reader has been written itself, and has the driver look for
    exchanges that nothing refers to any more, whose files the executors then delete."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(table._scratch.rpartition("/")[0])
        path.getFileSystem(conf).delete(path, True)
    gc.collect()
    SparkSession.active()._jvm.System.gc()


def salted_join(many: DataFrame, few: DataFrame, key: str, spread: Column, how: str = "inner", salts: int = 16) -> DataFrame:
    """Joins by a key that some rows of ``many`` may all have, and of which ``few`` has one row each: the rows of a
    key go to ``salts`` places by the hash ``spread``, and the row of ``few`` to each of them."""
    many = many.withColumn("__salt", F.pmod(spread, F.lit(salts)).cast("int"))
    few = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.join(few, [key, "__salt"], how).drop("__salt")


def n_buckets(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


# --------------------------------------------------------------------------------------- packed arrays


def narrow(a: np.ndarray) -> np.ndarray:
    """The same non-negative integers in the fewest bytes of 1, 2, 4 and 8."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one dimension as bytes, byte planes apart and compressed."""
    head, body = [struct.pack("<H", len(arrays))], []
    for a in arrays:
        a = np.ascontiguousarray(a)
        head.append(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)))
        body.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if a.itemsize > 1 else a.tobytes())
    raw = b"".join(body)
    return b"".join([*head, struct.pack("<Q", len(raw)), pa.compress(raw, codec="zstd", asbytes=True) if raw else b""])


def unpack(data: bytes) -> list[np.ndarray]:
    (n,), at = struct.unpack_from("<H", data), 2
    kinds = [struct.unpack_from("<2sQ", data, at + 10 * i) for i in range(n)]
    at += 10 * n
    (size,) = struct.unpack_from("<Q", data, at)
    raw = np.frombuffer(pa.decompress(data[at + 8 :], decompressed_size=size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    out, at = [], 0
    for kind, length in kinds:
        dtype = np.dtype("<" + kind.decode()) if kind[1:] != b"1" else np.dtype(kind.decode())
        part = raw[at : at + length * dtype.itemsize]
        at += length * dtype.itemsize
        out.append(np.ascontiguousarray(part.reshape(dtype.itemsize, length).T).view(dtype).ravel() if length else np.zeros(0, dtype))
    return out


# --------------------------------------------------------------------------------------- chunks of documents

CHUNK_SCHEMA = "chunk long, ids binary, lengths binary, body binary, carry binary"
CHUNK_COLUMNS = ("chunk", "ids", "lengths", "body", "carry")
#: Stands for a null doc_id inside a chunk: it sorts after every other.
NO_ID = np.iinfo(np.int64).max


def texts_of(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _ipc(parts: list[pa.RecordBatch]) -> bytes:
    table = pa.Table.from_batches(parts).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _chunks(batches):
    """Columns: the id as a long, the text, then what is carried along."""
    from pyspark import TaskContext

    part, seq = TaskContext.get().partitionId(), 0
    ids, texts, carried, size = [], [], [], 0

    def row():
        return pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([(part << 24) + seq], pa.int64()),
                "ids": pa.array([pack(np.array([NO_ID if i is None else i for i in ids], np.int64))], pa.binary()),
                "lengths": pa.array([pack(np.array([len(t) for t in texts], np.int64))], pa.binary()),
                "body": pa.array([pa.compress(b"".join(texts), codec="zstd", asbytes=True) if size else b""], pa.binary()),
                "carry": pa.array([_ipc(carried)], pa.binary()),
            }
        )

    for batch in batches:
        rest = pa.RecordBatch.from_arrays(batch.columns[2:], schema=pa.schema(list(batch.schema)[2:]))
        first = 0
        for at, (i, t) in enumerate(zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True)):
            t = t or b""
            if ids and size + len(t) > CHUNK_BYTES:
                if at > first:
                    carried.append(rest.slice(first, at - first))
                yield row()
                first, seq, ids, texts, carried, size = at, seq + 1, [], [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
        if batch.num_rows > first:
            carried.append(rest.slice(first))
    if ids:
        yield row()


def carried_columns(docs: DataFrame, text_col: str, results: list[str]) -> list[str]:
    """The columns that stay beside an operator's results: all but the text, and those named as a result is."""
    taken = {r.lower() for r in results}
    return [c for c in docs.columns if c != text_col and c.lower() not in taken]


def chunk_table(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """Documents (null text: empty) packed into chunks and written once, so that a chunk's number and order hold."""
    slim = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"), *[F.col(f"`{c}`") for c in carry])
    return materialize(slim.mapInArrow(_chunks, CHUNK_SCHEMA), "chunks")


def dealt_chunk_table(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """A chunk table in buckets of its number, for operators that come back to the chunks again and again: the chunks
    are dealt once and never shuffled after that. It is an external table in the shared scratch folder, whose name is
    dropped when the application ends."""
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text"), *[F.col(f"`{c}`") for c in carry])
    name, n = f"siftwell_{uuid.uuid4().hex}", n_buckets(spark)
    chunks = slim.mapInArrow(_chunks, CHUNK_SCHEMA).repartition(n, "chunk")
    with exchanges_dropped(spark):
        chunks.write.format("parquet").option("compression", "zstd").option("path", scratch_path(spark, "chunks")).bucketBy(n, "chunk").saveAsTable(name)

    def forget() -> None:
        with contextlib.suppress(Exception):
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    atexit.register(forget)
    return spark.table(name)


def fields_of(docs: DataFrame, carry: list[str], more: str) -> StructType:
    """The schema of the carried columns and an operator's results."""
    return StructType([docs.schema[c] for c in carry] + list(_parse_datatype_string(more)))


class Chunk:
    """One row of the chunk table: the ids, and the texts in one buffer with a space before each and after the last."""

    def __init__(self, number: int, ids: bytes, lengths: bytes, body: bytes, carry: bytes):
        self.number, (self.ids,), (lengths_,), self._carry = number, unpack(ids), unpack(lengths), carry
        size = int(lengths_.sum())
        raw = np.frombuffer(pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
        n = len(lengths_)
        self.starts = np.concatenate([[0], np.cumsum(lengths_)[:-1]]).astype(np.int64) + np.arange(1, n + 1) if n else np.zeros(0, np.int64)
        self.ends = self.starts + lengths_
        self.buf = np.full(size + n + 1, 32, np.uint8)
        keep = np.ones(size + n + 1, bool)
        keep[np.concatenate([self.starts - 1, [size + n]]).astype(np.int64)] = False
        self.buf[keep] = raw

    def __len__(self) -> int:
        return len(self.ids)

    def with_results(self, **results) -> pa.Table:
        """The carried columns, row by row, and the results beside them."""
        carried = pa.ipc.open_stream(self._carry).read_all()
        columns = {n: carried.column(n) for n in carried.column_names} | results
        return pa.table(columns)

    @classmethod
    def each(cls, table):
        cols = [table.column(c) for c in CHUNK_COLUMNS]
        for i in range(table.num_rows):
            yield cls(*(c[i].as_py() for c in cols))


def exchange_rows(key: str, keys, chunk, payloads) -> dict:
    return {key: pa.array(keys, pa.int64()), "chunk": pa.array(chunk, pa.int64()), "payload": pa.array(payloads, pa.binary())}


def sent(number: int, hashes: np.ndarray, buckets: int, *more: np.ndarray) -> pa.RecordBatch:
    """What a chunk sends the buckets: sorted distinct hashes as steps, and arrays beside them."""
    cuts = by_bucket(hashes, buckets)
    full = [k for k in range(buckets) if cuts[k] < cuts[k + 1]]
    payloads = []
    for k in full:
        part = slice(cuts[k], cuts[k + 1])
        h = hashes[part]
        payloads.append(pack(h[:1], narrow(h[1:] - h[:-1]), *[m[part] for m in more]))
    return pa.RecordBatch.from_pydict(exchange_rows("bucket", full, [number] * len(full), payloads))


EXCHANGE_SCHEMA = "bucket long, chunk long, payload binary"


def received(payload: bytes) -> list[np.ndarray]:
    first, steps, *more = unpack(payload)
    return [np.cumsum(np.concatenate([first, steps.astype(U64)]), dtype=U64), *more]


# --------------------------------------------------------------------------------------- words and hashes

K1, K2, K3 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(32))
    x *= K3
    x ^= x >> U64(29)
    x *= K2
    x ^= x >> U64(32)
    return x


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two neighbouring pieces, in order."""
    x = a * K1
    x += b
    x ^= x >> U64(29)
    x *= K3
    x ^= x >> U64(32)
    return x


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer that begins and ends with a space."""
    space = IS_SPACE[buf]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    return edges[0::2], edges[1::2]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight at a time."""
    lengths = ends - starts
    out = mix(lengths.astype(U64) * K1 + K2)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    loads = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    at, left, which = starts.astype(np.int64), lengths.astype(np.int64), None
    masks = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], U64)
    while len(at):
        x = loads[at] & masks[np.minimum(left, 8)]
        if which is None:
            out = join_hash(out, mix(x))
        else:
            out[which] = join_hash(out[which], mix(x))
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        which = more if which is None else which[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n neighbouring items: n - 1 fewer than there are items."""
    if len(h) < n:
        return h[:0]
    out, have, power, width = None, 0, h, 1
    while True:
        if n & width:
            if out is None:
                out, have = power, width
            else:  # the narrower part stands first
                out = join_hash(out[: len(h) - have - width + 1], power[have : have + len(h) - have - width + 1])
                have += width
        if have == n:
            return out[: len(h) - n + 1]
        power = join_hash(power[: len(power) - width], power[width:])
        width *= 2


def doc_of(chunk: Chunk, starts: np.ndarray) -> np.ndarray:
    return np.searchsorted(chunk.starts, starts, side="right") - 1


def by_bucket(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted hashes: cuts between the buckets, which are equal ranges of the hashes."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=U64)
    return np.concatenate([[0], np.searchsorted(h, edges), [len(h)]])
