"""Operator 10: removal of repeated passages by fixed-block anchors.

Every document is a reference that is cut into non-overlapping blocks of b words, at multiples of b from its
start. A window of w words holds a whole block if w >= 2b - 1, so b = (w + 1) // 2. The blocks are indexed by
hash; every rolling window of b words in every document probes the index; and the hits are extended: windows
of w words around a hit block are confirmed by equality with another one, and the confirmed windows that
overlap make up the maximal exact repeats.

Plan: documents are packed into chunks (see ``common``). Each chunk sends the bucket of a hash its blocks and
probes, distinct within the chunk, so that a group of copies costs a bucket one entry a chunk. The bucket
answers with a bit for each: hit or not. The same is done with the windows around hit blocks, and the chunks
then cut their own texts. Three reads of the chunk table, four small exchanges, no pairs of documents, and
nothing goes to the driver.

Hits are found by 48 bits of hash (a false hit only costs a comparison); windows are equal if their 64-bit
hashes are.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    CHUNK_COLUMNS,
    EXCHANGE_SCHEMA,
    U64,
    Chunk,
    by_bucket,
    carried_columns,
    chunk_table,
    doc_of,
    fields_of,
    materialize,
    n_buckets,
    received,
    rolling,
    sent,
    word_hashes,
    word_spans,
)

BLOCK, MANY = 1, 2
ANSWER_SCHEMA = "chunk long, step int, bucket long, bits binary"
RESULTS = "n_words long, n_removed long, kept string, spans array<struct<start:long,end:long>>"


class _Words:
    """A chunk's words and the sorted distinct hashes of its blocks and probes."""

    def __init__(self, chunk: Chunk, window: int):
        self.chunk, self.window, self.block = chunk, window, (window + 1) // 2
        self.starts, self.ends = word_spans(chunk.buf)
        self.doc = doc_of(chunk, self.starts)
        self.first = np.searchsorted(self.doc, np.arange(len(chunk) + 1))  # each document's first word
        words = word_hashes(chunk.buf, self.starts, self.ends)
        self.at, grams = self._inside(words, self.block)
        grams >>= U64(16)
        self.grams, self.back, counts = np.unique(grams << U64(16), return_inverse=True, return_counts=True)
        self.flags = np.zeros(len(self.grams), np.uint8)
        self.flags[self.back[(self.at - self.first[self.doc[self.at]]) % self.block == 0]] = BLOCK
        self.flags[counts > 1] |= MANY
        self.words = words

    def _inside(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the runs of n words that lie within one document."""
        h = rolling(words, n)
        at = np.flatnonzero(self.doc[: len(h)] == self.doc[n - 1 : n - 1 + len(h)]) if len(h) else np.zeros(0, np.int64)
        return at, h[at]

    def candidates(self, hits: np.ndarray) -> None:
        """The windows whose first whole block is a hit, and their sorted distinct hashes."""
        hit = np.zeros(len(self.words) + 1, bool)
        hit[self.at] = hits[self.back]
        at, h = self._inside(self.words, self.window)
        inner = at + -(at - self.first[self.doc[at]]) % self.block
        keep = hit[inner]
        self.spots = at[keep]
        self.windows, self.window_back, counts = np.unique(h[keep], return_inverse=True, return_counts=True)
        self.window_flags = np.where(counts > 1, MANY, 0).astype(np.uint8) | BLOCK

    def removed(self, repeated: np.ndarray) -> np.ndarray:
        step = np.zeros(len(self.words) + 1, np.int32)
        at = self.spots[repeated[self.window_back]]
        np.add.at(step, at, 1)
        np.add.at(step, at + self.window, -1)
        return np.cumsum(step[:-1]) > 0


def _probe(batches, window: int, buckets: int):
    for batch in batches:
        for chunk in Chunk.each(batch):
            w = _Words(chunk, window)
            if len(w.grams):
                yield sent(chunk.number, w.grams, buckets, w.flags)


def _answer(table: pa.Table, step: int) -> pa.Table:
    """A bucket's answer: which hashes occur twice or more, one of them as a block."""
    parts = [received(p) for p in table.column("payload").to_pylist()]
    lengths = [len(p[0]) for p in parts]
    groups, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    flags = np.concatenate([p[1] for p in parts])
    count = np.bincount(back, weights=1 + (flags & MANY > 0), minlength=len(groups))
    block = np.bincount(back, weights=flags & BLOCK, minlength=len(groups))
    hit = ((count > 1) & (block > 0))[back]
    chunks, bits, at = [], [], 0
    for chunk, n in zip(table.column("chunk").to_pylist(), lengths, strict=True):
        part = hit[at : at + n]
        at += n
        if part.any():
            chunks.append(chunk)
            bits.append(pa.compress(np.packbits(part).tobytes(), codec="zstd", asbytes=True))
    n = len(chunks)
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "step": pa.array([step] * n, pa.int32()), "bucket": pa.array([table.column("bucket")[0].as_py()] * n, pa.int64()), "bits": pa.array(bits, pa.binary())})


def _gathered(hashes: np.ndarray, buckets: int, answers: pa.Table, step: int) -> np.ndarray:
    out, cuts = np.zeros(len(hashes), bool), by_bucket(hashes, buckets)
    for s, k, bits in zip(answers.column("step").to_pylist(), answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True):
        if s == step:
            n = int(cuts[k + 1] - cuts[k])
            raw = np.frombuffer(pa.decompress(bits, decompressed_size=(n + 7) // 8, codec="zstd", asbytes=True), np.uint8)
            out[cuts[k] : cuts[k + 1]] = np.unpackbits(raw, count=n).astype(bool)
    return out


def _extend(chunks: pa.Table, answers: pa.Table, window: int, buckets: int) -> pa.Table:
    out = [pa.RecordBatch.from_pydict({"bucket": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()), "payload": pa.array([], pa.binary())})]
    if answers.num_rows:
        for chunk in Chunk.each(chunks):
            w = _Words(chunk, window)
            w.candidates(_gathered(w.grams, buckets, answers, 1))
            out.append(sent(chunk.number, w.windows, buckets, w.window_flags))
    return pa.Table.from_batches(out)


def _cut(chunks: pa.Table, answers: pa.Table, window: int, buckets: int, layout: bool) -> pa.Table:
    out = []
    for chunk in Chunk.each(chunks):
        w = _Words(chunk, window)
        w.candidates(_gathered(w.grams, buckets, answers, 1))
        gone = w.removed(_gathered(w.windows, buckets, answers, 2))
        kept, spans = [], []
        data = chunk.buf.tobytes()
        for d in range(len(chunk)):
            a, b = w.first[d], w.first[d + 1]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
            spans.append([{"start": int(s), "end": int(e)} for s, e in zip(edges[0::2], edges[1::2], strict=True)])
            text = data[chunk.starts[d] : chunk.ends[d]]
            if layout:  # a removed run goes with the white space after it
                begin = np.append(w.starts[a:b], chunk.ends[d]) - chunk.starts[d]
                cuts = [0, *(int(begin[e]) for e in edges), len(text)]
                kept.append(b"".join(text[x:y] for x, y in zip(cuts[0::2], cuts[1::2], strict=True)))
            else:
                words = text.split()
                kept.append(b" ".join(words if not len(edges) else [x for x, g in zip(words, gone[a:b], strict=True) if not g]))
        total = np.concatenate([[0], np.cumsum(gone)])
        out.append(
            chunk.with_results(
                n_words=pa.array(np.diff(w.first).astype(np.int64)),
                n_removed=pa.array((total[w.first[1:]] - total[w.first[:-1]]).astype(np.int64)),
                kept=pa.array(kept, pa.binary()),
                spans=pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            )
        )
    return pa.concat_tables(out)


def remove_repeated_passages(docs: DataFrame, window_words: int = 35, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, layout: bool = False) -> DataFrame:
    """Removes every word that a window of ``window_words`` words covers whose words also start anywhere else.

    Returns a row for each row of ``docs`` with the columns ``carry`` (unset: all but the text), ``n_words``,
    ``n_removed``, ``kept`` (the words left, joined by one space; with
    ``layout`` they keep their own white space) and ``spans`` (removed runs of words, ends
    excluded). A null or empty text has no words and stays empty; a repeated row is another document, so that
    both lose what they share; null ids and other columns pass unchanged, but a column named as a result is is
    dropped; an empty table gives an empty one; a very long text is one chunk and is never cut.
    """
    if window_words < 2:
        raise ValueError("window_words must be 2 or more")
    spark = docs.sparkSession
    buckets = n_buckets(spark)
    results = ["n_words", "n_removed", "kept", "spans"]
    carry = carried_columns(docs, text_col, results) if carry is None else carry
    chunks = chunk_table(docs, id_col, text_col, carry)
    probes = chunks.mapInArrow(partial(_probe, window=window_words, buckets=buckets), EXCHANGE_SCHEMA)
    hits = materialize(probes.groupBy("bucket").applyInArrow(lambda t: _answer(t, 1), ANSWER_SCHEMA), "hits")
    around = chunks.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(lambda c, a: _extend(c, a, window_words, buckets), EXCHANGE_SCHEMA)
    repeats = around.groupBy("bucket").applyInArrow(lambda t: _answer(t, 2), ANSWER_SCHEMA)
    schema = fields_of(docs, carry, RESULTS.replace("kept string", "kept binary"))
    out = chunks.select(*CHUNK_COLUMNS).groupBy("chunk").cogroup(hits.unionByName(repeats).groupBy("chunk")).applyInArrow(lambda c, a: _cut(c, a, window_words, buckets, layout), schema)
    return out.withColumn("kept", F.col("kept").cast("string"))
