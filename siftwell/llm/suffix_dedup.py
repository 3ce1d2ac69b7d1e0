"""Operator 4: removal of repeated byte strings by suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a row with a smaller id, or
earlier in the same text.

Which suffixes meet in which shard is settled by anchors, so that shards need not all be compared with each
other: every window of ``length`` bytes picks the rightmost smallest hash of its ``ANCHOR``-byte strings, hence
equal windows pick equal anchors, and a *segment* is the stretch of windows that pick one anchor.

1. Each chunk of documents sends the bucket of an anchor its segments: 48 bits of hash each for the anchor and
   the whole segment, the id, place and number of windows. Of equal segments in one chunk only the earliest is
   sent, so a group of copies costs a bucket one entry a chunk.
2. Of equal segments the bucket keeps the earliest; the others' windows are all repeats. If an anchor is left
   with several different segments, their bytes are asked for.
3. These bytes form shards of bounded size. Each shard is indexed by a suffix array (Larsson-Sadakane: the ranks
   of prefixes of 8, 16, 32 ... bytes, refining only the groups not yet resolved), and the common prefixes of
   neighbours come by Kasai's rule that they shrink by one at most from one text position to the next. A run of
   neighbours with ``length`` bytes in common is one window's class; all but its earliest member are repeats.
4. Should the segments of one anchor exceed a shard, they go to several; each sends its sorted distinct
   windows on, and these are merged across shards by binary search.
5. The chunks cut their own texts.

Nothing goes to the driver, no pairs are made, and shards are bounded whatever the data. Segments count as equal
by 96 bits of hash; windows of different segments are compared byte for byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_COLUMNS, K3, U64, Chunk, carried_columns, chunk_table, doc_of, fields_of, join_hash, materialize, mix, n_buckets, narrow, pack, received, sent, unpack

ANCHOR = 40
BLOCK = 1 << 19
SHARD_BYTES = 6 << 20
ANCHORS, GONE, ASK, WHOLE, PART = range(5)
ROW_SCHEMA = "bucket long, chunk long, kind int, payload binary"
RESULTS = "n_bytes long, n_removed long, kept binary, spans array<struct<start:long,end:long>>"


def _rows(found: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*found, strict=True)) if found else [[], [], [], []]
    return pa.table({"bucket": pa.array(cols[0], pa.int64()), "chunk": pa.array(cols[1], pa.int64()), "kind": pa.array(cols[2], pa.int32()), "payload": pa.array(cols[3], pa.binary())})


# ----------------------------------------------------------------------------------------------- segments


def segments(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each segment: first window, number of windows, hash of the anchor, hash of the segment."""
    span = length - ANCHOR + 1
    out = []
    padded = np.concatenate([buf, np.zeros(length + 80, np.uint8)])
    limit = np.zeros(len(buf) + 1, np.int8)  # windows may start where the running sum is positive
    long = ends - starts >= length
    np.add.at(limit, starts[long], 1)
    np.add.at(limit, ends[long] - length + 1, -1)
    open_ = np.cumsum(limit, dtype=np.int8)[:-1] > 0
    place = np.arange(BLOCK + span, dtype=U64)
    for at in range(0, len(buf), BLOCK):
        stop = min(at + BLOCK, len(buf))
        ok = open_[at:stop]
        if not ok.any():
            continue
        n = stop - at + span - 1 + ANCHOR + 64
        part = padded[at : at + n + 8]
        h8 = np.ndarray((len(part) - 7,), "<u8", part, strides=(1,)) * K3
        h8 ^= h8 >> U64(31)
        h16 = join_hash(h8[:-8], h8[8:])
        h32 = join_hash(h16[:-16], h16[16:])
        anchor = join_hash(h32[: stop - at + span - 1], h8[32 : 32 + stop - at + span - 1])
        low = (anchor & U64(0xFFFFFFFFFF000000)) | (U64(0xFFFFFF) - place[: len(anchor)])
        width = 1
        least = low
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: stop - at], least[span - width : span - width + stop - at])
        pick = (U64(0xFFFFFF) - (least[: stop - at] & U64(0xFFFFFF))).astype(np.int64)
        spots = np.flatnonzero(ok)
        pick = pick[spots]
        new = np.ones(len(spots), bool)
        new[1:] = (pick[1:] != pick[:-1]) | (spots[1:] != spots[:-1] + 1)
        first = np.flatnonzero(new)
        s, count = spots[first], np.diff(np.concatenate([first, [len(spots)]]))
        size = count + length - 1
        whole = np.zeros(len(s), U64)
        # pieces of 32 bytes, the last one flush with the end, cover a segment
        for k in range(0, 2 * length, 32):
            off = np.minimum(k, size - 32)
            whole = join_hash(whole, h32_at(padded, at + s + off))
            if k + 32 >= int(size.max()):
                break
        whole = join_hash(whole, size.astype(U64))
        out.append((at + s, count, mix(anchor[pick[first]]), whole))  # the smallest hashes, spread evenly again
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def h32_at(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from each place."""
    loads = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    out = loads[at] * K3
    for k in (8, 16, 24):
        out ^= out >> U64(31)
        out = join_hash(out, loads[at + k])
    return out


def _send(batches, length: int, buckets: int):
    for batch in batches:
        for chunk in Chunk.each(batch):
            s, count, anchor, whole = segments(chunk.buf, chunk.starts, chunk.ends, length)
            if not len(s):
                continue
            anchor, whole = anchor >> U64(16) << U64(16), whole >> U64(16)
            doc = doc_of(chunk, s)
            rank = np.empty(len(chunk), np.int64)
            rank[np.argsort(chunk.ids, kind="stable")] = np.arange(len(chunk))
            order = np.lexsort((s, rank[doc], whole, anchor))
            s, count, anchor, whole, ids = s[order], count[order], anchor[order], whole[order], chunk.ids[doc[order]]
            first = np.ones(len(s), bool)
            first[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
            found = sent(chunk.number, anchor[first], buckets, whole[first], ids[first], s[first].astype(np.uint32), narrow(count[first]))
            out = [(k, c, ANCHORS, p) for k, c, p in zip(*(found.column(i).to_pylist() for i in range(3)), strict=True)]
            if not first.all():
                out.append((chunk.number % buckets, chunk.number, GONE, _ranges(s[~first], count[~first])))
            yield from _rows(out).to_batches()


def _ranges(s: np.ndarray, count: np.ndarray) -> bytes:
    order = np.argsort(s, kind="stable")
    return pack(s[order].astype(np.uint32), count[order].astype(np.uint32))


def _resolve(table: pa.Table, length: int, shard_bytes: int) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    parts, out = [], []
    for chunk, kind, payload in zip(*(table.column(c).to_pylist() for c in ("chunk", "kind", "payload")), strict=True):
        if kind == GONE:
            out.append((bucket, chunk, GONE, payload))
        else:
            p = received(payload)
            parts.append([*p, np.full(len(p[0]), chunk, np.int64)])
    if not parts:
        return _rows(out)
    anchor, whole, ids, s, count, chunk = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((s, chunk, ids, whole, anchor))
    anchor, whole, ids, s, count, chunk = (x[order] for x in (anchor, whole, ids, s, count, chunk))
    new_anchor, new_whole = np.ones(len(s), bool), np.ones(len(s), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new_whole[1:] = new_anchor[1:] | (whole[1:] != whole[:-1])
    gone = ~new_whole
    group = np.cumsum(new_anchor) - 1
    kinds = np.bincount(group, weights=new_whole)
    ask = new_whole & (kinds[group] > 1)
    out += _by_chunk(bucket, GONE, chunk[gone], s[gone], count[gone])
    if ask.any():
        g, c, at, n = group[ask], chunk[ask], s[ask], count[ask].astype(np.int64)
        size = n + length - 1
        total = np.bincount(g, weights=size)[g]
        big = total > shard_bytes
        shard = np.zeros(len(g), np.int64)
        shard[~big] = np.cumsum(np.where(~big & np.concatenate([[True], g[1:] != g[:-1]]), total, 0))[~big] // shard_bytes
        shard[big] = (1 << 20) + np.cumsum(np.where(big, size, 0))[big] // shard_bytes
        for kind, of in ((WHOLE, ~big), (PART, big)):
            for k in np.unique(shard[of]):
                m = of & (shard == k)
                out += [((bucket << 24) + int(k), x[1], kind, x[3]) for x in _by_chunk(bucket, kind, c[m], at[m], n[m])]
    return _rows(out)


def _by_chunk(bucket: int, kind: int, chunk: np.ndarray, s: np.ndarray, count: np.ndarray) -> list:
    if not len(chunk):
        return []
    order = np.argsort(chunk, kind="stable")
    chunk, s, count = chunk[order], s[order], count[order]
    cuts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
    return [(bucket, int(chunk[a]), kind, _ranges(s[a:b], count[a:b])) for a, b in zip(cuts, [*cuts[1:], len(chunk)], strict=True)]


def _show(chunks: pa.Table, asked: pa.Table, length: int) -> pa.Table:
    """The bytes of the segments that shards ask a chunk for."""
    out = []
    if asked.num_rows:
        for chunk in Chunk.each(chunks):
            for shard, kind, payload in zip(*(asked.column(c).to_pylist() for c in ("bucket", "kind", "payload")), strict=True):
                s, count = (x.astype(np.int64) for x in unpack(payload))
                size = count + length - 1
                begins = np.cumsum(size) - size
                index = np.repeat(s - begins, size) + np.arange(int(size.sum()))
                out.append((shard, chunk.number, kind, pack(chunk.ids[doc_of(chunk, s)], s.astype(np.uint32), narrow(count), chunk.buf[index])))
    return _rows(out)


# ----------------------------------------------------------------------------------------------- suffix arrays


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` bytes or more, and whether each shares the last depth under
    ``depth`` that was refined with the one before. Larsson-Sadakane: sorted groups are left alone."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(U64)
    sa = np.argsort(key, kind="stable").astype(np.int32)
    k = key[sa]
    new = np.ones(n, bool)
    new[1:] = k[1:] != k[:-1]
    del key, k
    rank = np.empty(n + 1, np.int32)
    h, near = 8, ~new
    while True:
        head = np.flatnonzero(new).astype(np.int32)  # a group's rank is the place of its first suffix
        rank[sa] = np.repeat(head, np.diff(np.concatenate([head, [n]])))
        rank[n] = -1
        if h >= depth:
            return sa, near
        near = ~new
        open_ = near.copy()
        open_[:-1] |= near[1:]
        spots = np.flatnonzero(open_)
        if not len(spots):
            return sa, near
        own = sa[spots]
        pair = (rank[own].astype(np.int64) << 32) | (rank[np.minimum(own.astype(np.int64) + h, n)].astype(np.int64) + 1)
        order = np.argsort(pair, kind="stable")
        sa[spots] = own[order]
        pair = pair[order]
        fresh = np.ones(len(spots), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        new[spots] = fresh
        h *= 2


def common_prefixes(text: np.ndarray, sa: np.ndarray, which: np.ndarray, cap: int, stride: int = 16) -> np.ndarray:
    """Bytes, ``cap`` at most, that the suffix at each of the places ``which`` of ``sa`` shares with the one before.

    Kasai's rule in text order: if the suffix at i shares l bytes with its forerunner j, the one at i + d shares
    l - d at least with j + d. Every ``stride``-th place is compared from its start, and the others from that bound
    on where j + d is their forerunner; suffixes sorted by their first bytes only may have another one.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(cap + 16, np.uint8)])
    loads = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    here, before = sa[which].astype(np.int64), sa[which - 1].astype(np.int64)
    order = np.argsort(here)
    here, before = here[order], before[order]
    most = np.minimum(cap, n - np.maximum(here, before))

    def compare(i: np.ndarray, shared: np.ndarray) -> np.ndarray:
        live = np.arange(len(i))
        while len(live):
            x = loads[here[i[live]] + shared[live]] ^ loads[before[i[live]] + shared[live]]
            same = np.where(x == 0, 8, np.bitwise_count((x & (~x + U64(1))) - U64(1)) >> 3).astype(np.int64)
            shared[live] += same
            live = live[(same == 8) & (shared[live] < most[i[live]])]
        return np.minimum(shared, most[i])

    out = np.zeros(len(here), np.int64)
    sampled = np.zeros(len(here), bool)
    sampled[::stride] = True
    lead = np.flatnonzero(sampled)
    out[lead] = compare(lead, np.zeros(len(lead), np.int64))
    rest = np.flatnonzero(~sampled)
    at = (rest // stride) * stride
    # the bound is one on the bytes shared with the lead's forerunner moved on; with another forerunner start from 0
    gap = here[rest] - here[at]
    bound = np.where(before[rest] - before[at] == gap, np.maximum(out[at] - gap, 0), 0)
    out[rest] = compare(rest, np.minimum(bound, most[rest]))
    back = np.empty(len(here), np.int64)
    back[order] = out
    return back


def window_classes(text: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the valid windows of a shard in suffix order, and the class of each: equal windows, equal class."""
    sa, near = suffix_array(text, length)
    shared = np.zeros(len(sa), np.int64)
    which = np.flatnonzero(near)
    which = which[which > 0]
    shared[which] = common_prefixes(text, sa, which, length)
    cls = np.cumsum(shared < length)
    ok = valid[sa]
    return sa[ok].astype(np.int64), cls[ok]


def _index(table: pa.Table, length: int) -> pa.Table:
    """A shard: which windows of its segments start earlier too; for a part of a split anchor, its sorted windows."""
    shard, kind = table.column("bucket")[0].as_py(), table.column("kind")[0].as_py()
    ids, s, count, chunk, text = [], [], [], [], []
    for c, payload in zip(table.column("chunk").to_pylist(), table.column("payload").to_pylist(), strict=True):
        i, at, n, body = unpack(payload)
        ids.append(i), s.append(at.astype(np.int64)), count.append(n.astype(np.int64)), text.append(body)
        chunk.append(np.full(len(i), c, np.int64))
    ids, s, count, chunk, text = (np.concatenate(x) for x in (ids, s, count, chunk, text))
    size = count + length - 1
    begins = np.cumsum(size) - size
    seg = np.repeat(np.arange(len(s)), size)
    offset = np.arange(len(text)) - begins[seg]
    at, cls = window_classes(text, offset < count[seg], length)
    own, place = seg[at], s[seg[at]] + offset[at]
    order = np.lexsort((place, chunk[own], ids[own], cls))
    at, cls, own, place = at[order], cls[order], own[order], place[order]
    first = np.ones(len(at), bool)
    first[1:] = cls[1:] != cls[:-1]
    out = _by_chunk(shard, GONE, chunk[own[~first]], place[~first], np.ones(int((~first).sum()), np.int64))
    if kind == PART:  # its distinct windows, sorted, in 64 parts by their first two bytes
        at, own, place = at[first], own[first], place[first]
        part = (text[at].astype(np.int64) * 256 + text[at + 1]) % 64
        for p in np.unique(part):
            m = part == p
            body = text[(at[m][:, None] + np.arange(length)).ravel()]
            out.append((((shard >> 24) << 24) + int(p), 0, PART, pack(ids[own[m]], chunk[own[m]], place[m], body)))
    return _rows(out)


def _merge(table: pa.Table, length: int) -> pa.Table:
    """Sorted windows of several shards: each is looked up in the others by binary search; the earliest stays."""
    runs = []
    for payload in table.column("payload").to_pylist():
        ids, chunk, place, body = unpack(payload)
        ended = np.concatenate([body.reshape(-1, length), np.ones((len(ids), 1), np.uint8)], axis=1)  # no zero byte ends it
        words = np.ascontiguousarray(ended).view(f"S{length + 1}").ravel()
        order = np.argsort(words, kind="stable")  # in suffix order already, but for ties of the shard's own order
        runs.append((words[order], ids[order], chunk[order], place[order]))
    out, bucket = [], table.column("bucket")[0].as_py()
    for i, (words, ids, chunk, place) in enumerate(runs):
        later = np.zeros(len(words), bool)
        for j, (others, ids2, chunk2, place2) in enumerate(runs):
            if i != j and len(others):
                spot = np.minimum(np.searchsorted(others, words), len(others) - 1)
                same = others[spot] == words
                i2, c2, p2 = ids2[spot], chunk2[spot], place2[spot]
                later |= same & ((i2 < ids) | (i2 == ids) & ((c2 < chunk) | (c2 == chunk) & (p2 < place)))
        out += _by_chunk(bucket, GONE, chunk[later], place[later], np.ones(int(later.sum()), np.int64))
    return _rows(out)


# ----------------------------------------------------------------------------------------------- the operator


def _cut(chunks: pa.Table, gone: pa.Table, length: int) -> pa.Table:
    out = []
    for chunk in Chunk.each(chunks):
        step = np.zeros(len(chunk.buf) + 1, np.int32)
        for payload in gone.column("payload").to_pylist():
            s, count = (x.astype(np.int64) for x in unpack(payload))
            np.add.at(step, s, 1)
            np.add.at(step, s + count + length - 1, -1)
        lost = np.cumsum(step[:-1], dtype=np.int32) > 0
        data, kept, spans, n_removed = chunk.buf.tobytes(), [], [], []
        for a, b in zip(chunk.starts, chunk.ends, strict=True):
            part = lost[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], part, [False]]).astype(np.int8))) if part.any() else np.zeros(0, np.int64)
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edges[0::2], edges[1::2], strict=True)])
            n_removed.append(int(part.sum()))
            kept.append(data[a:b] if not len(edges) else chunk.buf[a:b][~part].tobytes())
        out.append(
            chunk.with_results(
                n_bytes=pa.array((chunk.ends - chunk.starts).astype(np.int64)),
                n_removed=pa.array(n_removed, pa.int64()),
                kept=pa.array(kept, pa.binary()),
                spans=pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            )
        )
    return pa.concat_tables(out)


def remove_repeated_bytes(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Removes every byte of the UTF-8 texts that a string of ``length`` bytes covers which also starts earlier:
    in a row with a smaller id, or earlier in the same text. Strings never cross rows.

    Returns a row for each row of ``docs`` with the columns ``carry`` (unset: all but the text), ``n_bytes``,
    ``n_removed``, ``kept`` (the bytes left; a cut may part a character, hence binary) and ``spans`` (maximal
    removed runs, ends excluded). A null or empty text has no bytes; null ids come after all others; rows with
    one id, repeated rows too, are ordered by their place in the input; an empty table gives an empty one; a
    column named as a result is is dropped; a very long text is one chunk and is never cut.
    """
    if length < ANCHOR + 8:
        raise ValueError(f"length must be {ANCHOR + 8} or more")
    spark = docs.sparkSession
    buckets = n_buckets(spark)
    carry = carried_columns(docs, text_col, ["n_bytes", "n_removed", "kept", "spans"]) if carry is None else carry
    chunks = chunk_table(docs, id_col, text_col, carry)
    sent_ = chunks.mapInArrow(lambda batches: _send(batches, length, buckets), ROW_SCHEMA)
    first = materialize(sent_.groupBy("bucket").applyInArrow(lambda t: _resolve(t, length, shard_bytes), ROW_SCHEMA), "resolved")
    asked = first.filter(F.col("kind").isin(WHOLE, PART))
    shown = chunks.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(lambda c, a: _show(c, a, length), ROW_SCHEMA)
    second = materialize(shown.groupBy("bucket").applyInArrow(lambda t: _index(t, length), ROW_SCHEMA), "indexed")
    merged = second.filter(F.col("kind") == PART).groupBy("bucket").applyInArrow(lambda t: _merge(t, length), ROW_SCHEMA)
    gone = first.unionByName(second).filter(F.col("kind") == GONE).unionByName(merged)
    out = chunks.select(*CHUNK_COLUMNS).groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(lambda c, g: _cut(c, g, length), fields_of(docs, carry, RESULTS))
    return out
