"""Operator 7: near-duplicate texts by an inverted join of MinHash coordinates.

A text's set is its distinct word shingles; its signature has ``coordinates`` MinHash values. Texts with one set
are one class and go on as one. A pair of classes at the threshold collides in ``matches`` coordinates at least (the
binomial mean less four standard deviations); pairs with fewer collisions are skipped.

Posting, by prefixes: every (coordinate, value) is a token. If the tokens of each signature are put into one order,
the rarest first, two signatures with ``matches`` tokens in common share ``LEAST`` of their first
``coordinates - matches + LEAST``; only this prefix is posted, of it only tokens that another class has too, and
nothing of a class with fewer than ``LEAST`` of those. How many classes have a token is counted exactly: packs of
classes send their tokens to buckets as packed arrays and get the counts back (see ``common``).

Merging, with skips: the short lists are merged, which counts the collisions of every pair that meets in one. The long
ones (over ``short`` classes) are skipped; a pair is dropped if its collisions, with all that the skipped lists could
add, stay below ``LEAST``. What is left is looked up in the signatures: pairs with fewer than ``matches`` collisions
over all coordinates go. Of a long list the pairs of one class with every other are taken as candidates too, of the
class whose posted tokens are the most shared: among edited copies of one text this is the text itself.

Confirming: each class is first compared on the full sets with the partner with which it collides most, then only pairs
still in different components. What is open after that are members of one long list in different components. These
classes are put into blocks, those of a group's largest component apart from its others, so that blocks of one and the
same component never meet. Two blocks of a list meet by outlines (sizes, components and a byte of each coordinate);
those that may have a link are compared as a whole in one task (signatures, then shared shingles by a matrix product),
which returns a spanning forest of the links. That is the only cost that can grow with
the square of a group: its members that are similar without being linked, times the group, in blocks of bounded size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import EXCHANGE_SCHEMA, LOWER, U64, by_bucket, carried_columns, fields_of, materialize, mix, n_buckets, narrow, pack, received, release, rolling, salted_join, sent, texts_of, unpack, word_hashes, word_spans
from .components import connected_components, forest

PACK = 4096  # classes in a pack
ROWS = 128  # texts that are put through numpy at once
LEAST = 4  # collisions of posted tokens
SHORT = 24  # classes in a list that is merged, at most
GROUP, GROUP_SHINGLES = 512, 1 << 20  # pairs and shingles that are confirmed together, about
BLOCK, BLOCK_SHINGLES = 2048, 1 << 21  # classes and shingles of a block, about


def match_threshold(coordinates: int, similarity: float) -> int:
    return max(LEAST, int(coordinates * similarity - 4 * (coordinates * similarity * (1 - similarity)) ** 0.5))


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each lower-cased text."""
    buf = LOWER[np.frombuffer(b" " + b" ".join([t or b"" for t in texts]) + b" ", np.uint8)]
    first = np.cumsum([1] + [len(t or b"") + 1 for t in texts])
    starts, ends = word_spans(buf)
    h = word_hashes(buf, starts, ends)
    cuts = np.searchsorted(starts, first)
    grams = rolling(h, words)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        else:  # the whole sequence is one shingle
            out.append(mix(rolling(h[a:b], b - a) + U64(b - a)) if b > a else np.zeros(0, U64))
    return out


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20_240_607))
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    mult, add = _multipliers(coordinates)
    out = np.zeros((len(sets), coordinates), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        flat = (flat ^ (flat >> U64(32))).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        for k in range(coordinates):
            out[full, k] = np.minimum.reduceat((flat ^ add[k]) * mult[k], starts)
    return out


def tokens_of(sigs: np.ndarray) -> np.ndarray:
    """One hash for each coordinate and its value."""
    return mix(sigs.astype(U64) + (np.arange(sigs.shape[1], dtype=U64) << U64(32)))


def _sign(batches, words: int, coordinates: int, carry: list[str]):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            sets = shingle_sets(texts_of(part.column(0)), words)
            sigs = signatures(sets, coordinates)
            cls = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None for s in sets]
            columns = [*part.columns[1:], pa.array(cls, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sigs], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "cls", "n_shingles", "sig"])


def _sig_matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def _pack(batches):
    """Packs of classes: their ids, set sizes and signatures."""
    from pyspark import TaskContext

    part, seq, ids, sizes, sigs = TaskContext.get().partitionId(), 0, [], [], []

    def row():
        return pa.RecordBatch.from_pydict({"chunk": pa.array([(part << 24) + seq], pa.int64()), "ids": pa.array([np.concatenate(ids).tobytes()], pa.binary()), "sizes": pa.array([np.concatenate(sizes).tobytes()], pa.binary()), "sigs": pa.array([b"".join(sigs)], pa.binary())})

    for batch in batches:
        for at in range(0, batch.num_rows, PACK):
            some = batch.slice(at, PACK)
            ids.append(some.column(0).to_numpy()), sizes.append(some.column(1).to_numpy()), sigs.extend(some.column(2).to_pylist())
            if len(sigs) >= PACK:
                yield row()
                seq, ids, sizes, sigs = seq + 1, [], [], []
    if sigs:
        yield row()


PACK_SCHEMA = "chunk long, ids binary, sizes binary, sigs binary"


def _packs(table):
    for chunk, ids, sizes, sigs in zip(*(table.column(c).to_pylist() for c in ("chunk", "ids", "sizes", "sigs")), strict=True):
        cls = np.frombuffer(ids, np.int64)
        yield chunk, cls, np.frombuffer(sizes, np.int64), np.frombuffer(sigs, np.uint32).reshape(len(cls), -1)


def _unpack_sigs(batches):
    for batch in batches:
        for _, cls, _, sigs in _packs(batch):
            yield pa.RecordBatch.from_pydict({"cls": pa.array(cls), "sig": pa.array([s.tobytes() for s in sigs], pa.binary())})


def _offer(batches, buckets: int):
    for batch in batches:
        for chunk, _, _, sigs in _packs(batch):
            found, counts = np.unique(tokens_of(sigs), return_counts=True)
            yield sent(chunk, found, buckets, narrow(counts))


def _tally(table: pa.Table) -> pa.Table:
    parts = [received(p) for p in table.column("payload").to_pylist()]
    groups, back = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
    total = np.bincount(back, weights=np.concatenate([c for _, c in parts]), minlength=len(groups)).astype(np.int64)[back]
    cuts = np.cumsum([0] + [len(h) for h, _ in parts])
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "counts": pa.array([pack(narrow(total[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})


POST_SCHEMA = "token long, cls long, size long, n long, far long, rest long, score long"


def _post(packs: pa.Table, answers: pa.Table, prefix: int, buckets: int, short: int) -> pa.Table:
    """Posted tokens: how many classes have each (``n``), how many long lists the class is posted in (``far``), in how
    many of those from this token on, the rarest first (``rest``), and how shared its posted tokens are (``score``)."""
    out = {c: [np.zeros(0, np.int64)] for c in ("token", "cls", "size", "n", "far", "rest", "score")}
    for _, cls, size, sigs in _packs(packs):
        t = tokens_of(sigs)
        found, back = np.unique(t, return_inverse=True)
        counts, cuts = np.zeros(len(found), np.int64), by_bucket(found, buckets)
        for k, payload in zip(answers.column("bucket").to_pylist(), answers.column("counts").to_pylist(), strict=True):
            counts[cuts[k] : cuts[k + 1]] = unpack(payload)[0]
        n = counts[back].reshape(t.shape)
        order = np.lexsort((t, n), axis=1)[:, :prefix]
        t, n = np.take_along_axis(t, order, axis=1), np.take_along_axis(n, order, axis=1)
        shared = n > 1
        shared &= (shared.sum(axis=1) >= LEAST)[:, None]
        far = shared & (n > short)
        out["token"].append(t[shared].view(np.int64))
        out["n"].append(n[shared])
        out["rest"].append(np.cumsum(far[:, ::-1], axis=1)[:, ::-1][shared])
        for name, each in (("cls", cls), ("size", size), ("far", far.sum(axis=1)), ("score", (n * shared).sum(axis=1))):
            out[name].append(np.broadcast_to(each[:, None], t.shape)[shared])
    return pa.table({k: np.concatenate(v) for k, v in out.items()})


def _merge(batches, percent: int):
    """Pairs of the members of short lists whose sizes allow the threshold, with the collisions counted so far."""
    for batch in batches:
        lists = batch.column(0)
        lengths = np.diff(lists.offsets.to_numpy())
        first = np.cumsum(lengths) - lengths
        cls, size, far = (lists.flatten().field(k).to_numpy() for k in range(3))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in np.unique(lengths).tolist():
            at = first[lengths == n][:, None]
            i, j = np.triu_indices(n, 1)
            a.append((at + i).ravel()), b.append((at + j).ravel())
        a, b = np.concatenate(a), np.concatenate(b)
        ok = 100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])
        a, b = a[ok], b[ok]
        if not len(a):
            continue
        low, high = np.minimum(cls[a], cls[b]), np.maximum(cls[a], cls[b])
        more = np.minimum(far[a], far[b])
        order = np.lexsort((high, low))
        low, high, more = low[order], high[order], more[order]
        new = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
        yield pa.RecordBatch.from_pydict({"a": low[new], "b": high[new], "far": more[new], "collisions": np.diff(np.append(new, len(low)))})


def _look_up(batches, matches: int):
    """The collisions over all coordinates."""
    for batch in batches:
        if batch.num_rows:
            agree = (_sig_matrix(batch.column(2)) == _sig_matrix(batch.column(3))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(agree, pa.int64())], names=["a", "b", "collisions"]).filter(pa.array(agree >= matches))


def _known_sets(cls: list[int], texts: list[bytes], words: int) -> dict[int, np.ndarray]:
    out = {}
    for at in range(0, len(cls), ROWS):
        out |= dict(zip(cls[at : at + ROWS], shingle_sets(texts[at : at + ROWS], words), strict=True))
    return out


def _confirm(pairs: pa.Table, texts: pa.Table, words: int, percent: int) -> pa.Table:
    """Of the pairs of one group: those whose sets reach the threshold."""
    known = _known_sets(texts.column("cls").to_pylist(), texts_of(texts.column("text")), words)
    a, b = [], []
    for x, y in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
        one, two = known[x], known[y]
        both = len(np.intersect1d(one, two, assume_unique=True))
        if 100 * both >= percent * (len(one) + len(two) - both):
            a.append(x), b.append(y)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _confirmed(pairs: DataFrame, sized: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the pairs (a, b): those whose sets reach the threshold.

    Pairs meet in groups of about ``GROUP`` pairs and ``GROUP_SHINGLES`` shingles, by the one of the two that has more
    pairs; if it has more than a group's, its pairs are dealt to several."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("degree"))
    ends = materialize(ends.join(sized, "cls"), "ends")
    total = ends.agg(F.sum("degree"), F.sum(F.col("degree") * F.col("size"))).first()
    if not total[0]:
        release(ends)
        return pairs.select("a", "b")
    groups = max(1, -(-total[0] // (2 * GROUP)), -(-total[1] // GROUP_SHINGLES))
    of = lambda c: ends.select(F.col("cls").alias(c), F.col("degree").alias(f"degree_{c}"))
    both = salted_join(salted_join(pairs, of("a"), "a", F.xxhash64("b")), of("b"), "b", F.xxhash64("a"))
    hub = F.when(F.col("degree_a") >= F.col("degree_b"), F.col("a")).otherwise(F.col("b"))
    other = F.when(F.col("degree_a") >= F.col("degree_b"), F.col("b")).otherwise(F.col("a"))
    cut = F.pmod(F.xxhash64(other), F.ceil(F.greatest("degree_a", "degree_b") / F.lit(GROUP)))
    grouped = materialize(both.select(F.pmod(F.xxhash64(hub, cut), F.lit(groups)).alias("group"), "a", "b"), "grouped")
    needed = grouped.select(F.col("group").alias("where"), F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = needed.join(texts, "cls").groupBy("where")
    links = materialize(grouped.groupBy("group").cogroup(sets).applyInArrow(lambda p, t: _confirm(p, t, words, percent), "a long, b long"), "links")
    release(ends, grouped)
    return links


def _bundle(table: pa.Table) -> pa.Table:
    """A block of classes as one row."""
    texts = texts_of(table.column("text"))
    raw = b"".join(texts)
    numbers = pack(*(table.column(c).to_numpy().astype(np.int64) for c in ("cls", "component", "size")), np.array([len(t) for t in texts], np.int64))
    body = pa.compress(raw, codec="zstd", asbytes=True) if raw else b""
    component, size = (table.column(c).to_numpy().astype(np.int64) for c in ("component", "size"))
    outline = pack(component, narrow(size), _sig_matrix(table.column("sig")).astype(np.uint8).T.ravel())
    return pa.table({"block": table.column("block")[:1], "outline": pa.array([outline], pa.binary()), "numbers": pa.array([numbers], pa.binary()), "sigs": pa.array([b"".join(table.column("sig").to_pylist())], pa.binary()), "body": pa.array([body], pa.binary())})


class _Outline:
    """Of a block what tells most pairs apart: components, sizes, and the low byte of each coordinate."""

    def __init__(self, outline: bytes):
        self.component, size, sig = unpack(outline)
        self.size = size.astype(np.int64)
        self.sig = sig.reshape(-1, len(size)).T


class _Block:
    def __init__(self, numbers: bytes, sigs: bytes, body: bytes):
        self.cls, self.component, self.size, lengths = unpack(numbers)
        self.sig = np.frombuffer(sigs, np.uint32).reshape(len(self.cls), -1)
        raw = pa.decompress(body, decompressed_size=int(lengths.sum()), codec="zstd", asbytes=True) if lengths.sum() else b""
        ends = np.cumsum(lengths)
        self.texts = [raw[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many items each two sets share."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    some = often > 1  # what one set alone has is in no intersection
    place = np.cumsum(some) - 1
    row, column = row[some[column]], place[column[some[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(some.sum()), 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        both += part @ part.T
    return both


def _near(x, y, matches: int, percent: int) -> np.ndarray:
    """Which classes of two blocks, or of one with itself, are in different components and collide often enough."""
    out = (x.component[:, None] != y.component[None, :]) & (100 * np.minimum(x.size[:, None], y.size[None, :]) >= percent * np.maximum(x.size[:, None], y.size[None, :]))
    if x is y:
        out &= np.triu(np.ones(out.shape, bool), 1)
    for i in np.flatnonzero(out.any(axis=1)):
        at = np.flatnonzero(out[i])
        out[i, at[(y.sig[at] == x.sig[i]).sum(axis=1) < matches]] = False
    return out


def _screen(table: pa.Table, matches: int, percent: int) -> pa.Table:
    """The pair of blocks, if by their outlines it may have a link. Low bytes agree wherever whole values do."""
    blocks = [_Outline(o) for o in table.column("outline").to_pylist()]
    return table.select(["pair"]).slice(0, int(_near(blocks[0], blocks[-1], matches, percent).any()))


def _cross(table: pa.Table, words: int, matches: int, percent: int) -> pa.Table:
    """Of two blocks, or of one with itself: a spanning forest of the links between different components."""
    blocks = [_Block(*(table.column(c)[i].as_py() for c in ("numbers", "sigs", "body"))) for i in range(table.num_rows)]
    x, y = blocks[0], blocks[-1]
    i, j = np.nonzero(_near(x, y, matches, percent))
    out = [np.zeros(0, np.int64)] * 2
    if len(i):
        use_x, at_x = np.unique(i, return_inverse=True)
        use_y, at_y = np.unique(j, return_inverse=True)
        sets = []
        for block, use in ((x, use_x), (y, use_y)):
            for at in range(0, len(use), ROWS):
                sets += shingle_sets([block.texts[k] for k in use[at : at + ROWS].tolist()], words)
        common = shared_counts(sets)[at_x, len(use_x) + at_y].astype(np.int64)
        ok = 100 * common >= percent * (x.size[i] + y.size[j] - common)
        if ok.any():
            nodes, roots = forest(x.cls[i[ok]], y.cls[j[ok]])
            out = [nodes[nodes != roots], roots[nodes != roots]]
    return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})


def _crossing(lists: DataFrame, groups: DataFrame, packs: DataFrame, texts: DataFrame, words: int, matches: int, percent: int) -> DataFrame:
    """Links between members of one long list that are in different components, found block by block. Blocks meet if
    they have members of one list whose sizes allow the threshold."""
    labelled = lists.join(groups.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    labelled = materialize(labelled, "labelled")
    several = labelled.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("token")
    entries = materialize(salted_join(labelled, several, "token", F.xxhash64("cls")), "open")
    release(labelled)
    if entries.isEmpty():
        return entries.select(F.col("cls").alias("a"), F.col("head").alias("b"))
    # a class goes with the head of its most shared list
    led = materialize(entries.groupBy("cls").agg(F.max_by("head", F.struct("n", "token")).alias("head"), F.first("component").alias("component"), F.first("size").alias("size")), "led")
    main = led.groupBy("head", "component").agg(F.count("*").alias("k")).groupBy("head").agg(F.max_by("component", F.struct("k", "component")).alias("main"))
    part = salted_join(led, main, "head", F.xxhash64("cls")).withColumn("pure", F.when(F.col("component") == F.col("main"), F.col("main"))).drop("main")
    part = part.withColumn("part", F.xxhash64("head", F.col("pure").isNull()))
    cuts = part.groupBy("part").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("cuts"))
    placed = materialize(salted_join(part, cuts, "part", F.xxhash64("cls")).select("cls", "component", "size", "pure", F.xxhash64("part", F.pmod(F.xxhash64("cls"), F.col("cuts"))).alias("block")), "placed")

    met = entries.select("token", "cls").join(placed.select("cls", "block", "pure", "size"), "cls")
    met = met.groupBy("token", "block").agg(F.first("pure").alias("pure"), F.min("size").alias("low"), F.max("size").alias("high"))
    met = met.groupBy("token").agg(F.array_sort(F.collect_list(F.struct("block", "pure", "low", "high"))).alias("m")).select("m").distinct()
    each = met.select("m", F.posexplode("m").alias("at", "x")).select("x", F.explode(F.slice("m", F.col("at") + 1, F.size("m"))).alias("y"))
    open_ = (F.col("x.block") == F.col("y.block")) & F.col("x.pure").isNull() | (F.col("x.block") != F.col("y.block")) & ~F.coalesce(F.col("x.pure") == F.col("y.pure"), F.lit(False))
    alike = (100 * F.col("x.high") >= percent * F.col("y.low")) & (100 * F.col("y.high") >= percent * F.col("x.low"))
    meet = materialize(each.filter(open_ & alike).select(F.col("x.block").alias("x"), F.col("y.block").alias("y")).distinct(), "meet")

    sigs = packs.mapInArrow(_unpack_sigs, "cls long, sig binary")
    members = placed.join(texts, "cls").join(sigs, "cls")
    bundles = materialize(members.groupBy("block").applyInArrow(_bundle, "block long, outline binary, numbers binary, sigs binary, body binary"), "bundles")
    sides = meet.select(F.xxhash64("x", "y").alias("pair"), F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    outlines = sides.join(bundles.select("block", "outline"), "block").groupBy("pair")
    close = materialize(outlines.applyInArrow(lambda t: _screen(t, matches, percent), "pair long"), "close")
    whole = sides.join(close, "pair", "left_semi").join(bundles.drop("outline"), "block").groupBy("pair")
    links = materialize(whole.applyInArrow(lambda t: _cross(t, words, matches, percent), "a long, b long"), "links")
    release(entries, led, placed, meet, bundles, close)
    return links


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, coordinates: int = 64, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, one_row: bool = False, short: int = SHORT) -> DataFrame:
    """Links texts whose sets of ``words``-word shingles have a Jaccard similarity of ``percent`` hundredths or more,
    and groups what links reach.

    Returns a row for each row of ``docs`` with the columns ``carry`` (unset: all but the text), ``n_shingles``,
    ``component_id`` (the smallest id of the group) and ``kept`` (whether it is the row's own). Words are lower
    case; a text of fewer words than a shingle has is one shingle; a null, empty or blank text has none, is linked
    with nothing and is kept. Rows that repeat an id with its text share its values; a null id never is the
    smallest, and its row is kept only if its group has no id. With ``one_row`` a group keeps a single row: of those
    that would be kept the first by a digest of the text, and of repeated ones any. A column named as a result is is
    dropped; an empty table gives an empty one; long texts are compared whole. Ids are integers or their texts.
    """
    results = ["n_shingles", "component_id", "kept"]
    carry = carried_columns(docs, text_col, results) if carry is None else carry
    matches = match_threshold(coordinates, percent / 100)
    prefix = coordinates - matches + LEAST
    ident, text = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    key = F.coalesce(ident, F.xxhash64(text))
    kept = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(None).alias("__none"))
    slim = docs.select(text.alias("__text"), ident.alias("__id"), F.struct(key.alias("key"), F.xxhash64(text).alias("digest")).alias("__place"), kept.alias("__row"))
    names = ["__id", "__place", "__row"]
    if one_row:  # the table is written before the numbers are used, so they stay
        slim, names = slim.withColumn("__no", F.monotonically_increasing_id()), [*names, "__no"]
    signed = materialize(slim.mapInArrow(lambda b: _sign(b, words, coordinates, names), fields_of(slim, names, "cls long, n_shingles long, sig binary")), "signed")

    buckets = n_buckets(docs.sparkSession)
    full = signed.filter("cls is not null")
    packs = materialize(full.groupBy("cls").agg(F.min("n_shingles").alias("size"), F.min("sig").alias("sig")).mapInArrow(_pack, PACK_SCHEMA), "packs")
    counts = packs.mapInArrow(lambda b: _offer(b, buckets), EXCHANGE_SCHEMA).groupBy("bucket").applyInArrow(_tally, "chunk long, bucket long, counts binary")
    posted = materialize(packs.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(lambda p, a: _post(p, a, prefix, buckets, short), POST_SCHEMA), "posted")

    brief = posted.filter(F.col("n") <= short).groupBy("token").agg(F.collect_list(F.struct("cls", "size", "far")).alias("members")).filter(F.size("members") > 1)
    merged = brief.select("members").mapInArrow(lambda b: _merge(b, percent), "a long, b long, far long, collisions long")
    merged = merged.groupBy("a", "b").agg(F.sum("collisions").alias("collisions"), F.max("far").alias("far")).filter(F.col("collisions") + F.col("far") >= LEAST)
    long = posted.filter(F.col("n") > short)
    heads = long.groupBy("token").agg(F.max_by("cls", F.struct("score", "cls")).alias("head"))
    lists = materialize(salted_join(long, heads, "token", F.xxhash64("cls")).select("token", "cls", "size", "n", "rest", "head"), "lists")
    stars = lists.filter("cls <> head").select(F.least("cls", "head").alias("a"), F.greatest("cls", "head").alias("b"))
    candidates = materialize(merged.select("a", "b").unionByName(stars).distinct(), "candidates")
    sigs = packs.mapInArrow(_unpack_sigs, "cls long, sig binary")
    of = lambda c: sigs.select(F.col("cls").alias(c), F.col("sig").alias(f"sig_{c}"))
    looked = candidates.join(of("a"), "a").join(of("b"), "b")
    likely = materialize(looked.select("a", "b", "sig_a", "sig_b").mapInArrow(lambda b: _look_up(b, matches), "a long, b long, collisions long"), "likely")
    release(candidates)

    # pairs that no short list has brought share LEAST long ones, the rarest of them before the last LEAST - 1 of both
    far = lists.filter(F.col("rest") >= LEAST)
    # one row a class: its set's size, and the place of one text that has it
    wanted = likely.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(far.select("cls")).distinct()
    places = full.groupBy("cls").agg(F.min("__place").alias("place"), F.min("n_shingles").alias("size")).join(wanted, "cls", "left_semi")
    places = materialize(places.select("cls", "size", "place.key", "place.digest"), "places")
    # one plan at every size: the texts are dealt by their keys, however few are wanted
    found = docs.select(key.alias("key"), F.xxhash64(text).alias("digest"), text.alias("text")).hint("merge").join(places.hint("merge"), ["key", "digest"]).groupBy("cls").agg(F.first("text").alias("text"))
    texts = materialize(found, "texts")
    sized = places.select("cls", "size")

    ends = likely.select(F.explode(F.array(F.struct(F.col("a").alias("cls"), F.col("b").alias("other"), "collisions"), F.struct(F.col("b").alias("cls"), F.col("a").alias("other"), "collisions"))).alias("e")).select("e.*")
    best = ends.groupBy("cls").agg(F.max_by("other", F.struct("collisions", "other")).alias("other"))
    best = materialize(best.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct(), "best")
    links = _confirmed(best, sized, texts, words, percent)
    groups = connected_components(links, "a", "b")
    of = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"component_{c}"))
    apart = F.coalesce("component_a", "a") != F.coalesce("component_b", "b")
    others = likely.join(best, ["a", "b"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left").filter(apart)
    others = materialize(others.select("a", "b"), "others")
    if not others.isEmpty():
        more = _confirmed(others, sized, texts, words, percent)
        if not more.isEmpty():
            links = links.unionByName(more)
            groups = connected_components(links, "a", "b")
    if not far.isEmpty():
        crossing = _crossing(far, groups, packs, texts, words, matches, percent)
        if not crossing.isEmpty():
            groups = connected_components(links.unionByName(crossing), "a", "b")

    # rows alone in their group keep their own id; all others get the group's
    first = [F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", F.col("__place.digest").alias("digest"), "__no")).alias("first")] if one_row else []
    least = [F.min("first").alias("one")] if one_row else []
    classes = full.groupBy("cls").agg(F.min("__id").alias("least"), F.count("*").alias("copies"), *first)
    member = classes.join(groups.withColumnRenamed("node", "cls"), "cls", "left").filter("copies > 1 or component is not null").withColumn("component", F.coalesce("component", "cls"))
    member = materialize(member, "member")
    names_of = member.groupBy("component").agg(F.min("least").alias("component_id"), *least)
    named = salted_join(member.select("cls", "component"), names_of, "component", F.xxhash64("cls")).select("cls", "component_id", *(["one"] if one_row else []), F.lit(True).alias("grouped"))
    out = salted_join(signed.drop("sig"), named, "cls", F.xxhash64("__place"), "left")
    out = out.withColumn("component_id", F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("__id")))
    kept = F.coalesce(F.col("__id") == F.col("component_id"), F.col("component_id").isNull())
    if one_row:
        kept = F.col("grouped").isNull() | (F.col("__no") == F.col("one.__no"))
    columns = [F.col(f"__row.`{c}`") for c in carry]
    release(packs, posted, lists, likely, places, texts, best)
    return out.select(*columns, "n_shingles", "component_id", kept.alias("kept"))
