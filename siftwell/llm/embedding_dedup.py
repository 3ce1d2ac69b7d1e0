"""Operator 6: near-duplicate vectors by randomised-rotation binary codes.

A unit vector is rotated at random, several times, and keeps the signs of its coordinates as a binary code; its first
rotation's signs, taken as a unit vector x, also leave a correction factor f, the inner product of x and the rotated
vector. Code and factor are stored once for each vector. Two bounds decide which pairs are recomputed:

* The share of bits in which two codes differ is an unbiased estimate of their angle over pi. A pair that differs in
  more bits than one at the threshold does by ``sigmas`` deviations is dropped; that takes an exclusive or and a bit
  count, and needs the codes alone.
* <x, q> / f, q being the other rotated vector, is an unbiased estimate of the cosine, whose deviation is about
  sqrt((1 - f^2) / (f^2 (d - 1))). A pair whose estimate plus ``sigmas`` deviations lies below the threshold is dropped.

Every other pair is recomputed exactly, in double precision.

Which pairs are looked at: vectors meet in the buckets of several bands of code bits. The bits of a band follow the
number of vectors (about ``PER_BUCKET`` unrelated ones in a bucket: the first bound is cheap, so buckets are large and
bands few), and the number of bands the recall that is asked for at the threshold: 1 - (1 - p^bits)^bands with
p = 1 - arccos(threshold) / pi. A bucket receives key and code, 24 bytes a vector, and says which of its vectors have a
pair left; only these are sent there in full.

Equal vectors are one class with a count. A bucket over ``BLOCK`` vectors is dealt out as pairs of blocks. Pairs never
leave a task: it returns a count of links for each vector and a spanning forest; a pair that meets in several bands
counts in the first of them. Counting every link of a group of near copies takes the square of the group, in blocks of
bounded size.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried_columns, fields_of, materialize, release, salted_join
from .components import connected_components, forest

BLOCK = 4096
PER_BUCKET = 1024
CODE_WORDS = 2  # of 64 bits
SEED = 20_240_611
BAND_BITS, DIM_BITS = 11, 13  # of a bucket's number


def rotation(dim: int, k: int) -> np.ndarray:
    """The k-th random rotation of a dimension."""
    rng = np.random.Generator(np.random.PCG64([SEED, dim, k]))
    q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def plan_bands(vectors: int, threshold: float, recall: float) -> tuple[int, int]:
    bits = max(4, math.ceil(math.log2(max(vectors, 1) / PER_BUCKET)) if vectors > PER_BUCKET else 4)
    p = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def most_bits(threshold: float, sigmas: float) -> int:
    """In how many code bits a pair at the threshold may differ."""
    n, q = 64 * CODE_WORDS, math.acos(threshold) / math.pi
    return int(n * q + sigmas * math.sqrt(n * q * (1 - q)))


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; null where they are null, empty, zero or hold null or non-finite components."""
    out = []
    for x in column.to_pylist():
        v = None if x is None or any(c is None for c in x) else np.array(x, np.float64)
        out.append(v if v is not None and len(v) and np.isfinite(v).all() and v.any() else None)
    return out


def _digest(batches, names: list[str]):
    for batch in batches:
        raw = [None if v is None else v.tobytes() for v in _vectors(batch.column(0))]
        key = [None if r is None else int.from_bytes(hashlib.blake2b(r, digest_size=8).digest(), "little", signed=True) for r in raw]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(key, pa.int64()), pa.array(raw, pa.binary())], names=[*names, "key", "vector"])


def units_of(raw: list[bytes]) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def code_bits(units: np.ndarray, bits: int) -> np.ndarray:
    """The first ``bits`` sign bits under as many rotations as it takes, as bools."""
    dim = units.shape[1]
    return np.concatenate([units @ rotation(dim, k).T > 0 for k in range(-(-bits // dim))], axis=1)[:, :bits]


def factors_of(units: np.ndarray) -> np.ndarray:
    dim = units.shape[1]
    return np.abs(units @ rotation(dim, 0).T).sum(axis=1) / math.sqrt(dim)


def _encode(batches, bits: int, bands: int):
    """Code, factor and buckets of each vector."""
    weight = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        raw = batch.column(1).to_pylist()
        by_size: dict[int, list[int]] = {}
        for i, r in enumerate(raw):
            by_size.setdefault(len(r), []).append(i)
        for size, rows in by_size.items():
            for at in range(0, len(rows), 512):
                own = rows[at : at + 512]
                u = units_of([raw[i] for i in own])
                code = code_bits(u, max(bits * bands, 64 * CODE_WORDS))
                values = code[:, : bits * bands].reshape(len(own), bands, bits).astype(np.int64) @ weight
                places = (((values << BAND_BITS) + np.arange(bands)) << DIM_BITS) + size // 8 % (1 << DIM_BITS)
                packed = np.packbits(code[:, : 64 * CODE_WORDS], axis=1)
                some = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array([c.tobytes() for c in packed], pa.binary()), pa.array(factors_of(u)), pa.array(places.tolist(), pa.list_(pa.int64()))],
                    names=["key", "vector", "copies", "code", "factor", "places"],
                )


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("key")


def _codes(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint64).reshape(table.num_rows, CODE_WORDS)


def _band(table: pa.Table) -> int:
    return (table.column("place")[0].as_py() >> DIM_BITS) & ((1 << BAND_BITS) - 1)


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    sub, i, j = table.column("sub").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
    one = np.flatnonzero(sub == i)
    return one, one if i == j else np.flatnonzero(sub == j)


def close_codes(code: np.ndarray, x: np.ndarray, y: np.ndarray, most: int):
    """Pairs of the two sides whose codes differ in ``most`` bits at most, some at a time; each pair of one side once."""
    for a in range(0, len(x), 256):
        part = x[a : a + 256]
        differ = np.bitwise_count(code[part][:, None, :] ^ code[y][None, :, :]).sum(axis=2, dtype=np.uint16)
        p, q = np.nonzero(differ <= most)
        p, q = part[p], y[q]
        if x is y:
            p, q = p[p < q], q[p < q]
        yield p, q


def met_before(bits_: np.ndarray, p: np.ndarray, q: np.ndarray, bits: int, band: int) -> np.ndarray:
    """Which pairs meet in a band before this one, as far as the bits given say."""
    out = np.zeros(len(p), bool)
    for t in range(min(band, bits_.shape[1] // bits)):
        own = bits_[:, t * bits : (t + 1) * bits]
        left = np.flatnonzero(~out)
        out[left] = (own[p[left]] == own[q[left]]).all(axis=1)
    return out


def _screen(table: pa.Table, bits: int, most: int) -> pa.Table:
    """Of two blocks of a bucket: the vectors that have a pair left."""
    table = _in_order(table)
    code = _codes(table)
    flat = np.unpackbits(code.view(np.uint8), axis=1).astype(bool)
    (x, y), band = _sides(table), _band(table)
    left = np.zeros(len(code), bool)
    for p, q in close_codes(code, x, y, most):
        new = ~met_before(flat, p, q, bits, band)
        left[p[new]] = left[q[new]] = True
    return table.select(["place", "i", "j", "key", "sub"]).filter(pa.array(left))


def _block(table: pa.Table, bits: int, bands: int, most: int, threshold: float, sigmas: float) -> pa.Table:
    """Of two blocks, the vectors with pairs left: their links, and a spanning forest."""
    table = _in_order(table)
    keys, copies, factor = (table.column(c).to_numpy() for c in ("key", "copies", "factor"))
    code, units = _codes(table), units_of(table.column("vector").to_pylist())
    dim, (x, y), band = units.shape[1], _sides(table), _band(table)
    turned = units @ rotation(dim, 0).T
    signs = np.where(turned > 0, 1 / math.sqrt(dim), -1 / math.sqrt(dim))
    slack = sigmas * np.sqrt(np.maximum(1 - factor**2, 0) / (factor**2 * max(dim - 1, 1)))
    met = code_bits(units, bits * band) if band else np.zeros((len(keys), 0), bool)
    links, a, b = np.zeros(len(keys)), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p, q in close_codes(code, x, y, most):
        for at in range(0, len(p), 1 << 16):
            one, two = p[at : at + (1 << 16)], q[at : at + (1 << 16)]
            near = np.einsum("ij,ij->i", signs[one], turned[two]) / factor[one] + slack[one] >= threshold
            one, two = one[near], two[near]
            exact = np.einsum("ij,ij->i", units[one], units[two]) >= threshold
            one, two = one[exact], two[exact]
            new = ~met_before(met, one, two, bits, band)
            one, two = one[new], two[new]
            links += np.bincount(one, weights=copies[two], minlength=len(keys)) + np.bincount(two, weights=copies[one], minlength=len(keys))
            nodes, roots = forest(one, two) if len(one) else (one, one)
            a.append(nodes[nodes != roots]), b.append(roots[nodes != roots])
    a, b = np.concatenate(a), np.concatenate(b)
    nodes, roots = forest(a, b) if len(a) else (a, a)
    root = keys.copy()
    root[nodes] = keys[roots]
    own = links > 0
    return pa.table({"key": keys[own], "links": links[own].astype(np.int64), "root": root[own]})


def near_vectors(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.9999, sigmas: float = 5.0, id_col: str = "vec_id", vector_col: str = "embedding", carry: list[str] | None = None) -> DataFrame:
    """Links vectors whose cosine is ``threshold`` or more, and groups what links reach.

    Returns a row for each row of ``vectors`` with the columns ``carry`` (unset: all but the vector), ``n_links``
    (other rows linked directly), ``component_id`` (the smallest id reachable) and ``kept`` (whether it is the row's
    own). Every link is exact; a pair at the threshold is found with probability ``recall`` or more, a closer one
    with more. Vectors that are null, empty, zero or hold null or non-finite components, and vectors of different
    lengths, are not linked. Equal vectors and repeated rows are linked; a null id is never the smallest, and its
    row is kept only if its group has no id. A column named as a result is is dropped; an empty table gives an
    empty one. Ids are integers or their texts.
    """
    results = ["n_links", "component_id", "kept"]
    carry = carried_columns(vectors, vector_col, results) if carry is None else carry
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(None).alias("__none"))
    slim = vectors.select(F.col(f"`{vector_col}`").cast("array<double>").alias("__v"), F.col(f"`{id_col}`").cast("long").alias("__id"), row.alias("__row"))
    keyed = materialize(slim.mapInArrow(lambda b: _digest(b, ["__id", "__row"]), fields_of(slim, ["__id", "__row"], "key long, vector binary")), "keyed")
    classes = materialize(keyed.filter("key is not null").groupBy("key").agg(F.min("vector").alias("vector"), F.count("*").alias("copies")), "classes")
    bits, bands = plan_bands(classes.count(), threshold, recall)
    most = most_bits(threshold, sigmas)

    encoded = materialize(classes.select("key", "vector", "copies").mapInArrow(lambda b: _encode(b, bits, bands), "key long, vector binary, copies long, code binary, factor double, places array<long>"), "encoded")
    release(classes)
    posted = encoded.select(F.explode("places").alias("place"), "key", "code")
    fill = posted.groupBy("place").agg(F.count("*").alias("n")).filter("n > 1").select("place", F.ceil(F.col("n") / BLOCK).cast("int").alias("subs"))
    placed = salted_join(posted, fill, "place", F.xxhash64("key")).withColumn("sub", F.pmod(F.xxhash64("key", F.lit(SEED)), F.col("subs")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
    dealt = dealt.select("place", "key", "code", "sub", F.least("sub", "other").alias("i"), F.greatest("sub", "other").alias("j"))
    left = materialize(dealt.groupBy("place", "i", "j").applyInArrow(lambda t: _screen(t, bits, most), "place long, i int, j int, key long, sub int"), "left")
    whole = left.join(encoded.select("key", "vector", "copies", "code", "factor"), "key")
    found = materialize(whole.groupBy("place", "i", "j").applyInArrow(lambda t: _block(t, bits, bands, most, threshold, sigmas), "key long, links long, root long"), "found")
    release(left, encoded)

    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    groups = connected_components(found.filter("key <> root"), "key", "root").withColumnRenamed("node", "key")
    # rows alone in their group keep their own id; all others get the group's
    own = keyed.filter("key is not null").groupBy("key").agg(F.min("__id").alias("least"), F.count("*").alias("copies"))
    member = own.join(groups, "key", "left").filter("copies > 1 or component is not null").join(links, "key", "left").withColumn("component", F.coalesce("component", "key"))
    member = materialize(member, "member")
    heads = member.groupBy("component").agg(F.min("least").alias("component_id"))
    named = salted_join(member, heads, "component", F.xxhash64("key")).select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.lit(True).alias("grouped"))
    out = salted_join(keyed.drop("vector"), named, "key", F.xxhash64("__id"), "left")
    out = out.withColumn("component_id", F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("__id")))
    columns = [F.col(f"__row.`{c}`") for c in carry]
    kept = F.coalesce(F.col("__id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select(*columns, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", kept.alias("kept"))
