"""Operator 9: toxicity by non-negative positive-unlabelled learning.

The classifier is linear in the presence of words. It learns from texts that are confirmed toxic and from
unlabelled ones, whose own labels it never sees, by the class-prior-corrected risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

where R_p and R_u are mean sigmoid losses over positive and unlabelled texts: the negative part of the risk is
what unlabelled texts show beyond the share of positives among them, and it is never let below 0 (when a step
would do so, the step goes against that part's gradient instead). The boundary is then set in the widest gap of the
unlabelled margins near the prior. The prior is the share of toxic texts among
the labelled rows of the training folds.

Where no gap stands out, or the sample's share of toxic texts is far from the prior, the boundary stays at the risk's own
zero or within half to 1.15 times the prior: it never calls more than that share of the sample toxic.

Training runs on the driver in numpy on a bounded sample of rows (``Sample``), each with all its words; scoring is one pass over all rows
with a model of some thousand words, which is all that is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, LOWER, carried_columns, fields_of, pack, texts_of, unpack, word_hashes

#: Words end at white space and at ASCII punctuation.
BREAK = IS_SPACE.copy()
BREAK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


@dataclass(frozen=True)
class Sample:
    """Bounds of the training sample, each taken in the order of a digest of the id, and of the model."""

    positives: int = 2000
    unlabelled: int = 6000
    words: int = 4096
    steps: int = 150
    rate: float = 0.1
    decay: float = 1e-4


def text_words(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word of the lower-cased texts."""
    buf = LOWER[np.frombuffer(b" " + b" ".join([t or b"" for t in texts]) + b" ", np.uint8)]
    first = np.cumsum([1] + [len(t or b"") + 1 for t in texts])
    gap = BREAK[buf]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    return np.searchsorted(first, starts, side="right") - 1, word_hashes(buf, starts, ends)


def held_out(id_col: str, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds == fold, F.lit(False))


def _sampled(batches):
    for batch in batches:
        texts = texts_of(batch.column(1))
        row, h = text_words(texts)
        out = []
        for r in range(len(texts)):
            a, b = np.searchsorted(row, [r, r + 1])
            out.append(pack(np.unique(h[a:b] >> np.uint64(16))))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["positive", "words"])


class Model:
    """Sorted word hashes, their weights, and the bias."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, bias: float):
        self.words, self.weights, self.bias = words, weights.astype(np.float64), float(bias)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        if len(self.words) and len(texts):
            row, h = text_words(texts)
            h >>= np.uint64(16)
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = self.words[at] == h
            pairs = np.unique(row[hit] * len(self.words) + at[hit])  # a word counts once in a text
            z += np.bincount(pairs // len(self.words), weights=self.weights[pairs % len(self.words)], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, sample: Sample) -> Model:
    """Trains on word hashes, distinct within each text."""
    n_p, n_u = len(positive), len(unlabelled)
    prior = min(max(prior, 1e-3), 0.5)
    flat = np.log(prior / (1 - prior))
    if not n_p or not n_u:
        return Model(np.zeros(0, np.uint64), np.zeros(0), flat)
    in_p, df_p = np.unique(np.concatenate(positive), return_counts=True)
    both, back = np.unique(np.concatenate([in_p, np.concatenate(unlabelled)]), return_inverse=True)
    df_p_all = np.bincount(back[: len(in_p)], weights=df_p, minlength=len(both))
    df_u = np.bincount(back[len(in_p) :], minlength=len(both))
    share_p, share = df_p_all / n_p, (df_p_all + df_u) / (n_p + n_u)
    gain = np.where(df_p_all >= 3, (share_p - share) / np.sqrt(share * (1 - share) / n_p + 1e-12), 0)
    chosen = np.sort(np.argsort(-np.abs(gain), kind="stable")[: sample.words])
    chosen = chosen[np.abs(gain[chosen]) > 4]  # words that differ between the two by chance are left out
    words, k = both[chosen], len(chosen)

    def matrix(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row, h = np.repeat(np.arange(len(texts)), [len(t) for t in texts]), np.concatenate(texts)
        at = np.minimum(np.searchsorted(words, h), max(k - 1, 0))
        hit = words[at] == h if k else np.zeros(len(h), bool)
        return row[hit], at[hit]

    (p_row, p_col), (u_row, u_col) = matrix(positive), matrix(unlabelled)
    theta, m, v = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    theta[k] = flat
    margin = lambda r, c, n: theta[k] + np.bincount(r, weights=theta[c], minlength=n)
    for step in range(1, sample.steps + 1):
        s_p, s_u = (1 / (1 + np.exp(-margin(*x))) for x in ((p_row, p_col, n_p), (u_row, u_col, n_u)))
        slope_p, slope_u = s_p * (1 - s_p), s_u * (1 - s_u)
        # sigmoid losses: 1 - s for a text held to be positive, s for one held to be negative
        negative = s_u.mean() - prior * s_p.mean()
        g_p, g_u = np.zeros(n_p), np.zeros(n_u)
        if negative >= 0:
            g_p -= 2 * prior * slope_p / n_p
            g_u += slope_u / n_u
        else:
            g_p += prior * slope_p / n_p
            g_u -= slope_u / n_u
        grad = np.append(np.bincount(p_col, weights=g_p[p_row], minlength=k)[:k] + np.bincount(u_col, weights=g_u[u_row], minlength=k)[:k], g_p.sum() + g_u.sum())
        grad[:k] += sample.decay * theta[:k]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - sample.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(words, theta[:k], theta[k] - boundary(margin(u_row, u_col, n_u), prior))


def boundary(margins: np.ndarray, prior: float) -> float:
    """Where to part positives from the rest: the middle of the widest gap between the margins of unlabelled texts,
    where half to a little over the class prior of them lie above it."""
    s, n = np.sort(margins)[::-1], len(margins)
    low, high = max(1, int(0.5 * prior * n)), min(n - 1, int(1.15 * prior * n) + 1)
    if high < low:
        return 0.0
    gaps = s[low - 1 : high] - s[low : high + 1]
    k = low + int(np.argmax(gaps))
    return float(s[k - 1] + s[k]) / 2 if gaps.max() > 1e-9 else 0.0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, held: int = 0, sample: Sample = Sample()) -> Model:
    """Learns from the rows whose crc32 of the id as text leaves another remainder than ``held`` modulo ``folds``."""
    key = F.col(f"`{id_col}`").cast("long")
    label = labels.filter(~held_out(id_col, folds, held)).select(key.alias("__id"), F.col(f"`{label_col}`").cast("int").alias("__label")).filter("__id is not null and __label is not null")
    totals = label.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("__label") == 1).cast("int")), F.lit(0)).alias("p")).first()
    if not totals["p"]:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.log(0.01))
    place = F.xxhash64("__id")
    toxic = label.filter("__label = 1").groupBy("__id").agg(F.lit(True).alias("positive")).orderBy(place, "__id").limit(sample.positives)
    others = docs.filter(~held_out(id_col, folds, held)).select(key.alias("__id")).filter("__id is not null").orderBy(place, "__id").limit(sample.unlabelled).select("__id", F.lit(False).alias("positive"))
    chosen = toxic.unionByName(others)
    # at most positives + unlabelled ids, hence the broadcast
    rows = docs.select(key.alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text")).join(F.broadcast(chosen), "__id")
    found = rows.select("positive", "__text").mapInArrow(_sampled, "positive boolean, words binary").collect()
    found.sort(key=lambda r: (r["positive"], bytes(r["words"])))
    words = {x: [unpack(bytes(r["words"]))[0] for r in found if r["positive"] == x] for x in (True, False)}
    return fit(words[True], words[False], totals["p"] / totals["n"], sample)


def _score(batches, model: Model, carry: list[str]):
    for batch in batches:
        n, texts = batch.num_rows, texts_of(batch.column(0))
        for at in range(0, n, 256):
            s = model.scores(texts[at : at + 256])
            rest = batch.select(range(1, batch.num_columns)).slice(at, len(s))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], names=[*carry, "score", "predicted"])


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None, keep_text: bool = False) -> DataFrame:
    """Scores every whole text with a trained model.

    Returns a row for each row of ``docs`` with the columns ``carry`` (unset: all but the text), ``score`` (0 to 1,
    higher is more likely toxic) and ``predicted`` (1 from 0.5 on). A null or empty text gets the score of a text
    without any known word; repeated rows and null ids are scored as others; a column named as a result is is
    dropped; an empty table gives an empty one.
    """
    carry = carried_columns(docs, "" if keep_text else text_col, ["score", "predicted"]) if carry is None else carry
    slim = docs.select(F.col(f"`{text_col}`").cast("string").alias("__text"), *[F.col(f"`{c}`") for c in carry])
    return slim.mapInArrow(lambda b: _score(b, model, carry), fields_of(docs, carry, "score double, predicted int"))
