"""Operator 1: language-model scores from a probabilistic suffix tree over words.

The symbols are a text's lower-cased words and its end; all words that training has not seen are one symbol. A context
is the last 1 to ``depth`` symbols, of which the oldest may be the start of the text. The root predicts by counts plus
one: (count + 1) / (tokens + distinct + 1). A context that occurs twice or more in training is retained by a divergence
test: the count-weighted log ratio of its next-symbol distribution, each symbol's own occurrence left out, to that of
the longest retained shorter context must reach ``least_gain`` nats. (Without the leaving out, every rare context would
pass, as its few next symbols are all it has.) A retained context's distribution is smoothed towards that shorter
context's: (count + kinds * shorter) / (total + kinds), kinds being its different next symbols; it sums to 1 over all
words, the unseen symbol and the end. The score takes each symbol from its longest retained context, which is the
longest suffix state of the text so far.

The tree has no bound but the corpus, and is never in one place. Level by level, every chunk sends its distinct
(context, next symbol) pairs with their training counts, and the shorter context's probability in eighths of a bit, to
the bucket of the context's hash. The bucket sums, tests, and answers each chunk with what it needs: counts of its
pairs, totals and kinds of its contexts. A context that occurs once cannot be retained and is not sent; nor are the
longer ones of a context with a single next symbol, whose gain is below one nat. Contexts are told apart by 64 bits of
hash, the next symbols of one context by 32.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_COLUMNS, LOWER, NO_ID, U64, Chunk, by_bucket, carried_columns, dealt_chunk_table, doc_of, fields_of, materialize, mix, n_buckets, narrow, pack, received, release, rolling, sent, unpack, word_hashes, word_spans

START, END = U64(0x5BD1E9955BD1E995), U64(0x2545F4914F6CDD1D)  # in the place of a word's hash
TOTALS = -1  # the bucket of the training totals
ANSWER_SCHEMA = "level int, bucket long, chunk long, payload binary"
SENT_SCHEMA = "bucket long, chunk long, payload binary"


def is_held_out(ids: np.ndarray, none: int, folds: int, fold: int) -> np.ndarray:
    return np.array([i != none and zlib.crc32(str(i).encode()) % folds == fold for i in ids.tolist()], bool)


class _Stream:
    """A chunk's texts as symbols: of each a start, its words and an end."""

    def __init__(self, chunk: Chunk, folds: int, fold: int):
        buf = LOWER[chunk.buf]
        starts, ends = word_spans(buf)
        self.hashes = word_hashes(buf, starts, ends)
        doc = doc_of(chunk, starts)
        n = len(chunk)
        self.words = np.bincount(doc, minlength=n).astype(np.int64)
        self.symbols = np.empty(len(doc) + 2 * n, U64)
        self.begin = np.cumsum(self.words + 2) - (self.words + 2)
        self.at_word = np.arange(len(doc)) + 2 * doc + 1
        self.symbols[self.begin], self.symbols[self.begin + self.words + 1] = START, END
        self.symbols[self.at_word] = self.hashes
        self.doc = np.repeat(np.arange(n), self.words + 2)
        self.place = np.arange(len(self.symbols)) - self.begin[self.doc]
        self.held_out = is_held_out(chunk.ids, NO_ID, folds, fold)
        self.train = ~self.held_out[self.doc]


class _Pairs:
    """The distinct (context, next symbol) pairs at some places: contexts in the order of their hashes."""

    def __init__(self, s: _Stream, depth: int, at: np.ndarray):
        context, symbol = rolling(s.symbols, depth)[at - depth], (mix(s.symbols[at]) >> U64(32)).astype(np.uint32)
        order = np.argsort(context)
        context = context[order]
        group = np.cumsum(np.concatenate([[False], context[1:] != context[:-1]])).astype(U64) if len(at) else context
        order = order[np.argsort((group << U64(32)) | symbol[order])]  # contexts stay where they are
        symbol = symbol[order]
        new_context = np.concatenate([[True], context[1:] != context[:-1]]) if len(at) else np.zeros(0, bool)
        new = new_context | np.concatenate([[True], symbol[1:] != symbol[:-1]]) if len(at) else new_context
        self.at, self.first = at, order[new]  # places, and one of each pair
        self.back = np.empty(len(at), np.int64)
        self.back[order] = np.cumsum(new) - 1
        self.contexts, self.symbols = context[new_context], symbol[new]
        self.context_of = (np.cumsum(new_context) - 1)[new]
        self.counts = np.bincount(self.back[s.train[at]], minlength=len(self.symbols))

    def send(self, chunk: int, shorter: np.ndarray, buckets: int) -> list:
        code = np.clip(np.rint(-8 * np.log2(shorter[self.first])), 0, 255).astype(np.uint8)
        per = np.bincount(self.context_of, minlength=len(self.contexts))
        cuts, ends = by_bucket(self.contexts, buckets), np.concatenate([[0], np.cumsum(per)])
        out = []
        for k in range(buckets):
            a, b = cuts[k], cuts[k + 1]
            if a < b:
                h, part = self.contexts[a:b], slice(ends[a], ends[b])
                out.append((k, chunk, pack(h[:1], narrow(h[1:] - h[:-1]), narrow(per[a:b]), self.symbols[part], code[part], narrow(self.counts[part]))))
        return out


def _rows(found: list, names: tuple[str, ...]) -> pa.Table:
    types = {"level": pa.int32(), "payload": pa.binary()}
    cols = list(zip(*found, strict=True)) if found else [[] for _ in names]
    return pa.table({n: pa.array(c, types.get(n, pa.int64())) for n, c in zip(names, cols, strict=True)})


def _words(batches, buckets: int, folds: int, fold: int):
    """Each chunk's distinct words with their training counts, and its training totals."""
    for batch in batches:
        for chunk in Chunk.each(batch):
            s, rows = _Stream(chunk, folds, fold), []
            if len(s.hashes):
                words, back = np.unique(s.hashes, return_inverse=True)
                found = sent(chunk.number, words, buckets, narrow(np.bincount(back[s.train[s.at_word]], minlength=len(words))))
                rows = list(zip(*(found.column(i).to_pylist() for i in range(3)), strict=True))
            train = ~s.held_out
            rows.append((chunk.number % buckets, TOTALS, pack(np.array([(s.words[train] + 1).sum(), train.sum()], np.int64))))
            yield from _rows(rows, ("bucket", "chunk", "payload")).to_batches()


def _sum_words(table: pa.Table) -> pa.Table:
    """Of one bucket: the words' counts for each chunk, and the totals: tokens, texts, distinct words."""
    bucket, totals, out = table.column("bucket")[0].as_py(), np.zeros(3, np.int64), []
    chunks, words, counts = [], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for chunk, payload in zip(table.column("chunk").to_pylist(), table.column("payload").to_pylist(), strict=True):
        if chunk == TOTALS:
            totals[:2] += unpack(payload)[0]
        else:
            h, c = received(payload)
            chunks.append(chunk), words.append(h), counts.append(c.astype(np.int64))
    found, back = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(back, weights=np.concatenate(counts), minlength=len(found)).astype(np.int64)
    totals[2] = (total > 0).sum()
    every, at = total[back], 0
    for chunk, h in zip(chunks, words[1:], strict=True):
        out.append((0, bucket, chunk, pack(narrow(every[at : at + len(h)]))))
        at += len(h)
    return _rows([*out, (0, bucket, TOTALS, pack(totals))], ("level", "bucket", "chunk", "payload"))


def gains(counts: np.ndarray, code: np.ndarray, context: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Of each context: nats by which it predicts its own next symbols, each left out in turn, better than the shorter
    context does; ``code`` has the latter's probabilities in eighths of a bit."""
    c, n, k, p = counts, total[context], kinds[context], np.exp2(code / -8.0)
    k = k - (c == 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        each = np.where((c > 0) & (n > 1), c * np.log((c - 1 + k * p) / (n - 1 + k) / p), 0.0)
    return np.bincount(context, weights=each, minlength=len(total))


def _level(table: pa.Table, level: int, least_gain: float) -> pa.Table:
    """Of one bucket's contexts of one length: which are retained, and the answers to the chunks."""
    bucket, parts = table.column("bucket")[0].as_py(), []
    for payload in table.column("payload").to_pylist():
        first, steps, per, symbol, code, count = unpack(payload)
        context = np.cumsum(np.concatenate([first, steps.astype(U64)]), dtype=U64)
        parts.append((context, per.astype(np.int64), symbol, code, count.astype(np.int64)))
    contexts, owner = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    context = np.repeat(owner, np.concatenate([p[1] for p in parts]))
    symbol, code, count = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
    order = np.argsort((context.astype(U64) << U64(32)) | symbol)
    new = np.concatenate([[True], (context[order][1:] != context[order][:-1]) | (symbol[order][1:] != symbol[order][:-1])])
    pair = np.empty(len(order), np.int64)
    pair[order] = np.cumsum(new) - 1
    one = order[new]
    total = np.bincount(pair, weights=count).astype(np.int64)
    of = context[one]
    n = np.bincount(of, weights=total, minlength=len(contexts)).astype(np.int64)
    kinds = np.bincount(of[total > 0], minlength=len(contexts))
    kept = (n > 1) & (gains(total, code[one], of, n, kinds) >= least_gain)
    total = np.where(kept[of], total, np.minimum(total, 2))  # else only whether it occurs twice is asked
    n = np.where(kept, n, 0)
    out, a, b = [], 0, 0
    for chunk, (h, per, *_) in zip(table.column("chunk").to_pylist(), parts, strict=True):
        own, pairs = owner[a : a + len(h)], pair[b : b + int(per.sum())]
        out.append((level, bucket, chunk, pack(narrow(n[own]), narrow(kinds[own]), narrow(total[pairs]))))
        a, b = a + len(h), b + len(pairs)
    return _rows(out, ("level", "bucket", "chunk", "payload"))


class _Walk:
    """What a chunk knows after some levels: each symbol's probability and longest retained context, and where a
    longer context may be retained."""

    def __init__(self, s: _Stream, answers: dict[int, list[np.ndarray]], level: int, totals: np.ndarray):
        tokens, texts, distinct = (int(x) for x in totals)
        every = tokens + distinct + (texts > 0) + 1
        words, back = np.unique(s.hashes, return_inverse=True)
        counts = np.concatenate([a[0].astype(np.int64) for a in answers.get(0, [])]) if len(words) else np.zeros(0, np.int64)
        self.counts = np.full(len(s.symbols), texts, np.int64)  # of starts and ends
        self.counts[s.at_word] = counts[back]
        self.p = (self.counts + 1) / every
        self.base = np.log10(self.p)
        self.length = np.zeros(len(s.symbols), np.int64)
        open_ = np.flatnonzero(s.place >= 1)
        self.open = open_[self.counts[open_ - 1] >= 2]
        for d in range(1, level + 1):
            pairs = _Pairs(s, d, self.open)
            got = answers.get(d, [])
            n, kinds, total = (np.concatenate([a[i].astype(np.int64) for a in got]) if got else np.zeros(0, np.int64) for i in range(3))
            context = pairs.context_of[pairs.back] if len(pairs.at) else pairs.back
            n, kinds, total = n[context], kinds[context], total[pairs.back]
            kept = n > 0
            at = pairs.at[kept]
            self.p[at] = (total[kept] + kinds[kept] * self.p[at]) / (n[kept] + kinds[kept])
            self.length[at] = d
            twice, several = np.zeros(len(s.symbols), bool), np.zeros(len(s.symbols), bool)
            twice[pairs.at], several[pairs.at] = total >= 2, kinds >= 2
            longer = np.flatnonzero(s.place > d)
            self.open = longer[twice[longer - 1] & several[longer]]


def _answers(table: pa.Table) -> dict[int, list[np.ndarray]]:
    """Answers by level, in the order of the buckets, which is that of the hashes."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("level", "bucket", "payload")), strict=True), key=lambda r: r[:2])
    out: dict[int, list[np.ndarray]] = {}
    for level, _, payload in rows:
        out.setdefault(level, []).append(unpack(payload))
    return out


def _send(chunks: pa.Table, answers: pa.Table, level: int, totals: np.ndarray, buckets: int, folds: int, fold: int) -> pa.Table:
    out = []
    for chunk in Chunk.each(chunks):
        s = _Stream(chunk, folds, fold)
        walk = _Walk(s, _answers(answers), level - 1, totals)
        if len(walk.open):
            pairs = _Pairs(s, level, walk.open)
            out += pairs.send(chunk.number, walk.p[walk.open], buckets)
    return _rows(out, ("bucket", "chunk", "payload"))


def _score(chunks: pa.Table, answers: pa.Table, depth: int, totals: np.ndarray, folds: int, fold: int) -> pa.Table:
    out = []
    for chunk in Chunk.each(chunks):
        s, n = _Stream(chunk, folds, fold), len(chunk)
        walk = _Walk(s, _answers(answers), depth, totals)
        own = s.place >= 1
        by_text = lambda x: np.bincount(s.doc[own], weights=x[own], minlength=n)  # noqa: E731,B023
        out.append(
            chunk.with_results(
                held_out=pa.array(s.held_out),
                n_tokens=pa.array(s.words + 1),
                n_known=pa.array(by_text(walk.counts > 0).astype(np.int64)),
                train_tokens=pa.array(np.full(n, totals[0], np.int64)),
                base_score=pa.array(by_text(walk.base)),
                score=pa.array(by_text(np.log10(walk.p))),
                n_in_context=pa.array(by_text(walk.length > 0).astype(np.int64)),
                mean_context=pa.array(by_text(walk.length) / (s.words + 1)),
            )
        )
    return pa.concat_tables(out)


RESULTS = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_in_context long, mean_context double"


def score_texts(docs: DataFrame, folds: int = 7, held: int = 2, depth: int = 3, least_gain: float = 2.0, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Learns a probabilistic suffix tree from the rows whose crc32 of the id as text does not leave ``held`` modulo
    ``folds``, and scores every whole text.

    Returns a row for each row of ``docs`` with the columns ``carry`` (unset: all but the text), ``held_out``,
    ``n_tokens`` (words and the end), ``n_known`` (of these: seen in training), ``train_tokens``, ``base_score``
    (the root's log10 score), ``score`` (the tree's log10 probability), ``n_in_context`` (tokens that a retained
    context predicts) and ``mean_context`` (its mean length). ``depth`` is 1 or more, ``least_gain`` 1 or more. A null or
    empty text is an end alone; a null id is in training; repeated rows count as often as they occur; a column named as
    a result is is dropped; an empty table gives an empty one; long texts are scored whole.
    """
    if depth < 1 or least_gain < 1:
        raise ValueError("depth and least_gain must be 1 or more")
    buckets = n_buckets(docs.sparkSession)
    results = [f.split(" ")[0] for f in RESULTS.split(", ")]
    carry = carried_columns(docs, text_col, results) if carry is None else carry
    chunks = dealt_chunk_table(docs, id_col, text_col, carry)
    release()
    answers = [materialize(chunks.mapInArrow(lambda b: _words(b, buckets, folds, held), SENT_SCHEMA).groupBy("bucket").applyInArrow(_sum_words, ANSWER_SCHEMA), "words")]
    release()
    totals = np.zeros(3, np.int64)
    for r in answers[0].filter(F.col("chunk") == TOTALS).select("payload").toLocalIterator():  # one row a bucket
        totals += unpack(bytes(r["payload"]))[0]

    def known() -> DataFrame:
        out = answers[0].filter(F.col("chunk") != TOTALS)
        for more in answers[1:]:
            out = out.unionByName(more)
        return out.groupBy("chunk")

    by_chunk = chunks.select(*CHUNK_COLUMNS).groupBy("chunk")
    def level(d: int) -> DataFrame:
        pairs = by_chunk.cogroup(known()).applyInArrow(lambda c, a: _send(c, a, d, totals, buckets, folds, held), SENT_SCHEMA)
        return materialize(pairs.groupBy("bucket").applyInArrow(lambda t: _level(t, d, least_gain), ANSWER_SCHEMA), f"level{d}")

    for d in range(1, depth + 1):
        answers.append(level(d))
        release()
    return by_chunk.cogroup(known()).applyInArrow(lambda c, a: _score(c, a, depth, totals, folds, held), fields_of(docs, carry, RESULTS))
