"""Operator 8: exact byte-pair encoding by backtracking, and decoding by an offset table.

The encoder never runs the merges. It walks a word from left to right by the longest vocabulary entry that
matches (Aho-Corasick); two neighbouring tokens may stand together only if the merges would not have joined
across their border, which a pair table answers and remembers; if they may not, the last token is replaced by its
next shorter prefix in the vocabulary, or, if there is none, the walk steps back over the token before it. Each
place of a word is given up at most once, so the walk is linear, and the segmentation that it finds is the one
that the merges make.

Words are encoded once per worker while they stay in a bounded cache. Decoding gathers the strings of ids from
one table of bytes by their offsets, without a step per token.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried_columns, fields_of, texts_of

END = "￿"  # ends a word inside the automaton; no vocabulary entry holds it
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
ODD_BLANK = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
CACHE_WORDS = 200_000
BATCH_BYTES = 4 << 20


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself if it is printable, else the next
    letter from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class WordBpe:
    """A vocabulary file of the tokenizers library with word ends: NFC, white space as one space, lower case; words,
    single digits and runs of other signs; byte letters; merges."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.pattern = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{BLANK}\p{{L}}\p{{N}}]+")
        self.blank = regex.compile(f"[{BLANK}]+")
        self.letters = byte_letters()
        strings = dict(sorted(((i, s) for s, i in [*vocab.items(), *special.items()])))
        self.size = max(strings) + 1
        # decoding: a space, then the entry's string; the first space of a text is left out
        parts = [(" " + strings[i]).encode() if i in strings else b"" for i in range(self.size)]
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        # encoding
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.order = [0] * self.size  # 0 for single letters, else the merge's place from 1 on
        for k, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.rank[left, right] = k + 1
            self.halves.setdefault(whole, (left, right))
            self.order[whole] = self.order[whole] or k + 1
        self.fits: dict[tuple[int, int], bool] = {}
        shape = lambda s: s[: -len(self.suffix)] + END if self.suffix and s.endswith(self.suffix) else s
        self.length, self.shorter = [0] * self.size, [-1] * self.size
        self.automaton = ahocorasick.Automaton()
        usable = {shape(s): i for s, i in vocab.items() if i in self.halves or len(shape(s).rstrip(END)) == 1}
        usable = {s: i for s, i in usable.items() if i not in self.halves or self._stands(i)}
        for s, i in usable.items():
            self.length[i] = len(s)
            for n in range(len(s) - 1, 0, -1):
                if (short := usable.get(s[:n])) is not None:
                    self.shorter[i] = short
                    break
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.longest = max(map(len, usable))
        self.usable = usable
        self.words: dict[str, bytes] = {}

    def _stands(self, token: int) -> bool:
        """Whether the merges of the token's own letters end in the token: its halves must stand and fit but for its
        own merge."""
        left, right = self.halves[token]
        return all(t not in self.halves or self._stands_known(t) for t in (left, right)) and self._fit(left, right, self.rank[left, right])

    @functools.cache  # noqa: B019 - one tokenizer lives as long as its worker
    def _stands_known(self, token: int) -> bool:
        return self._stands(token)

    def _fit(self, left: int, right: int, limit: int = 1 << 60) -> bool:
        """Whether no merge of a rank below those that made the two tokens joins letters across their border.

        Undo the merges of both tokens from the latest to the earliest: before each of them stood its two halves,
        and at the border the inner one. A pair of border tokens that has a merge of a rank below the merges still
        to come would have been joined."""
        while True:
            if self.rank.get((left, right), limit) < limit:
                return False
            a, b = self.order[left], self.order[right]
            if a == b == 0:
                return True
            if a > b:
                limit, left = a, self.halves[left][1]
            else:
                # of equal merges the left one comes first, so a merge of this very rank across the border wins
                limit, right = b + 1, self.halves[right][0]

    def _may(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            known = self.fits[left, right] = self._fit(left, right)
        return known

    def _piece(self, letters: str) -> list[int]:
        word = letters + END if self.suffix else letters
        tokens, at = [], 0
        for end, token in self.automaton.iter_long(word):  # the greedy walk; mostly no step back is needed
            if end + 1 - self.length[token] != at or (tokens and not self._may(tokens[-1], token)):
                break
            tokens.append(token)
            at = end + 1
        return tokens if at == len(word) else self._backtrack(word, tokens, at)

    def _match(self, word: str, at: int) -> int:
        rest = word[at : at + self.longest]
        for n in range(self.automaton.longest_prefix(rest), 0, -1):
            if (token := self.usable.get(rest[:n])) is not None:
                return token
        return -1

    def _backtrack(self, word: str, tokens: list[int], at: int) -> list[int]:
        """Goes on from the tokens that cover the word up to ``at`` and fit."""
        dead = set()  # places from which no rest of the word can be covered
        token = self._match(word, at)
        while at < len(word):
            while token >= 0:
                end = at + self.length[token]
                if end not in dead and (not tokens or self._may(tokens[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                tokens.append(token)
                at = end
                token = self._match(word, at)
            else:
                dead.add(at)
                if not tokens:
                    raise ValueError(f"no segmentation of {word!r}")
                token = tokens.pop()
                at -= self.length[token]
                token = self.shorter[token]
        return tokens

    def _word(self, word: str) -> bytes:
        ids: list[int] = []
        for piece in self.pattern.findall(word):
            ids += self._piece("".join([self.letters[b] for b in piece.encode()]))
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        out = self.words[word] = np.array(ids, "<u4").tobytes()
        return out

    def _plain(self, text: str) -> list[bytes]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # lower case goes letter by letter: no final sigma
                text = text.replace("Σ", "σ")
        words = self.blank.split(text.lower()) if ODD_BLANK.search(text) else text.lower().split()
        known = self.words
        out = []
        for w in words:
            ids = known.get(w)
            out.append(self._word(w) if ids is None else ids)
        return out

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not any(s in text for s in self.special):
            return b"".join(self._plain(text))
        out: list[bytes] = []
        for part in self.split_special.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                out += self._plain(part)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The entries' strings joined by one space, in UTF-8."""
        if not len(ids):
            return b""
        first, size = self.offsets[ids], self.offsets[ids.astype(np.int64) + 1] - self.offsets[ids]
        place = np.arange(int(size.sum()), dtype=np.int64)
        place += np.repeat(first - (np.cumsum(size) - size), size)
        return self.bytes[place][1:].tobytes()


@functools.cache
def load(path: str) -> WordBpe:
    return WordBpe(path)


def _run(batches, path: str, carry: list[str]):
    bpe = load(path)
    for batch in batches:
        texts = texts_of(batch.column(0))
        rest = batch.select(range(1, batch.num_columns))
        first, ids, decoded, size = 0, [], [], 0

        def out(first: int, ids: list, decoded: list, rest=rest):
            columns = [*rest.slice(first, len(ids)).columns, pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=[*carry, "n_tokens", "ids", "decoded"])

        for at, t in enumerate(texts):
            i = bpe.encode((t or b"").decode("utf-8", "replace"))
            ids.append(i)
            decoded.append(bpe.decode(np.frombuffer(i, "<u4")))
            size += len(i) + len(decoded[-1])
            if size > BATCH_BYTES:
                yield out(first, ids, decoded)
                first, ids, decoded, size = at + 1, [], [], 0
        if ids:
            yield out(first, ids, decoded)


def encode_and_decode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Encodes every text as the tokenizers library does without special tokens added, and decodes the ids again.

    Returns a row for each row of ``docs`` with the columns ``carry`` (unset: all but the text), ``n_tokens``,
    ``ids`` (little-endian unsigned 32-bit integers) and ``decoded``. A null or empty text has no ids and decodes
    to an empty text; strings of special tokens within a text are these tokens; repeated rows, null ids and other
    columns pass as they are; a column named as a result is is dropped; an empty table gives an empty one; a very
    long text is encoded whole. No shuffle: one pass over the rows, in bounded output batches.
    """
    results = ["n_tokens", "ids", "decoded"]
    carry = carried_columns(docs, text_col, results) if carry is None else carry
    slim = docs.select(F.col(text_col).cast("string").alias("__text"), *[F.col(f"`{c}`") for c in carry])
    schema = fields_of(docs, carry, "n_tokens long, ids binary, decoded binary")
    out = slim.mapInArrow(lambda batches: _run(batches, tokenizer_path, carry), schema)
    return out.withColumn("decoded", F.col("decoded").cast("string"))
