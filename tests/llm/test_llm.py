"""The operators of the subpackage against brute force, exact round trips and held-out accuracy."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.llm import bpe, common, embedding_dedup, licenses, media, mixing, near_dedup, substring_dedup, suffix_dedup, suffix_tree_lm, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["".join(random.Random(i).choice("abcdefgh") for _ in range(2 + i % 5)) for i in range(80)]


def make_docs(seed=1, n=60):
    """Texts with copies, near copies, shared passages, repeats within a text, a long one, blank and null ones."""
    rng = random.Random(seed)
    say = lambda k: " ".join(rng.choice(WORDS) for _ in range(k))
    passage, long = say(50), say(30_000)
    texts = []
    for i in range(n):
        t = say(rng.randint(1, 120))
        if i % 5 == 0:
            t = t + " " + passage + "\n" + say(20)
        if i % 11 == 0 and texts:
            t = texts[rng.randrange(len(texts))]
        if i % 7 == 0 and texts:
            w = texts[-1].split()
            if w:
                w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        texts.append(t)
    texts[3] = texts[4] + " " + texts[4]
    texts += [long, long[:40_000], "", "   \n", None, "é" * 150, "é" * 150, "word"]
    return [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_docs(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def texts():
    return {r[0]: r[1] or "" for r in make_docs()}


def covered(n, starts, size):
    out = [False] * n
    for s in starts:
        out[s : s + size] = [True] * size
    return out


# ----------------------------------------------------------------------------------------- 10: passages


def passages(texts, size=35):
    words = {i: t.encode().split() for i, t in texts}
    count = Counter(tuple(w[k : k + size]) for w in words.values() for k in range(len(w) - size + 1))
    out = {}
    for i, w in words.items():
        gone = covered(len(w), [k for k in range(len(w) - size + 1) if count[tuple(w[k : k + size])] > 1], size)
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def test_repeated_passages(docs, texts):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup.remove_repeated_passages(docs).collect()}
    assert got == passages(texts.items())


def test_passages_keep_layout_and_clashing_columns(spark):
    p = " ".join(WORDS[:40])
    df = spark.createDataFrame([(1, f"a\n\nb  {p}\nend", 5), (2, f"{p} x", 6), (3, "one\ttwo", 7)], "doc_id long, text string, n_words int")
    out = substring_dedup.remove_repeated_passages(df, layout=True)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept", "spans"]
    assert {r["doc_id"]: r["kept"] for r in out.collect()} == {1: "a\n\nb  end", 2: "x", 3: "one\ttwo"}


# ----------------------------------------------------------------------------------------- 4: bytes


@pytest.mark.parametrize("shard", [suffix_dedup.SHARD_BYTES, 3000])
def test_repeated_bytes(docs, texts, shard):
    seen, want = set(), {}
    for i in sorted(texts):
        b = texts[i].encode()
        again = []
        for k in range(len(b) - 99):
            (again.append(k) if b[k : k + 100] in seen else seen.add(b[k : k + 100]))
        gone = covered(len(b), again, 100)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want[i] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in suffix_dedup.remove_repeated_bytes(docs, shard_bytes=shard).collect()}
    assert got == want


def test_repeats_longer_than_a_byte_can_count(spark):
    rng = random.Random(21)
    say = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    shared = say(700)
    rows = spark.createDataFrame([(1, say(50) + shared), (2, say(90) + shared)], "doc_id long, text string")
    for length in (100, 300, 400):
        assert {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeated_bytes(rows, length=length).collect()} == {1: 0, 2: 700}


def test_suffix_array_and_common_prefixes():
    rng = random.Random(2)
    text = np.array([rng.choice(b"ab") for _ in range(600)] + [97] * 300, np.uint8)
    sa, _ = suffix_dedup.suffix_array(text, 128)
    s = text.tobytes()
    keys = [s[i : i + 128] for i in sa]
    assert keys == sorted(keys) and sorted(sa) == list(range(len(s)))
    which = np.arange(1, len(sa))
    got = suffix_dedup.common_prefixes(text, sa, which, 100)
    for k, n in zip(which, got):
        a, b = s[sa[k - 1] :], s[sa[k] :]
        full = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert n == min(full, 100)


def test_window_classes_of_edited_copies():
    """Near copies with a one-letter edit and tails that part after 100 to 160 bytes, against a dictionary."""
    for seed in range(300):
        rng = random.Random(seed)
        say = lambda k: bytes(rng.choice(b"abcd") for _ in range(k))
        passage, text, valid = say(220), b"", []
        for _ in range(rng.randint(3, 6)):
            seg = bytearray(passage)
            if rng.random() < 0.5:
                seg[rng.randrange(120)] = rng.choice(b"Az")
            seg = bytes(seg[: rng.randint(100, 160)]) + say(rng.randint(0, 30))
            text += seg
            valid += [True] * (len(seg) - 99) + [False] * 99
        at, cls = suffix_dedup.window_classes(np.frombuffer(text, np.uint8), np.array(valid), 100)
        by_class, by_window = {}, {}
        for a, c in zip(at.tolist(), cls.tolist()):
            by_class.setdefault(c, set()).add(a)
            by_window.setdefault(text[a : a + 100], set()).add(a)
        assert sorted(map(sorted, by_class.values())) == sorted(map(sorted, by_window.values())), seed


# ----------------------------------------------------------------------------------------- 1: language model


class SuffixTree:
    """Brute force: all contexts of training in dictionaries."""

    def __init__(self, texts, depth, gain):
        self.depth, self.next = depth, {}
        self.tokens = Counter(w for t in texts for w in t)
        for t in texts:
            t = ["<start>", *t]
            for i in range(1, len(t)):
                for d in range(1, min(depth, i) + 1):
                    self.next.setdefault(tuple(t[i - d : i]), Counter())[t[i]] += 1
        self.all, self.kept = sum(self.tokens.values()), {}
        for d in range(1, depth + 1):
            self.kept |= {c: 1 for c in [c for c in self.next if len(c) == d and self.gain(c) >= gain]}

    def gain(self, c):
        n, k, out = sum(self.next[c].values()), len(self.next[c]), 0.0
        for x, m in self.next[c].items():
            p = 2 ** (-min(255, max(0, round(-8 * math.log2(self.prob(c[1:], x))))) / 8)
            left = k - (m == 1)
            out += m * math.log((m - 1 + left * p) / (n - 1 + left) / p) if n > 1 else 0
        return out

    def prob(self, c, x):
        while c and c not in self.kept:
            c = c[1:]
        if not c:
            return (self.tokens[x] + 1) / (self.all + len(self.tokens) + 1)
        n, k = sum(self.next[c].values()), len(self.next[c])
        return (self.next[c][x] + k * self.prob(c[1:], x)) / (n + k)

    def score(self, t):
        t = ["<start>", *t]
        return sum(math.log10(self.prob(tuple(t[max(0, i - self.depth) : i]), t[i])) for i in range(1, len(t)))


@pytest.mark.parametrize("depth", [1, 3])
def test_language_model(spark, docs, texts, depth):
    out = {r["doc_id"]: r for r in suffix_tree_lm.score_texts(docs, depth=depth).collect()}
    tokens = {i: [*t.encode().lower().split(), None] for i, t in texts.items()}
    train = {i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2}
    c = Counter(w for i in train for w in tokens[i])
    n, v = sum(c.values()), len(c)
    tree = SuffixTree([tokens[i] for i in train], depth, 2.0)
    assert {len(c) for c in tree.kept} == set(range(1, depth + 1))
    for i, w in tokens.items():
        r = out[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i not in train, len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert math.isclose(r["score"], tree.score(w), rel_tol=1e-9)
    for context in list(tree.kept)[:200]:
        assert math.isclose(sum(tree.prob(context, x) for x in [*c, "unseen"]), 1)


def test_language_model_learns_contexts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        k, w = rng.randrange(20), []
        for _ in range(60):
            k = (3 * k + 1) % 20 if rng.random() < 0.9 else rng.randrange(20)
            w.append(WORDS[k + 20])
        rows.append((i, " ".join(w)))
    out = suffix_tree_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    assert len(out) > 20 and sum(r["score"] for r in out) > 0.6 * sum(r["base_score"] for r in out)


def test_language_model_of_independent_words_keeps_to_the_root(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(60))) for i in range(300)]
    out = suffix_tree_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    assert sum(r["score"] for r in out) > 1.02 * sum(r["base_score"] for r in out)


# ----------------------------------------------------------------------------------------- 7: near duplicates


def components(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(texts, size, percent=80):
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, components(links, sets)


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, texts, size):
    sets, roots = near(texts, size)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs, words=size).collect()}
    assert got == {i: (len(sets[i]), roots[i], roots[i] == i) for i in texts}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_of_long_lists(spark, docs, texts, size):
    """Every list is a long one here: heads and blocks settle all."""
    rng = random.Random(12)
    base = [rng.choice(WORDS) for _ in range(60)]
    more = dict(texts)
    for i in range(1000, 1080):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(60)] = rng.choice(WORDS) + "x"
        more[i] = " ".join(w)
    rows = spark.createDataFrame(list(more.items()), "doc_id long, text string").repartition(3)
    sets, roots = near(more, size)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(rows, words=size, short=2).collect()}
    assert got == {i: (len(sets[i]), roots[i], roots[i] == i) for i in more}


def test_near_duplicates_ship_few_blocks_whole(spark, monkeypatch):
    """Families that have half of their text in common: their blocks meet in long lists, but few go out with texts."""
    rng = random.Random(5)
    common, rows = [rng.choice(WORDS) + str(k) for k in range(30)], {}
    for family in range(12):
        base = common + [f"{rng.choice(WORDS)}{family}x{k}" for k in range(30)]
        for i in range(30):
            w = list(base)
            for _ in range(rng.randint(1, 9)):
                w[rng.randrange(60)] = f"{rng.choice(WORDS)}y{i}"
            rows[family * 100 + i] = " ".join(w)
    written, real = {}, near_dedup.materialize
    monkeypatch.setattr(near_dedup, "materialize", lambda df, name: written.setdefault(name, []).append(out := real(df, name)) or out)
    monkeypatch.setattr(near_dedup, "release", lambda *tables: None)
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df, words=2, short=8).collect()}
    _, roots = near(rows, 2)
    assert got == {i: (roots[i], roots[i] == i) for i in rows}
    assert written["meet"][0].count() > 100 and written["close"][0].count() < written["meet"][0].count() / 2


def test_outlines_never_lose_a_pair():
    rng = np.random.default_rng(3)
    sigs = rng.integers(0, 1 << 32, (40, 64), dtype=np.uint32)
    sigs[20:] = np.where(rng.random((20, 64)) < 0.6, sigs[:20], sigs[20:])
    block = lambda own, sig: type("Block", (), {"component": np.arange(len(own)) + own[0], "size": np.array(own) * 0 + 50, "sig": sig})
    x, y = block(range(20), sigs[:20]), block(range(20, 40), sigs[20:])
    x8, y8 = block(range(20), sigs[:20].astype(np.uint8)), block(range(20, 40), sigs[20:].astype(np.uint8))
    whole, brief = near_dedup._near(x, y, 38, 80), near_dedup._near(x8, y8, 38, 80)
    assert 3 < whole.sum() < 20 and not (whole & ~brief).any() and brief.sum() < 25


# ----------------------------------------------------------------------------------------- 6: vectors


def test_near_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((30, 16))
    rows = [(i, (base[i % 30] + (0.18 if i % 4 else 0) * rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(240)]
    rows += [(240, None), (241, [0.0] * 16), (242, [float("nan")] * 16), (243, [1.0, 2.0]), (244, rows[0][1]), (245, [2 * x for x in rows[0][1]]), (246, [None] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int" if False else "vec_id long, embedding array<float>")
    v = {i: np.array(x, float) for i, x in rows if x is not None and None not in x and np.isfinite(x).all() and np.any(x)}
    links = [(a, b) for a in v for b in v if a < b and len(v[a]) == len(v[b]) and v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b]) >= 0.95]
    n, roots = Counter(x for link in links for x in link), components(links, [i for i, _ in rows])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_vectors(df).collect()}
    assert got == {i: (n[i], roots[i], roots[i] == i) for i, _ in rows}


def test_near_vectors_in_blocks_and_bands():
    """Every pair at the threshold is found, once, whatever blocks and bands it meets in."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((60, 48))
    v = np.concatenate([base + 0.17 * rng.standard_normal((60, 48)) for _ in range(6)])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    bits, bands, most = 6, 14, embedding_dedup.most_bits(0.95, 5.0)
    table = __import__("pyarrow").Table.from_batches(list(embedding_dedup._encode([__import__("pyarrow").RecordBatch.from_pydict({"key": np.arange(len(v)), "vector": [x.tobytes() for x in v], "copies": np.ones(len(v), np.int64)})], bits, bands)))
    pa, rows = __import__("pyarrow"), table.to_pylist()
    links = np.zeros(len(v))
    for place in sorted({p for r in rows for p in r["places"]}):
        own = [r | {"place": place, "sub": r["key"] % 2} for r in rows if place in r["places"]]
        for i, j in ((0, 0), (0, 1), (1, 1)):
            some = [r | {"i": i, "j": j} for r in own if r["sub"] in (i, j)]
            if some:
                left = set(embedding_dedup._screen(pa.Table.from_pylist(some), bits, most).column("key").to_pylist())
                for x in embedding_dedup._block(pa.Table.from_pylist([r for r in some if r["key"] in left]), bits, bands, most, 0.95, 5.0).to_pylist() if left else []:
                    links[x["key"]] += x["links"]
    want = ((u @ u.T >= 0.95).sum(axis=1) - 1).astype(float)
    assert want.sum() > 100 and (links <= want).all() and links.sum() >= 0.99 * want.sum()


# ----------------------------------------------------------------------------------------- 8: tokens


def test_bpe_matches_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    P = pytest.importorskip("public_tokenizers")
    ours, theirs = bpe.WordBpe(P.path("word_bpe_49k.json")), tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rng = random.Random(6)
    entries = [s.replace("</w>", "") for s in theirs.get_vocab()]
    signs = "abcdefghij klmnop QRSTU'sdtrevm.,!?0123456789éÉßüñ漢字  \x1c\x85ΣΑ😀İ<|endoftext|>\t\n"
    tries = ["", "<|endoftext|>", "a<|startoftext|>b <|endoftext|", "a" * 900, "''''ss'ss's", "ṩ ẛ̣", "ΑΣ ΣΑΣ"]
    tries += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(1500)] + ["".join(rng.choice(entries) for _ in range(3)) for _ in range(4000)]
    for t in tries:
        ids = np.frombuffer(ours.encode(t), "<u4")
        assert ids.tolist() == theirs.encode(t, add_special_tokens=False).ids, ascii(t)
        assert ours.decode(ids).decode() == theirs.decode(ids.tolist(), skip_special_tokens=False)


def test_bpe_query_rows(spark):
    """Null, empty and long texts, repeated rows, null ids and clashing columns, against the library."""
    tokenizers = pytest.importorskip("tokenizers")
    P = pytest.importorskip("public_tokenizers")
    theirs = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = [None, "", "  ", "Hello <|endoftext|> World's 42nd", "word " * 200_000, "é漢字 ", "é漢字 "]
    df = spark.createDataFrame([(None if i == 5 else min(i, 6), t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids int, keep string")
    out = bpe.encode_and_decode(df, P.path("word_bpe_49k.json"))
    assert out.columns == ["doc_id", "keep", "n_tokens", "ids", "decoded"]
    want = [theirs.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = sorted((np.frombuffer(bytes(r["ids"]), "<u4").tolist(), r["n_tokens"], r["decoded"]) for r in out.collect())
    assert got == sorted((x, len(x), theirs.decode(x, skip_special_tokens=False)) for x in want)


def test_clashing_columns_and_long_texts(spark):
    """Columns named as results are, and a text over a chunk's size beside short ones."""
    rng = random.Random(3)
    long = " ".join(rng.choice(WORDS) + str(i) for i in range(500_000))
    assert len(long) > common.CHUNK_BYTES
    rows = [(1, long, 7, 7.0, 7), (2, "short text", 7, 7.0, 7), (3, long, 7, 7.0, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int, score double, component_id int")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in suffix_dedup.remove_repeated_bytes(df).collect()}
    assert got == {1: (len(long), 0), 2: (10, 0), 3: (len(long), len(long))}
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 1}
    scores = {r["doc_id"]: r["score"] for r in suffix_tree_lm.score_texts(df).collect()}
    assert all(s < 0 for s in scores.values())
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeated_passages(df).collect()} == {1: 500_000, 2: 0, 3: 500_000}


def test_toxicity_of_an_empty_table(spark):
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), -1.0)
    none = spark.createDataFrame([], "doc_id long, text string, score int")
    out = toxicity.score_toxicity(none, model)
    assert out.columns == ["doc_id", "score", "predicted"] and out.count() == 0


# ----------------------------------------------------------------------------------------- 2: the mix


def test_mix(spark, docs, texts):
    out = {r["doc_id"]: r for r in mixing.fair_mix(docs, carry=["doc_id", "source"]).collect()}
    size = {i: len(t.split()) for i, t in texts.items()}
    assert {i: r["size"] for i, r in out.items()} == size
    by = {}
    for r in out.values():
        by.setdefault(r["source"], []).append(r)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    order = sorted((s for s in by if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(size.values()), set(order)
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * by[s][0]["source_size"]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * by[s][0]["source_size"]
            left -= target[s]
        open_ -= over
    longest = {s: max(r["size"] for r in rs) for s, rs in by.items()}
    for s, rs in by.items():
        assert math.isclose(rs[0]["target"], target[s]) and abs(sum(r["taken"] for r in rs) - target[s]) <= longest[s]
    again = {r["doc_id"]: r["taken"] for r in mixing.fair_mix(docs.repartition(5)).collect()}
    assert again == {i: r["taken"] for i, r in out.items()}


# ----------------------------------------------------------------------------------------- 5: media


def test_media_round_trip(spark, docs, texts):
    rows, folder = media.store_media(docs)
    for r in media.read_features(media.read_metadata(rows, folder), folder).collect():
        b = texts[r["doc_id"]].encode()
        p = b + b"\0" * (-len(b) % 64 or (0 if b else 64))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert (r["width"], r["height"], r["bit_depth"]) == (64, len(p) // 64, 8)
    with pytest.raises(ValueError):
        media.from_png(media.to_png(b"x" * 64)[:-20] + b"0" * 20)


# ----------------------------------------------------------------------------------------- 3: licences


def test_patience_alignment():
    a, b = "x y the cat sat on the mat z".split(), "the cat lay on the mat".split()
    pairs = licenses.align([hash(w) for w in a], [hash(w) for w in b])
    assert [(a[i], b[j]) for i, j in pairs] == [(w, w) for w in "the cat on the mat".split()]
    assert licenses.longest_increasing([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])


def test_license_scan(spark):
    mit = licenses.TEMPLATES["MIT"][1]
    cut = mit.replace("free of charge, to any person", "free of charge to each and every person")
    df = spark.createDataFrame([(1, f"head {cut} tail " + "word " * 5000), (2, "nothing here"), (3, None), (4, "Released under the MIT License. x " * 3), (5, "license MIT the under released")], "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], round(r["coverage"], 2), len(r["matches"])) for r in licenses.scan_licenses(df).collect()}
    assert got[1][0] == "MIT" and 0.9 < got[1][1] < 1 and got[2] == (None, 0.0, 0) and got[3] == (None, 0.0, 0) and got[4] == ("MIT", 1.0, 3) and got[5] == (None, 0.0, 0)


@pytest.mark.parametrize("between", [0, 1, 3])
def test_licenses_back_to_back(between):
    known = licenses.Templates(licenses.TEMPLATES)
    read = lambda t: toxicity.text_words([t.encode()])[1]
    rng = random.Random(7)
    say = lambda k: "".join(f" {rng.choice(WORDS)}q" for _ in range(k))
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            n = len(read(text))
            for copies in (2, 3, 4):
                got = known.scan(read(say(50) + "".join(f" {text}{say(between)}" for _ in range(copies)) + say(50)), 0.8)
                starts = [50 + i * (n + between) for i in range(copies)]
                assert [m[1:] for m in got if known.names[m[0]] == name and m[3] - m[2] == n] == [(1.0, s, s + n) for s in starts], (name, n, copies)


def test_edited_licenses_back_to_back():
    known = licenses.Templates(licenses.TEMPLATES)
    mit = licenses.TEMPLATES["MIT"][1]
    cut = mit.replace("free of charge, to any person", "free of charge to each and every person")
    got = known.scan(toxicity.text_words([f"head {cut} {mit} {cut} tail".encode()])[1], 0.8)
    assert [(known.names[m[0]], m[1] == 1) for m in got] == [("MIT", False), ("MIT", True), ("MIT", False)]
    assert all(x[3] <= y[2] for x, y in zip(got, got[1:], strict=False))


# ----------------------------------------------------------------------------------------- 9: toxicity


def test_toxicity(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1500):
        w = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(60)]
        bad = i % 10 == 0
        if bad:
            for k in rng.sample(range(60), 4):
                w[k] = rng.choice(["idiot", "moron", "scum"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, model).withColumn("held", toxicity.held_out("doc_id", 5, 0)).collect()}
    held = [i for i in out if out[i]["held"]]
    assert held == [i for i in out if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(out[i]["predicted"] == labels[i][1] for i in held) / len(held) > 0.97
    empty = toxicity.score_toxicity(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), model).collect()
    assert len(empty) == 2 and empty[0]["score"] == empty[1]["score"] < 0.5


def test_without_labels(spark, docs):
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, model).collect()} == {0}


# ----------------------------------------------------------------------------------------- edges


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert substring_dedup.remove_repeated_passages(none).count() == 0
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert mixing.fair_mix(none).count() == 0
    assert suffix_tree_lm.score_texts(none).count() == 0
    assert licenses.scan_licenses(none).count() == 0
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    rows, folder = media.store_media(none)
    assert media.read_features(rows, folder).count() == 0


def test_null_ids_and_repeated_rows(spark):
    p = " ".join(WORDS[:40])
    rows = [(None, p), (None, p), (5, p), (5, p), (6, "alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in substring_dedup.remove_repeated_passages(df).collect()) == [(-1, 40), (-1, 40), (5, 40), (5, 40), (6, 0)]
    gone = sorted((r["doc_id"] or 99, r["n_removed"] > 0) for r in suffix_dedup.remove_repeated_bytes(df).collect())
    assert gone == [(5, False), (5, True), (6, False), (99, True), (99, True)]
    assert sorted((r["doc_id"] or -1, r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df, words=2).collect()) == [(-1, 5, False), (-1, 5, False), (5, 5, True), (5, 5, True), (6, 6, True)]
    assert sum(r["taken"] for r in mixing.fair_mix(df.withColumn("source", F.lit(None).cast("string"))).collect()) > 0
    assert len(suffix_tree_lm.score_texts(df).collect()) == 5


def test_packed_arrays():
    for a in (np.zeros(0, np.uint64), np.array([1, 2**63], np.uint64), np.array([-5, 7], np.int64), np.array([255], np.uint8)):
        assert np.array_equal(common.unpack(common.pack(a, a))[1], a)


# ----------------------------------------------------------------------------------------- the pipeline


def test_pipeline(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as P

    rows = make_docs(9, 80)
    rng = random.Random(1)
    rows = [(i, (t or "") + (" idiot moron scum" if rng.random() < 0.2 else ""), a, b, c) for i, t, a, b, c in rows]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 0, int("idiot" in r[1])) for r in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, str(tmp_path)), name)
        kept[name] = [r.asDict() for r in docs.collect()]
    text = lambda n: {r["doc_id"]: r["text"] for r in kept[n]}
    assert {r[0] for r in rows} - set(text("toxicity")) == {r[0] for r in rows if "idiot" in r[1]}
    _, roots = near(text("toxicity"), 5)
    assert set(text("minhash_near_dedup")) == {i for i, root in roots.items() if i == root}
    want = passages(text("minhash_near_dedup").items())
    assert {i: " ".join(t.encode().decode().split()) for i, t in text("substring_dedup").items()} == {i: " ".join(x[2].split()) for i, x in want.items()}
    mixed = Counter(r["doc_id"] for r in kept["mixing"])
    sized = {r["doc_id"]: r["copies"] for r in mixing.fair_mix(spark.createDataFrame(kept["substring_dedup"], DOCS)).collect()}
    assert mixed == Counter({i: n for i, n in sized.items() if n})
    assert len(kept["bpe"]) == len(kept["mixing"]) and all(len(r["ids"]) == 4 * r["n_tokens"] for r in kept["bpe"])


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as P

    p, q = " ".join(WORDS[:60]), " ".join(WORDS[20:80])
    edited = q.split()
    edited[59] = "changed"
    rows = [(5, p), (5, p), (5, p), (8, p), (None, p), (None, q), (None, q), (None, " ".join(edited)), (6, "alone"), (7, ""), (7, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).repartition(3)
    kept = P.materialize(P.drop_near_duplicates(spark, docs, ""), "kept")
    got = sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect())
    assert len(got) == 6 and got[0] == (-1, "") and got[1][0] == -1 and got[1][1] in (q, " ".join(edited))
    assert got[2:] == [(5, p), (6, "alone"), (7, ""), (7, "")]
    cut = {r["doc_id"]: r["text"] for r in P.cut_repeated_passages(spark, kept.filter("doc_id = 5 or doc_id = 6"), "").collect()}
    assert cut == {5: p, 6: "alone"}


def test_pipeline_keeps_clashing_columns(spark):
    import corpus_pipeline as P

    extra = ["kept", "size", "n_words", "copies", "score", "predicted", "component_id", "spans", "target", "cls", "key"]
    rows = [(i, f"{' '.join(WORDS[i : i + 50])} {i}", "en", "s", 9, *range(len(extra))) for i in range(8)] + [(8, None, "en", None, 0, *range(len(extra)))]
    docs = spark.createDataFrame(rows, DOCS + "".join(f", {c} long" for c in extra))
    labels = spark.createDataFrame([(i, 0) for i in range(9)], "doc_id long, toxic int")
    labels.write.mode("overwrite").parquet(f"{common.scratch_root(spark)}/clash/labels.parquet")
    for name, stage in P.STAGES[:4]:
        docs = P.materialize(stage(spark, docs, f"{common.scratch_root(spark)}/clash"), name)
        got = [r.asDict() for r in docs.collect()]
        assert docs.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), *extra], name
        assert got and all(r[c] == k for r in got for k, c in enumerate(extra)), name
