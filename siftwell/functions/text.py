"""Text functions as Column expressions. White space is the ASCII class in every pattern."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[ \t\n\r\x0B\f]+"
SHINGLE_K = 5
#: The phrases that mark shallow reasoning.
META_PATTERNS = (
    r"the\s+user\s+is\s+asking",
    r"i\s+need\s+to",
    r"let\s+me",
    r"i\s+should",
    r"i\s+will\s+now",
    r"first\s+i\s+will",
    r"this\s+is\s+a\s+simple",
    r"this\s+is\s+straightforward",
)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{SPACE}|{SPACE}$", "")


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(strip(c), SPACE, " ")


def words(c: Column) -> Column:
    """Words between white space; none in a blank text."""
    return F.filter(F.split(c, SPACE), lambda w: w != "")


def _nfc(s: pd.Series) -> pd.Series:
    import unicodedata

    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def normalize_for_hash(c: Column) -> Column:
    """White space collapsed and the text composed (NFC): the form whose digest tells records apart."""
    return F.pandas_udf(_nfc, "string")(collapse_space(c))


def longest_run(items: Column) -> Column:
    """How often the most frequent item of an array occurs, without exploding it."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, x: Column) -> Column:
        run = F.when(acc["last"] == x, acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(F.array_sort(items), start, step, lambda acc: acc["best"])


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, where a lambda in it would compute it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def runs_of(text: Column, n: int) -> Column:
    """Every run of n words as one string."""
    none = F.array().cast("array<string>")
    return let(words(text), lambda w: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(none))


def char_shingles(c: Column, k: int = SHINGLE_K) -> Column:
    """Distinct k-character shingles of the lower-cased text with underscores for white space; a shorter text is
    one shingle, a blank one has none."""
    text = F.replace(collapse_space(F.lower(c)), F.lit(" "), F.lit("_"))
    letters = F.filter(F.split(text, ""), lambda x: x != "")
    many = let(letters, lambda ls: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(ls) - (k - 1), F.lit(1))), lambda i: F.array_join(F.slice(ls, i, k), ""))))
    return F.when(text == "", F.array().cast("array<string>")).when(F.char_length(text) < k, F.array(text)).otherwise(many)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def shingle_text(c: Column) -> Column:
    """The text whose shingles ``char_shingles`` takes."""
    return F.replace(collapse_space(F.lower(c)), F.lit(" "), F.lit("_"))


def _shingle_keys(points: list[np.ndarray], k: int) -> list[np.ndarray]:
    """A sorted distinct integer for each k-character shingle of some texts, the same for the same shingle."""
    flat, width = np.concatenate(points).astype(np.int64), 63 // k
    if len(flat) and flat.max() >> width:
        flat = np.unique(flat, return_inverse=True)[1]
    if len(flat) and int(flat.max()) >> width:  # so many characters that ranks of shorter shingles stand for them
        key, most = flat, int(flat.max()) + 1
        for i in range(1, k):
            key = np.unique(key[: len(key) - 1] * most + flat[i:], return_inverse=True)[1]
    else:
        key = np.zeros(max(0, len(flat) - k + 1), np.int64)
        for i in range(k):
            key = (key << width) | flat[i : i + len(key)]
    ends = np.cumsum([len(p) for p in points])
    found = [np.sort(key[end - len(p) : max(end - k + 1, end - len(p))]) for p, end in zip(points, ends, strict=True)]
    return [x[np.append(True, x[1:] != x[:-1])] if len(x) else x for x in found]


def jaccard_of_texts(df: DataFrame, id_col: str, a: str, b: str, k: int = SHINGLE_K) -> DataFrame:
    """The id, the number of shingles of the first text, and the similarity of the shingles of both; a null text
    has none, and where it is the first, no number, and no similarity with a text that has some."""

    points = lambda t: np.frombuffer(t.encode("utf-32-le"), "<u4")

    def size(x: str | None) -> int | None:
        return x if x is None else min(len(x), 1) if len(x) < k else len(_shingle_keys([points(x)], k)[0])

    def both_of(x: str | None, y: str | None) -> tuple[int | None, float | None]:
        if x is None or y is None:
            return size(x), None if x is None and y else 0.0
        if min(len(x), len(y)) < k:  # a short text is one shingle, and none of a longer text's
            return size(x), float(x == y != "")
        g, h = _shingle_keys([points(x), points(y)], k)
        merged = np.sort(np.concatenate([g, h]))
        both = int((merged[1:] == merged[:-1]).sum())
        return len(g), both / (len(g) + len(h) - both)

    def compare(frames):
        for pdf in frames:
            n, similarity = zip(*map(both_of, pdf["a"], pdf["b"]), strict=True) if len(pdf) else ((), ())
            yield pd.DataFrame({"id": pdf["id"], "n": pd.array(n, "Int64"), "similarity": pd.array(similarity, "Float64")})

    rows = df.select(F.col(id_col).alias("id"), shingle_text(F.col(a)).alias("a"), shingle_text(F.col(b)).alias("b"))
    return rows.mapInPandas(compare, "id long, n long, similarity double").withColumnRenamed("id", id_col)


def quality_score(c: Column) -> Column:
    """0 to 1 from the variety of a text's words; repeated sentences and ellipses lower it."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit("[a-z]{2,}"), 0)
    n = F.size(tokens)
    sentences = F.filter(F.transform(F.split(c, rf"[.!?]{SPACE}"), strip), lambda s: s != "")
    ellipses = F.regexp_count(c, F.lit(r"\.\.\."))
    score = 0.6 * (F.size(F.array_distinct(tokens)) / n) + 0.4 * (1.0 - longest_run(tokens) / n)
    score = score * F.when(longest_run(sentences) >= 3, 0.35).otherwise(1.0)
    score = score * F.when(ellipses > 2, 0.60).otherwise(1.0)
    return F.when(F.coalesce(n, F.lit(0)) <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))


def battery(c: Column) -> dict[str, Column]:
    """Scores of the quality battery, in the manner of published web-text heuristics."""
    chars = F.greatest(F.char_length(c), F.lit(1))
    n_words = F.size(words(c))
    lines = F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")
    n_lines = F.greatest(F.size(lines), F.lit(1))
    grams = runs_of(F.lower(c), 3)
    return {
        "n_words": n_words.cast("long"),
        "symbol_ratio": F.regexp_count(c, F.lit(r"#|\.\.\.")) / F.greatest(n_words, F.lit(1)),
        "non_alnum_ratio": F.regexp_count(c, F.lit(r"[^\p{L}\p{N} \t\n\r\x0B\f]")) / chars,
        "url_ratio": F.aggregate(F.regexp_extract_all(c, F.lit(r"https?://[^ \t\n\r\x0B\f]+"), 0), F.lit(0), lambda a, u: a + F.char_length(u)) / chars,
        "no_endmark_ratio": F.size(F.filter(lines, lambda x: ~x.rlike("[.!?\"']$"))) / n_lines,
        "boilerplate_ratio": F.size(F.filter(lines, lambda x: F.lower(x).rlike("privacy policy|terms of use|cookie policy|all rights reserved"))) / n_lines,
        "repeated_line_ratio": 1.0 - F.size(F.array_distinct(lines)) / n_lines,
        "top_gram_ratio": let(grams, lambda g: F.when(F.size(g) > 0, longest_run(g) / F.size(g)).otherwise(F.lit(0.0))),
    }


#: Fixed thresholds of the battery: least words, then the most that each score may be.
BATTERY_LIMITS = {"n_words": 20, "symbol_ratio": 0.50, "non_alnum_ratio": 0.65, "url_ratio": 0.30, "no_endmark_ratio": 0.99, "boilerplate_ratio": 0.85, "repeated_line_ratio": 0.90, "top_gram_ratio": 0.35}


def battery_passes(scores: dict[str, Column]) -> Column:
    ok = scores["n_words"] >= BATTERY_LIMITS["n_words"]
    for name, limit in BATTERY_LIMITS.items():
        if name != "n_words":
            ok = ok & (scores[name] <= limit)
    return ok


def meta_speech(c: Column) -> Column:
    """Whether more than a fifth of the lines, blank ones counted in the total, hold a phrase of shallow reasoning."""
    lines = F.split(c, "\n")
    return F.size(F.filter(lines, lambda x: F.lower(x).rlike("|".join(META_PATTERNS)))) / F.size(lines) > 0.20


# ------------------------------------------------------------------------------------------ logic density

#: Words that count as code.
CODE_WORDS = (
    "async", "await", "def", "class", "import", "from", "return", "if", "else", "elif", "for", "while", "try", "except", "finally", "with", "lambda", "yield", "raise", "assert", "pass", "break", "continue",
    "True", "False", "None", "self", "super", "__init__", "function", "const", "let", "var", "new", "this", "export", "HomeAssistant", "DataUpdateCoordinator", "Entity", "ConfigEntry", "async_setup_entry",
    "async_added_to_hass", "hass", "entry", "coordinator", "device_info", "state", "attributes", "entity_id",
)
#: Words that do not count as natural language.
NOT_NATURAL = ("async", "await", "def", "class", "import", "from", "return", "true", "false", "none", "self", "super", "function", "const", "homeassistant", "coordinator", "entity", "hass", "config")
JSON_BLOCK = r"\{[^}]*\}"
FENCE = r"(?s)```.*?```"


def _any_of(words: tuple[str, ...]) -> str:
    """A pattern of any of the words that branches by letter, so a place is tried against few of them."""
    ends, first = "" in words, sorted({w[0] for w in words if w})
    rest = "|".join(re.escape(x) + _any_of(tuple(w[1:] for w in words if w.startswith(x))) for x in first)
    return f"(?:{rest}){'?' * ends}" if first else ""


def _total(parts: Column, pattern: str) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, p: a + F.regexp_count(p, F.lit(pattern)))


def code_tokens(c: Column, code_words: tuple[str, ...] = CODE_WORDS) -> Column:
    """Tokens in braces and fences, code words anywhere, and signs in what is left without those blocks."""
    words = rf"\b{_any_of(code_words)}\b"

    def count(x: Column) -> Column:
        text, blocks, fences = x["text"], x["blocks"], x["fences"]
        bodies = F.transform(fences, lambda f: F.replace(f, F.lit("```"), F.lit("")))
        rest = F.aggregate(F.concat(blocks, fences), text, lambda left, b: F.replace(left, b, F.lit("")))
        return _total(blocks, r"\w+|[{}\[\]:,]") + _total(bodies, r"\w+|[{}\[\]():;=.,<>]") + F.regexp_count(text, F.lit(words)) + F.regexp_count(rest, F.lit(r"[{}\[\]():;=.,<>!&|+\-*/%]"))

    parts = lambda t: F.struct(t.alias("text"), F.regexp_extract_all(t, F.lit(JSON_BLOCK), 0).alias("blocks"), F.regexp_extract_all(t, F.lit(FENCE), 0).alias("fences"))
    return let(c, lambda t: let(parts(t), count))


def natural_tokens(c: Column, not_natural: tuple[str, ...] = NOT_NATURAL) -> Column:
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, JSON_BLOCK, ""), FENCE, ""), "<[^>]+>", "")
    found = F.regexp_extract_all(text, F.lit(r"\b[a-zA-Z]{2,}\b"), 0)
    return F.size(F.filter(found, lambda w: ~F.lower(w).isin(*not_natural)))


def logic_density(c: Column, stability: float = 800.0) -> Column:
    """Share of code tokens, damped in short texts."""

    def share(x: Column) -> Column:
        code, natural = x["code"], x["natural"]
        return F.when(code == 0, F.lit(0.0)).otherwise(code / F.greatest(F.lit(1.0), (natural + code).cast("double")) * (code / (code + F.lit(stability))))

    return let(c, lambda t: let(F.struct(code_tokens(t).alias("code"), natural_tokens(t).alias("natural")), share))


def density_check(code: Column, reasoning: Column, kind: Column) -> Column:
    """Production rule on the lengths of code and reasoning: (is_valid, score, reason)."""
    c, r = F.char_length(F.coalesce(code, F.lit(""))), F.char_length(F.coalesce(reasoning, F.lit("")))
    score = F.when(r == 0, F.lit(0.0)).otherwise(F.round(c / r, 3))
    limit = 0.10 * c / (c + 1200.0)
    reason = (
        F.when(c == 0, "no_code")
        .when(kind.isin("doc", "test", "jinja", "yaml"), F.when(c >= 50, "exempt").otherwise("too_short"))
        .when((c < 100) & (score > 0.01), "micro_snippet")
        .when(score >= limit, "dense")
        .otherwise("sparse")
    )
    return F.struct(reason.isin("exempt", "micro_snippet", "dense").alias("is_valid"), score.alias("score"), reason.alias("reason"))


# ------------------------------------------------------------------------------------------ smaller functions


def checkpoint_key(name: Column, file: Column, rep: Column | None = None) -> Column:
    """First 16 digits of the MD5 of name::file, with ::repN for a repetition."""
    base = F.concat_ws("::", name, file)
    return F.substring(F.md5(base if rep is None else F.when(rep.isNull(), base).otherwise(F.concat(base, F.lit("::rep"), rep.cast("string")))), 1, 16)


def bits_per_byte(predicted: Column, target: Column) -> Column:
    """0 if equal, infinite for an empty prediction, else -log2(share of equal places) * characters / bytes."""
    chars, size = F.char_length(target), F.octet_length(target)
    equal = F.aggregate(F.zip_with(F.split(predicted, ""), F.split(target, ""), lambda a, b: F.when(a == b, 1).otherwise(0)), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return F.when(predicted == target, F.lit(0.0)).when(predicted == "", F.lit(float("inf"))).otherwise(-F.log2(F.greatest(equal / chars, F.lit(1e-10))) * chars / size)


def length_penalty(n_words: Column, least: int = 200, most: float = 0.5) -> Column:
    return F.when(n_words >= least, F.lit(1.0)).otherwise(F.lit(1.0 - most) + F.lit(most) * n_words / least)


def clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def duration(seconds: Column) -> Column:
    """45s, 3m 20s, 2h 5m."""
    s = seconds.cast("long")
    return F.when(s < 60, F.concat(s.cast("string"), F.lit("s"))).when(s < 3600, F.concat((s / 60).cast("long").cast("string"), F.lit("m "), (s % 60).cast("string"), F.lit("s"))).otherwise(F.concat((s / 3600).cast("long").cast("string"), F.lit("h "), ((s % 3600) / 60).cast("long").cast("string"), F.lit("m")))


def fences(c: Column) -> Column:
    """Bodies of fenced code blocks."""
    return F.regexp_extract_all(c, F.lit(r"(?s)```(?:\w+)?\n(.*?)```"), 1)


def repair_output(c: Column) -> Column:
    """Inserts the closing tags that a reply lacks."""
    no_end = c.contains("<think>") & ~c.contains("</think>") & c.contains("<tool_call>")
    c = F.when(no_end, F.replace(c, F.lit("<tool_call>"), F.lit("</think><tool_call>"))).otherwise(c)
    return F.when(c.contains("<tool_call>") & ~c.contains("</tool_call>"), F.concat(c, F.lit("</tool_call>"))).otherwise(c)


#: The words, with their blanks, by which a text counts as Spanish or English.
SPANISH = (" el ", " la ", " que ", " y ", " para ", " usar ", " será ", " debe ", "vamos")
ENGLISH = (" the ", " and ", " to ", " is ", " will ", " this ")


def language_hint(c: Column) -> Column:
    """Spanish or English by which words occur more often; English where neither does."""
    text = F.lower(c)
    count = lambda ws: sum(((F.char_length(text) - F.char_length(F.replace(text, F.lit(w), F.lit("")))) / len(w) for w in ws), F.lit(0.0))
    return F.when(F.round(count(SPANISH)) > F.round(count(ENGLISH)), "Spanish").otherwise("English")


def tool_format(messages: Column) -> Column:
    """xml, json or none; XML anywhere wins."""
    xml = "(?i)<tool_call>|<tool_name>|<tool_args>"
    json = r'(?i)"tool_calls"\s*:|"name"\s*:\s*"[^"]+"\s*,\s*"arguments"'
    return F.when(F.exists(messages, lambda m: m["content"].rlike(xml)), "xml").when(F.exists(messages, lambda m: m["content"].rlike(json)), "json").otherwise("none")


def has_tool_call(messages: Column) -> Column:
    artefact = r'(?i)</?tool_calls?>|"tool_calls"\s*:|"name"\s*:\s*"[^"]+"\s*,\s*"arguments"'
    return F.exists(messages, lambda m: F.coalesce(m["content"].rlike(artefact), F.lit(False)))
