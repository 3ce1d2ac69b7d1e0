"""Queries for curation: duplicates, quality, structure, validation, formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import curation as C
from .registry import query, table

WS = r"[ \t\n\r\x0B\f]+"

# ------------------------------------------------------------------------------- tagged texts made from documents

#: A tagged assistant turn for each document: 0 passes, 1 a space between the tags, 2 no closing tag, 3 shallow,
#: 4 filler lines, 5 no tool call, 6 little code, 7 no tags; 8 no assistant turn.
CALL = '{"name": "write", "arguments": {"path": "a.py", "content": "def f(x): return x"}}'


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    kind = F.col("doc_id") % 9
    call = F.concat(F.lit("<tool_call>"), F.repeat(F.lit(CALL), 60), F.lit("</tool_call>"))
    think = F.concat(F.lit("<think>"), F.col("text"), F.lit("</think>"))
    content = (
        F.when(kind == 0, F.concat(think, call))
        .when(kind == 1, F.concat(think, F.lit(" "), call))
        .when(kind == 2, F.concat(F.lit("<think>"), F.col("text"), call))
        .when(kind == 3, F.concat(F.lit("<think>"), F.substring("text", 1, 80), F.lit("</think>"), call))
        .when(kind == 4, F.concat(F.lit("<think>"), F.repeat(F.lit("let me see what this is about, step by step\n"), 20), F.lit("</think>"), call))
        .when(kind == 5, think)
        .when(kind == 6, F.concat(think, F.lit("<tool_call>write it down</tool_call>")))
        .otherwise(F.col("text"))
    )
    user = F.struct(F.lit("user").alias("role"), F.lit("please").alias("content"))
    reply = F.struct(F.when(kind == 8, "system").otherwise("assistant").alias("role"), content.alias("content"))
    return d.select("doc_id", kind.alias("kind"), content.alias("content"), F.array(user, reply).alias("conversation"))


TAGGED = f"""
tagged AS (
  SELECT doc_id, doc_id % 9 AS kind, CASE doc_id % 9
    WHEN 0 THEN '<think>' || text || '</think><tool_call>' || repeat('{CALL}', 60) || '</tool_call>'
    WHEN 1 THEN '<think>' || text || '</think> <tool_call>' || repeat('{CALL}', 60) || '</tool_call>'
    WHEN 2 THEN '<think>' || text || '<tool_call>' || repeat('{CALL}', 60) || '</tool_call>'
    WHEN 3 THEN '<think>' || substring(text, 1, 80) || '</think><tool_call>' || repeat('{CALL}', 60) || '</tool_call>'
    WHEN 4 THEN '<think>' || repeat('let me see what this is about, step by step' || chr(10), 20) || '</think><tool_call>' || repeat('{CALL}', 60) || '</tool_call>'
    WHEN 5 THEN '<think>' || text || '</think>'
    WHEN 6 THEN '<think>' || text || '</think><tool_call>write it down</tool_call>'
    ELSE text END AS content FROM documents
)"""

# ----------------------------------------------------------------------------------------------- duplicates


@query("c1_exact_dedup_docs", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY sha256(text)")
def exact_docs(spark: SparkSession, d: str) -> DataFrame:
    return C.exact_dedup_texts(table(spark, d, "documents")).select("doc_id")


@query("c1_exact_dedup_conversations", "WITH r AS (SELECT conv_id, list((role, text) ORDER BY turn) AS c FROM conversations GROUP BY conv_id) SELECT min(conv_id) AS conv_id FROM r GROUP BY c")
def exact_conversations(spark: SparkSession, d: str) -> DataFrame:
    return C.exact_dedup_records(C.records_from_turns(table(spark, d, "conversations"))).select("conv_id")


@query("t6_normalized_dedup", rf"SELECT min(doc_id) AS doc_id FROM documents GROUP BY nfc_normalize(regexp_replace(regexp_replace(text, '^{WS}|{WS}$', '', 'g'), '{WS}', ' ', 'g'))")
def normalized_docs(spark: SparkSession, d: str) -> DataFrame:
    return C.keep_first(table(spark, d, "documents"), F.sha2(T.normalize_for_hash(F.col("text")), 256), "doc_id").select("doc_id")


# ----------------------------------------------------------------------------------------------- quality

SCORE = rf"""
q AS (
  SELECT doc_id, text, regexp_extract_all(lower(text), '[a-z]{{2,}}') AS t, list_filter(list_transform(regexp_split_to_array(text, '[.!?]{WS}'), lambda s: regexp_replace(s, '^{WS}|{WS}$', '', 'g')), lambda s: s <> '') AS s FROM documents
), score AS (
  SELECT doc_id, CASE WHEN len(t) = 0 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE,
    (0.6::DOUBLE * (len(list_distinct(t)) / len(t)::DOUBLE) + 0.4::DOUBLE * (1.0::DOUBLE - list_max(map_values(list_histogram(t))) / len(t)::DOUBLE))
    * CASE WHEN list_max(map_values(list_histogram(s))) >= 3 THEN 0.35::DOUBLE ELSE 1.0::DOUBLE END
    * CASE WHEN len(regexp_extract_all(text, '\.\.\.')) > 2 THEN 0.60::DOUBLE ELSE 1.0::DOUBLE END)) END AS score FROM q
)"""


@query("a4_quality_score", f"WITH {SCORE.strip()} SELECT doc_id, round(score, 9) AS score FROM score")
def quality(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.round(T.quality_score(F.col("text")), 9).alias("score"))


@query("f14_quality_gate", f"WITH {SCORE.strip()} SELECT count(*) AS n, count(*) FILTER (WHERE score >= 0.23) AS kept FROM score")
def gate(spark: SparkSession, d: str) -> DataFrame:
    scored = table(spark, d, "documents").select(T.quality_score(F.col("text")).alias("score"))
    return scored.agg(F.count("*").alias("n"), F.count_if(F.col("score") >= 0.23).alias("kept"))


BATTERY = rf"""
b AS (
  SELECT doc_id, text, greatest(length(text), 1) AS chars, list_filter(regexp_split_to_array(text, '{WS}'), lambda w: w <> '') AS w, list_filter(regexp_split_to_array(lower(text), '{WS}'), lambda w: w <> '') AS lw,
    list_filter(list_transform(string_split(text, chr(10)), lambda s: regexp_replace(s, '^{WS}|{WS}$', '', 'g')), lambda s: s <> '') AS lines FROM documents
), g AS (
  SELECT *, greatest(len(lines), 1)::DOUBLE AS n_lines, CASE WHEN len(lw) >= 3 THEN list_transform(range(1, len(lw) - 1), lambda i: lw[i] || ' ' || lw[i + 1] || ' ' || lw[i + 2]) ELSE [] END AS grams FROM b
), battery AS (
  SELECT doc_id, len(w) AS n_words, len(regexp_extract_all(text, '#|\.\.\.')) / greatest(len(w), 1)::DOUBLE AS symbol_ratio,
    len(regexp_extract_all(text, '[^\p{{L}}\p{{N}} \t\n\r\x0B\f]')) / chars::DOUBLE AS non_alnum_ratio,
    coalesce(list_sum(list_transform(regexp_extract_all(text, 'https?://[^ \t\n\r\x0B\f]+'), lambda u: length(u))), 0) / chars::DOUBLE AS url_ratio,
    len(list_filter(lines, lambda x: NOT regexp_matches(x, '[.!?"'']$'))) / n_lines AS no_endmark_ratio,
    len(list_filter(lines, lambda x: regexp_matches(lower(x), 'privacy policy|terms of use|cookie policy|all rights reserved'))) / n_lines AS boilerplate_ratio,
    1.0::DOUBLE - len(list_distinct(lines)) / n_lines AS repeated_line_ratio,
    CASE WHEN len(grams) > 0 THEN list_max(map_values(list_histogram(grams))) / len(grams)::DOUBLE ELSE 0.0 END AS top_gram_ratio FROM g
)"""
PASSES = "n_words >= 20 AND symbol_ratio <= 0.50 AND non_alnum_ratio <= 0.65 AND url_ratio <= 0.30 AND no_endmark_ratio <= 0.99 AND boilerplate_ratio <= 0.85 AND repeated_line_ratio <= 0.90 AND top_gram_ratio <= 0.35"
ROUNDED = ", ".join(f"round({n}, 9) AS {n}" for n in T.BATTERY_LIMITS if n != "n_words")


@query("f1_f8_quality_battery", f"WITH {BATTERY.strip()} SELECT doc_id, n_words, {ROUNDED}, {PASSES} AS passes FROM battery")
def quality_battery(spark: SparkSession, d: str) -> DataFrame:
    s = T.battery(F.col("text"))
    return table(spark, d, "documents").select("doc_id", *[(c if n == "n_words" else F.round(c, 9)).alias(n) for n, c in s.items()], T.battery_passes(s).alias("passes"))


@query("c2_battery_counts", f"WITH {BATTERY.strip()} SELECT lang, count(*) AS n, count(*) FILTER (WHERE {PASSES}) AS kept FROM battery JOIN documents USING (doc_id) GROUP BY lang")
def battery_counts(spark: SparkSession, d: str) -> DataFrame:
    ok = T.battery_passes(T.battery(F.col("text")))
    return table(spark, d, "documents").select("lang", ok.alias("ok")).groupBy("lang").agg(F.count("*").alias("n"), F.count_if("ok").alias("kept"))


# ----------------------------------------------------------------------------------------------- structure

# the SQL has word lists of its own
KW = "async|await|def|class|import|from|return|if|else|elif|for|while|try|except|finally|with|lambda|yield|raise|assert|pass|break|continue|True|False|None|self|super|__init__|function|const|let|var|new|this|export|HomeAssistant|DataUpdateCoordinator|Entity|ConfigEntry|async_setup_entry|async_added_to_hass|hass|entry|coordinator|device_info|state|attributes|entity_id"
STOP = "'async', 'await', 'def', 'class', 'import', 'from', 'return', 'true', 'false', 'none', 'self', 'super', 'function', 'const', 'homeassistant', 'coordinator', 'entity', 'hass', 'config'"


def ldi_sql(c: str) -> str:
    """Logic density in SQL, for texts of JSON blocks without fences."""
    code = rf"""(coalesce(list_sum(list_transform(regexp_extract_all({c}, '\{{[^}}]*\}}'), lambda b: len(regexp_extract_all(b, '\w+|[{{}}\[\]:,]')))), 0) + len(regexp_extract_all({c}, '\b(?:{KW})\b')) + len(regexp_extract_all(regexp_replace({c}, '\{{[^}}]*\}}', '', 'g'), '[{{}}\[\]():;=.,<>!&|+\-*/%]')))"""
    natural = rf"""len(list_filter(regexp_extract_all(regexp_replace(regexp_replace({c}, '\{{[^}}]*\}}', '', 'g'), '<[^>]+>', '', 'g'), '\b[a-zA-Z]{{2,}}\b'), lambda w: lower(w) NOT IN ({STOP})))"""
    return f"CASE WHEN {code} = 0 THEN 0.0::DOUBLE ELSE {code} / greatest(1.0::DOUBLE, ({natural} + {code})::DOUBLE) * ({code} / ({code} + 800.0::DOUBLE)) END"


GATE = rf"""
parts AS (
  SELECT *, CASE WHEN contains(content, '<think>') THEN 1 END AS has, CASE WHEN regexp_matches(content, '(?s)<think>.*?</think>') THEN regexp_replace(regexp_extract(content, '(?s)<think>(.*?)</think>', 1), '^{WS}|{WS}$', '', 'g') END AS think,
    CASE WHEN regexp_matches(content, '(?s)<tool_call>.*?</tool_call>') THEN regexp_extract(content, '(?s)<tool_call>(.*?)</tool_call>', 1) END AS call FROM tagged
), gate AS (
  SELECT doc_id, kind, CASE WHEN kind = 8 THEN 'invalid_syntax'
    WHEN contains(content, '<think>') AND contains(content, '</think>') AND (regexp_matches(content, '</think>\s+<tool_call>') OR (contains(content, '<tool_call>') AND NOT contains(content, '</think><tool_call>'))) THEN 'invalid_syntax'
    WHEN has IS NULL THEN NULL WHEN think IS NULL THEN 'invalid_syntax' WHEN length(think) < 500 THEN 'shallow_thinking'
    WHEN len(list_filter(string_split(think, chr(10)), lambda x: regexp_matches(lower(x), '{"|".join(T.META_PATTERNS)}'))) / len(string_split(think, chr(10)))::DOUBLE > 0.20 THEN 'meta_speech'
    WHEN call IS NULL THEN 'invalid_syntax' WHEN {ldi_sql("call")} < 0.15 THEN 'low_ldi' END AS reason FROM parts
)"""


@query("c3_structural_gate", f"WITH {TAGGED.strip()}, {GATE.strip()} SELECT doc_id, kind, reason FROM gate")
def structural(spark: SparkSession, d: str) -> DataFrame:
    return tagged(spark, d).select("doc_id", "kind", C.structural_reason(F.col("conversation")).alias("reason"))


@query("f13_reason_counts", f"WITH {TAGGED.strip()}, {GATE.strip()} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM gate GROUP BY 1")
def reasons(spark: SparkSession, d: str) -> DataFrame:
    r = tagged(spark, d).select(F.coalesce(C.structural_reason(F.col("conversation")), F.lit("kept")).alias("reason"))
    return r.groupBy("reason").agg(F.count("*").alias("n"))


@query("a1_removal_counters", f"WITH {TAGGED.strip()}, {GATE.strip()} SELECT count(*) AS total_input, count(*) FILTER (WHERE reason = 'invalid_syntax') AS invalid_syntax, count(*) FILTER (WHERE reason = 'shallow_thinking') AS shallow_thinking, count(*) FILTER (WHERE reason = 'meta_speech') AS meta_speech, count(*) FILTER (WHERE reason = 'low_ldi') AS low_ldi, count(*) FILTER (WHERE reason IS NULL) AS total_output, round(100.0::DOUBLE * count(*) FILTER (WHERE reason IS NULL) / count(*), 2) AS retention_pct FROM gate")
def counters(spark: SparkSession, d: str) -> DataFrame:
    r = tagged(spark, d).select(C.structural_reason(F.col("conversation")).alias("reason"))
    counts = [F.count_if(F.col("reason") == n).alias(n) for n in ("invalid_syntax", "shallow_thinking", "meta_speech", "low_ldi")]
    kept = F.count_if(F.col("reason").isNull())
    return r.agg(F.count("*").alias("total_input"), *counts, kept.alias("total_output"), F.round(F.lit(100.0) * kept / F.count("*"), 2).alias("retention_pct"))


@query("l1_logic_density", f"WITH {TAGGED.strip()} SELECT doc_id, round({ldi_sql('content')}, 9) AS ldi FROM (SELECT doc_id, regexp_replace(content, '[^ -~\\n]', '', 'g') AS content FROM tagged)")
def density(spark: SparkSession, d: str) -> DataFrame:
    return tagged(spark, d).select("doc_id", F.round(T.logic_density(F.regexp_replace("content", r"[^ -~\n]", "")), 9).alias("ldi"))


L2 = """
x AS (SELECT doc_id, length(coalesce(substring(text, 1, (doc_id % 200)::INT), '')) AS c, length(text) AS r, CASE doc_id % 3 WHEN 0 THEN 'doc' WHEN 1 THEN 'python' ELSE 'yaml' END AS kind FROM documents),
y AS (SELECT *, CASE WHEN r = 0 THEN 0.0::DOUBLE ELSE round(c / r::DOUBLE, 3) END AS score FROM x),
z AS (SELECT *, CASE WHEN c = 0 THEN 'no_code' WHEN kind IN ('doc', 'test', 'jinja', 'yaml') THEN CASE WHEN c >= 50 THEN 'exempt' ELSE 'too_short' END WHEN c < 100 AND score > 0.01 THEN 'micro_snippet' WHEN score >= 0.10::DOUBLE * c / (c + 1200.0::DOUBLE) THEN 'dense' ELSE 'sparse' END AS reason FROM y)"""


@query("l2_density_check", f"WITH {L2.strip()} SELECT doc_id, score, reason, reason IN ('exempt', 'micro_snippet', 'dense') AS is_valid FROM z")
def density_rule(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("doc_id") % 3 == 0, "doc").when(F.col("doc_id") % 3 == 1, "python").otherwise("yaml")
    code = F.substring(F.col("text"), F.lit(1), (F.col("doc_id") % 200).cast("int"))
    return table(spark, d, "documents").select("doc_id", T.density_check(code, F.col("text"), kind).alias("x")).select("doc_id", "x.score", "x.reason", "x.is_valid")


@query("l6_density_words", rf"WITH {TAGGED.strip()}, w AS (SELECT doc_id, list_filter(regexp_split_to_array(content, '{WS}'), lambda x: x <> '') AS w FROM tagged) SELECT doc_id, len(list_filter(w, lambda x: regexp_matches(x, '[{{}}();=<>\[\]]'))) AS code_words, round(len(list_filter(w, lambda x: regexp_matches(x, '[{{}}();=<>\[\]]'))) / greatest(1, len(list_filter(w, lambda x: NOT regexp_matches(x, '[{{}}();=<>\[\]]'))))::DOUBLE, 9) AS ratio FROM w")
def density_words(spark: SparkSession, d: str) -> DataFrame:
    w = T.words(F.col("content"))
    code = F.size(F.filter(w, lambda x: x.rlike(r"[{}();=<>\[\]]")))
    return tagged(spark, d).select("doc_id", code.cast("long").alias("code_words"), F.round(code / F.greatest(F.lit(1), F.size(w) - code), 9).alias("ratio"))


@query("p1_assistant_text", "SELECT conv_id, string_agg(text, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant') IS NOT NULL AS spoken, coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS text FROM conversations GROUP BY conv_id")
def p1(spark: SparkSession, d: str) -> DataFrame:
    r = C.records_from_turns(table(spark, d, "conversations"))
    return r.select("conv_id", F.exists("conversation", lambda m: m["role"] == "assistant").alias("spoken"), C.assistant_text(F.col("conversation")).alias("text"))


@query("p2_best_text", rf"""
WITH r AS (SELECT conv_id, list_filter(list((role, text) ORDER BY turn), lambda x: x[1] = 'assistant') AS a FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN 'flat ' || conv_id WHEN len(a) > 0 THEN regexp_replace(array_to_string(list_transform(a, lambda m: regexp_replace(m[2], '^{WS}|{WS}$', '', 'g')), chr(10)), '^{WS}|{WS}$', '', 'g') ELSE 'thought' END AS text FROM r""")
def p2(spark: SparkSession, d: str) -> DataFrame:
    flat = F.when(F.col("conv_id") % 5 == 0, F.concat(F.lit(" flat "), F.col("conv_id").cast("string")))
    r = C.records_from_turns(table(spark, d, "conversations"))
    return r.select("conv_id", C.best_text([flat, F.lit("  ")], F.col("conversation"), F.lit(" thought ")).alias("text"))


@query("p3_first_turns", "SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS user_prompt, arg_min(text, turn) FILTER (WHERE role = 'assistant') AS response FROM conversations GROUP BY conv_id")
def p3(spark: SparkSession, d: str) -> DataFrame:
    r = C.records_from_turns(table(spark, d, "conversations"))
    return r.select("conv_id", C.first_turn(F.col("conversation"), "user").alias("user_prompt"), C.first_turn(F.col("conversation"), "assistant").alias("response"))


@query("p5_think_split", f"WITH {TAGGED.strip()} SELECT doc_id, CASE WHEN contains(content, '</think>') THEN md5(substring(content, 1, strpos(content, '</think>') - 1)) END AS before, CASE WHEN contains(content, '</think>') THEN md5(substring(content, strpos(content, '</think>') + 8)) ELSE md5(content) END AS after FROM tagged")
def p5(spark: SparkSession, d: str) -> DataFrame:
    at = F.instr("content", "</think>")
    before = F.when(at > 0, F.md5(F.substring(F.col("content"), F.lit(1), at - 1)))
    after = F.when(at > 0, F.md5(F.substring(F.col("content"), at + 8, F.char_length("content")))).otherwise(F.md5("content"))
    return tagged(spark, d).select("doc_id", before.alias("before"), after.alias("after"))


@query("p11_tool_call_parse", f"WITH {TAGGED.strip()}, c AS (SELECT doc_id, regexp_extract(content, '(?s)<tool_call>([^<]*?}}}}}})', 1) AS j FROM tagged WHERE kind IN (0, 1, 3)) SELECT doc_id, 'write' AS name, 'a.py' AS path, true AS valid FROM c")
def p11(spark: SparkSession, d: str) -> DataFrame:
    call = F.regexp_extract("content", r"(?s)<tool_call>(\{.*?\}\})", 1)
    j = F.from_json(call, "name string, arguments struct<path:string,content:string>")
    return tagged(spark, d).filter(F.col("kind").isin(0, 1, 3)).select("doc_id", j["name"].alias("name"), j["arguments"]["path"].alias("path"), (j["name"].isNotNull() & j["arguments"].isNotNull()).alias("valid"))


@query("t22_code_fences", "SELECT doc_id, 2::BIGINT AS n, 'x = ' || doc_id || chr(10) AS first FROM documents")
def t22(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("see\n```python\nx = "), F.col("doc_id").cast("string"), F.lit("\n``` and ```\ny\n```"))
    found = T.fences(text)
    return table(spark, d, "documents").select("doc_id", F.size(found).cast("long").alias("n"), found[0].alias("first"))


@query("t12_output_repair", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '<think>a</think><tool_call>b</tool_call>' WHEN 1 THEN '<think>a</think><tool_call>b</tool_call>' ELSE 'plain' END AS text FROM documents")
def t12(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("doc_id") % 3 == 0, "<think>a<tool_call>b").when(F.col("doc_id") % 3 == 1, "<think>a</think><tool_call>b").otherwise("plain")
    return table(spark, d, "documents").select("doc_id", T.repair_output(raw).alias("text"))


# ----------------------------------------------------------------------------------------------- validation, formats


def chat_records(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("doc_id") % 7
    extra = F.when(kind == 0, "<tool_call>x</tool_call>").when(kind == 1, '"name": "f", "arguments": {}').when(kind == 2, "<tool_name>f").otherwise("")
    m = F.array(F.struct(F.lit("user").alias("role"), F.lit("q").alias("content")), F.struct(F.lit("assistant").alias("role"), F.concat(F.col("text"), extra).alias("content")))
    return table(spark, d, "documents").select(F.col("doc_id").alias("_seq"), m.alias("messages"))


CHAT = rf"""
chat AS (SELECT doc_id AS _seq, text || CASE doc_id % 7 WHEN 0 THEN '<tool_call>x</tool_call>' WHEN 1 THEN '"name": "f", "arguments": {{}}' WHEN 2 THEN '<tool_name>f' ELSE '' END AS c FROM documents),
marked AS (SELECT *, CASE WHEN regexp_matches(c, '(?i)<tool_call>|<tool_name>|<tool_args>') THEN 'xml' WHEN regexp_matches(c, '(?i)"tool_calls"\s*:|"name"\s*:\s*"[^"]+"\s*,\s*"arguments"') THEN 'json' ELSE 'none' END AS tool_format,
  regexp_matches(c, '(?i)</?tool_calls?>|"tool_calls"\s*:|"name"\s*:\s*"[^"]+"\s*,\s*"arguments"') AS bad, regexp_replace(regexp_replace(c, '^{WS}|{WS}$', '', 'g'), '{WS}', ' ', 'g') AS k FROM chat),
firsts AS (SELECT *, min(_seq) FILTER (WHERE NOT bad) OVER (PARTITION BY k) AS f FROM marked),
checked AS (SELECT _seq, tool_format, CASE WHEN bad THEN 'tool_call_content' WHEN _seq <> f THEN 'duplicate' END AS reason FROM firsts)"""


@query("c5_validate_and_dedup", f"WITH {CHAT.strip()} SELECT _seq, tool_format, reason FROM checked")
def c5(spark: SparkSession, d: str) -> DataFrame:
    return C.validate_and_dedup(chat_records(spark, d)).select("_seq", "tool_format", "reason")


@query("a3_discard_report", f"WITH {CHAT.strip()} SELECT tool_format, coalesce(reason, 'kept') AS reason, count(*) AS n FROM checked GROUP BY 1, 2")
def a3(spark: SparkSession, d: str) -> DataFrame:
    return C.validate_and_dedup(chat_records(spark, d)).groupBy("tool_format", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def raw_formats(spark: SparkSession, d: str) -> DataFrame:
    kind, text = F.col("doc_id") % 5, F.col("text")
    turn = lambda a, b, x, y: F.struct(F.lit(x).alias(a), y.alias(b))
    return table(spark, d, "documents").select(
        "doc_id",
        F.when(kind == 0, F.array(turn("role", "content", "user", text))).alias("messages"),
        F.when(kind.isin(1, 2), F.array(turn("from", "value", "human", text), turn("from", "value", "gpt", F.when(kind == 1, text)), turn("from", "value", "critic", text))).alias("conversations"),
        F.when(kind == 3, text).alias("instruction"),
        F.when(F.col("doc_id") % 2 == 0, "in").alias("input"),
        F.when(kind == 3, F.lit("out")).alias("output"),
    )


@query("n1_n5_normalize", """
WITH r AS (SELECT doc_id, doc_id % 5 AS k, text AS t FROM documents)
SELECT doc_id, CASE k WHEN 0 THEN 'openai_messages' WHEN 1 THEN 'sharegpt' WHEN 2 THEN 'sharegpt' WHEN 3 THEN 'alpaca' ELSE 'unknown' END AS format,
  CASE k WHEN 0 THEN 'user:' || t WHEN 1 THEN 'user:' || t || '|assistant:' || t || '|critic:' || t WHEN 3 THEN 'user:' || t || CASE WHEN doc_id % 2 = 0 THEN chr(10) || chr(10) || 'in' ELSE '' END || '|assistant:out' END AS turns FROM r""")
def n1(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    fmt = C.detect_format(c("messages"), c("conversations"), c("instruction"), c("output"))
    r = raw_formats(spark, d).withColumn("format", fmt)
    m = C.normalize_messages(c("format"), c("messages"), c("conversations"), c("instruction"), c("input"), c("output"))
    return r.select("doc_id", "format", m.alias("m")).select("doc_id", "format", F.when(c("m").isNotNull(), F.array_join(F.transform("m", lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "|")).alias("turns"))


@query("t1_t3_shingle_jaccard", rf"""
WITH s AS (SELECT doc_id, replace(regexp_replace(regexp_replace(lower(text), '^{WS}|{WS}$', '', 'g'), '{WS}', ' ', 'g'), ' ', '_') AS t FROM documents),
g AS (SELECT doc_id, CASE WHEN t = '' THEN [] WHEN length(t) < 5 THEN [t] ELSE list_distinct(list_transform(range(1, length(t) - 3), lambda i: l[i] || l[i + 1] || l[i + 2] || l[i + 3] || l[i + 4])) END AS g FROM (SELECT *, string_split(t, '') AS l FROM s))
SELECT a.doc_id, len(a.g) AS n, round(CASE WHEN len(list_distinct(list_concat(a.g, b.g))) = 0 THEN 0.0 ELSE len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g)))::DOUBLE END, 9) AS similarity FROM g a JOIN g b ON b.doc_id = a.doc_id + 1""")
def t1(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "documents").select("doc_id", "text")
    other = one.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("other"))
    return T.jaccard_of_texts(one.join(other, "doc_id"), "doc_id", "text", "other").withColumn("similarity", F.round("similarity", 9))
