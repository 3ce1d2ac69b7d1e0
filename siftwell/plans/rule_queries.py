"""Queries of the rules on generated records. The records are made of the documents: thoughts, calls in several forms
and code snippets, so that every rule is met and missed. The SQL has its own patterns, without lookarounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audit as A
from ..operators import rules as R
from ..operators import sampling as S
from .registry import query, table

SNIPPETS = (
    "x = hass.data[DOMAIN]", "requests.get(url)", "time.sleep(3)", "await time.sleep(3)", "TEMP_CELSIUS", "return PERCENTAGE, 1", "self._state =5", "platform: template", "{{ None }}", "as_timestamp (now)",
    "async_forward_entry_setups(entry)", "async_forward_entry_setup(entry)", "print(1) # requests.get(", "Expert HA 2026 Implementation", "... later", "urllib.request.urlopen(u)", "trigger:", "value_template: x",
    "{{ _helper(1) }}", "{{- func(2) }}", "def update(self)", "mysql_query($a)", "global $db; echo $_GET[0]", "include_once $x", "include $x; TABLE_ORDERS", "x | float }", "wp_send_json_error($e)", "entry.runtime_data = await asyncio",
)
TYPES = ("nominal", "contrast", "error_recovery", "theory", "nominal")


def pick(items, n: int = 0):
    """One of some strings by the id."""
    return F.element_at(F.array(*[F.lit(s) for s in items]), ((F.col("doc_id") + n) % len(items)).cast("int") + 1)


def sql_pick(items, n: int = 0) -> str:
    return "[" + ", ".join("'" + s.replace("'", "''") + "'" for s in items) + f"][(doc_id + {n}) % {len(items)} + 1]"


def records(spark: SparkSession, d: str) -> DataFrame:
    s, t, k = pick(SNIPPETS), F.coalesce("text", F.lit("")), F.col("doc_id") % 6
    x = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    raw = (
        F.when(k == 0, x("<think>", t, '</think><tool_call>{"name": "write_to_file", "arguments": {"path": "a.py", "content": "', s, '"}}</tool_call>'))
        .when(k == 1, x(t, '</think><tool_call>[{"name": "w", "arguments": {"content": "', s, '"}}, {"name": "v", "arguments": {}}]</tool_call> done'))
        .when(k == 2, x(t, " await </think><write_action><path>a</path><content> ", s, " </content></write_action>"))
        .when(k == 3, x(t, "</think>\n```python\n", s, "\n```"))
        .when(k == 4, t)
        .otherwise(x("<think> non-blocking ", t, "</think><tool_call>", s, "</tool_call>"))
    )
    gold = F.when(F.col("doc_id") % 5 != 0, F.col("doc_id") % 3 == 0)
    return table(spark, d, "documents").select(
        "doc_id",
        pick(TYPES).alias("example_type"),
        gold.alias("gold_injected"),
        (F.col("doc_id") % 7 == 0).alias("legacy_detected"),
        x("Fix ", F.coalesce("source", F.lit("")), " now").alias("user_text"),
        raw.alias("raw"),
        F.when(F.col("doc_id") % 4 == 0, s).alias("filter_text"),
        F.when(F.col("doc_id") % 2 == 0, F.upper("source")).alias("fragment_name"),
        F.lit("").alias("source_file"),
        s.alias("code"),
    )


SPOKEN = f"""
src AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS source, {sql_pick(SNIPPETS)} AS s, {sql_pick(TYPES)} AS example_type FROM documents),
rec AS (SELECT *, CASE doc_id % 6
  WHEN 0 THEN '<think>' || t || '</think><tool_call>{{"name": "write_to_file", "arguments": {{"path": "a.py", "content": "' || s || '"}}}}</tool_call>'
  WHEN 1 THEN t || '</think><tool_call>[{{"name": "w", "arguments": {{"content": "' || s || '"}}}}, {{"name": "v", "arguments": {{}}}}]</tool_call> done'
  WHEN 2 THEN t || ' await </think><write_action><path>a</path><content> ' || s || ' </content></write_action>'
  WHEN 3 THEN t || '</think>' || chr(10) || '```python' || chr(10) || s || chr(10) || '```'
  WHEN 4 THEN t ELSE '<think> non-blocking ' || t || '</think><tool_call>' || s || '</tool_call>' END AS raw,
  CASE WHEN doc_id % 5 <> 0 THEN doc_id % 3 = 0 END AS gold, doc_id % 7 = 0 AS legacy, CASE WHEN doc_id % 4 = 0 THEN s END AS filter_text FROM src),
said AS (SELECT *, regexp_replace(CASE WHEN contains(raw, '</think>') THEN CASE WHEN contains(raw, '<think>') THEN string_split(substring(raw, strpos(raw, '<think>') + 7), '</think>')[1] ELSE string_split(raw, '</think>')[1] END ELSE '' END, '^[ \\t\\n\\r\\x0B\\f]+|[ \\t\\n\\r\\x0B\\f]+$', '', 'g') AS reasoning,
  CASE WHEN contains(raw, '</think>') THEN substring(raw, strpos(raw, '</think>') + 8) ELSE '' END AS rest FROM rec),
done AS (SELECT *, CASE doc_id % 6
  WHEN 0 THEN s || chr(10) || chr(10) || rest WHEN 1 THEN s || chr(10) || chr(10) || rest WHEN 2 THEN s || chr(10) || chr(10) || rest WHEN 3 THEN rest WHEN 4 THEN ''
  ELSE s || chr(10) || chr(10) || rest END AS action FROM said)""".strip()


def sql_found(column: str, rules) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {cond.format(c=column)} THEN '{name}' END" for cond, name in rules) + "], lambda x: x IS NOT NULL)"


def rx(p: str) -> str:
    return f"regexp_matches({{c}}, '{p}')".replace("{c}", "\0").replace("{", "{{").replace("}", "}}").replace("\0", "{c}")


SLEEP = "contains(regexp_replace({c}, 'await[ \\t\\n]time\\.sleep\\(', '', 'g'), 'time.sleep(')"


@query("p6_reasoning", f"WITH {SPOKEN} SELECT doc_id, md5(reasoning) AS digest, length(reasoning) AS n FROM done")
def p6(spark: SparkSession, d: str) -> DataFrame:
    r = R.reasoning(F.col("raw"))
    return records(spark, d).select("doc_id", F.md5(r).alias("digest"), F.char_length(r).cast("long").alias("n"))


@query("p7_action_text", f"WITH {SPOKEN} SELECT doc_id, md5(action) AS digest FROM done")
def p7(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("doc_id", F.md5(R.action_text(F.col("raw"), F.col("filter_text"))).alias("digest"))


@query("p8_p9_executable_code", f"WITH {SPOKEN}, e AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN s WHEN 1 THEN s WHEN 3 THEN s || chr(10) ELSE raw END AS code FROM done) SELECT doc_id, md5(code) AS code, md5(regexp_replace(code, '(?m)[ \\t]*#.*$', '', 'g')) AS bare FROM e")
def p8(spark: SparkSession, d: str) -> DataFrame:
    code = R.executable_code(F.col("raw"))
    return records(spark, d).select("doc_id", F.md5(code).alias("code"), F.md5(R.strip_comments(code)).alias("bare"))


PROGRAM = [
    (rx(r"hass\.data\["), R.LEGACY_PROGRAM[0][1]),
    (rx(r"\bTEMP_(CELSIUS|FAHRENHEIT|KELVIN)\b"), R.LEGACY_PROGRAM[2][1]),
    (rx(r"\bUNIT_PERCENTAGE\b|\bPERCENTAGE\b\s*[,\)]"), R.LEGACY_PROGRAM[3][1]),
    (rx(r"async_forward_entry_setup\b"), R.LEGACY_PROGRAM[8][1]),
    ("contains({c}, 'def update(self)')", R.LEGACY_PROGRAM[11][1]),
    (rx(r"requests\.(get|post|put|delete)\("), R.LEGACY_PROGRAM[14][1]),
    (SLEEP, R.LEGACY_PROGRAM[15][1]),
    ("contains({c}, 'urllib.request.urlopen')", R.LEGACY_PROGRAM[16][1]),
    (rx(r"\bself\._state\s*="), R.LEGACY_PROGRAM[17][1]),
]
TEMPLATE = [
    (rx(r"(?m)^\s*trigger:\s*$"), R.LEGACY_TEMPLATE[0][1].replace("'", "''")),
    (rx(r"platform:\s*template"), R.LEGACY_TEMPLATE[11][1].replace("'", "''")),
    ("contains({c}, 'value_template:')", R.LEGACY_TEMPLATE[12][1].replace("'", "''")),
    (rx(r"\|\s*float\s*[^(]"), R.LEGACY_TEMPLATE[13][1].replace("'", "''")),
    (rx(r"\|\s*int\s*[^(]"), R.LEGACY_TEMPLATE[14][1].replace("'", "''")),
    (rx(r"\bas_timestamp\b"), R.LEGACY_TEMPLATE[15][1].replace("'", "''")),
]


@query("f16_pattern_detector", f"WITH {SPOKEN}, c AS (SELECT doc_id, (doc_id // 7) % 2 = 1 AS template, t || chr(10) || s || chr(10) || {sql_pick(SNIPPETS, 5)} AS code FROM done) SELECT doc_id, array_to_string(CASE WHEN template THEN {sql_found('code', TEMPLATE)} ELSE {sql_found('code', PROGRAM)} END, ';') AS found FROM c")
def f16(spark: SparkSession, d: str) -> DataFrame:
    code = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), pick(SNIPPETS), F.lit("\n"), pick(SNIPPETS, 5))
    return table(spark, d, "documents").select("doc_id", F.array_join(R.legacy_patterns(code, F.expr("(doc_id div 7) % 2 = 1")), ";").alias("found"))


POISONS = [
    (rx(r"\{\{-?\s*None\s*-?\}\}"), R.POISON[0][1]),
    (rx(r"\bas_timestamp\s*\("), R.POISON[1][1]),
    (rx(r"platform:\s*template"), R.POISON[2][1].replace("'", "''")),
    (rx(r"(?m)^\s*trigger:\s*\n\s*-"), R.POISON[3][1].replace("'", "''")),
    (rx(r"\{\{-?\s*func\s*\("), R.POISON[6][1]),
    (rx(r"\{\{-?\s*_\w+\s*\("), R.POISON[7][1]),
]


@query("f17_output_poison", f"WITH {SPOKEN}, c AS (SELECT doc_id, s || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '  - ' ELSE '' END || {sql_pick(SNIPPETS, 3)} AS code FROM done) SELECT doc_id, array_to_string({sql_found('code', POISONS)}, ';') AS found FROM c")
def f17(spark: SparkSession, d: str) -> DataFrame:
    code = F.concat(pick(SNIPPETS), F.lit("\n"), F.when(F.col("doc_id") % 2 == 0, "  - ").otherwise(""), pick(SNIPPETS, 3))
    return table(spark, d, "documents").select("doc_id", F.array_join(R.output_poison(code), ";").alias("found"))


@query("f19_f20_strategy", f"WITH {SPOKEN} SELECT doc_id, example_type <> 'theory' AND (length('Fix ' || source || ' now') + length(raw)) // 4 <= 1000 AND contains(raw, '</think>') AS eligible, CASE WHEN example_type = 'theory' THEN 'skip' WHEN legacy THEN 'full_backtracking' WHEN coalesce(gold, false) THEN 'trace_reconstruction' WHEN example_type = 'error_recovery' THEN 'error_first' WHEN example_type = 'contrast' THEN 'contrast_backtracking' ELSE 'pass_through' END AS strategy FROM done")
def f19(spark: SparkSession, d: str) -> DataFrame:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    ok = R.eligible(F.col("example_type"), F.array(turn("user", "user_text"), turn("assistant", "raw")), most_tokens=1000)
    return records(spark, d).select("doc_id", ok.alias("eligible"), R.strategy(F.col("example_type"), F.col("legacy_detected"), F.col("gold_injected")).alias("strategy"))


LEGACIES = [rx(r"hass\.data\["), rx(r"hass\.data\.setdefault"), rx(r"\bTEMP_(CELSIUS|FAHRENHEIT|KELVIN)\b"), rx(r"async_forward_entry_setup\b"), rx(r"requests\.(get|post|put|delete)\("), SLEEP, rx(r"urllib\.request\.urlopen"), rx(r"\bself\._state\s*=\b")]
OLD = lambda c: " OR ".join(f"({p.format(c=c)})" for p in LEGACIES)


@query("f21_rejection", f"WITH {SPOKEN}, e AS (SELECT doc_id, regexp_replace(CASE WHEN (doc_id // 6) % 2 = 0 THEN 'x' || chr(10) ELSE s || chr(10) END, '(?m)[ \\t]*#.*$', '', 'g') AS half, regexp_replace(CASE doc_id % 6 WHEN 0 THEN s WHEN 1 THEN s WHEN 3 THEN s || chr(10) ELSE rest END, '(?m)[ \\t]*#.*$', '', 'g') AS after FROM done) SELECT doc_id, NOT ({OLD('half')}) AND NOT ({OLD('after')}) AS clean FROM e")
def f21(spark: SparkSession, d: str) -> DataFrame:
    body = F.when(F.expr("(doc_id div 6) % 2 = 0"), "x").otherwise(F.col("code"))
    thought = F.concat(F.col("code"), F.lit(" " * 200), F.lit("```python\n"), body, F.lit("\n```"))
    return records(spark, d).select("doc_id", R.resolution_is_clean(thought, R.after(F.col("raw"), "</think>")).alias("clean"))


SIGNAL = r"(?i)\bawait\b|\basyncio\b|async_add_executor_job|no blocking|avoid blocking|non-blocking"
AUDITED = f"""{SPOKEN}, m AS (SELECT *, regexp_matches(action, 'requests\\.|time\\.sleep\\(|urllib\\.request') AS blocking, regexp_matches(reasoning, '{SIGNAL}') AS thinks, regexp_matches(action, '{SIGNAL}') AS acts,
  {" + ".join(f"({p.format(c='action')})::INT" for p, _ in POISONS)} + regexp_matches(action, '(?m)^\\s*condition:\\s*\\n\\s*-')::INT + regexp_matches(action, '(?m)^\\s*action:\\s*\\n\\s*-')::INT AS poison, {" + ".join(f"({p.format(c='action')})::INT" for p in LEGACIES)} AS old,
  {" + ".join(f"contains(lower(reasoning), '{k.lower()}')::INT" for k in ("CoordinatorEntity", "entry.runtime_data", "async_forward_entry_setups", "async_add_executor_job", "await asyncio", "ConfigFlow", "EntityDescription"))} AS hits,
  regexp_replace(action, '^[ \\t\\n\\r\\x0B\\f]+|[ \\t\\n\\r\\x0B\\f]+$', '', 'g') AS bare FROM done),
a AS (SELECT *, coalesce(gold, false) AND (length(bare) < 180 OR contains(action, 'Expert HA 2026 Implementation') OR starts_with(bare, '...')) AS bad FROM m),
f AS (SELECT *, list_filter([CASE WHEN old > 0 THEN 'legacy' END, CASE WHEN blocking THEN 'blocking' END, CASE WHEN blocking AND thinks THEN 'contradiction' END, CASE WHEN poison > 0 THEN 'poison' END, CASE WHEN bad THEN 'gold_problem' END], lambda x: x IS NOT NULL) AS flags,
  CASE WHEN gold IS NULL THEN CASE WHEN blocking THEN 'gold injection' WHEN acts THEN 'gold skiping' ELSE 'unknown' END WHEN gold THEN 'gold injection' ELSE 'gold skiping' END AS gold_label, length(reasoning) AS n, length(coalesce(filter_text, '')) AS fl FROM a)"""


@query("f22_audit_flags", f"WITH {AUDITED} SELECT doc_id, array_to_string(flags, ',') AS flags, gold_label, hits AS keyword_hits, (poison + old)::BIGINT AS violations FROM f")
def f22(spark: SparkSession, d: str) -> DataFrame:
    return R.audit(records(spark, d)).select("doc_id", F.array_join("flags", ",").alias("flags"), "gold_label", "keyword_hits", F.col("violations").cast("long").alias("violations"))


@query("a6_health_score", f"""WITH {AUDITED}, p AS (SELECT example_type, count(*) AS sample_size,
  round(avg((doc_id % 2 = 0 AND source <> '')::INT) * 20, 2) AS contextual_alignment,
  round(avg(0.6::DOUBLE * least(n, 500) / 500 + 0.4::DOUBLE * least(hits / 3.0::DOUBLE, 1.0::DOUBLE)) * 20, 2) AS reasoning_quality,
  round(avg(CASE WHEN NOT coalesce(gold, false) THEN CASE WHEN n > 100 THEN 1.0::DOUBLE ELSE 0.8::DOUBLE END WHEN bad THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) * 20, 2) AS gold_injection_integrity,
  round(avg(CASE WHEN n = 0 THEN CASE WHEN fl < 100 THEN 0.3::DOUBLE ELSE 0.6::DOUBLE END ELSE 0.6::DOUBLE * least(fl / greatest(n, 1)::DOUBLE, 1.0::DOUBLE) + 0.4::DOUBLE * (hits > 0 AND fl > 0)::INT END) * 20, 2) AS distillation_efficacy,
  round(avg(greatest(0.0::DOUBLE, 1.0::DOUBLE - least(poison + old, 3) / 3.0::DOUBLE)) * 20, 2) AS law_compliance FROM f GROUP BY 1)
SELECT *, round(contextual_alignment + reasoning_quality + gold_injection_integrity + distillation_efficacy + law_compliance, 2) AS health_score FROM p""")
def a6(spark: SparkSession, d: str) -> DataFrame:
    return R.health(R.audit(records(spark, d)), "example_type")


@query("a7_flag_counts", f"WITH {AUDITED} SELECT flag, gold_label, count(*) AS n FROM (SELECT unnest(flags) AS flag, gold_label FROM f) GROUP BY 1, 2")
def a7(spark: SparkSession, d: str) -> DataFrame:
    return R.flag_counts(R.audit(records(spark, d)))


SIGNATURE_SQL = ", ".join(f"('{n}', '{c}', '{p}')" for n, c, p in (
    ("mysql_query", "PERSISTENCE_SMELL", r"mysql_query\s*\("), ("global_var", "STATE_POLLUTION", r"global\s+\$\w+"), ("get_access", "STATE_POLLUTION", r"\$_GET\s*\["), ("include", "MODULE_LINK_SMELL", r"\binclude\b"),
    ("include_once", "MODULE_LINK_SMELL", r"\binclude_once\b"), ("require", "MODULE_LINK_SMELL", r"\brequire\b"), ("echo_get", "SECURITY_VULN", r"echo\s+\$_(GET|POST|REQUEST)\s*\["), ("dynamic_include", "SECURITY_VULN", r"include\s*\$\w+"),
    ("unescaped_json_error", "SECURITY_VULN", r"\bwp_send_json_error\s*\("), ("eval_usage", "SECURITY_VULN", r"eval\s*\("), ("table_constant", "CONSTANT_POLLUTION", r"TABLE_\w+"), ("define", "CONSTANT_POLLUTION", r"define\s*\("),
))


@query("g5_signature_scan", f"WITH {SPOKEN}, l AS (SELECT doc_id, unnest(string_split(t || chr(10) || s, chr(10))) AS line, unnest(range(1, len(string_split(t || chr(10) || s, chr(10))) + 1)) AS line_number FROM done), p AS (SELECT * FROM (VALUES {SIGNATURE_SQL}) v(pattern_name, category, pattern)) SELECT doc_id, line_number, pattern_name, category, CASE category WHEN 'SECURITY_VULN' THEN 'critical' WHEN 'PERSISTENCE_SMELL' THEN 'warning' WHEN 'STATE_POLLUTION' THEN 'warning' ELSE 'info' END AS severity FROM l JOIN p ON regexp_matches(line, pattern)")
def g5(spark: SparkSession, d: str) -> DataFrame:
    code = table(spark, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), pick(SNIPPETS)).alias("code"))
    return R.signatures(code, "doc_id", "code").drop("matched_text")


@query("f26_query_validator", "WITH x AS (SELECT doc_id, text || ' ' || " + sql_pick(("sin detalles", "Crea una clase nueva", "usa DataUpdateCoordinator", "Debes usar eso", "define la función f")) + " AS t FROM documents) SELECT doc_id, NOT (" + " OR ".join(f"contains(lower(t), '{w}')" for w in ("async_forward_entry_setups", "dataupdatecoordinator", "llama al servicio", "usa el componente", "async_setup_entry", "implementa usando", "crea una clase", "define la función", "sigue estos pasos", "primero haz", "después haz", "para resolver esto:", "necesitas usar", "debes usar")) + ") AS valid FROM x")
def f26(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.col("text"), F.lit(" "), pick(("sin detalles", "Crea una clase nueva", "usa DataUpdateCoordinator", "Debes usar eso", "define la función f")))
    return table(spark, d, "documents").select("doc_id", R.query_is_valid(t).alias("valid"))


CATEGORIES = ("data_coordinator", "dual_mode_integration", "Entity_types", "rest_api", "local_files", "websocket_rest")


@query("t26_objectives", f"SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'El sistema debe coordinar actualizaciones de datos automáticamente' WHEN 1 THEN 'El sistema debe integrar componentes de forma autónoma' WHEN 2 THEN 'El sistema debe gestionar entidades con verificación de tipos' WHEN 3 THEN 'El sistema debe consumir servicios externos' WHEN 4 THEN 'El sistema debe manejar local files de forma autónoma' ELSE 'El sistema debe mantener comunicación bidireccional' END AS objective FROM documents")
def t26(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", R.objective(pick(CATEGORIES)).alias("objective"))


WORDS_SQL = "'def', 'class', 'import', 'from', 'return', 'if', 'else', 'elif', 'for', 'while', 'try', 'except', 'async', 'await', 'self', 'None', 'True', 'False', 'dict', 'list', 'str', 'int', 'float', 'bool', '__init__', 'lambda', 'yield', 'with', 'as', 'raise', 'assert', 'pass', 'break', 'continue', 'and', 'or', 'not', 'in', 'is', 'config', 'state', 'hass', 'entity', 'device', 'sensor', 'binary_sensor', 'switch', 'light', 'climate'"
SIGNS_SQL = r"\[\]{}()=<>+\-*/%&|^~!:;,.@#$"
SPLIT_SQL = r"list_filter(regexp_split_to_array({c}, '[ \t\n\r\x0B\f]+'), lambda x: x <> '')"
DENSITY_SQL = f"""
b AS (SELECT *, regexp_extract_all(reply, '\\{{[^}}]*\\}}') AS blocks, regexp_extract_all(reply, '(?s)```.*?```') AS fences FROM gold),
q AS (SELECT *, len(list_filter(flatten(list_transform(list_concat(blocks, fences), lambda p: regexp_split_to_array(p, '[ \\t\\n\\r\\x0B\\f]+'))), lambda x: x <> '')) + len(list_filter({SPLIT_SQL.format(c="lower(reply)")}, lambda w: w IN ({WORDS_SQL}))) + len(regexp_extract_all(reply, '[{SIGNS_SQL}]')) AS code,
  len(list_filter({SPLIT_SQL.format(c="regexp_replace(regexp_replace(reply, '(?s)```.*?```', '', 'g'), '{[^}]*}', '', 'g')").replace("'{[^}]*}'", "'[{][^}]*[}]'")}, lambda w: lower(w) NOT IN ({WORDS_SQL}) AND NOT regexp_matches(w, '^[{SIGNS_SQL}]+$'))) AS words FROM b)"""


@query("f25_false_negatives", f"WITH gold AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE '<think>' || text || '</think> do {{a: 1}}' END AS reply FROM documents), {DENSITY_SQL.strip()} SELECT doc_id, round(code / greatest(words, 1)::DOUBLE, 6) AS ldi FROM q WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) AND doc_id % 3 <> 0 AND length(regexp_replace(regexp_extract(reply, '(?s)<think>(.*?)</think>', 1), '^[ \\t\\n\\r\\x0B\\f]+|[ \\t\\n\\r\\x0B\\f]+$', '', 'g')) > 1000 AND code / greatest(words, 1)::DOUBLE < 2.5")
def f25(spark: SparkSession, d: str) -> DataFrame:
    reply = F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(F.concat(F.lit("<think>"), F.col("text"), F.lit("</think> do {a: 1}")))
    gold = table(spark, d, "documents").select("doc_id", reply.alias("reply"))
    return R.false_negatives(gold, table(spark, d, "labels").filter("quality = 1"), "doc_id").select("doc_id", F.round("ldi", 6).alias("ldi"))


@query("f24_ignored_reasons", "WITH r AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'json_decode_error' WHEN 1 THEN 'conversation_missing_or_not_list' WHEN 2 THEN 'conversation_entry_not_object' WHEN 3 THEN 'message_content_missing_or_non_string' WHEN 4 THEN CASE WHEN length(text) > 3000 THEN 'content_too_long' END ELSE CASE WHEN length(text) > 3000 THEN 'content_too_long' ELSE 'message_content_missing_or_non_string' END END AS reason FROM documents) SELECT doc_id, reason FROM r WHERE reason IS NOT NULL")
def f24(spark: SparkSession, d: str) -> DataFrame:
    k, q = F.col("doc_id") % 6, F.to_json(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    line = F.when(k == 0, F.concat(F.lit("{"), q)).when(k == 1, '{"conversation": {"a": 1}}').when(k == 2, '{"conversation": ["x"]}').when(k == 3, '{"conversation": [{"role": "user", "content": 5}]}')
    line = line.when(k == 4, F.concat(F.lit('{"conversation": ['), q, F.lit("]}"))).otherwise(F.concat(F.lit('{"conversation": ['), q, F.lit(', {"role": "user"}]}')))
    return table(spark, d, "documents").select("doc_id", R.ignored_reason(line, 3000).alias("reason")).filter("reason is not null")


@query("w13_typed_sample", "WITH x AS (SELECT doc_id, CASE WHEN doc_id % 60 = 0 THEN 'contrast' WHEN doc_id % 2 = 0 THEN 'nominal' WHEN doc_id % 3 = 0 THEN 'error_recovery' ELSE 'theory' END AS kind FROM documents), r AS (SELECT *, kind <> 'theory' AND row_number() OVER (PARTITION BY kind ORDER BY md5(doc_id || ':42')) <= 20 AS first FROM x), s AS (SELECT *, row_number() OVER (ORDER BY NOT first, md5(doc_id || ':42')) AS n FROM r) SELECT doc_id, kind FROM s WHERE n <= 60")
def w13(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("doc_id") % 60 == 0, "contrast").when(F.col("doc_id") % 2 == 0, "nominal").when(F.col("doc_id") % 3 == 0, "error_recovery").otherwise("theory")
    x = table(spark, d, "documents").select("doc_id", kind.alias("kind"))
    return S.typed_sample(x, "kind", ("nominal", "contrast", "error_recovery"), 60, S.seeded_order(F.col("doc_id"), 42))


@query("a10_grades", "WITH x AS (SELECT doc_id, doc_id * 7 % 1001 / 10.0 AS s FROM documents) SELECT CASE WHEN s >= 90 THEN 'A+' WHEN s >= 80 THEN 'A' WHEN s >= 70 THEN 'B' WHEN s >= 60 THEN 'C' WHEN s >= 50 THEN 'D' ELSE 'F' END AS grade, CASE WHEN s >= 90 THEN 'A' WHEN s >= 80 THEN 'B' WHEN s >= 70 THEN 'C' WHEN s >= 60 THEN 'D' WHEN s >= 50 THEN 'E' ELSE 'F' END AS report_grade, CASE WHEN s >= 80 THEN 'PASS' WHEN s >= 60 THEN 'CONDITIONAL' WHEN s >= 40 THEN 'WARN' ELSE 'FAIL' END AS verdict, count(*) AS n FROM x GROUP BY 1, 2, 3")
def a10(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("doc_id") * 7 % 1001 / 10.0
    return table(spark, d, "documents").select(A.grade(s).alias("grade"), A.grade(s, A.REPORT_GRADES).alias("report_grade"), A.verdict(s).alias("verdict")).groupBy("grade", "report_grade", "verdict").agg(F.count("*").alias("n"))


LANGUAGE = lambda ws: " + ".join(f"(length(t) - length(replace(t, '{w}', ''))) / {len(w)}.0::DOUBLE" for w in ws)


@query("t11_language_hint", f"WITH x AS (SELECT doc_id, lower(text || {sql_pick((' El sistema debe usar la vía', ' it will be this one and that', ' vamos', ''))}) AS t FROM documents) SELECT doc_id, CASE WHEN round({LANGUAGE((' el ', ' la ', ' que ', ' y ', ' para ', ' usar ', ' será ', ' debe ', 'vamos'))}) > round({LANGUAGE((' the ', ' and ', ' to ', ' is ', ' will ', ' this '))}) THEN 'Spanish' ELSE 'English' END AS hint FROM x")
def t11(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.col("text"), pick((" El sistema debe usar la vía", " it will be this one and that", " vamos", "")))
    return table(spark, d, "documents").select("doc_id", T.language_hint(t).alias("hint"))


@query("c7_mix", "WITH RECURSIVE s AS (SELECT doc_id, length(text) // 4 AS tokens FROM documents WHERE doc_id % 3 = 0), b AS (SELECT (sum(tokens) * 30.0::DOUBLE / 70)::BIGINT AS budget, floor(sum(tokens) * 30.0::DOUBLE / 70)::BIGINT AS whole FROM s), o AS (SELECT doc_id, length(text) // 4 AS tokens, row_number() OVER (ORDER BY doc_id) AS r FROM documents WHERE doc_id % 3 <> 0), g AS (SELECT 0::BIGINT AS r, (SELECT whole FROM b) AS budget, NULL::BIGINT AS took UNION ALL SELECT o.r, CASE WHEN o.tokens <= g.budget THEN g.budget - o.tokens ELSE g.budget END, CASE WHEN o.tokens <= g.budget THEN o.doc_id END FROM g JOIN o ON o.r = g.r + 1) SELECT doc_id, tokens, false AS is_anchor FROM s UNION ALL SELECT o.doc_id, o.tokens, true FROM o JOIN g ON g.took = o.doc_id")
def c7(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "documents").select("doc_id", F.expr("length(text) div 4").alias("tokens"))
    return S.mix(x.filter("doc_id % 3 = 0"), x.filter("doc_id % 3 <> 0"), "doc_id", "tokens", 70, 30).drop("place_key")
