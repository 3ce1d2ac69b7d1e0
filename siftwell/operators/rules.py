"""Rules on generated records: legacy and poison patterns, signatures of old PHP code, what a reply reasons and does,
rewrite strategies, audit flags and health pillars. All are Column expressions; pattern tables are small literals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Legacy patterns of programs, and what they should be replaced by.
LEGACY_PROGRAM = (
    (r"hass\.data\[", "hass.data[] dict pattern -> entry.runtime_data"),
    (r"hass\.data\.setdefault", "hass.data.setdefault() -> entry.runtime_data"),
    (r"\bTEMP_CELSIUS\b|\bTEMP_FAHRENHEIT\b|\bTEMP_KELVIN\b", "Legacy TEMP_* constants -> UnitOfTemperature enum"),
    (r"\bUNIT_PERCENTAGE\b|\bPERCENTAGE\b(?=\s*[,\)])", "Legacy UNIT_PERCENTAGE -> UnitOfMeasurement enum"),
    (r"\bLENGTH_METERS\b|\bLENGTH_KILOMETERS\b|\bLENGTH_MILES\b", "Legacy LENGTH_* constants -> UnitOfLength enum"),
    (r"\bMASS_GRAMS\b|\bMASS_KILOGRAMS\b|\bVOLUME_LITERS\b", "Legacy MASS_*/VOLUME_* constants -> UnitOf* enums"),
    (r"\bPRESSURE_BAR\b|\bPRESSURE_PA\b|\bPRESSURE_HPA\b", "Legacy PRESSURE_* constants -> UnitOfPressure enum"),
    (r"\bENERGY_KILO_WATT_HOUR\b|\bENERGY_WATT_HOUR\b|\bPOWER_WATT\b|\bPOWER_KILO_WATT\b", "Legacy ENERGY_*/POWER_* -> UnitOfEnergy/UnitOfPower enums"),
    (r"async_forward_entry_setup\b(?!s)", "Singular async_forward_entry_setup -> async_forward_entry_setups"),
    (r"""device_class\s*=\s*["'](?:temperature|humidity|pressure|energy|power|battery|voltage|current)""", "String literal device_class -> SensorDeviceClass/BinarySensorDeviceClass enum"),
    (r"""_attr_device_class\s*=\s*["']""", "String _attr_device_class -> Enum"),
    (r"def update\(self\)", "Synchronous update(self) -> CoordinatorEntity + async"),
    (r"def\s+async_update\(self\)", "Direct async_update -> CoordinatorEntity pattern"),
    (r"PLATFORM_SCHEMA\s*=", "YAML-only PLATFORM_SCHEMA -> ConfigFlow required"),
    (r"requests\.get\(|requests\.post\(|requests\.put\(|requests\.delete\(", "Blocking requests.* in code -> aiohttp/async_add_executor_job"),
    (r"(?<!await\s)time\.sleep\(", "Blocking time.sleep() -> await asyncio.sleep()"),
    (r"urllib\.request\.urlopen", "Blocking urllib -> aiohttp"),
    (r"\bself\._state\s*=", "Legacy self._state = X -> native_value property"),
    (r"\bself\._attr_state\s*=", "Legacy self._attr_state -> native_value property"),
    (r"@property\s*\n\s*def\s+state\(self\)", "Legacy state property -> native_value"),
    (r"add_entities\(\[.*\]\s*,\s*True\)", "Legacy polling=True -> CoordinatorEntity"),
)
# Legacy patterns of templates, read line by line.
LEGACY_TEMPLATE = (
    (r"^\s*trigger:\s*$", "Singular 'trigger:' -> 'triggers:' (2024.10)"),
    (r"^\s*condition:\s*$", "Singular 'condition:' -> 'conditions:' (2024.10)"),
    (r"^\s*action:\s*$", "Singular 'action:' -> 'actions:' (2024.10)"),
    (r"^\s*-\s*platform:\s*(?:state|numeric_state|time|event|mqtt|webhook|sun|zone|tag)\b", "Legacy 'platform:' in trigger -> 'trigger:' (2024.10)"),
    (r"\bthis\.state\b", "Legacy this.state -> use 'value' variable (2024.12)"),
    (r"\bthis\.attributes\b", "Legacy this.attributes -> use 'value' or new 'this' semantics (2024.12)"),
    (r"""==\s*['"](?:[A-Z][a-z]+\s+[A-Z]|[A-Z]{2,}[a-z])""", "Non-snake_case state format -> migrate to snake_case (2024.12)"),
    (r"or\s+None\s*[%}]", "Implicit None in binary_sensor -> use explicit 'false' (2025.8)"),
    (r"""is_state\([^)]*['"]standby['"]""", "State 'standby' removed -> use 'off' (2025.8)"),
    (r"""state_attr\([^)]*['"]battery_level['"]""", "Attribute 'battery_level' removed -> use dedicated sensor (2025.8)"),
    (r"""state_attr\([^)]*['"]battery['"]""", "Attribute 'battery' removed -> use dedicated sensor (2025.8)"),
    (r"platform:\s*template", "Legacy 'platform: template' -> root 'template:' syntax (2025.12, dies 2026.6)"),
    (r"value_template:", "Legacy 'value_template:' -> use 'state:' in modern syntax (2025.12)"),
    (r"\|\s*float\s*[^(]", "float without default -> use '| float(0)' with default value"),
    (r"\|\s*int\s*[^(]", "int without default -> use '| int(0)' with default value"),
    (r"\bas_timestamp\b", "as_timestamp (epoch float) -> prefer as_datetime (timezone-aware)"),
)
# What generated code must not hold, read line by line.
POISON = (
    (r"\{\{-?\s*None\s*-?\}\}", "Output returns None (must be false, HA 2025.8)"),
    (r"\bas_timestamp\s*\(", "Output uses as_timestamp() (deprecated, use as_datetime)"),
    (r"platform:\s*template", "Output uses 'platform: template' (deprecated 2025.12)"),
    (r"^\s*trigger:\s*\n\s*-", "Output uses singular 'trigger:' (deprecated 2024.10)"),
    (r"^\s*condition:\s*\n\s*-", "Output uses singular 'condition:' (deprecated 2024.10)"),
    (r"^\s*action:\s*\n\s*-", "Output uses singular 'action:' (deprecated 2024.10)"),
    (r"\{\{-?\s*func\s*\(", "Output invokes func() as callable (impossible in Jinja2)"),
    (r"\{\{-?\s*_\w+\s*\(", "Output calls undefined private helper (_helper())"),
)
# The audit's own patterns, keywords and limits.
AUDIT_LEGACY = (
    r"hass\.data\[",
    r"hass\.data\.setdefault",
    r"\bTEMP_CELSIUS\b|\bTEMP_FAHRENHEIT\b|\bTEMP_KELVIN\b",
    r"async_forward_entry_setup\b",
    r"requests\.get\(|requests\.post\(|requests\.put\(|requests\.delete\(",
    r"(?<!await\s)time\.sleep\(",
    r"urllib\.request\.urlopen",
    r"\bself\._state\s*=\b",
)
BLOCKING = (r"requests\.", r"time\.sleep\(", r"urllib\.request")
ASYNC_SIGNALS = (r"\bawait\b", r"\basyncio\b", "async_add_executor_job", "no blocking", "avoid blocking", "non-blocking")
KEYWORDS = ("CoordinatorEntity", "entry.runtime_data", "async_forward_entry_setups", "async_add_executor_job", "await asyncio", "ConfigFlow", "EntityDescription")
GOLD_LEAST_CHARS, GOLD_PLACEHOLDER = 180, "Expert HA 2026 Implementation"
# Patterns of old PHP code by category.
SIGNATURES = {
    "PERSISTENCE_SMELL": (
        ("mysql_query", r"mysql_query\s*\("),
        ("tep_db_query", r"tep_db_query\s*\("),
        ("wpdb_query", r"\$wpdb->query\s*\("),
        ("wpdb_prepare", r"\$wpdb->prepare\s*\("),
        ("wpdb_get_results", r"\$wpdb->get_results\s*\("),
        ("zen_db_perform", r"zen_db_perform\s*\("),
        ("Mage_getModel", r"Mage::getModel\s*\("),
        ("db_query", r"\$db->query\s*\("),
    ),
    "STATE_POLLUTION": (
        ("global_var", r"global\s+\$\w+"),
        ("session_access", r"\$_SESSION\s*\["),
        ("cookie_access", r"\$_COOKIE\s*\["),
        ("globals_access", r"\$GLOBALS\s*\["),
        ("tep_session_register", r"tep_session_register\s*\("),
        ("tep_redirect", r"\btep_redirect\s*\("),
        ("post_access", r"\$_POST\s*\["),
        ("get_access", r"\$_GET\s*\["),
        ("request_access", r"\$_REQUEST\s*\["),
    ),
    "MODULE_LINK_SMELL": (
        ("include", r"\binclude\b(?!_once)"),
        ("include_once", r"\binclude_once\b"),
        ("require", r"\brequire\b(?!_once)"),
        ("require_once", r"\brequire_once\b"),
        ("path_concat_include", r"""include\s*\.\s*['"]"""),
    ),
    "SECURITY_VULN": (
        ("concat_sql", r"""mysql_query\s*[^;]*\.\s*["']"""),
        ("echo_get", r"echo\s+\$_(GET|POST|REQUEST)\s*\["),
        ("eval_usage", r"eval\s*\("),
        ("dynamic_include", r"include\s*\$\w+"),
        ("preg_replace_eval", r"preg_replace\s*\([^,]+,\s*/(e|eval)"),
        ("ajax_referer_no_die", r"\bcheck_ajax_referer\s*\("),
        ("unescaped_json_error", r"\bwp_send_json_error\s*\("),
    ),
    "CONSTANT_POLLUTION": (("define", r"define\s*\("), ("dir_ws_constant", r"DIR_WS_\w+"), ("dir_fs_constant", r"DIR_FS_\w+"), ("table_constant", r"TABLE_\w+")),
    "MODERN_HYBRID": (
        ("namespace", r"namespace\s+\w+"),
        ("use_statement", r"^use\s+\w+"),
        ("class_extends", r"class\s+\w+\s+extends"),
        ("class_implements", r"class\s+\w+\s+implements"),
        ("php8_construct", r"->__construct\s*\("),
        ("add_action", r"\badd_action\s*\("),
        ("add_filter", r"\badd_filter\s*\("),
        ("apply_filters", r"\bapply_filters\s*\("),
        ("register_hook", r"\bregister_activation_hook\s*\("),
    ),
}
SEVERITY = {"SECURITY_VULN": "critical", "PERSISTENCE_SMELL": "warning", "STATE_POLLUTION": "warning", "MODULE_LINK_SMELL": "info", "CONSTANT_POLLUTION": "info", "MODERN_HYBRID": "info"}
# Terms and phrases that a hard query must not hold, and its objectives by category keyword.
FORBIDDEN_TERMS = ("async_forward_entry_setups", "DataUpdateCoordinator", "llama al servicio", "usa el componente", "async_setup_entry")
IMPERATIVES = ("implementa usando", "crea una clase", "define la función", "sigue estos pasos", "primero haz", "después haz", "para resolver esto:", "necesitas usar", "debes usar")
OBJECTIVES = (
    ("coordinator", "El sistema debe coordinar actualizaciones de datos automáticamente"),
    ("integration", "El sistema debe integrar componentes de forma autónoma"),
    ("entity", "El sistema debe gestionar entidades con verificación de tipos"),
    ("protocol", "El sistema debe implementar protocolos de comunicación"),
    ("websocket", "El sistema debe mantener comunicación bidireccional"),
    ("bluetooth", "El sistema debe recibir datos de dispositivos externos"),
    ("rest", "El sistema debe consumir servicios externos"),
)
# Words and signs of the density that the analyser of false negatives measures.
ANALYSER_WORDS = (
    "def", "class", "import", "from", "return", "if", "else", "elif", "for", "while", "try", "except", "async", "await", "self", "None", "True", "False", "dict", "list", "str", "int", "float", "bool",
    "__init__", "lambda", "yield", "with", "as", "raise", "assert", "pass", "break", "continue", "and", "or", "not", "in", "is", "config", "state", "hass", "entity", "device", "sensor", "binary_sensor",
    "switch", "light", "climate",
)
ANALYSER_SIGNS = r"\[\]{}()=<>+\-*/%&|^~!:;,.@#$"

# ------------------------------------------------------------------------------------------ patterns


def any_of(c: Column, patterns, flags: str = "") -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.rlike(flags + p)
    return out


def how_many(c: Column, patterns, flags: str = "") -> Column:
    """How many of the patterns occur."""
    return sum((c.rlike(flags + p).cast("int") for p in patterns), F.lit(0))


def found(c: Column, rules, flags: str = "") -> Column:
    """The descriptions of the rules (pattern, description) that match."""
    return F.array_compact(F.array(*[F.when(c.rlike(flags + p), F.lit(d)) for p, d in rules]))


def legacy_patterns(code: Column, is_template: Column) -> Column:
    """Descriptions of the legacy patterns in a program or a template."""
    return F.when(is_template, found(code, LEGACY_TEMPLATE, "(?m)")).otherwise(found(code, LEGACY_PROGRAM))


def output_poison(code: Column) -> Column:
    return found(code, POISON, "(?m)")


def signatures(df: DataFrame, key: str, code: str, platform: dict | None = None) -> DataFrame:
    """A row for each line and pattern of old code that it holds, with category and severity. ``platform`` adds patterns
    by category."""
    rules = [(n, c, p) for c, ps in SIGNATURES.items() for n, p in (*ps, *(platform or {}).get(c, ()))]
    lines = df.select(key, F.posexplode(F.split(code, "\n")).alias("at", "line"))
    hit = lambda n, c, p: F.when(F.col("line").rlike(p), F.struct(F.lit(n).alias("pattern_name"), F.lit(c).alias("category"), F.lit(SEVERITY.get(c, "info")).alias("severity")))
    hits = F.array_compact(F.array(*[hit(*r) for r in rules]))
    return lines.select(key, (F.col("at") + 1).cast("long").alias("line_number"), T.strip(F.col("line")).alias("matched_text"), F.explode(hits).alias("x")).select(key, "line_number", "matched_text", "x.*")


# ------------------------------------------------------------------------------------------ parts of a reply


def before(c: Column, mark: str) -> Column:
    return F.when(c.contains(mark), F.substring_index(c, mark, 1)).otherwise(c)


def after(c: Column, mark: str) -> Column:
    return F.when(c.contains(mark), F.substring(c, F.instr(c, mark) + len(mark), F.char_length(c))).otherwise("")


def reasoning(raw: Column) -> Column:
    """What is thought: between the tags, or before the closing one; empty without it."""
    opened = F.when(raw.contains("<think>"), after(raw, "<think>")).otherwise(raw)
    return F.when(raw.contains("</think>"), T.strip(before(opened, "</think>"))).otherwise("")


def _contents(block: Column) -> Column:
    """Contents of the calls in a block: an object or a list of them; if it is no JSON, its <content>, or itself."""
    v = F.try_parse_json(block)
    one = F.when(v.isNotNull(), F.try_variant_get(v, "$.arguments.content", "string"))
    many = F.try_variant_get(v, "$", "array<struct<arguments: struct<content: string>>>")
    inner = F.regexp_extract(block, r"(?s)<content>(.*?)</content>", 1)
    plain = F.when(block.rlike(r"(?s)<content>.*?</content>"), T.strip(inner)).otherwise(block)
    return F.when(v.isNull(), F.array(plain)).when(F.schema_of_variant(v).startswith("ARRAY"), F.array_compact(F.transform(many, lambda x: x["arguments"]["content"]))).otherwise(F.array_compact(F.array(one)))


def action_text(raw: Column, filter_text: Column) -> Column:
    """What is done: contents of tool calls, then of write actions, then all that follows the thought."""
    combined = F.concat(F.coalesce(raw, F.lit("")), F.lit("\n"), F.coalesce(filter_text, F.lit("")))
    blocks = F.concat(*[F.transform(F.regexp_extract_all(combined, F.lit(rf"(?s)<{t}>(.*?)</{t}>"), 1), T.strip) for t in ("tool_call", "write_action")])
    said = F.when(raw.contains("</think>"), F.array(after(raw, "</think>"))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(F.flatten(F.transform(blocks, _contents)), said), "\n\n")


def executable_code(c: Column) -> Column:
    """Fenced blocks and contents of tool calls, joined by newlines; the text itself if it has neither."""
    fenced = F.regexp_extract_all(c, F.lit(r"(?s)```(?:\w+)?\n?(.*?)```"), 1)
    calls = F.filter(F.transform(F.regexp_extract_all(c, F.lit(r"(?is)<tool_call>(.*?)</tool_call>"), 1), T.strip), lambda b: F.try_parse_json(b).isNotNull())
    code = F.concat(fenced, F.filter(F.flatten(F.transform(calls, _contents)), lambda x: x != ""))
    return F.when(F.size(code) > 0, F.array_join(code, "\n")).otherwise(c)


def strip_comments(c: Column) -> Column:
    """From the first # of each line on, with the space before it."""
    return F.regexp_replace(c, r"(?m)[ \t]*#.*$", "")


# ------------------------------------------------------------------------------------------ rewriting


def eligible(example_type: Column, conversation: Column, excluded=("theory",), most_tokens: int = 4000) -> Column:
    """Whether a record may be rewritten: a type not excluded, at most so many tokens of four characters, a closed
    thought in its first assistant turn."""
    chars = F.aggregate(conversation, F.lit(0), lambda a, m: a + F.char_length(F.coalesce(m["content"], F.lit(""))))
    reply = F.try_element_at(F.filter(conversation, lambda m: m["role"] == "assistant"), F.lit(1))["content"]
    kept = ~F.coalesce(example_type, F.lit("")).isin(*excluded)
    return kept & (F.floor(chars / 4) <= most_tokens) & F.coalesce(reply.contains("</think>"), F.lit(False))


def strategy(example_type: Column, legacy: Column, gold: Column) -> Column:
    return (
        F.when(example_type == "theory", "skip")
        .when(F.coalesce(legacy, F.lit(False)), "full_backtracking")
        .when(F.coalesce(gold, F.lit(False)), "trace_reconstruction")
        .when(example_type == "error_recovery", "error_first")
        .when(example_type == "contrast", "contrast_backtracking")
        .otherwise("pass_through")
    )


def resolution_is_clean(thought: Column, rest: Column, patterns=AUDIT_LEGACY) -> Column:
    """Whether neither the code of the thought's second half nor that after it holds a legacy pattern; comments do not
    count."""
    half = F.substring(thought, F.floor(F.char_length(thought) / 2).cast("int") + 1, F.char_length(thought))
    return ~any_of(strip_comments(executable_code(half)), patterns) & ~any_of(strip_comments(executable_code(rest)), patterns)


# ------------------------------------------------------------------------------------------ audit


def audit(df: DataFrame) -> DataFrame:
    """Adds what the audit says of each record of (user_text, raw, filter_text, gold_injected, fragment_name,
    source_file): flags as an array, gold_label, and the measures of the health pillars."""
    x = df.withColumn("reasoning", reasoning(F.col("raw"))).withColumn("action", action_text(F.col("raw"), F.col("filter_text")))
    a, r, gold = F.col("action"), F.col("reasoning"), F.coalesce("gold_injected", F.lit(False))
    signal = "(?i)" + "|".join(ASYNC_SIGNALS)
    blocking, poison, legacy = any_of(a, BLOCKING), how_many(a, [p for p, _ in POISON], "(?m)"), how_many(a, AUDIT_LEGACY)
    bad_gold = gold & ((F.char_length(T.strip(a)) < GOLD_LEAST_CHARS) | a.contains(GOLD_PLACEHOLDER) | T.strip(a).startswith("..."))
    flags = [F.when(legacy > 0, "legacy"), F.when(blocking, "blocking"), F.when(blocking & r.rlike(signal), "contradiction"), F.when(poison > 0, "poison"), F.when(bad_gold, "gold_problem")]
    guess = F.when(blocking, "gold injection").when(a.rlike(signal), "gold skiping").otherwise("unknown")
    label = F.when(F.col("gold_injected").isNull(), guess).when(gold, "gold injection").otherwise("gold skiping")
    named = lambda c: F.coalesce((F.col(c) != "") & F.lower("user_text").contains(F.lower(c)), F.lit(False))
    hits = sum((F.lower(r).contains(k.lower()).cast("int") for k in KEYWORDS), F.lit(0))
    return x.select(
        *df.columns,
        F.array_compact(F.array(*flags)).alias("flags"),
        label.alias("gold_label"),
        F.char_length(r).alias("reasoning_len"),
        hits.alias("keyword_hits"),
        F.char_length(F.coalesce("filter_text", F.lit(""))).alias("filter_len"),
        (named("fragment_name") | named("source_file")).alias("alignment"),
        bad_gold.alias("gold_problem"),
        (poison + legacy).alias("violations"),
    )


def health(audited: DataFrame, *by: str) -> DataFrame:
    """The five pillars, 0 to 20 each, and their sum."""
    n, hits, f = F.col("reasoning_len"), F.col("keyword_hits"), F.col("filter_len")
    pillars = {
        "contextual_alignment": F.col("alignment").cast("double"),
        "reasoning_quality": 0.6 * F.least(n, F.lit(500)) / 500 + 0.4 * F.least(hits / 3, F.lit(1.0)),
        "gold_injection_integrity": F.when(~F.coalesce("gold_injected", F.lit(False)), F.when(n > 100, 1.0).otherwise(0.8)).otherwise(F.when(F.col("gold_problem"), 0.0).otherwise(1.0)),
        "distillation_efficacy": F.when(n == 0, F.when(f < 100, 0.3).otherwise(0.6)).otherwise(0.6 * F.least(f / F.greatest(n, F.lit(1)), F.lit(1.0)) + 0.4 * ((hits > 0) & (f > 0)).cast("double")),
        "law_compliance": F.greatest(F.lit(0.0), 1.0 - F.least(F.col("violations"), F.lit(3)) / 3.0),
    }
    out = audited.groupBy(*by).agg(F.count("*").alias("sample_size"), *[F.round(F.avg(c) * 20, 2).alias(k) for k, c in pillars.items()])
    return out.withColumn("health_score", F.round(sum((F.col(k) for k in pillars), F.lit(0.0)), 2))


def flag_counts(audited: DataFrame) -> DataFrame:
    """Records by flag and gold label."""
    return audited.select(F.explode("flags").alias("flag"), "gold_label").groupBy("flag", "gold_label").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------------------------------ hard queries, densities


def query_is_valid(c: Column) -> Column:
    """Whether a hard query names no forbidden term and gives no orders."""
    low, out = F.lower(c), F.lit(True)
    for t in (*FORBIDDEN_TERMS, *IMPERATIVES):
        out = out & ~low.contains(t.lower())
    return out


def objective(category: Column) -> Column:
    """The objective of a category: of the first keyword that it holds, else made of its words."""
    out = F.concat(F.lit("El sistema debe manejar "), F.replace(category, F.lit("_"), F.lit(" ")), F.lit(" de forma autónoma"))
    for word, text in reversed(OBJECTIVES):
        out = F.when(F.lower(category).contains(word), text).otherwise(out)
    return out


def analyser_density(c: Column) -> Column:
    """Code to natural words: words of braces and fences, code words and signs, over all other words outside them."""
    total = lambda parts: F.aggregate(F.transform(parts, lambda p: F.size(T.words(p))), F.lit(0), lambda a, n: a + n)
    blocks, fences = F.regexp_extract_all(c, F.lit(T.JSON_BLOCK), 0), F.regexp_extract_all(c, F.lit(T.FENCE), 0)
    known = F.size(F.filter(T.words(F.lower(c)), lambda w: w.isin(*ANALYSER_WORDS)))
    code = total(blocks) + total(fences) + known + F.regexp_count(c, F.lit(f"[{ANALYSER_SIGNS}]"))
    rest = F.regexp_replace(F.regexp_replace(c, T.FENCE, ""), T.JSON_BLOCK, "")
    natural = F.size(F.filter(T.words(rest), lambda w: ~F.lower(w).isin(*ANALYSER_WORDS) & ~w.rlike(f"^[{ANALYSER_SIGNS}]+$")))
    return code / F.greatest(natural, F.lit(1))


def ignored_density(c: Column) -> Column:
    """The report's ratio: code tokens over natural ones, 99.9 without any; its word lists lack the domain's words."""
    words = T.CODE_WORDS[: T.CODE_WORDS.index("export") + 1]
    natural = T.natural_tokens(c, ("async", "await", "def", "class", "import", "from", "return", "true", "false", "none", "self", "super", "function", "const"))
    return F.when(natural == 0, F.lit(99.9)).otherwise(T.code_tokens(c, words) / natural)


def false_negatives(gold: DataFrame, platinum: DataFrame, key: str = "id", reply: str = "reply") -> DataFrame:
    """Records of ``gold`` that ``platinum`` lacks although they think over 1,000 characters and are thin in code."""
    think = T.strip(F.regexp_extract(reply, r"(?s)<think>(.*?)</think>", 1))
    x = gold.join(platinum.select(key), key, "left_anti").withColumn("think_length", F.char_length(think))
    return x.filter("think_length > 1000").withColumn("ldi", analyser_density(F.col(reply))).filter("ldi < 2.5")


def ignored_reason(line: Column, most: int = 20_000) -> Column:
    """Why a JSON record is ignored: the first reason, null if it is not."""
    v = F.try_parse_json(line)
    turns = F.try_variant_get(v, "$.conversation", "array<variant>")
    kind = lambda x: F.coalesce(F.schema_of_variant(x), F.lit("VOID"))
    content = lambda m: F.try_variant_get(m, "$.content", "variant")
    reason = lambda m: (
        F.when(~kind(m).startswith("OBJECT"), "conversation_entry_not_object")
        .when(kind(content(m)) != "STRING", "message_content_missing_or_non_string")
        .when(F.char_length(F.try_variant_get(m, "$.content", "string")) > most, "content_too_long")
    )
    return F.when(v.isNull(), "json_decode_error").when(turns.isNull(), "conversation_missing_or_not_list").otherwise(F.try_element_at(F.filter(F.transform(turns, reason), lambda r: r.isNotNull()), F.lit(1)))


def ignored(df: DataFrame, order: str, line: str, most: int = 50) -> DataFrame:
    """The first ``most`` ignored records by order: a top-k report."""
    x = df.filter(T.strip(F.col(line)) != "").select(order, ignored_reason(F.col(line)).alias("reason"))
    return x.filter("reason is not null").orderBy(order).limit(most)
