"""Curation: exact duplicates, the structural gate, validation, format normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

MESSAGES = "array<struct<role:string,content:string>>"


def records_from_turns(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """Turns as one record each conversation, in the order of their numbers."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col(role).alias("role"), F.col(content).alias("content"))))
    return turns.groupBy(key).agg(F.transform(rows, lambda r: F.struct(r["role"].alias("role"), r["content"].alias("content"))).alias("conversation"))


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """One row of each key: the first by ``order`` (null first), of rows that tie the first by a digest, of equal rows
    any. An aggregation finds the firsts, so a key that many rows share is summed up where the rows are before anything
    is shuffled; a semi join on order and digest fetches the rows, and equal rows meet on the same exchange."""
    marked = df.withColumn("__digest", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    firsts = marked.groupBy(key.alias("__key")).agg(F.min(F.struct(F.col(order).alias("o"), F.col("__digest").alias("d"))).alias("f"))
    firsts = firsts.select(F.col("f.o").alias("__o"), F.col("f.d").alias("__d"))
    kept = marked.join(firsts, F.col(order).eqNullSafe(F.col("__o")) & (F.col("__digest") == F.col("__d")), "left_semi")
    return kept.dropDuplicates([order, "__digest"]).drop("__digest")


def exact_dedup_texts(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    return keep_first(df, F.sha2(F.col(text), 256), order)


def exact_dedup_records(df: DataFrame, conversation: str = "conversation", order: str = "conv_id") -> DataFrame:
    """First record of each conversation. Records without one are a class of their own (null)."""
    return keep_first(df, F.sha2(F.to_json(F.struct(F.col(conversation))), 256), order)


def assistant_text(conversation: Column, sep: str = " ") -> Column:
    turns = F.filter(conversation, lambda m: m["role"] == "assistant")
    return F.array_join(F.transform(turns, lambda m: F.coalesce(m["content"], F.lit(""))), sep)


def best_text(flat: list[Column], conversation: Column, thought: Column) -> Column:
    """The first of the flat columns that is not blank, else the assistant's turns, else the thought."""
    turns = F.filter(conversation, lambda m: m["role"] == "assistant")
    spoken = F.when(F.size(turns) > 0, T.strip(F.array_join(F.transform(turns, lambda m: T.strip(F.coalesce(m["content"], F.lit("")))), "\n")))
    some = [F.nullif(T.strip(c), F.lit("")) for c in flat]
    return F.coalesce(*some, spoken, F.nullif(T.strip(thought), F.lit("")), F.lit(""))


def first_turn(conversation: Column, role: str) -> Column:
    return F.try_element_at(F.transform(F.filter(conversation, lambda m: F.lower(m["role"]).contains(role)), lambda m: m["content"]), F.lit(1))


def structural_reason(conversation: Column, least_think: int = 500, least_density: float = 0.15) -> Column:
    """Why a record fails the structural gate: the first reason, or null."""
    turns = F.filter(conversation, lambda m: m["role"] == "assistant")
    texts = F.transform(turns, lambda m: m["content"])
    closed = lambda t: t.contains("<think>") & t.contains("</think>")
    apart = lambda t: closed(t) & (t.rlike(r"</think>\s+<tool_call>") | (t.contains("<tool_call>") & ~t.contains("</think><tool_call>")))
    think_turn = F.try_element_at(F.filter(texts, lambda t: t.contains("<think>")), F.lit(1))
    think = F.try_element_at(F.regexp_extract_all(think_turn, F.lit("(?s)<think>(.*?)</think>"), 1), F.lit(1))
    call = F.try_element_at(F.regexp_extract_all(think_turn, F.lit("(?s)<tool_call>(.*?)</tool_call>"), 1), F.lit(1))
    return (
        F.when(F.coalesce(F.size(turns), F.lit(0)) <= 0, "invalid_syntax")
        .when(F.exists(texts, apart), "invalid_syntax")
        .when(think_turn.isNull(), F.lit(None).cast("string"))
        .when(think.isNull(), "invalid_syntax")
        .when(F.char_length(T.strip(think)) < least_think, "shallow_thinking")
        .when(T.meta_speech(T.strip(think)), "meta_speech")
        .when(call.isNull(), "invalid_syntax")
        .when(T.logic_density(T.strip(call)) < least_density, "low_ldi")
    )


def validate_and_dedup(df: DataFrame, messages: str = "messages", order: str = "_seq") -> DataFrame:
    """Adds tool_format and reason: tool_call_content, duplicate of an earlier valid record, or null for kept ones."""
    m = F.col(messages)
    marked = df.withColumn("tool_format", T.tool_format(m)).withColumn("__bad", T.has_tool_call(m))
    key = F.sha2(F.to_json(F.transform(m, lambda x: F.struct(x["role"].alias("role"), T.collapse_space(x["content"]).alias("content")))), 256)
    marked = marked.withColumn("__key", key)
    firsts = marked.filter("not __bad").groupBy("__key").agg(F.min(order).alias("__first"))
    reason = F.when(F.col("__bad"), "tool_call_content").when(F.col(order) != F.col("__first"), "duplicate")
    return marked.join(firsts, "__key", "left").withColumn("reason", reason).drop("__bad", "__key", "__first")


def detect_format(messages: Column, conversations: Column, instruction: Column, output: Column) -> Column:
    return F.when(messages.isNotNull(), "openai_messages").when(conversations.isNotNull(), "sharegpt").when(instruction.isNotNull() & output.isNotNull(), "alpaca").otherwise("unknown")


def normalize_messages(fmt: Column, messages: Column, conversations: Column, instruction: Column, input_: Column, output: Column) -> Column:
    """Messages of role and content; null (quarantine) where a turn lacks either or the format is unknown."""
    roles = F.create_map(*[F.lit(x) for x in ("human", "user", "gpt", "assistant", "tool", "tool", "system", "system")])
    said = F.when(F.coalesce(input_, F.lit("")) != "", F.concat(instruction, F.lit("\n\n"), input_)).otherwise(instruction)
    message = lambda role, content: F.struct(role.alias("role"), content.alias("content"))
    alpaca = F.array(message(F.lit("user"), said), message(F.lit("assistant"), output))
    shared = F.when(~F.exists(conversations, lambda t: t["from"].isNull() | t["value"].isNull()), F.transform(conversations, lambda t: message(F.coalesce(F.try_element_at(roles, t["from"]), t["from"]), t["value"])))
    plain = F.when(~F.exists(messages, lambda t: t["role"].isNull() | t["content"].isNull()), messages)
    return F.when(fmt == "alpaca", alpaca).when(fmt == "sharegpt", shared).when(fmt == "openai_messages", plain)
