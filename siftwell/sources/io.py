"""Scans and sinks: JSON lines, JSON documents, tab-separated registries, source trees, split outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str, mode: str = "skip", first: int | None = None) -> DataFrame:
    """JSON lines. Blank lines are passed over. Malformed ones are skipped, kept in ``_corrupt`` (mode "mark"), or end
    the read (mode "strict")."""
    reader = spark.read.schema(schema)
    if mode == "strict":
        df = reader.option("mode", "FAILFAST").json(path)
    elif mode == "mark":
        lines = spark.read.text(path).filter(F.trim("value") != "")
        parsed = F.from_json("value", schema, {"mode": "PERMISSIVE"})
        df = lines.select(parsed.alias("r"), F.when(F.expr("try_parse_json(value)").isNull(), F.col("value")).alias("_corrupt")).select("r.*", "_corrupt")
    else:
        df = reader.option("mode", "DROPMALFORMED").json(path)
    return df if first is None else df.limit(first)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines; a reader sees all files or none (the commit protocol renames them at the end)."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_records(spark: SparkSession, path: str, records: StructType | str) -> DataFrame:
    """A JSON document with a list under ``records``."""
    doc = spark.read.option("multiLine", True).schema(f"records array<{records}>" if isinstance(records, str) else StructType().add("records", f"array<{records.simpleString()}>")).json(path)
    return doc.select(F.inline("records"))


def read_registry(spark: SparkSession, path: str, last: int | None = None, **equals: str) -> DataFrame:
    """A tab-separated registry with a header; equality filters; the last n rows by ``timestamp``."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    for name, value in equals.items():
        df = df.filter(F.col(name) == value)
    return df if last is None else df.orderBy(F.desc("timestamp")).limit(last)


def write_registry(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("sep", "\t").option("header", True).csv(path)


def read_tree(spark: SparkSession, path: str, pattern: str = "*", ignore: tuple[str, ...] = (".git", "node_modules", "__pycache__", "vendor")) -> DataFrame:
    """Files under a folder by name pattern, without those below ignored folders; text as UTF-8, else Latin-1; null
    for binary files (more than 30 % control characters)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    files = files.filter(~F.arrays_overlap(F.split("path", "/"), F.array(*[F.lit(i) for i in ignore])))
    raw = F.decode("content", "ISO-8859-1")
    control = F.regexp_count(raw, F.lit(r"[\x00-\x08\x0E-\x1F]")) / F.greatest(F.length("content"), F.lit(1))
    text = F.when(control > 0.30, F.lit(None)).when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string")).otherwise(raw)
    return files.select("path", "length", text.alias("text"))


def write_split(df: DataFrame, accepted: Column, path: str) -> None:
    """Accepted and rejected rows in one pass, as partitions of one table."""
    df.withColumn("status", F.when(accepted, "accepted").otherwise("rejected")).write.partitionBy("status").json(path)


def prometheus(df: DataFrame, metric: str, labels: list[str], value: str) -> DataFrame:
    """Text exposition: one line for each row."""
    tags = F.concat_ws(",", *[F.concat(F.lit(f'{k}="'), F.col(k).cast("string"), F.lit('"')) for k in labels])
    return df.select(F.concat(F.lit(metric + "{"), tags, F.lit("} "), F.col(value).cast("string")).alias("line"))


def chat_lines(df: DataFrame, system: str, question: str, answer: str) -> DataFrame:
    """Three-turn chat records as JSON text."""
    turn = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    return df.select(F.to_json(F.struct(F.array(turn("system", F.lit(system)), turn("user", F.col(question)), turn("assistant", F.col(answer))).alias("messages"))).alias("line"))
