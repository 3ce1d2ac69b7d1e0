"""Source text: dependencies, fragments, includes, signatures. Parsing is a per-row Arrow function; the rest is
expressions."""

from __future__ import annotations

import ast
import re
import sys

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPENDENCY = "array<struct<name:string,module_type:string>>"


def _kind(name: str, level: int) -> str:
    if level:
        return "relative"
    return "stdlib" if name.split(".")[0] in sys.stdlib_module_names else "external"


def imports_of(source: str) -> list[dict]:
    """Imported modules in order, each once; by pattern if the text does not parse."""
    found: dict[tuple[str, str], None] = {}
    try:
        nodes = sorted((n for n in ast.walk(ast.parse(source)) if isinstance(n, ast.Import | ast.ImportFrom)), key=lambda n: (n.lineno, n.col_offset))
        for n in nodes:
            if isinstance(n, ast.Import):
                found |= {(a.name, _kind(a.name, 0)): None for a in n.names}
            else:
                found["." * n.level + (n.module or ""), _kind(n.module or "", n.level)] = None
    except (SyntaxError, ValueError):
        for m in re.finditer(r"(?m)^[ \t]*(?:from[ \t]+(\.*[\w.]*)[ \t]+import\b|import[ \t]+([\w.]+))", source):
            name = m[1] or m[2] or ""
            found[name, _kind(name.lstrip("."), name.startswith("."))] = None
    return [{"name": n, "module_type": k} for n, k in found]


def _imports(s: pd.Series) -> pd.Series:
    return s.map(lambda x: imports_of(x or ""))


def python_imports(c: Column | str) -> Column:
    return F.pandas_udf(_imports, DEPENDENCY)(c)


def fragments_of(source: str) -> list[dict]:
    """Top-level definitions: name, kind, text, and a skeleton of signatures without bodies."""
    try:
        tree = ast.parse(source)
    except (SyntaxError, ValueError):
        return []
    out = []
    for n in tree.body:
        if isinstance(n, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef):
            heads = [m for m in ([n] if not isinstance(n, ast.ClassDef) else [n, *n.body]) if isinstance(m, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef)]
            lines = source.split("\n")
            skeleton = "\n".join(lines[h.lineno - 1].rstrip() for h in heads)
            out.append({"name": n.name, "kind": "class" if isinstance(n, ast.ClassDef) else "function", "original": ast.get_source_segment(source, n) or "", "skeleton": skeleton})
    return out


def _fragments(s: pd.Series) -> pd.Series:
    return s.map(lambda x: fragments_of(x or ""))


def python_fragments(c: Column | str) -> Column:
    return F.pandas_udf(_fragments, "array<struct<name:string,kind:string,original:string,skeleton:string>>")(c)


def script_imports(c: Column) -> Column:
    """Modules that a TypeScript or JavaScript text imports or requires, in order, each once."""
    pattern = r"""(?:from|import|require\()\s*['"]([^'"]+)['"]"""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), 1))


def include_edges(files: DataFrame) -> DataFrame:
    """Include statements by line; an argument that is not a literal is $DYNAMIC."""
    lines = files.select("path", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    pattern = r"""\b(include_once|require_once|include|require)\b\s*\(?\s*(?:['"]([^'"]+)['"]|(\S))"""
    kind, literal = F.regexp_extract("line", pattern, 1), F.regexp_extract("line", pattern, 2)
    return lines.filter(F.col("line").rlike(pattern)).select(F.col("path").alias("source_file"), F.when(literal != "", literal).otherwise("$DYNAMIC").alias("target_file"), kind.alias("include_type"), (F.col("at") + 1).alias("line_number"))


def markdown_sections(c: Column, least: int = 100) -> Column:
    """Sections under # and ## headings with a body of ``least`` characters or more."""
    parts = F.filter(F.split(F.concat(F.lit("\n"), c), r"\n(?=##? )"), lambda p: p.rlike(r"^##? "))
    cut = F.transform(parts, lambda p: F.struct(F.trim(F.regexp_replace(F.split(p, "\n")[0], "^##? ", "")).alias("title"), F.trim(F.regexp_replace(p, r"^[^\n]*\n?", "")).alias("body")))
    return F.filter(cut, lambda x: F.char_length(x["body"]) >= least)


def recall_at(gold: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """Share of each file's gold names among its first n found ones."""
    top = found.filter(F.col("rank") <= n).select("path", "name").distinct()
    hits = gold.join(top.withColumn("hit", F.lit(1)), ["path", "name"], "left")
    return hits.groupBy("path").agg((F.count("hit") / F.count("*")).alias("recall"))


def nearest_ancestor(files: DataFrame, readmes: DataFrame) -> DataFrame:
    """For each file the README of its nearest folder upwards: an equality join on exploded folders."""
    parts = F.split("path", "/")
    up = files.select("path", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda d: F.struct(d.alias("depth"), F.array_join(F.slice(parts, 1, d), "/").alias("folder")))).alias("x")).select("path", "x.*")
    return up.join(readmes, "folder").groupBy("path").agg(F.max_by("readme", "depth").alias("readme"))
