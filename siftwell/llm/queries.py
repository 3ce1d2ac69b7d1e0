"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from . import mixing, oracles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_tree_lm import score_texts

    return score_texts(table(spark, sf_dir, "documents"), carry=["doc_id"])


def op2_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import fair_mix

    return fair_mix(table(spark, sf_dir, "documents"), carry=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    out = scan_licenses(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("doc_id", "license", "coverage", F.size("matches").cast("long").alias("n_matches"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeated_bytes

    out = remove_repeated_bytes(table(spark, sf_dir, "documents"), length=100, carry=["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import read_features, read_metadata, store_media

    manifest, folder = store_media(table(spark, sf_dir, "documents"), carry=["doc_id"])
    out = read_features(read_metadata(manifest, folder), folder)
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "bit_depth")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95, carry=["vec_id"])


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80, carry=["doc_id"])


#: The vocabulary file of the tokenizing queries.
TOKENIZER = "word_bpe_49k.json"


def op8_bpe(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    from .bpe import encode_and_decode

    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path(TOKENIZER)
    out = encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_path, carry=["doc_id"])
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import held_out, score_toxicity, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model, carry=["doc_id"]).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeated_passages

    out = remove_repeated_passages(table(spark, sf_dir, "documents"), window_words=35, carry=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_fair_mix": op2_fair_mix,
    "op3_licenses": op3_licenses,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_media": op5_media,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_near_dedup": op7_near_dedup,
    "op8_bpe": op8_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
}

ORACLES: dict[str, str] = {"op2_fair_mix": mixing.oracle_sql(), **oracles.ORACLES}
