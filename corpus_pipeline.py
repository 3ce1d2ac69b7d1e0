"""A corpus pipeline of five stages, each of which works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet in the shared
scratch folder and reads again as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.bpe import encode_and_decode
from siftwell.llm.common import materialize
from siftwell.llm.mixing import mix_documents
from siftwell.llm.near_dedup import near_duplicates
from siftwell.llm.queries import TOKENIZER, table
from siftwell.llm.substring_dedup import remove_repeated_passages
from siftwell.llm.toxicity import score_toxicity, train


def whole(docs: DataFrame) -> DataFrame:
    """Id and text, and all columns as one, so that none of them clashes with an operator's results."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be toxic go; null and empty texts stay, repeated rows go together.
    Without toxic labels nothing goes."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(whole(docs), model, carry=["__doc"]).filter("predicted = 0").select("__doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, one with the smallest id; of a group without ids, any one. Rows
    without words (null, empty, blank) all stay."""
    return near_duplicates(whole(docs), words=5, percent=80, carry=["__doc"], one_row=True).filter("kept").select("__doc.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that occur elsewhere too are cut out of the texts. All rows stay; a text that is
    cut whole, and a null one, is empty."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__doc")
    out = remove_repeated_passages(docs.select("doc_id", "text", rest), window_words=35, carry=["__doc"], layout=True)
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return out.select(*[new.get(c, F.col(f"__doc.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it; documents without words are in no mix."""
    return mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to; none for a null or empty text."""
    import public_tokenizers

    out = encode_and_decode(docs, public_tokenizers.path(TOKENIZER), carry=[c for c in docs.columns if c not in ("text", "n_chars")])
    return out.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

#: SQL cannot express the first stage, a trained classifier, and so none of what follows from it; tests compare every
#: stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
