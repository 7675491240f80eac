"""From raw documents to token ids: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpipe.llm import byte_bpe, decontaminate, near_dedup, quality, substring_dedup
from vidpipe.scratch import made, release, written

#: The columns that all stages but the last return.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a passage that no second document may repeat.
PASSAGE = 50


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, scores 0.5 or more.

    Every row goes by its own text, rows with null or repeated ids too; null and empty texts are scored like any
    other.  Without labels of both kinds all rows have one score.  No rows give no rows.
    """
    return quality.keep_good(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (shingles of five words, similarity 0.8) the document with the smallest id.

    Rows with null id and texts without words stay; rows that repeat an id are one document and go or stay
    together.  No rows give no rows.
    """
    found = near_dedup.near_duplicates(docs, width=5, percent=80)
    # written, so that Spark knows how large the ids are and broadcasts them if they are few by its measure
    copies = written(found.where("NOT kept").select("doc_id").distinct(), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of PASSAGE words or more that a document with a smaller id has; texts left empty go.

    Null and empty texts stay as they are, rows with null id too; rows that repeat an id are one document and keep
    what only they have.  ``n_chars`` follows a text that changed.  No rows give no rows.
    """
    given = docs.select(*COLUMNS).withColumn("_null", F.col("text").isNull())
    cut = substring_dedup.remove_repeats(given, window=PASSAGE, layout="text", carry=("lang", "source", "n_chars", "_null"))
    kept = cut.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    changed = F.col("n_removed") > 0
    return kept.select(
        "doc_id", F.when(~F.col("_null"), F.col("text")).alias("text"), "lang", "source", F.when(changed, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars")
    )


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of the benchmark.

    Rows with null id and null texts stay; rows that repeat an id go together.  An empty benchmark takes nothing;
    no rows give no rows.
    """
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256, ids)`` of each row.

    Null and empty texts have no ids; null and repeated doc_ids are carried as they are.  No rows give no rows.
    """
    out = byte_bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("minhash near-dedup", one_of_each),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", decontaminated),
    ("byte-level bpe", encoded),
]

#: Training and tokenizing are not SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote for itself goes once its result is written."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), made(spark)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release(spark, since, made(spark) - 1)  # all but the table just written
        since = made(spark) - 1
    return STAGES[-1][1](spark, docs, sf_dir)
