"""The registered queries ``opN_<name>`` on the given tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .byte_bpe import encode_decode
from .chat_format import format_chats, read_back
from .decontaminate import find_hits
from .embedding_dedup import near_vectors
from .fingerprint import compare_with_edits
from .language_id import identify
from .near_dedup import near_duplicates
from .periodic_runs import find_runs, with_tails
from .quality import classify
from .substring_dedup import remove_repeats
from .token_alignment import align
from .token_counts import count_tokens
from .url_filter import Rule, filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cws_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=10)
    return hits.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


#: A conversation whose texts spell out control strings.
_TRICKY = "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(spark.sql(_TRICKY))
    back = read_back(format_chats(chats)).groupBy("conv_id").agg(
        F.max("n_turns").alias("n_turns"), F.max(F.sha2("turns", 256)).alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"), F.sum("chars").alias("formatted_chars"),
    )
    return back.select(
        "conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_decode(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(_table(spark, sf_dir, "documents"), window=13, layout="words")
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "documents"))


#: Host and path of each rule, and what it says.
_RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), _RULES)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumn("groups_sha256", F.when(F.col("n_groups") == 0, F.lit("")).otherwise(F.sha2("groups", 256))).drop("groups")


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", with_tails(F.col("text"), F.col("doc_id")).alias("text"))
    out = find_runs(docs, exponent=4, least=6)
    # quotients of whole numbers of this size are equal as doubles only if they are equal
    best = F.array_max(F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("q"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("length"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.withColumn("b", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("b.s")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("b.length") / -F.col("b.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_cws_fingerprint": op1_cws_fingerprint,
    "op2_decontamination": op2_decontamination,
    "op3_chat_format": op3_chat_format,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_token_counts": op5_token_counts,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_language_id": op9_language_id,
    "op10_url_filter": op10_url_filter,
    "op11_token_alignment": op11_token_alignment,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

#: Fingerprints, tokens, the two classifiers and runs are beyond SQL; tests hold them against plain versions.
ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": oracles.DECONTAMINATION,
    "op3_chat_format": oracles.CHAT,
    "op7_minhash_near_dedup": oracles.NEAR_DEDUP,
    "op8_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op10_url_filter": oracles.URL_FILTER,
    "op12_embedding_near_dedup": oracles.EMBEDDINGS,
}
