"""Registered queries of the operators for training data. The thin queries derive the contract's digests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetally.llm import (
    decontamination,
    hard_negatives,
    lexical_search,
    mixing,
    near_duplicates,
    packing,
    personal_data,
    preference,
    repeats,
    sharding,
    sql,
    substrings,
    token_files,
    wrappers,
)
from zonetally.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(file: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(file)


@_query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_ids(_table(spark, sf_dir, "documents"), path, _tokenizer("word_bpe_49k.json"))
    read = token_files.with_starts(token_files.checksums(spark, path), path)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


@_query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@_query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, [f"shard-{k:03d}" for k in range(256)]).select("doc_id", "slot", "shard")


@_query
def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.judge(_table(spark, sf_dir, "documents")).drop("longest_repeat")


@_query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.group(_table(spark, sf_dir, "documents"))


@_query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, cut = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    left = cut.select("doc_id", "tag", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    n_removed = F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    kept = F.when(F.col("whole"), F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", "sha256"))
    return rows.join(left, ["doc_id", "tag"], "left").select("doc_id", "n_words", n_removed.alias("n_removed"), kept.alias("kept_sha256"))


@_query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("score", F.round("score", 6))


@_query
def op4_wrapper_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_texts(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@_query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find(docs, keep=["doc_id"])
    counts = [personal_data.number_of("base", kind).alias(f"n_{kind}") for kind in personal_data.BASE]
    listed = personal_data.listed
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@_query
def op6_preference_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    rows = preference.featured(docs)
    scored = preference.score_featured(rows, preference.learn_featured(rows, labels.where(~held_out)))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= preference.CUT).cast("int").alias("predicted"))


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=label)


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = F.element_at(F.array(F.lit(5), F.lit(2), F.lit(1)), (F.col("nth") % 3 + 1).cast("int"))
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), weight)
    return mixed.select("doc_id", "size", "source_size", "target", mixing.taken().alias("taken"))


ORACLE_SQL |= {
    "op11_hard_negatives": sql.hard_negatives(),
    "op12_lexical_search": sql.lexical_search(),
    "op13_mixing": sql.mixing(mixing.BLOCK),
    "op3_near_duplicates": sql.near_duplicates(),
    "op5_repetition": sql.repetition(repeats.LEAST, repeats.MOST_COVERED, repeats.LONGEST),
    "op7_substring_dedup": sql.substring_dedup(substrings.WIDTH),
}
