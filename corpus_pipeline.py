"""From raw documents to packed sequences: quality rules, near-duplicates, decontamination, personal data, packing.

Each stage gets what its predecessor kept, as a table that was written and read
again. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetally.llm import decontamination, near_duplicates, packing, personal_data, repeats
from zonetally.llm.text import without
from zonetally.session import prepare, scratch_path, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are short or repeat themselves."""
    prepare(spark)
    return repeats.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near-duplicates."""
    prepare(spark)
    groups = near_duplicates.group(docs)
    return without(docs, store(spark, groups.where(~F.col("kept")).select("doc_id"), "dropped"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that quote a benchmark item."""
    prepare(spark)
    found = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, store(spark, found.select("doc_id"), "dropped"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the kind of data in the place of each span; n_chars follows the new text."""
    prepare(spark)
    # the columns travel as one, so that none of them can have a name that the operator uses
    found = personal_data.find(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"), "text"), keep=["document"])
    text = personal_data.masked(F.col("document.text"), F.col("spans"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return found.select(*(changed.get(c, F.col(f"document.`{c}`")).alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens."""
    import public_tokenizers

    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("personal data", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither tokenizers nor alignments; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents in `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
