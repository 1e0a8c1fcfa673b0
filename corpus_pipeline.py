"""The corpus pipeline: five stages over ``documents``, each over all that the one before kept.

    toxicity            documents that score 0.5 or more go
    near_duplicates     of the documents in a SimHash component, the smallest doc_id stays
    decontamination     documents in which a benchmark window occurs go
    personal_data       spans of personal data are replaced by their kind
    byte_bpe            texts become token ids, with the digests of ids and decoded bytes

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return
the columns they were given. ``run`` writes the result of each stage as Parquet to the shared
folder and gives the table to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropweave.llm import byte_bpe, decontamination, personal, simhash, toxicity
from cropweave.llm.components import stored
from cropweave.llm.queries import pattern, table, tokenizer
from cropweave.llm.texts import free_name
from cropweave.session import shared_folder


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score below 0.5. Null and empty texts have no evidence and stay, as do rows with a null id."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"), shared_folder(spark))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: that of the smallest ``doc_id``, of repeated ids the smallest row.

    A row with a null ``doc_id`` goes if another row has its fingerprint, and stays else.
    """
    name = free_name(docs, "kept_id")
    groups = simhash.near_duplicates(docs, shared_folder(spark), words=4, distance=4)
    keep = groups.where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    columns = [F.col(f"`{x}`") for x in docs.columns]
    own = docs.where("doc_id IS NOT NULL").join(keep, docs["doc_id"] == F.col(name), "left_semi")
    repeated = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias(name))
    once = own.join(repeated, own["doc_id"] == F.col(name), "left_anti").select(*columns)
    several = own.join(repeated, own["doc_id"] == F.col(name), "left_semi")
    least = several.groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("row")).select("row.*")
    return once.unionByName(least).unionByName(_without_id(docs, groups, columns, name))


def _without_id(docs: DataFrame, groups: DataFrame, columns: list, name: str) -> DataFrame:
    """Rows without an id whose fingerprint no other row has, one of each fingerprint."""
    nameless = docs.where("doc_id IS NULL")
    own = simhash.fingerprints(nameless.withColumn("doc_id", F.xxhash64("text")))
    alone = groups.where("doc_id IS NULL AND component_id IS NULL").select(F.col("fingerprint").alias(name)).distinct()
    own = own.select(F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("print"), F.col("doc_id").alias("hash"))
    kept = own.join(alone, own["print"] == F.col(name), "left_semi").groupBy("print").agg(F.min("hash").alias(name)).select(name)
    rows = nameless.join(kept, F.xxhash64(nameless["text"]) == F.col(name), "left_semi")
    return rows.groupBy(F.xxhash64("text").alias(name)).agg(F.min(F.struct(*columns)).alias("row")).select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no 10-word window of a benchmark item occurs. Null and empty texts stay."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"), shared_folder(spark), window=10)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their personal data replaced and ``n_chars`` counted anew."""
    return personal.redacted(docs, shared_folder(spark))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the token ids and what they decode to, a row for each document."""
    path = tokenizer("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(docs, path, pattern(), with_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("byte_bpe", as_tokens),
]

#: Decoding, fitted scores and byte-pair merges have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs
