"""A corpus pipeline over ``documents``: quality, near copies, repeated passages, test items, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor and returns a
DataFrame; all but the last return the columns of ``documents``.  ``run`` writes each result as
Parquet in the shared folder and reads it back for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm import bpe, decontam, quality, simhash, substring
from plinth.llm.catalog import ranks_path
from plinth.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that fail the base rules or that the label model finds poor go."""
    return quality.judge(docs).filter("kept").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: that of the smallest doc_id, then of the smallest fingerprint, then the
    smallest row by text and the other columns; ids are smaller than no id.

    Rows whose id no other row has are found by it; only for repeated and missing ids the fingerprint
    is computed again, so unlike texts under one id stay, each in its group.
    """
    found = simhash.near_duplicates(docs, shingle=3, distance=3)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("__id"), F.col("fp").alias("__fp")))
    keep = written(found.groupBy("group").agg(first.alias("k")).select("k.__id", "k.__fp"), "keep")
    shared = found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1 OR doc_id IS NULL")
    shared = written(shared.select(F.col("doc_id").alias("__id")), "shared")
    same = F.col("doc_id").eqNullSafe(F.col("__id"))
    rows = docs.join(keep.join(shared, "__id", "left_anti").filter("__id IS NOT NULL"), F.col("doc_id") == F.col("__id"), "left_semi")
    many = simhash.with_fingerprint(docs.join(shared, same, "left_semi"), name="__print")
    many = many.join(keep, same & (F.col("__print") == F.col("__fp")), "left_semi")
    row, order = F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.struct("text", F.to_json(F.struct("*")))
    many = many.groupBy("doc_id", "__print").agg(F.min_by(row, order).alias("r")).select("r.*")
    return rows.select(*[f"`{c}`" for c in docs.columns]).unionByName(many)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut; every row stays."""
    return substring.dedup(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose hit spans reach the coverage limit go; the others stay as they are."""
    return decontam.mark(docs, table(spark, sf_dir, "benchmark")).filter("NOT contaminated").select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the digests of the ids and of the bytes they decode to."""
    vocabulary = bpe.Vocabulary(spark, ranks_path())
    keys = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return (bpe.round_trip(docs.select(*keys, "text"), vocabulary, keep_text=False)
            .select(*keys, "n_tokens", "ids", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe),
]

#: The label model, the fingerprints' hash and the merges are beyond SQL; tests hold the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
