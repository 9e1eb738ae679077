"""Corpus pipeline over ``documents``: quality rules, line dedup, near-duplicate
removal, source mix, best-fit packing.

Each stage takes what its predecessor kept, and its decisions take effect:
rejected documents and emptied documents go, repeated lines are cut out of the
texts, one document of each near-duplicate group stays (the smallest id), the
mix repeats or leaves out documents, and packing returns the pieces with their
places.  All stages but the last return the columns of ``documents``.

Defined cases: null texts fail the quality rules; a document whose lines all
went to earlier documents goes; rows equal in id and text count as one in the
near-duplicate stage; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import line_dedup, ngram_join, packing, quality_rules, source_mix
from railyard.llm.staging import Stage


def _packed(docs: DataFrame, *apart: str) -> DataFrame:
    """``docs`` as the columns ``apart`` and one struct of all others, so that
    no name of theirs meets a name that an operator uses."""
    rest = [c for c in docs.columns if c not in apart]
    return docs.select(*apart, F.struct(F.lit(0).alias("_"), *rest).alias("_doc"))


def _unpacked(df: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` again."""
    return df.select(*[(changed[c] if c in changed else F.col(c) if c in df.columns and c != "_doc"
                        and c in ("doc_id", "text") else F.col("_doc")[c]).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak rules keep."""
    kept = quality_rules.judge(_packed(docs, "text"), keep_text=True).where("kept").select("text", "_doc")
    return _unpacked(kept, docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows."""
    found = line_dedup.drop_repeats(_packed(docs, "doc_id", "text")).where("n_lines = 0 OR n_removed < n_lines")
    size = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return _unpacked(found, docs, **size)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets, 0.8 or more."""
    found = ngram_join.link_documents(docs.select("doc_id", "text"), n=5, num=4, den=5)
    stay = (found.where("doc_id = component_id OR component_id IS NULL")
            .select(F.col("doc_id").alias("_id")).distinct())
    rows = _packed(docs, "doc_id", "text").withColumn("_h", F.xxhash64("text"))
    kept = (rows.join(stay, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").dropDuplicates(["doc_id", "_h"]))
    return _unpacked(kept, docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return source_mix.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their places."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates),
          ("source_mix", mix), ("best_fit_packing", pack)]

#: SQL cannot express the tokenizer; tests compare with a brute-force pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = Stage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, st.stage(stage(spark, docs, sf_dir), name)
        st.discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
