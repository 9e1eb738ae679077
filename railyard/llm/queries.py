"""The registered queries ``opN_<name>``: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from railyard.llm import (class_lm, fingerprints, html_text, language_id, lexical_search, line_dedup, ngram_join,
                          packing, personal_data, quality_rules, source_mix, spelling, toxicity)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, Jaccard 0.85 or more."""
    return ngram_join.link_documents(_documents(spark, sf_dir), n=4, num=85, den=100).drop("class_key")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 3, 1, 2; 150 % of all words; at most twice a source."""
    return source_mix.take(_documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, hard base rule and the verdict of the weak rules."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                            "n_repeat_words", "base_failed", "kept")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line windows."""
    return line_dedup.drop_repeats(_documents(spark, sf_dir).select("doc_id", "text"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens of the byte-level BPE, end id 0."""
    return packing.pack(_documents(spark, sf_dir))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages learned from the rows that are not held out."""
    docs = _documents(spark, sf_dir)
    model = language_id.learn(language_id.sample(docs))
    rows = docs.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "text")
    return language_id.identify(rows, model).drop("phrases_per_char")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and of its edited text."""
    return fingerprints.neighbours(_documents(spark, sf_dir))


def op9_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class-based bigram scores and the smoothed unigram base."""
    return class_lm.score(_documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores learned from the labels that are not held out."""
    docs = _documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select("doc_id", (~toxicity.in_training("doc_id")).alias("held_out"), "text")
    return toxicity.score(rows, model)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of seven letters and more, their near words, forms and roots."""
    return spelling.variants(spelling.word_counts(_documents(spark, sf_dir)))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    index = lexical_search.build(_documents(spark, sf_dir))
    return lexical_search.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern spans, their digest, and all spans with those of the trained tagger."""
    docs = _documents(spark, sf_dir)
    return personal_data.digest(personal_data.find(docs, personal_data.fit(docs)))


QUERIES = (op1_ngram_jaccard_join, op2_source_mix, op3_quality_rules, op4_line_dedup, op5_best_fit_packing,
           op6_html_text, op7_language_id, op8_fingerprints, op9_class_lm, op10_toxicity,
           op11_spelling, op12_lexical_search, op13_personal_data)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard_join": ngram_join.oracle_sql(4, 85, 100),
            "op2_source_mix": source_mix.oracle_sql(), "op3_quality_rules": quality_rules.oracle_sql(),
            "op4_line_dedup": line_dedup.oracle_sql(), "op11_spelling": spelling.oracle_sql(),
            "op12_lexical_search": lexical_search.oracle_sql()}
