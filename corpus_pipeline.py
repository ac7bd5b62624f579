"""Documents to tokens: quality rules, near copies, repeated passages, benchmark leaks, BPE.

Each stage reads what its predecessor kept. The first four return the columns of documents, whatever
further ones they have; the last one adds n_tokens and ids and returns the text that the ids decode to.

Defined cases, by stage. A null text has no words, so the first stage drops it; called alone, the others
keep rows of null texts. Rows without an id go through all stages like others and come last wherever the
order of ids decides; nulls in other columns are carried. Empty texts go in the first stage; very long
ones are read whole by all. Of near copies, of rows that share an id and of repeated rows the stage says
which stays, and the choice depends on nothing but the rows. Empty tables give empty tables. Columns
of any name are carried, but the last stage replaces columns named n_tokens and ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isarithm.llm import bpe, decontam, jaccard, quality_rules, substring
from isarithm.llm.queries import tokenizer_path
from isarithm.llm.storage import drop, fresh_dir

#: BPE ids have no SQL; tests hold the stages against plain Python versions.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the v2 policy go; each row is judged by its text alone."""
    return quality_rules.keep_good(docs, "v2")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked documents one row stays: that of the smallest id, rows without one last.

    Rows that agree in id and text are told apart by a hash of all their columns. Rows of one id with
    texts of different classes are different documents.
    """
    return jaccard.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated passages are cut; a document that had nothing else goes.

    The first occurrence, by id (rows without one last), then text, then place, stays. Where there is a
    column n_chars, it is set to the new length of a text that was cut.
    """
    carried = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_stage"))
    cleaned = substring.drop_repeats(carried).where("n_removed = 0 OR n_removed < n_sentences")
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        fresh["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(F.col("_stage.n_chars"))
    return cleaned.select(*[fresh.get(c, F.col(f"_stage.`{c}`")).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds a test item go, with or without an id."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and the text decoded from them; the ids of a null text are none, and its text is then empty."""
    return bpe.encode_and_decode(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_copies),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written as Parquet in the shared folder and read again.

    A stage's table is deleted when its successor's is written; the last one stays for the caller.
    """
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = fresh_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            drop(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
