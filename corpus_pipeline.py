"""Documents to a training mixture: language, near duplicates, benchmark passages, secrets, source weights.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows to the shared folder and reads them
again as the next stage's documents. All stages but the last return the columns of documents; the last adds the
epoch, as a document can be selected in more than one.

In every stage an empty table gives an empty one, extra columns pass through whatever their names, texts of any length are read whole, and a row with a
null doc_id is a document like any other. Language: null and empty texts go, repeated rows stay. Near duplicates: of repeated rows one stays;
doc_ids that repeat over unlike texts are documents of their own; ties go to the least id, then the least digest of the text. Benchmark and secrets: repeated rows are
judged each for itself. Mixture: rows that repeat a doc_id within a source are selected together or not at all; a null lang or source is the empty name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxlake.llm import decontaminate, langid, mixing, near_copies, secrets, simhash
from boxlake.llm.common import stored, table
from boxlake.scratch import discard, tables


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return langid.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word Jaccard of 0.8 and more) stays: the one with the least doc_id."""
    return simhash.keep_one(docs, near_copies.groups(docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the source weights select, with the epoch."""
    return mixing.select(docs)[0]


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("secrets", secret_scan),
    ("mixture", mixture),
]

#: Hashed n-grams, XXH64 fingerprints and token structure are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what a stage has written goes as soon as its successor's rows are there, but for what the result reads."""
    docs, last = table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        before = set(tables())
        docs = stored(stage(spark, docs, sf_dir))
        made = [p for p in tables() if p not in before]
        discard(spark, [*last, *made[:-1]])
        last = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
