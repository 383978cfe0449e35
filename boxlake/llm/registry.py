"""Queries of the training-data operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.llm import decontaminate, langid, line_runs, mixing, phrases, pu_quality, quality_rules, quotes, repair, secrets, simhash, tokencount, warc
from boxlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
c AS (SELECT *, strlen(html) AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN newest END AS refers_to
FROM c"""


def queries() -> dict[str, Query]:
    return {
        "op1_warc": lambda s, d: warc.records(table(s, d, "pages")),
        "op2_decontaminate": lambda s, d: decontaminate.report(table(s, d, "documents"), table(s, d, "benchmark")),
        "op3_pu_quality": lambda s, d: pu_quality.classify(table(s, d, "documents"), table(s, d, "labels")),
        "op4_secrets": lambda s, d: secrets.scan(table(s, d, "documents")),
        "op5_language": lambda s, d: langid.identify(table(s, d, "documents")),
        "op6_mixture": lambda s, d: mixing.mixture(table(s, d, "documents")),
        "op7_quality_rules": lambda s, d: quality_rules.judge(table(s, d, "documents")),
        "op8_simhash": _near_duplicates,
        "op9_quotes": lambda s, d: quotes.chat(table(s, d, "conversations")),
        "op10_token_counts": lambda s, d: tokencount.counts(table(s, d, "documents"), _tokenizer()),
        "op11_phrases": lambda s, d: phrases.collocations(table(s, d, "documents")),
        "op12_repair": lambda s, d: repair.report(table(s, d, "conversations")),
        "op13_line_runs": lambda s, d: line_runs.repeated_lines(table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": _WARC,
        "op2_decontaminate": decontaminate.oracle(),
        "op6_mixture": mixing.oracle(),
        "op7_quality_rules": quality_rules.oracle(),
        "op11_phrases": phrases.oracle(),
        "op12_repair": repair.oracle(),
        "op13_line_runs": line_runs.oracle(),
    }
