"""The registered queries of the subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, collocations, conversations, embeddings, exact, html, language, near, packing, quality, suffix, toxicity, warc
from tidemark.llm.storage import table

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_PATTERN = public_tokenizers.PATTERN
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
END_ID, SEQUENCE = 1, 4096


BATCH_BYTES, SPARK_BATCH_BYTES = "8m", "67108864b"


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package where they share its folder; clusters ship it with --py-files.

    Texts reach them in batches of a few megabytes, unless the session names a size of its own.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == SPARK_BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def _over(name: str, operator: Callable[..., DataFrame], *arguments) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        reachable(spark)
        return operator(table(spark, folder, name), *arguments)
    return query


def _with_labels(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        reachable(spark)
        return operator(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_main_text": _over("pages", html.of_pages),
        "op2_near_duplicates": _over("documents", near.of_documents),
        "op3_byte_bpe": _over("documents", bpe.of_documents, BPE_RANKS, BPE_PATTERN),
        "op4_toxicity": _with_labels(toxicity.of_documents),
        "op5_language": _over("documents", language.of_documents),
        "op6_quality_rules": _over("documents", quality.of_documents),
        "op7_warc_revisits": _over("pages", warc.of_pages),
        "op8_exact_dedup": _over("documents", exact.of_documents),
        "op9_best_fit_packing": _over("documents", packing.of_documents, WORD_BPE, END_ID, SEQUENCE),
        "op10_repeat_removal": _over("documents", suffix.of_documents),
        "op11_collocations": _over("documents", collocations.of_documents),
        "op12_conversation_repair": _over("conversations", conversations.of_conversations),
        "op13_embedding_groups": _over("embeddings", embeddings.of_embeddings),
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_warc_revisits": warc.ORACLE.strip(), "op8_exact_dedup": exact.ORACLE.strip(),
            "op11_collocations": collocations.ORACLE.strip(), "op13_embedding_groups": embeddings.ORACLE.strip()}
