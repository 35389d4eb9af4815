"""The numbered operators as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import blocks, conversation_repair, decontamination, exact_dedup, extract, langid, mixing, near_dedup, packing
from . import quality, tool_calls, warc, whitening
from .common import ship, table


Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(packing.pack(table(spark, sf_dir, "documents")))


def op3_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op6_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, index = blocks.write_ids(table(spark, sf_dir, "documents"))
    return blocks.read_ids(folder, index).drop("ids")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.from_conversations(table(spark, sf_dir, "conversations"))
    return tool_calls.link(calls, results, tool_calls.TOOLS, every_row=True)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), shingle=4, similarity=0.8)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_language_id,
        op2_packing,
        op3_capture_index,
        op4_quality_rules,
        op5_mixing,
        op6_token_blocks,
        op7_exact_dedup,
        op8_tool_calls,
        op9_near_dedup,
        op10_html_extraction,
        op11_decontamination,
        op12_conversation_repair,
        op13_embedding_whitening,
    )
}
