"""Registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.llm import decontaminate, licenses, mixing, packing, pages, ppm, quality, repair, simhash, substrings, topk, toxicity, trie
from tallywatch.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op6_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.scores(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_id")


def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces, _ = packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.drop("row", "skip")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audited(repair.damaged(table(spark, sf_dir, "conversations")))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node", "parent")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_licenses": op2_licenses,
    "op3_mixing": op3_mixing,
    "op4_substrings": op4_substrings,
    "op5_topk": op5_topk,
    "op6_ppm": op6_ppm,
    "op7_decontaminate": op7_decontaminate,
    "op8_pages": op8_pages,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_packing": op11_packing,
    "op12_repair": op12_repair,
    "op13_trie": op13_trie,
}

ORACLE: dict[str, str] = {"op3_mixing": mixing.ORACLE, "op5_topk": topk.ORACLE, "op7_decontaminate": decontaminate.ORACLE}
