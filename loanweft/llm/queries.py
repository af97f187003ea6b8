"""The operators of this subpackage as named queries over the driver's tables."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweft.llm import decontaminate, fingerprints, forced_bpe, html_crf, jaccard, merkle, oracles, packing, ring, role_repair, substrings, toxicity, training_order, warc
from loanweft.llm.common import table


def op1_bottom_k_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.with_neighbours(table(spark, folder, "documents"))


def op2_warc_index_merge(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "captured", "range", "seq")


def op3_vertical_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_components(table(spark, folder, "documents"))


def op4_weak_supervision_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_bounded_load_ring(spark: SparkSession, folder: str) -> DataFrame:
    placed = ring.assign(table(spark, folder, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_cgk_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_training_order(spark: SparkSession, folder: str) -> DataFrame:
    made = training_order.materialised(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), key=20_240_601)
    return made.select("slot", "shard", "doc_id", "sequence", "n_tokens", F.crc32(F.concat_ws(",", F.col("tokens").cast("array<string>")).cast("binary")).alias("ids_crc32"))


def op8_crf_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return html_crf.extract(pages, html_crf.fit(pages))


def op9_forced_boundary_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return forced_bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_prefix_doubling_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    return role_repair.repair(role_repair.damaged(rows), rows)


def op12_bounded_space_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def without_breaks() -> Column:
    """The text, where 2 divides the check sum of its doc_id without its line breaks."""
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"), without_breaks()).audit()


QUERIES = {
    "op1_bottom_k_fingerprints": (op1_bottom_k_fingerprints, None),
    "op2_warc_index_merge": (op2_warc_index_merge, None),
    "op3_vertical_jaccard_join": (op3_vertical_jaccard_join, None),
    "op4_weak_supervision_toxicity": (op4_weak_supervision_toxicity, None),
    "op5_bounded_load_ring": (op5_bounded_load_ring, None),
    "op6_cgk_decontamination": (op6_cgk_decontamination, None),
    "op7_training_order": (op7_training_order, None),
    "op8_crf_main_text": (op8_crf_main_text, None),
    "op9_forced_boundary_bpe": (op9_forced_boundary_bpe, None),
    "op10_prefix_doubling_dedup": (op10_prefix_doubling_dedup, None),
    "op11_role_repair": (op11_role_repair, None),
    "op12_bounded_space_packing": (op12_bounded_space_packing, None),
    "op13_merkle_manifest": (op13_merkle_manifest, oracles.MERKLE),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
