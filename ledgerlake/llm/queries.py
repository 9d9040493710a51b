"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.collocations import collocations
from ledgerlake.llm.common import fold, table
from ledgerlake.llm.fair_mix import mix_plan
from ledgerlake.llm.id_store import read_store, write_store
from ledgerlake.llm.impact_topk import top_k
from ledgerlake.llm.length_buckets import pack
from ledgerlake.llm.mil_quality import quality_scores
from ledgerlake.llm.multiset_hash import edited_fingerprints
from ledgerlake.llm.periodic_runs import periodic_runs, run_report
from ledgerlake.llm.ppm_language import identify
from ledgerlake.llm.pu_toxicity import toxicity_scores
from ledgerlake.llm.sql import ORACLE  # noqa: F401  (read by the entry module)
from ledgerlake.llm.substring_dedup import without_repeats
from ledgerlake.llm.tensored_minhash import near_duplicates
from ledgerlake.llm.warc_revisit import read_archives, write_archives
from ledgerlake.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op10_tensored_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


@register
def op9_ppm_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    return identify(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register
def op2_mil_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    scores = quality_scores(docs, labels, ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op8_pu_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 4) == 2
    scores = toxicity_scores(docs, labels, ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op1_impact_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


@register
def op3_warc_revisit(spark, sf_dir):
    path = fresh_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op5_multiset_hash(spark, sf_dir):
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@register
def op4_fair_mix(spark, sf_dir):
    return mix_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register
def op6_length_buckets(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


@register
def op7_id_store(spark, sf_dir):
    path = fresh_dir(spark, "id_store")
    write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_store(spark, path)


def planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the contract of op11 makes the end of some texts periodic."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(crc % 10 == 0, F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    listed = docs.select("doc_id", "text", F.expr("crc32(string(doc_id)) div 10").alias("g"), words.alias("words"))
    placed = listed.select("doc_id", "text", "g", "words", F.when(F.size("words") > 0, F.expr("int(g % size(words))")).alias("a"))
    planted = F.expr(
        """array_join(concat(slice(words, 1, a), transform(sequence(a, size(words) - 1),
             i -> words[int(a + (i - a) % (1 + (size(words) - a) div (3 + g % 8)))])), ' ')"""
    )
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


@register
def op11_periodic_runs(spark, sf_dir):
    return run_report(periodic_runs(planted_periods(table(spark, sf_dir, "documents"))))


@register
def op13_sketch_substrings(spark, sf_dir):
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@register
def op12_vertical_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
