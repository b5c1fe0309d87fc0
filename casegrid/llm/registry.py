"""The ``opN_*`` queries: each applies its operator to the whole of its table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.llm import (decontaminate, hard_negatives, language_model, line_dedup, mixing, periodic_runs, quality, robust_rules, simhash,
                          substring_dedup, url_filter, warc, wrappers)
from casegrid.llm.common import doc_remainder, table
from casegrid.llm.oracles import ORACLES as ORACLES

#: Weights of the mix, relative to siblings; every source has weight 1.
MIX_WEIGHTS = {"domain": {"web": 50, "reference": 30, "forum": 20}, "lang": {"en": 55, "de": 20, "fr": 15, "es": 10}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.6, 2, 42


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = doc_remainder(F.col("id"), 5) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out, "doc_id", "text", "quality")
    scored = quality.score_documents(docs, model)
    return scored.select("row.doc_id", (doc_remainder(F.col("row.doc_id"), 5) == 0).alias("held_out"),
                         "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op4_robust_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = robust_rules.judge(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "distance", "kept")


#: Host, path and action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = url_filter.judge_urls(pages, url_filter.rules_table(spark, URL_RULES))
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return (found.select(F.col("row.doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    chunks = warc.read_archives(manifest).where("last")
    return chunks.select("page_id", F.col("bytes_so_far").alias("payload_bytes"), base32(F.hex("sha1_so_far")).alias("payload_digest"),
                         "record_type", "refers_to")


def base32(sha1: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hexadecimal digits: five of them make four letters."""
    letters = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(sha1, i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                    for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model.score_texts(table(spark, sf_dir, "documents"), doc_remainder(F.col("id"), 7) != 2)
    return found.select(F.col("id").alias("doc_id"), (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                        "base_score", "score")


def domain_of(source: Column) -> Column:
    """The domain of a source by its number: web, reference or forum; other without a number."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]+)$", 1)
    return F.when(number == "", "other").otherwise(
        F.element_at(F.array(F.lit("web"), F.lit("reference"), F.lit("forum")), F.pmod(F.length(number) + F.right(number, F.lit(1)).cast("int"), F.lit(3)) + 1))


def mixed(docs: DataFrame) -> DataFrame:
    levels = {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    return mixing.mix(docs, levels, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")), F.col("id") % 100 == 0)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def with_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten ends in a period of its own words, by the checksum of its id; without an id, none."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(docs, id_col="doc_id", change=with_tail).withColumn("best", periodic_runs.longest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select("row.doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_classifier, op2_html_extraction, op3_simhash, op4_robust_rules, op5_url_filter, op6_decontamination, op7_line_dedup, op8_warc,
        op9_language_model, op10_mixing, op11_hard_negatives, op12_substring_dedup, op13_periodic_runs)}
