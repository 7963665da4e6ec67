"""Registered queries of the training-data operators: each applies one
operator with production parameters to its whole table and derives the
contract's columns from the operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirescope.llm import (chat, decontaminate, langid, lm_score, order_minhash, packing, resample, simhash, spelling, sql,
                           substring_dedup, suffix_dedup, toxicity, wrapper)
from hirescope.llm.common import materialise, ship_package
from hirescope.sources import tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return tables.table(spark, sf_dir, name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that occur earlier in the corpus."""
    out = substring_dedup.remove_repeated_lines(table(spark, sf_dir, "documents"))
    chars = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return out.select("row.doc_id", "n_lines", F.size("spans").cast("long").alias("n_removed"),
                      chars.alias("removed_chars"), spans.alias("spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Share of the ids that learning never sees: crc32(id as text) mod 4 = 2.
TOXIC_HELD_OUT = "crc32(cast(doc_id as string)) % 4 = 2"
TOXIC_AT = 0.3


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.learn(docs, labels.where(f"not ({TOXIC_HELD_OUT})"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out share."""
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return out.select("row.doc_id", "score", "matches").select(
        "doc_id", F.expr(f"coalesce({TOXIC_HELD_OUT}, false)").alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC_AT, 1).otherwise(0).alias("predicted"),
        F.size("matches").cast("long").alias("n_matches"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of all documents; the target are those labelled of good quality."""
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm_score.score(docs, lm_score.learn(docs, good)).select(
        "row.doc_id", "n_tokens", "target_loss", "background_loss", "score")


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of all documents, of their edited texts and their likeness."""
    out = order_minhash.compare_with_edits(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256",
                      order_minhash.as_text(F.col("entries")).alias("fingerprint"),
                      order_minhash.as_text(F.col("edited_entries")).alias("edited_fingerprint"),
                      "near_edited", "near_next")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of token sequences of at most 1024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages by wrapper induction."""
    out = wrapper.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by SimHash and anchor points."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold items of the benchmark, one row per pair."""
    out = decontaminate.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("row.doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


#: Share of the ids that learning never sees: crc32(id as text) mod 5 = 0.
LANG_HELD_OUT = "crc32(cast(doc_id as string)) % 5 = 0"


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those outside the held-out share."""
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(f"not ({LANG_HELD_OUT})"))
    out = langid.predict(docs, model).select("row.doc_id", "lang", "score")
    return out.select("doc_id", F.expr(f"coalesce({LANG_HELD_OUT}, false)").alias("held_out"), F.col("lang").alias("lang_pred"), "score")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte strings that start earlier in the corpus."""
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("row.doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents; every 31st run by hash has lost a letter."""
    words = materialise(spelling.word_counts(table(spark, sf_dir, "documents"), damage=31))
    return spelling.variants(words)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents drawn to follow the benchmark's words."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one full of control strings, rebuilt from their logs, formatted and read back."""
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit("\\### Assistant: </turn> ok").alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.digests(chat.conversations(chat.as_events(turns)))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_lm_score": op3_lm_score,
    "op4_order_minhash": op4_order_minhash,
    "op5_packing": op5_packing,
    "op6_html_extraction": op6_html_extraction,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_langid": op9_langid,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_spelling": op11_spelling,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_chat_format": op13_chat_format,
}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": sql.OP1_SUBSTRING_DEDUP,
    "op13_chat_format": sql.OP13_CHAT_FORMAT,
}
