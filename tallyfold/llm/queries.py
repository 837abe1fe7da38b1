"""The queries ``op1_`` to ``op10_``: each operator on its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_digest, fm_substring, html_blstm, line_dedup, pow2_packing, preference_format, quality_ledger, simhash_vptree, source_mix, token_counts, token_rollups
from .common import cut, read, shared_dir


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.near_duplicates(read(spark, sf_dir, "documents")).select("row.doc_id", "fingerprint", "component_id")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mix.mix_sources(read(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "source", "size", "source_size", "target", "copies", "taken")


def op3_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger is written once; both policies and the ablations come from what was written."""
    made = quality_ledger.ledger(quality_ledger.measure(read(spark, sf_dir, "documents"), carry=["doc_id"]))
    entries = quality_ledger.store(made, shared_dir(spark, "ledger"))
    judged = quality_ledger.apply_policy(quality_ledger.apply_policy(entries, quality_ledger.BASE).withColumnRenamed("kept", "base_kept"), quality_ledger.STRICT)
    judged = quality_ledger.sole_failures(judged)
    base_failed = (~F.col("base_kept")).alias("base_failed")
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed, "kept", "failed_bits", "sole_rule", "sole_rule_rejects")


def op4_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = preference_format.format_pairs(preference_format.neighbour_pairs(read(spark, sf_dir, "conversations")))
    flat = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["from"].cast("string"), s["to"].cast("string"))), ",").alias(c)
    return done.select(F.col("id").alias("conv_id"), "n_prefix", "prompt", "chosen", "rejected", flat("chosen_spans"), flat("rejected_spans"))


def op5_exact_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_digest.edited_fingerprints(read(spark, sf_dir, "documents"))


def op6_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents come in; all are counted anew without markup symbols; those of under
    five words go.  The second is sent twice and counts once.  Texts are read once, for all three."""
    docs = read(spark, sf_dir, "documents").withColumn("n_words", source_mix.word_count(F.col("text")))
    texts = {"raw": F.col("text"), "plain": F.regexp_replace("text", r"[#*$%&|<>]", "")}
    files = {name: tokenizer_path(f"{name}.json") for name in ("word_bpe_49k", "byte_bpe_50k")}
    counts = cut(token_counts.count_tokens(docs, files, texts, ["source", "lang", "n_words"]).select("row.*", "tokenizer", "raw", "plain"))
    store = token_rollups.RollupStore(spark, shared_dir(spark, "rollups"))
    none, was, now = F.lit(None).cast("long"), "old_tokens", "new_tokens"
    store.apply("insert", counts.withColumns({was: none, now: F.col("raw")}))
    for _ in range(2):
        store.apply("recount", counts.withColumns({was: F.col("raw"), now: F.col("plain")}))
    store.apply("short", counts.where("n_words < 5").withColumns({was: F.col("plain"), now: none}))
    return store.totals()


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return lines.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_html_blstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_blstm.extract_main_text(read(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return text.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op9_fm_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = fm_substring.dedup_substrings(read(spark, sf_dir, "documents"), carry=["doc_id"])
    return rest.select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_pow2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pow2_packing.pack_pow2(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_simhash_vptree, op2_source_mix, op3_quality_ledger, op4_preference_format, op5_exact_digest, op6_token_rollups, op7_line_dedup, op8_html_blstm, op9_fm_substring, op10_pow2_packing)}
