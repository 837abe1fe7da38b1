"""A corpus pipeline of five operators: each stage works on all its predecessor kept.

Stages take ``(spark, docs, sf_dir)`` and return a DataFrame that is written as Parquet and read
again as the next stage's ``docs``; all but the last return the columns of ``documents``.

Cases that hold for every stage: nulls are allowed in any column and an id may be missing or repeated (rows, not ids, are
what stages keep or drop); an empty table gives an empty table; other columns than those of ``documents``, whatever
their names, are left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm import line_dedup, pow2_packing, quality_ledger, shingle_groups, source_mix
from tallyfold.llm.common import shared_dir
from tallyfold.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the corpus policy: all rules of the strict one but the least number of words, so a clean text
    may be short.  A text without a word (null, empty, white space) goes; repeated rows and ties are judged alike; a very
    long text is measured whole."""
    entries = quality_ledger.ledger(quality_ledger.measure(docs.select(*COLUMNS), carry=list(COLUMNS)))
    return quality_ledger.apply_policy(entries, quality_ledger.CORPUS).where("kept AND n_words > 0").select("row.*")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share; a document left without a word goes.  ``n_chars`` is counted
    anew.  Rows of one id, and rows without one, count as one document each; rows that share the largest id all keep a
    line, and a very long text loses its lines like any other."""
    lines = line_dedup.dedup_lines(docs.select(*COLUMNS))
    kept = lines.select("row.doc_id", "text", "row.lang", "row.source", F.char_length("text").cast("long").alias("n_chars"))
    return kept.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: texts whose five-word shingles have a Jaccard
    similarity of 0.8 or more, and those connected through such.  It is the one with the smallest id,
    nulls last, and among equal ids the one with the smallest digest of its row, so reruns agree; null or repeated ids
    never join other texts.  Null and empty texts are equal; of equal rows one stays; very long texts are compared whole."""
    digest = F.md5(F.to_json(F.struct(*COLUMNS), {"ignoreNullFields": "false"}))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    docs = docs.select(*COLUMNS)
    rows = docs.select(digest.alias("digest"), shingle_groups.text_key(F.col("text")).alias("t"), *COLUMNS)
    first = rows.groupBy("t").agg(F.min(order).alias("first"))
    groups = first.join(shingle_groups.similar_texts(docs), "t", "left").groupBy(F.coalesce("root", "t").alias("root")).agg(F.min("first").alias("first"))
    keep = groups.select(F.col("first.digest").alias("digest"))
    return rows.join(keep, "digest", "left_semi").dropDuplicates(["digest"]).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to twice.  A null source is a source; rows with equal ids, or
    without one, get equal verdicts; a text without a word has size 0 and is taken in whole repetitions only."""
    mixed = source_mix.mix_sources(docs.select(*COLUMNS), carry=list(COLUMNS))
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two sequences, one row per piece.  A null or empty text is the end token alone; repeated rows are packed
    once each; a very long text is cut into as many pieces as it takes."""
    return pow2_packing.pack_pow2(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", near_deduplication),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

#: Neither XXH64 fingerprints nor the tokenizer can be expressed in DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder before the next."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark, "pipeline")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
    return docs
