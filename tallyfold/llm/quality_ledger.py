"""Quality rules as a bitmask ledger.

``measure`` reads each whole text once and gives measurements; ``ledger`` evaluates every rule once over the
measurements and adds the failures as bits of one long; ``store`` writes both as a Parquet table in the shared
folder, with the rules it was made by, and ``load`` reads it back (another set of rules is an error).  From the stored
ledger ``apply_policy`` keeps or rejects by a versioned mask and ``ablations`` tells, for each rule of a
policy, how many documents it rejects, how many only it rejects, and how many would be kept without it, from one
aggregation over the distinct bit patterns (at most 2^rules groups, partial sums first).  Neither reads a text.

All of it is row-local but for the ablation sums, so nothing can be skewed but one very long text,
which is measured with numpy in memory proportional to that text.

Defined cases: a null or empty text has no words and fails ``few_words`` only; null ids and
repeated rows are measured like any other row; an empty table gives an empty ledger; other columns
are carried in ``row``.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS_BYTES, mix, n_chars, row_of, texts_of, word_hashes

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_plain_words", "top_word", "n_runs", "n_pipes")

#: name -> condition under which a document fails; the position is the bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 5 * word_chars"),
    ("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    ("not_words", "100 * n_plain_words < 60 * n_words"),
    ("dominant_word", "top_word > 3 AND 100 * top_word > 30 * n_words"),
    ("stuttering", "100 * n_runs > 20 * n_words"),
    ("table_pipes", "100 * n_pipes > 10 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules: a document is rejected if it fails any of them."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
STRICT = Policy("strict-1", tuple(BIT))
#: For corpora: a clean text is not junk for being short.
CORPUS = Policy("corpus-1", tuple(r for r in BIT if r != "few_words"))


_SYMBOLS = b"#*$%&|<>"


def measure_text(text: bytes) -> tuple[int, ...]:
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip(WS_BYTES)]
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    chars = n_chars(text.translate(None, WS_BYTES))
    dup = len(lines) - len(set(lines))
    if not n:
        return (0, 0, symbols, dup, 0, len(lines), 0, 0, 0, 0)
    h = word_hashes(words)
    repeat = 0
    if n >= 4:
        w = mix(mix(mix(h[:-2]) + h[1:-1]) + h[2:])
        s = np.sort(w)
        twice = s[1:][s[1:] == s[:-1]]
        if len(twice):
            hit = np.isin(w, twice)
            cover = np.zeros(n, bool)
            cover[:-2] |= hit
            cover[1:-1] |= hit
            cover[2:] |= hit
            repeat = int(cover.sum())
    counts = Counter(words)
    plain = sum(k for x, k in counts.items() if x.strip(b".,;:!?()\"'-").isalpha() or not x.isascii())
    runs = int(np.count_nonzero(h[1:] == h[:-1]))
    pipes = counts.get(b"|", 0)
    return (n, chars, symbols, dup, repeat, len(lines), plain, max(counts.values()), runs, pipes)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = list(map(measure_text, texts_of(batch, 1)))
        columns = [pa.array([x[i] for x in got], pa.int64()) for i in range(len(MEASURES))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", *MEASURES])


def measure(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (the ``carry`` columns, all by default) and the measurements of each text."""
    kept = docs.select(*[f"`{c}`" for c in carry]) if carry is not None else docs
    base = docs.select(row_of(kept, "row") if carry is None else F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    return base.mapInArrow(_measure, f"row {base.schema['row'].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in MEASURES))


def ledger(measured: DataFrame) -> DataFrame:
    bits = sum((F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, rule) in enumerate(RULES)), F.lit(0).cast("long"))
    return measured.withColumn("failed_bits", bits)


def rules_version() -> str:
    """A digest of the rules: bits of another version mean something else."""
    return hashlib.sha256(repr((MEASURES, RULES)).encode()).hexdigest()[:16]


def store(entries: DataFrame, path: str) -> DataFrame:
    """Write a ledger under its rules' version and return it as read back; texts are read for this only."""
    entries.write.mode("overwrite").parquet(f"{path}/rules={rules_version()}")
    return load(entries.sparkSession, path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of the present rules; there is none if it was written by others."""
    return spark.read.parquet(f"{path}/rules={rules_version()}")


def apply_policy(entries: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """Adds ``kept`` and ``policy_version``."""
    return entries.withColumns({"kept": F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) == 0, "policy_version": F.lit(policy.version)})


def ablations(entries: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """Per rule of the policy: ``rule failed failed_only_it kept kept_without_it``."""
    patterns = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules]))
    each = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    zero = F.lit(0).cast("long")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(zero)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(zero)).alias("failed_only_it"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(zero)).alias("kept"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0, F.col("n")).otherwise(zero)).alias("kept_without_it"),
    )


def sole_failures(entries: DataFrame, policy: Policy = STRICT) -> DataFrame:
    """Adds ``sole_rule``, the only rule of the policy that a document fails (null if none or several), and
    ``sole_rule_rejects``, how many documents fail that rule only: what dropping it would bring back."""
    bits = F.col("failed_bits").bitwiseAND(F.lit(policy.mask))
    name = F.element_at(F.create_map(*[x for r in policy.rules for x in (F.lit(BIT[r]).cast("long"), F.lit(r))]), bits)
    table = ablations(entries, policy).select(F.col("rule").alias("sole_rule"), F.col("failed_only_it").alias("sole_rule_rejects"))
    return entries.withColumn("sole_rule", name).join(F.broadcast(table), "sole_rule", "left")  # a row a rule
