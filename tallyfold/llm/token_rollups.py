"""Token counts as delta-maintained rollups.

Totals per (source, language, tokenizer version) are additive, so they are kept as signed sums: an insert
adds a document and its tokens, a delete takes them away, a revised count adds the difference.
A batch of events is reduced to one row per key (partial sums first: a hot source shuffles one row per
task), written as its own Parquet folder, and counts only once its commit marker exists; a batch that
is applied again finds its marker and changes nothing, and one that was interrupted is simply
overwritten.  ``compact`` folds committed batches into one base batch.

Token counts come from ``token_counts``: real tokenizers by their files, each under a version name.  A new version of a
tokenizer is a key of its own; a revised count of the same version is a pair of old and new numbers.

A store is a folder that driver and executors share; its writers take a lock.

Defined cases: a null source, language or version is a key of its own; a null count counts as 0 tokens; an
event with both counts null changes nothing; a key whose documents and tokens are all taken away
has no row; repeated events count as often as they come; an empty batch commits and changes nothing;
other columns of events are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.store import Folder

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"

def deltas(events: DataFrame) -> DataFrame:
    """Events with ``old_tokens`` (null: an insert) and ``new_tokens`` (null: a delete) -> signed sums per key."""
    old, new = F.col("old_tokens"), F.col("new_tokens")
    docs = new.isNotNull().cast("long") - old.isNotNull().cast("long")
    tokens = F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0))
    sums = events.groupBy(*KEYS).agg(F.sum(docs).alias("n_docs"), F.sum(tokens.cast("long")).alias("n_tokens"))
    return sums.where("n_docs <> 0 OR n_tokens <> 0")


class RollupStore:
    """Committed batches of signed sums under one shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.folder = spark, root.rstrip("/"), Folder(spark, root)
        self._path, self._fs = self.folder._Path, self.folder._fs

    def _marker(self, batch: str):
        return self._path(f"{self.root}/commits/{batch}")

    def committed(self) -> list[str]:
        at = self._path(f"{self.root}/commits")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def apply(self, batch: str, events: DataFrame) -> bool:
        """Commit a batch once; False if it was there already."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch is named by letters, digits, - and _")
        with self.folder.lock():
            if self._fs.exists(self._marker(batch)):
                return False
            deltas(events).write.mode("overwrite").parquet(f"{self.root}/deltas/{batch}")
            self._fs.createNewFile(self._marker(batch))
            return True

    def totals(self) -> DataFrame:
        """``source lang tokenizer n_docs n_tokens`` over all committed batches."""
        names = self.committed()
        if not names:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*[f"{self.root}/deltas/{b}" for b in names])
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self, into: str) -> "RollupStore":
        """A new store that holds the present totals as one batch ``base`` (the old one stays as it is)."""
        new = RollupStore(self.spark, into)
        self.totals().write.mode("overwrite").parquet(f"{new.root}/deltas/base")
        new._fs.createNewFile(new._marker("base"))
        return new
