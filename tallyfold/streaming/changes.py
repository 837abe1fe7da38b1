"""Structured Streaming adapters: upserts per micro-batch, latest state per key, late rows, event windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.temporal import latest_per_key
from ..plans.rewrite import upsert_if_newer
from ..plans.store import Folder, expire, manifest, rewrite_buckets


def read_changes(spark, path: str, schema, files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """A folder of Parquet files (those of a name pattern) as a stream; the trigger bound is the back-pressure."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return (r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r).parquet(path)


def upsert_sink(root: str, keys: list[str], changed: str, buckets: int = 64, expire_every: int = 20) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: each batch rewrites the hash buckets that it touches; a batch that comes again is skipped.

    Rows of one key in one batch are reduced to the newest first.  Files of earlier versions go every
    ``expire_every`` batches.  A table without its manifest is an error, not a first batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done = manifest(Folder(spark, root))
        if done is not None and int(done["version"]) >= number:
            return
        newest = latest_per_key(batch, keys, [F.col(changed).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in batch.columns if c not in (*keys, changed)]])
        rewrite_buckets(newest, root, str(number), keys, lambda old, new: upsert_if_newer(old, new, keys, changed), buckets)
        if number % expire_every == expire_every - 1:
            expire(spark, root)

    return write


def latest_state(stream: DataFrame, key: str, changed: str, columns: list[str]) -> DataFrame:
    """Newest values per key; use with output mode ``update`` or ``complete``."""
    newest = F.max(F.struct(changed, *columns)).alias("m")
    return stream.groupBy(key).agg(newest).select(key, *[F.col(f"m.{c}").alias(c) for c in (changed, *columns)])


def flag_late(rows: DataFrame, baseline_max, changed: str) -> DataFrame:
    """Late rows stay and are marked: a watermark would drop them."""
    return rows.withColumn("late", F.coalesce(F.col(changed) < F.lit(baseline_max), F.lit(False)))


def tumbling(stream: DataFrame, ts: str, width: str, delay: str, groups: list[str]) -> DataFrame:
    """Counts per event-time window and group (event times without a zone are taken in the session's)."""
    stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, width).alias("w"), *groups).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *groups, "n")


def sessions(df: DataFrame, key: str, ts: str, gap: str) -> DataFrame:
    """Sessions per key: a pause of at least ``gap`` starts a new one."""
    return df.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("session_start"), "n")


def batch_order(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Position of each change among its key's changes (keys are users: their histories are bounded)."""
    return df.withColumn("nth_change", F.row_number().over(Window.partitionBy(key).orderBy(ts)))
