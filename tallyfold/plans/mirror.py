"""Refreshes of a published mirror: guards before the change, the change as one version, a gate after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import delta
from ..operators.quality import collapse_identical
from .store import Folder, current, manifest, publish


def refresh(spark: SparkSession, read_source, root: str, version: str, key: str = "key", changed: str = "changed", allow_empty: bool = False) -> dict:
    """Publish what ``read_source()`` holds as the mirror's next version and return the counts of the delta.

    The source is counted before and after it is copied: a source that changes meanwhile, one whose rows of one key
    differ, and an empty one while the mirror holds rows are errors, and the mirror stays as it is.
    """
    source: DataFrame = read_source()
    before = source.count()
    rows = collapse_identical(source, [key])
    published = manifest(Folder(spark, root)) is not None
    old = current(spark, root) if published else source.limit(0)
    if not allow_empty:
        delta.guard_empty_source(source, old)
    counts = delta.mirror_stats(delta.mirror_delta(rows, old, key, changed, allow_empty=True)).first().asDict()

    def stable(_: DataFrame) -> None:
        delta.guard_stable_count(before, read_source().count())

    publish(rows, root, version, check=stable, planned=counts["source"])
    return counts
