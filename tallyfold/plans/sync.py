"""Three-way safe synchronisation of a production table with its staging table.

Four steps, each recorded in one folder and repeatable: ``freeze`` writes key, change time and payload digest of
every staging row; ``preflight`` compares production with that manifest and refuses conflicts; ``apply`` writes
inserts and updates after checking that neither side moved since; ``delete`` removes what staging does not hold,
and only once staging has been read again and is still exactly what was frozen.

Deletes come last: until then production holds at least what it held before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.digest import payload_digest
from ..operators.delta import ReconciliationError, _invariant, assert_inventory
from .store import Folder, publish


class Moved(ReconciliationError):
    """One of the tables changed since it was looked at; the synchronisation has to start anew."""


class SafeSync:
    def __init__(self, spark: SparkSession, root: str, key: str, changed: str, payload: list[str]):
        self.spark, self.folder, self.key, self.changed = spark, Folder(spark, root), key, changed
        self.columns = [key, changed, *[c for c in payload if c not in (key, changed)]]

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.root}/{name}")

    def _once(self, name: str, df: DataFrame) -> DataFrame:
        if not self.folder.exists(f"{name}/_SUCCESS"):
            df.write.mode("overwrite").parquet(f"{self.folder.root}/{name}")
        return self._read(name)

    def _seen(self, df: DataFrame, prefix: str) -> DataFrame:
        return df.select(self.key, F.col(self.changed).alias(f"{prefix}_changed"), payload_digest(*self.columns).alias(f"{prefix}_digest"), F.lit(True).alias(f"in_{prefix}"))

    def freeze(self, staging: DataFrame) -> DataFrame:
        if not self.folder.exists("frozen/_SUCCESS"):
            assert_inventory(staging.withColumn(self.changed, F.coalesce(self.changed, F.lit(0).cast("timestamp").cast("timestamp_ntz"))), self.key, self.changed, "staging")
        return self._once("frozen", self._seen(staging, "staged"))

    def preflight(self, production: DataFrame) -> dict[str, int]:
        """Counts of planned actions; a production row that is newer or cannot be compared stops everything."""
        both = self._read("frozen").join(self._seen(production, "produced"), self.key, "full")
        s, p = F.col("staged_changed"), F.col("produced_changed")
        action = (
            F.when(F.col("in_staged").isNull(), "delete").when(F.col("in_produced").isNull(), "insert")
            .when(s.eqNullSafe(p), "unchanged").when(p < s, "update").otherwise("conflict")
        )
        actions = self._once("actions", both.withColumn("action", action).drop("in_staged", "in_produced"))
        counts = {r.action: r["count"] for r in actions.groupBy("action").count().collect()}  # five at most
        if counts.get("conflict"):
            raise ReconciliationError(f"{counts['conflict']} production rows are newer than staging or cannot be compared")
        return {a: counts.get(a, 0) for a in ("insert", "update", "delete", "unchanged")}

    def _none(self, df: DataFrame, message: str) -> None:
        n = df.count()
        if n:
            raise Moved(f"{n} {message}")

    def apply(self, staging: DataFrame, production: DataFrame, target: str, version: str) -> str:
        """Publish production with its inserts and updates; a repeated call gives the same rows."""
        plan = self._read("actions").where("action IN ('insert', 'update')")
        now = plan.join(self._seen(staging, "now"), self.key, "left")
        self._none(now.where("in_now IS NULL OR now_digest <> staged_digest"), "staging rows changed since the freeze")
        there = plan.join(self._seen(production, "now"), self.key, "left")
        done = F.col("now_digest").eqNullSafe(F.col("staged_digest"))
        as_planned = F.when(F.col("action") == "insert", F.col("in_now").isNull()).otherwise(F.col("now_digest").eqNullSafe(F.col("produced_digest")))
        self._none(there.where(~(as_planned | done)), "production rows changed since the preflight")
        wanted = staging.join(plan, self.key, "left_semi").select(*self.columns)
        kept = production.join(plan, self.key, "left_anti").select(*self.columns)
        inserts = there.where("in_now IS NULL").count()
        return publish(kept.unionByName(wanted), target, version, planned=production.count() + inserts)

    def delete(self, staging: DataFrame, production: DataFrame, target: str, version: str) -> str:
        """The last step: production without the rows that the verified staging table does not hold."""
        frozen, now = self._read("frozen"), self._seen(staging, "now")
        apart = frozen.join(now, self.key, "full").where("in_staged IS NULL OR in_now IS NULL OR NOT staged_digest <=> now_digest")
        self._none(apart, "staging rows differ from the freeze; nothing is deleted")
        doomed = self._read("actions").where("action = 'delete'").select(self.key, "produced_digest")
        there = production.select(*self.columns).withColumn("_digest", payload_digest(*self.columns)).join(doomed, self.key, "left")
        self._none(there.where("produced_digest IS NOT NULL AND produced_digest <> _digest"), "rows to delete changed since the preflight")
        gone = there.where("produced_digest IS NOT NULL").count()
        return publish(there.where("produced_digest IS NULL").select(*self.columns), target, version, planned=production.count() - gone)


def sync_counts(staging: DataFrame, production: DataFrame, key: str, changed: str) -> DataFrame:
    """One row of planned actions without a folder: a dry run.  The actions must account for every production row."""
    s = staging.select(key, F.col(changed).alias("s"), F.lit(True).alias("in_s"))
    p = production.select(key, F.col(changed).alias("p"), F.lit(True).alias("in_p"))
    here, there, a, b = F.col("in_s").isNotNull(), F.col("in_p").isNotNull(), F.col("s"), F.col("p")
    same, older = a.eqNullSafe(b), F.coalesce(b < a, F.lit(False))
    n = F.count_if
    counts = s.join(p, key, "full").agg(
        n(there).alias("production_rows"), n(~there).alias("inserts"), n(here & there & ~same & older).alias("updates"), n(~here).alias("deletes"),
        n(here & there & same).alias("unchanged"), n(here & there & ~same & ~older).alias("conflicts"),
    )
    parts = F.col("updates") + F.col("deletes") + F.col("unchanged") + F.col("conflicts")
    return _invariant(counts, parts == F.col("production_rows"), "actions do not account for every production row")
