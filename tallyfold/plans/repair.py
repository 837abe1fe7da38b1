"""Two-phase repair: prepare a durable diff, review it, apply it with fresh checks, verify."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import delta
from . import rewrite
from .contracts import RunIdentity
from .store import Folder, publish


@dataclass
class Repair:
    """A run in one folder; every step can be repeated and a resumed run must have the same identity.

    Other leeways make another diff: reopening a run with them clears what was prepared, unless it was applied.
    """

    spark: SparkSession
    root: str
    identity: RunIdentity
    key: str = "key"
    changed: str = "changed"
    ahead_leeway: bool = False
    behind_leeway: bool = False

    def __post_init__(self) -> None:
        self.folder = Folder(self.spark, self.root)
        seen, mine = self.folder.read_json("run.json"), {"fingerprint": self.identity.fingerprint(), **self._leeway}
        if seen is not None and seen["fingerprint"] != mine["fingerprint"]:
            raise ValueError("the folder belongs to another run")
        if seen is not None and seen != mine:
            if self.folder.exists("outcomes"):
                raise ValueError("the run was applied with other leeways")
            self.folder.delete("diff")
        if seen != mine:
            self.folder.write_json("run.json", mine)

    @property
    def _leeway(self) -> dict:
        return {"ahead_leeway": self.ahead_leeway, "behind_leeway": self.behind_leeway}

    def prepare(self, source: DataFrame, target: DataFrame, cutoff, min_date=None) -> DataFrame:
        """Write the diff once; later calls return what was written."""
        if not self.folder.exists("diff/_SUCCESS"):
            delta.assert_inventory(source, self.key, self.changed, "source")
            delta.assert_inventory(target, self.key, self.changed, "target")
            make = delta.prepare_diff(source, target, cutoff, self.key, self.changed, **self._leeway) if min_date is None else delta.min_date_diff(source, target, min_date, cutoff, self.key, self.changed, **self._leeway)
            make.write.mode("overwrite").parquet(f"{self.root}/diff")
        return self.spark.read.parquet(f"{self.root}/diff")

    def apply(self, fresh: DataFrame, target: DataFrame, version: str, payload: list[str]) -> DataFrame:
        """Publish the next version of the target and return the outcome of each planned row."""
        plan = self.spark.read.parquet(f"{self.root}/diff")
        outcome = delta.apply_recheck(plan, fresh, target, self.key, self.changed, **self._leeway)
        outcome.write.mode("overwrite").parquet(f"{self.root}/outcomes/{version}")
        done = self.spark.read.parquet(f"{self.root}/outcomes/{version}")
        written = fresh.join(done.where("outcome = 'written'").select(self.key), self.key, "left_semi").select(self.key, self.changed, *payload)
        doomed = plan.where("action = 'remove'").select(self.key, F.col("target_changed").alias(self.changed))
        publish(rewrite.guarded_delete(rewrite.upsert(target, written, [self.key]), doomed, [self.key], self.changed), f"{self.root}/target", version)
        return done

    def verify(self, source: DataFrame, target: DataFrame, cutoff) -> dict:
        return delta.verify_counts(source, target, cutoff, keys=self.key, changed=self.changed, **self._leeway).first().asDict()
