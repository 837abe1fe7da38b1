"""Incremental windows with a composite watermark: lower bound exclusive, upper bound frozen per run.

A window is a snapshot first, then applied, and only then the manifest advances, to the frozen bound
even if its last row is gone meanwhile.  A run that was interrupted applies the same snapshot again; a run
with nothing after its lower bound applies nothing.  The lock of the folder is held for the whole run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scans import frozen_window, tuple_after, upper_watermark
from .store import Folder


def effective_lower(full: bool, last_run: object | None, stored: object | None, column_switched: bool, fallback: object | None) -> tuple[object | None, str]:
    """Lower bound of a run and why: full loads and first runs have none, a switched change column falls back."""
    if full:
        return None, "full load"
    if last_run is None:
        return None, "first run"
    if column_switched:
        return fallback, "change column switched"
    return (stored, "stored watermark") if stored is not None else (fallback, "fallback")


class IncrementalLoad:
    def __init__(self, spark: SparkSession, root: str, changed: str, keys: list[str], fingerprint: str):
        self.spark, self.folder, self.changed, self.keys, self.fingerprint = spark, Folder(spark, root), changed, keys, fingerprint

    def state(self) -> dict | None:
        s = self.folder.read_json("watermark.json")
        if s is not None and s["fingerprint"] != self.fingerprint:
            raise ValueError("the watermark belongs to another load")
        return s

    def bootstrap(self, lower: list | None, acknowledged: bool = False) -> None:
        """The first window must be opened on purpose."""
        if self.state() is not None or not acknowledged:
            raise ValueError("there is a watermark already, or the bootstrap was not acknowledged")
        self._save({"lower": lower})

    def adapt(self, target: DataFrame, dry_run: bool = True) -> object:
        """Watermark from the target's largest change time."""
        top = target.agg(F.max(self.changed).cast("string").alias("t")).first().t
        if not dry_run:
            self._save({"lower": [top, *[None] * len(self.keys)] if top else None})
        return top

    def _save(self, body: dict) -> None:
        self.folder.write_json("watermark.json", body | {"fingerprint": self.fingerprint, "changed": self.changed})

    def _typed(self, source: DataFrame, values: list) -> list:
        return [F.lit(v).cast(source.schema[c].dataType) for c, v in zip((self.changed, *self.keys), values, strict=False)]

    def _is_after(self, source: DataFrame, upper: list, lower: list | None) -> bool:
        """Whether the upper tuple lies after the lower one, compared as the columns' types."""
        if lower is None:
            return True
        known = [x for x in lower if x is not None]
        up, lo = self._typed(source, upper[: len(known)]), self._typed(source, known)
        return bool(self.spark.range(1).select(tuple_after(up, lo).alias("later")).first().later)

    def run(self, source: DataFrame, apply: Callable[[DataFrame], None], full: bool = False, fallback: list | None = None) -> dict:
        """Freeze (or resume) a window, snapshot it, apply it, advance.

        ``full`` starts without a lower bound; ``fallback`` is the lower bound when the change column is another
        than the one of the stored watermark.
        """
        with self.folder.lock():
            return self._run(source, apply, full, fallback)

    def _run(self, source: DataFrame, apply: Callable[[DataFrame], None], full: bool, fallback: list | None) -> dict:
        state = self.state()
        if state is None:
            raise ValueError("no watermark: bootstrap first")
        if "upper" not in state:
            switched = state.get("changed") not in (None, self.changed)
            lower, why = effective_lower(full, state.get("runs") or state["lower"], state["lower"], switched, fallback)
            row = upper_watermark(source, self.changed, self.keys).first()
            if row[self.changed] is None:
                return {"rows": 0, "lower": lower, "why": why}
            upper = [str(row[c]) for c in (self.changed, *self.keys)]
            if not self._is_after(source, upper, lower):
                return {"rows": 0, "lower": lower, "why": why}
            state = {"lower": lower, "upper": upper, "why": why, "runs": state.get("runs") or 0}
            self._save(state)
        lower, upper = state["lower"], state["upper"]
        bounds = "-".join(["" if x is None else str(x) for x in (lower or ["start"])] + ["to", *upper])
        name = f"window-{state['runs']}-" + "".join(c if c.isalnum() else "_" for c in bounds)
        if not self.folder.exists(f"{name}/_SUCCESS"):
            rows = frozen_window(source, self.changed, self.keys, None, tuple(upper))
            if lower is not None:
                known = [x for x in lower if x is not None]
                if len(known) == len(lower):
                    rows = frozen_window(source, self.changed, self.keys, tuple(lower), tuple(upper))
                else:  # a watermark adapted from the target has a time only
                    rows = rows.where(F.col(self.changed) > self._typed(source, lower)[0])
            rows.write.mode("overwrite").parquet(f"{self.folder.root}/{name}")
        snapshot = self.spark.read.parquet(f"{self.folder.root}/{name}")
        apply(snapshot)
        self._save({"lower": upper, "runs": state["runs"] + 1})
        return {"rows": snapshot.count(), "lower": upper, "why": state.get("why")}
