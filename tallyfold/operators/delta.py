"""Keyed reconciliation of two inventories.

An inventory is a DataFrame ``key changed`` (key of one or more columns, change time as
``timestamp_ntz`` in UTC).  All comparisons are one full outer equi-join of two narrow inputs, left to
AQE; no payload is read before the differences are known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000


class ReconciliationError(ValueError):
    """An inventory breaks a rule that a repair relies on."""


def _keys(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def assert_inventory(df: DataFrame, keys: str | list[str] = "key", changed: str = "changed", side: str = "source") -> None:
    """NULL keys, NULL change times and duplicate keys are errors (one aggregate job, partial sums first)."""
    ks = _keys(keys)
    any_null = F.lit(False)
    for k in ks:
        any_null |= F.col(k).isNull()
    per_key = df.groupBy(*ks).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(changed).isNull()).alias("no_time"))
    row = per_key.agg(F.sum(F.when(any_null, F.col("n"))).alias("null_keys"), F.sum("no_time").alias("null_times"), F.count_if((F.col("n") > 1) & ~any_null).alias("duplicates")).first()
    for what in ("null_keys", "null_times", "duplicates"):
        if row[what]:
            raise ReconciliationError(f"{side}: {row[what]} {what.replace('_', ' ')}")


def micros_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later)


def decision(source: Column, target: Column, ahead_leeway: bool = False, behind_leeway: bool = False, in_source: Column | None = None, in_target: Column | None = None) -> Column:
    """insert / update / remove / ahead / equal.  Leeways are one second, inclusive, and independent.

    A row is there if ``in_source`` / ``in_target`` says so; only without them does a NULL time stand for a missing
    row.  Rows on both sides of which one has no time are ``undated``: nothing is decided about them.
    """
    no_source = source.isNull() if in_source is None else ~in_source
    no_target = target.isNull() if in_target is None else ~in_target
    apart = F.abs(micros_between(source, target)) <= MICROS_PER_SECOND
    near = F.lit(False)
    if ahead_leeway:
        near |= (target > source) & apart
    if behind_leeway:
        near |= (target < source) & apart
    ladder = F.when(no_source, "remove").when(no_target, "insert").when(source.isNull() | target.isNull(), "undated")
    return ladder.when(near, "equal").when(target < source, "update").when(target > source, "ahead").otherwise("equal")


def _decided(both: DataFrame, ahead_leeway: bool, behind_leeway: bool) -> DataFrame:
    """``side_by_side`` rows with their ``action``."""
    c = F.col
    action = decision(c("source_changed"), c("target_changed"), ahead_leeway, behind_leeway, c("in_source"), c("in_target"))
    return both.withColumn("action", action).drop("in_source", "in_target")


def side_by_side(source: DataFrame, target: DataFrame, keys: str | list[str] = "key", changed: str = "changed") -> DataFrame:
    """Full outer join: keys, ``source_changed``, ``target_changed``, ``in_source``, ``in_target``."""
    ks = _keys(keys)
    s = source.select(*ks, F.col(changed).alias("source_changed"), F.lit(True).alias("in_source"))
    t = target.select(*ks, F.col(changed).alias("target_changed"), F.lit(True).alias("in_target"))
    return s.join(t, ks, "full").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_source", "in_target")})


def classify(source: DataFrame, target: DataFrame, keys: str | list[str] = "key", changed: str = "changed", ahead_leeway: bool = False, behind_leeway: bool = False) -> DataFrame:
    """Every key of either side with its ``action``."""
    both = side_by_side(source, target, keys, changed)
    return _decided(both, ahead_leeway, behind_leeway)


def prepare_diff(source: DataFrame, target: DataFrame, cutoff: Column, keys: str | list[str] = "key", changed: str = "changed", ahead_leeway: bool = False, behind_leeway: bool = False) -> DataFrame:
    """The full-scan diff bounded by a cutoff.

    Source rows beyond the cutoff prove that their key exists (no removal) and do nothing else; target rows beyond
    the cutoff are not seen, so their source keys within it come out as inserts, which the apply step
    turns into warnings.  Rows without a change time are seen on both sides and come out as ``undated``.
    """
    both = side_by_side(source, target.where((F.col(changed) <= cutoff) | F.col(changed).isNull()), keys, changed)
    within = both.where(~F.col("in_source") | (F.col("source_changed") <= cutoff) | F.col("source_changed").isNull())
    return _decided(within, ahead_leeway, behind_leeway)


def min_date_diff(source: DataFrame, target: DataFrame, min_date: Column, cutoff: Column, keys: str | list[str] = "key", changed: str = "changed", ahead_leeway: bool = False, behind_leeway: bool = False) -> DataFrame:
    """The windowed diff: absence proves nothing, and target rows are looked up without the cutoff."""
    ks = _keys(keys)
    s = source.where((F.col(changed) >= min_date) & (F.col(changed) <= cutoff)).select(*ks, F.col(changed).alias("source_changed"), F.lit(True).alias("in_source"))
    t = target.select(*ks, F.col(changed).alias("target_changed"), F.lit(True).alias("in_target"))
    return _decided(s.join(t, ks, "left").withColumn("in_target", F.coalesce("in_target", F.lit(False))), ahead_leeway, behind_leeway)


def apply_recheck(plan: DataFrame, fresh: DataFrame, target_now: DataFrame, keys: str | list[str] = "key", changed: str = "changed", ahead_leeway: bool = False, behind_leeway: bool = False) -> DataFrame:
    """Outcome of planned inserts and updates against what both sides hold now.

    ``disappeared``: the source row is gone; ``changed``: its change time differs from the plan; ``ahead``: the target
    became newer; ``undated``: one side has no time any more; ``kept``: equal only by leeway with an older
    target; else ``written`` (an exactly equal row is written again).
    """
    ks = _keys(keys)
    p = plan.where(F.col("action").isin("insert", "update")).select(*ks, F.col("source_changed").alias("planned"))
    f = fresh.select(*ks, F.col(changed).alias("fresh_changed"), F.lit(True).alias("in_fresh"))
    t = target_now.select(*ks, F.col(changed).alias("now_changed"), F.lit(True).alias("in_now"))
    there = lambda c: F.coalesce(c, F.lit(False))
    now = decision(F.col("fresh_changed"), F.col("now_changed"), ahead_leeway, behind_leeway, there("in_fresh"), there("in_now"))
    outcome = (
        F.when(F.col("in_fresh").isNull(), "disappeared").when(~F.col("fresh_changed").eqNullSafe(F.col("planned")), "changed").when(now.isin("ahead", "undated"), now)
        .when((now == "equal") & (F.col("now_changed") < F.col("fresh_changed")), "kept").otherwise("written")
    )
    return p.join(f, ks, "left").join(t, ks, "left").withColumn("outcome", outcome).drop("in_fresh", "in_now")


def verify_counts(source: DataFrame, target: DataFrame, cutoff: Column, **options) -> DataFrame:
    """One row after an apply: eligible source keys, equal, updates, inserts, removals, warnings."""
    d = prepare_diff(source, target, cutoff, **options)
    n = lambda a: F.count_if(F.col("action") == a)
    return d.agg(F.count_if(F.col("action") != "remove").alias("source_eligible"), n("equal").alias("equal"), n("update").alias("updates"), n("insert").alias("inserts"), n("remove").alias("removals"), n("ahead").alias("warnings"))


def plan_changes(source: DataFrame, target: DataFrame, keys: str | list[str] = "key", changed: str = "changed", ignore_change: bool = False) -> DataFrame:
    """delete / insert / unchanged / update / conflict (one change time is NULL, or the target is newer)."""
    both = side_by_side(source, target, keys, changed)
    s, t = F.col("source_changed"), F.col("target_changed")
    common = F.lit("unchanged") if ignore_change else F.when(s.eqNullSafe(t), "unchanged").when(t < s, "update").otherwise("conflict")
    return both.withColumn("action", F.when(~F.col("in_source"), "delete").when(~F.col("in_target"), "insert").otherwise(common)).drop("in_source", "in_target")


def newer_write_set(source: DataFrame, target: DataFrame, keys: str | list[str] = "key", changed: str = "changed") -> DataFrame:
    """Source rows that are absent from the target or strictly newer; a newer target is an error."""
    both = side_by_side(source, target, keys, changed)
    ahead = count_target_newer(source, target, keys, changed)
    if ahead:
        raise ReconciliationError(f"{ahead} target rows are newer than their source")
    ks = _keys(keys)
    wanted = both.where(F.col("in_source") & (~F.col("in_target") | F.col("target_changed").isNull() | (F.col("source_changed") > F.col("target_changed")))).select(*ks)
    return source.join(wanted, ks, "left_semi")


def count_target_newer(source: DataFrame, target: DataFrame, keys: str | list[str] = "key", changed: str = "changed") -> int:
    ks = _keys(keys)
    t = target.select(*ks, F.col(changed).alias("_t"))
    return source.select(*ks, F.col(changed).alias("_s")).join(t, ks).where("_t > _s").count()


# ---- audits --------------------------------------------------------------------------------------


def window_audit(source: DataFrame, target: DataFrame, start: Column, end: Column, bound: Column | None = None, key: str = "key", changed: str = "changed", target_id: str = "target_id") -> DataFrame:
    """Categories of all keys with a change time in ``[start, end)`` on either side, and of keys with none at all.

    NULL keys and keys that are duplicated in the source are left to :func:`anomalies`.
    """
    inside = lambda c: (c >= start) & (c < end)
    flags = lambda p: (F.count(F.lit(1)).alias(f"{p}_n"), F.max(F.coalesce(inside(F.col(changed)), F.lit(False))).alias(f"{p}_in"), F.count(changed).alias(f"{p}_dated"))
    # a key that stays is there once in the source at most, so its source time comes with the counts
    s = source.where(F.col(key).isNotNull()).groupBy(key).agg(*flags("s"), F.max(changed).alias("source_changed"))
    cohort = s.join(target.where(F.col(key).isNotNull()).groupBy(key).agg(*flags("t")), key, "full")
    z = lambda c: F.coalesce(c, F.lit(0))
    hit = F.coalesce("s_in", F.lit(False)) | F.coalesce("t_in", F.lit(False))
    undated = (z("s_dated") == 0) & (z("t_dated") == 0)
    cohort = cohort.where((hit | undated) & (z("s_n") <= 1)).select(key, F.when(hit, "WINDOW").otherwise("UNKNOWN_DATE").alias("scope"), z("t_n").cast("long").alias("target_count"), "source_changed", (z("s_n") == 1).alias("_s"))
    t = target.select(key, F.col(changed).alias("target_changed"), F.col(target_id).alias("target_id"), F.lit(True).alias("_t"))
    j = cohort.join(t, key, "left")
    sc, tc = F.col("source_changed"), F.col("target_changed")
    category = F.when(~F.col("_s"), "TARGET_ONLY").when(F.col("_t").isNull(), "MISSING_TARGET").when(sc.isNull() | tc.isNull(), "NULL_CHANGE").when(sc == tc, "EQUAL").when(sc > tc, "TARGET_STALE").otherwise("TARGET_AHEAD")
    to_bound = F.lit("UNKNOWN") if bound is None else F.when(bound.isNull() | sc.isNull(), "UNKNOWN").when(sc < bound, "BELOW").when(sc == bound, "AT").otherwise("ABOVE")
    return j.select("scope", key, "target_id", "source_changed", "target_changed", "target_count", category.alias("category"), to_bound.alias("relative_bound"), (~inside(sc)).alias("source_outside"), (~inside(tc)).alias("target_outside"))


def anomalies(source: DataFrame, target: DataFrame, key: str = "key", changed: str = "changed") -> DataFrame:
    """Rows of either side with a NULL key, a NULL change time or a key found more than once on that side.

    Keys are counted by aggregation, and those found more than once are joined back, so one hot key is split by AQE
    instead of filling a window.  They are dealt anew, or the join would hold the table of all keys beside its rows.
    """
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def one(df: DataFrame, side: str) -> DataFrame:
        n = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").repartition(parts)
        rows = df.select(F.lit(side).alias("side"), key, changed).join(n, key, "left")
        count = F.when(F.col(key).isNotNull(), F.coalesce("n", F.lit(1)).cast("long")).alias("same_side_key_count")
        return rows.where(F.col(key).isNull() | F.col(changed).isNull() | F.col("n").isNotNull()).select("side", key, changed, count)

    return one(source, "SOURCE").unionByName(one(target, "TARGET"))


def watermark_gaps(source: DataFrame, target: DataFrame, watermark: Column, shifted: Column, key: str = "key", changed: str = "changed") -> DataFrame:
    """Counters of missing and stale keys around a watermark and in the window up to a shifted one.

    Flags are raised per key first (the join has dealt the rows by key already), then the flags are counted.
    """
    s = source.where(F.col(key).isNotNull()).select(key, F.col(changed).alias("s"))
    t = target.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(changed).alias("t"), F.lit(True).alias("there"))
    at, missing, stale = F.col("s"), F.col("there").isNull(), F.col("s") > F.col("t")
    flags = {
        "missing_keys": missing, "missing_at_or_before": missing & (at <= watermark), "missing_after": missing & (at > watermark),
        "missing_in_shifted_window": missing & (at >= watermark) & (at < shifted), "stale_keys": stale, "stale_at_or_before": stale & (at <= watermark),
    }
    per_key = s.join(t, key, "left").groupBy(key).agg(*[F.max(c).alias(n) for n, c in flags.items()])
    return per_key.agg(*[F.count_if(n).alias(n) for n in flags])


def inferred_windows(source: DataFrame, target: DataFrame, shift: str, key: str = "key", changed: str = "changed", loaded: str = "loaded") -> DataFrame:
    """Load stamps whose maximal change time opens a window ``[max, max + shift)`` that holds missing keys.

    Loads are bucketed by the shift and each missing key is looked up in two buckets: an equi-join
    instead of a range join over all loads.
    """
    missing = source.join(target.select(key), key, "left_anti").select(key, F.col(changed).alias("s"))
    loads = target.where(F.col(changed).isNotNull()).groupBy(loaded).agg(F.max(changed).alias("from")).where(F.col("from") <= F.col(loaded))
    width = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.lit("1970-01-01").cast("timestamp_ntz") + F.expr(f"INTERVAL {shift}"))
    bucket = lambda c: F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), c) / width)
    m = missing.withColumn("b", bucket(F.col("s")))
    w = loads.withColumn("b", F.explode(F.array(bucket(F.col("from")), bucket(F.col("from")) + 1)))
    hit = m.join(w, "b").where((F.col("s") >= F.col("from")) & (F.col("s") < F.col("from") + F.expr(f"INTERVAL {shift}")))
    return hit.groupBy(loaded, "from").agg(F.count_distinct(key).alias("missing_keys"), F.min("s").alias("earliest"), F.max("s").alias("latest"))


def observation_diff(first: DataFrame, latest: DataFrame, fields: list[str], key: str = "key", changed: str = "changed") -> DataFrame:
    """Differences of two complete snapshots: new, absent and changed keys; ``late`` marks a new key that is older than
    everything the first snapshot reached."""
    top = first.agg(F.max(changed).alias("top"))
    b = first.select(key, *[F.col(f).alias(f"b_{f}") for f in fields], F.lit(True).alias("_b"))
    n = latest.select(key, *[F.col(f).alias(f"n_{f}") for f in fields], F.lit(True).alias("_n"))
    j = b.join(n, key, "full").crossJoin(F.broadcast(top))  # one row
    new, absent = F.col("_b").isNull(), F.col("_n").isNull()
    text = lambda c: c.cast("string")
    at = lambda p: text(F.col(f"{p}_{changed}"))
    none = F.lit(None).cast("string")
    item = lambda kind, field, old, now, late: F.struct(F.lit(kind).alias("category"), F.lit(field).alias("field"), old.alias("old_value"), now.alias("new_value"), late.alias("late"))
    nothing = F.lit(None).cast("boolean")
    late = F.when(F.col("top").isNotNull(), F.coalesce(F.col(f"n_{changed}") < F.col("top"), F.lit(False)))
    items = [F.when(new, item("NEW_KEY", changed, none, at("n"), late)), F.when(absent, item("ABSENT_KEY", changed, at("b"), none, nothing))]
    for f in fields:
        kind = "CHANGED_TIMESTAMP" if f == changed else "CHANGED_AUDIT_TIMESTAMP"
        items.append(F.when(~new & ~absent & ~F.col(f"b_{f}").eqNullSafe(F.col(f"n_{f}")), item(kind, f, text(F.col(f"b_{f}")), text(F.col(f"n_{f}")), nothing)))
    return j.select(key, F.explode(F.array_compact(F.array(*items))).alias("d")).select(key, "d.*")


def date_movement(before: DataFrame, after: DataFrame, low: Column, key: str = "key", changed: str = "changed") -> DataFrame:
    """Counts of how change times moved between two snapshots.

    Backward, forward, unchanged and absent keys must add up to the keys before; if they do not (a row has no
    time), the query fails.
    """
    b = before.select(key, F.col(changed).alias("b"))
    a = after.select(key, F.col(changed).alias("a"), F.lit(True).alias("there"))
    j = b.join(a, key, "left").crossJoin(F.broadcast(before.agg(F.max(changed).alias("top"))))  # one row
    there = F.col("there").isNotNull()
    n = F.count_if
    counts = j.agg(
        F.count(F.lit(1)).alias("keys"), n(there & (F.col("a") < F.col("b"))).alias("backward"), n(there & (F.col("a") > F.col("b"))).alias("forward"), n(there & F.col("a").eqNullSafe(F.col("b"))).alias("unchanged"), n(~there).alias("absent"),
        n(there & (F.col("b") >= low) & (F.col("a") < low)).alias("moved_below_window"), n(there & (F.col("a") > F.col("b")) & (F.col("a") < F.col("top"))).alias("forward_but_late"),
    )
    parts = F.col("backward") + F.col("forward") + F.col("unchanged") + F.col("absent")
    return _invariant(counts, parts == F.col("keys"), "moved and absent keys do not add up to the keys before")


def _invariant(counts: DataFrame, holds: Column, message: str) -> DataFrame:
    """One row of counts that cannot be read unless the invariant holds."""
    first, *rest = counts.columns
    return counts.select(F.when(holds, F.col(first)).otherwise(F.raise_error(F.lit(message)).cast("long")).alias(first), *rest)


def window_movement(before: DataFrame, after: DataFrame, low: Column, key: str = "key", changed: str = "changed") -> DataFrame:
    """Rows that an observed window ``changed >= low`` gained and lost: the rows now are the rows before, plus new
    keys, minus absent ones, minus those that moved below the window; if that does not hold, the query fails."""
    b = before.where(F.col(changed) >= low).select(key, F.col(changed).alias("b"))
    a = after.select(key, F.col(changed).alias("a"))
    j = b.join(a, key, "full")
    was, now, there = F.col("b").isNotNull(), F.col("a") >= low, F.col("a").isNotNull()
    n = F.count_if
    counts = j.agg(n(was).alias("old_rows"), n(now).alias("new_rows"), n(now & ~was).alias("new_keys"), n(was & ~there).alias("absent"), n(was & there & ~now).alias("moved_below"))
    holds = F.col("new_rows") == F.col("old_rows") + F.col("new_keys") - F.col("absent") - F.col("moved_below")
    return _invariant(counts, holds, "the window's rows do not add up")


def compare_capture(source: DataFrame, target: DataFrame, key: str = "key", changed: str = "changed", loaded: str | None = None) -> DataFrame:
    """``key s t loaded category`` for every source key: MISSING, EQUAL, STALE or AHEAD_OR_NULL."""
    stamp = F.lit(None).cast("timestamp_ntz") if loaded is None else F.col(loaded)
    t = target.select(key, F.col(changed).alias("t"), stamp.alias("loaded"), F.lit(True).alias("there"))
    j = source.select(key, F.col(changed).alias("s")).join(t, key, "left")
    s, t_ = F.col("s"), F.col("t")
    category = F.when(F.col("there").isNull(), "MISSING").when(s == t_, "EQUAL").when(s > t_, "STALE").otherwise("AHEAD_OR_NULL")
    return j.withColumn("category", category).drop("there")


def gap_cohorts(source: DataFrame, target: DataFrame, key: str = "key", changed: str = "changed") -> DataFrame:
    """Gaps (missing and stale keys) by source month and, for stale ones, target month."""
    gaps = compare_capture(source, target, key, changed).where("category IN ('MISSING', 'STALE')")
    by = [F.lower("category").alias("gap"), F.date_format("s", "yyyy-MM").alias("source_month"), F.date_format("t", "yyyy-MM").alias("target_month")]
    return gaps.groupBy(*by).agg(F.count(F.lit(1)).alias("keys"), F.min("s").alias("earliest"), F.max("s").alias("latest"))


def gap_days(compared: DataFrame) -> DataFrame:
    """Keys that are not equal by source day."""
    per = compared.where("category <> 'EQUAL'").groupBy(F.date_format("s", "yyyy-MM-dd").alias("day"))
    return per.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("category") == "MISSING").alias("missing"), F.min("s").alias("earliest"), F.max("s").alias("latest"))


def gap_loads(compared: DataFrame) -> DataFrame:
    """Keys of the target by load stamp: all, and stale ones."""
    per = compared.where("category <> 'MISSING'").groupBy("loaded")
    return per.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("category") == "STALE").alias("stale"), F.min("s").alias("earliest"), F.max("s").alias("latest"))


def gap_ties(compared: DataFrame) -> DataFrame:
    """Source change times of which some key has a gap, with all keys that share the time."""
    n = lambda c: F.count_if(F.col("category") == c)
    per = compared.groupBy(F.col("s").alias("changed")).agg(F.count(F.lit(1)).alias("keys"), n("EQUAL").alias("equal"), n("MISSING").alias("missing"), n("STALE").alias("stale"))
    return per.where("keys <> equal")


def merge_audit(source: DataFrame, target: DataFrame, cutoff: Column, keys: list[str], changed: str = "changed") -> DataFrame:
    """Differences of two key-ordered streams below a strict cutoff: source_only, target_only, date_mismatch."""
    both = side_by_side(source.where(F.col(changed) < cutoff), target.where(F.col(changed) < cutoff), keys, changed)
    kind = F.when(~F.col("in_target"), "source_only").when(~F.col("in_source"), "target_only").when(~F.col("source_changed").eqNullSafe(F.col("target_changed")), "date_mismatch")
    return both.withColumn("difference", kind).where("difference IS NOT NULL").drop("in_source", "in_target")


# ---- mirrors ---------------------------------------------------------------------------------------


def one_time_per_key(df: DataFrame, key: str = "key", changed: str = "changed") -> DataFrame:
    """``key changed`` with identical rows as one; a key whose rows differ fails the query."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count(changed).alias("dated"), F.min(changed).alias("low"), F.max(changed).alias("high"))
    agree = (F.col("dated") == 0) | ((F.col("dated") == F.col("n")) & (F.col("low") == F.col("high")))
    kind = df.schema[changed].dataType
    fail = F.raise_error(F.concat(F.lit("rows with one key differ: "), F.col(key).cast("string"))).cast(kind)
    return per.select(key, F.when(agree, F.col("high")).otherwise(fail).alias(changed))


def mirror_delta(source: DataFrame, mirror: DataFrame, key: str = "key", changed: str = "changed", full_refresh: bool = False, allow_empty: bool = False) -> DataFrame:
    """inserted / updated (NULL or different change time) / unchanged / deleted per key.

    Identical source rows count once and conflicting ones are an error; an empty source does not delete a mirror
    that holds rows unless ``allow_empty``.
    """
    if not allow_empty:
        guard_empty_source(source, mirror)
    both = side_by_side(one_time_per_key(source, key, changed), mirror, key, changed)
    moved = F.lit(True) if full_refresh else F.col("source_changed").isNull() | ~F.col("source_changed").eqNullSafe(F.col("target_changed"))
    state = F.when(~F.col("in_source"), "deleted").when(~F.col("in_target"), "inserted").when(moved, "updated").otherwise("unchanged")
    return both.withColumn("state", state).drop("in_source", "in_target")


def mirror_stats(delta: DataFrame) -> DataFrame:
    n = lambda *s: F.count_if(F.col("state").isin(*s))
    return delta.agg(n("inserted", "updated", "unchanged").alias("source"), n("inserted", "updated").alias("wanted"), n("inserted").alias("inserted"), n("updated").alias("updated"), n("unchanged").alias("unchanged"), n("deleted").alias("deleted"))


def guard_empty_source(source: DataFrame, mirror: DataFrame) -> None:
    """An empty source never empties a mirror that holds rows."""
    if source.isEmpty() and not mirror.isEmpty():
        raise ReconciliationError("the source is empty and the mirror is not")


def guard_stable_count(before: int, after: int) -> None:
    if before != after:
        raise ReconciliationError(f"the source changed during the run: {before} and {after} rows")


def assert_clean(gaps: DataFrame) -> None:
    """Gate: any row in a gap report is an error."""
    if not gaps.isEmpty():
        raise ReconciliationError("gaps remain")
