"""Views over version tables (intervals are ``[valid_from, valid_to)``; an open end is NULL or a far date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key under a total order.  Spark limits each group to one row before the shuffle
    (WindowGroupLimit), so a hot key does not fill a task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def latest_by_max(df: DataFrame, keys: list[str], order: list[str], take: list[str]) -> DataFrame:
    """Latest values per key as an aggregation (partial, no sort): the largest ``order`` tuple wins, NULL last."""
    pick = F.max(F.struct(*order, *[c for c in take if c not in order])).alias("_m")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in take])


def two_level_latest(df: DataFrame, link: str, parent: str, link_order: list[Column], parent_order: list[Column]) -> DataFrame:
    """The latest version of each link, then one link for each parent."""
    return latest_per_key(latest_per_key(df, [link], link_order), [parent], parent_order)


def valid_at(at: Column, start: str = "valid_from", end: str = "valid_to") -> Column:
    return (F.col(start) <= at) & (F.col(end).isNull() | (F.col(end) > at))


def as_of(history: DataFrame, at: Column, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions that are valid at one instant (a pushed-down filter)."""
    return history.where(valid_at(at, start, end))


def as_of_join(facts: DataFrame, history: DataFrame, keys: list[str], at: str, start: str = "valid_from", end: str = "valid_to", how: str = "left") -> DataFrame:
    """Join each fact with the versions valid at its own instant: equi-join on the keys, interval as residual."""
    h = history.withColumnsRenamed({k: f"_h_{k}" for k in keys})
    on = [F.col(k) == F.col(f"_h_{k}") for k in keys] + [valid_at(F.col(at), start, end)]
    cond = on[0]
    for c in on[1:]:
        cond &= c
    return facts.join(h, cond, how).drop(*[f"_h_{k}" for k in keys])


def open_versions(history: DataFrame, end: str = "valid_to", far: str | None = None) -> DataFrame:
    """Versions with an open end: NULL, or the far date that stands for it."""
    c = F.col(end)
    return history.where(c.isNull() | (c >= F.lit(far).cast("timestamp_ntz")) if far else c.isNull())


def allocate_share(df: DataFrame, group: str, weight: str, amount: Column, digits: int = 2) -> DataFrame:
    """``amount`` dealt to the rows of a group by weight and rounded; groups without weight get NULL.

    The group total comes from an aggregation joined back, so a large group needs no window.
    """
    total = df.groupBy(F.col(group).alias("_g")).agg(F.sum(weight).alias("_total"))
    j = df.join(total, F.col(group).eqNullSafe(F.col("_g")), "left")
    return j.withColumn("allocated", F.round(amount * F.col(weight) / F.nullif(F.col("_total"), F.lit(0)), digits)).drop("_g", "_total")


def banded_lookup(facts: DataFrame, bands: DataFrame, bounds: list[tuple[str, str, str]], take: str) -> DataFrame:
    """``take`` of the band whose inclusive bounds hold a fact; none or several give NULL with their number.

    ``bounds``: (fact column, low column, high column).  Bands are a small rule table (its rows
    are counted and must not exceed 10,000) and are broadcast; facts need a unique ``_id`` only within the plan.
    """
    if bands.count() > 10_000:
        raise ValueError("a band table of over 10,000 rows needs keyed bands")
    held = F.lit(True)
    for x, lo, hi in bounds:
        held &= (F.col(x) >= F.col(lo)) & (F.col(x) <= F.col(hi))
    distinct = facts.select(*[x for x, _, _ in bounds]).distinct()
    hits = distinct.join(F.broadcast(bands), held, "left").groupBy(*[x for x, _, _ in bounds]).agg(F.count(take).alias("bands"), F.max(take).alias("_v"))
    on = F.lit(True)
    r = hits.withColumnsRenamed({x: f"_r_{x}" for x, _, _ in bounds})
    for x, _, _ in bounds:
        on &= F.col(x).eqNullSafe(F.col(f"_r_{x}"))
    return facts.join(r, on, "left").withColumn(take, F.when(F.col("bands") == 1, F.col("_v"))).drop("_v", *[f"_r_{x}" for x, _, _ in bounds])


def current_and_closing(df: DataFrame, revisions: DataFrame, opened: str, closed: str, rev_key: str, rev_date: str) -> DataFrame:
    """Join a revision table twice (opening and closing); the change time is the closing date, else the opening one."""
    o = revisions.select(F.col(rev_key).alias(opened), F.col(rev_date).alias("opened_at"))
    c = revisions.select(F.col(rev_key).alias(closed), F.col(rev_date).alias("closed_at"))
    return df.join(o, opened, "left").join(c, closed, "left").withColumn("changed", F.coalesce("closed_at", "opened_at"))
