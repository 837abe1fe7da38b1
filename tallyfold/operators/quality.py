"""Proofs about tables: uniqueness, parity, high-water marks, drift, row and column comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def prove_source(df: DataFrame, membership: str, page: list[str]) -> DataFrame:
    """One row: total, NULL keys, distinct membership keys, distinct page tuples, rows with a NULL in the page.

    Distinct counts are aggregations, so no task sees all values.  Tuples and membership keys are counted beside each
    other and not on top of each other, so a task holds one table of keys at a time.
    """
    null_page = F.lit(False)
    for p in page:
        null_page |= F.col(p).isNull()
    by_page = df.groupBy(*page).agg(F.count(F.lit(1)).alias("_n"))
    a = df.groupBy(membership).agg(F.count(F.lit(1)).alias("_n")).agg(F.sum("_n").alias("total_rows"), F.sum(F.when(F.col(membership).isNull(), F.col("_n")).otherwise(0)).alias("null_keys"), F.count(membership).alias("distinct_keys"))
    b = by_page.agg(F.count_if(~null_page).alias("distinct_pages"), F.sum(F.when(null_page, F.col("_n")).otherwise(0)).alias("null_page_rows"))
    return a.crossJoin(b)  # one row each


def duplicates(df: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """Keys found more than once: ``n`` rows, ``versions`` different payloads (NULLs compare as equal).

    Rows are counted before they are dealt by key, so of a hot key only its different payloads come to one task.  They
    are dealt to all partitions, because a key's payloads and the keys together would fill coalesced ones.
    """
    per = df.groupBy(*keys, *payload).agg(F.count(F.lit(1)).alias("n"))
    per = per.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    return per.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("versions")).where("n > 1")


def collapse_identical(df: DataFrame, keys: list[str]) -> DataFrame:
    """Identical duplicates become one row; conflicting ones are an error."""
    one = df.dropDuplicates()
    if set(df.columns) <= set(keys):  # nothing is left that could differ
        return one
    dealt = one.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)  # as in duplicates()
    if not dealt.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError("rows with one key differ")
    return one


def parity(source: DataFrame, target: DataFrame, changed: str, cutoff: Column) -> DataFrame:
    """Counts of both sides: all, up to the cutoff, up to the cutoff with times rounded to seconds (half up)."""
    rounded = F.date_trunc("SECOND", (F.col(changed) + F.expr("INTERVAL 500000 MICROSECOND")).cast("timestamp_ntz"))
    one = lambda df, p: df.agg(F.count(F.lit(1)).alias(f"{p}_rows"), F.count_if(F.col(changed) <= cutoff).alias(f"{p}_to_cutoff"), F.count_if(rounded <= cutoff).alias(f"{p}_rounded"))
    return one(source, "source").crossJoin(one(target, "target"))  # one row each


def high_water(source: DataFrame, target: DataFrame, changed: str) -> DataFrame:
    """Maximal change times of both sides and the source rows at or after, and after, the target's."""
    top = target.agg(F.max(changed).alias("target_max"))
    j = source.select(changed).crossJoin(F.broadcast(top))  # one row
    c, t = F.col(changed), F.col("target_max")
    return j.groupBy("target_max").agg(F.max(changed).alias("source_max"), F.count_if(c >= t).alias("candidates_inclusive"), F.count_if(c > t).alias("candidates_strict"))


def row_compare(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Full outer comparison: ``presence`` and the ``changed_columns`` (none if the rows are equal) of every key."""
    l = left.select(*keys, *[F.col(c).alias(f"l_{c}") for c in columns], F.lit(True).alias("_l"))
    r = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in columns], F.lit(True).alias("_r"))
    j = l.join(r, keys, "full")
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    differs = [F.when(both & ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), F.lit(c)) for c in columns]
    presence = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    return j.select(*keys, presence.alias("presence"), F.array_compact(F.array(*differs)).alias("changed_columns"))


def mismatch_counts(compared: DataFrame, columns: list[str]) -> DataFrame:
    """One row: keys per presence and mismatches per column."""
    n = lambda p: F.count_if(F.col("presence") == p).alias(p)
    return compared.agg(n("left_only"), n("right_only"), n("both"), *[F.count_if(F.array_contains("changed_columns", c)).alias(f"{c}_mismatches") for c in columns])


def difference_examples(compared: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` keys of each kind of difference, in key order: a report's examples."""
    kind = F.when(F.col("presence") != "both", F.col("presence")).when(F.size("changed_columns") > 0, "different")
    w = Window.partitionBy("kind").orderBy(*keys)
    return compared.withColumn("kind", kind).where("kind IS NOT NULL").withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n).drop("nth")


def mapped_payload_audit(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Comparison where a NULL source value keeps the target's: per column equal, different and preserved counts."""
    l = source.select(*keys, *[F.col(c).alias(f"l_{c}") for c in columns])
    j = l.join(target.select(*keys, *[F.col(c).alias(f"r_{c}") for c in columns]), keys)
    parts = [F.struct(F.lit(c).alias("column"), F.when(F.col(f"l_{c}").isNull() & F.col(f"r_{c}").isNotNull(), "preserved").when(F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")), "equal").otherwise("different").alias("state")) for c in columns]
    return j.select(F.explode(F.array(*parts)).alias("p")).groupBy("p.column", "p.state").agg(F.count(F.lit(1)).alias("n"))


def audit_with_control(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str], control: str) -> DataFrame:
    """:func:`mapped_payload_audit` after it has proven itself: a wrong value of ``control`` is put into one row that
    agrees, and the audit has to find it; an audit that does not see it is an error."""
    agree = source.join(target.select(*keys, F.col(control).alias("_there")), keys).where(F.col(control) == F.col("_there")).drop("_there").limit(1)
    if agree.isEmpty():
        raise ValueError(f"no row agrees in {control}, so the audit cannot be tried")
    kind = agree.schema[control].dataType
    wrong = F.concat(F.col(control), F.lit("~")) if kind.simpleString() == "string" else (F.col(control) + 1000).cast(kind)
    seen = mapped_payload_audit(agree.withColumn(control, wrong), target, keys, [control]).collect()  # one row a state
    if [(r["state"], r["n"]) for r in seen] != [("different", 1)]:
        raise ValueError("the audit did not see the wrong value")
    return mapped_payload_audit(source, target, keys, columns)


def schema_drift(left: StructType, right: StructType) -> list[tuple[str, str]]:
    """(column, problem) for columns that are missing, extra or of another type on the right."""
    a, b = ({f.name: f.dataType.simpleString() for f in s} for s in (left, right))
    out = [(c, "missing") for c in a if c not in b] + [(c, "extra") for c in b if c not in a]
    return sorted(out + [(c, f"{a[c]} <> {b[c]}") for c in a if c in b and a[c] != b[c]])


def unique_key_coverage(df: DataFrame, candidates: list[list[str]]) -> DataFrame:
    """Per candidate key: rows, distinct tuples, rows with a NULL part, and whether it is unique."""
    out = None
    for key in candidates:
        null = F.lit(False)
        for k in key:
            null |= F.col(k).isNull()
        per = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).withColumn("_null", null)
        one = per.agg(F.lit(",".join(key)).alias("candidate"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count_if(~F.col("_null")).alias("distinct_keys"), F.coalesce(F.sum(F.when(F.col("_null"), F.col("n"))), F.lit(0)).alias("null_rows"), F.coalesce(F.max(F.when(~F.col("_null"), F.col("n"))) <= 1, F.lit(True)).alias("is_unique"))
        out = one if out is None else out.unionByName(one)
    return out


def lookup_with_presence(df: DataFrame, cache: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A looked-up NULL is a value; a missing key is not: ``found`` tells them apart."""
    c = cache.select(*keys, F.col(value).alias("looked_up"), F.lit(True).alias("found"))
    return df.join(c, keys, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def require_found(looked: DataFrame) -> DataFrame:
    """The lookup's rows; raises if a key was missing."""
    n = looked.where(~F.col("found")).count()
    if n:
        raise KeyError(f"{n} keys are missing from the lookup")
    return looked


def utc_validation(df: DataFrame, local: str, utc: str, expected: Column) -> DataFrame:
    """Per offset: rows, correct, missing, unexpected and wrong conversions of a local time column."""
    l, u = F.col(local), F.col(utc)
    offset = F.timestamp_diff("MINUTE", u, l)
    return df.withColumn("_e", expected).groupBy(offset.alias("offset_minutes")).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(u.isNotNull() & (u == F.col("_e"))).alias("correct"), F.count_if(l.isNotNull() & u.isNull()).alias("missing"),
        F.count_if(l.isNull() & u.isNotNull()).alias("unexpected"), F.count_if(l.isNotNull() & u.isNotNull() & (u != F.col("_e"))).alias("wrong"),
    )
