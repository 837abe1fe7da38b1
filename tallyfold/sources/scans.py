"""Scans: wrapped queries, inventories, keyset pages, frozen windows, fences, lookups, catalog facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import split_key
from .guards import identifier, single_select, user_filter

LOOKUP_BROADCAST = 1_000_000


def query_scan(spark: SparkSession, sql: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """A saved single SELECT as a relation, with an optional user filter outside it (pushed down by Catalyst)."""
    df = spark.sql(single_select(sql))
    if (w := user_filter(where)) is not None:
        df = df.where(w)
    return df.select(*columns) if columns else df


def jdbc_scan(spark: SparkSession, url: str, sql: str, fetch: int = 10_000, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 1, **options: str) -> DataFrame:
    """The same over JDBC; with ``key`` and ``bounds`` it is read in ranges by ``parts`` tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch).options(**options)
    if key is None:
        return reader.option("query", single_select(sql)).load()
    lo, hi = bounds or (0, 0)
    return reader.option("dbtable", f"({single_select(sql)}) q").option("partitionColumn", identifier(key)).option("lowerBound", lo).option("upperBound", hi).option("numPartitions", parts).load()


def describe(df: DataFrame, required: list[str]) -> StructType:
    """The schema without running anything; missing or repeated columns are errors."""
    names = df.columns
    twice = {c for c in names if names.count(c) > 1}
    missing = [c for c in required if c not in names]
    if twice or missing:
        raise ValueError(f"repeated columns {sorted(twice)}, missing columns {missing}")
    return df.schema


def inventory(df: DataFrame, keys: list[str], changed: str) -> DataFrame:
    """Keys and change time only."""
    return df.select(*keys, F.col(changed).alias("changed"))


def keyset_page(df: DataFrame, keys: list[str], after: tuple | None, size: int) -> DataFrame:
    """The next page in key order after a lower-exclusive composite cursor (a page is the feature here)."""
    values = [] if after is None else [F.lit(v).cast(df.schema[k].dataType) for k, v in zip(keys, after, strict=True)]
    rows = df if after is None else df.where(tuple_after([F.col(k) for k in keys], values))
    return rows.orderBy(*keys).limit(size)


def tuple_after(columns: list[Column], values: list[Column]) -> Column:
    """``(c1, c2, ...) > (v1, v2, ...)`` expanded to comparisons that a scan can push down."""
    out, equal = F.lit(False), F.lit(True)
    for c, v in zip(columns, values, strict=True):
        out |= equal & (c > v)
        equal &= c == v
    return out


def upper_watermark(df: DataFrame, changed: str, keys: list[str]) -> DataFrame:
    """The largest ``(changed, keys)`` tuple as one row: where a window is frozen."""
    return df.where(F.col(changed).isNotNull()).agg(F.max(F.struct(changed, *keys)).alias("m")).select("m.*")


def frozen_window(df: DataFrame, changed: str, keys: list[str], lower: tuple | None, upper: tuple) -> DataFrame:
    """Rows after the lower tuple (exclusive) and up to the frozen upper one.

    The plain range on the change time comes first, so it reaches the scan; the tuples trim its ends.
    """
    cols = [F.col(c) for c in (changed, *keys)]
    cast = lambda t: [F.lit(v).cast(df.schema[c].dataType) for c, v in zip((changed, *keys), t, strict=True)]
    up = cast(upper)
    out = df.where(cols[0] <= up[0]).where(~tuple_after(cols, up))
    if lower is not None:
        lo = cast(lower)
        out = out.where(cols[0] >= lo[0]).where(tuple_after(cols, lo))
    return out


def fence(df: DataFrame, created: str, now: Column) -> DataFrame:
    """Rows created before a captured instant."""
    return df.where(F.col(created) < now)


def lookup(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the wanted keys; the keys are broadcast when counted to be at most ``LOOKUP_BROADCAST``."""
    k = wanted.select(*keys).distinct()
    small = k.limit(LOOKUP_BROADCAST + 1).count() <= LOOKUP_BROADCAST
    return df.join(F.broadcast(k) if small else k, keys, "left_semi")


def lookup_text_key(df: DataFrame, wanted: DataFrame, text_key: str, parts: list[str], separator: str = "-") -> DataFrame:
    """The same for composite text keys: split from the right, typed as the components, and joined natively."""
    split = split_key(F.col(text_key), len(parts), separator)
    typed = wanted.select(*[c.cast(df.schema[p].dataType).alias(p) for c, p in zip(split, parts, strict=True)])
    return lookup(df, typed, parts)


def payload(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Full rows of the wanted keys; a key that comes twice is an error."""
    return checked_payload(lookup(df, wanted, keys), wanted, keys)


def checked_payload(fetched: DataFrame, wanted: DataFrame, keys: list[str], operation: str | None = None, allowed: tuple[str, ...] = ("UPSERT",)) -> DataFrame:
    """Rows as a service sent them, held against what was asked for: an unrequested key, a key that comes twice and
    a row that is not a current one (an ``operation`` other than ``allowed``; NULL is current) are errors."""
    asked = wanted.select(*keys).distinct().withColumn("_asked", F.lit(True))
    odd = F.lit(0) if operation is None else F.count_if(F.col(operation).isNotNull() & ~F.col(operation).isin(*allowed))
    per_key = fetched.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), odd.alias("odd")).join(asked, keys, "left")
    bad = per_key.agg(F.count_if(F.col("_asked").isNull()).alias("unrequested"), F.count_if(F.col("n") > 1).alias("repeated"), F.coalesce(F.sum("odd"), F.lit(0)).alias("operations")).first()
    if any(bad):
        raise ValueError(f"unrequested keys: {bad.unrequested}; keys with several rows: {bad.repeated}; rows that are no current rows: {bad.operations}")
    return fetched


def sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(fraction, seed)


def series(spark: SparkSession, start: int, stop: int, step: int = 1) -> DataFrame:
    return spark.range(start, stop, step).withColumnRenamed("id", "n")


def json_rows(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON array column as rows of a declared schema."""
    return df.select(*[c for c in df.columns if c != column], F.inline(F.from_json(column, f"array<struct<{schema}>>")))


def column_facts(df: DataFrame, table: str) -> DataFrame:
    """Names, positions, types and nullability of a relation as rows."""
    spark = df.sparkSession
    return spark.createDataFrame([(table, i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)], "table_name string, position int, column_name string, data_type string, nullable boolean")


def column_statistics(df: DataFrame) -> DataFrame:
    """Per column: rows, NULLs, smallest and largest value as text, and about how many distinct ones (one pass)."""
    parts = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        parts.append(F.struct(
            F.lit(f.name).alias("column_name"), F.count(F.lit(1)).alias("row_count"), F.count_if(c.isNull()).alias("null_count"),
            F.min(c).cast("string").alias("low"), F.max(c).cast("string").alias("high"), F.approx_count_distinct(c).alias("about_distinct"),
        ))
    return df.agg(F.array(*parts).alias("s")).select(F.inline("s"))


def value_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows in ``bins`` intervals of equal width between the extremes of a numeric column: what an optimiser keeps."""
    ends = df.agg(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))
    v = F.col(column).cast("double")
    at = F.when(F.col("high") > F.col("low"), F.least(F.floor((v - F.col("low")) * bins / (F.col("high") - F.col("low"))), F.lit(bins - 1))).otherwise(0)
    return df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))  # one row
