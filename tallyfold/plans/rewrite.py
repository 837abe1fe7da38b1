"""Changes to Parquet tables as rewrites: a new version is computed, the old one stays until it is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.digest import stable_uuid
from .shared import cut


def upsert(target: DataFrame, source: DataFrame, keys: list[str], omit_null: bool = True, immutable: tuple[str, ...] = ()) -> DataFrame:
    """Full outer rewrite.  A NULL source value keeps the target's (``omit_null``); immutable columns of
    existing rows are never overwritten.  Columns that only the target has stay."""
    cols = [c for c in target.columns if c not in keys]
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols if c in source.columns], F.lit(True).alias("_in_s"))
    j = target.withColumn("_in_t", F.lit(True)).join(s, keys, "full")
    there, sent = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()

    def value(c: str) -> Column:
        if c not in source.columns:
            return F.col(c)
        new = F.coalesce(F.col(f"_s_{c}"), F.col(c)) if omit_null else F.when(sent, F.col(f"_s_{c}")).otherwise(F.col(c))
        return F.when(there, F.col(c)).otherwise(new) if c in immutable else new

    return j.select(*keys, *[value(c).alias(c) for c in cols])


def upsert_if_newer(target: DataFrame, source: DataFrame, keys: list[str], changed: str) -> DataFrame:
    """A source row replaces a target row only if the target's change time is NULL or older."""
    cols = [c for c in target.columns if c not in keys]
    s = source.select(*keys, F.struct(*cols).alias("_s"))
    t = target.select(*keys, F.struct(*cols).alias("_t"))
    newer = F.col("_t").isNull() | (F.col("_s").isNotNull() & (F.col(f"_t.{changed}").isNull() | (F.col(f"_s.{changed}") > F.col(f"_t.{changed}"))))
    return t.join(s, keys, "full").select(*keys, F.when(newer, F.col("_s")).otherwise(F.col("_t")).alias("_r")).select(*keys, "_r.*")


def merge_sql(target: str, source: str, keys: list[str], columns: list[str], changed: str) -> str:
    """The same as MERGE, for table formats that support it."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"{c} = s.{c}" for c in columns)
    names = ", ".join([*keys, *columns])
    return f"MERGE INTO {target} t USING {source} s ON {on} WHEN MATCHED AND (t.{changed} IS NULL OR s.{changed} > t.{changed}) THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join(f's.{c}' for c in [*keys, *columns])})"


def delete_keys(target: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(doomed.select(*keys).distinct(), keys, "left_anti")


def guarded_delete(target: DataFrame, doomed: DataFrame, keys: list[str], changed: str) -> DataFrame:
    """Delete a row only if its change time is still what the plan saw (NULL equals NULL)."""
    d = doomed.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(changed).alias("_planned"))
    on = F.col(changed).eqNullSafe(F.col("_planned"))
    for k in keys:
        on &= F.col(k) == F.col(f"_{k}")
    return target.join(d, on, "left_anti")


def keep_in_source(target: DataFrame, inventory: DataFrame, keys: list[str]) -> DataFrame:
    """Delete what a complete inventory does not hold."""
    return target.join(inventory.select(*keys).distinct(), keys, "left_semi")


def backfill(target: DataFrame, found: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """Set a column where a key is found, to NULL too; other rows stay."""
    f = found.select(key, F.col(value).alias("_v"), F.lit(True).alias("_f"))
    return target.join(f, key, "left").withColumn(column, F.when(F.col("_f"), F.col("_v")).otherwise(F.col(column))).drop("_v", "_f")


def checked_upsert(target: DataFrame, source: DataFrame, keys: list[str], changed: str) -> DataFrame:
    """:func:`upsert_if_newer` in which every source row must take effect: one that the target's change time keeps out
    (the target moved on meanwhile), or whose key comes twice, fails the query instead of being skipped."""
    cols = [c for c in target.columns if c not in keys]
    s = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(*cols)).alias("_s"))
    t = target.select(*keys, F.struct(*cols).alias("_t"))
    blocked = F.col("_s").isNotNull() & F.col("_t").isNotNull() & ~F.coalesce(F.col(f"_t.{changed}").isNull() | (F.col(f"_s.{changed}") > F.col(f"_t.{changed}")), F.lit(False))
    joined = t.join(s, keys, "full")
    fail = F.raise_error(F.lit("a planned row was not written")).cast(joined.schema["_s"].dataType)
    row = F.when(blocked | (F.col("_n") > 1), fail).otherwise(F.coalesce("_s", "_t"))
    return joined.select(*keys, row.alias("_r")).select(*keys, "_r.*")


def number_rows(df: DataFrame, order: list[str], name: str = "gid", modulus: int | None = None) -> DataFrame:
    """Row numbers from 1 in the order of ``order`` (its tuples are unique), and ``__mod``, the number modulo ``modulus``.

    Rows are dealt to ranges of that order, sorted there and written to the shared folder with their place in the
    range; a running sum over the ranges' sizes (one row each) makes the numbers.  One shuffle, no window over rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part, nth = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    sizes = placed.groupBy(part.alias("_part")).agg(F.max(nth).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_base"))  # one row a range
    out = placed.withColumn("_part", part).join(F.broadcast(bases), "_part").withColumn(name, (F.col("_base") + nth).cast("long")).drop("_part", "_base", "_at")
    return out if modulus is None else out.withColumn("__mod", F.col(name) % F.lit(modulus))


def copy_absent(existing: DataFrame, incoming: DataFrame, id_col: str) -> DataFrame:
    """Idempotent copy: incoming rows whose (deterministic) id exists are left out."""
    return existing.unionByName(incoming.join(existing.select(id_col), id_col, "left_anti"))


def copy_family(parents: DataFrame, children: DataFrame, wanted: DataFrame, id_col: str, parent_col: str, namespace: str) -> tuple[DataFrame, DataFrame]:
    """Copies of the wanted parents and of their children, under ids made from the sources' ids.

    ``origin`` is the source's id and NULL for rows that are no copies.  A parent whose copy is there already is left
    alone together with its children, so a repeated run adds nothing; copies are never copied.
    """
    copied = lambda c: stable_uuid(namespace, c)
    # dealt by number, so AQE leaves the join, which holds the table of wanted ids beside its rows, in as many tasks
    ids = wanted.select(id_col).repartition(int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")), id_col).distinct()
    new = parents.where("origin IS NULL").join(ids, id_col, "left_semi")
    new = new.withColumns({"origin": F.col(id_col), "_copy": copied(F.col(id_col).cast("string"))}).join(parents.select(F.col(id_col).alias("_copy")), "_copy", "left_anti")
    added = new.withColumn(id_col, F.col("_copy")).drop("_copy").select(*parents.columns)
    of = new.select(F.col("origin").alias(parent_col), F.col("_copy").alias("_parent"))
    kids = children.where("origin IS NULL").join(of, parent_col).withColumns({"origin": F.col(id_col), parent_col: F.col("_parent")})
    kids = kids.withColumn(id_col, copied(F.concat_ws("/", F.col("_parent"), F.col("origin")))).select(*children.columns)
    return parents.unionByName(added), children.unionByName(kids)


def clone_row(template: DataFrame, overrides: DataFrame) -> DataFrame:
    """A template row (exactly one) once per row of overrides, whose columns replace its own."""
    if template.limit(2).count() != 1:
        raise ValueError("the template is one row")
    keep = [c for c in template.columns if c not in overrides.columns]
    return overrides.crossJoin(F.broadcast(template.select(*keep))).select(*template.columns)  # one row


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to write, rows that become warnings): unknown validity is not valid."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)


def running_sums(df: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """``before_<column>`` (the sum over all earlier rows in ``order``) and ``nth`` (from 1), without gathering the rows.

    Rows are dealt to ranges of the order and sorted there; the ranges' totals (one row each) are carried forward.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftrightunsigned("_at", 33)).withColumn("_one", F.lit(1).cast("long"))
    counted = {**{f"before_{c}": c for c in columns}, "nth": "_one"}
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in counted.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    bases = totals.select("_part", *[zero(F.sum(n).over(earlier)).alias(f"_{n}") for n in counted])  # one row a range
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.join(F.broadcast(bases), "_part").withColumns({n: F.col(f"_{n}") + zero(F.sum(c).over(inside)) for n, c in counted.items()})
    return out.withColumn("nth", F.col("nth") + 1).select(*df.columns, *counted)
