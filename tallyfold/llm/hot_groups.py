"""Comparisons inside groups of any size, in cells of bounded size.

Rows ``key id ...`` meet others of their key.  A key of at most ``bound`` rows is one cell.  A larger one (a hot
band, a much copied text) is never gathered: it takes two passes.

1. ``first_cells`` deals its rows to blocks of about ``bound`` and puts the key's ``PIVOTS`` smallest ids into every
   block, so rows that are alike are mostly linked through a pivot.
2. Once the links of the first pass are turned into classes, ``rest_cells`` compares the rows that are not in the
   key's largest class with all rows of the key: blocks of all rows (role 0) against chunks of the others (role 1).
   Two rows of the largest class are connected already and need no comparison, so nothing is left out.

If n rows of a key leave r outside its largest class, the second pass makes about 2 n r / bound rows, which is no more
than 2 n as long as r is within one chunk.  No row is dropped for being in a large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 32


def _deal(salt: str, id_: Column, n: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), id_), n)


def _spread(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))


def first_cells(members: DataFrame, key: str, id_: str, bound: int) -> DataFrame:
    """``cell`` in place of ``key``; rows of small keys keep one cell, those of large ones get blocks and pivots."""
    others = [c for c in members.columns if c != key]
    large = members.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bound).select(key, F.ceil(F.col("_n") / bound).cast("long").alias("_blocks"))
    placed = members.join(large, key, "left")
    block = F.when(F.col("_blocks").isNull(), F.lit(-1).cast("long")).otherwise(_deal("block", F.col(id_), F.col("_blocks")))
    dealt = placed.select(F.xxhash64(key, block).alias("cell"), *others)
    nth = Window.partitionBy(key).orderBy(id_)
    pivots = placed.where("_blocks IS NOT NULL").withColumn("_nth", F.row_number().over(nth)).where(F.col("_nth") <= PIVOTS)
    everywhere = pivots.select("*", _spread(F.col("_blocks")).alias("_block")).where(_deal("block", F.col(id_), F.col("_blocks")) != F.col("_block"))
    return dealt.unionByName(everywhere.select(F.xxhash64(key, "_block").alias("cell"), *others))


def rest_cells(members: DataFrame, key: str, id_: str, root: str, bound: int) -> DataFrame:
    """``cell role`` in place of ``key`` for keys whose rows are not all of one class (``root``); two rows of a cell are to
    be compared if one of them has role 1.  A row of the rest is in one cell with both roles."""
    others = [c for c in members.columns if c != key]
    per = members.groupBy(key, root).agg(F.count(F.lit(1)).alias("_n"))
    sums = per.groupBy(key).agg(F.sum("_n").alias("_all"), F.max(F.struct("_n", root)).alias("_main"))
    split = sums.where(F.col("_main._n") < F.col("_all")).select(
        key, F.col(f"_main.{root}").alias("_main"), (F.col("_all") > bound).alias("_large"), F.ceil(F.col("_all") / bound).cast("long").alias("_blocks"),
        F.ceil((F.col("_all") - F.col("_main._n")) / bound).cast("long").alias("_chunks"),
    )
    placed = members.join(split, key)
    small = placed.where("NOT _large").select(F.xxhash64(key, F.lit(-1).cast("long")).alias("cell"), F.lit(1).alias("role"), *others)
    large = placed.where("_large")
    block, chunk = _deal("block", F.col(id_), F.col("_blocks")), _deal("chunk", F.col(id_), F.col("_chunks"))
    every = large.select("*", _spread(F.col("_chunks")).alias("_chunk")).select(F.xxhash64(key, block, "_chunk").alias("cell"), F.lit(0).alias("role"), *others)
    rest = large.where(F.col(root) != F.col("_main")).select("*", _spread(F.col("_blocks")).alias("_block"))
    # its own block holds the row already, with role 0; there it comes once more with role 1
    return small.unionByName(every).unionByName(rest.select(F.xxhash64(key, "_block", chunk).alias("cell"), F.lit(1).alias("role"), *others))
