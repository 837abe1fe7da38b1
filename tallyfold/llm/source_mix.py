"""Mixing sources to target weights by capped water-filling.

Each source gets a share of ``budget_ratio`` times all words in proportion to its weight, but at most
``max_epochs`` times its own words; what a clamped source cannot take is shared again among the
others in proportion to their weights until no target is above its clamp.  The repeated
redistribution ends at one fixed point, which is computed directly: ordered by clamp / weight, the
clamped sources are a prefix, and the first source whose share of what is left fits ends it.

A source's target is then sampled as whole repetitions of all its documents plus a fractional one:
documents are ordered by a seeded MD5 of their id and taken while the middle of the document lies
within the fractional quota, so the words taken differ from the target by at most half of one
document (more only where several rows share one id, which are taken or left together).

Plan: sizes are summed per source with partial sums; the quota's cut-off hash is found on sums per
(source, 4,096 hash buckets), and only the one bucket per source in which the quota ends is looked
at document by document, so a source with a third of all rows puts 1/12,288 of them into one task.
Each document then compares its hash with its source's cut-off: no ordering of whole sources and no
second shuffle of documents.  The table of sources (one row each) is broadcast only when counted to be at
most ``BROADCAST_SOURCES`` rows; beyond that it is joined in ``SALTS`` copies with salted documents.
Words are counted once where the rows carry no text; a mix that carries texts counts them again instead of
writing them.

Defined cases: a null or empty text has size 0; a null source is a source, the last; null ids share
one hash; rows with equal ids get equal verdicts; no words at all gives targets 0; an empty table
gives an empty result; other columns, whatever their names, are carried in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.rewrite import running_sums
from .common import cut

WEIGHTS, BUDGET_RATIO, MAX_EPOCHS, SEED = (3, 1, 2), 1.5, 2.0, "mix-1"
BROADCAST_SOURCES, SALTS = 10_000, 64
_BUCKET_HEX = 3


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text, null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget_ratio: float = BUDGET_RATIO, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``source source_size`` (one row a source) -> also ``weight target whole quota``.

    Both orders (by name, by clamp / weight) are running sums over ranges, so any number of sources is spread.
    """
    by_name = running_sums(sources, [F.col("source").asc_nulls_last()], [])
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    s = by_name.select("source", "source_size", weight.cast("double").alias("weight"), (F.col("source_size") * F.lit(float(max_epochs))).alias("clamp"))
    s = running_sums(s, [F.col("clamp") / F.col("weight"), F.col("source").asc_nulls_last()], ["clamp", "weight"])
    sums = s.agg(F.sum("source_size").alias("_size"), F.sum("weight").alias("_weight"))
    s = s.crossJoin(F.broadcast(sums)).withColumns({"left": F.col("_size") * F.lit(float(budget_ratio)) - F.col("before_clamp"), "weight_left": F.col("_weight") - F.col("before_weight")})  # one row
    fits = F.col("clamp") * F.col("weight_left") > F.col("weight") * F.col("left")
    first_fit = s.agg(F.min(F.when(fits, F.struct("nth", "left", "weight_left"))).alias("first_fit"))
    s = s.crossJoin(F.broadcast(first_fit))  # one row
    free = F.col("nth") >= F.col("first_fit.nth")
    s = s.withColumn("target", F.when(free, F.col("weight") * (F.col("first_fit.left") / F.col("first_fit.weight_left"))).otherwise(F.col("clamp")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return s.withColumn("whole", whole).select("source", "source_size", "weight", "target", "whole", (F.col("target") - F.col("whole") * F.col("source_size")).alias("quota"))


def order_hash(id_: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("null"))).cast("binary"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, budget_ratio: float = BUDGET_RATIO, max_epochs: float = MAX_EPOCHS, seed: str = SEED, carry: list[str] | None = None) -> DataFrame:
    """``row source size source_size target copies taken`` per input row; ``copies`` is how often it is taken."""
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row")
    base = docs.select(row, F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"), order_hash(F.col(f"`{id_col}`"), seed).alias("hash"))
    if carry is not None and text_col not in carry:
        base = cut(base)  # narrow: words are counted once and what follows reads the counts
    sized = base.select("source", "size", "hash") if carry is not None and text_col not in carry else cut(base.select("source", "size", "hash"))
    bucket = F.substring("hash", 1, _BUCKET_HEX)
    sums = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    totals = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = cut(water_fill(totals, weights, budget_ratio, max_epochs))
    few = plan.count() <= BROADCAST_SOURCES

    def same(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        """Join on the source; beyond a broadcast the left rows are salted, so a source with many rows is many keys."""
        if few:
            return left.join(F.broadcast(right.withColumnRenamed("source", "of")), left["source"].eqNullSafe(F.col("of")), how).drop("of")
        salted = left.withColumn("_salt", F.pmod(F.xxhash64("hash") if "hash" in left.columns else F.lit(0), F.lit(SALTS)).cast("int"))
        many = right.withColumnRenamed("source", "of").withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        return salted.join(many, salted["source"].eqNullSafe(F.col("of")) & (F.col("_salt") == F.col("_of")), how).drop("of", "_of", "_salt")

    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = same(sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0))), plan.select("source", "quota")).where((F.col("quota") > 0) & (F.col("before") <= F.col("quota")) & (F.col("before") + F.col("words") > F.col("quota"))).select("source", "bucket", "before", "quota")
    inside = same(sized, ends).where(F.substring("hash", 1, _BUCKET_HEX) == F.col("bucket")).groupBy("source", "bucket", "before", "quota", "hash").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("words").over(upto), F.lit(0)) + F.col("words") / 2.0
    cuts = inside.withColumn("ok", middle <= F.col("quota")).groupBy("source").agg(F.coalesce(F.max(F.when(F.col("ok"), F.col("hash"))), F.max("bucket")).alias("cut"))
    final = same(plan, cuts, "left").withColumn("cut", F.coalesce("cut", F.when(F.col("quota") > 0, "g").otherwise("")))
    out = same(base, cut(final))
    copies = (F.col("whole") + F.when(F.col("hash") <= F.col("cut"), 1).otherwise(0)).cast("long")
    return out.withColumn("copies", copies).select("row", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
