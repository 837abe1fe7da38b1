"""Document fingerprints: a canonical exact digest.

The canonical form of a text is NFKC-normalised (ICU, called in the JVM), case-folded, with every run of
white space turned into one space and none at the ends.  Its fingerprint is 128 bits wide: two XXH64 with
different seeds, as 32 hex digits.  Inside a bucket of equal fingerprints the canonical bytes are compared; should
two texts ever collide, the fingerprints of that bucket are lengthened by the SHA-256 of the canonical
bytes, whatever the number of such buckets.  Likeness of two fingerprints is 1 if they (and the bytes) are equal and 0
otherwise: a digest says same or not the same.

Everything is a Spark expression: no Python runs on executors.  The canonical form of a text is made once.

Byte comparison.  A variant is a raw text (told apart by its SHA-256) or an edited one (a pair of raw texts).  Buckets
of several rows are found on hashes alone; only their variants get their raw texts back, one per distinct text, so a
text that a third of all rows share is fetched once.

Plan for the edited texts: the next document by descending id is a neighbour in a global order.  Ids are cut into
ranges by quantiles, and an id (or the missing id) with more rows than a range is cut further by its rows'
SHA-256 (at most ``MAX_RANGES`` numbers and as many hot ids on the driver).  The first document of each range is lent
to the range before, and one window per range finds the neighbours: one shuffle of the texts, and no task
holds more than about a range.

Defined cases: a null text is an empty one; documents with null ids come last; rows with equal ids are ordered by
the SHA-256 of their text, descending, and equal rows are interchangeable; a single document is its own next; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.search import rank_in
from .common import cut

MAX_RANGES, BROADCAST_TEXTS = 2048, 100_000


def canonical(text: Column) -> Column:
    """NFKC, full case folding, single spaces.  Text of ASCII only is in NFKC and folds to lower case."""
    text = F.coalesce(text, F.lit(""))
    nfkc = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    fold = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), nfkc, F.lit(True))
    again = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), fold, F.lit(True))
    plain = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(again)
    return F.trim(F.regexp_replace(plain, r"[\s\x{85}\p{Z}]++", " "))


def wide_hash(canonical_text: Column) -> Column:
    """Two 64-bit hashes of different seeds as 32 hex digits."""
    half = [F.lower(F.lpad(F.hex(F.xxhash64(*x)), 16, "0")) for x in ((canonical_text,), (F.lit(0x51ED), canonical_text))]
    return F.concat(*half)


def raw_key(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def edit(text: Column, next_text: Column) -> Column:
    """The last half of a text's code points replaced by the first ones of another text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(next_text, half))


# ---- bytes inside equal buckets ----------------------------------------------------------------------


def collisions(variants: DataFrame, texts: DataFrame) -> DataFrame:
    """``fp raw next_raw longer`` of the variants whose fingerprint another canonical text has too.

    ``variants(fp, raw, next_raw, n)``: one row per distinct variant with its number of rows; ``texts(raw, text)``.
    """
    several = variants.groupBy("fp").agg(F.sum("n").alias("rows")).where("rows > 1").select("fp")
    inside = cut(variants.join(several, "fp").select("fp", "raw", "next_raw"))
    wanted = inside.select("raw").union(inside.select("next_raw")).where("raw IS NOT NULL").distinct()
    few = wanted.count() <= BROADCAST_TEXTS
    found = cut(texts.join(F.broadcast(wanted) if few else wanted, "raw", "left_semi").groupBy("raw").agg(F.max("text").alias("text")))
    second = found.select(F.col("raw").alias("next_raw"), F.col("text").alias("next_text"))
    whole = F.when(F.col("next_raw").isNull(), F.col("text")).otherwise(edit(F.col("text"), F.col("next_text")))
    both = inside.join(found, "raw").join(second, "next_raw", "left").select("fp", "raw", "next_raw", canonical(whole).alias("canon"))
    both = cut(both.select("fp", "raw", "next_raw", "canon"))
    bad = both.groupBy("fp").agg(F.min("canon").alias("low"), F.max("canon").alias("high")).where("low <> high").select("fp")
    return both.join(bad, "fp").select("fp", "raw", "next_raw", F.concat("fp", F.sha2(F.col("canon").cast("binary"), 256)).alias("longer"))


def _lengthen(rows: DataFrame, longer: DataFrame, fp: str, raw: str, next_raw: str | None) -> DataFrame:
    own = longer.where(F.col("next_raw").isNull() if next_raw is None else F.col("next_raw").isNotNull())
    own = own.select(F.col("fp").alias("_fp"), F.col("raw").alias("_raw"), F.col("next_raw").alias("_next"), F.col("longer").alias("_longer"))
    on = (F.col(fp) == F.col("_fp")) & (F.col(raw) == F.col("_raw"))
    if next_raw is not None:
        on &= F.col(next_raw) == F.col("_next")
    return rows.join(own, on, "left").withColumn(fp, F.coalesce("_longer", fp)).drop("_fp", "_raw", "_next", "_longer")


def fingerprints(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row fingerprint`` per input row: equal exactly where canonical texts are equal."""
    carry = [c for c in docs.columns if c != text_col] if carry is None else carry
    text = F.col(f"`{text_col}`")
    texts = docs.select(raw_key(text).alias("raw"), F.coalesce(text, F.lit("")).alias("text"))
    made = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), raw_key(text).alias("raw"), canonical(text).alias("canon"))
    rows = cut(made.select("row", "raw", wide_hash(F.col("canon")).alias("fp")))
    variants = rows.groupBy("fp", "raw").agg(F.count(F.lit(1)).alias("n")).select("fp", "raw", F.lit(None).cast("binary").alias("next_raw"), "n")
    longer = cut(collisions(variants, texts))
    if not longer.isEmpty():
        rows = _lengthen(rows, longer, "fp", "raw", None)
    return rows.select("row", F.col("fp").alias("fingerprint"))


# ---- neighbours in descending order of ids -----------------------------------------------------------


def _places(base: DataFrame) -> Column:
    """The number of a row's range: ascending numbers follow the order of ``id`` descending, then ``raw`` descending."""
    ids = base.select("id")
    ranges = min(MAX_RANGES, 8 * int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = ids.where("id IS NOT NULL").approxQuantile("id", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    per = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    total = base.count()
    limit = max(1, 2 * total // ranges)
    hot = {r.id: -(-r.n // limit) for r in per.where(F.col("n") > limit).collect()}  # at most ranges / 2 ids
    # a hot id has a range to itself: ids from it on, and ids beyond it, start at a bound
    marks = sorted({int(b) for b in bounds} | {x for h in hot if h is not None for x in (h, h + 1) if x < 2**63})
    most = max(hot.values(), default=1)
    up = rank_in(F.array(*[F.lit(m).cast("long") for m in marks]).cast("array<bigint>"), F.col("id"), len(marks)) if marks else F.lit(0)
    place = F.when(F.col("id").isNull(), F.lit(len(marks) + 1)).otherwise(F.lit(len(marks)) - up).cast("long") * most
    share = F.conv(F.hex(F.substring("raw", 1, 4)), 16, 10).cast("long") / F.lit(2.0**32)  # even over [0, 1)
    part = F.lit(0)
    for h, n in hot.items():
        part = F.when(F.col("id").eqNullSafe(F.lit(h).cast("long")), F.lit(n - 1) - F.floor(share * n)).otherwise(part)
    return place + part.cast("long")


def with_next(base: DataFrame, finish) -> DataFrame:
    """``id raw text`` -> ``finish`` of it, and ``next_`` of each of its columns but the id.

    ``finish`` adds columns row by row, once for every row that is kept and for the few rows that are lent.
    """
    placed = base.withColumn("range", _places(base))
    tops = {r.range: r.top for r in placed.select("range", F.struct("id", "raw").alias("t")).groupBy("range").agg(F.max("t").alias("top")).collect()}  # one row a range
    held = sorted(tops)
    lend = {p: q for p, q in zip(held, [held[-1], *held[:-1]], strict=True)} if held else {}
    wanted = F.lit(False)
    known = sorted({t.id for t in tops.values() if t.id is not None})
    if known:
        wanted |= F.col("id").isin(known)
    if any(t.id is None for t in tops.values()):
        wanted |= F.col("id").isNull()
    raws = F.array(*[F.lit(bytes(t.raw)) for t in tops.values()]) if tops else F.array().cast("array<binary>")
    guests = placed.where(wanted).where(F.array_contains(raws, F.col("raw")))
    tops_of = F.create_map(*[x for p, t in tops.items() for x in (F.lit(p).cast("long"), F.struct(F.lit(t.id).cast("long").alias("id"), F.lit(bytes(t.raw)).alias("raw")))]) if tops else None
    others = None
    if tops_of is not None:
        top = F.element_at(tops_of, F.col("range"))
        guests = guests.where(top["id"].eqNullSafe(F.col("id")) & (top["raw"] == F.col("raw")))
        borrower = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in lend.items() for x in pair]), F.col("range"))
        guests = guests.dropDuplicates(["range"]).withColumn("range", borrower)
    both = finish(placed.withColumn("guest", F.lit(0)).unionByName(guests.withColumn("guest", F.lit(1))))
    others = [c for c in both.columns if c not in ("id", "range", "guest")]
    seen = Window.partitionBy("range").orderBy(F.col("guest"), F.col("id").desc_nulls_last(), F.col("raw").desc())
    return both.withColumns({f"next_{c}": F.lead(c).over(seen) for c in others}).where("guest = 0").drop("guest", "range")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text")).withColumn("raw", raw_key(F.col("text")))

    def finish(df: DataFrame) -> DataFrame:
        made = df.withColumn("canon", canonical(F.col("text")))
        return made.withColumn("fp", wide_hash(F.col("canon"))).drop("canon")

    d = with_next(base, finish).withColumn("edited", edit(F.col("text"), F.col("next_text")))
    d = d.withColumn("canon", canonical(F.col("edited"))).withColumn("edited_fp", wide_hash(F.col("canon")))
    same_bytes = lambda other, bytes_: F.when(F.col("fp") == F.col(other), bytes_).otherwise(F.lit(False)).cast("double")
    d = cut(d.select(
        "id", F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fp", "edited_fp", "raw", "next_raw",
        same_bytes("edited_fp", F.col("canon") == canonical(F.col("text"))).alias("near_edited"),
        same_bytes("next_fp", (F.col("raw") == F.col("next_raw")) | (canonical(F.col("text")) == canonical(F.col("next_text")))).alias("near_next"),
    ))
    n = F.count(F.lit(1)).alias("n")
    own = d.groupBy("fp", "raw").agg(n).select("fp", "raw", F.lit(None).cast("binary").alias("next_raw"), "n")
    variants = own.unionByName(d.groupBy(F.col("edited_fp").alias("fp"), "raw", "next_raw").agg(n))
    longer = cut(collisions(variants, base.select("raw", "text")))
    if not longer.isEmpty():
        d = _lengthen(_lengthen(d, longer, "fp", "raw", None), longer, "edited_fp", "raw", "next_raw")
    return d.select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next")
