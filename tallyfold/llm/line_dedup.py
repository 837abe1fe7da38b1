"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble.

A line's key is the line without the white space ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z
lower-cased.  Keys of at least ``min_chars`` code points that at least ``min_docs`` documents hold
lose all their lines, except in the holder with the largest id.

Plan: pass 1 emits each document's distinct long keys as 128-bit hashes (no text is shuffled), keeps one row per
(id, hash) and counts those with partial sums, so a line that a third of all documents hold is counted from one row
per task.  The over-threshold keys are joined back to the (id, hash) rows.  A key with more than
1/``HOT_KEYS`` of those rows is hot; there can be at most ``HOT_KEYS`` of them, so they are broadcast, and
their rows are dealt out by document; the other keys take a sort-merge join.  The verdicts are gathered per document (bounded by
that document's lines) and pass 2 reassembles each text by position.

Defined cases: null or empty text is one empty line; a null id is smaller than any other, so a
document with one never keeps a dropped line unless all holders have null ids; rows that share an id (or have
none) count as one document, and rows that share the largest id all keep their lines; an empty table
gives an empty result; other columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS_BYTES, cut, n_chars, texts_of

MIN_CHARS, MIN_DOCS, HOT_KEYS = 40, 5, 20_000


def line_key(line: bytes) -> bytes:
    return line.strip(WS_BYTES).lower()


def _long_keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            at, out = [], []
            for i, text in enumerate(texts_of(batch, 1)):
                keys = {k for x in text.lower().split(b"\n") if len(k := x.strip(WS_BYTES)) >= min_chars and n_chars(k) >= min_chars}
                out += [digest(k) for k in keys]
                at += [i] * len(keys)
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary())], ["id", "k"])

    return run


def _reassemble(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            kept, lines, dropped = [], [], []
            for text, drops in zip(texts_of(batch, 1), batch.column(2).to_pylist(), strict=True):
                own = text.split(b"\n")
                lines.append(len(own))
                if drops:
                    gone = set(drops)
                    own = [x for x in own if len(k := line_key(x)) < min_chars or digest(k) not in gone]
                    text = b"\n".join(own)
                dropped.append(lines[-1] - len(own))
                kept.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], ["row", "text", "n_lines", "n_dropped"])

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``row`` (all input columns), ``text`` (kept lines), ``n_lines``, ``n_dropped`` per input row."""
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    held = base.select("id", "text").mapInArrow(_long_keys(min_chars), f"id {kind}, k binary")
    common = cut(held.distinct().groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs))
    rows = common.agg(F.sum("n")).first()[0] or 0
    hot = common.where(F.col("n") > rows / HOT_KEYS).select("k", F.col("keeper").alias("hot_keeper"), F.lit(True).alias("is_hot"))
    rest = common.where(F.col("n") <= rows / HOT_KEYS).select(F.col("k").alias("key"), F.col("keeper").alias("rest_keeper"), F.lit(True).alias("is_rest"))
    known = held.join(F.broadcast(hot), "k", "left")
    # a row of a hot key has its verdict already: it goes to any task, under a key that matches nothing
    known = known.withColumn("key", F.when(F.col("is_hot"), F.concat(F.col("k"), F.hex(F.xxhash64("id")).cast("binary"))).otherwise(F.col("k")))
    found = known.join(rest, "key", "left").where("is_hot OR is_rest")
    keeper = F.when(F.col("is_hot"), F.col("hot_keeper")).otherwise(F.col("rest_keeper"))
    drops = found.where(~F.col("id").eqNullSafe(keeper)).groupBy(F.col("id").alias("drop_id")).agg(F.collect_set("k").alias("drops"))
    joined = base.join(drops, base["id"].eqNullSafe(drops["drop_id"]), "left").select("row", "text", "drops")
    row = base.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_reassemble(min_chars), f"row {row}, text string, n_lines long, n_dropped long")
