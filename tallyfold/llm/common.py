"""Small helpers that several operators share."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import checkpoint_dir, cut, release, shared_dir  # noqa: F401  (operators take them from here)

#: The white space that separates words: space and the code points 9 to 13.
WS = " \t\n\x0b\x0c\r"
WS_BYTES = WS.encode()
WORD_RE = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def process_cache(name: str) -> dict:
    """A dictionary that lives in the Python worker process until another operator asks for one of another name."""
    holder = sys.modules.setdefault("_tallyfold_process_cache", types.ModuleType("_tallyfold_process_cache")).__dict__
    if holder.get("_name") != name:
        for key in [k for k in holder if not k.startswith("__")]:
            del holder[key]
        holder["_name"], holder["_cache"] = name, {}
    return holder["_cache"]


def texts_of(batch: pa.RecordBatch, i: int) -> list[bytes]:
    """Column ``i`` as UTF-8 bytes, null as empty."""
    column = batch.column(i)
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def n_chars(data: bytes) -> int:
    """Code points in UTF-8 bytes."""
    if data.isascii():
        return len(data)
    b = np.frombuffer(data, np.uint8)
    return int(len(b) - np.count_nonzero((b & 0xC0) == 0x80))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, looked up in a bounded per-process dictionary."""
    import xxhash

    known = process_cache(f"words{seed}")
    get = known.get
    out = [get(w) for w in words]
    if None in out:
        h = xxhash.xxh3_64_intdigest
        if len(known) > 120_000:
            known.clear()
        for i, x in enumerate(out):
            if x is None:
                out[i] = known[words[i]] = h(words[i], seed)
    return np.array(out, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def row_of(df: DataFrame, name: str = "__row") -> Column:
    """All columns of ``df`` in one struct, so that operator columns cannot clash with them."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name)
