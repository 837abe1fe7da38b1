"""Groups of texts whose word shingles have a Jaccard similarity of at least ``ALIKE``.

Two texts are linked when the sets of their ``WORDS``-word shingles (ASCII case folded, white space as in
``simhash_vptree``) have an exact Jaccard similarity of ``ALIKE`` or more; texts connected through links
form a group.

1. Equal texts are one point, their 128-bit digest.
2. Candidates share a key: a component of SimHash links, found with the shards and trees of ``simhash_vptree``
   (five words, four bits), or one of ``KEYS`` MinHash keys of ``EACH`` values.  SimHash alone does not do: texts of
   similarity 0.8 differ by up to 17 of 64 bits, where bands no longer tell points apart.  A linked pair shares no
   MinHash key with probability (1 - 0.8 ** 3) ** 24 = 3e-8 at most.
3. The ``KEYS * EACH`` MinHash values of a text also estimate similarities (standard error 0.05 at 0.8).  Inside a
   key a pair whose estimate is below ``MAYBE``, five standard errors under ``ALIKE``, is no candidate.
4. Candidates are verified on their texts' shingle sets, in two passes.  The first verifies a maximum spanning forest of
   each key's estimates, fewer pairs than texts, which connects nearly all that belongs together.  The second looks at
   every candidate pair that is still in different groups, once, in the first key that the two share: there they
   bring their sets along (32 bits a shingle; of very long texts a sample by hash value of about ``SAMPLE``), and what
   these cannot rule out is verified on the texts.  No pair that may link two groups stays unverified, and
   pairs inside a group are not looked at again.  Keys of any size are compared in cells of bounded size, see
   ``hot_groups``.

Defined cases: null is empty text; fewer words than a shingle give one shingle, the whole sequence; an empty
table has no groups; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hot_groups
from .common import cut, release, texts_of
from .simhash_vptree import bit_counts, classes, link_fingerprints

WORDS, ALIKE, MAX_BITS = 5, 0.8, 4
KEYS, EACH, SEED, MAYBE = 24, 3, 42, 0.56
#: Rows of a key that one task compares at once.
CELL = 1024
#: A text of more shingles than this brings a sample to the second pass: standard error 0.006, allowed for five times.
SAMPLE = 4096
_AT_ONCE = 2048


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """XXH64 of every shingle in order, repeated ones too."""
    import xxhash

    own = text.lower().split()
    hash_of, joined = xxhash.xxh64_intdigest, b" ".join(own)
    if len(own) <= words:
        return np.array([hash_of(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(own) - words + 1].tolist()
    return np.fromiter((hash_of(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)), np.uint64, len(starts))


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 2**32, (KEYS * EACH, 1), np.uint32), rng.integers(0, 2**32, (KEYS * EACH, 1), np.uint32) | np.uint32(1)


_FLIP, _FACTOR = _constants()


def minhashes(hashes: np.ndarray) -> np.ndarray:
    """``KEYS * EACH`` minima over the shingles, of 32 bits."""
    low = np.full(KEYS * EACH, 2**32 - 1, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32) ^ hashes.astype(np.uint32)
    for at in range(0, len(short), _AT_ONCE):  # bounded memory for very long texts
        h = (short[at : at + _AT_ONCE] ^ _FLIP) * _FACTOR
        h ^= h >> np.uint32(15)
        h *= _FACTOR[::-1]
        low = np.minimum(low, h.min(axis=1))
    return low


def minhash_keys(low: np.ndarray) -> np.ndarray:
    """``KEYS`` keys, each of ``EACH`` minima."""
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(k.tobytes(), i) for i, k in enumerate(low.reshape(KEYS, EACH))], np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part, prints, keys, lows = batch.slice(at, 1024), [], [], []
            for text in texts_of(part, 1):
                h = shingles(text)
                bits = np.nonzero(2 * bit_counts(h) > len(h))[0]
                prints.append(sum(1 << int(b) for b in bits))
                low = minhashes(h)
                lows.append(low.tobytes())
                keys.append(minhash_keys(low))
            flat = np.concatenate(keys).view(np.int64)
            offsets = pa.array(np.arange(len(keys) + 1) * KEYS, pa.int32())
            columns = [part.column(0), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(lows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["t", "fp", "keys", "low"])


# ---- candidates in a cell ----------------------------------------------------------------------------


def spanning_forest(low: np.ndarray, root: np.ndarray) -> list[tuple[int, int]]:
    """A maximum spanning forest over estimated similarities of at least ``MAYBE`` (rows of one root count as joined)."""
    n, least = len(low), MAYBE * low.shape[1]
    best, to, left = np.full(n, -1.0), np.zeros(n, np.int64), np.ones(n, bool)
    out = []
    for _ in range(n):
        at = int(np.argmax(np.where(left, best, -2.0)))
        if best[at] >= least and root[at] != root[to[at]]:
            out.append((int(to[at]), at))
        left[at] = False
        same = np.count_nonzero(low == low[at], axis=1).astype(float)
        same[root == root[at]] = low.shape[1] + 1
        closer = left & (same > best)
        best[closer], to[closer] = same[closer], at
    return out


def sample_of(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """``(b, values)``: the sorted 32-bit hashes below 2^(32 - b), with the smallest b that leaves ``SAMPLE`` or so."""
    values = np.unique((hashes >> np.uint64(32)).astype(np.uint32))
    b = max(0, math.ceil(math.log2(len(values) / SAMPLE)))
    return b, values[values < 2 ** (32 - b)]


def may_be_alike(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> bool:
    """Whether the samples of two texts leave it open that they are alike (32-bit hashes only ever add to what they share)."""
    bits = max(a[0], b[0])
    x, y = ((v[: np.searchsorted(v, 2 ** (32 - bits))] if k < bits else v) for k, v in (a, b))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= (ALIKE - (5 * 0.4 / math.sqrt(SAMPLE) if bits else 0)) * (len(x) + len(y) - both)


def open_pairs(band: int, low: np.ndarray, root: np.ndarray, role: np.ndarray, samples: list[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
    """Pairs of different roots, one of role 1, that may be alike and share no MinHash key before ``band``."""
    least, out = MAYBE * low.shape[1], []
    size = np.array([len(v) << b for b, v in samples], float)
    place = np.arange(len(low))
    for i in np.flatnonzero(role == 1).tolist():
        same = low == low[i]
        j = np.flatnonzero((np.count_nonzero(same, axis=1) >= least) & (root != root[i]) & ((role == 0) | (place > i)))
        if len(j):
            shared = same[j].reshape(len(j), KEYS, EACH).all(axis=2)
            j = j[np.where(shared.any(axis=1), shared.argmax(axis=1), KEYS) == band]
            close = np.minimum(size[j], size[i]) >= 0.75 * np.maximum(size[j], size[i])  # sizes apart by over a fifth cannot be alike
            out += [(i, k) for k in j[close].tolist() if may_be_alike(samples[i], samples[k])]
    return out


def _in_cells(solve, out: pa.Schema):
    """Batches sorted by cell (the first column) -> what ``solve`` makes of the rows of each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last, found = [], None, []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate(out.types)], schema=out)

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for cell, *row in zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns), strict=True):
                    if cell != last:
                        found += solve(rows) if len(rows) > 1 else []
                        rows, last = [], cell
                    rows.append(tuple(row))
            if len(found) > 10_000:
                yield batch_of()
                found = []
        found += solve(rows) if len(rows) > 1 else []
        yield batch_of()

    return run


_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _ordered(ts: tuple, pairs: list[tuple[int, int]]) -> list[tuple[bytes, bytes]]:
    return [(min(ts[i], ts[j]), max(ts[i], ts[j])) for i, j in pairs if ts[i] != ts[j]]


def _roots(roots: tuple) -> np.ndarray:
    return np.unique(np.array([r.hex() for r in roots]), return_inverse=True)[1]


def _sketches(lows: tuple) -> np.ndarray:
    return np.frombuffer(b"".join(lows), np.uint32).reshape(len(lows), -1)


def _first_pass(rows: list[tuple]) -> list[tuple]:
    ts, lows = zip(*rows, strict=True)
    return _ordered(ts, spanning_forest(_sketches(lows), np.arange(len(rows))))


def _second_pass(rows: list[tuple]) -> list[tuple]:
    role, band, ts, roots, lows, bits, values = zip(*rows, strict=True)
    samples = [(b, np.frombuffer(v, np.uint32)) for b, v in zip(bits, values, strict=True)]
    return _ordered(ts, open_pairs(band[0], _sketches(lows), _roots(roots), np.array(role), samples))


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            made = [sample_of(shingles(t)) for t in texts_of(part, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([b for b, _ in made], pa.int32()), pa.array([v.tobytes() for _, v in made], pa.binary())], ["t", "bits", "sample"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, own = None, np.empty(0, np.uint64)
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part, near = batch.slice(at, 1024), []
            for a, b in zip(texts_of(part, 2), texts_of(part, 3), strict=True):
                if a != last:  # rows of one text tend to follow each other
                    last, own = a, shingles(a)
                near.append(similarity(own, shingles(b)) >= ALIKE)
            yield pa.RecordBatch.from_arrays([x.filter(pa.array(near, pa.bool_())) for x in part.columns[:2]], ["a", "b"])


def _shared_keys(signed: DataFrame) -> DataFrame:
    """``key band t low`` for keys that several texts have.  Sketches travel only with those."""
    linked = link_fingerprints(signed.select("fp").distinct(), MAX_BITS)
    minhash = signed.select(F.posexplode("keys").alias("band", "key"), "t").select("key", "band", "t")
    last = F.lit(KEYS).alias("band")
    by_print = signed.select("t", "fp").join(linked, "fp").select(F.xxhash64(F.lit("simhash"), "root").alias("key"), last, "t")
    same_print = signed.select(F.xxhash64(F.lit("print"), "fp").alias("key"), last, "t")
    members = minhash.union(by_print).union(same_print)
    shared = members.groupBy("key").agg(F.min("t").alias("low"), F.max("t").alias("high")).where("low <> high").select("key")
    members = cut(members.join(shared, "key").select("key", "band", "t").distinct())
    sketches = signed.join(members.select("t").distinct(), "t", "left_semi").groupBy("t").agg(F.max("low").alias("low"))
    return cut(members.join(sketches, "t").select("key", "band", "t", "low"))


def similar_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``t root`` for every text key in a group of two or more; ``root`` is the smallest key of its group."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(text_key(F.col(f"`{text_col}`")).alias("t"), F.col(f"`{text_col}`").alias("text"))
    members = _shared_keys(cut(base.mapInArrow(_signatures, "t binary, fp long, keys array<long>, low binary")))
    texts = cut(base.join(members.select("t").distinct(), "t", "left_semi").groupBy("t").agg(F.max("text").alias("text")))
    known = lambda x: texts.select(F.col("t").alias(x), F.col("text").alias(f"text_{x}"))

    def alike(cells: DataFrame, columns: list[str], solve) -> DataFrame:
        rows = cells.select("cell", *columns).repartition(parts, "cell").sortWithinPartitions("cell", "t")
        pairs = rows.mapInArrow(_in_cells(solve, _PAIR), "a binary, b binary").distinct()
        return pairs.join(known("b"), "b").join(known("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a binary, b binary")

    release(spark)
    groups = classes(alike(hot_groups.first_cells(members.select("key", "t", "low"), "key", "t", CELL), ["t", "low"], _first_pass), "t")
    rooted = cut(members.join(groups, "t", "left").select("key", "band", "t", F.coalesce("root", "t").alias("root"), "low"))
    still = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    rooted = cut(rooted.join(still, "key"))
    del members, still
    release(spark)
    samples = texts.join(rooted.select("t").distinct(), "t", "left_semi").mapInArrow(_samples, "t binary, bits int, sample binary")
    cells = hot_groups.rest_cells(rooted, "key", "t", "root", CELL).join(samples, "t")
    more = cut(alike(cells, ["role", "band", "t", "root", "low", "bits", "sample"], _second_pass))
    if more.isEmpty():
        return groups
    return classes(groups.select(F.col("t").alias("a"), F.col("root").alias("b")).union(more), "t")
