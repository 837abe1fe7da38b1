"""SimHash near-dedup with vantage-point trees.

A fingerprint has 64 bits, each set if it is set in over half of the XXH64 (seed 42) of the text's
word shingles.  Fingerprints link when they differ in at most ``max_bits`` bits; documents whose
fingerprints are connected through links form a component.

Finding the links, exactly:

1. Equal fingerprints are merged first (partial aggregation), so a group of copies is one point.
2. Shards.  Restricted to a band of bits, Hamming distance is still a (pseudo-)metric, and two points within
   ``max_bits`` have distance zero on at least ``parts - max_bits`` of ``parts`` disjoint bands (pigeonhole).  A shard is
   the set of points at distance zero from one vantage pattern on one choice of bands, of which only as many bits are
   used as leave about ``SHARD`` points in a shard; every linked pair meets in one, whatever it contains.
3. In a shard a vantage-point tree joins the points with themselves.  A node measures its points' distance to a
   vantage point and splits them at the median.  What the triangle inequality decides is not looked at: points
   within ``max_bits / 2`` of the vantage point are all linked, branches further apart than ``max_bits`` are not
   visited, and across a split only the shells next to it are compared.  Leaves of ``LEAF`` points are compared in
   full.  A shard emits a spanning forest of its links (fewer rows than points), never the pairs.
4. A shard of over ``LARGE`` points (a band that a group of near copies shares) is dealt to cells of bounded size, see
   ``hot_groups``: blocks with common pivots first, then the points outside the shard's largest component against
   all of its points.
5. Components of the forest edges are found with large-star / small-star rounds on DataFrames, each
   checkpointed; nothing but a checksum of the edges reaches the driver.

Without bands the trees would be exact too, but near-uniform 64-bit points have distances of 32 +- 4, so a radius of
4 crosses 57 % of the split points at every level and the work grows with the power 1.8 of the points; shards keep
the points under one tree to a few hundred, whatever the corpus holds.

Defined cases: a null or empty text has fingerprint zero, linked like any other; fewer words than a
shingle give one shingle, the whole sequence; a document with a null id has a fingerprint and the
component's smallest non-null id (null if it has none); repeated rows are repeated in the result; an
empty table gives an empty result; other columns, whatever their names, are carried in ``row``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hot_groups
from .common import cut, release, texts_of

WORDS, SEED, MAX_BITS = 4, 42, 4
SHARD, LARGE, LEAF = 512, 8192, 24
_LANES = np.uint64(0x0101010101010101)
_CHUNK = 255


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The unsigned 64-bit SimHash of a UTF-8 text."""
    import xxhash

    own = text.lower().split()
    if not own:
        return 0
    joined = b" ".join(own)
    hash_of = xxhash.xxh64_intdigest
    if len(own) <= words:
        return hash_of(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(own) - words + 1].tolist()
    ends = (ends[words - 1 :] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):  # bounded memory for very long texts
        h = np.array([hash_of(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)], strict=True)], np.uint64)
        counts += bit_counts(h)
    bits = np.nonzero(2 * counts > len(starts))[0]
    return sum(1 << int(b) for b in bits)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of ``h`` have each of the 64 bits set (eight byte-wide counters at a time)."""
    at, out = np.arange(0, len(h), _CHUNK), np.empty((8, 8), np.int64)
    for j in range(8):
        sums = np.add.reduceat((h >> np.uint64(j)) & _LANES, at)
        out[:, j] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return out.reshape(64)


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array([fingerprint(t, words) for t in texts_of(batch, 1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], ["row", "fp"])

    return run


def band_masks(points: int, max_bits: int = MAX_BITS) -> list[int]:
    """One mask per choice of bands: as many bands as give enough bits for shards of ``SHARD`` random points, and of
    each choice only as many bits as that takes."""
    wanted = max(0, math.ceil(math.log2(max(points, 1) / SHARD)))
    parts = max_bits + 1
    while parts < 2 * max_bits + 4 and 64 * (parts - max_bits) // parts < wanted:
        parts += 1
    edges = [64 * i // parts for i in range(parts + 1)]
    bands = [range(a, b) for a, b in zip(edges, edges[1:], strict=False)]
    masks = []
    for choice in combinations(bands, parts - max_bits):
        turns = [b for several in zip_longest(*choice) for b in several if b is not None]  # bits from all bands alike
        masks.append(sum(1 << b for b in turns[:wanted]))
    return sorted(set(masks))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# ---- the tree, on one shard -------------------------------------------------------------------


class Links:
    """Components of a shard's points while its tree is walked, and what the walk did: inner ``nodes`` and ``leaves``
    visited, ``distances`` measured, balls ``enclosed`` whole, and pairs of points that were never looked at because
    of the triangle inequality (``pruned``) or because they were connected already (``connected``)."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.nodes = self.leaves = self.distances = self.enclosed = self.pruned = self.connected = 0

    def join(self, at: np.ndarray) -> None:
        """All points ``at`` are connected."""
        own = np.unique(self.label[at])
        if len(own) > 1:
            self.label[np.isin(self.label, own)] = own[0]

    def compare(self, x: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> None:
        self.leaves += 1
        self.distances += len(a) * len(b)
        near = np.bitwise_count(x[a][:, None] ^ x[b][None, :]) <= most
        near &= self.label[a][:, None] != self.label[b][None, :]
        i, j = np.nonzero(near)
        for u, v in zip(a[i].tolist(), b[j].tolist(), strict=True):
            p, q = self.label[u], self.label[v]
            if p != q:
                self.label[self.label == max(p, q)] = min(p, q)

    def apart(self, a: np.ndarray, b: np.ndarray) -> bool:
        """False if every point of both sides is in one component already."""
        first = self.label[a[0]]
        return bool((self.label[a] != first).any() or (self.label[b] != first).any())


def _distances(x: np.ndarray, at: np.ndarray, vantage: int, out: Links) -> np.ndarray:
    out.distances += len(at)
    return np.bitwise_count(x[at] ^ x[vantage]).astype(np.int64)


def _own(x: np.ndarray, at: np.ndarray, most: int, out: Links) -> None:
    """Link the points ``at`` of ``x`` among themselves."""
    if len(at) < 2 or not out.apart(at[:1], at):
        out.connected += len(at) * (len(at) - 1) // 2
        return
    if len(at) <= LEAF:
        out.compare(x, at, at, most)
        return
    out.nodes += 1
    vantage = int(at[len(at) // 2])
    d = _distances(x, at, vantage, out)
    inside = d <= most // 2  # any two of them are within ``most``
    if inside.sum() > 1:
        out.enclosed += 1
        out.join(at[inside])
    out.join(at[d <= most])  # neighbours of the vantage point
    mid = int(np.median(d))
    inner = d <= mid
    if inner.all():
        inner = d < mid
    if not inner.any():  # all at one distance: no split here, cut by order and compare across
        half = len(at) // 2
        _own(x, at[:half], most, out)
        _own(x, at[half:], most, out)
        _cross(x, at[:half], at[half:], most, out)
        return
    edge = int(d[inner].max())
    _own(x, at[inner], most, out)
    _own(x, at[~inner], most, out)
    shell, beyond = at[inner & (d >= edge + 1 - most)], at[~inner & (d <= edge + most)]
    out.pruned += int(inner.sum() * (~inner).sum()) - len(shell) * len(beyond)
    _cross(x, shell, beyond, most, out)


def _cross(x: np.ndarray, a: np.ndarray, b: np.ndarray, most: int, out: Links) -> None:
    """Link points of ``a`` with points of ``b``: both sides split at the same vantage point."""
    if not len(a) or not len(b) or not out.apart(a, b):
        out.connected += len(a) * len(b)
        return
    if len(a) * len(b) <= LEAF * LEAF:
        out.compare(x, a, b, most)
        return
    out.nodes += 1
    side = a if len(a) >= len(b) else b
    vantage = int(side[len(side) // 2])
    da, db = _distances(x, a, vantage, out), _distances(x, b, vantage, out)
    if da.min() - db.max() > most or db.min() - da.max() > most:
        out.pruned += len(a) * len(b)
        return
    mid = int(np.median(np.concatenate((da, db))))
    ia, ib = da <= mid, db <= mid
    visited = 0
    shells = (ia & (da > mid - most), ~ib & (db <= mid + most)), (~ia & (da <= mid + most), ib & (db > mid - most))
    for ma, mb in ((ia, ib), (~ia, ~ib), *shells):
        if ma.all() and mb.all():  # the vantage point tells nothing apart
            _block(x, a, b, most, out)
        else:
            _cross(x, a[ma], b[mb], most, out)
        visited += int(ma.sum() * mb.sum())
    out.pruned += len(a) * len(b) - visited


def _block(x: np.ndarray, a: np.ndarray, b: np.ndarray, most: int, out: Links) -> None:
    for i in range(0, len(a), 16 * LEAF):
        for j in range(0, len(b), 16 * LEAF):
            u, w = a[i : i + 16 * LEAF], b[j : j + 16 * LEAF]
            if out.apart(u, w):
                out.compare(x, u, w, most)


def walk(points: np.ndarray, max_bits: int = MAX_BITS, rest: np.ndarray | None = None) -> Links:
    """The tree over distinct fingerprints; with ``rest`` (a mask) only pairs with one of them are looked for."""
    out = Links(len(points))
    at = np.arange(len(points))
    if rest is None:
        _own(points, at, max_bits, out)
    else:
        _cross(points, at[rest], at[~rest], max_bits, out)
        _own(points, at[rest], max_bits, out)
    return out


def tree_links(points: np.ndarray, max_bits: int = MAX_BITS, rest: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints, as (point, another of its component) arrays."""
    label = walk(points, max_bits, rest).label
    linked = np.flatnonzero(label != np.arange(len(points)))
    return points[linked], points[label[linked]]


def _join_cells(max_bits: int):
    """Batches of (cell, role, fp), sorted by cell -> forest edges.  A cell holds a bounded number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def edges(k: np.ndarray, role: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1], [True])))
            a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if j - i > 1:
                    if role[i:j].all():
                        u, v = tree_links(x[i:j], max_bits)
                    else:  # a point of the rest comes with both roles
                        p, first = np.unique(x[i:j][np.argsort(-role[i:j], kind="stable")], return_index=True)
                        u, v = tree_links(p, max_bits, np.sort(-role[i:j])[first] == -1)
                    a.append(u)
                    b.append(v)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(z).view(np.int64)) for z in (a, b)], ["a", "b"])

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                yield edges(*(np.concatenate(z) for z in zip(*held, strict=True)))
                held.clear()

        for batch in batches:
            k, role, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
            if not len(k):
                continue
            new = np.flatnonzero(k != (held[-1][0][-1] if held else k[0]))
            if not len(new):
                held.append((k, role, x))
                continue
            last = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
            held.append((k[:last], role[:last], x[:last]))
            yield from flush()
            held.append((k[last:], role[last:], x[last:]))
        yield from flush()

    return run


def _cell_links(cells: DataFrame, max_bits: int) -> DataFrame:
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = cells.select("cell", F.col("role").cast("int").alias("role"), "fp").repartition(n, "cell").sortWithinPartitions("cell", "fp")
    return rows.mapInArrow(_join_cells(max_bits), "a long, b long")


def link_fingerprints(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct ``fp`` -> ``fp root`` of those that are linked to another one, directly or through others."""
    masks = band_masks(points.count(), max_bits)
    shard = F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)]))
    placed = points.select(shard.alias("shard"), "fp")
    found = classes(_cell_links(hot_groups.first_cells(placed, "shard", "fp", LARGE).withColumn("role", F.lit(1)), max_bits), "fp")
    large = cut(placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LARGE).select("shard"))
    if large.isEmpty():
        return found
    hot = placed.join(large, "shard").join(found, "fp", "left").select("shard", "fp", F.coalesce("root", "fp").alias("root"))
    more = _cell_links(hot_groups.rest_cells(hot, "shard", "fp", "root", LARGE), max_bits)
    return classes(found.select(F.col("fp").alias("a"), F.col("root").alias("b")).union(more), "fp")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node root``: the smallest node reachable over undirected edges ``a b``, for all nodes that are no roots.

    Alternating large-star and small-star rounds until the edges stay as they are; a hub's neighbours are never
    gathered, only their minimum (a partial aggregation) which is joined back.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
            return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        low = e.groupBy("a").agg(F.min("b").alias("low"))
        moved = e.join(low, "a")
        return moved.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = state(e)
    for _ in range(most_rounds):
        if not before[0]:
            break
        e = cut(star(star(e, True), False))
        now = state(e)
        release(e.sparkSession)  # files of earlier rounds
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def classes(edges: DataFrame, name: str) -> DataFrame:
    """``<name> root`` for every node of an edge, roots included."""
    found = components(edges)
    return cut(found.select(F.col("node").alias(name), "root").union(found.select(F.col("root").alias(name), "root").distinct()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, max_bits: int = MAX_BITS, carry: list[str] | None = None) -> DataFrame:
    """``row fingerprint component_id`` per input row; ``row`` holds the ``carry`` columns (the id by default)."""
    carry = [id_col] if carry is None else carry
    base = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    kind = base.schema["row"].dataType.simpleString()
    prints = cut(base.mapInArrow(_fingerprints(words), f"row {kind}, fp long"))
    points = cut(prints.groupBy("fp").agg(F.min("row.id").alias("first_id")))
    linked = points.join(link_fingerprints(points.select("fp"), max_bits), "fp")
    # only linked points take part: a component's smallest id is a partial aggregation, whatever its size
    ids = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = cut(linked.join(ids, "root").select("fp", F.col("component_id").alias("shared_id")))
    whole = points.join(of_print.withColumn("linked", F.lit(True)), "fp", "left").select("fp", F.when(F.col("linked"), F.col("shared_id")).otherwise(F.col("first_id")).alias("component_id"))
    row = F.struct(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(carry)]).alias("row")
    return prints.join(whole, "fp").select(row, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
