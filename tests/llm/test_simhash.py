import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tallyfold.llm import hot_groups
from tallyfold.llm import simhash_vptree as S


def slow_fingerprint(text, words=4):
    own = "".join(c.lower() if c.isascii() else c for c in text)
    import re

    own = re.findall(r"[^\x20\x09-\x0D]+", own)
    if not own:
        return 0
    grams = [" ".join(own[i : i + words]) for i in range(max(1, len(own) - words + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, prints, most=4):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(set(prints))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if bin(a ^ b).count("1") <= most:
                root[find(a)] = find(b)
    out = {}
    for i, p in zip(ids, prints, strict=True):
        if i is not None:
            out[find(p)] = min(out.get(find(p), i), i)
    return [out.get(find(p)) for p in prints]


@pytest.mark.parametrize("text", ["", " \n", "one", "a b c", "A b C d", "x " * 700, "Ä é ß İ words here and more of them", "a b c\x1fd e\x0bf g h i"])
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == slow_fingerprint(text)


def test_long_text_in_chunks():
    text = " ".join(str(i * 7919 % 1000) for i in range(70_000))
    assert S.fingerprint(text.encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("n,clusters", [(50, 3), (900, 2), (3000, 40)])
def test_tree_finds_all_links(n, clusters):
    rng = np.random.default_rng(n)
    centres = rng.integers(0, 2**64, clusters, np.uint64)
    x = centres[rng.integers(0, clusters, n)]
    for _ in range(6):
        x = x ^ np.where(rng.random(n) < 0.5, np.uint64(1) << rng.integers(0, 64, n, np.uint64), np.uint64(0))
    x = np.unique(np.concatenate((x, rng.integers(0, 2**64, n, np.uint64))))
    a, b = S.tree_links(x)
    assert (np.bitwise_count(a ^ b) >= 0).all()
    root = {int(p): int(p) for p in x}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        root[find(p)] = find(q)
    want = slow_components(list(range(len(x))), x.tolist())
    got = {}
    for i, p in enumerate(x.tolist()):
        got[find(p)] = min(got.get(find(p), i), i)
    assert [got[find(p)] for p in x.tolist()] == want


def test_bands_cover_every_pair():
    for points in (10, 10**5, 10**8, 10**10, 10**12):
        masks = S.band_masks(points, 4)
        rng = np.random.default_rng(points % 1000)
        for _ in range(200):
            d = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(not d & m for m in masks)
        if points > S.SHARD:
            assert all(S.SHARD / 2 <= points / 2 ** bin(m).count("1") <= S.SHARD for m in masks)
    assert len(S.band_masks(10**6)) == 5 and len(S.band_masks(10**9)) == 15


def test_trees_split_and_prune():
    """Shards of the size that the bands aim at are cut into many leaves, and most pairs are never looked at."""
    rng = np.random.default_rng(8)
    x = np.unique(rng.integers(0, 2**64, S.SHARD, np.uint64))
    seen = S.walk(x)
    assert seen.nodes > 20 and seen.leaves > 50
    assert seen.pruned > 0.25 * len(x) * (len(x) - 1) / 2
    centre = np.uint64(rng.integers(0, 2**63))
    copies = np.unique(np.array([centre] + [centre ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a in range(64) for b in range(a)], np.uint64))
    dense = S.walk(copies)
    assert dense.enclosed > 0 and len(set(dense.label.tolist())) == 1
    assert dense.distances < 0.1 * len(copies) ** 2  # what is connected is not compared again


def test_rest_against_all():
    rng = np.random.default_rng(9)
    centres = rng.integers(0, 2**64, 30, np.uint64)
    x = np.unique(centres[rng.integers(0, 30, 1500)] ^ (np.uint64(1) << rng.integers(0, 64, 1500, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1500, np.uint64)))
    rest = rng.random(len(x)) < 0.2
    a, b = S.tree_links(x, 4, rest)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 4
    near &= rest[:, None] | rest[None, :]
    want = slow_labels(len(x), zip(*np.nonzero(near), strict=True))
    at = {int(p): i for i, p in enumerate(x)}
    got = slow_labels(len(x), [(at[int(p)], at[int(q)]) for p, q in zip(a, b, strict=True)])
    assert got == want


def slow_labels(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        up[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def check(spark, rows, schema="doc_id long, text string"):
    got = S.near_duplicates(spark.createDataFrame(rows, schema)).select("row.doc_id", "fingerprint", "component_id").collect()
    prints = [slow_fingerprint(r[1] or "") for r in rows]
    want = sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, slow_components([r[0] for r in rows], prints), strict=True)), key=repr)
    assert sorted(map(tuple, got), key=repr) == want


def test_edge_rows(spark):
    check(spark, [(3, None), (None, ""), (7, "one two"), (7, "one two"), (9, "ONE two"), (None, "alone here"), (1, "z " * 5000)])


def test_empty(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("points", [10, 10**5, 10**9])
@pytest.mark.parametrize("large", [8192, 40])
def test_hot_shards_and_many_bands(spark, monkeypatch, points, large):
    """Shards far above the bound are dealt to cells; no link is lost."""
    monkeypatch.setattr(S, "LARGE", large)
    masks = S.band_masks(points)
    monkeypatch.setattr(S, "band_masks", lambda n, m: masks)
    rng = np.random.default_rng(5)
    centres = rng.integers(-(2**63), 2**63, 4)
    x = {int(c) ^ S._signed(1 << int(b)) ^ S._signed(1 << int(d)) ^ S._signed(1 << int(e)) for c in centres for b, d, e in rng.integers(0, 64, (150, 3))}
    found = S.link_fingerprints(spark.createDataFrame([(p,) for p in x], "fp long")).collect()
    root = {r.fp: r.root for r in found}
    pts = sorted(x)
    want = slow_components(pts, [p % 2**64 for p in pts])
    assert [root.get(p, p) for p in pts] == want


def test_no_cell_is_much_larger_than_its_bound(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 5 < 4, 1).otherwise(F.col("id")).alias("key"), F.col("id").alias("fp"), F.when(F.col("id") < 4900, 0).otherwise(F.col("id")).alias("root"))
    first = hot_groups.first_cells(rows.drop("root"), "key", "fp", 100).groupBy("cell").count()
    assert first.agg(F.max("count")).first()[0] < 250
    rest = hot_groups.rest_cells(rows, "key", "fp", "root", 100)
    assert rest.groupBy("cell").count().agg(F.max("count")).first()[0] < 350
    assert rest.count() < 3 * 4000 and rest.where("role = 1").select("fp").distinct().count() == 80


def test_extra_columns_may_clash(spark):
    rows = spark.createDataFrame([(1, "a b", 7, "x"), (2, "a b", 8, "y")], "doc_id long, text string, fp long, row string").withColumns({c: F.lit(0) for c in ("root", "component_id", "id", "shard", "c0", "fingerprint", "first_id")})
    got = S.near_duplicates(rows, carry=rows.columns).collect()
    assert sorted((r["row"]["doc_id"], r["row"]["fp"], r["row"]["row"], r["component_id"]) for r in got) == [(1, 7, "x", 1), (2, 8, "y", 1)]


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)
