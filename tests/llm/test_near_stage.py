"""The pipeline's near-dedup stage against brute force over all pairs."""

import random

import corpus_pipeline
from tallyfold.llm import shingle_groups

from . import slow


def sets_of(text):
    w = slow.words((text or "").translate(slow.UP))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def groups_of(texts):
    """Every pair compared; the index of each text's group."""
    sets, at = [sets_of(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if at[i] != at[j] and alike(sets[i], sets[j]):
                at = [at[j] if x == at[i] else x for x in at]
    return at


def stage(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return sorted((tuple(r) for r in corpus_pipeline.near_deduplication(spark, docs, "").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def row(i, text, source="s"):
    return (i, text, "en", source, len(text or ""))


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"new{rng.randrange(10**9)}"
    return out


def smallest(texts):
    got = {}
    for i, g in enumerate(groups_of(texts)):
        got.setdefault(g, i)
    return sorted(got.values())


def test_pairs_near_the_threshold(spark):
    rng, texts, high = random.Random(3), [], 0
    for k in range(60):
        base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        texts += [" ".join(base), " ".join(edited(rng, base, 1 + k % 9))]
        a, b = sets_of(texts[-2]), sets_of(texts[-1])
        high += 0.8 <= len(a & b) / len(a | b) < 0.9
    assert high >= 15
    assert [r[0] for r in stage(spark, [row(i, t) for i, t in enumerate(texts)])] == smallest(texts)


def test_chains_and_templates(spark):
    """Links through others, and texts that share much but too little to be linked."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    chain = [base]
    for _ in range(12):
        chain.append(edited(rng, chain[-1], 4))
    texts = [" ".join(w) for w in chain + [edited(rng, base, 9) for _ in range(25)] + [edited(rng, base, 2) for _ in range(25)]]
    assert [r[0] for r in stage(spark, [row(i, t) for i, t in enumerate(texts)])] == smallest(texts)


def test_documents(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*corpus_pipeline.COLUMNS).collect()]
    rows.sort()
    assert [r[0] for r in stage(spark, rows)] == [rows[i][0] for i in smallest([r[1] for r in rows])]


def test_similarity_counts_distinct_shingles():
    a, b = shingle_groups.shingles(b"a b c d e f a b c d e f"), shingle_groups.shingles(b"A b c d  e f")
    assert len(a) == 8 and shingle_groups.similarity(a, b) == 2 / 6


def test_null_and_repeated_ids(spark):
    """One row of each group stays, whatever the ids; which one does not depend on the order of rows."""
    texts = [" ".join(f"{k}{i}" for i in range(60)) for k in "abcdef"]
    near = texts[0] + " more"
    rows = [row(None, texts[0]), row(None, texts[1]), row(None, texts[2]), row(7, texts[3]), row(7, texts[4]), row(7, texts[4]), row(9, near), row(None, None), row(None, ""), row(3, texts[5], "s"), row(3, texts[5], "t")]
    got = stage(spark, rows)
    assert len(got) == 7 and got == stage(spark, rows[::-1])
    assert [r[:2] for r in got if r[0] is not None] == [(3, texts[5]), (7, texts[3]), (7, texts[4]), (9, near)]
    assert [r[1] for r in got if r[0] is None and r[1]] == texts[1:3]


def test_samples_of_long_texts(monkeypatch):
    """What the second pass rules out is not alike; texts above and below the sampling bound are compared on common ground."""
    import numpy as np

    monkeypatch.setattr(shingle_groups, "SAMPLE", 4096)
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**64, 30_000, np.uint64)
    for size in (900, 5000, 30_000):
        for share in (0.75, 0.86, 0.89, 0.92, 1.0):
            a = base[:size]
            b = np.concatenate((a[: int(size * share)], rng.integers(0, 2**64, size - int(size * share), np.uint64)))
            alike_ = shingle_groups.similarity(a, b) >= 0.8
            may = shingle_groups.may_be_alike(shingle_groups.sample_of(a), shingle_groups.sample_of(b))
            assert may or not alike_
            if share == 0.75:
                assert not may
    small, large = shingle_groups.sample_of(base[:4000]), shingle_groups.sample_of(base[:4500])
    assert small[0] == 0 and large[0] == 1 and shingle_groups.may_be_alike(small, large)


def test_a_large_group_in_small_cells(spark, monkeypatch):
    """Hundreds of near copies, some of them apart from the rest, in cells of a few rows."""
    monkeypatch.setattr(shingle_groups, "CELL", 24)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(edited(rng, base, rng.randrange(0, 8))) for _ in range(180)]
    other = edited(rng, base, 40)
    texts += [" ".join(edited(rng, other, rng.randrange(0, 3))) for _ in range(40)]
    assert [r[0] for r in stage(spark, [row(i, t) for i, t in enumerate(texts)])] == smallest(texts)
