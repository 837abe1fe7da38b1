import re

import numpy as np
import pytest

from tallyfold.llm import fm_substring as S


def slow(rows, window=20):
    """rows: (doc, text) -> (doc, n_words, n_removed, rest)"""
    key = lambda d: -(1 << 63) if d is None else d
    first = {}
    split = [(key(d), re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in split:
        for s in range(len(w) - window + 1):
            g = tuple(w[s : s + window])
            first[g] = min(first.get(g, (d, s)), (d, s))
    out = []
    for (d, t), (k, w) in zip(rows, split, strict=True):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (k, s):
                gone.update(range(s, s + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


def fast(spark, rows):
    got = S.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "n_words", "n_removed", "text").collect()
    return sorted(map(tuple, got), key=repr)


def test_index_counts():
    rng = np.random.default_rng(1)
    lengths = rng.integers(3, 30, 200)
    x = rng.integers(1, 5, lengths.sum())
    index = S.FmIndex(x, lengths)
    ends = np.cumsum(lengths)
    parts = [x[e - n : e].tolist() for e, n in zip(ends, lengths, strict=True)]
    for _ in range(200):
        p = rng.integers(1, 5, rng.integers(1, 6)).tolist()
        lo, hi = np.array([0]), np.array([index.size])
        for c in reversed(p):
            lo, hi = index.extend(np.array([c]), lo, hi)
        want = sum(f[i : i + len(p)] == p for f in parts for i in range(len(f)))
        assert hi[0] - lo[0] == want


def test_places_are_found_from_samples():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 40, 150)
    x = rng.integers(1, 9, lengths.sum())
    text = np.insert(x + len(lengths) - 1, np.cumsum(lengths), np.arange(len(lengths)))
    want = S.suffix_array(text)
    for sample in (1, 8, 1000):
        index = S.FmIndex(x, lengths, sample)
        ranks = np.arange(len(lengths), index.size)  # separators have no place of their own
        assert index.locate(ranks).tolist() == want[ranks].tolist()
        assert sample == 1 or len(index.places) < index.size / 2


def test_matching_statistics():
    """Streamed fragments against an index over others."""
    rng = np.random.default_rng(4)
    lengths = rng.integers(2, 30, 60)
    x = rng.integers(1, 4, lengths.sum())
    index = S.FmIndex(x, lengths)
    held = [x[e - n : e].tolist() for e, n in zip(np.cumsum(lengths), lengths, strict=True)]
    asked = rng.integers(3, 25, 20)
    y = rng.integers(1, 4, asked.sum())
    best, lo, hi = index.matching_statistics(y, asked, 9)
    times = lambda p: sum(f[i : i + len(p)] == p for f in held for i in range(len(f)))
    at = 0
    for n in asked.tolist():
        f = y[at : at + n].tolist()
        for e in range(n):
            want = max([k for k in range(1, min(9, e + 1) + 1) if times(f[e + 1 - k : e + 1]) > 1], default=0)
            assert best[at + e] == want
            if want:
                assert hi[at + e] - lo[at + e] == times(f[e + 1 - want : e + 1])
        at += n


def test_intervals_and_clashing_columns(spark):
    common = " ".join(f"c{i}" for i in range(25))
    rows = [(1, f"a b {common} x"), (2, f"{common} y y {common}"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: S.F.lit(c) for c in ("row", "doc", "rid", "spots", "firsts", "key", "h", "removed", "n_words")})
    got = {r.row.doc_id: r for r in S.dedup_substrings(df).collect()}
    assert [[(x["from"], x["to"]) for x in got[i].removed] for i in (1, 2, 3)] == [[], [(0, 25), (27, 52)], []]
    assert got[2].text == "y y" and got[2].row.n_words == "n_words"


def test_anchors(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [b"", b" \n", b"a b", *[" ".join(f"w{i}" for i in rng.integers(0, 30, n)).encode() for n in (19, 20, 21, 300, 5)], "é\x0bÄ x\x1fy ".encode() * 40, b"\tz " * 25]
    for chunk in (1 << 20, 50):
        monkeypatch.setattr(S, "_CHUNK", chunk)
        got = list(S.per_text(len(texts), S.anchor_table(texts)))
        for text, (h, p, first, last) in zip(texts, got, strict=True):
            words = text.split()
            _, each = S.word_table([text])
            assert len(each) == len(words) and len(set(words)) == len(set(each.tolist()))
            want = []
            if len(words) >= 20:
                g = S.gram_hashes(each)
                for s in range(len(words) - 19):
                    at = s + int(g[s : s + 13].argmin())
                    if want and want[-1][1] == at:
                        want[-1][3] = s
                    else:
                        want.append([int(g[at]), at, s, s])
            assert list(map(list, zip(h.tolist(), p.tolist(), first.tolist(), last.tolist(), strict=True))) == want


@pytest.mark.parametrize("seed", range(4))
def test_random_passages(spark, seed):
    rng = np.random.default_rng(seed)
    pool = [[f"w{i}" for i in rng.integers(0, 3000, rng.integers(15, 60))] for _ in range(12)]
    rows = []
    for d in rng.permutation(60).tolist():
        words = []
        for _ in range(rng.integers(0, 6)):
            words += pool[rng.integers(0, 12)][rng.integers(0, 8) :] if rng.random() < 0.6 else [f"w{i}" for i in rng.integers(0, 3000, rng.integers(1, 50))]
        rows.append((d, " ".join(words)))
    assert fast(spark, rows) == slow(rows)


def test_periodic_hot_and_edges(spark, monkeypatch):
    long = " ".join(str(i % 37) for i in range(3000))
    rows = [(1, "a " * 50), (2, "a " * 45 + "b"), (3, "a b " * 30), (4, None), (5, ""), (None, "x y z " * 9), (None, "x y z " * 9), (7, "x y z " * 9), (7, "x y z " * 9), (8, " ".join(map(str, range(19)))), (9, " ".join(map(str, range(19)))), (10, long), (11, "q " + long), (-3, "A\x1fb\x0bc " * 12)]
    assert fast(spark, rows) == slow(rows)
    monkeypatch.setattr(S, "HOT", 1)
    monkeypatch.setattr(S, "INDEX_WORDS", 50)
    assert fast(spark, rows) == slow(rows)


def test_rows_whose_hashes_collide(spark, monkeypatch):
    """A hash of a few bits for everything but the second choice: rows are told apart all the same."""
    real = S.F.xxhash64
    monkeypatch.setattr(S.F, "xxhash64", lambda *c: S.F.pmod(real(*c), S.F.lit(3)) if isinstance(c[0], str) and c[0] == "doc" else real(*c))
    rng = np.random.default_rng(7)
    rows = [(d, " ".join(f"w{i}" for i in rng.integers(0, 40, 60))) for d in range(30)] + [(1, "x y z " * 20), (1, "x y z " * 20)]
    for few in (100_000, 0):
        monkeypatch.setattr(S, "BROADCAST_ROWS", few)
        base = S.known_rows(spark.createDataFrame(rows, "doc long, text string"))
        assert base.select("rid").distinct().count() == 31
        assert fast(spark, rows) == slow(rows)


def test_empty(spark):
    assert fast(spark, []) == []


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert fast(spark, rows) == slow(rows)
