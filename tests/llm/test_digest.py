import hashlib
import re
import unicodedata

import xxhash
from pyspark.sql import functions as F

from tallyfold.llm import exact_digest as D


def canon(t):
    t = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t or "").casefold())
    return re.sub(r"\s+", " ", t).strip(" ")


def print_of(t):
    c = canon(t).encode()
    a = xxhash.xxh64_intdigest(c, 42)
    b = xxhash.xxh64_intdigest(c, xxhash.xxh64_intdigest((0x51ED).to_bytes(4, "little"), 42))
    return f"{a:016x}{b:016x}"


def slow(rows):
    texts = [t or "" for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: hashlib.sha256(texts[i].encode()).digest(), reverse=True)
    order.sort(key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0)))
    out = []
    for at, i in enumerate(order):
        t, nxt = texts[i], texts[order[(at + 1) % len(order)]]
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        out.append((rows[i][0], len(t), hashlib.sha256(e.encode()).hexdigest(), print_of(t), print_of(e), float(canon(t) == canon(e)), float(canon(t) == canon(nxt))))
    return sorted(out, key=repr)


def fast(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("x"), "range": F.lit(1), "fp": F.lit(None).cast("string"), "guest": F.lit(7)})
    return sorted(map(tuple, D.edited_fingerprints(df).collect()), key=repr)


def test_edges(spark):
    rows = [(5, "Straße ﬁne  Á"), (4, "STRASSE  fine Á"), (9, None), (8, ""), (2, "𝒳y z" * 3), (None, "null id"), (None, "other null id"), (7, "dup"), (7, "dup"), (-1, "w " * 40_000)]
    assert fast(spark, rows) == slow(rows)
    got = {r[0]: r[3] for r in fast(spark, rows)}
    assert got[5] == got[4] and got[9] == got[8] and got[5] != got[7]


def test_one_and_none(spark):
    assert fast(spark, [(3, "only")]) == slow([(3, "only")])
    assert fast(spark, []) == []


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert fast(spark, rows) == slow(rows)


def test_collisions_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(D, "wide_hash", lambda c: F.substring(c, 1, 1))
    df = spark.createDataFrame([(1, "ax"), (2, "ay"), (3, "AX"), (4, "b")], "doc_id long, text string")
    for few in (100_000, 0):
        monkeypatch.setattr(D, "BROADCAST_TEXTS", few)
        got = {r.row.doc_id: r.fingerprint for r in D.fingerprints(df).collect()}
        assert got[1] == got[3] != got[2] and got[4] == "b" and got[1][0] == got[2][0] == "a"


def test_edited_texts_are_told_apart_too(spark, monkeypatch):
    """With a hash that collides all the time the bytes decide: equal texts, and only those, have equal fingerprints."""
    monkeypatch.setattr(D, "wide_hash", lambda c: F.substring(c, 1, 1))
    rows = [(1, "abcd"), (2, "ABcd"), (3, "abxy"), (4, "b"), (5, "abcd"), (6, ""), (7, "abab"), (8, "ab")]
    got = {r.doc_id: r for r in D.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    edited = {i: text[i][: len(text[i]) - len(text[i]) // 2] + text[i - 1 if i > 1 else 8][: len(text[i]) // 2] for i in text}
    prints = [(canon(text[i]), got[i].fingerprint) for i in text] + [(canon(edited[i]), got[i].edited_fingerprint) for i in text]
    for a, x in prints:
        assert all((a == b) == (x == y) for b, y in prints)
    for i in text:
        assert got[i].near_edited == float(canon(text[i]) == canon(edited[i])) and got[i].near_next == float(canon(text[i]) == canon(text[i - 1 if i > 1 else 8]))


def test_hot_and_missing_ids_are_spread(spark):
    rows = [(None, f"text {i}") for i in range(400)] + [(7, f"other {i % 150}") for i in range(400)] + [(i, f"own {i}") for i in range(-200, 200)]
    assert fast(spark, rows) == slow(rows)
    base = spark.createDataFrame(rows, "id long, text string").withColumn("raw", D.raw_key(F.col("text")))
    sizes = base.groupBy(D._places(base).alias("p")).count()
    assert sizes.agg(F.max("count")).first()[0] < 150
