"""Quality, line dedup, mixing and the pipeline against plain versions."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyfold.llm import line_dedup, quality_ledger, source_mix

from . import slow
from .test_near_stage import smallest

LONG = "A line that is long enough to be a key, ÄÖ"
EDGES = [
    (1, "s", None), (2, "s", ""), (3, None, " \n\t"), (4, "t", "a b c a b c a b c"), (4, "t", "a b c a b c a b c"), (None, "t", "null id " * 40), (5, "u", "x " * 100_000), (6, "u", "w1 w2 | # $ %%% & < > * é 日本\x1fz"),
    (7, None, f"{LONG}\n{LONG} \nown line\n{LONG}"), (8, None, LONG.lower().replace("ä", "Ä").replace("ö", "Ö")), (9, "s", f"\t{LONG}"), (10, "s", f"{LONG}\r\nrest"), (11, "s", f"{LONG}\nmore"), (None, "s", LONG), (12, "z", "short\n" * 6),
]


def documents(spark, sf):
    return [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def both(spark, sf):
    return {"edges": EDGES, "documents": documents(spark, sf), "none": []}


def frame(spark, rows):
    """With columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return df.withColumns({c: F.lit(i) for i, c in enumerate(("row", "id", "size", "k", "fp", "n_words", "hash", "bucket", "drops", "keeper"))})


@pytest.mark.parametrize("which", ["edges", "documents", "none"])
def test_quality(spark, both, which):
    rows = both[which]
    entries = quality_ledger.ledger(quality_ledger.measure(frame(spark, rows)))
    got = sorted(((r.row.doc_id, r.failed_bits, r.kept, *(r[m] for m in quality_ledger.MEASURES[:10])) for r in quality_ledger.apply_policy(entries).collect()), key=repr)
    want = []
    for d, _, t in rows:
        m = slow.measures(t)
        f = slow.failed(m)
        want.append((d, sum(x << i for i, x in enumerate(f)), not any(f), *(m[k] for k in quality_ledger.MEASURES[:10])))
    assert got == sorted(want, key=repr)
    table = {r.rule: r for r in quality_ledger.ablations(entries).collect()}
    for i, (rule, _) in enumerate(quality_ledger.RULES):
        fails = [slow.failed(slow.measures(t)) for _, _, t in rows]
        if rows:
            r = table[rule]
            assert (r.failed, r.failed_only_it) == (sum(f[i] for f in fails), sum(f[i] and sum(f) == 1 for f in fails))
            assert r.kept_without_it == sum(not any(x for j, x in enumerate(f) if j != i) for f in fails) and r.kept == sum(not any(f) for f in fails)


def test_quality_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    entries = quality_ledger.apply_policy(quality_ledger.ledger(quality_ledger.measure(spark.read.parquet(f"{sf}/documents.parquet"), carry=["doc_id"])))
    j = entries.select("row.doc_id", "kept", "n_words").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("n_words >= 50")
    r = j.agg(F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("int"))).alias("clean"), F.avg(F.when(F.col("quality") == 0, F.col("kept").cast("int"))).alias("junk")).first()
    assert r.clean > 0.98 and r.junk < 0.02


@pytest.mark.parametrize("hot", [20_000, 3])
@pytest.mark.parametrize("which", ["edges", "documents", "none"])
def test_line_dedup(spark, both, which, hot, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_KEYS", hot)
    rows = both[which]
    got = line_dedup.dedup_lines(frame(spark, rows)).select("row.doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(slow.line_dedup([(d, t) for d, _, t in rows]), key=repr)


@pytest.mark.parametrize("which", ["edges", "documents", "none"])
@pytest.mark.parametrize("few", [10_000, 0])
def test_mixing(spark, both, which, few, monkeypatch):
    monkeypatch.setattr(source_mix, "BROADCAST_SOURCES", few)
    rows = both[which]
    got = source_mix.mix_sources(frame(spark, rows)).select("row.doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()
    tidy = lambda d, s, n, ns, t, c: (d, s, n, ns, round(t, 6), c)
    assert sorted((tidy(*r[:6]) for r in got), key=repr) == sorted((tidy(*r) for r in slow.mix(rows)), key=repr)
    assert all(r.taken == r["size"] * r.copies and r.copies <= 2 for r in got)
    if which == "documents":
        for s in {r.source for r in got}:
            own = [r for r in got if r.source == s]
            assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own) / 2 + 1e-6


def test_stages_against_plain_versions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*corpus_pipeline.COLUMNS).collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    steps = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "source_mixing", "packing"]

    def run(name, want):
        nonlocal docs
        docs = steps[name](spark, docs, sf)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        got = sorted(map(tuple, docs.collect()))
        assert got == sorted(want)
        docs = spark.createDataFrame(got, "doc_id long, text string, lang string, source string, n_chars long")
        return got

    rows = run("quality_rules", [r for r in rows if slow.words(r[1]) and not any(slow.failed(slow.measures(r[1]))[1:])])  # short texts stay
    kept = {d: t for d, t, _, _ in slow.line_dedup([(r[0], r[1]) for r in rows])}
    rows = run("line_dedup", [(r[0], kept[r[0]], r[2], r[3], len(kept[r[0]])) for r in rows if slow.words(kept[r[0]])])
    rows = run("simhash_near_dedup", [rows[i] for i in smallest([r[1] for r in rows])])  # five words, similarity 0.8
    copies = {m[0]: m[5] for m in slow.mix([(r[0], r[3], r[1]) for r in rows])}
    rows = run("source_mixing", [r for r in rows for _ in range(copies[r[0]])])
    want = []
    for r in rows:
        ids = [*tokenizer.encode(r[1], add_special_tokens=False).ids, 1]
        at = 0
        for n in slow.pieces(len(ids)):
            want.append((r[0], at, n, slow.crc(ids[at : at + n]), len(ids)))
            at += n
    got = steps["packing"](spark, docs, sf).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted(tuple(r)[:5] for r in whole) == sorted(want)


def test_quality_stage_agrees_with_labels(spark):
    """Clean documents of any length stay, junk goes."""
    sf = "/root/testdata/sf0.01"
    kept = corpus_pipeline.quality(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).select("doc_id", F.lit(1).alias("kept"))
    j = spark.read.parquet(f"{sf}/labels.parquet").join(kept, "doc_id", "left")
    r = j.agg(F.avg(F.when(F.col("quality") == 1, F.coalesce("kept", F.lit(0)))).alias("clean"), F.avg(F.when(F.col("quality") == 0, F.coalesce("kept", F.lit(0)))).alias("junk")).first()
    assert r.clean > 0.98 and r.junk < 0.02


NAMES = [a + b + c for a in "bcdfglmnprst" for b in ("an", "el", "ir", "os", "ut") for c in "kstxyz"]
WORDS = " ".join(NAMES[:90])
LONG_TEXT = " ".join(NAMES[(i * i + 7 * i + i // 359) % 360] + NAMES[(i * 31) % 357] for i in range(60_000))
CASES = [
    (None, WORDS, None, None, None), (None, WORDS.upper(), "en", "s", 1), (1, " ".join(NAMES[100:190]), "en", "s", 5), (1, " ".join(NAMES[200:290]), "en", None, None),
    (2, None, "en", "s", 0), (3, "", None, "s", 0), (4, " \n\t", "de", "s", 3), (5, LONG_TEXT, "en", "t", 1), (6, "Short but clean.", "en", "t", 2), (6, "Short but clean.", "en", "t", 2),
]


def test_stages_on_odd_rows(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and clashing columns, stage by stage."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clash = {c: F.lit("clash") for c in ("row", "t", "digest", "root", "first", "key", "size", "hash", "copies", "copy", "id", "fp", "drops", "no_id", "kept", "failed_bits")}
    docs = spark.createDataFrame(CASES, schema).withColumns(clash)
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == list(corpus_pipeline.COLUMNS)
        kept[name] = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in out.collect())
        docs = spark.createDataFrame(out.collect(), schema).withColumns(clash)
    texts = [(r[0] is None, r[0] or 0, r[1] or "") for r in CASES]
    worded = sorted(t for t in texts if t[2].strip())
    assert kept["quality_rules"] == kept["line_dedup"] == worded  # texts without a word go, repeated rows stay
    alone = [t for t in worded if not t[0]]  # of the two texts without an id that differ in case only, one stays
    near = kept["simhash_near_dedup"]
    assert [t for t in near if not t[0]] == sorted(set(alone)) and len([t for t in near if t[0]]) == 1
    assert set(kept["source_mixing"]) <= set(near)
    pieces = corpus_pipeline.packing(spark, docs, "").collect()
    assert sorted(r.sequence_id for r in pieces) == list(range(len(pieces)))


def test_stages_on_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0 and docs.columns == list(corpus_pipeline.COLUMNS)
        docs = spark.createDataFrame([], docs.schema)
    assert corpus_pipeline.packing(spark, docs, sf).count() == 0


def test_queries_have_the_asked_columns(spark, sf):
    from tallyfold.llm.queries import QUERIES

    asked = {
        "op1": "doc_id fingerprint component_id", "op2": "doc_id size source_size target taken", "op3": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op5": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next", "op7": "doc_id n_lines n_dropped kept_sha256", "op8": "page_id url text n_chars", "op9": "doc_id n_words n_removed kept_sha256",
        "op10": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    }
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 11))
    for name, f in QUERIES.items():
        if want := asked.get(name.split("_")[0]):
            assert set(want.split()) <= set(f(spark, sf).columns), name
    r = QUERIES["op7_line_dedup"](spark, sf).first()
    assert len(r.kept_sha256) == len(hashlib.sha256().hexdigest())


def test_oracles(spark, sf):
    """The SQL of queries gives the same rows on the smallest tables."""
    import duckdb

    from tallyfold.llm.oracles import ORACLES
    from tallyfold.llm.queries import QUERIES

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in ORACLES.items():
        df, rel = QUERIES[name](spark, sf), con.sql(sql)
        order, other = sorted(df.columns), list(rel.columns)
        assert order == sorted(other)
        got = sorted(repr(tuple(r[c] for c in order)) for r in df.collect())
        assert got == sorted(repr(tuple(r[other.index(c)] for c in order)) for r in rel.fetchall()), name
