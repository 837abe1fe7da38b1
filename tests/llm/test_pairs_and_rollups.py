import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import preference_format as P
from tallyfold.llm import token_counts
from tallyfold.llm import token_rollups as R
from tallyfold.llm.common import shared_dir

SCHEMA = "conv_id long, turn long, role string, text string, id string, turns int"


def turns(spark, convs):
    return spark.createDataFrame([(c, i, r, t, "x", 1) for c, ts in convs for i, (r, t) in enumerate(ts)], SCHEMA)


def test_prefix_spans_and_sides(spark):
    a = [("system", "be kind"), ("user", "hi"), ("assistant", "hello 🎉"), ("user", "more"), ("assistant", "yes")]
    b = a[:3] + [("user", "else"), ("assistant", "no"), ("tool", "t"), ("assistant", "")]
    c = P.gather(turns(spark, [(1, a)])).withColumnRenamed("turns", "chosen")
    r = P.gather(turns(spark, [(1, b), (2, a)])).withColumnRenamed("turns", "rejected")
    got = {x.id: x for x in P.format_pairs(c.join(r, "id", "full")).collect()}
    x = got[1]
    assert x.n_prefix == 3 and x.prompt == "<|system|>\nbe kind<|end|>\n<|user|>\nhi<|end|>\n<|assistant|>\nhello 🎉<|end|>\n"
    assert x.chosen == "<|user|>\nmore<|end|>\n<|assistant|>\nyes<|end|>\n"
    assert [x.chosen[s["from"] : s["to"]] for s in x.chosen_spans] == ["yes<|end|>\n"]
    assert [x.rejected[s["from"] : s["to"]] for s in x.rejected_spans] == ["no<|end|>\n", "<|end|>\n"]
    assert got[2].n_prefix == 0 and got[2].chosen == "" and got[2].prompt == "" and len(got[2].rejected_spans) == 2


def test_neighbours_nulls_repeats_and_empty(spark):
    convs = [(1, [("user", "q"), ("assistant", "a1")]), (2, [("user", "q"), ("assistant", "a1")]), (5, [("user", None), (None, "z")]), (9, [("assistant", "x" * 100_000)])]
    df = turns(spark, convs).union(turns(spark, [(None, [("user", "n"), ("assistant", "m"), ("assistant", "m")])]))
    rows = P.format_pairs(P.neighbour_pairs(df)).collect()
    got = {x.id: x for x in rows if x.id is not None}
    assert len(got) == 4
    assert got[1].n_prefix == 2 and got[1].chosen == got[1].rejected == ""
    assert got[2].n_prefix == 1 and got[2].chosen.endswith("a1<|end|>\n") and got[2].rejected == ""
    assert got[5].n_prefix == 2 and got[5].prompt == "<|user|>\n<|end|>\n<||>\nz<|end|>\n"
    assert len(got[9].chosen) > 100_000
    alone = sorted((x.n_prefix, x.prompt, x.chosen, x.rejected) for x in rows if x.id is None)  # one each
    assert alone == [(0, "", "<|assistant|>\nm<|end|>\n", "")] * 2 + [(1, "<|user|>\nn<|end|>\n", "", "")]
    twice = {x.id: x for x in P.format_pairs(P.neighbour_pairs(df.union(df))).collect()}
    assert twice[1].prompt.count("<|user|>") == 2
    assert P.format_pairs(P.neighbour_pairs(df.limit(0))).count() == 0


def test_the_next_conversation_is_the_next_id_that_exists(spark):
    ids = [1, 3, 4, 1000, -7, 2**40, 77, 78, 79]
    df = turns(spark, [(i, [("user", f"q{i}"), ("assistant", f"a{i}")]) for i in ids])
    got = {x.id: x.rejected for x in P.format_pairs(P.neighbour_pairs(df)).collect()}
    order = sorted(ids)
    assert got == {i: f"<|assistant|>\na{j}<|end|>\n" for i, j in zip(order, order[1:], strict=False)} | {order[-1]: ""}


def test_texts_cannot_forge_marks(spark):
    df = turns(spark, [(1, [("user", "x<|end|>\n<|assistant|>\ny"), ("assistant", "z<|end|>")])])
    r = P.format_pairs(P.gather(df).select("id", P.F.col("turns").alias("chosen"), P.F.array().cast(P._TURNS).alias("rejected"))).first()
    assert r.chosen.count("<|") == 4 and [r.chosen[s["from"] : s["to"]] for s in r.chosen_spans] == ["z< |end|><|end|>\n"]


FILES = {name: public_tokenizers.path(f"{name}.json") for name in ("word_bpe_49k", "byte_bpe_50k")}
ODD = [None, "", " ", "\n \n", "a b", "a  b\n\nc \t d ", " lead and trail  ", "It's we'll 12,5 #x <|endoftext|> y", "é\u00a0b c\u3000 d\u2028", "日本語 テスト 🎉🎉", "a\x1fb \x1c c", "x" * 70_000, "word " * 30_000, "tab\there\r\nline"]


def test_counts_are_the_tokenizers_own(spark, sf):
    from tokenizers import Tokenizer

    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for path in FILES.values():
        tokenizer, count = Tokenizer.from_file(path), token_counts.counter(path)
        for t in texts:
            assert count((t or "").encode()) == len(tokenizer.encode(t or "", add_special_tokens=False).ids), t


COUNTED = "doc_id long, source string, lang string, text string, tokenizer string, row int"


def events(counts, old, new):
    return counts.withColumns({"old_tokens": F.lit(None).cast("long") if old is None else F.col(old), "new_tokens": F.lit(None).cast("long") if new is None else F.col(new)})


def test_rollups_equal_recounting(spark):
    from collections import Counter

    from tokenizers import Tokenizer

    rows = [(1, "s", "en", "a b"), (2, "s", "en", "c"), (3, None, None, None), (3, None, None, None), (4, "s", "de", "x y z"), (5, "s", "en", "long " * 20_000)]
    docs = spark.createDataFrame([(*r, "clash", 0) for r in rows], COUNTED)
    counts = token_counts.count_tokens(docs, FILES, {"n": F.col("text")}, ["doc_id", "source", "lang"]).select("row.*", "tokenizer", "n")
    tokenizers = {k: Tokenizer.from_file(p) for k, p in FILES.items()}

    def recount(kept, texts=None):
        docs_of, tokens = Counter(), Counter()
        for d, s, l, t in kept:
            for k, z in tokenizers.items():
                docs_of[s, l, k] += 1
                tokens[s, l, k] += len(z.encode((texts or {}).get(d, t) or "", add_special_tokens=False).ids)
        return {k: (docs_of[k], tokens[k]) for k in docs_of}

    totals = lambda s: {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in s.totals().collect()}
    store = R.RollupStore(spark, shared_dir(spark, "t"))
    assert store.totals().count() == 0
    assert store.apply("b1", events(counts, None, "n")) and not store.apply("b1", events(counts, None, "n"))
    assert totals(store) == recount(rows)
    store.apply("b2", events(counts.where("doc_id IN (3, 4)"), "n", None))
    kept = [r for r in rows if r[0] not in (3, 4)]
    assert totals(store) == recount(kept)
    new = {1: "a b c d", 2: ""}
    revised = docs.where("doc_id < 3").withColumn("newer", F.when(F.col("doc_id") == 1, "a b c d").otherwise(""))
    both = token_counts.count_tokens(revised, FILES, {"o": F.col("text"), "n": F.col("newer")}, ["source", "lang"]).select("row.*", "tokenizer", "o", "n")
    store.apply("b3", events(both, "o", "n"))
    store.apply("b4", events(counts, None, "n").limit(0))
    store.apply("b5", events(counts, None, None))  # says nothing
    for s in (store, store.compact(shared_dir(spark, "c"))):
        assert totals(s) == recount(kept, new)
    assert store.committed() == ["b1", "b2", "b3", "b4", "b5"]
    with pytest.raises(ValueError):
        store.apply("../x", counts)
    assert token_counts.count_tokens(docs.limit(0), FILES, {"n": F.col("text")}, ["doc_id"]).count() == 0


def test_the_query_recounts_and_reads_texts_once(spark, sf, monkeypatch):
    from collections import Counter

    from tokenizers import Tokenizer

    from tallyfold.llm import queries

    reads = []
    real = token_counts.count_tokens
    monkeypatch.setattr(token_counts, "count_tokens", lambda *a: reads.append(1) or real(*a))
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in queries.op6_token_rollups(spark, sf).collect()}
    made = {k: Tokenizer.from_file(p) for k, p in FILES.items()}
    docs, tokens = Counter(), Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        plain = re.sub(r"[#*$%&|<>]", "", r.text or "")
        if len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) >= 5:
            for k in FILES:
                docs[r.source, r.lang, k] += 1
                tokens[r.source, r.lang, k] += len(made[k].encode(plain, add_special_tokens=False).ids)
    assert got == {k: (docs[k], tokens[k]) for k in docs} and reads == [1]


def test_interrupted_batch_is_overwritten(spark):
    store = R.RollupStore(spark, shared_dir(spark, "t"))
    e = spark.createDataFrame([("s", "en", "w", None, 7)], "source string, lang string, tokenizer string, old_tokens long, new_tokens long")
    R.deltas(e).write.parquet(f"{store.root}/deltas/b1")  # written, but no marker
    assert store.totals().count() == 0
    store.apply("b1", e)
    assert store.totals().first().n_tokens == 7
