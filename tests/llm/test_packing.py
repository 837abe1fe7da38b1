from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from tallyfold.llm import pow2_packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", "a", "It's we'LL 's <|endoftext|> x<|startoftext|>y İstanbul ΣΑΣ ΟΔΟΣ", "ﬁ é ́x 12ab 3.5% <b>|| a b a\x1fb a\x0bb", "日本語 テスト 🎉🎉 éx", "word " * 3000, "Ünïcödé,%%% a.b ab--cd [x] {y} `z` ~q @me #h $5 a&b", "\x00 \x7f", "x" * 5000]


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_word_ids_equal_the_tokenizer(sf):
    tokenizer = Tokenizer.from_file(PATH)
    words = P.WordIds(PATH)
    for text in ODD + pq.read_table(f"{sf}/documents.parquet").column("text").to_pylist():
        got = words.encode((text or "").encode())
        assert got == ids_of(tokenizer, text)[:-1].tobytes()


def test_binary_pieces():
    for n in [*range(1, 5000, 7), 2048, 4096]:
        got = P.binary_pieces(n)
        assert sum(got) == n and got == sorted(got, reverse=True) and all(x & (x - 1) == 0 and x <= 2048 for x in got)


def test_pieces_partition_the_ids(spark):
    rows = list(enumerate(ODD)) + [(3, ODD[3]), (None, "null id")]
    got = P.pack_pow2(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and all(r.offset == 0 for r in got)
    assert all(r.length & (r.length - 1) == 0 and r.length <= 2048 for r in got)
    by_length = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert by_length == sorted(by_length, reverse=True)
    want = []
    for doc, text in rows:
        ids = ids_of(tokenizer, text)
        at = 0
        for n in P.binary_pieces(len(ids)):
            want.append((doc, at, n, crc32(ids[at : at + n].tobytes()), len(ids)))
            at += n
    assert sorted(((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got), key=repr) == sorted(want, key=repr)


def test_reruns_agree_and_empty(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    one = sorted(map(tuple, P.pack_pow2(df, PATH).collect()))
    assert one == sorted(map(tuple, P.pack_pow2(df.repartition(3), PATH).collect()))
    assert P.pack_pow2(df.limit(0), PATH).count() == 0


def test_other_tokenizers_read_whole_texts(spark, tmp_path):
    """Ids word by word only where the file says what that needs; any other file still gives its own ids."""
    import json

    assert P.is_wordwise(PATH)
    body = json.load(open(PATH))
    body["normalizer"]["normalizers"].pop()  # case counts now
    other = tmp_path / "other.json"
    other.write_text(json.dumps(body))
    for path in (str(other), public_tokenizers.path("byte_bpe_50k.json")):
        assert not P.is_wordwise(path)
        tokenizer = Tokenizer.from_file(path)
        rows = list(enumerate(ODD))
        got = {(r.doc_id, r.start): r for r in P.pack_pow2(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()}
        for doc, text in rows:
            ids = ids_of(tokenizer, text)
            assert got[doc, 0].doc_tokens == len(ids) and got[doc, 0].ids_crc32 == crc32(ids[: got[doc, 0].length].tobytes())


def test_hot_ids_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKETS", 16)
    rows = [(None, f"words of text {i}") for i in range(300)] + [(1, "same")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: P.F.lit(0) for c in ("length", "bucket", "start", "nth", "base")})
    got = P.pack_pow2(df, PATH).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got))) and {r.doc_id for r in got} == {None, 1}
