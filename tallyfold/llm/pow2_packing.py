"""Packing by power-of-two decomposition.

A document's token count is written in binary: as many pieces of ``max_len`` (itself a power of two)
as fit, then one piece for each set bit of the rest, longest first.  Each piece is a sequence of its
own, so no sequence crosses documents, every sequence length is a power of two, nothing is padded,
and equal lengths are bucketed together: sequence ids run through the lengths from the longest to
the shortest, so a trainer reads uniform batches.

Sequence numbers are a distributed prefix sum: pieces are dealt to hash buckets of all their columns, so neither an
id with many rows nor the missing id is one bucket; pieces are counted per (length, bucket), at most 12 x
``BUCKETS`` counts for ``max_len`` 2048 whatever the data size, whose running sum is broadcast (that bound is the
proof); the rest is a row number inside each bucket.  ``BUCKETS`` grows with the session's shuffle partitions.

Ids are made word by word only if the tokenizer's file has the parts that this relies on; any other file's tokenizer
reads whole texts.

Defined cases: a null or empty text is the end token alone; a null id packs like any other; repeated rows are
packed once each (their order among equals does not matter, they are equal); an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import process_cache, texts_of

MAX_LEN, END_ID, BUCKETS = 2048, 1, 1024
#: Words, and parts of words, kept in a worker's dictionaries before they start anew: about 20 MB each.
CACHE_WORDS = 120_000
#: Latin letters (whole characters, so already in NFC), then punctuation without ' and <, which the
#: pre-tokenizer or the special tokens treat in their own way.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-į]+)([!-&(-/:;=>?@\[-`{-~]*)")


def byte_letters() -> dict[int, str]:
    """Byte -> the character that stands for it in byte-level BPE: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: What a tokenizer's file must say for ids to be made word by word: white space is dropped, words end in a mark of
#: their own, and the pre-tokenizer splits letters, single digits and runs of other characters.
_WORDWISE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False},
}


def is_wordwise(path: str) -> bool:
    """Whether a tokenizer's file has the parts that :class:`WordIds` relies on."""
    with open(path, encoding="utf-8") as f:
        have = json.load(f)
    if any(have.get(k) != _WORDWISE[k] for k in ("normalizer", "pre_tokenizer")) or have.get("post_processor"):
        return False
    plain = all(re.fullmatch(r"<\|\w+\|>", t["content"]) and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in have["added_tokens"])
    return plain and all(have["model"].get(k) == v for k, v in _WORDWISE["model"].items())


class TextIds:
    """Token ids of whole texts, for tokenizers of any make."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, text: bytes) -> bytes:
        return _ids(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)


class WordIds(dict):
    """Token ids of white-space separated words as little-endian unsigned 32-bit bytes.

    Byte-level BPE with word ends never merges across white space, so the ids of a text are those of
    its words in a row.  A word made of Latin letters and closing punctuation is taken apart the way
    the pre-tokenizer does it (letters, then the run of punctuation), which lets "Word", "word," and
    "word." share one BPE run; all others take the whole tokenizer.  The runs themselves are made by a faster library
    with the same merges: a word end is a byte of its own there, which the first merges join to the last byte.
    Only for files of which :func:`is_wordwise` holds.
    """

    def __init__(self, path: str):
        import tiktoken

        self.tokenizer, self.parts = TextIds(path).tokenizer, {}
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], byte_letters()
        to_byte = {c: b for b, c in letters.items()}
        spelt = lambda t: bytes(to_byte[c] for c in t.removesuffix("</w>")) + (b"\x00" if t.endswith("</w>") else b"")
        tokens = [*letters.values(), *(c + "</w>" for c in letters.values()), *("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])]
        ranks = {spelt(t): n for n, t in enumerate(tokens)}
        self.runs = tiktoken.Encoding("runs", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        self.number = [vocab[t] for t in tokens]

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))

    def part(self, piece: str) -> bytes:
        if (got := self.parts.get(piece)) is None:
            if len(self.parts) > CACHE_WORDS:
                self.parts.clear()
            number = self.number
            got = self.parts[piece] = _ids([number[r] for r in self.runs.encode_ordinary(piece + "\0")])
        return got

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHE_WORDS:
            self.clear()
        text = word.decode("utf-8", "replace")
        m = _SIMPLE.fullmatch(text)
        if m:
            ids = self.part(m[1].lower())
            if m[2]:
                ids += self.part(m[2])
        else:
            ids = _ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(word) <= 64:
            self[word] = ids
        return ids


def _ids(ids: Iterable[int]) -> bytes:
    return array("I", ids).tobytes()


def encoder(path: str) -> WordIds | TextIds:
    """The tokenizer of a file, once per worker process: word by word if the file allows it, else by whole texts."""
    known = process_cache("encoders")
    if path not in known:
        known[path] = WordIds(path) if is_wordwise(path) else TextIds(path)
    return known[path]


def binary_pieces(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Lengths of the pieces of ``n`` tokens, longest first."""
    whole, rest = divmod(n, max_len)
    return [max_len] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(path: str, max_len: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            at, starts, lengths, crcs, totals = [], [], [], [], []
            for i, text in enumerate(texts_of(batch, 1)):
                data = memoryview(encode(text) + end)
                start, n = 0, len(data) // 4
                for length in binary_pieces(n, max_len):
                    at.append(i)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(crc32(data[4 * start : 4 * (start + length)]))
                    totals.append(n)
                    start += length
            ids = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def pack_pow2(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id start length ids_crc32 doc_tokens sequence_id offset``."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(_pieces(tokenizer_path, max_len, end_id), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")
    return number_sequences(pieces)


def number_sequences(pieces: DataFrame) -> DataFrame:
    from .common import cut

    buckets = max(BUCKETS, 4 * int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = ("doc_id", "start", "ids_crc32", "doc_tokens")
    pieces = cut(pieces.withColumn("bucket", F.pmod(F.xxhash64(*own), F.lit(buckets)).cast("int")))
    counts = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("length").desc(), "bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy(*own)
    return (
        pieces.withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(bases), ["length", "bucket"])
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth") - 1).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )
