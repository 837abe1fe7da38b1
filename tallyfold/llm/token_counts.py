"""Numbers of tokens of whole texts, under several tokenizers at once.

A counter is made from a tokenizer's file.  Word-level files (white space dropped) are counted word by word from a
bounded dictionary; byte-level ones whose merges are numbered in order go to a faster library with the same
vocabulary; any other file's tokenizer reads whole texts.  All counts equal the tokenizer's own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import process_cache, texts_of
from .pow2_packing import TextIds, WordIds, byte_letters, is_wordwise

# Fixed value: the pre-tokenizer of byte-level BPE, as published.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space beyond ASCII's and the separators 1C to 1F, on which libraries may differ: such texts take the file's own
#: tokenizer, as do those that may hold a special token.
_ODD = re.compile("[" + "".join(map(chr, (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF))) + "]|<\\|")


class _Bytewise:
    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        to_byte = {c: b for b, c in byte_letters().items()}
        ranks = {bytes(to_byte[c] for c in token): n for token, n in vocab.items()}
        self.fast, self.whole = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), TextIds(path)

    def count(self, text: bytes) -> int:
        words = text.decode("utf-8", "replace")
        return len(self.whole.encode(text)) // 4 if _ODD.search(words) else len(self.fast.encode_ordinary(words))


def _is_bytewise(path: str) -> bool:
    """Byte-level BPE without normalisation or word ends, in which the number of a token is the rank of its merge."""
    with open(path, encoding="utf-8") as f:
        have = json.load(f)
    model = have["model"]
    plain = not have.get("normalizer") and not have.get("post_processor") and model["type"] == "BPE"
    split = have.get("pre_tokenizer") == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    marks = all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"]) for t in have["added_tokens"])
    if not (plain and split and marks) or any(model.get(k) for k in ("dropout", "end_of_word_suffix", "continuing_subword_prefix", "ignore_merges")):
        return False
    vocab, pairs = model["vocab"], (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    first = set(byte_letters().values())
    return {t for t, n in vocab.items() if n < 256} == first and all(vocab.get("".join(m)) == 256 + i for i, m in enumerate(pairs)) and len(vocab) == 256 + len(model["merges"])


class _Wordwise:
    def __init__(self, path: str):
        self.ids = WordIds(path)

    def count(self, text: bytes) -> int:
        return sum(len(self.ids[w]) for w in text.split()) // 4


class _Whole:
    def __init__(self, path: str):
        self.ids = TextIds(path)

    def count(self, text: bytes) -> int:
        return len(self.ids.encode(text)) // 4


def counter(path: str) -> Callable[[bytes], int]:
    """Text -> number of tokens, without special ones; once per worker process."""
    known = process_cache("counters")
    if path not in known:
        known[path] = (_Wordwise if is_wordwise(path) else _Bytewise if _is_bytewise(path) else _Whole)(path)
    return known[path].count


def _count(paths: list[str], n_texts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [counter(p) for p in paths]
        for batch in batches:
            columns = [[] for _ in range(len(paths) * n_texts)]
            for texts in zip(*(texts_of(batch, 1 + i) for i in range(n_texts)), strict=True):
                for k, c in enumerate(counters):
                    for i, text in enumerate(texts):
                        columns[k * n_texts + i].append(columns[k * n_texts][-1] if i and text == texts[0] else c(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, pa.int64()) for x in columns]], ["row", *[f"c{i}" for i in range(len(columns))]])

    return run


def count_tokens(docs: DataFrame, tokenizers: dict[str, str], texts: dict[str, "F.Column"], carry: list[str]) -> DataFrame:
    """``row tokenizer <alias>...``: per input row and tokenizer (name -> file) the tokens of each text (alias -> column).

    ``row`` holds the ``carry`` columns.  Each text is read once for all tokenizers; null counts as 0 tokens.
    """
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), *[t.alias(f"t{i}") for i, t in enumerate(texts.values())])
    n = len(texts)
    names = [f"c{i}" for i in range(len(tokenizers) * n)]
    kind = base.schema["row"].dataType.simpleString()
    wide = base.mapInArrow(_count(list(tokenizers.values()), n), f"row {kind}, " + ", ".join(f"{c} long" for c in names))
    each = [F.struct(F.lit(t).alias("tokenizer"), *[F.col(names[k * n + i]).alias(a) for i, a in enumerate(texts)]) for k, t in enumerate(tokenizers)]
    return wide.select("row", F.explode(F.array(*each)).alias("c")).select("row", "c.*")
