"""Substring dedup with FM-indexes.

A window is ``WINDOW`` consecutive words of a document.  A word is removed if a window over it has a
word sequence that also starts earlier: in a document with a smaller id, or earlier in the same one.

Plan:

1. Each window picks an anchor, the ``GRAM`` consecutive words in it with the smallest hash (leftmost
   among equals), so equal windows pick the same anchor at the same place.  About one word in seven
   starts an anchor.  Anchors are counted over all documents (hashes only, partial sums), and those
   found once are done: no window of theirs repeats.
2. The windows of an anchor's occurrence form one fragment of at most 32 words.  Equal fragments
   are merged to their first position before and after the shuffle, so copies of a passage shuffle
   little and are never paired.  An anchor found over ``HOT`` times gives single windows as
   fragments, keyed by the whole window, so that no key gathers the surroundings of a common phrase; such
   windows are therefore told apart by a 128-bit hash of the window and not by an index.
3. Fragments meet in shards by anchor.  A shard builds a compressed FM-index over its distinct fragments:
   the Burrows-Wheeler transform in a wavelet tree of packed bits with popcount ranks, and every ``SAMPLE``-th
   entry of the suffix array; the others are found by walking back.  The fragments are streamed through it:
   backward search gives the matching statistics of every word, the longest run of words ending there that the
   shard holds a second time, up to the threshold of ``WINDOW``; where the threshold is reached, the
   earliest place in the interval decides whether the window starts earlier too.
4. Windows that are the first of their kind go back to their document; all other windows of counted
   anchors are removed in a last pass over the text, which reports the removed intervals.

A shard is cut into indexes of about ``INDEX_WORDS`` words at key boundaries; a key holds at most
``HOT`` fragments, so an index has a bounded size whatever the corpus holds.  A row is known by a 64-bit hash of its id
and text, which keeps anchors small; rows whose hash another row has too (held against a second hash, one small row a
document) get another one first, so two documents are not mixed up however many there are.

Defined cases: null and empty texts have no words and an empty rest; null ids come before all others
and form one document; rows that share an id and a position do not count against each other (a
repeated row is not its own predecessor); an empty table gives an empty result; other columns,
whatever their names, are carried in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS_BYTES, cut, mix, texts_of

WINDOW, GRAM, HOT, INDEX_WORDS, SAMPLE = 20, 8, 20_000, 200_000, 8
BROADCAST_ROWS = 100_000
_NO_ID = -(1 << 63)


def _odd(i: int) -> int:
    return (0x9E3779B97F4A7C15 * (2 * i + 1)) & (1 << 64) - 1 | 1


_SPACE = np.zeros(256, bool)
_SPACE[list(WS_BYTES)] = True
_BYTE = np.where(_SPACE, np.uint64(0), mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_odd(1))))
#: Bytes of text that are read at once.
_CHUNK = 1 << 20


def word_table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word (a polynomial over its bytes; equal words, equal hashes)."""
    b = np.frombuffer(b"\n".join(texts), np.uint8)
    space = np.concatenate(([True], _SPACE[b], [True]))
    starts = np.flatnonzero(space[:-2] & ~space[1:-1])
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    b = b[starts[0] :]
    first = starts - starts[0]
    place = np.arange(len(b)) - np.repeat(first, np.diff(np.append(first, len(b))))
    power = np.multiply.accumulate(np.full(int(place.max()) + 1, _odd(2), np.uint64))
    hashes = mix(np.add.reduceat(_BYTE[b] * power[place], first))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.searchsorted(ends, starts, "right"), hashes


def gram_hashes(h: np.ndarray, gram: int = GRAM) -> np.ndarray:
    out = np.zeros(len(h) - gram + 1, np.uint64)
    for j in range(gram):
        out += h[j : j + len(out)] * np.uint64(_odd(j))
    return mix(out)


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest value (leftmost among equals) of every ``width`` values in a row, by doubling."""
    at, step = np.arange(len(x)), 1

    def join(v: np.ndarray, at: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        right = v[shift:] < v[:-shift]
        return np.where(right, v[shift:], v[:-shift]), np.where(right, at[shift:], at[:-shift])

    v = x
    while step * 2 <= width:
        v, at = join(v, at, step)
        step *= 2
    if step < width:
        v, at = join(v, at, width - step)
    return at


def anchor_table(texts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> list[np.ndarray]:
    """Of every anchor, text by text: text number, hash, first word, and the first and last window that pick it."""
    parts: list[list[np.ndarray]] = []
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= _CHUNK):
            size += len(texts[j]) + 1
            j += 1
        doc, h = word_table(texts[i:j])
        if len(doc) >= window:
            inside = np.flatnonzero(doc[: len(doc) - window + 1] == doc[window - 1 :])
            if len(inside):
                g = gram_hashes(h, gram)
                at = sliding_argmin(g, window - gram + 1)[inside]
                own = doc[inside]
                new = np.concatenate(([True], (at[1:] != at[:-1]) | (own[1:] != own[:-1])))
                a = np.flatnonzero(new)
                z = np.concatenate((a[1:], [len(inside)])) - 1
                zero = np.searchsorted(doc, own[a])  # first word of the text
                parts.append([own[a] + i, g[at[a]], at[a] - zero, inside[a] - zero, inside[z] - zero])
        i = j
    if not parts:
        e = np.empty(0, np.int64)
        return [e, e.view(np.uint64), e, e, e]
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def per_text(n: int, table: list[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """The anchors of each of ``n`` texts: hash, first word, first and last window."""
    cuts = np.searchsorted(table[0], np.arange(n + 1)).tolist()
    for a, z in zip(cuts, cuts[1:], strict=False):
        yield tuple(c[a:z] for c in table[1:])


# ---- compressed index ---------------------------------------------------------------------------


class BitVector:
    """Packed bits with a count before every 64-bit word."""

    def __init__(self, bits: np.ndarray):
        pad = np.zeros(-len(bits) % 64 + 64, bool)
        self.words = np.packbits(np.concatenate((bits, pad)), bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1].astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before position ``i``."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Ranks and symbols of a sequence, one bit vector per bit of a symbol (levels as one matrix)."""

    def __init__(self, symbols: np.ndarray, most: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        for b in range(max(1, int(most).bit_length()) - 1, -1, -1):
            bits = (symbols >> b & 1).astype(bool)
            self.levels.append((b, BitVector(bits), int(len(bits) - np.count_nonzero(bits))))
            symbols = np.concatenate((symbols[~bits], symbols[bits]))

    def ranks(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ``symbol`` before positions ``lo`` and ``hi``."""
        start = np.zeros_like(lo)
        for b, bits, zeros in self.levels:
            one = (symbol >> b & 1).astype(bool)
            s1, l1, h1 = bits.ones(start), bits.ones(lo), bits.ones(hi)
            start = np.where(one, zeros + s1, start - s1)
            lo = np.where(one, zeros + l1, lo - l1)
            hi = np.where(one, zeros + h1, hi - h1)
        return lo - start, hi - start

    def at(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at position ``i`` and how many of it stand before."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for b, bits, zeros in self.levels:
            one = bits.get(i)
            s1, i1 = bits.ones(start), bits.ones(i)
            symbol |= one.astype(i.dtype) << b
            start, i = np.where(one, zeros + s1, start - s1), np.where(one, zeros + i1, i - i1)
        return symbol, i - start


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; every suffix must differ from all others in a few steps."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
    step = 1
    while step < n and rank[order[-1]] < n - 1:
        after = np.zeros(n, np.int64)
        after[:-step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ranked[1:] != ranked[:-1])))
        step *= 2
    return order


class FmIndex:
    """An FM-index over fragments given as one array of symbols (from 1) and fragment lengths.

    The suffix array is only a step of its making: kept are the transform, and the array's entries for every
    ``sample``-th place and for the fragments' first symbols (a walk back never leaves its fragment).
    """

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, sample: int = SAMPLE):
        k, n = len(lengths), int(symbols.max(initial=0))
        ends = np.cumsum(lengths)
        text = np.insert(symbols + k - 1, ends, np.arange(k))  # a separator of its own ends each fragment
        sa = suffix_array(text)
        self.size = len(sa)
        bwt = text[sa - 1]
        bwt = np.where(bwt < k, 0, bwt - k + 1)
        self.tree = WaveletTree(bwt, n)
        counts = np.bincount(bwt, minlength=n + 2)
        counts[0] = k
        self.before = np.concatenate(([0], np.cumsum(counts)))
        kept = (bwt == 0) | (sa % sample == 0)
        self.marked, self.places = BitVector(kept), sa[kept].astype(np.int32)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: the intervals of ``symbol`` followed by what the intervals stand for."""
        a, b = self.tree.ranks(symbol, lo, hi)
        return self.before[symbol] + a, self.before[symbol] + b

    def locate(self, ranks: np.ndarray) -> np.ndarray:
        """Places in the text (with its separators) of the suffixes at ``ranks``."""
        out, todo, at, steps = np.empty(len(ranks), np.int64), np.arange(len(ranks)), ranks.astype(np.int64), 0
        while len(todo):
            here = self.marked.get(at)
            out[todo[here]] = self.places[self.marked.ones(at[here])] + steps
            todo, at = todo[~here], at[~here]
            symbol, nth = self.tree.at(at)
            at, steps = self.before[symbol] + nth, steps + 1
        return out

    def matching_statistics(self, symbols: np.ndarray, lengths: np.ndarray, threshold: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every word of streamed fragments with at least ``least`` words up to it: the longest run ending there,
        up to ``threshold``, that the index holds at least twice, and the interval of that run (0 for other words)."""
        inside = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)  # words before it in its fragment
        best = np.zeros(len(symbols), np.int64)
        lo, hi = np.zeros(len(symbols), np.int64), np.full(len(symbols), self.size, np.int64)
        alive = np.flatnonzero(inside >= least - 1)
        for n in range(threshold):
            if n >= least:
                alive = alive[inside[alive] >= n]
            a, b = self.extend(symbols[alive - n], lo[alive], hi[alive])
            twice = b - a > 1
            alive = alive[twice]
            lo[alive], hi[alive], best[alive] = a[twice], b[twice], n + 1
            if not len(alive):
                break
        return best, lo, hi


def repeated_windows(symbols: np.ndarray, lengths: np.ndarray, position: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each window start (fragment by fragment): does an equal window have a smaller position?

    ``position`` is given for every fragment: a number that orders the places of the corpus, one a word.
    """
    index = FmIndex(symbols, lengths)
    best, lo, hi = index.matching_statistics(symbols, lengths, window, window)
    first = np.cumsum(lengths) - lengths
    offset = np.arange(len(symbols)) - np.repeat(first, lengths)
    ends = np.flatnonzero(offset >= window - 1)  # one a window, in order
    out = np.zeros(len(ends), bool)
    hit = np.flatnonzero(best[ends] >= window)
    if len(hit):
        at = ends[hit]
        left, which = np.unique(lo[at], return_inverse=True)  # intervals of runs of one length are disjoint
        right = np.zeros(len(left), np.int64)
        right[which] = hi[at]
        size = right - left
        cuts = np.cumsum(size) - size
        text_at = index.locate(np.repeat(left - cuts, size) + np.arange(size.sum()))
        starts = first + np.arange(len(lengths))  # separators stand between
        of = np.searchsorted(starts, text_at, "right") - 1
        earliest = np.minimum.reduceat(position[of] + text_at - starts[of], cuts)
        own = np.searchsorted(first, at, "right") - 1
        out[hit] = earliest[which] < position[own] + offset[at] - (window - 1)
    return out


# ---- passes ---------------------------------------------------------------------------------------


def _anchor_rows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, h, p, _, _ = anchor_table(texts_of(batch, 1), window, gram)
            row = pa.array(doc)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(0).take(row), pa.array(p.astype(np.int32))], ["h", "rid", "p"])

    return run


_FRAGMENT = pa.schema([("key", pa.int64()), ("fh", pa.int64()), ("doc", pa.int64()), ("s0", pa.int32()), ("rid", pa.int64()), ("text", pa.binary())])


def _fragments(window: int, gram: int):
    """(row, doc, rid, text, spots) -> fragments of the counted anchors.

    Equal fragments of a task are merged to their first position (a bounded number at a time), and a text is sent
    once per task.
    """

    def send(merged: dict, texts: dict) -> pa.RecordBatch:
        rows = [(*kf, *first, texts.get(kf)) for kf, first in merged.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _FRAGMENT.types, strict=True)], schema=_FRAGMENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        sent: set[int] = set()
        merged: dict[tuple[int, int], tuple] = {}
        texts: dict[tuple[int, int], bytes] = {}
        for batch in batches:
            docs, rids, spots = batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(4).to_pylist()
            use = [i for i, s in enumerate(spots) if s]
            all_texts = texts_of(batch, 3)
            own = [all_texts[i] for i in use]
            for i, text, (h, p, first, last) in zip(use, own, per_text(len(own), anchor_table(own, window, gram)), strict=True):
                doc, rid, words = docs[i], rids[i], text.split()
                hot = {s >> 1: s & 1 for s in spots[i]}
                for key, at, a, b in zip(h.view(np.int64).tolist(), p.tolist(), first.tolist(), last.tolist(), strict=True):
                    if (kind := hot.get(at)) is None:
                        continue
                    for x, y in ((s, s) for s in range(a, b + 1)) if kind else ((a, b),):
                        piece = b" ".join(words[x : y + window])
                        fh = digest(piece) - (1 << 63)
                        kf = (digest(piece, 1) - (1 << 63) if kind else key, fh)
                        place = (doc, x, rid)
                        if (known := merged.get(kf)) is None:
                            merged[kf] = place
                            if (both := kf[0] ^ kf[1] << 1) not in sent:
                                if len(sent) > 300_000:
                                    sent.clear()
                                sent.add(both)
                                texts[kf] = piece
                        elif place < known:
                            merged[kf] = place
                if len(merged) >= 50_000:
                    yield send(merged, texts)
                    merged, texts = {}, {}
        if merged:
            yield send(merged, texts)

    return run


def _search(window: int):
    """Fragments sorted by key, hash and position -> of each distinct one the windows that are the first of their kind."""
    schema = pa.schema([("rid", pa.int64()), ("s0", pa.int32()), ("firsts", pa.int32())])

    def solve(docs: list, s0s: list, rids: list, texts: list, single: list[bool]) -> pa.RecordBatch:
        masks = [0] * len(docs)
        many = [i for i, alone in enumerate(single) if not alone]
        for i, alone in enumerate(single):
            if alone:
                masks[i] = (1 << len(texts[i].split()) - window + 1) - 1
        if many:
            known: dict[bytes, int] = {}
            own = [texts[i].split() for i in many]
            symbols = np.array([known.setdefault(w, len(known) + 1) for f in own for w in f], np.int64)
            lengths = np.fromiter(map(len, own), np.int64, len(own))
            _, dense = np.unique(np.array([docs[i] for i in many], np.int64), return_inverse=True)
            position = (dense.astype(np.int64) << 32) + np.array([s0s[i] for i in many], np.int64)
            twice = repeated_windows(symbols, lengths, position, window)
            n = lengths - window + 1
            bit = np.int64(1) << (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            for i, m in zip(many, np.add.reduceat(np.where(twice, 0, bit), np.cumsum(n) - n).tolist(), strict=True):
                masks[i] = m
        return pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(s0s, pa.int32()), pa.array(masks, pa.int32())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]  # key doc s0 rid text
        words, last = 0, None
        for batch in batches:
            for key, fh, doc, s0, rid, text in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (key, fh) == last:  # sorted by position: the first of equal fragments stands for all
                    if held[4][-1] is None and text is not None:
                        held[4][-1] = text
                        words += text.count(b" ") + 1
                    continue
                if words >= INDEX_WORDS and key != last[0]:
                    yield flush(held)
                    held, words = [[], [], [], [], []], 0
                last = (key, fh)
                for column, x in zip(held, (key, doc, s0, rid, text), strict=True):
                    column.append(x)
                words += text.count(b" ") + 1 if text is not None else 0
        if held[0]:
            yield flush(held)

    def flush(held: list[list]) -> pa.RecordBatch:
        keys, docs, s0s, rids, texts = held
        single = [(i == 0 or keys[i - 1] != k) and (i + 1 == len(keys) or keys[i + 1] != k) for i, k in enumerate(keys)]
        return solve(docs, s0s, rids, texts, single)

    return run


_SPANS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _remove(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, total, gone, spans = [], [], [], []
            texts, every = texts_of(batch, 3), batch.column(4).to_pylist()
            table = per_text(len(texts), anchor_table([t if s else b"" for t, s in zip(texts, every, strict=True)], window, gram))
            for text, spots, firsts, (_, p, first, last) in zip(texts, every, batch.column(5).to_pylist(), table, strict=True):
                words = text.split()
                n = len(words)
                removed, runs = 0, []
                if spots:
                    hit = np.isin(p, np.array([s >> 1 for s in spots], np.int64))
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, first[hit], 1)
                    np.add.at(change, last[hit] + 1, -1)
                    again = np.cumsum(change)[: n - window + 1] > 0
                    for f in firsts or ():
                        s0, m = f["s0"], f["firsts"]
                        while m:
                            low = m & -m
                            again[s0 + low.bit_length() - 1] = False
                            m ^= low
                    change = np.zeros(n + 1, np.int64)
                    at = np.flatnonzero(again)
                    change[at] += 1
                    change[at + window] -= 1
                    covered = np.cumsum(change)[:n] > 0
                    removed = int(covered.sum())
                    if removed:
                        edge = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))).tolist()
                        runs = [{"from": a, "to": z} for a, z in zip(edge[::2], edge[1::2], strict=True)]
                        words = [words[i] for i in np.flatnonzero(~covered).tolist()]
                out.append(b" ".join(words))
                total.append(n)
                gone.append(removed)
                spans.append(runs)
            columns = [batch.column(0), pa.array(out, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, _SPANS)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "text", "n_words", "n_removed", "removed"])

    return run


def known_rows(base: DataFrame) -> DataFrame:
    """``doc text ...`` with ``rid``: equal for rows of equal id and text, and for no others."""
    of = lambda seed: F.xxhash64(F.lit(seed), "doc", "text")
    plain = F.xxhash64("doc", "text")
    twice = cut(base.select(plain.alias("rid"), of(1).alias("other")).groupBy("rid").agg(F.min("other").alias("low"), F.max("other").alias("high")).where("low <> high").select("rid"))
    rows = base.withColumn("rid", plain)
    if twice.isEmpty():
        return rows
    few = twice.count() <= BROADCAST_ROWS
    mark = twice.withColumn("_twice", F.lit(True))
    return rows.join(F.broadcast(mark) if few else mark, "rid", "left").withColumn("rid", F.when(F.col("_twice"), of(2)).otherwise(F.col("rid"))).drop("_twice")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, carry: list[str] | None = None) -> DataFrame:
    """``row text n_words n_removed removed`` per input row; ``text`` holds the kept words joined by one space and
    ``removed`` the intervals of words, from the first on and before the last, that are gone."""
    if not 1 <= gram < window <= gram + 30:
        raise ValueError("a window must be longer than an anchor, by 30 words at most")
    carry = [c for c in docs.columns if c != text_col] if carry is None else carry
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID))
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), doc.alias("doc"), F.col(f"`{text_col}`").alias("text"))
    base = known_rows(base)
    spots = base.select("rid", "text").mapInArrow(_anchor_rows(window, gram), "h long, rid long, p int")
    # joined on ~h, so that the counts are shuffled apart from their aggregation and AQE can split a hot anchor
    found = spots.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.bitwise_not("h").alias("j"), "n")
    spot = (F.col("p") * 2 + F.when(F.col("n") > HOT, 1).otherwise(0)).cast("int").alias("spot")
    kept = spots.select(F.bitwise_not("h").alias("j"), "rid", "p").join(found, "j").select("rid", spot)
    by_row = kept.groupBy(F.col("rid").alias("of")).agg(F.collect_set("spot").alias("spots"))
    # the two readers of this join take the same columns, so the texts are shuffled once
    known = base.join(by_row, base["rid"] == by_row["of"], "left").select("row", "doc", "rid", "text", "spots")
    pieces = known.mapInArrow(_fragments(window, gram), "key long, fh long, doc long, s0 int, rid long, text binary")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pieces.repartition(n, "key").sortWithinPartitions("key", "fh", "doc", "s0", "rid")
    firsts = placed.mapInArrow(_search(window), "rid long, s0 int, firsts int").groupBy(F.col("rid").alias("of")).agg(F.collect_list(F.struct("s0", "firsts")).alias("firsts"))
    joined = known.join(firsts, known["rid"] == firsts["of"], "left").select("row", "doc", "rid", "text", "spots", "firsts")
    kind = base.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_remove(window, gram), f"row {kind}, text string, n_words long, n_removed long, removed array<struct<from:int,to:int>>")
