"""Plain versions of operators, written apart from them, to hold their results against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WS = " \t\n\x0b\x0c\r"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def measures(text):
    text = text or ""
    w = words(text)
    n = len(w)
    grams = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    covered = {j for i in range(n - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if words(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    plain = sum(not x.isascii() or x.strip(".,;:!?()\"'-").isalpha() for x in w)
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup, "n_repeat_words": len(covered), "n_lines": lines, "n_plain_words": plain, "top_word": max(Counter(w).values(), default=0), "n_runs": sum(a == b for a, b in zip(w, w[1:], strict=False)), "n_pipes": sum(x == "|" for x in w)}


def failed(m):
    n = m["n_words"]
    return [
        n < 50, m["n_repeat_words"] * 100 > 50 * n, m["n_symbols"] * 100 > 5 * m["word_chars"], m["n_dup_lines"] * 100 > 40 * m["n_lines"], m["word_chars"] < 2 * n or m["word_chars"] > 15 * n,
        m["n_plain_words"] * 100 < 60 * n, m["top_word"] > 3 and m["top_word"] * 100 > 30 * n, m["n_runs"] * 100 > 20 * n, m["n_pipes"] * 100 > 10 * n,
    ]


def line_dedup(rows):
    """(doc, text) -> (doc, kept text, n_lines, n_dropped); rows of one id are one document"""
    low = lambda d: -(10**30) if d is None else d
    holders = defaultdict(set)
    key = lambda x: x.strip(WS).translate(UP)
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                holders[k].add(low(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= 5 and low(d) != max(holders[key(x)]))]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def mix(rows, weights=(3, 1, 2), ratio=1.5, most=2.0, seed="mix-1"):
    """(doc, source, text) -> (doc, source, size, source_size, target, copies)"""
    size = defaultdict(int)
    for _, s, t in rows:
        size[s] += len(words(t))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), ratio * sum(size.values())
    while free:
        share = {s: weight[s] * rest / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= most * size[s]]
        if not over:
            target |= share
            break
        for s in over:  # clamp all of them and share again
            target[s] = most * size[s]
            free.discard(s)
            rest -= target[s]
    units = defaultdict(lambda: defaultdict(int))
    hash_of = lambda d: hashlib.md5(f"{seed}:{'null' if d is None else d}".encode()).hexdigest()
    for d, s, t in rows:
        units[s][hash_of(d)] += len(words(t))
    extra = defaultdict(set)
    for s, docs in units.items():
        whole = int(target[s] // size[s]) if size[s] else 0
        quota, before = target[s] - whole * size[s], 0
        for h in sorted(docs):
            if quota > 0 and before + docs[h] / 2 <= quota:
                extra[s].add(h)
            before += docs[h]
    return [(d, s, len(words(t)), size[s], target[s], (int(target[s] // size[s]) if size[s] else 0) + (hash_of(d) in extra[s])) for d, s, t in rows]


def pieces(n, most=2048):
    out = [most] * (n // most)
    return out + [2**b for b in reversed(range(12)) if (n % most) >> b & 1]


def crc(ids):
    from zlib import crc32

    return crc32(np.array(ids, "<u4").tobytes())
