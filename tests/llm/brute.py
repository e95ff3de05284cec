"""Plain Python versions of the training-data operators, for small tables."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


class Groups:
    """Union of ids; the smallest names its group."""

    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.up[y] = x


def decontaminated(docs, items, window=13):
    """doc rows [(id, text)], item rows -> {id: (n_words, n_hit, item ids, contaminated, longest match)}."""
    items = [(str(i), words(t)) for i, t in items if i is not None and t is not None]
    wins = {}
    grams = set()
    for i, w in items:
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[a:a + n]), set()).add(i)
        for a in range(len(w)):
            for b in range(a + 1, len(w) + 1):
                grams.add(tuple(w[a:b]))
    out = []
    for i, t in docs:
        w = words(t)
        hit, found, longest = [False] * len(w), set(), 0
        for a in range(len(w)):
            n = max(longest + 1, window)
            while tuple(w[a:a + n]) in grams and a + n <= len(w):
                longest, n = n, n + 1
            for n in range(1, window + 1):
                k = tuple(w[a:a + n])
                if len(k) == n and k in wins:
                    found |= wins[k]
                    longest = max(longest, n)
                    hit[a:a + n] = [True] * n
        h = sum(hit)
        out.append((i, len(w), h, sorted(found), h > 0 and 20 * h >= len(w), longest))
    return out


def fingerprint(text, n=3):
    w = BLANK_WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    sh = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash_groups(rows, distance=3):
    f = {i: fingerprint(t) for i, t in rows}
    g = Groups(f)
    ids = list(f)
    a = np.array([f[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(a[k] ^ a) <= distance):
            g.join(i, ids[j])
    return {i: (f"{f[i]:016x}", g.find(i)) for i in ids}


def cosine_groups(rows, least=0.9):
    ok = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    g = Groups([i for i, _ in rows])
    n = Counter()
    for x, (i, v) in enumerate(ok):
        for j, w in ok[:x]:
            if len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= least:
                n[i] += 1
                n[j] += 1
                g.join(i, j)
    return {i: (n[i], g.find(i), g.find(i) == i) for i, _ in rows}


def repeats(rows, length=100):
    """{id: (bytes, removed, spans, sha256 of the rest)} of (id, text) rows in order of their ids."""
    seen, out = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(s)
        runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0
