"""Exact substring deduplication by blockwise suffix sorting with a difference cover (operator 6).

A byte goes if a ``length``-byte string that covers it also starts earlier in the corpus. Only the first
``length`` bytes of a suffix matter, so suffixes are compared on those.

1. *Suspects.* The offsets whose residue modulo v is in a difference cover are sampled. Whatever their distance, two
   equal strings of ``length`` bytes have a pair of sampled suffixes, at one shift under v, that agree on the
   ``length - v + 1`` bytes that are left. A suffix without a sampled suffix in reach whose hash is met again is the
   only one of its kind, and is done. (Hashes that meet by chance only make suspects.)
2. *Buckets.* The other suffixes are dealt to buckets, one sorted at a time. A bucket's key is the least gram
   (by hash) in the suffix's first ``length`` bytes, rather than its first bytes: neighbouring suffixes then
   share a bucket and travel as one piece of text. Suffixes of a gram that is so common that its bucket would
   stand out travel as strings of their own, dealt by their hashes.
3. *Sorting.* A bucket's suffixes are sorted by their bytes. Its own cover sample is ranked first; suffixes that
   tie on their first bytes are then told apart by the ranks of the sampled suffixes at their common shift, and by the few
   bytes after those. What still ties is equal byte by byte; the first by (id, offset) stays.

Hashes only choose suspects and buckets: no byte goes without a comparison of bytes.
Texts are read three times from a table of chunks, bucketed by chunk: replies meet it without moving a text.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import binary_list, kept_by_worker, materialize, sliced
from tessera.session import ensure_checkpoint_dir

#: Perfect difference sets, by modulus.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18),
          57: (0, 1, 3, 13, 32, 36, 43, 52)}
#: Bytes of text in a chunk (a longer text is a chunk of its own), and of suffix data in a bucket.
CHUNK = 4 << 20
BUCKET = 8 << 20
#: A gram is common if its suffixes are over a HOT-th of all; a chunk reports those with LOCAL suffixes or more, or with
#: fewer where so many chunks might add up to a bucket.
HOT = 2000
LOCAL = 256
_SLICE = 1 << 20
_NULL_ID = np.iinfo(np.int64).max


class Rolling:
    """64-bit hashes of any substrings: prefix sums of table values times powers of an odd base."""

    def __init__(self, seed: int, most: int = _SLICE + 4096):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        self.power, self.inverse = (self._powers(b, most) for b in (base, pow(base, -1, 1 << 64)))

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        k = 1
        while k < n:
            m = min(k, n - k)
            out[k:k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
            k += m
        return out

    def at(self, data: np.ndarray, pos: np.ndarray, size: int) -> np.ndarray:
        """Hashes of ``data[p:p + size]`` for the ascending positions ``pos``."""
        out = np.empty(len(pos), np.uint64)
        cuts = np.searchsorted(pos, np.arange(0, len(data) + _SLICE, _SLICE))
        for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
            if i == j:
                continue
            s = k * _SLICE
            part = data[s:s + _SLICE + size]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.table[part] * self.power[:len(part)], out=sums[1:])
            p = pos[i:j] - s
            out[i:j] = (sums[p + size] - sums[p]) * self.inverse[p]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
        return out


def _rolling(seed: int, size: int) -> Rolling:
    return kept_by_worker(f"rolling{seed}", size, lambda: Rolling(seed, _SLICE + size))


def _words(n: int) -> int:
    return -(-n // 8)


class Plan:
    """Sizes that follow from the length of the strings."""

    def __init__(self, length: int):
        fit = [v for v in COVERS if length - v + 1 >= 0.4 * length]
        if not fit:
            raise ValueError("strings of under 10 bytes")
        self.length, self.v = length, max(fit)
        self.gram = length - self.v + 1
        self.sampled = np.isin(np.arange(self.v), COVERS[self.v])
        # the cover of the sort: the one that compares the fewest words
        self.sort_v = min((v for v in COVERS if v < length), key=lambda v: (
            _words(v) + len(COVERS[v]) / v * _words(length - v + 1) + _words(v - 1)))


def _squeezed(sorted_keys: np.ndarray) -> bytes:
    """Ascending uint32 as differences, byte by byte: the high bytes are zeros, which Spark's codec shrinks."""
    return np.diff(sorted_keys.astype("<u4"), prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unsqueezed(data: bytes) -> np.ndarray:
    planes = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T)
    return np.cumsum(planes.view("<u4").ravel(), dtype=np.uint32)


def _chunks(chunk_bytes: int):
    """Rows (id, text) to chunks: texts in order of their ids, one after the other."""
    def run(batches):
        n = 0
        base = TaskContext.get().partitionId() << 32
        held: list = []
        size = 0

        def out():
            nonlocal n, held, size
            held.sort(key=lambda r: (r[0] is None, r[0]))
            n += 1
            row = pa.RecordBatch.from_arrays(
                [pa.array([base + n - 1], pa.int64()), pa.array([[r[0] for r in held]], pa.list_(pa.int64())),
                 pa.array([[len(r[1]) for r in held]], pa.list_(pa.int64())),
                 pa.array([b"".join(r[1] for r in held)], pa.binary())], names=["chunk", "ids", "sizes", "data"])
            held, size = [], 0
            return row

        for b in sliced(batches, 1 << 23, "t"):
            for i, t in zip(b.column("i").to_pylist(), binary_list(b.column("t"))):
                t = t or b""
                if held and size + len(t) > chunk_bytes:
                    yield out()
                held.append((i, t))
                size += len(t)
        if held:
            yield out()
    return run


class Chunk:
    """A chunk's bytes, with each byte's distance from its text's start and to its end."""

    def __init__(self, row: dict):
        self.id, self.ids = row["chunk"], row["ids"]
        self.sizes = np.array(row["sizes"], np.int64)
        self.data = np.frombuffer(row["data"], np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]

    def sample(self, plan: Plan, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions that a string of full length can reach, and their keys: bucket << 32 | 32 bits."""
        pos = []
        for s in range(plan.v):
            if plan.sampled[s]:
                n = np.where(self.sizes >= plan.length, (self.sizes - plan.gram - s) // plan.v + 1, 0).clip(0)
                pos.append(np.repeat(self.starts + s - (np.cumsum(n) - n) * plan.v, n) + np.arange(n.sum()) * plan.v)
        pos = np.sort(np.concatenate(pos))
        h = _rolling(1, plan.length).at(self.data, pos, plan.gram)
        return pos, (h >> np.uint64(32)) % np.uint64(parts) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)

    def suspects(self, plan: Plan, parts: int, replies: list) -> np.ndarray:
        """Positions of the suffixes that a repeated sampled suffix reaches."""
        pos, key = self.sample(plan, parts)
        known, at, n = np.unique(key, return_inverse=True, return_counts=True)
        again = n > 1
        edges = np.searchsorted(known, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
        for r in replies or ():
            i, j = edges[r["part"]], edges[r["part"] + 1]
            again[i:j] |= np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=j - i).astype(bool)
        hit = pos[again[at]]
        doc = np.searchsorted(self.starts, hit, "right") - 1
        step = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(step, np.maximum(hit - plan.v + 1, self.starts[doc]), 1)
        np.add.at(step, np.minimum(hit, self.starts[doc] + self.sizes[doc] - plan.length) + 1, -1)
        return np.flatnonzero(np.cumsum(step[:-1]) > 0)

    def least_grams(self, plan: Plan, at: np.ndarray) -> np.ndarray:
        """The least gram's hash of each suffix at the positions ``at``."""
        n = len(self.data) - plan.gram + 1
        out = np.empty(len(at), np.uint64)
        cuts = np.searchsorted(at, np.arange(0, n + _SLICE, _SLICE))
        roll = _rolling(1, plan.length)
        for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
            if i == j:
                continue
            s = k * _SLICE
            g = roll.at(self.data[s:], np.arange(min(_SLICE + plan.v, n - s)), plan.gram)
            w = 1
            while 2 * w <= plan.v:
                g = np.minimum(g[:-w], g[w:])
                w *= 2
            g = np.minimum(g[:len(g) - (plan.v - w)], g[plan.v - w:])
            out[i:j] = g[at[i:j] - s]
        return out


def _ask(plan: Plan, parts: int):
    """Each chunk's distinct sample keys, by bucket."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                keys = np.unique(Chunk(row).sample(plan, parts)[1])
                edges = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
                some = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array([row["chunk"]] * len(some), pa.int64()),
                     pa.array([_squeezed(keys[edges[p]:edges[p + 1]]) for p in some], pa.binary())],
                    names=["part", "chunk", "keys"])
    return run


def _rank(batches):
    """One bucket's keys: for each chunk the bits of those that another chunk has too."""
    rows = [r for b in batches for r in b.to_pylist()]
    if not rows:
        return
    keys = [_unsqueezed(r["keys"]) for r in rows]
    sizes = np.array([len(k) for k in keys], np.int64)
    _, at, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    again = np.split(n[at] > 1, np.cumsum(sizes)[:-1])
    some = [k for k, x in enumerate(again) if x.any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([rows[k]["chunk"] for k in some], pa.int64()), pa.array([rows[k]["part"] for k in some], pa.int32()),
         pa.array([np.packbits(again[k]).tobytes() for k in some], pa.binary())], names=["chunk", "part", "bits"])


def _count(plan: Plan, parts: int, least: int):
    """Grams with many suffixes in a chunk, and (gram NULL) all suffixes."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                c = Chunk(row)
                at = c.suspects(plan, parts, row["replies"])
                g, n = np.unique(c.least_grams(plan, at), return_counts=True)
                g, m = g[n >= least].view(np.int64), n[n >= least]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([*g.tolist(), None], pa.int64()), pa.array([*m.tolist(), len(at)], pa.int64())],
                    names=["gram", "n"])
    return run


def _distinct(c: Chunk, pos: np.ndarray, length: int):
    """Which of the strings of ``length`` bytes at ``pos`` differ, the places of the others, and all hashes.

    Strings are brought together by a hash and compared byte by byte; one that only shares the hash stands for itself.
    """
    h = _rolling(2, length).at(c.data, pos, length)
    order = np.lexsort((pos, h))
    same = np.concatenate([[False], h[order][1:] == h[order][:-1]])[:len(pos)]
    first, again = order[~same], order[same]
    of = first[(np.cumsum(~same) - 1)[same]]
    equal = np.ones(len(again), bool)
    text = Words(c.data)
    for skip in range(0, length, 8):
        size = min(8, length - skip)
        equal &= text.at(pos[again] + skip, size) == text.at(pos[of] + skip, size)
    return np.append(first, again[~equal]), pos[again[equal]], h


def _distinct_pieces(raw: bytes, pos: np.ndarray, size: np.ndarray):
    """Which of the pieces of ``size`` bytes at ``pos`` differ, and which others there are."""
    first: dict = {}
    other = [k for k, (p, n) in enumerate(zip(pos.tolist(), size.tolist())) if first.setdefault(raw[p:p + n], k) != k]
    return np.fromiter(first.values(), np.int64, len(first)), np.array(other, np.int64)


def _merged(start: np.ndarray, end: np.ndarray) -> bytes:
    """The stretches that the given ones cover together."""
    order = np.argsort(start, kind="stable")
    start, top = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > top[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return np.stack([start[new], top[last]], 1).astype("<u4").tobytes()


_SENT = ("part int, chunk long, sizes binary, data binary, ids binary, pos binary, cuts binary")


def _send(plan: Plan, parts: int, common: np.ndarray):
    """Each chunk's suspect suffixes by bucket, as pieces of text; those of common grams as a piece each.

    What occurs in the chunk before goes whatever the buckets say: its stretches go to a task of the chunk's own.
    """
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                c = Chunk(row)
                ids = np.array([_NULL_ID if x is None else x for x in c.ids], np.int64)
                at = c.suspects(plan, parts, row["replies"])
                gram = c.least_grams(plan, at)
                hot = np.isin(gram, common)
                doc = np.searchsorted(c.starts, at, "right") - 1
                cut = np.ones(len(at), bool)
                cut[1:] = (np.diff(at) != 1) | (np.diff(gram) != 0) | (np.diff(doc) != 0)
                first = np.flatnonzero(cut)
                size = np.diff(np.append(first, len(at))) + plan.length - 1
                plain = ~hot[first]
                pos, size, part = at[first[plain]], size[plain], gram[first[plain]] % np.uint64(parts)
                kept, other = _distinct_pieces(row["data"], pos, size)
                yield from _rows(c, ids, pos[kept], size[kept], part[kept])
                start, end = pos[other], pos[other] + size[other]
                pos = at[hot]
                kept, more, h = _distinct(c, pos, plan.length)
                yield from _rows(c, ids, pos[kept], np.full(len(kept), plan.length), h[kept] % np.uint64(parts))
                start, end = np.append(start, more), np.append(end, more + plan.length)
                if len(start):
                    yield _sent(((c.id >> 32) + c.id) % parts, c.id, b"", b"", b"", b"", _merged(start, end))
    return run


def _sent(part: int, chunk: int, *parts: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([chunk], pa.int64()), *(pa.array([x], pa.binary()) for x in parts)],
        names=["part", "chunk", "sizes", "data", "ids", "pos", "cuts"])


def _rows(c: Chunk, ids: np.ndarray, pos: np.ndarray, size: np.ndarray, part: np.ndarray):
    """A row for each bucket: the pieces at ``pos``."""
    if not len(pos):
        return
    raw = c.data.tobytes()
    order = np.argsort(part, kind="stable")
    pos, size, part = pos[order], size[order], part[order]
    edges = np.searchsorted(part, np.arange(int(part[-1]) + 2, dtype=np.uint64))
    doc = np.searchsorted(c.starts, pos, "right") - 1
    for p in np.flatnonzero(np.diff(edges)):
        s = slice(edges[p], edges[p + 1])
        data = b"".join(raw[x:x + n] for x, n in zip(pos[s].tolist(), size[s].tolist()))
        yield _sent(p, c.id, size[s].astype("<u4").tobytes(), data, ids[doc[s]].astype("<i8").tobytes(),
                    pos[s].astype("<u4").tobytes(), b"")


class Words:
    """The bytes at any places of a text as numbers that compare as the bytes do."""

    def __init__(self, data: np.ndarray):
        self.bytes = np.concatenate([data, np.zeros(8, np.uint8)])
        self.words = np.ndarray(len(data) + 1, ">u8", self.bytes, strides=(1,))

    def at(self, pos: np.ndarray, size: int = 8) -> np.ndarray:
        """The ``size`` bytes (8 at most) at each place."""
        return self.words[pos].astype(np.uint64) >> np.uint64(64 - 8 * size)


def _regroup(order: np.ndarray, cut: np.ndarray, at: np.ndarray, key: np.ndarray) -> None:
    """Sort the members ``at`` of whole groups by ``key`` within their group, and cut the groups where it changes."""
    group = np.cumsum(cut[at])
    mixed = np.zeros(len(at), bool)
    mixed[1:] = (group[1:] == group[:-1]) & (key[1:] != key[:-1])
    if not mixed.any():
        return
    some = np.zeros(group[-1] + 1, bool)
    some[group[mixed]] = True
    here = np.flatnonzero(some[group])
    by = here[np.lexsort((key[here], group[here]))]
    order[at[here]] = order[at[by]]
    key[here] = key[by]
    cut[at[1:][key[1:] != key[:-1]]] = True


def _tied(cut: np.ndarray) -> np.ndarray:
    """Places of the members of groups of two and more."""
    tied = ~cut
    tied[:-1] |= ~cut[1:]
    return np.flatnonzero(tied)


def _sort_words(text: Words, pos: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the places ``pos`` by their first ``size`` bytes, and where in it another string begins."""
    key = text.at(pos, min(8, size))
    order = np.argsort(key)
    key = key[order]
    cut = np.concatenate([[True], key[1:] != key[:-1]])[:len(pos)]
    for skip in range(8, size, 8):
        at = _tied(cut)
        if not len(at):
            break
        _regroup(order, cut, at, text.at(pos[order[at]] + skip, min(8, size - skip)))
    return order, cut


def sort_suffixes(data: np.ndarray, pos: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at the ascending places ``pos`` by their first ``length`` bytes, and its cuts.

    Each has ``length`` bytes from its place on. Suffixes that tie on v bytes are sorted by the ranks of the
    cover sample (a quicksort of all tied groups at once: whatever the pivot, both it and the other have a sampled
    suffix at one shift under v) and, if those tie as well, by the last v - 1 bytes.
    """
    v = plan.sort_v
    depth = plan.length - v + 1
    cover = np.array(COVERS[v])
    text = Words(data)
    order, cut = _sort_words(text, pos, v)
    live = _tied(cut)
    if not len(live):
        return order, cut
    # the sampled suffixes in reach of a suffix that ties, and their ranks
    step = np.zeros(len(data) + v + 1, np.int32)
    np.add.at(step, pos[order[live]], 1)
    np.add.at(step, pos[order[live]] + v, -1)
    where = np.flatnonzero(np.cumsum(step) > 0)
    slot = np.full(v, -1)
    slot[cover] = np.arange(len(cover))
    where = where[slot[where % v] >= 0]
    by, new = _sort_words(text, where, depth)
    rank = np.zeros((len(data) // v + 2) * len(cover), np.int32)
    rank[where[by] // v * len(cover) + slot[where[by] % v]] = np.cumsum(new)
    inside = np.isin(np.arange(v), cover)
    shift = np.array([[next(s for s in range(v) if inside[(a + s) % v] and inside[(b + s) % v]) for b in range(v)]
                      for a in range(v)])
    while len(live):
        starts = np.flatnonzero(cut[live])
        size = np.diff(np.append(starts, len(live)))
        mine = pos[order[live]]
        pivot = np.repeat(mine[starts + size // 2], size)
        s = shift[mine % v, pivot % v]
        one, two = mine + s, pivot + s
        side = np.sign(rank[one // v * len(cover) + slot[one % v]] - rank[two // v * len(cover) + slot[two % v]])
        for skip in range(depth, plan.length, 8):
            same = np.flatnonzero(side == 0)
            n = min(8, plan.length - skip)
            one, two = text.at(mine[same] + skip, n), text.at(pivot[same] + skip, n)
            side[same] = (one > two).astype(np.int32) - (one < two)
        _regroup(order, cut, live, side)
        # the pivot's equals are done; of the others groups of two and more go on
        more = live[side != 0]
        if not len(more):
            break
        alone = cut.copy()
        alone[:-1] &= cut[1:]
        live = more[~alone[more]]
    return order, cut


def _sort(plan: Plan):
    """Sort one bucket: the stretches of each chunk that suffixes with an earlier equal cover."""
    def run(batches):
        rows, out = [], []
        for b in batches:
            for r in b.to_pylist():
                if r["cuts"]:
                    out.append((r["chunk"], r["cuts"]))
                else:
                    rows.append(r)
        yield _cuts(out)
        if not rows:
            return
        size, pos = (np.concatenate([np.frombuffer(r[c], "<u4").astype(np.int64) for r in rows]) for c in ("sizes", "pos"))
        ids = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in rows])
        chunk = np.repeat([r["chunk"] for r in rows], [len(r["sizes"]) // 4 for r in rows])
        raw = b"".join(r["data"] for r in rows)
        rows.clear()
        starts = (np.cumsum(size) - size).tolist()
        # pieces in corpus order; of equal ones only the first is sorted, as all of the others goes
        pieces: dict = {}
        other = []
        for k in np.lexsort((pos, chunk, ids)).tolist():
            if pieces.setdefault(raw[starts[k]:starts[k] + int(size[k])], k) != k:
                other.append(k)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        other = np.array(other, np.int64)
        first = np.fromiter(pieces.values(), np.int64, len(pieces))
        pieces.clear()
        n = size[first] - plan.length + 1
        ends = np.cumsum(size[first])
        owner = np.repeat(np.arange(len(first)), n)
        at = np.repeat(ends - size[first], n) + _ramp(n)
        order, cut = sort_suffixes(data, at, plan)
        tied = _tied(cut)
        begin = np.flatnonzero(cut[tied])
        order = order[tied]
        keeps = np.minimum.reduceat(order, begin) if len(begin) else order
        again = order[order != np.repeat(keeps, np.diff(np.append(begin, len(order))))]
        place = pos[first][owner[again]] + at[again] - (ends - size[first])[owner[again]]
        to = np.concatenate([chunk[first][owner[again]], chunk[other]])
        start = np.concatenate([place, pos[other]])
        end = np.concatenate([place + plan.length, pos[other] + size[other]])
        by = np.argsort(to, kind="stable")
        edges = np.flatnonzero(np.diff(to[by], prepend=-1))
        yield _cuts([(int(to[k[0]]), _merged(start[k], end[k])) for k in np.split(by, edges[1:]) if len(k)])
    return run


def _cuts(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()),
                                       pa.array([x[1] for x in rows], pa.binary())], names=["chunk", "cuts"])


def _ramp(n: np.ndarray) -> np.ndarray:
    """0, 1, .. n[0] - 1, 0, 1, .. n[1] - 1, and so on."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


def _apply(batches):
    """Cut each chunk's texts; stretches of one text never reach into the next."""
    for b in batches:
        for row in b.to_pylist():
            c = Chunk(row)
            step = np.zeros(len(c.data) + 1, np.int32)
            for cuts in row["replies"] or ():
                x = np.frombuffer(cuts, "<u4").reshape(-1, 2).astype(np.int64)
                np.add.at(step, x[:, 0], 1)
                np.add.at(step, x[:, 1], -1)
            gone = np.cumsum(step[:-1]) > 0
            out = []
            for i, s, n in zip(c.ids, c.starts.tolist(), c.sizes.tolist()):
                g = gone[s:s + n]
                runs = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
                out.append((i, n, int(g.sum()), runs, c.data[s:s + n][~g].tobytes()))
            for s in range(0, len(out), 512):
                cols = list(zip(*out[s:s + 512]))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in cols[:4]), pa.array(cols[4], pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text: str = "text",
                   chunk_bytes: int = CHUNK, bucket_bytes: int = BUCKET, hot: int = HOT) -> DataFrame:
    """``(id_col, n_bytes, n_removed, n_spans, kept)`` per row; ``kept``: the remaining bytes of the text.

    A byte of a text (UTF-8; NULL: empty) is removed if a string of ``length`` bytes that covers it also starts
    earlier: in a text of a smaller id, or of the same text further left. Strings never cross texts and are judged
    on the input. Texts of under ``length`` bytes stay whole. Ids are integers; rows with a NULL id come after all
    others, and rows that share an id are ordered by where they are read. Empty in, empty out.
    """
    spark = docs.sparkSession
    plan = Plan(length)
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text).alias("t"))
    total = int(rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-total // bucket_bytes))
    local = max(1, min(LOCAL, bucket_bytes // (total // chunk_bytes + 1)))
    name = f"texts_{uuid.uuid4().hex}"
    (rows.mapInArrow(_chunks(chunk_bytes), "chunk long, ids array<long>, sizes array<long>, data binary")
     .write.bucketBy(parts, "chunk").option("path", f"{ensure_checkpoint_dir(spark)}/{name}")
     .option("compression", "zstd").saveAsTable(name))
    chunks = spark.table(name)

    def met(replies: DataFrame, what) -> DataFrame:
        gathered = replies.groupBy("chunk").agg(F.collect_list(what).alias("replies"))
        return chunks.join(gathered, "chunk", "left")

    asked = chunks.mapInArrow(_ask(plan, parts), "part int, chunk long, keys binary")
    # a task for each bucket: dealt by number, as buckets dealt by hash fall together
    ranks = materialize(asked.repartitionById(parts, F.col("part")).mapInArrow(_rank, "chunk long, part int, bits binary"))
    marked = met(ranks, F.struct("part", "bits"))
    counted = marked.mapInArrow(_count(plan, parts, local), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n")).limit(hot + 1).collect()  # the number of all suspects comes first
    most = next((r["n"] for r in top if r["gram"] is None), 0)
    common = np.array([r["gram"] for r in top if r["gram"] is not None and r["n"] * hot > most], np.int64).view(np.uint64)
    sent = marked.mapInArrow(_send(plan, parts, common), _SENT)
    cuts = materialize(sent.repartitionById(parts, F.col("part")).mapInArrow(_sort(plan), "chunk long, cuts binary"))
    out = met(cuts, F.col("cuts")).mapInArrow(
        _apply, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
