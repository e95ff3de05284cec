"""Benchmark decontamination with a generalised suffix automaton of test items (operator 1)."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import binary_list, kept_by_worker, materialize, passed_columns, schema_of, sliced, with_columns

#: A-Z lowered; every byte outside [0-9a-z\x80-\xff] is a separator.
FOLD = bytes(c if c >= 0x80 or chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" else
             c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


@dataclass
class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items of each window.

    ``next``, ``link``, ``length``: the usual transitions, suffix links and longest lengths. ``windows``: for
    the state of a ``window``-word substring, the items that have it. ``whole``: items of fewer words, by the
    state that ends them, as (words, item); ``short``: the nearest state with such an entry on the way to the root.
    """

    window: int
    vocab: dict[bytes, int]
    next: list[dict[int, int]]
    link: list[int]
    length: list[int]
    windows: dict[int, set[int]]
    whole: dict[int, list[tuple[int, int]]]
    short: list[int]
    least: int


def build(items: list[list[bytes]], window: int) -> SuffixAutomaton:
    nxt, link, length = [{}], [-1], [0]
    vocab: dict[bytes, int] = {}

    def copy_of(p: int, c: int, q: int) -> int:
        """Split off from q the state of the strings that p reaches by c."""
        k = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = k
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = k
            p = link[p]
        return k

    def extend(last: int, c: int) -> int:
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else copy_of(last, c, q)
        cur, p = len(nxt), last
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else copy_of(p, c, q)
        return cur

    coded = [[vocab.setdefault(w, len(vocab)) for w in words] for words in items]
    for ids in coded:
        last = 0
        for c in ids:
            last = extend(last, c)
    windows: dict[int, set[int]] = {}
    whole: dict[int, list[tuple[int, int]]] = {}
    least = window
    for k, ids in enumerate(coded):
        v = 0
        for i, c in enumerate(ids):
            v = nxt[v][c]
            if i + 1 >= window:
                while length[link[v]] >= window:
                    v = link[v]
                windows.setdefault(v, set()).add(k)
        if 0 < len(ids) < window:
            whole.setdefault(v, []).append((len(ids), k))
            least = min(least, len(ids))
    short = [0] * len(nxt)
    for v in sorted(range(1, len(nxt)), key=length.__getitem__):
        short[v] = v if v in whole else short[link[v]]
    return SuffixAutomaton(window, vocab, nxt, link, length, windows, whole, short, least)


def match(sam: SuffixAutomaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
    """Hit spans of a document (merged, [start, end) in words), the items that hit, the longest match of a
    window or more, or whole short item, in words.

    The text streams through the automaton, which tracks the longest match that ends at each word. Words that
    no item has reset it, so runs of item words shorter than the shortest window are passed over.
    """
    get = sam.vocab.get
    ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]]).astype(np.int8)))
    spans: list[tuple[int, int]] = []
    hit: set[int] = set()
    longest = 0
    nxt, link, length, window = sam.next, sam.link, sam.length, sam.window

    def mark(a: int, b: int) -> None:
        while spans and spans[-1][1] >= a:
            a, b = min(a, spans[-1][0]), max(b, spans[-1][1])
            spans.pop()
        spans.append((a, b))

    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if b - a < sam.least:
            continue
        v = n = 0
        for i, c in enumerate(ids[a:b].tolist(), a + 1):
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            if n >= window:
                u = v
                while length[link[u]] >= window:
                    u = link[u]
                hit |= sam.windows[u]
                mark(i - window, i)
                longest = max(longest, n)
            u = sam.short[v]
            while u:
                for m, k in sam.whole[u]:
                    if m <= n:
                        hit.add(k)
                        mark(i - m, i)
                        longest = max(longest, m)
                u = sam.short[link[u]]
    return spans, hit, longest


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the bytes from the first to the last word of each span."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(FOLD))]
    out, end = [], 0
    for a, b in spans:
        out.append(text[end:at[a][0]])
        end = at[b - 1][1]
    return b"".join([*out, text[end:]])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = 13, coverage: tuple[int, int] = (1, 20),
                  max_span: int | None = None, shard_bytes: int = 2_000_000, clean_text: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``item_ids`` (sorted strings), ``contaminated``, ``longest_match``,
    ``hit_spans`` ([a, b) in words) and, on demand, ``clean_text``.

    A window is ``window`` consecutive words of an item, or a whole item of fewer words; a document's word in
    an occurrence of a window is hit. A document is contaminated if it has hits, and on at least the fraction
    ``coverage`` of its words. ``clean_text`` is the text without the spans over the limits: all hit spans of a
    contaminated document, else those of more than ``max_span`` words (None: all hit spans).

    NULL and empty texts have no words. Items with a NULL id or without words match nothing; items of one id
    count once. Repeated rows are judged alike; input columns named like the results are replaced. Items come to
    the driver in shards of about ``shard_bytes`` (one item at least), so each automaton is bounded; with more
    than one shard the documents stream past one after another, and are written in between. Texts of any length are read
    whole, in the task that reads their row. An empty table of documents gives an empty one, one of items no hits.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")).where(
        F.col("i").isNotNull() & F.col("t").isNotNull())
    total = named.agg(F.sum(F.octet_length("t") + F.octet_length("i"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    state = f"__spans {_SPANS}, __items array<string>, __longest int"
    results = (f"n_words long, n_hit long, item_ids array<string>, contaminated boolean, longest_match int, "
               f"hit_spans {_SPANS}" + ", clean_text string" * clean_text)
    held, final = _arrow(state), _arrow(results)
    keep = passed_columns(docs, list(final))
    if text not in keep:
        raise ValueError(f"the text column has the name of a result: {text}")
    df = docs.select(*keep)
    limit = 0 if max_span is None else max_span
    for s in range(shards):
        part = named.where(F.pmod(F.xxhash64("i"), F.lit(shards)) == s).orderBy("i", "t").toArrow()
        items_of = (part.column("i").to_pylist(), [t.encode() for t in part.column("t").to_pylist()])
        key = (window, hashlib.sha256(repr(items_of).encode()).hexdigest())
        shared = spark.sparkContext.broadcast(items_of)  # about shard_bytes
        first, last = s == 0, s == shards - 1

        def run(batches, shared=shared, key=key, first=first, last=last):
            ids, texts = shared.value
            sam = kept_by_worker("automaton", key, lambda: build([words_of(t) for t in texts], window))
            kinds = final if last else held
            for b in sliced(batches, 1 << 25, text):
                had = [None] * b.num_rows if first else list(zip(*(b.column(k).to_pylist() for k in held)))
                rows = []
                for t, old in zip(binary_list(b.column(text)), had):
                    words = words_of(t)
                    spans, hit, longest = match(sam, words)
                    names = {ids[k] for k in hit}
                    if old:
                        spans = [(x["a"], x["b"]) for x in old[0]] + spans
                        names |= set(old[1])
                        longest = max(longest, old[2])
                    spans = _merged(spans)
                    found = [{"a": x, "b": y} for x, y in spans]
                    row = (found, sorted(names), longest)
                    if last:
                        n, n_hit = len(words), sum(y - x for x, y in spans)
                        bad = n_hit > 0 and coverage[1] * n_hit >= coverage[0] * n
                        row = (n, n_hit, row[1], bad, longest, found)
                        if clean_text:
                            cut = [x for x in spans if bad or x[1] - x[0] > limit]
                            row += (t if t is None else cut_spans(t, cut).decode("utf-8", "replace"),)
                    rows.append(row)
                new = {k: pa.array([r[i] for r in rows], kind) for i, (k, kind) in enumerate(kinds.items())}
                yield with_columns(b, keep, new)

        df = df.mapInArrow(run, schema_of(docs, keep, results if last else state))
        if not last:
            df = materialize(df)
    return df


_SPANS = "array<struct<a:int,b:int>>"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _arrow(ddl: str) -> dict[str, pa.DataType]:
    return {f.name: f.type for f in to_arrow_schema(T.StructType.fromDDL(ddl))}
