"""Secret scans by pattern and by sliding-window entropy, in DataFrame functions only (operator 5)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import passed_columns

#: Kind, pattern, capture group that is measured, characters it needs. In order of precedence.
#: A run that is long enough is the leftmost match of a pattern that asks for the length itself.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Candidate strings of the entropy scan: whole runs, however long.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
WINDOW = 20
#: Matches whose places are added up one after the other; a text's blocks are added up in the same way.
BLOCK = 256
#: The stretches of a run that are measured, so that the work grows with its length: a stretch has 96 characters
#: and the next one starts 77 = 96 - (WINDOW - 1) later, so each window of the run lies in one of them.
STRETCH = r"(?=(.{20,96})).{1,77}+"
#: Character classes of a candidate, most special first: name, whole pattern, bits a window must reach.
CLASSES = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("alnum", r"^[A-Za-z0-9]+$", 3.6),
    ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.8),
)
#: What is no secret however it scores: words of letters in one case, numbers, UUIDs, paths and joined words.
ALLOW = (
    r"^[A-Z]?[a-z]+$", r"^[A-Z]+$", r"^[0-9]+$",
    r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"^/?(?:[A-Za-z]{1,15}[-_/=+]+)*+[A-Za-z]{0,15}/?$",  # possessive: no recursion over a long run
)
ENTROPY = "entropy"
KINDS = (*(k for k, *_ in BASE), ENTROPY)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is made once: within a lambda an expression would be made anew for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _appended(xs: Column, of) -> Column:
    """Running totals of ``of`` each element; every step copies the ones before, so ``xs`` should be short."""
    return F.aggregate(xs, F.array().cast("array<int>"),
                       lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + of(x))))


def _totals(xs: Column) -> Column:
    """Running totals of an array of ints: within blocks of ``BLOCK``, and of the blocks' totals."""
    starts = F.when(F.size(xs) > 0, F.sequence(F.lit(1), F.size(xs), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    inner = F.transform(starts, lambda s: _appended(F.slice(xs, s, F.lit(BLOCK)), lambda x: x))

    def joined(blocks: Column) -> Column:
        ends = _appended(blocks, lambda b: F.element_at(b, -1))
        return F.flatten(F.zip_with(blocks, ends, lambda b, e: _bound(e - F.element_at(b, -1), lambda before: F.transform(b, lambda x: x + before))))
    return _bound(inner, joined)


def _places(text: Column, pattern: str) -> Column:
    """Array of (start, match) of the leftmost non-overlapping matches, in code points.

    The text is cut at the matches; a match ends after all the pieces and matches up to it.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    both = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("match")))

    def placed(pieces: Column) -> Column:
        ends = _bound(F.transform(pieces, lambda p: p["gap"] + F.length(p["match"])), _totals)
        return F.zip_with(ends, pieces, lambda e, p: F.struct((e - F.length(p["match"])).alias("start"), p["match"].alias("match")))
    return _bound(both, placed)


def _part(n: Column) -> Column:
    """n log2 n, a count's share of a window's sum (0 for none)."""
    return F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))


def window_entropy(s: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy (bits a character) of ``window`` consecutive characters of ``s``.

    The window slides by one character: of the sum of n log2 n over its characters' counts only the terms of
    the character that comes and the one that goes change. A shorter string is one window.
    """
    def count(win: Column, c: Column) -> Column:
        return F.length(win) - F.length(F.replace(win, c, F.lit("")))

    def step(acc: Column, i: Column) -> Column:
        new = F.substring(s, i, F.lit(1))
        win = F.substring(s, F.greatest(i - window, F.lit(1)), F.least(i - 1, F.lit(window)))
        n = count(win, new)
        grown = acc["sum"] + _part(n + 1) - _part(n)
        old = F.substring(s, i - window, F.lit(1))
        # what goes is counted in the window that already has the new character
        m = count(win, old) + F.when(old == new, 1).otherwise(0)
        total = F.when(i > window, grown + _part(m - 1) - _part(m)).otherwise(grown)
        full = F.least(i, F.lit(window))
        bits = F.log2(full.cast("double")) - total / full
        whole = F.least(F.length(s), F.lit(window))
        return F.struct(total.alias("sum"), F.when(i >= whole, F.greatest(acc["best"], bits)).otherwise(acc["best"]).alias("best"))

    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")),
                       step, lambda acc: acc["best"])


def _suspicious(s: Column) -> Column:
    """A candidate of a class whose entropy limit a window reaches, and which the allow-list doesn't name."""
    limit = F.lit(math.inf)
    for _, pattern, bits in reversed(CLASSES):
        limit = F.when(s.rlike(pattern), F.lit(bits)).otherwise(limit)
    allowed = F.lit(False)
    for p in ALLOW:
        allowed = allowed | s.rlike(p)
    stretches = F.regexp_extract_all(s, F.lit(STRETCH), F.lit(1))
    return F.when(allowed, F.lit(False)).otherwise(F.exists(stretches, lambda x: window_entropy(x) >= limit))


def _spans(places: Column, kind: str, ok) -> Column:
    order = KINDS.index(kind)
    return F.transform(F.filter(places, ok), lambda p: F.struct(
        p["start"].alias("start"), F.lit(order).alias("rank"), (p["start"] + F.length(p["match"])).alias("end"),
        F.lit(kind).alias("kind")))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, rank, end, kind), in code points, by start and rank.

    ``base`` has the leftmost non-overlapping matches of each base kind whose measured group is long enough;
    ``spans`` has those and the candidate strings that the entropy scan finds. NULL and empty texts have none.
    Everything happens in the row, so repeated rows give equal results and nothing is shuffled; input columns named
    like the results are replaced, and one named ``__entropy`` is dropped. Texts of any length are scanned whole; up to
    some hundred thousand matches the work grows with them. Empty in, empty out.
    """
    keep = passed_columns(docs, ["base", "spans", "__entropy"])
    t = F.coalesce(F.col(text), F.lit(""))
    kinds = []
    for kind, pattern, group, least in BASE:
        kinds.append(_spans(_places(t, pattern), kind, _long_enough(pattern, group, least)))
    base = F.array_sort(F.concat(*kinds))
    entropy = _spans(_places(t, CANDIDATE), ENTROPY, lambda p: _suspicious(p["match"]))
    out = docs.select(*keep, base.alias("base"), entropy.alias("__entropy"))
    return out.select(*keep, "base", F.array_sort(F.concat("base", "__entropy")).alias("spans"))


def _long_enough(pattern: str, group: int, least: int):
    return lambda p: F.length(F.regexp_extract(p["match"], pattern, group) if group else p["match"]) >= least


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                   s["end"].cast("string"))), ",")
