"""Filter interaction audit with count-weighted decision diagrams (operator 13).

Each document has a failure mask: one bit for each filter. Spark adds up the documents of each (part, mask); a part's
few counts become a decision diagram whose levels test the filters in some order. Neighbouring levels are swapped until
every order was there once, and an order's all-pass path gives what each of its filters removes.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import binary_list, looked_up, pieces, sliced, written

#: Filters in the order of their bits, the first one in the lowest bit.
FILTERS = "ABCDE"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes that continue a code point.
FOLLOWING = bytes(range(0x80, 0xC0))
MARKS = re.compile(rb"[#$%&*|]")
#: A text is taken apart in pieces of about this many bytes, cut at white space.
PIECE = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a whole text fails."""
    words, distinct = 0, set()
    for piece in pieces(text, PIECE, BLANK):
        found = piece.split()
        words += len(found)
        distinct.update(found)
    points = len(text.translate(None, FOLLOWING))
    upper = len(text) - len(text.translate(None, UPPER))
    return ((words < 200) | (100 * len(distinct) < 50 * words) << 1 | (100 * upper > 2 * points) << 2
            | bool(MARKS.search(text)) << 3)


def failure_masks(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
                  part: str = "source") -> DataFrame:
    """``(part, mask, n, good, toxic)``: how many documents of a part fail exactly the filters in ``mask``, and how many
    of these are labelled good (quality = 1) or toxic. Several rows may share a part and mask.

    Filters of the whole text (NULL: empty; words are runs without ASCII white space): A under 200 words, B under half
    of the words distinct, C over 2 % of the code points in A-Z, D has one of ``#$%&*|``, E equal to the text of a smaller
    id anywhere in the table. A NULL part is the empty string. Rows that repeat an id and text stand alike; a row
    without an id neither fails E nor makes another fail it, and has no label. Of several labels of an id any 1 counts.
    Texts of any length are taken in pieces. An empty table gives no rows; other columns are not read.

    Only (id, part, mask, digest) is shuffled. Equal texts meet by the pair (digest, id), so a text that a third of all
    documents share is no hot key; hot ids of the labels come by a bounded broadcast.
    """
    src = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    schema = T.StructType([src.schema["doc"], T.StructField("part", T.StringType())] +
                          T.StructType.fromDDL("mask int, digest binary").fields)

    def run(batches):
        for b in sliced(batches, 1 << 25, "text"):
            texts = [t or b"" for t in binary_list(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("part"), pa.array([text_mask(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], names=["doc", "part", "mask", "digest"])

    rows, _ = written(src.mapInArrow(run, schema).groupBy("doc", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n")))
    first = (rows.where(F.col("doc").isNotNull()).groupBy("digest").agg(F.min("doc").alias("doc"))
             .select("digest", "doc", F.lit(True).alias("first")))
    if labels is None:
        said = rows.select(*rows.columns, F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    else:
        said = labels.groupBy(F.col("doc_id").alias("doc")).agg(
            F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
        said = looked_up(rows, said, "doc")
    copy = F.when(F.col("first").isNull() & F.col("doc").isNotNull(), 1 << 4).otherwise(0)
    judged = said.join(first, ["digest", "doc"], "left").select("part", F.col("mask").bitwiseOR(copy).alias("mask"), "n", "good", "toxic")
    return judged.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def adjacent_swaps(k: int):
    """Levels l to swap with l + 1, one after another, so that each order of k filters is there once (plain changes)."""
    order, step = list(range(k)), [-1] * k
    while True:
        for e in range(k - 1, -1, -1):
            i = order.index(e)
            j = i + step[e]
            if 0 <= j < k and order[j] < e:
                break
        else:
            return
        order[i], order[j] = order[j], order[i]
        for above in range(e + 1, k):
            step[above] = -step[above]
        yield min(i, j)


class Diagram:
    """Decision diagram of failure masks, with the summed weights of the masks below each node.

    ``order[l]`` is the filter that level l tests. A node is its pair of children (pass, fail), equal nodes are one; node 0
    stands for no documents at any level.
    """

    def __init__(self, filters: int, masks: dict[int, tuple[int, ...]], width: int):
        self.order = list(range(filters))
        self.children, self.weight = [(0, 0)], [(0,) * width]
        self.known: dict = {}
        self.root = self._built(0, masks)

    def _leaf(self, weight: tuple[int, ...]) -> int:
        return self._held(("leaf", weight), (0, 0), weight) if any(weight) else 0

    def _held(self, key, children: tuple[int, int], weight: tuple[int, ...]) -> int:
        if key not in self.known:
            self.known[key] = len(self.children)
            self.children.append(children)
            self.weight.append(weight)
        return self.known[key]

    def _node(self, passed: int, failed: int) -> int:
        if not passed and not failed:
            return 0
        total = tuple(a + b for a, b in zip(self.weight[passed], self.weight[failed]))
        return self._held((passed, failed), (passed, failed), total)

    def _built(self, level: int, masks: dict[int, tuple[int, ...]]) -> int:
        if not masks:
            return 0
        if level == len(self.order):
            return self._leaf(next(iter(masks.values())))
        bit = 1 << self.order[level]
        return self._node(self._built(level + 1, {m: w for m, w in masks.items() if not m & bit}),
                          self._built(level + 1, {m: w for m, w in masks.items() if m & bit}))

    def swap(self, level: int) -> None:
        """Exchange ``level`` and the one below; nodes at other levels keep their meaning."""
        done = {0: 0}

        def moved(node: int, depth: int) -> int:
            if (depth, node) not in done and node:
                passed, failed = self.children[node]
                if depth < level:
                    new = self._node(moved(passed, depth + 1), moved(failed, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self.children[passed], self.children[failed]
                    new = self._node(self._node(pp, fp), self._node(pf, ff))
                done[depth, node] = new
            return done[depth, node] if node else 0

        self.root = moved(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def all_pass(self):
        """Along the path of documents that pass: (filter, weights that remain, weights that the filter removes)."""
        node = self.root
        for f in self.order:
            node, failed = self.children[node]
            yield f, self.weight[node], self.weight[failed]


RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def part_rows(part: str, masks: dict[int, tuple[int, int, int]], names: str) -> list[tuple]:
    """All rows of one part: each order's steps."""
    diagram = Diagram(len(names), masks, 3)
    paths, fails, alone, shapley = [], [0] * len(names), [0] * len(names), [0] * len(names)

    def read() -> None:
        path = list(diagram.all_pass())
        fails[path[0][0]] = path[0][2][0]
        alone[path[-1][0]] = path[-1][2][0]
        for f, _, gone in path:
            shapley[f] += gone[0]
        paths.append(path)

    read()
    for level in adjacent_swaps(len(names)):
        diagram.swap(level)
        read()
    rows = []
    for path in paths:
        order = "".join(names[f] for f, _, _ in path)
        for step, (f, left, gone) in enumerate(path, 1):
            rows.append((part, order, step, left[0], gone[0], fails[f] - gone[0], alone[f], gone[1], gone[2], shapley[f]))
    return rows


def interactions(masks: DataFrame, names: str = FILTERS) -> DataFrame:
    """For each part, each order of the filters and each step: what the step's filter keeps and removes.

    ``masks`` has (part, mask, n, good, toxic), as from ``failure_masks`` or any other filters (``names``, the lowest bit
    first). ``kept``, ``removed``: documents after and by the step; ``redundant``: those that fail its filter and were
    removed before; ``unique_fails``: those that fail no other filter; ``good_lost``, ``toxic_lost``: removed documents with
    that label; ``shapley``: the filter's ``removed`` added up over all orders. No masks, no rows.

    A part has at most one row for each mask, and the parts are dealt to the tasks, however many there are.
    """
    if not 1 <= len(names) <= 8 or len(set(names)) != len(names):
        raise ValueError("one to eight filters with different names")
    counts = masks.groupBy("part", "mask").agg(*(F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")))
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    kinds = list(to_arrow_schema(T.StructType.fromDDL(RESULT)))

    def run(batches):
        for b in batches:
            for part, found in zip(b.column("part").to_pylist(), b.column("masks").to_pylist()):
                rows = part_rows(part, {r["mask"]: (r["n"], r["good"], r["toxic"]) for r in found}, names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], names=[k.name for k in kinds])

    return parts.mapInArrow(run, RESULT)
