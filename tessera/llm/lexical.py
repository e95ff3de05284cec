"""Ranked lexical search by NRA: sequential impact-sorted reads with score intervals (operator 12).

The lists of the items' terms are written once, each cut into blocks of falling impact whose sizes grow by a factor. A
round reads one block of every list. A document that was seen has a lower bound of its score (what was read) and an upper
one (plus the best that each list it was not seen in can still give); one that was not seen has the sum of these bests.
No list is ever looked up by document: a round is a scan of its block.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import binary_list, discard, kept_by_worker, pieces, sliced, written
from tessera.llm.decontam import FOLD
from tessera.session import ensure_checkpoint_dir

#: Postings of a list in its first block, about, and the factor from the end of a block to that of the next.
FIRST_BLOCK, GROWTH = 512, 8
#: Impacts are told apart in steps of this size when blocks are cut; a block's best impact is exact.
STEP = 256
#: Requests (document, list) of a round that go by broadcast at most (32 bytes each); more meet the block in a shuffle join.
ASKS = 1_000_000
#: A text is taken apart in pieces of about this many bytes.
PIECE = 1 << 20
BLANK = re.compile(rb" ")


def terms_of(text: bytes | None):
    """Batches of the terms of a text, A-Z lowered, in bounded pieces."""
    for piece in pieces(text.translate(FOLD) if text else b"", PIECE, BLANK):
        yield piece.split()


def _documents(docs: DataFrame, vocabulary: list[bytes], doc_id: str, text: str) -> DataFrame:
    """``(k, doc, n, terms)`` for each row: its key, id, number of terms, and (t, tf) of those in ``vocabulary``."""
    src = docs.select(F.monotonically_increasing_id().alias("k"), F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    schema = T.StructType([src.schema["k"], src.schema["doc"]] + T.StructType.fromDDL("n long, terms array<struct<t:int,tf:long>>").fields)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    key = hashlib.sha256(b"\n".join(vocabulary)).hexdigest()
    kind = pa.list_(pa.struct([("t", pa.int32()), ("tf", pa.int64())]))

    def run(batches):
        number = kept_by_worker("search terms", key, lambda: {w: i for i, w in enumerate(shared.value)})
        for b in sliced(batches, 1 << 25, "text"):
            sizes, ends, t, tf = [], [0], [], []
            for value in binary_list(b.column("text")):
                count, size = Counter(), 0
                for words in terms_of(value):
                    size += len(words)
                    count.update(words)
                for w, c in count.items():
                    if w in number:
                        t.append(number[w])
                        tf.append(c)
                sizes.append(size)
                ends.append(len(t))
            flat = pa.StructArray.from_arrays([pa.array(t, pa.int32()), pa.array(tf, pa.int64())], fields=list(kind.value_type))
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("doc"), pa.array(sizes, pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], names=["k", "doc", "n", "terms"])

    return src.mapInArrow(run, schema)


def _postings(held: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """``(t, k, doc, x)``: x is the part of the impact that comes from the document."""
    wide = "decimal(19,0)"
    m = F.expr(f"25 + cast(75 * n as {wide}) * cast({n_docs} as {wide}) div cast({n_terms} as {wide})")
    return (held.select("k", "doc", m.alias("m"), F.inline("terms"))
            .select("t", "k", "doc", F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)").alias("x")))


def _cut_lists(postings: DataFrame, n_docs: int, first: int, growth: int) -> DataFrame:
    """``(t, block, low, best, w)``: each list's blocks, with their least level, best impact and the term's weight.

    From a histogram of levels, so no list is sorted as a whole; a block ends with a level.
    """
    levels = postings.groupBy("t", F.expr(f"x div {STEP}").alias("level")).agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("x"))
    over = Window.partitionBy("t")
    before = F.coalesce(F.sum("n").over(over.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = F.sum("n").over(over)
    w = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * df + 1)))
    block = F.when(F.col("before") < first, 0).otherwise(1 + F.floor(F.log(F.col("before") / first) / F.log(F.lit(float(growth)))))
    return (levels.select("t", "level", "x", before.alias("before"), w.alias("w")).select("t", "level", "x", "w", block.cast("int").alias("block"))
            .groupBy("t", "block", "w").agg(F.min("level").alias("low"), (F.max("x") * F.col("w")).alias("best")))


class _Items:
    """The items of one shard and their terms' lists, on the driver: all within the shard's bytes."""

    def __init__(self, texts: list[bytes | None]):
        number: dict[bytes, int] = {}
        item, term, times, place = [], [], [], []
        for i, text in enumerate(texts):
            count = Counter(w for words in terms_of(text) for w in words)
            for p, (w, c) in enumerate(count.items()):
                item.append(i)
                term.append(number.setdefault(w, len(number)))
                times.append(c)
                place.append(p)
        self.vocabulary = list(number)
        self.n = len(texts)
        self.item, self.term = np.array(item, np.int64), np.array(term, np.int64)
        self.times, self.place = np.array(times, np.int64), np.array(place, np.int64)

    def take(self, blocks: pa.Table) -> None:
        """Note the best impact from each block on: ``behind[t, r + 1]`` is what list t can give after round r."""
        t, b = blocks.column("t").to_numpy().astype(np.int64), blocks.column("block").to_numpy().astype(np.int64)
        self.blocks = int(b.max()) + 1 if len(b) else 0
        best = np.zeros((len(self.vocabulary), self.blocks + 1), np.int64)
        best[t, b] = blocks.column("best").to_numpy()
        self.behind = np.maximum.accumulate(best[:, ::-1], axis=1)[:, ::-1]

    def rest(self, r: int) -> np.ndarray:
        """What each (item, term) can still give after round r."""
        return self.times * self.behind[self.term, r + 1]

    def frame(self, spark: SparkSession, r: int, least: np.ndarray, which: np.ndarray, closed: np.ndarray) -> DataFrame:
        """A row for each item in ``which``: its terms, their times, what they can still give, its limit, and if it takes no new documents."""
        front = self.rest(r)
        edge = np.searchsorted(self.item, np.arange(self.n + 1))
        rows = [(int(i), self.term[a:b].tolist(), self.times[a:b].tolist(), front[a:b].tolist(), int(front[a:b].sum()), int(least[i]), bool(closed[i]))
                for i, a, b in ((i, edge[i], edge[i + 1]) for i in np.flatnonzero(which))]
        return spark.createDataFrame(rows, "item int, terms array<int>, times array<long>, front array<long>, rest long, least long, closed boolean").coalesce(1)

    def terms_frame(self, spark: SparkSession, which: np.ndarray) -> DataFrame:
        at = np.flatnonzero(which[self.item])
        cols = [pa.array(self.item[at], pa.int32()), pa.array(self.term[at], pa.int32()), pa.array(self.times[at]), pa.array(self.place[at], pa.int32())]
        return spark.createDataFrame(pa.table(cols, names=["item", "t", "times", "place"])).coalesce(1)


_UPPER = "lower + rest - aggregate(seen, 0L, (a, p) -> a + front[p])"


def _rounds(spark: SparkSession, items: _Items, lists: DataFrame, k: int, log: list | None) -> list[DataFrame]:
    """Read the blocks one after the other until every item's rows are settled; the rows, in parts."""
    active, closed = np.zeros(items.n, bool), np.zeros(items.n, bool)
    active[items.item[items.rest(-1) > 0]] = True
    least, asks = np.zeros(items.n, np.int64), 0
    state, path, parts = None, None, []
    best = Window.partitionBy("item").orderBy(F.desc("lower"), F.asc_nulls_last("doc"), "k")
    columns = ["item", "k", "doc", "lower", "seen"]
    for r in range(items.blocks):
        if not active.any():
            break
        posts, rows = lists.where(F.col("block") == r), []
        if (active & ~closed).any():
            rows.append(posts.join(F.broadcast(items.terms_frame(spark, active & ~closed)), "t").select(
                "item", "k", "doc", (F.col("times") * F.col("impact")).alias("lower"), F.array("place").alias("seen")))
        if state is not None:
            kept = state.join(F.broadcast(items.frame(spark, r - 1, least, active, closed)), "item").where(F.expr(f"{_UPPER} >= least"))
            rows.append(kept.select(*columns))
            if asks:
                open_lists = F.expr("filter(sequence(0, size(front) - 1), p -> front[p] > 0 AND NOT array_contains(seen, p))")
                ask = (kept.where("closed").select("item", "k", "terms", "times", F.explode(open_lists).alias("place"))
                       .select("item", "k", F.expr("terms[place]").alias("t"), F.expr("times[place]").alias("times"), "place"))
                ask = F.broadcast(ask) if asks <= ASKS else ask
                rows.append(posts.join(ask, ["t", "k"]).select(
                    "item", "k", "doc", (F.col("times") * F.col("impact")).alias("lower"), F.array("place").alias("seen")))
        union = rows[0]
        for more in rows[1:]:
            union = union.unionByName(more)
        merged = union.groupBy("item", "k").agg(F.min("doc").alias("doc"), F.sum("lower").alias("lower"),
                                                F.flatten(F.collect_list("seen")).alias("seen")).select(*columns)
        old, (state, path) = path, written(merged)
        if old:
            discard(spark, old)
        top = state.select("item", "lower", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("lower"))).alias("rank")).where(F.col("rank") <= k)
        for row in top.groupBy("item").agg(F.min("lower").alias("least"), F.count(F.lit(1)).alias("n")).collect():
            if row["n"] == k:
                least[row["item"]] = max(least[row["item"]], row["least"])
        rest = np.zeros(items.n, np.int64)
        np.add.at(rest, items.item, items.rest(r))
        closed = active & ((rest < least) | (rest == 0))
        frame = items.frame(spark, r, least, active, closed)
        kept = state.join(F.broadcast(frame), "item").where(F.expr(f"{_UPPER} >= least"))
        unread = F.expr("size(filter(sequence(0, size(front) - 1), p -> front[p] > 0 AND NOT array_contains(seen, p)))")
        counts = kept.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum(unread).alias("asks")).collect()
        left = np.zeros(items.n, np.int64)
        held = 0
        for row in counts:
            left[row["item"]] = row["asks"]
            held += row["n"]
        done = closed & (left == 0)
        if done.any():
            final = kept.join(F.broadcast(spark.createDataFrame([(int(i),) for i in np.flatnonzero(done)], "item int")), "item", "left_semi")
            parts.append(written(final.select("item", F.row_number().over(best).alias("rank"), "doc", "lower").where(F.col("rank") <= k))[0])
        active &= ~done
        asks = int(left[active & closed].sum())
        if log is not None:
            log.append({"block": r, "candidates": held, "asks": asks, "open": int((active & ~closed).sum()), "active": int(active.sum())})
    if path:
        discard(spark, path)
    return parts


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", shard_bytes: int = 500_000, first_block: int = FIRST_BLOCK, growth: int = GROWTH,
           log: list | None = None) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of the highest score above 0 for each item.

    Terms are runs of bytes of ASCII letters, digits or above 0x7F, with A-Z lowered. With N documents that have a term, L terms in
    all, n in a document, df documents with the term and tf of it in the document: w = floor(1000 ln((2N + 2) / (2df + 1))),
    m = 25 + 75nN div L, and a score adds up w * (10^9 tf div (1000 tf + 8m)) over the item's terms, repeats included.
    Equal scores go by ascending id.

    NRA: reading goes on while an unseen document could reach the k-th lower bound or tie with it, while a seen one
    could, and until every document that may be among the first k has been met or ruled out in all lists, so that
    membership, ties and scores are exact. ``log`` takes a row of figures for each round.

    NULL and empty texts have no terms. Each row of ``items`` is an item and each row of ``docs`` a document of its own, also
    if an id is NULL (last in ties) or repeated. Texts of any length are taken in pieces. An empty table on either side gives no
    rows. Other columns are not read. Items come to the driver in shards of about ``shard_bytes`` (one item at least); their terms,
    at most that large, and ranked rows are all that does. With more than one shard the documents are read once for each.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("t")).where(F.col("t").isNotNull())
    total = named.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    ids = T.StructType([T.StructField("item", T.IntegerType()), named.schema["item_id"]])
    kinds = docs.select(F.col(doc_id).alias("doc_id"))
    out = None
    for s in range(shards):
        mine = named.where(F.pmod(F.xxhash64("t"), F.lit(shards)) == s).orderBy("t", "item_id").collect()
        shard = _Items([row["t"].encode() for row in mine])
        if not shard.vocabulary:
            continue
        held, held_path = written(_documents(docs, shard.vocabulary, doc_id, text))
        n_docs, n_terms = held.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not n_docs:
            discard(spark, held_path)
            continue
        postings = _postings(held, n_docs, n_terms)
        blocks, blocks_path = written(_cut_lists(postings, n_docs, first_block, growth))
        shard.take(blocks.select("t", "block", "best").toArrow())
        # one row for each term of the shard: bounded by its bytes
        cuts = blocks.groupBy("t", "w").agg(F.collect_list(F.struct("low", "block")).alias("cuts"))
        placed = postings.join(F.broadcast(cuts), "t").select(
            "t", "k", "doc", (F.col("x") * F.col("w")).alias("impact"),
            F.expr(f"array_min(transform(filter(cuts, c -> c.low <= x div {STEP}), c -> c.block))").alias("block"))
        lists_path = f"{ensure_checkpoint_dir(spark)}/lists-{uuid.uuid4().hex}"
        placed.where(F.col("impact") > 0).write.partitionBy("block").parquet(lists_path)
        lists = spark.read.schema(placed.schema).parquet(lists_path)
        parts = _rounds(spark, shard, lists, k, log)
        for path in (held_path, blocks_path, lists_path):
            discard(spark, path)
        names = F.broadcast(spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(mine)], ids))
        for part in parts:
            rows = part.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), F.col("lower").alias("score"))
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        schema = T.StructType([named.schema["item_id"], T.StructField("rank", T.IntegerType()), kinds.schema["doc_id"], T.StructField("score", T.LongType())])
        return spark.createDataFrame([], schema)
    return out
