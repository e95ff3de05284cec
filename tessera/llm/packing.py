"""Sequence packing as vector bin packing with the dot-product heuristic (operator 9)."""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm.common import binary_list, kept_by_worker, sliced


#: The pre-tokenizer pattern of byte-level BPE files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: What the pattern's \s stands for.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space from this length on don't go through the pattern, whose matcher gives up at a million.
LONG_RUN = 100_000
_RUNS = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")


def byte_ranks(data: dict) -> dict[bytes, int]:
    """Byte strings and ids of a byte-level BPE file; its ids must be in the order of its merges.

    Such a file writes the bytes that aren't printable as the characters from U+0100 on, in order.
    """
    pre, vocab = data["pre_tokenizer"], data["model"]["vocab"]
    if data["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or data["normalizer"]:
        raise ValueError("not a plain byte-level BPE file")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(c): c for c in printable}
    of |= {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in of.values())}
    special = {x["content"] for x in data["added_tokens"]}
    made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in data["model"]["merges"]]
    order = [vocab[c] for c in of] + [vocab[t] for t in made]
    if sorted(order[:256]) + order[256:] != sorted(order) or set(vocab) - special != set(of) | set(made):
        raise ValueError("ids that aren't in the order of the merges")
    return {bytes(of[c] for c in t): i for t, i in vocab.items() if t not in special}


def special_ids(data: dict) -> dict[str, int]:
    """Strings and ids of a file's added tokens; those that take their surroundings in are refused."""
    added = data["added_tokens"]
    names = [x["content"] for x in added]
    if (any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in added)
            or any(a != b and a in b for a in names for b in names)):
        raise ValueError("added tokens that aren't plain strings")
    return {x["content"]: x["id"] for x in added}


def file_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Encoder:
    """Ids of texts by a byte-level BPE ``tokenizers`` file, given as its path or bytes.

    The file's vocabulary is run by ``tiktoken``, which gives the same ids in a seventh of the time. With
    ``specials`` a special token's string in a text is that token, as ``tokenizers`` has it by default; else it is
    ordinary text (its ``encode_special_tokens``).
    """

    def __init__(self, file: str | bytes, specials: bool = False):
        import tiktoken
        data = json.loads(file_bytes(file) if isinstance(file, str) else file)
        self.specials = special_ids(data) if specials else {}
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=byte_ranks(data), special_tokens=self.specials)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        ids: list[int] = []
        at = 0
        for run in _RUNS.finditer(text):
            # the pattern takes a run of white space but for its last character, if text of no special token follows
            end = run.end()
            if end < len(text) and not text.startswith(tuple(self.specials), end):
                end -= 1
            ids += self.bpe.encode(text[at:run.start()], allowed_special="all")
            ids += self.bpe._encode_single_piece(text[run.start():end].encode())
            at = end
        return np.array(ids + self.bpe.encode(text[at:], allowed_special="all"), "<u4")

    def bears(self, text: str | None, ids: np.ndarray, skip: int | None) -> np.ndarray | None:
        """Which of ``ids``, those of ``text`` and of its end, have anything after the first ``skip`` characters."""
        if not text or not skip or skip < 0:
            return None
        n = len(text[:skip].encode())
        ends = np.cumsum([len(self.bpe.decode_single_token_bytes(i)) for i in self.encode(text).tolist()])
        return np.concatenate([ends > n, np.ones(len(ids) - len(ends), bool)])


@dataclass
class Example:
    """A document's ids that aren't placed yet; ``loss`` says which of them bear loss (None: all)."""

    key: object
    ids: np.ndarray
    loss: np.ndarray | None = None
    start: int = 0
    total: int = 0

    @property
    def size(self) -> int:
        return len(self.ids)

    def n_loss(self, n: int | None = None) -> int:
        return len(self.ids[:n]) if self.loss is None else int(self.loss[:n].sum())


@dataclass
class Packer:
    """Fill sequences under limits on tokens, segments and loss-bearing tokens.

    For an open sequence with remaining capacities r, the example of the largest dot product of its needs and
    r (each in units of its limit) among those that fit is placed next. If none fits whole, the one of the
    largest dot product is cut at what fits. A sequence closes when a capacity is used up. With a constant
    loss share the dot product grows with the size, so the waiting examples are kept in order of size. The last
    segment that a sequence may have goes to an example that fills it, if there is one. ``pool`` examples wait, or
    as many more as it takes to have a sequence's tokens (``tokens`` at most); they hold the tokens of ``pool`` full
    sequences at most, whatever the input.
    """

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048
    pool: int = 512
    waiting: list = field(default_factory=list)
    sizes: list = field(default_factory=list)
    sequence: int = -1
    held: int = 0

    def add(self, e: Example):
        at = bisect_right(self.sizes, e.size)
        self.sizes.insert(at, e.size)
        self.waiting.insert(at, e)
        self.held += e.size
        while self.held >= self.tokens and (len(self.waiting) > self.pool or self.held > self.pool * self.tokens):
            yield from self.fill(self.tokens)

    def _best(self, room: tuple[int, int, int]) -> tuple[int, int]:
        """Index of the example to place and the number of its tokens that fit."""
        if room[1] == 1 and self.sizes[-1] > room[0] and self.waiting[-1].n_loss(room[0]) <= room[2]:
            return len(self.waiting) - 1, room[0]
        r = (room[0] / self.tokens, room[1] / self.segments, room[2] / self.loss)
        best = (-1.0, 0, 0)
        hi = bisect_right(self.sizes, room[0])
        for k in range(hi - 1, -1, -1):
            e = self.waiting[k]
            if (top := e.size / self.tokens * r[0] + r[1] / self.segments + e.size / self.loss * r[2]) <= best[0]:
                break  # smaller ones can't be better: loss tokens are at most the tokens
            n = e.n_loss()
            if n <= room[2]:
                score = top - (e.size - n) / self.loss * r[2]
                if score > best[0]:
                    best = (score, k, e.size)
        if best[2]:
            return best[1], best[2]
        k = len(self.waiting) - 1  # nothing fits whole: the largest is cut
        e = self.waiting[k]
        n = min(room[0], e.size)
        if e.loss is not None and e.n_loss(n) > room[2]:
            n = int(np.searchsorted(np.cumsum(e.loss[:n]), room[2], "right"))
        else:
            n = n if e.loss is not None else min(n, room[2])
        return k, n

    def fill(self, capacity: int):
        """Close one sequence of at most ``capacity`` tokens; yield (example key, total, start, ids, sequence, offset)."""
        self.sequence += 1
        room, offset = (capacity, self.segments, self.loss), 0
        while self.waiting and min(room[:2]) > 0:
            k, n = self._best(room)
            if not n:
                break
            e = self.waiting.pop(k)
            self.sizes.pop(k)
            yield e.key, e.total, e.start, e.ids[:n], self.sequence, offset
            room = (room[0] - n, room[1] - 1, room[2] - e.n_loss(n))
            offset += n
            self.held -= n
            if n < e.size:
                rest = Example(e.key, e.ids[n:], None if e.loss is None else e.loss[n:], e.start + n, e.total)
                at = bisect_left(self.sizes, rest.size)
                self.sizes.insert(at, rest.size)
                self.waiting.insert(at, rest)

    def finish(self):
        """Place what waits. The rest of under ``tokens``, or what the longest examples have in as many segments as
        a sequence may have, goes to sequences of powers of two, which need no padding unless the loss limit
        closes them early.
        """
        while self.waiting:
            left = sum(self.sizes[-self.segments:])
            yield from self.fill(min(self.tokens, 1 << (left.bit_length() - 1)))


PIECES = ("doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", tokens: int = 2048,
         segments: int = 64, loss: int | None = None, end_id: int | None = 1, pool: int = 512,
         specials: bool = False, loss_from: str | None = None) -> DataFrame:
    """Pieces of packed sequences: id, ``start``, ``length``, ``ids``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``.

    Each row's whole text is encoded by the tokenizer file and closed by ``end_id``; NULL and empty texts are that
    id alone. With ``specials`` the strings of the file's special tokens are those tokens, else ordinary text. Examples are cut freely; each id is in exactly one piece. A sequence holds at most ``tokens``
    tokens, ``segments`` pieces and ``loss`` loss-bearing tokens. All tokens of a document bear loss, unless the
    column ``loss_from`` has the number of characters its text begins with that bear none (a prompt; NULL: 0); a
    token that goes on after them bears loss, and so does ``end_id``. Each
    task packs the rows it reads, ``pool`` examples at a time, and numbers its sequences after its
    partition, so nothing is shuffled and a retried task repeats its result. Full sequences have ``tokens``
    tokens; what a task has left goes to sequences whose length is a power of two. ``segments=tokens`` is no
    limit on pieces; a lower one closes sequences of many short texts before they are full. Repeated rows are packed as
    often as they occur; other columns don't matter. No rows, no sequences. A text of any length or makeup (runs of millions of
    blanks too) is encoded whole, in one worker's memory. The tokenizer file is read on the driver.
    """
    limit = tokens if loss is None else loss
    # read here alone: executors need no file; a vocabulary's size doesn't follow the data
    data = file_bytes(tokenizer)
    shared, key = docs.sparkSession.sparkContext.broadcast(data), (zlib.crc32(data), len(data), specials)

    def run(batches):
        enc = kept_by_worker("encoder", key, lambda: Encoder(shared.value, specials))
        packer = Packer(tokens, segments, limit, pool)
        base = TaskContext.get().partitionId() << 33
        end = np.array([] if end_id is None else [end_id], "<u4")
        out: list = []
        for b in sliced(batches, 1 << 23, text):
            texts = [None if t is None else t.decode("utf-8", "replace") for t in binary_list(b.column(text))]
            skips = b.column(loss_from).to_pylist() if loss_from else [None] * len(texts)
            for doc, t, skip in zip(b.column(id_col).to_pylist(), texts, skips):
                ids = np.concatenate([enc.encode(t), end])
                if len(ids):
                    out.extend(packer.add(Example(doc, ids, enc.bears(t, ids, skip), 0, len(ids))))
            yield _pieces(out, base, key_type, id_col)
            out = []
        for p in packer.finish():
            out.append(p)
            if len(out) >= 4096:
                yield _pieces(out, base, key_type, id_col)
                out = []
        yield _pieces(out, base, key_type, id_col)

    kind = dict(docs.dtypes)[id_col]
    key_type = to_arrow_schema(docs.select(id_col).schema).field(0).type
    read = [id_col, text, *([loss_from] if loss_from else [])]
    return docs.select(*read).mapInArrow(run, PIECES.replace("doc_id long", f"{id_col} {kind}", 1))


def _pieces(rows: list, base: int, kind: pa.DataType, id_col: str) -> pa.RecordBatch:
    keys, totals, starts, ids, seqs, offs = zip(*rows) if rows else ((),) * 6
    sizes = [len(x) for x in ids]
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, "<u4"), *ids]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, kind), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
         pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()), pa.array(totals, pa.int64()),
         pa.array([base + s for s in seqs], pa.int64()), pa.array(offs, pa.int64())],
        names=[id_col, "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Path of a public tokenizer's file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)
