"""Quality and toxicity scores from a weak-label model and a hashed linear scorer (operator 10).

Heuristic labellers vote on each document or abstain. Nobody knows how good they are: expectation-maximisation
over the counts of their vote patterns estimates for each what it votes on good and on bad documents, and so the
posterior label of each pattern. A linear scorer over hashed features learns those posteriors on a bounded
sample and scores every document, also where the labellers abstain.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import binary_list, passed_columns, schema_of, sliced, with_columns

BAD, GOOD, ABSTAIN = 0, 1, 2
#: The number of vote patterns, which the driver collects, is at most 3 ** MOST_LABELLERS.
MOST_LABELLERS = 9
_SYMBOLS = b"#$%&*<>[]{}|\\^~_=+@!"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
#: Classes of a feature's shape: A, a (other letters too), 9; signs stand for themselves.
_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 57 if 48 <= c <= 57 else c
               for c in range(256))
_TRIM = b".,;:!?\"'()[]"

#: Common insults, in overlapping lists of which each labeller has one.
INSULTS = {
    "mind": frozenset(b"idiot idiots moron morons stupid dumb dumbass fool imbecile clown brainless retard trash pathetic".split()),
    "worth": frozenset(b"loser losers worthless scum trash garbage pathetic vermin filth stupid idiot clown".split()),
    "disgust": frozenset(b"disgusting pathetic scum filthy vile moron worthless bastard pig loser jerk disgusting".split()),
}


@dataclass
class Text:
    """What the labellers look at."""

    raw: bytes
    words: list[bytes]
    #: Distinct words in lower case without the signs around them.
    plain: frozenset[bytes]

    @classmethod
    def of(cls, raw: bytes | None) -> Text:
        raw = raw or b""
        return cls(raw, raw.split(), frozenset(w.strip(_TRIM) for w in raw.lower().split()))

    def share(self, chars: bytes) -> float:
        return (len(self.raw) - len(self.raw.translate(None, chars))) / max(1, len(self.raw))


def _vote(value: float, good_under: float, bad_from: float) -> int:
    return GOOD if value < good_under else BAD if value >= bad_from else ABSTAIN


def by_symbols(t: Text) -> int:
    return _vote(t.share(_SYMBOLS), 0.01, 0.04)


def by_capitals(t: Text) -> int:
    up, low = t.share(_UPPER), t.share(_LOWER)
    return _vote(up / max(1e-9, up + low), 0.2, 0.5) if up + low else ABSTAIN


def by_marked_words(t: Text) -> int:
    """Words that hold a sign other than those of a sentence."""
    marked = sum(len(w) != len(w.translate(None, _SYMBOLS)) for w in t.words)
    return _vote(marked / max(1, len(t.words)), 0.08, 0.25)


def by_stutter(t: Text) -> int:
    """Words that repeat the one before."""
    again = sum(map(operator.eq, t.words, t.words[1:]))
    return _vote(again / max(1, len(t.words)), 0.03, 0.15)


def by_commonest_word(t: Text) -> int:
    if len(t.words) < 20:
        return ABSTAIN
    return _vote(Counter(t.words).most_common(1)[0][1] / len(t.words), 0.15, 0.25)


def by_variety(t: Text) -> int:
    if not 20 <= len(t.words) <= 2000:
        return ABSTAIN
    return _vote(1 - len(set(t.words)) / len(t.words), 0.6, 0.85)


def by_sentences(t: Text) -> int:
    """Words for each sign that ends a sentence."""
    ends = t.raw.count(b". ") + t.raw.count(b".\n") + t.raw.endswith(b".")
    return _vote(len(t.words) / max(1, ends), 40, 120) if t.words else BAD


def by_length(t: Text) -> int:
    return BAD if len(t.words) < 5 else ABSTAIN


QUALITY = (by_symbols, by_capitals, by_marked_words, by_stutter, by_commonest_word, by_variety, by_sentences, by_length)


def by_list(name: str, words: frozenset[bytes], least: int = 1):
    """A labeller: bad with ``least`` of the words or more."""
    def vote(t: Text) -> int:
        return GOOD if len(words & t.plain) < least else BAD
    vote.__name__ = f"by_{name}"
    return vote


#: A document that is "bad" here is toxic.
TOXICITY = tuple(by_list(k, v) for k, v in INSULTS.items())


def marked_words(docs: DataFrame, labels: DataFrame, flag: str, id_col: str = "doc_id", text: str = "text",
                 share: float = 0.01, ratio: float = 50.0, most: int = 5_000, most_words: int = 2_000) -> frozenset[bytes]:
    """Words that flagged documents have, and others hardly: a labeller's list, in any language.

    Of the labelled documents about ``most`` with the flag and as many without it are read, by the hash of their id.
    A word is listed if it is in a ``share`` of the flagged distinct texts at least, in three at least, and ``ratio``
    times as often as in the others; there are ``most_words`` at most, the commonest ones. Rows with a NULL id, text
    or flag say nothing.
    """
    of = labels.select(F.col(id_col).alias("i"), F.col(flag).alias("f")).dropna().dropDuplicates(["i"])
    n = dict(of.groupBy("f").count().collect())
    u = F.xxhash64(F.col("i").cast("string")).bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))
    of = of.where(u < F.when(F.col("f") == 1, most / max(1, n.get(1, 0))).otherwise(most / max(1, n.get(0, 0))))
    # about 2 * most ids and flags go to the texts, rather than the texts to them
    texts = docs.select(F.col(id_col).alias("i"), F.col(text).alias("t")).dropna().join(F.broadcast(of), "i").select("f", "t").distinct()
    size = dict(texts.groupBy("f").count().collect())
    yes, no = size.get(1, 0), size.get(0, 0)
    words = texts.select("f", F.explode(F.array_distinct(F.split(F.lower("t"), r"[\s.,;:!?\"'()\[\]]+"))).alias("w"))
    hit = words.where(F.col("w") != "").groupBy("w").agg(F.sum((F.col("f") == 1).cast("long")).alias("y"),
                                                       F.sum((F.col("f") != 1).cast("long")).alias("n"))
    hit = hit.where((F.col("y") >= max(3.0, share * yes)) & (F.col("y") * no >= F.col("n") * yes * ratio))
    return frozenset(r["w"].encode() for r in hit.orderBy(F.desc("y"), "w").limit(most_words).collect())


def votes_of(t: Text, labellers) -> str:
    return "".join(str(f(t)) for f in labellers)


@dataclass(frozen=True)
class WeakLabels:
    """``table[j, y, v]``: probability that labeller j, if it votes, votes v on a document of class y (1 for
    abstaining); ``prior`` of good."""

    table: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        logs = np.log(self.table)
        j = np.arange(votes.shape[1])
        one, zero = (logs[j, y, votes].sum(1) for y in (GOOD, BAD))
        return 1 / (1 + np.exp(np.clip(zero - one + np.log(1 - self.prior) - np.log(self.prior), -500, 500)))


def expectation_maximisation(votes: np.ndarray, n: np.ndarray, rounds: int = 200) -> WeakLabels:
    """Fit to vote patterns (rows) that ``n`` documents have each.

    Each labeller knows one kind of fault, so the first guess is that two bad votes mean a bad document, however
    many see nothing wrong, and that one bad vote is open.
    """
    m = votes.shape[1]
    p = 1 / (1 + np.exp(4.0 * ((votes == BAD).sum(1) - 1)))
    for _ in range(rounds):
        w = np.stack([(1 - p) * n, p * n])
        table = np.stack([[np.bincount(votes[:, j], weights=w[y], minlength=3) + 0.5 for y in (BAD, GOOD)]
                          for j in range(m)])
        table /= table[:, :, :ABSTAIN].sum(2, keepdims=True)
        table[:, :, ABSTAIN] = 1  # who abstains says nothing
        model = WeakLabels(table, float((w[GOOD].sum() + 1) / (w.sum() + 2)))
        new = model.posterior(votes)
        if np.abs(new - p).max(initial=0) < 1e-9:
            break
        p = new
    return model


def features(t: Text, buckets: int) -> np.ndarray:
    """Distinct hashed features: lower-case words without their signs, shapes of words' ends, repeated words."""
    found = set(t.plain)
    found |= {b"\x01" + w[:1] + w[-2:] for w in t.raw.translate(_SHAPE).split()}
    again = sum(map(operator.eq, t.words, t.words[1:]))
    if again * 20 > len(t.words):
        found.add(b"\x02again")
    return np.unique(np.fromiter((zlib.crc32(x) for x in found), np.int64, len(found)) & (buckets - 1))


def train(rows: list[np.ndarray], labels: np.ndarray, buckets: int, rounds: int = 4, rate: float = 0.3) -> np.ndarray:
    """AdaGrad on the logistic loss of soft labels, both classes of equal weight; the last value is the bias."""
    w, g = np.zeros(buckets + 1), np.full(buckets + 1, 1e-2)
    mean = float(labels.mean()) if len(labels) else 0.5
    for k in range(rounds):
        for i in np.random.default_rng(k).permutation(len(rows)):
            at = np.append(rows[i], buckets)
            y = labels[i]
            weight = y / max(mean, 1e-3) + (1 - y) / max(1 - mean, 1e-3)
            step = weight * (1 / (1 + np.exp(-np.clip(w[at].sum(), -30, 30))) - y) + 1e-4 * w[at]
            g[at] += step * step
            w[at] -= rate * step / np.sqrt(g[at])
    return w


@dataclass(frozen=True)
class Scorer:
    labellers: tuple
    weak: WeakLabels
    weights: np.ndarray

    def score(self, at: np.ndarray) -> float:
        z = self.weights[at].sum() + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(docs: DataFrame, labellers: dict[str, tuple], id_col: str = "doc_id", text: str = "text", buckets: int = 1 << 16,
        most: int = 20_000, partitions: int = 4) -> dict[str, Scorer]:
    """A scorer for each named set of labellers.

    The vote patterns of all documents are counted by Spark; the driver gets 3 ** labellers counts at most.
    About ``most`` documents with a text, taken by the hash of their id, train the linear scorers: each of
    ``partitions`` tasks trains one, and they are averaged.
    """
    for v in labellers.values():
        if len(v) > MOST_LABELLERS:
            raise ValueError(f"over {MOST_LABELLERS} labellers")
    rows = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text).alias("t"))

    def vote(batches):
        for b in sliced(batches, 1 << 25, "t"):
            name, votes = [], []
            for x in binary_list(b.column("t")):  # one text's words at a time
                t = Text.of(x)
                for k, v in labellers.items():
                    name.append(k)
                    votes.append(votes_of(t, v))
            yield pa.RecordBatch.from_arrays([pa.array(name, pa.string()), pa.array(votes, pa.string())],
                                             names=["target", "votes"])

    counts = (rows.mapInArrow(vote, "target string, votes string").groupBy("target", "votes").count().collect())
    weak, total = {}, 0
    for name, v in labellers.items():
        of = sorted((r["votes"], r["count"]) for r in counts if r["target"] == name)
        total = sum(c for _, c in of)
        votes = np.array([[int(x) for x in p] for p, _ in of], np.int64).reshape(len(of), len(v))
        weak[name] = expectation_maximisation(votes, np.array([c for _, c in of], float))
    share = min(1.0, most / max(1, total))
    u = F.xxhash64("i").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))
    sample = rows.where(F.col("t").isNotNull() & F.col("i").isNotNull() & (u < share)).repartition(partitions, F.xxhash64("i"))

    def learn(batches):
        at, votes = [], {k: [] for k in labellers}
        for b in sliced(batches, 1 << 25, "t"):
            for x in binary_list(b.column("t")):
                t = Text.of(x)
                at.append(features(t, buckets))
                for k, v in labellers.items():
                    votes[k].append([int(c) for c in votes_of(t, v)])
        for k, v in votes.items():
            if at:
                w = train(at, weak[k].posterior(np.array(v)), buckets)
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([w.astype("<f4").tobytes()], pa.binary())],
                                                 names=["target", "w"])

    trained = sample.select("t").mapInArrow(learn, "target string, w binary").collect()
    out = {}
    for name, v in labellers.items():
        ws = [np.frombuffer(r["w"], "<f4") for r in trained if r["target"] == name]
        out[name] = Scorer(v, weak[name], np.mean(ws, axis=0) if ws else np.zeros(buckets + 1, np.float32))
    return out


def targets(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text: str = "text") -> dict[str, tuple]:
    """The labellers of quality, and of being clean of insults; labelled toxic documents add words to the latter."""
    toxic = TOXICITY
    if labels is not None:
        words = marked_words(docs, labels, "toxic", id_col, text)
        toxic = (*TOXICITY, by_list("toxic_word", words), by_list("toxic_words", words, 2))
    return {"quality": QUALITY, "clean": toxic}


def classify(docs: DataFrame, scorers: dict[str, Scorer] | None = None, labels: DataFrame | None = None,
             id_col: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with ``score``, ``keep``, and for each target its ``<target>`` score and ``weak_<target>`` posterior.

    ``score`` is the product of the targets' scores: whether the document is good, and whether it is clean of
    insults. ``keep``: each target reaches ``least``. A target's score is the mean of the linear scorer's and the
    posterior's. NULL and empty texts, and those without a word, score 0. Repeated rows score alike. Without any
    text to learn from all scores come from the labellers alone. ``labels`` (id, toxic) may name toxic documents
    whose words one more labeller looks for. Columns named like the results are replaced.
    Texts of any length are scored whole. Empty in, empty out.
    """
    scorers = scorers or fit(docs, targets(docs, labels, id_col, text), id_col, text)
    names = list(scorers)
    new = ["score", "keep", *names, *(f"weak_{k}" for k in names)]
    keep = passed_columns(docs, new)
    labellers = {k: m.labellers for k, m in scorers.items()}
    # plain values, of a size that the number of buckets bounds
    shared = docs.sparkSession.sparkContext.broadcast({k: (m.weak.table, m.weak.prior, m.weights) for k, m in scorers.items()})
    ddl = "score double, keep boolean, " + ", ".join(f"{k} double" for k in new[2:])

    def run(batches):
        models = {k: Scorer(labellers[k], WeakLabels(t, p), w) for k, (t, p, w) in shared.value.items()}
        buckets = len(next(iter(models.values())).weights) - 1
        for b in sliced(batches, 1 << 25, text):
            some, votes, line = [], {k: [] for k in models}, {k: [] for k in models}
            for x in binary_list(b.column(text)):  # one text's words at a time
                t = Text.of(x)
                some.append(bool(t.words))
                at = features(t, buckets)
                for k, m in models.items():
                    votes[k].append([int(c) for c in votes_of(t, m.labellers)])
                    line[k].append(m.score(at))
            out = {}
            for k, m in models.items():
                weak = m.weak.posterior(np.array(votes[k]))
                both = (weak + np.array(line[k])) / 2 if m.weights.any() else weak
                out[k], out[f"weak_{k}"] = np.where(some, both, 0.0), np.where(some, weak, 0.0)
            score = np.prod([out[k] for k in names], axis=0)
            ok = np.all([out[k] >= least for k in names], axis=0)
            cols = {"score": score, "keep": ok, **{k: out[k] for k in new[2:]}}
            yield with_columns(b, keep, {k: pa.array(v) for k, v in cols.items()})

    return docs.mapInArrow(run, schema_of(docs, keep, ddl))
