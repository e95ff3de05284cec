import random

import brute
import numpy as np
import pytest

from tessera.llm import sadedup as S
from tessera.llm.common import table
from tessera.llm.queries import op6_repeats


def results(df):
    return {r[0]: (*tuple(r)[1:4], brute.sha(bytes(r.kept))) for r in df.collect()}


def test_query_matches_brute_force(spark):
    rows = sorted(tuple(r) for r in table(spark, brute.SF, "documents").select("doc_id", "text").collect())
    want = brute.repeats(rows)
    assert {r[0]: tuple(r)[1:] for r in op6_repeats(spark, brute.SF).collect()} == want
    assert sum(v[1] for v in want.values()) > 0


@pytest.mark.parametrize("v", S.COVERS)
def test_covers(v):
    assert {(a - b) % v for a in S.COVERS[v] for b in S.COVERS[v]} == set(range(v))


def corpus(seed, length):
    rng = random.Random(seed)
    piece = lambda n, a="abcdé": "".join(rng.choice(a) for _ in range(n))
    common = [piece(rng.randint(length // 2, 3 * length)) for _ in range(6)]
    rows = [(k, "".join(rng.choice([rng.choice(common), piece(rng.randint(0, length))]) for _ in range(rng.randint(0, 6)))) for k in range(40)]
    rows += [(50, rows[3][1]), (51, rows[3][1]), (52, None), (53, ""), (54, "a" * 5 * length), (55, "ab" * 3 * length), (56, common[0] * 3)]
    return rows


@pytest.mark.parametrize("length,chunk,hot", [(100, 400, 2000), (100, 1 << 20, 1_000_000), (20, 700, 3)])
def test_chunks_and_common_grams(spark, monkeypatch, length, chunk, hot):
    monkeypatch.setattr(S, "LOCAL", 1)  # every gram may count as common: both kinds of rows are sent
    rows = corpus(length + hot, length)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert results(S.remove_repeats(df, length, chunk_bytes=chunk, hot=hot)) == brute.repeats(rows, length)


def test_null_and_repeated_ids_and_clashing_columns(spark):
    rng = random.Random(1)
    t = "".join(rng.choice("abcdefgh") for _ in range(150))
    rows = [(None, t, "x"), (7, t, None), (7, t, "y"), (None, "short", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string").coalesce(1)
    got = sorted((tuple(r)[:4] for r in S.remove_repeats(df).collect()), key=repr)
    assert got == sorted([(7, 150, 0, 0), (7, 150, 150, 1), (None, 150, 150, 1), (None, 5, 0, 0)], key=repr)
    assert S.remove_repeats(df.limit(0)).count() == 0


def test_rolling_hashes_tell_strings_apart_across_slices(monkeypatch):
    monkeypatch.setattr(S, "_SLICE", 64)
    data = np.frombuffer(b"abracadabra" * 40, np.uint8)
    h = S.Rolling(1, 64 + 30).at(data, np.arange(len(data) - 19), 20)
    by = {}
    for p, x in enumerate(h.tolist()):
        assert by.setdefault(x, data[p:p + 20].tobytes()) == data[p:p + 20].tobytes()
    assert len(by) == 11


def thue_morse(n, a="a", b="b"):
    return "".join(b if k.bit_count() % 2 else a for k in range(n))


@pytest.mark.parametrize("length", [1024, 2048])
@pytest.mark.parametrize("hot", [2000, 1_000_000])
def test_strings_whose_hashes_agree_stay(spark, monkeypatch, length, hot):
    # polynomial hashes modulo 2**64 agree on a Thue-Morse string and its complement, whatever their base
    monkeypatch.setattr(S, "LOCAL", 1)
    t, c = thue_morse(length), thue_morse(length, "b", "a")
    roll = S.Rolling(2, length + 4096)
    assert len({int(roll.at(np.frombuffer(x.encode(), np.uint8), np.zeros(1, int), length)[0]) for x in (t, c)}) == 1
    rows = [(1, t), (2, c), (3, t[:-1] + "x"), (4, c[:-1] + "x"), (5, "y" + c), (6, t * 2)]
    for parts in (1, 8):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert results(S.remove_repeats(df, length, hot=hot)) == brute.repeats(rows, length)


def test_equal_hashes_are_no_equal_strings(monkeypatch):
    class Same:
        def at(self, data, pos, size):
            return np.zeros(len(pos), np.uint64)

    monkeypatch.setattr(S, "_rolling", lambda seed, size: Same())
    text = b"abcabdabcxyzabd" + b"...abc"
    c = S.Chunk({"chunk": 0, "ids": [1], "sizes": [len(text)], "data": text})
    first, more, _ = S._distinct(c, np.array([0, 3, 6, 9, 12, 18]), 3)
    assert (first.tolist(), more.tolist()) == ([0, 1, 3, 4], [6, 18])


@pytest.mark.parametrize("length", [10, 23, 100, 300, 1100])
def test_suffixes_are_sorted_by_their_bytes(length):
    rng = random.Random(length)
    plan = S.Plan(length)
    words = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(1, 2 * length))) for _ in range(5)]
    for alphabet in (b"a", b"ab", b"\x00\x7f\x80\xff"):
        text = b"".join(rng.choice([rng.choice(words), bytes(rng.choice(alphabet) for _ in range(rng.randint(0, length)))]) for _ in range(30))
        text += thue_morse(2 * length).encode()
        pos = np.array(sorted(rng.sample(range(len(text) - length + 1), len(text) // 2)))
        pos = pos[pos <= len(text) - length]
        order, cut = S.sort_suffixes(np.frombuffer(text, np.uint8), pos, plan)
        got = [text[p:p + length] for p in pos[order]]
        assert got == sorted(got) and sorted(order.tolist()) == list(range(len(pos)))
        assert cut.tolist() == [k == 0 or got[k] != got[k - 1] for k in range(len(got))]
