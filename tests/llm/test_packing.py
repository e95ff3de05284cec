import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest

from tessera.llm import packing as P
from tessera.llm.common import table
from tessera.llm.queries import op9_packing


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.tokenizer_file())
    t.encode_special_tokens = True
    return t


def checked(pieces, docs, tok, tokens=2048, segments=64):
    """Every id of every row in exactly one piece, sequences gapless and within the limits; padding share."""
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t in docs}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id])
        want = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(want.tobytes())
    assert by_doc.keys() == ids.keys()
    for i, rs in by_doc.items():
        at = 0
        for r in sorted(rs, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[i])
    held = padded = 0
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= tokens and len(rs) <= segments
        held += at
        padded += 0 if at & (at - 1) == 0 else tokens - at
    return padded / held


def test_query_is_an_exact_round_trip(spark, tok):
    docs = [tuple(r) for r in table(spark, brute.SF, "documents").select("doc_id", "text").collect()]
    assert checked(op9_packing(spark, brute.SF).collect(), docs, tok) < 0.01


def test_edges(spark, tok):
    texts = [None, "", " ", "a  b \n c's <|endoftext|> é 中文 \x00\x1c", "word " * 30_000, "x" * 5000, "short"] + ["tiny"] * 300
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, ids string").repartition(3)
    assert checked(P.pack(df, P.tokenizer_file()).collect(), docs, tok) < 0.2
    got = P.pack(df, P.tokenizer_file(), tokens=100, segments=3, pool=8).collect()
    checked(got, docs, tok, 100, 3)
    assert all([r.ids[0] is not None and len(r.ids) == r.length for r in got])
    assert P.pack(df.limit(0), P.tokenizer_file()).count() == 0
    twice = spark.createDataFrame([(None, "one two"), (None, "one two")], "doc_id long, text string")
    assert sum(r.length for r in P.pack(twice, P.tokenizer_file()).collect()) == 6


def test_limits_hold_together():
    rng = np.random.default_rng(1)
    p = P.Packer(tokens=64, segments=5, loss=40, pool=20)
    out, want = [], {}
    for k in range(200):
        n = int(rng.integers(1, 150))
        loss = rng.random(n) < rng.random()
        want[k] = (np.arange(n), loss)
        out += p.add(P.Example(k, np.arange(n), loss, 0, n))
    out += p.finish()
    seqs, parts = defaultdict(list), defaultdict(list)
    for k, total, start, ids, s, offset in out:
        seqs[s].append((k, start, len(ids)))
        parts[k].append((start, len(ids)))
        assert offset == sum(n for *_, n in seqs[s][:-1]) and (ids == np.arange(start, start + len(ids))).all()
    for rows in seqs.values():
        assert sum(n for *_, n in rows) <= 64 and len(rows) <= 5
        assert sum(want[k][1][s:s + n].sum() for k, s, n in rows) <= 40
    for k, rows in parts.items():
        at = 0
        for s, n in sorted(rows):
            assert s == at
            at += n
        assert at == len(want[k][0])


def test_special_tokens_as_the_tokenizer_has_them(spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    plain = Tokenizer.from_file(P.tokenizer_file())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "x  <|endoftext|>  \n y", "<|endoftext", "é<|endoftext|>é", None, ""]
    enc = P.Encoder(P.tokenizer_file(), specials=True)
    assert enc.encode(texts[0]).tolist() == [64, 220, 50256, 275]
    rng = np.random.default_rng(2)
    parts = ["<|endoftext|>", "<|", "|>", " ", "  ", "\n", "'s", "it", "12", "é", "中", "endoftext"]
    texts += ["".join(rng.choice(parts, int(rng.integers(1, 20)))) for _ in range(200)]
    for t in texts:
        assert enc.encode(t).tolist() == plain.encode(t or "", add_special_tokens=False).ids, t
    schema = table(spark, brute.SF, "documents").schema
    rows = [tuple({"doc_id": i, "text": t}.get(f.name) for f in schema) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for out in (op9_packing(spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, df, str(tmp_path))):
        checked(out.collect(), list(enumerate(texts)), plain, segments=2048)


def test_short_texts_fill_their_sequences(spark, tok, tmp_path):
    import corpus_pipeline
    rng = np.random.default_rng(3)
    texts = ["word " * int(rng.integers(4, 29)) + "end" for _ in range(3000)] + [None] * 5000
    schema = table(spark, brute.SF, "documents").schema
    docs = list(enumerate(texts))
    df = spark.createDataFrame([tuple({"doc_id": i, "text": t}.get(f.name) for f in schema) for i, t in docs], schema)
    df.repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    df = table(spark, str(tmp_path), "documents")
    for out in (op9_packing(spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, df, str(tmp_path))):
        assert checked(out.collect(), docs, tok, segments=2048) == 0


@pytest.mark.parametrize("segments", [1, 2, 5, 64, 2048])
def test_what_is_left_needs_no_padding(segments):
    rng = np.random.default_rng(segments)
    for _ in range(200):
        p = P.Packer(tokens=2048, segments=segments, pool=1 << 30)
        sizes = rng.integers(1, rng.choice([3, 30, 300, 5000]), int(rng.integers(1, 200)))
        for k, n in enumerate(sizes):
            assert not list(p.add(P.Example(k, np.arange(n), None, 0, n)))
        held, n_pieces = defaultdict(int), defaultdict(int)
        for *_, ids, s, _ in p.finish():
            held[s] += len(ids)
            n_pieces[s] += 1
        assert p.held == 0 and sum(held.values()) == sizes.sum()
        assert all(n & (n - 1) == 0 and n <= 2048 for n in held.values()) and max(n_pieces.values()) <= segments


def test_long_examples_wait_in_bounded_memory():
    p = P.Packer(tokens=64, segments=64, loss=64, pool=8)
    for k in range(300):
        list(p.add(P.Example(k, np.arange(1000), None, 0, 1000)))
        assert p.held == sum(p.sizes) <= 8 * 64 and len(p.waiting) <= 64


def test_loss_starts_where_the_column_says(spark):
    enc = P.Encoder(P.tokenizer_file())
    assert enc.bears("é one two", np.append(enc.encode("é one two"), 1), 5).tolist() == [False] * (len(enc.encode("é one"))) + [True, True]
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(rng.choice(["é", "word", "of", "中文"], 60)), int(rng.integers(0, 300)) if k % 5 else None) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, skip int")
    mask = {}
    for k, t, skip in rows:
        at, ids, data = 0, enc.encode(t).tolist(), t.encode()
        n, mask[k] = len(t[:skip or 0].encode()), []
        for i in ids:
            at += len(enc.bpe.decode_single_token_bytes(i))
            mask[k].append(at > n)
        assert at == len(data)
        mask[k].append(True)
    assert not all(map(all, mask.values()))
    by_seq, seen = defaultdict(list), 0
    for r in P.pack(df, P.tokenizer_file(), tokens=256, loss=100, loss_from="skip").collect():
        by_seq[r.sequence_id].append((r.length, sum(mask[r.doc_id][r.start:r.start + r.length])))
        seen += r.length
    assert seen == sum(map(len, mask.values()))
    assert all(sum(n for n, _ in x) <= 256 and sum(n for _, n in x) <= 100 for x in by_seq.values())
    assert any(sum(n for n, _ in x) > 100 for x in by_seq.values())


def test_runs_of_blanks_and_letters_of_any_length(spark, monkeypatch):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(P.tokenizer_file())
    enc = P.Encoder(P.tokenizer_file(), specials=True)
    n = 1_200_000
    for t in (" " * n + "a", "\n" * n, "x" + "\t \u3000" * (n // 3) + " 12", " " * n + "<|endoftext|> " + "\n" * n, "a" * n, " \x1c" * n):
        assert enc.encode(t).tolist() == plain.encode(t, add_special_tokens=False).ids
    rows = [(0, "head" + " " * n + "tail"), (1, "b")]
    got = P.pack(spark.createDataFrame(rows, "doc_id long, text string"), P.tokenizer_file(), segments=2048, specials=True).collect()
    assert checked(got, rows, plain, segments=2048) == 0
    # the same cut, at every place and length
    monkeypatch.setattr(P, "_RUNS", P.re.compile(f"[{P.WHITE}]{{2,}}"))
    rng = np.random.default_rng(7)
    parts = ["<|endoftext|>", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x85", "\xa0", "\u2003", "\x1c", "'s", "it", "12", "é", "中", "!?"]
    for _ in range(2000):
        t = "".join(rng.choice(parts, int(rng.integers(1, 12))))
        assert enc.encode(t).tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_ids_must_follow_the_merges():
    data = P.json.loads(P.file_bytes(P.tokenizer_file()))
    merges = data["model"]["merges"]
    merges[5], merges[900] = merges[900], merges[5]
    with pytest.raises(ValueError, match="order of the merges"):
        P.Encoder(P.json.dumps(data).encode())
