import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from attestra.llm import bpe, packing, tokens, unigram

SIGNS = "aabbcde  \n\t'stre.,!?0123éñß漢字😀​ \x1c\x85▁"


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts(rng):
    out = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return [*out, "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "a" * 3000, "ab" * 2000, "", " " * 500, "".join(rng.choice("etaoinshr") for _ in range(5000))]


def test_encoders_equal_the_library_and_round_trip(rng, reference):
    path = tokens.default_vocabulary()
    mine, fast = bpe.encoder(path), tokens.fast_encoder(path)
    for t in texts(rng):
        ids = reference.encode(t, add_special_tokens=False).ids
        assert mine.encode(t).tolist() == ids
        assert fast(t).tolist() == ids
        assert mine.decode(np.array(ids)) == reference.decode(ids, skip_special_tokens=False)


def test_every_character_is_split_as_the_library_splits_it(reference):
    path = tokens.default_vocabulary()
    mine, fast = bpe.encoder(path), tokens.fast_encoder(path)
    some = [*range(0x3000), *range(0xD7F0, 0xD800), *range(0xE000, 0xE010), *range(0xFE00, 0x10100), 0x1F600, 0xE0001]
    samples = [f"a{chr(c)}b 1{chr(c)}2 {chr(c)} {chr(c)}{chr(c)}!" for c in some]
    for x, e in zip(samples, reference.encode_batch(samples, add_special_tokens=False), strict=True):
        assert mine.encode(x).tolist() == e.ids and fast(x).tolist() == e.ids


def test_very_long_runs(spark, reference, monkeypatch):
    """A million spaces go through; where the library can do it, parts encoded apart equal the whole."""
    path = tokens.default_vocabulary()
    fast, mine = tokens.fast_encoder(path), bpe.encoder(path)
    for run in (" " * 1_000_000, "\n" * 1_000_000, "a" * 300_000, "!" * 300_000, "1" * 300_000, " a" * 300_000):
        for t in (run, run + "x", "y" + run, f"y{run}<|endoftext|>{run}z"):
            assert fast(t).tolist() == mine.encode(t).tolist()
    docs = spark.createDataFrame([(1, " " * 1_000_000 + "x"), (2, "a")], "doc_id long, text string")
    assert {r.doc_id for r in packing.pack(docs, keep_ids=False).collect()} == {1, 2}
    assert bpe.round_trip_digests(docs).where("doc_id = 1").first().n_tokens == len(mine.encode(" " * 1_000_000 + "x"))
    monkeypatch.setattr(tokens, "LONG_TEXT", 0)
    monkeypatch.setattr(tokens, "LONG_RUN", 2)
    for t in ("", "  ", "a  b", "a \n b\n\n", "x   <|endoftext|>   y", "  <|endoftext|>", "a\t\t\tb  <|endo", " \x1c\x85 1 ", "'s  's   !"):
        assert fast(t).tolist() == reference.encode(t, add_special_tokens=False).ids, t


def test_bpe_edges(spark, edge_docs, no_docs, reference):
    got = bpe.round_trip_digests(edge_docs).collect()
    want = []
    for r in edge_docs.select("doc_id", "text").collect():
        ids = reference.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(r.text or "")))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.round_trip_digests(no_docs).count() == 0
    back = bpe.decode(bpe.encode(edge_docs)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r.doc_id), r.text or "") for r in edge_docs.select("doc_id", "text").collect())


def test_unigram_counts_equal_the_library(rng, edge_docs, no_docs):
    pieces = unigram.read_pieces(unigram.default_vocabulary())
    lib = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    lib.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always")
    c = unigram.Counter(pieces)
    for t in texts(rng):
        assert c.count(t)[1] == len(lib.encode(t).tokens), t
    for _ in range(1500):
        t = "".join(rng.choice("ab the ▁ ▁▁.é漢") for _ in range(rng.randint(0, 14)))
        assert c.count(t)[1] == len(lib.encode(t).tokens), t
    small = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("▁a", -2.0), ("aba", -3.0)]  # ties
    lib = Tokenizer(models.Unigram([("<unk>", 0.0), *small], 0, False))
    lib.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always")
    c = unigram.Counter(small)
    for _ in range(500):
        t = "".join(rng.choice("aabbc ▁") for _ in range(rng.randint(1, 12)))
        assert c.count(t)[1] == len(lib.encode(t).tokens), t
    got = {(r.doc_id, r.n_tokens) for r in unigram.count_tokens(edge_docs).collect()}
    assert (1, 0) in got and (2, 0) in got and unigram.count_tokens(no_docs).count() == 0
    with pytest.raises(ValueError):
        unigram.Counter([])


def check_packing(rows, docs, reference, limit=1024, segments=packing.MAX_SEGMENTS):
    ids = {}
    for r in docs:
        ids.setdefault(r.doc_id, []).append([*reference.encode(r.text or "", add_special_tokens=False).ids, 0])
    sequences, pieces = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        pieces.setdefault(r.doc_id, []).append(r)
        assert any(x[r.start : r.start + r.length] and zlib.crc32(np.array(x[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 and len(x) == r.doc_tokens for x in ids[r.doc_id])
    for d, lists in ids.items():
        assert sum(r.length for r in pieces[d]) == sum(map(len, lists))
        starts = sorted((r.start, r.start + r.length) for r in pieces[d])
        if len(lists) == 1:
            assert starts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(starts, starts[1:], strict=False))
    used = held = 0
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        at = 0
        for r in s:
            assert r.offset == at
            at += r.length
        assert at <= limit and len(s) <= segments
        used += at
        held += at if at & (at - 1) == 0 else limit
    return held / used


def test_packing(spark, edge_docs, no_docs, reference):
    rows = packing.pack(edge_docs).collect()
    assert check_packing(rows, edge_docs.collect(), reference) < 1.2
    assert packing.pack(no_docs).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert check_packing(packing.pack(docs, keep_ids=False).collect(), docs.collect(), reference) < 1.01


def test_packing_keeps_all_limits(rng):
    for _ in range(50):
        limits = {"max_tokens": rng.choice([8, 64]), "max_segments": rng.choice([1, 2, 5]), "max_loss": rng.choice([4, 8]), "window": rng.choice([1, 3, 20])}
        out = []
        p = packing.Packer(lambda o, s, i, q, at: out.append((o, s, i, q, at)), 0, **limits)
        docs = [(k, np.arange(rng.randint(1, 150)), rng.randint(0, 60)) for k in range(rng.randint(0, 20))]
        for d in docs:
            p.add(*d)
        p.finish()
        by = {}
        for o, s, i, q, at in out:
            by.setdefault(q, []).append((o, s, len(i)))
        prompt = {k: n for k, _, n in docs}
        for pieces in by.values():
            assert sum(n for *_, n in pieces) <= limits["max_tokens"] and len(pieces) <= limits["max_segments"]
            assert sum(max(0, s + n - max(s, prompt[o])) for o, s, n in pieces) <= limits["max_loss"]
        for k, ids, _ in docs:
            assert sorted(x for o, _, i, *_ in out if o == k for x in i.tolist()) == ids.tolist()
    with pytest.raises(ValueError):
        packing.Packer(print, 0, max_tokens=0)


def test_turns_are_packed_under_a_loss_limit(spark):
    sf = "/root/testdata/sf0.001"
    turns = {r.conv_id * (1 << 20) + r.turn: r for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    rows = packing.pack_turns(spark, sf).collect()
    tokens_in, loss, whole = {}, {}, {}
    for r in rows:
        tokens_in[r.sequence_id] = tokens_in.get(r.sequence_id, 0) + r.length
        loss[r.sequence_id] = loss.get(r.sequence_id, 0) + r.length * (turns[r.doc_id].role == "assistant")
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert set(whole) == set(turns) and max(tokens_in.values()) <= 1024 and 256 < max(loss.values()) <= 512
