import random

import numpy as np
import pytest

from lexloom.llm import bpe, repair
from lexloom.llm.queries import bpe_digests
from lexloom.llm.vocabulary import Vocabulary, vocabulary

ALPHABETS = [
    ["a", "b", "th", "in", " ", "'", "s", "1", ",", "\n", "  "],
    list("abcdefghijklmnopqrstuvwxyz"),
    ["the", "ing", "tion", "er"],
    list("0123456789"),
    list("!?.,-=*#'"),
    ["日", "本", "。", "a"],
    [" ", "\n", "\t", " a"],
    ["<|endoftext|>", "a", " ", "endoftext|>", "<|"],
    ["'", "s", "ll", "'re", "💩", "​", "\x1c", "᠎"],
]


def expected(vocab, text):
    return vocab.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("letters", ALPHABETS)
def test_tree_concatenation_equals_the_library(vocabulary_path, letters, monkeypatch):
    monkeypatch.setattr("lexloom.llm.vocabulary._FEW_CHARS", 0)
    vocab, rng = vocabulary(vocabulary_path), random.Random(len(letters))
    for _ in range(60):
        text = "".join(rng.choices(letters, k=rng.choice([0, 3, 20, 200])))
        assert np.frombuffer(vocab.encode_all([text])[0], "<u4").tolist() == expected(vocab, text)
        pieces = bpe.cut(text, rng.choice([2, 5, 33]), list(vocab.specials))
        ids = [np.frombuffer(i, "<u4") for i in vocab.encode_all([p for _, p in pieces])]
        joined = bpe.assemble([(j, t.encode(), i) for (j, t), i in zip(pieces, ids)], vocab)
        assert joined.tolist() == expected(vocab, text)
        assert vocab.decode(joined) == text


def test_decode_of_any_ids(vocabulary_path):
    vocab, rng = vocabulary(vocabulary_path), random.Random(1)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(6)]
        assert vocab.decode(np.array(ids)) == vocab.tokenizer.decode(ids, skip_special_tokens=False)


def test_round_trip_of_odd_texts(spark, odd_docs, no_docs, vocabulary_path):
    vocab = vocabulary(vocabulary_path)
    encoded = bpe.bpe_encode(odd_docs, vocabulary_path, leaf_chars=64)
    found = sorted((r.doc_id is None, r.doc_id, list(r.ids)) for r in encoded.collect())
    want = sorted((r.doc_id is None, r.doc_id, expected(vocab, r.text or "")) for r in odd_docs.collect())
    assert found == want
    back = bpe.bpe_decode(encoded, vocabulary_path).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r.doc_id), r.text or "") for r in odd_docs.collect())
    assert bpe_digests(no_docs, vocabulary_path).count() == 0


def test_grammar_decodes_whole_texts_and_ranges():
    rng = np.random.default_rng(2)
    texts = [rng.choice([5, 6, 7, 300], rng.integers(1, 4000), p=[0.5, 0.3, 0.1, 0.1]).astype("<u4") for _ in range(20)] + [np.full(999, 4, "<u4")]
    shard = repair.Shard(repair.pack([*range(20), None], [t.tobytes() for t in texts], 50_258))
    assert len(shard.rules) > 50 and shard.keys[-1] is None and len(shard._low) < sum(map(len, texts)) / 2
    for k, text in enumerate(texts):
        assert shard.text(k).tolist() == text.tolist()
        for a, b in ((0, 1), (len(text) // 3, len(text) // 2), (len(text) - 1, len(text)), (5, 5)):
            assert shard.slice(k, a, b).tolist() == text[a:b].tolist()


@pytest.mark.parametrize("shard_tokens", [50, repair.SHARD_TOKENS])
def test_shards_of_odd_texts(spark, odd_docs, no_docs, vocabulary_path, monkeypatch, shard_tokens):
    monkeypatch.setattr(repair, "SHARD_TOKENS", shard_tokens)
    vocab = vocabulary(vocabulary_path)
    found = repair.read_token_shards(repair.write_token_shards(odd_docs, vocabulary_path, 2)).collect()
    found.sort(key=lambda r: r.start)
    assert [r.id for r in found] == sorted((r.id for r in found), key=lambda i: (i is not None, i))
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    # Id by id.
    want = [(str(r.doc_id), [*expected(vocab, r.text or ""), 2]) for r in odd_docs.collect()]
    assert sorted((str(r.id), np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in found) == sorted(want)
    assert repair.read_token_shards(repair.write_token_shards(no_docs, vocabulary_path, 2)).count() == 0


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(5)
    for alphabet, size in ((3, 5000), (40, 60_000), (2000, 200_000), (1, 900)):
        ids = (rng.zipf(1.5, size) % alphabet).astype("<u4")
        starts = np.unique(np.append(0, rng.integers(0, size, 20)))
        symbols, first, rules = repair.compress(ids, starts, 5000)
        inner = np.ones(len(symbols), bool)
        inner[first] = False
        pairs = np.stack([symbols[:-1], symbols[1:]], 1)[inner[1:]]
        found, counts = np.unique(pairs, axis=0, return_counts=True)
        # Only a pair of equal symbols can be frequent and yet not replaced: its places overlap.
        assert all(a == b for a, b in found[counts >= repair.LEAST_COUNT].tolist())
        lengths = repair.expansion_lengths(rules, 5000)
        assert sum(1 if s < 5000 else lengths[s - 5000] for s in symbols.tolist()) == size


@pytest.mark.parametrize("top", [1, 60_000, 2**16, 2**20 + 5, 2**30])
def test_symbols_take_the_bits_they_need(top):
    symbols = np.random.default_rng(1).integers(0, top, 1001).astype(np.uint32)
    bits = (top - 1).bit_length()
    shard = repair.Shard.__new__(repair.Shard)
    packed = repair.pack_bits(symbols, bits)
    assert len(packed) <= 2 * 1001 + max(0, bits - 16) * 126
    shard._low = np.frombuffer(packed, "<u2", 1001)
    shard._planes = [np.frombuffer(packed, "u1", 126, 2002 + 126 * k) for k in range(max(0, bits - 16))]
    for lo, hi in ((0, 1001), (3, 4), (7, 900), (500, 500)):
        assert shard.symbols(lo, hi).tolist() == symbols[lo:hi].tolist()


def test_pieces_equal_the_library(vocabulary_path, monkeypatch):
    """Words merged by ranks, words across line ends, and short texts that go through the library."""
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column(0).to_pylist()
    vocab, rng = Vocabulary(vocabulary_path), random.Random(3)
    words = sorted({w for t in texts for w in (t or "").split()})
    made = [rng.choice(words) + rng.choice(["", "\n", ".\n", "\n\n", "'\n", "\nß", "\n1"]) + rng.choice(words) for _ in range(500)]
    every = [t or "" for t in texts] + [" ".join(made[k : k + 20]) for k in range(0, 500, 20)]
    want = [expected(vocab, t) for t in every]
    assert vocab._merge
    for few, together in ((0, 20_000), (0, 7), (20_000, 20_000)):
        monkeypatch.setattr("lexloom.llm.vocabulary._FEW_CHARS", few)
        monkeypatch.setattr("lexloom.llm.vocabulary._WORDS_TOGETHER", together)
        for at in range(0, len(every), 30):
            assert [np.frombuffer(i, "<u4").tolist() for i in vocab.encode_all(every[at : at + 30])] == want[at : at + 30]
