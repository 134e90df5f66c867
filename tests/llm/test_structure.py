"""Conversations, token counts and the Merkle manifest against plain definitions."""

import hashlib
import random
import re
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest

from lexloom.llm import conversation, tokencounts
from lexloom.llm.merkle import digest_of, merkle_manifest, proof_digest
from lexloom.llm.tokencounts import count_tokens
from lexloom.llm.transducer import Transducer, Transitions, transducer
from pyspark.sql import functions as F


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- conversations


def plain_repair(rows):
    """All columns of one conversation, from (turn, role, text) in any order, by a forward search over (cost, edits)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(r[2])))
    turns = [t for t, _, _ in rows if t is not None]
    counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    seen, faults = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
        if fault:
            counts[fault] += 1
    takes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    opens = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def inserted(found):
        for _ in range(3):
            for state, (cost, audit, lines) in list(found.items()):
                role = opens[state]
                option = (cost + 5, audit + "I", [*lines, role + ":"])
                found[role[0]] = min(found.get(role[0], option), option)
        return found

    states = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for state, (cost, audit, lines) in states.items():
            options = [(state, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                options.append((opens[state][0], (cost + 1 + extra, audit + "R", [*lines, opens[state] + ":" + text])))
                if (state, role[:1]) in takes:
                    options.append((takes[state, role[:1]], (cost + extra, audit + "K", [*lines, role + ":" + text])))
            for to, option in options:
                new[to] = min(new.get(to, option), option)
        states = inserted(new)
    cost, audit, lines = min(states[s] for s in ("", "a") if s in states)
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *counts.values(), illegal, cost, audit, sha("\n".join(lines)))


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "cut off", " \t\n", "", None, "Why?  ", "so. ", "a.b", "long " * 50 + "end."]
    return [(rng.choice([None, *range(2 * n)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("block_rows, direct_rows", [(conversation.BLOCK_ROWS, conversation.DIRECT_ROWS), (7, 10)])
def test_conversations_equal_a_plain_search(spark, monkeypatch, block_rows, direct_rows):
    monkeypatch.setattr(conversation, "DIRECT_ROWS", direct_rows)
    rng = random.Random(4)
    rows = [(conv, *row, "x", 1) for conv in [None, *range(30)] for row in random_rows(rng, rng.choice([1, 2, 5, 9, 40]))]
    rows += [(99, *row, "x", 1) for row in random_rows(rng, 300)]  # a third of all rows
    rows += rows[:20]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string, digest int")
    found = {r.conv_id: tuple(r)[1:] for r in conversation.repair_conversations(df, block_rows=block_rows).collect()}
    rows.sort(key=lambda r: str(r[0]))
    want = {conv: plain_repair([r[1:4] for r in group]) for conv, group in groupby(rows, key=lambda r: r[0])}
    assert found == want
    assert conversation.repair_conversations(df.limit(0), block_rows=block_rows).count() == 0


def test_blocks_compose_to_the_whole():
    rng = random.Random(8)
    for _ in range(300):
        codes = "".join(rng.choices("suaxSUAX-", k=rng.randrange(30)))
        whole, vector = conversation.edits(codes)[0], conversation.vector_before(codes, conversation.END)
        cut = rng.randrange(len(codes) + 1)
        behind = conversation.vector_before(codes[cut:], conversation.END)
        costs = conversation.block_costs(codes[:cut])
        assert [min(c + b for c, b in zip(row, behind)) for row in costs] == vector
        letters, state = conversation.edits(codes[:cut], behind, last=False)[0]
        assert letters + conversation.edits(codes[cut:])[state][0] == whole[0]


def test_a_conversation_that_is_right_stays(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello.")]
    found = conversation.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert found.audit == "KKK" and found.cost == 0
    assert found.repaired_sha256 == sha("system:Be kind.\nuser:Hi!\nassistant:Hello.")


# -- token counts

PARTS = ["a", "b", "the", "ing", "'", "'s", "'re", "'ll", "'v", "s", "ll", " ", "  ", "\n", "\t", "1", "42", "½", "!", "...", "é", "ß", "日本", "💩", "न", "नि", "\x1c", "\x85", "᠎", "​", "<|endoftext|>", "<|endo", "<", "|>"]


@pytest.fixture(scope="module")
def library(vocabulary_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_the_transducer_counts_as_the_library(vocabulary_path, library, monkeypatch):
    machine, rng = transducer(vocabulary_path), random.Random(6)
    for alphabet in (PARTS, list("abcdefghij"), list("ab' \n"), ["a"], [" "], ["=", "-", "*"], ["<|endoftext|>", "<", "|", "x"]):
        for _ in range(300):
            text = "".join(rng.choices(alphabet, k=rng.choice([0, 1, 4, 30, 120])))
            assert machine.count(text) == library(text), repr(text)
    # After every character the sum is that of the text so far, also from a state that was named and found again.
    text = "".join(rng.choices(PARTS, k=60))
    state, total = machine.start, 0
    for at, c in enumerate(text, 1):
        state, gained = machine.walk(machine.state(machine.key(state)), c)
        total += gained
        assert total == library(text[:at])
    # Forgetting changes nothing.
    monkeypatch.setattr("lexloom.llm.transducer.STATES_KEPT", 40)
    monkeypatch.setattr("lexloom.llm.transducer.WORDS_KEPT", 3)
    small = Transducer(vocabulary_path)
    for _ in range(50):
        text = " ".join("".join(rng.choices(PARTS, k=3)) for _ in range(20))
        assert small.count(text) == library(text)


@pytest.mark.parametrize("guesses", [1, tokencounts.GUESSES])
def test_state_maps_of_chunks_compose(vocabulary_path, library, monkeypatch, guesses):
    monkeypatch.setattr(tokencounts, "GUESSES", guesses)
    machine, rng, missed = transducer(vocabulary_path), random.Random(9), 0
    for alphabet in (PARTS, list("abcdefgh"), ["a"], ["ab", "c"], [" "], ["\n", " "], ["日"], ["<|endoftext|>", "x"]):
        for _ in range(6):
            text, size = "".join(rng.choices(alphabet, k=900)), rng.choice([40, 300])
            total = None
            for at in range(0, len(text), size):
                step, certain = tokencounts.state_map(machine, text[max(0, at - tokencounts.LOOK_BACK) : at], at <= tokencounts.LOOK_BACK, text[at : at + size])
                total = step if total is None else tokencounts.compose(total, step, certain)
            if total:
                assert [n for _, n in total.values()] == [library(text)]
            else:
                missed += 1
    assert missed < 12


def test_counts_of_odd_texts(spark, odd_docs, no_docs, vocabulary_path, library, monkeypatch):
    rng = random.Random(2)
    long = spark.createDataFrame([(100 + k, "".join(rng.choices("abcdefg", k=3000))) for k in range(4)] + [(104, " \n" * 900), (104, " \n" * 900)], "doc_id long, text string")
    docs = odd_docs.unionByName(long, allowMissingColumns=True)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), library(r.text)) for r in docs.collect())
    for chunk, guesses, fan in ((64, 8, 512), (64, 1, 8), (16, 8, 16), (tokencounts.CHUNK_CHARS, 8, 512)):
        monkeypatch.setattr(tokencounts, "GUESSES", guesses)
        monkeypatch.setattr(tokencounts, "FAN", fan)
        found = count_tokens(docs, vocabulary_path, chunk_chars=chunk)
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found.collect()) == want, chunk
    assert count_tokens(no_docs, vocabulary_path).count() == 0


def test_texts_read_side_by_side_are_read_as_alone(vocabulary_path, library, monkeypatch):
    monkeypatch.setattr("lexloom.llm.transducer._WORDS_TOGETHER", 3)
    rng, machine = random.Random(8), transducer(vocabulary_path)
    texts = ["", " ", "  ", "a", "a ", " a", "x\0 \0 y", "word " * 50, "z" * 40 + " and " + "ab" * 30 + " end", "<|endo ftext|> <|endoftext|> a <|endoftext|>"]
    for alphabet in (PARTS, ["the", "ing", " ", " ", "s", ",", "\n"], [" "], [" ", "日本", "a"]):
        texts += ["".join(rng.choices(alphabet, k=rng.choice([3, 20, 200]))) for _ in range(40)]
    for kept in (200_000, 40):  # forgetting changes nothing
        monkeypatch.setattr("lexloom.llm.transducer.STATES_KEPT", kept)
        small = Transducer(vocabulary_path)
        found = small.walk_all([small.start] * len(texts), pa.array(texts))
        assert [n for _, n in found] == [library(t) for t in texts]
        assert [small.key(s) for s, _ in found] == [machine.key(machine.walk(machine.start, t)[0]) for t in texts]
    # Nor does it matter which texts are together, or that one is too long for it.
    monkeypatch.setattr("lexloom.llm.transducer._BYTES_TOGETHER", 100)
    assert [n for _, n in small.walk_all([small.start] * len(texts), pa.array(texts))] == [library(t) for t in texts]
    # From any state, which a forgetful machine may know under another number.
    states = [machine.walk(machine.start, rng.choice(texts))[0] for _ in texts]
    alone = [machine.walk(s, t) for s, t in zip(states, texts)]
    found = small.walk_all([small.state(machine.key(s)) for s in states], pa.array(texts))
    assert [(small.key(s), n) for s, n in found] == [(machine.key(s), n) for s, n in alone]
    assert machine.walk_all([], pa.array([], pa.string())) == []


def test_words_between_spaces_are_not_read_one_by_one(vocabulary_path, library, monkeypatch):
    rng, read, plain = random.Random(4), [], Transducer._read
    monkeypatch.setattr(Transducer, "_read", lambda self, state, text: read.append(len(text)) or plain(self, state, text))
    texts = [" ".join("".join(rng.choices("etaoin", k=7)) for _ in range(200)) for _ in range(5)]
    machine = Transducer(vocabulary_path)
    found = machine.walk_all([machine.start] * 5, pa.array(texts))
    assert [n for _, n in found] == [library(t) for t in texts]
    assert sum(read) < sum(map(len, texts)) / 20  # first and last words


def test_transitions_are_found_in_a_table_that_grows():
    table, rng = Transitions(), np.random.default_rng(5)
    keys = rng.permutation(np.unique(rng.integers(0, 1 << 52, 150_000)))
    for low in range(0, len(keys), 1_000):
        some = keys[low : low + 1_000]
        table.add(some, some % 1_000_003, some % 7 - 3)
    slot, known = table.find(keys)
    after, gained = table.at(slot)
    assert known.all() and (after == keys % 1_000_003).all() and (gained == keys % 7 - 3).all()
    assert not table.find(keys + (1 << 53))[1].any()


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="not a byte-level"):
        Transducer(public_tokenizers.path("word_bpe_49k.json"))


# -- Merkle manifest


def plain_tree(leaves):
    """The root over leaves, and the siblings on the way up from each."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    paths = []
    for place in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            start = place // 8 * 8
            path.append((level[start:place], level[place + 1 : start + 8]))
            place //= 8
        paths.append(path)
    return levels[-1][0], paths


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    value = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], sha("".join(map(value, row)))))
    trees = []
    for _, leaves in sorted(groups.items(), key=lambda g: (g[0] is not None, (g[0] or "").encode())):
        leaves.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append((leaves, *plain_tree([digest for _, digest in leaves])))
    root, tops = plain_tree([subroot for _, subroot, _ in trees])
    return [
        (doc_id, leaf, subroot, root, sha("".join(d for before, after in [*path, *top] for d in before + after)))
        for (leaves, subroot, paths), top in zip(trees, tops)
        for (doc_id, leaf), path in zip(leaves, paths)
    ]


@pytest.mark.parametrize("sizes, direct_rows", [([1], 10_000), ([8, 1], 10_000), ([9, 64, 65, 1, 2], 10_000), ([600, 3, 70], 50), ([1] * 70, 10_000)])
def test_manifest_equals_the_plain_one(spark, monkeypatch, sizes, direct_rows):
    monkeypatch.setattr("lexloom.llm.merkle.DIRECT_ROWS", direct_rows)
    rng, rows = random.Random(len(sizes)), []
    for k, size in enumerate(sizes):
        lang = [None, "", "é", "en", "-", "=en"][k] if k < 6 else f"l{k}"
        rows += [(rng.choice([None, rng.randrange(500)]), rng.choice([None, "", "s"]), lang, rng.choice([None, 7]), rng.choice([None, "", "Äb", "AB"])) for _ in range(size)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, lo int, tree string")
    found = merkle_manifest(docs, claims={"text": F.lower("text")}, claimed=F.col("doc_id") % 2 == 0)
    got = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")), "folded_root", "claimed").collect()
    key = lambda r: [str(v) for v in r]
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(plain_manifest(rows), key=key)
    changed = sum(r[0] is not None and r[0] % 2 == 0 and r[4] is not None and r[4] != r[4].lower() for r in rows)
    assert sum(r.claimed != r.leaf for r in got) == changed == sum(r.folded_root != r.root for r in got)


def test_manifest_of_odd_rows(spark, odd_docs, no_docs):
    assert merkle_manifest(odd_docs).count() == odd_docs.count()
    assert merkle_manifest(no_docs).count() == 0
    told_apart = spark.sql("SELECT '1:' AS a, '' AS b UNION ALL SELECT '', '1:' UNION ALL SELECT NULL, '1:' UNION ALL SELECT '-', '1:'")
    assert told_apart.select(digest_of([F.col("a"), F.col("b")]).alias("d")).distinct().count() == 4
