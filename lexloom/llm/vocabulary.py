"""Exact encoding with a vocabulary of the tokenizers library, faster for running text.

A byte-level vocabulary splits a text before it merges bytes, and it always
splits in front of a space that a visible character follows, whatever stands
before.  Texts are cut there, each distinct piece of some hundred texts is encoded
once, and a text's ids are the ids of its pieces end to end.

Where the ids of a vocabulary are the ranks of its merges, words are merged by
tiktoken's core with the ranks of the same file, which gives the same ids in a third
of the time (it is tried on tokens side by side when a vocabulary is loaded);
all else goes through the tokenizers library.  Nothing is kept from one call to the next.
"""

from __future__ import annotations

import json
import os
import random
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts worth encoding together: more of them repeat more pieces, and take more memory.
TEXTS_TOGETHER = 500
#: Texts of fewer characters in all go through the library as they are.
_FEW_CHARS = 20_000
_WORDS_TOGETHER = 20_000

# Letters, then ASCII marks or nothing, and the same again behind single line ends: all splits are certain.
_LETTERS, _MARKS = "[a-zA-Zß-öø-ÿÀ-ÖØ-Þ]+", r"[!-/:-@\[-`{-~]"
_WORDS = rf"^{_LETTERS}{_MARKS}*(?:\n{_LETTERS}{_MARKS}*)*$"
_SPLIT = rf" ?{_LETTERS}|{_MARKS}+|\n"


class Vocabulary:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        before = spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        self.specials = {t["content"]: t["id"] for t in added}
        #: Whether pieces can be encoded on their own.
        self.splits = (
            spec["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        self._special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self._bytes: list[bytes] | None = None
        self._merge = self._merging(spec["model"]) if self.splits else None
        self._spaced = np.array([b[:1] == b" " for b in self.token_bytes]) if self._merge else None

    def encode_whole(self, text: str) -> bytes:
        """Ids of a text as the library gives them, as little-endian uint32."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian uint32."""
        if not self.splits:
            return [self.encode_whole(t) for t in texts]
        if self._special is None or not any(s in t for t in texts for s in self.specials):
            return self._encode_plain(texts)
        cut = [self._special.split(t) for t in texts]  # odd entries are special
        plain = iter(self._encode_plain([p for parts in cut for p in parts[::2]]))
        special = lambda p: np.array([self.specials[p]], "<u4").tobytes()
        return [b"".join(special(p) if i % 2 else next(plain) for i, p in enumerate(parts)) for parts in cut]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        if sum(map(len, texts)) < _FEW_CHARS:
            return self._ids(texts)
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        pieces, first = cut.values.dictionary_encode(), cut.offsets.to_numpy()
        place, distinct = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary
        behind_space = np.ones(len(place), bool)
        behind_space[first[:-1]] = False
        used = np.zeros(len(distinct), bool)
        used[place[behind_space]] = True
        words = used & (np.asarray(pc.match_substring_regex(distinct, _WORDS)) if self._merge else False)
        start, size, flat, at = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64), [], 0
        numbers = np.flatnonzero(words)
        for low in range(0, len(numbers), _WORDS_TOGETHER):
            some = numbers[low : low + _WORDS_TOGETHER]
            ids = self._merge(" " + " ".join(distinct.take(pa.array(some)).to_pylist()))
            begins = np.flatnonzero(self._spaced[ids])  # only the first id of a word begins with a space
            start[some], size[some] = at + begins, np.diff(np.append(begins, len(ids)))
            flat.append(ids)
            at += len(ids)
        # Other pieces, and the beginnings of texts, which no space precedes.
        numbers = np.flatnonzero(used & ~words)
        others = distinct.take(pa.array(numbers)).to_pylist()
        alone = np.ones(len(distinct), bool)  # spaces in a row: such pieces go with what precedes them
        alone[numbers] = [stands_alone(p) for p in others]
        heads = distinct.take(pa.array(place[first[:-1]])).to_pylist()
        found = [np.frombuffer(i, "<u4") for i in self._ids([" " + p for p in others] + heads)]
        more = np.array([len(i) for i in found], np.int64)
        begins = at + np.cumsum(more) - more
        start[numbers], size[numbers] = begins[: len(others)], more[: len(others)]
        start, size = np.append(start, begins[len(others) :]), np.append(size, more[len(others) :])
        place[first[:-1]] = len(distinct) + np.arange(len(texts))
        ids = np.concatenate([*flat, *found]) if flat or found else np.zeros(0, "<u4")
        sizes = size[place]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        gathered = ids[np.repeat(start[place] - ends[:-1], sizes) + np.arange(ends[-1])]
        out = [gathered[a:b].tobytes() for a, b in zip(ends[first[:-1]].tolist(), ends[first[1:]].tolist())]
        if not alone.all():
            apart = np.append(alone, np.ones(len(texts), bool))[place]
            for k in np.flatnonzero(~np.logical_and.reduceat(apart, first[:-1])).tolist():
                out[k] = self._encode_joined(texts[k].split(" "))
        return out

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _merging(self, model: dict) -> Callable[[str], np.ndarray] | None:
        """Ids of words with a space in front of each, where ids are ranks."""
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [model["vocab"].get(a + b) for a, b in pairs]
        ranks = {b: i for i, b in enumerate(self.token_bytes) if b and i not in self.specials.values()}
        if None in made or made != sorted(made) or len(ranks) != 256 + len(made) or model.get("ignore_merges"):
            return None
        import tiktoken

        core = tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
        merge = lambda text: np.array(core.encode_ordinary(text), "<u4")
        # Tokens side by side are where merges could differ.
        letters, rng = [b.decode() for b in ranks if b.isalpha() and b.isascii()], random.Random(0)
        tried = "".join([" " + "".join(rng.choices(letters, k=2)) for _ in range(2000)])
        return merge if merge(tried).tobytes() == self._ids([tried])[0] else None

    def _encode_joined(self, pieces: list[str]) -> bytes:
        """Pieces that do not stand alone go with what precedes them."""
        runs: list[list[str]] = [[pieces[0]]]
        for piece in pieces[1:]:
            if stands_alone(piece):
                runs.append(["", piece])
            else:
                runs[-1].append(piece)
        encoded = self.tokenizer.encode_batch_fast([" ".join(run) for run in runs], add_special_tokens=False)
        return np.array([i for e in encoded for i in e.ids], "<u4").tobytes()

    @property
    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for."""
        if self._bytes is None:
            of = byte_of_symbol()
            size = self.tokenizer.get_vocab_size(with_added_tokens=True)
            special = {i: s for s, i in self.specials.items()}
            self._bytes = [
                special[i].encode() if i in special else bytes(of[c] for c in self.tokenizer.id_to_token(i) or "")
                for i in range(size)
            ]
        return self._bytes

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; ids outside the vocabulary are left out, broken UTF-8 is replaced."""
        if not self.splits:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        known = self.token_bytes
        return b"".join([known[i] for i in ids.tolist() if 0 <= i < len(known)]).decode("utf-8", "replace")


def stands_alone(piece: str) -> bool:
    """Whether a space in front of ``piece`` is certainly a place where texts are split."""
    return piece != "" and not piece[0].isspace() and piece[0] != "᠎"


def byte_of_symbol() -> dict[str, int]:
    """The visible symbol that byte-level vocabularies write for each byte, by its rule."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary in a file, loaded once per process."""
    return Vocabulary(path)
