"""A byte-level vocabulary compiled into a deterministic transducer that counts tokens.

A state is all that the text read so far can still do to the tokens of what
follows; a transition reads one character and carries by how many tokens the
count of the text grows.  Since a character may merge what came before, a
transition can carry zero or less; the sum over a text is its number of tokens, and
after every character the sum is that of the text up to there.

* The split into pieces (words, numbers, marks, white space, contractions) is a
  small automaton over classes of characters, which the library itself names.
  White space waits one character, since the last of a run may belong to the
  word behind it.
* Inside a piece the last token of the encoding of every prefix is unique: it is
  the one vocabulary entry that ends there and that the library leaves unmerged
  behind the last token of the prefix before it.  The state keeps the vocabulary
  entries that are still growing, each with the token before it and its count
  relative to now; what can grow no further is forgotten, so states are finite.
* Added special strings are matched beside all this, each with the count it started from.

States are compiled when a text first needs them; beyond ``STATES_KEPT`` a process forgets
them and compiles anew.  Between spaces, transitions that read a whole word are kept too,
as long as they were used among the last ``WORDS_KEPT`` new ones.  ``Transducer.key`` names
a state the same way in every process.

``walk_all`` reads many texts at a time.  Most words are entered behind a word and a space and
left so again: each distinct one is read once from there, all side by side, a character at a
time, through the compiled transitions in arrays; a text gains what its words gain.  Words that
are entered or left in another state are read in their place.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lexloom.llm.vocabulary import byte_of_symbol

#: States a process keeps, some 150 MB.
STATES_KEPT = 200_000
#: Transitions that read a whole word: so many new ones, and as many from before.
WORDS_KEPT = 200_000
_WORD_CHARS = 24
_STRETCH = 65_536  # characters cut into words at a time
_BYTES_TOGETHER = 1 << 21  # of texts cut into words at a time; a longer text is walked alone
_WORDS_TOGETHER = 8_192  # distinct words read side by side; between such blocks states may be forgotten

#: What may follow an apostrophe at the start of a piece; the first letters of the long ones wait for the second.
_SHORT = frozenset("stmd")
_LONG = {"r": "e", "v": "e", "l": "l"}

#: Growing vocabulary entries of a piece: (trie node, token before or -1, count relative to now).
Growing = tuple[tuple[int, int, int], ...]
_FRESH: Growing = ((0, -1, 0),)

#: A state's transitions by character: the next state and the tokens gained; under "" its own name,
#: under "number" the place it has in ``Transitions``, if any.
State = dict[str, tuple]


class Transitions:
    """Compiled transitions in arrays, found by state number and character."""

    def __init__(self):
        self.states: list[State] = []
        self._used = 0
        self._make(1 << 16)

    def _make(self, size: int) -> None:
        self._shift = np.uint64(64 - (size.bit_length() - 1))
        self._keys, self._next, self._gained = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)

    def number(self, state: State) -> int:
        if "number" not in state:
            state["number"] = len(self.states)
            self.states.append(state)
        return state["number"]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each key, or a free one for it, and whether it is there."""
        slot = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)
        met = self._keys[slot]
        other = np.flatnonzero((met != keys) & (met >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) & (len(self._keys) - 1)
            met = self._keys[slot[other]]
            other = other[(met != keys[other]) & (met >= 0)]
        return slot, self._keys[slot] == keys

    def add(self, keys: np.ndarray, after: np.ndarray, gained: np.ndarray) -> None:
        """Add distinct keys that are not there yet."""
        if (self._used + len(keys)) * 2 > len(self._keys):
            there = np.flatnonzero(self._keys >= 0)
            keys, after, gained = (np.concatenate([a[there], b]) for a, b in ((self._keys, keys), (self._next, after), (self._gained, gained)))
            self._used = 0
            self._make(1 << (2 * len(keys)).bit_length())
        self._used += len(keys)
        while len(keys):
            slot, first = np.unique(self.find(keys)[0], return_index=True)
            self._keys[slot], self._next[slot], self._gained[slot] = keys[first], after[first], gained[first]
            keys, after, gained = (np.delete(a, first) for a in (keys, after, gained))

    def at(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._next[slot], self._gained[slot]


class Transducer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        spec = json.loads(tokenizer.to_str())
        split, model = spec["pre_tokenizer"] or {}, spec["model"]
        if (
            model["type"] != "BPE"
            or model.get("dropout")
            or model.get("ignore_merges")
            or spec["normalizer"] is not None
            or split.get("type") != "ByteLevel"
            or not split.get("use_regex", True)
            or split.get("add_prefix_space")
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"{path}: not a byte-level BPE vocabulary that can be compiled")
        self._pieces, self._model = tokenizer.pre_tokenizer, tokenizer.model
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self._heads = {special[0] for special in self.specials}
        special_ids = {t["id"] for t in spec["added_tokens"]}
        byte_of = byte_of_symbol()
        self._spelled = {i: s for s, i in model["vocab"].items() if i not in special_ids}
        # A trie of all entries; nodes are numbered in the order of the ids, the same in every process.
        self._child: dict[int, int] = {}
        self._token: dict[int, int] = {}
        nodes = 1
        for token in sorted(self._spelled):
            node = 0
            for symbol in self._spelled[token]:
                step = node << 8 | byte_of[symbol]
                if step not in self._child:
                    self._child[step] = nodes
                    nodes += 1
                node = self._child[step]
            self._token[node] = token
        self._inner = {step >> 8 for step in self._child}
        self._classes: dict[str, str] = {}
        self._forget()

    def _forget(self) -> None:
        self._states: dict[tuple, State] = {}
        self._apart: dict[int, bool] = {}
        self._words: dict[str, tuple[State, int]] = {}
        self._words_before: dict[str, tuple[State, int]] = {}
        self._leaving: dict[tuple[str, str], tuple[str, Growing, Growing | None, int]] = {}
        self._table = Transitions()
        self.start = self._state(("", _FRESH, None, ()))
        #: Behind a word and a space: words are read whole from here.
        self._space = self._read(self.start, "a ")[0]

    def _state(self, name: tuple) -> State:
        state = self._states.get(name)
        if state is None:
            state = self._states[name] = {"": name}
        return state

    def key(self, state: State) -> str:
        return json.dumps(state[""])

    def state(self, key: str) -> State:
        return self._state(_tuples(json.loads(key)))

    def walk(self, state: State, text: str) -> tuple[State, int]:
        """The state behind ``text`` and the tokens gained on the way."""
        total = 0
        for at in range(0, len(text), _STRETCH):
            words = text[at : at + _STRETCH].split(" ")
            rest = words.pop()
            for word in words:
                step = self._words.get(word) if state is self._space else None
                if step is None:
                    step = self._read_word(state, word)
                state = step[0]
                total += step[1]
            state, gained = self._read(state, rest)
            total += gained
        return state, total

    def _read_word(self, state: State, word: str) -> tuple[State, int]:
        """Read a word and the space behind it."""
        if state is not self._space or len(word) > _WORD_CHARS:
            return self._read(state, word + " ")
        if len(self._words) > WORDS_KEPT:
            self._words, self._words_before = {}, self._words
        step = self._words_before.get(word) or self._read(state, word + " ")
        if state is self._space:  # or all was forgotten on the way
            self._words[word] = step
        return step

    def _read(self, state: State, text: str) -> tuple[State, int]:
        total = 0
        for c in text:
            step = state.get(c)
            if step is None:
                step = self._grow(state, c)
            state = step[0]
            total += step[1]
        return state, total

    def count(self, text: str) -> int:
        return self.walk(self.start, text)[1]

    def walk_all(self, states: list[State], texts: pa.Array) -> list[tuple[State, int]]:
        """``walk`` for many texts, each from its own state."""
        out, low, size = [], 0, pc.binary_length(texts).to_pylist()
        while low < len(size):
            high, total = low + 1, size[low]
            while high < len(size) and total + size[high] <= _BYTES_TOGETHER:
                total += size[high]
                high += 1
            if total > _BYTES_TOGETHER:
                out.append(self.walk(states[low], texts[low].as_py()))
            else:
                out += self._walk_together(states[low:high], texts.slice(low, high - low))
            low = high
        return out

    def _walk_together(self, states: list[State], texts: pa.Array) -> list[tuple[State, int]]:
        words = pc.split_pattern(texts, " ")
        first, coded = words.offsets.to_numpy().astype(np.int64), words.values.dictionary_encode()
        place, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        # Between the first word of a text and what follows its last space.
        inner = np.ones(len(place), bool)
        inner[first[:-1]] = inner[first[1:] - 1] = False
        numbers = np.unique(place[inner])
        gained, back = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
        gained[numbers], back[numbers] = self._read_words(distinct.take(pa.array(numbers)).to_pylist())
        sums = np.concatenate([[0], np.cumsum(np.where(inner, gained[place], 0))])
        others = np.append(np.flatnonzero(inner & ~back[place]), len(place))
        many = np.diff(np.searchsorted(others, first)) * 8 > np.diff(first)  # read in their place
        out, k = [], 0
        for text, state, start, last, alone in zip(texts, states, first[:-1].tolist(), (first[1:] - 1).tolist(), many.tolist()):
            if alone:
                out.append(self.walk(state, text.as_py()))
                continue
            own, at, total, behind_space = None, start, 0, False
            while at < last:
                if behind_space:
                    while others[k] < at:
                        k += 1
                    stop = min(last, int(others[k]))
                    total += int(sums[stop] - sums[at])
                    at = stop
                    if at == last:
                        break
                own = own or text.as_py().split(" ")
                state, more = self._read(state, own[at - start] + " ")
                total += more
                at += 1
                behind_space = state[""] == self._space[""]
                if behind_space:
                    state = self._space
            state, more = self._read(state, own[-1] if own else text.as_py())
            out.append((state, total + more))
        return out

    def _read_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For words behind a word and a space: tokens gained with the space behind, and whether that leads there again.

        Long words are left to be read in their place.
        """
        gained, back = np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        length = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-length, kind="stable")
        order = order[length[order] <= _WORD_CHARS]
        for low in range(0, len(order), _WORDS_TOGETHER):
            if len(self._states) > STATES_KEPT:
                self._forget()
            some = order[low : low + _WORDS_TOGETHER]
            width, size = int(length[some[0]]) + 1, -length[some]
            chars = np.array([words[k] + " " for k in some.tolist()], f"<U{width}").view(np.uint32).reshape(len(some), width)
            space = self._table.number(self._space)
            state, total = np.full(len(some), space, np.int64), np.zeros(len(some), np.int64)
            for at in range(width):
                n = int(np.searchsorted(size, -at, "right"))  # the longest come first
                state[:n], more = self._read_side_by_side(state[:n] << 21 | chars[:n, at])
                total[:n] += more
            gained[some], back[some] = total, state == space
        return gained, back

    def _read_side_by_side(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and tokens gained, for state numbers and a character each."""
        table = self._table
        slot, known = table.find(keys)
        if not known.all():
            fresh = np.unique(keys[~known])
            steps = []
            for key in fresh.tolist():
                state, c = table.states[key >> 21], chr(key & 0x1FFFFF)
                steps.append(state.get(c) or self._compile(state, c))
            table.add(fresh, np.array([table.number(s) for s, _ in steps], np.int64), np.array([g for _, g in steps], np.int64))
            slot = table.find(keys)[0]
        return table.at(slot)

    def character_class(self, c: str) -> str:
        """L(etter), N(umber), S(pace) or O(ther), as the library splits."""
        found = self._classes.get(c)
        if found is None:
            alone = lambda text: len(self._pieces.pre_tokenize_str(text)) == 1
            found = "L" if alone("a" + c) else "N" if alone("1" + c) else "S" if alone("\n" + c) else "O"
            self._classes[c] = found
        return found

    def _grow(self, state: State, c: str) -> tuple[State, int]:
        """Compile the transition of ``state`` on ``c``, with room for it."""
        if len(self._states) > STATES_KEPT:
            self._forget()  # the state walked from lives on until it is left
        return self._compile(state, c)

    def _compile(self, state: State, c: str) -> tuple[State, int]:
        mode, growing, before, matches = state[""]
        if mode in ("L", "N", "O") and mode != self.character_class(c):
            # A new piece, whatever grew in the one before.
            now = self._leaving.get((mode, c))
            if now is None:
                now = self._leaving[mode, c] = self._step(mode, growing, before, c)
        else:
            now = self._step(mode, growing, before, c)
        gained = now[3]
        # Special strings that go on or begin here; the count at their start is kept relative to now.
        going = []
        fresh = [(k, 0, 0) for k in range(len(self.specials))] if c in self._heads else []
        for which, length, relative in [*matches, *fresh] if matches or fresh else ():
            if self.specials[which][length] == c:
                if length + 1 == len(self.specials[which]):
                    # The special string is one token, and what follows starts afresh.
                    step = (self._state(("", _FRESH, None, ())), relative + 1)
                    state[c] = step
                    return step
                going.append((which, length + 1, relative - gained))
        step = (self._state((*now[:3], tuple(going))), gained)
        state[c] = step
        return step

    def _step(self, mode: str, growing: Growing, before: Growing | None, c: str) -> tuple[str, Growing, Growing | None, int]:
        """The same without special strings: mode, growing entries, those before the last white space, tokens gained."""
        kind = self.character_class(c)
        if mode == "'" and c in _SHORT:
            return "", _FRESH, None, self._feed(growing, c)[1]
        if mode == "'" and c in _LONG:
            after, gained = self._feed(_FRESH, c)
            return "'" + c, after, growing, gained
        if len(mode) == 2 and mode[0] == "'":
            if c == _LONG[mode[1]]:
                # One piece instead of the mark and a word of one letter.
                after, first = self._feed(before, mode[1])
                return "", _FRESH, None, first + self._feed(after, c)[1] - self._feed(_FRESH, mode[1])[1]
            mode = "L"
        if mode and mode[0] == "S":
            last = mode[1]
            run, gained = self._feed(growing, c) if kind == "S" else (growing, 0)
            if kind == "S":
                return "S" + c, run, growing, gained
            # The run without its last character is a piece; that one belongs to what follows, or stands alone.
            gained = -self._feed(before, last)[1]
            if last == " ":
                after, space = self._feed(_FRESH, " ")
                after, more = self._feed(after, c)
                return kind, after, None, gained + space + more
            gained += self._feed(_FRESH, last)[1]
            after, more = self._feed(_FRESH, c)
            return "'" if c == "'" else kind, after, None, gained + more
        if kind == "S":
            after, gained = self._feed(_FRESH, c)
            return "S" + c, after, _FRESH, gained
        if mode == kind or (mode == "'" and kind == "O"):
            after, gained = self._feed(growing, c)
            return kind, after, None, gained
        after, gained = self._feed(_FRESH, c)
        return "'" if c == "'" else kind, after, None, gained

    def _feed(self, growing: Growing, c: str) -> tuple[Growing, int]:
        """Growing entries behind one more character of a piece, and the tokens gained."""
        total = 0
        for byte in c.encode("utf-8", "replace"):
            longer, found, gained = [], -1, 0
            for node, before, relative in growing:  # the longest comes first
                node = self._child.get(node << 8 | byte, 0)
                if not node:
                    continue
                if found < 0 and node in self._token and self._stays_apart(before, self._token[node]):
                    found, gained = self._token[node], relative + 1
                if node in self._inner:
                    longer.append((node, before, relative))
            growing = (*[(node, before, relative - gained) for node, before, relative in longer], (0, found, 0))
            total += gained
        return growing, total

    def _stays_apart(self, a: int, b: int) -> bool:
        """Whether the library encodes the two tokens' bytes together as these two tokens."""
        if a < 0:
            alone = self._model.tokenize(self._spelled[b])
            return len(alone) == 1 and alone[0].id == b
        pair = a << 20 | b
        found = self._apart.get(pair)
        if found is None:
            tokens = self._model.tokenize(self._spelled[a] + self._spelled[b])
            found = self._apart[pair] = len(tokens) == 2 and tokens[0].id == a and tokens[1].id == b
        return found


def _tuples(value):
    return tuple(map(_tuples, value)) if isinstance(value, list) else value


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """The compiled vocabulary of a file, one per process."""
    return Transducer(path)
