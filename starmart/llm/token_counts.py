"""Token counts by a compiled finite-state transducer.

A byte-level BPE tokenizer file is compiled into one deterministic transducer
over characters. A transition is annotated with the tokens it emits: the count
of the text read so far, as if it ended there, less the count before (it can be
negative, when a character completes a merge). A text's count is the sum along
its path; no token is ever made. Two machines run side by side in a state:

*Words.* The pre-tokenizer's pattern (contractions, then runs of letters, of
numbers, of other characters, each with at most one blank before it, and runs of white
space that leave their last character to what follows) is a machine of few
modes; a character's class is asked of the library once. A special token's text
cuts whatever is open; its partial matches are part of the state.

*Merges.* BPE codes a word as the only sequence of tokens in which no two
neighbours would have been merged otherwise, so the code of a prefix is the code of a
shorter one plus one token. A state holds, for every place from which the
vocabulary's trie can still be followed, the trie node, the token that ends there and the
count there. The next byte moves all of them, and the one place whose token
fits its neighbour gives the new count.

States and transitions are compiled when a text first needs them, as lazily
determinised automata are, and forgotten together when there are ``MOST`` of them, so
memory is bounded and results don't depend on it.

Texts over ``CHUNK`` characters are cut into chunks that are read in any task. A
chunk's state map is found without knowing the state it is entered in: white
space after another character ends all that is open, so from the first such place on
the state is known. The map is the part before that place, the count after
it and the state at the end. Maps compose (the state at the end of one reads the
first part of the next), which is associative, so a parallel scan joins
neighbours level by level, ``FAN`` at a time.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from starmart.checkpoint import materialize
from starmart.llm.common import fresh, small_batches

#: Characters of a chunk, and neighbours joined at a time by the scan.
CHUNK = 1 << 16
FAN = 32
#: Transitions kept compiled in a Python worker: about 250 MB at most.
MOST = 1_000_000

# Modes of the word machine.
_FRESH, _RUN, _BLANKS, _QUOTE, _QUOTE_LETTER = range(5)
# Classes of characters.
_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
# Fixed values of the pattern: what follows an apostrophe in a contraction.
_SHORT = ("s", "t", "m", "d")
_LONG = {"r": "e", "v": "e", "l": "l"}


class Merges:
    """The merge machine of a vocabulary: states are tuples of (trie node, token
    before, count there less the count now), one for each open place."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        # The printable stand-ins of the file for bytes: visible ones for themselves.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        of_char = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        self.rank = {(vocab[a], vocab[b]): k for k, (a, b) in enumerate(merges)}
        self.parts = {vocab["".join(m)]: (vocab[m[0]], vocab[m[1]]) for m in merges}
        self.spines: dict[tuple[int, int], tuple] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        # The trie of the tokens that can come out: bytes, and merges whose text is coded as themselves.
        self.trie: dict[int, int] = {}
        own = dict.fromkeys(t for t in vocab if len(t) == 1)
        for a, b in merges:  # parts come before what is made of them
            if a in own and b in own and self._meet(vocab[a], vocab[b]):
                own[a + b] = None
        ends = {}
        inner = set()
        for t in own:
            at = 0
            for c in t:
                inner.add(at)
                at = self.trie.setdefault(at << 8 | of_char[c], len(self.trie) + 1)
            ends[at] = vocab[t]
        self.token = [ends.get(k, -1) for k in range(len(self.trie) + 1)]
        self.inner = [k in inner for k in range(len(self.trie) + 1)]

    def _spine(self, token: int, side: int) -> tuple:
        """The pieces at one edge of a token, from the whole to its byte, each with
        the rank of the merge that took it up."""
        known = self.spines.get((token, side))
        if known is None:
            out, at, until = [], token, float("inf")
            while True:
                out.append((at, until))
                if at not in self.parts:
                    break
                until = self.rank[self.parts[at]]
                at = self.parts[at][side]
            known = self.spines[token, side] = tuple(out)
        return known

    def _across(self, a: int, b: int, before: float) -> bool:
        """Whether a merge of a rank under ``before`` would reach across from ``a`` to
        ``b``: one of a piece at ``a``'s right edge with one at ``b``'s left edge, before either is
        taken up. Of equal merges the left one comes first."""
        right, rank = self._spine(b, 0), self.rank
        for x, i in self._spine(a, 1):
            for y, j in right:
                k = rank.get((x, y))
                if k is not None and k < i and k <= j and k < before:
                    return True
        return False

    def _meet(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` last until they are merged."""
        return not self._across(a, b, self.rank[a, b])

    def fit(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` stay neighbours: no merge reaches across."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) >= MOST:
                self.fits.clear()
            known = self.fits[a, b] = not self._across(a, b, float("inf"))
        return known

    def step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """The state after one more byte, and the tokens it adds."""
        moved, last, added = [], -1, 0
        trie, tokens, inner = self.trie, self.token, self.inner
        for node, before, count in state:
            to = trie.get(node << 8 | byte)
            if to is not None:
                # Only one place has a token that fits.
                if last < 0:
                    token = tokens[to]
                    if token >= 0 and (before < 0 or self.fit(before, token)):
                        last, added = token, count + 1
                if inner[to]:
                    moved.append((to, before, count))
        if added:
            moved = [(n, b, c - added) for n, b, c in moved]
        moved.append((0, last, 0))
        return tuple(moved), added

    #: Nothing read: one open place, with no token before it.
    START = ((0, -1, 0),)

    def read(self, state: tuple, char: str) -> tuple[tuple, int]:
        added = 0
        for byte in char.encode("utf-8", "replace"):
            state, n = self.step(state, byte)
            added += n
        return state, added


class State(dict):
    """A state: character to (state after it, tokens added), filled as needed."""

    __slots__ = ("key", "machine")

    def __init__(self, machine: Transducer, key: tuple):
        super().__init__()
        self.machine, self.key = machine, key

    def __missing__(self, char: str) -> tuple[State, int]:
        return self.machine.compile(self, char)


class Transducer:
    """The counting machine of a tokenizer file.

    A state's key is (mode, merge state, extra, special characters matched,
    tokens added since that match began); ``extra`` is the pending last
    character of white space, or the letter after an apostrophe.
    """

    def __init__(self, spec: str):
        doc = json.loads(spec)
        self._check(doc)
        self.special = [t["content"] for t in doc["added_tokens"]]
        self.special = self.special[0] if self.special else ""
        self.merges = Merges(doc["model"]["vocab"], [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in doc["model"]["merges"]])
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        self.classes: dict[str, int] = {}
        self.states: dict[tuple, State] = {}
        self.size = 0
        self.start = (_FRESH, Merges.START, "", 0, 0)

    @staticmethod
    def _check(doc: dict) -> None:
        """Refuse files that this compiler would not count exactly."""
        model, pre, added = doc["model"], doc.get("pre_tokenizer") or {}, doc["added_tokens"]
        made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", ())]
        whole = len(set(made)) == len(made) and sum(len(t) == 1 for t in model.get("vocab", ())) == 256
        plain = all(not model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "ignore_merges"))
        bytelevel = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        # A special text must be found by its first character alone, and hold no white space.
        cut = all(
            t["content"] and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
            and t["content"].count(t["content"][0]) == 1 and not any(c.isspace() for c in t["content"])
            for t in added
        )
        if not (model["type"] == "BPE" and plain and whole and bytelevel and not doc.get("normalizer") and len(added) <= 1 and cut):
            raise ValueError("not a plain byte-level BPE file with at most one special token")

    def state(self, key: tuple) -> State:
        got = self.states.get(key)
        if got is None:
            got = self.states[key] = State(self, key)
        return got

    def class_of(self, char: str) -> int:
        """Asked of the library's pattern: a character of a class goes on its run."""
        known = self.classes.get(char)
        if known is None:
            known = next((k for k, first in enumerate("a1!") if len(self.split(first + char)) == 1), _SPACE)
            self.classes[char] = known
        return known

    def compile(self, state: State, char: str) -> tuple[State, int]:
        if self.size >= MOST:
            for s in self.states.values():
                s.clear()
            self.states.clear()
            self.states[state.key] = state
            self.size = 0
        mode, merged, extra, matched, since = state.key
        (mode, merged, extra), n = self._word(mode, merged, extra, char)
        if self.special:
            if char == self.special[matched]:
                matched, since = matched + 1, since + n
            else:
                matched = int(char == self.special[0])
                since = n if matched else 0
            if matched == len(self.special):
                # It is one token; what was read of it as text is taken back.
                (mode, merged, extra), n = (_FRESH, Merges.START, ""), 1 - since + n
                matched = since = 0
        out = state[char] = (self.state((mode, merged, extra, matched, since)), n)
        self.size += 1
        return out

    def _begin(self, char: str) -> tuple[tuple, int]:
        """The first character of a word."""
        merged, n = self.merges.read(Merges.START, char)
        if char == "'":
            return (_QUOTE, merged, ""), n
        kind = self.class_of(char)
        if kind == _SPACE:
            return (_BLANKS, Merges.START, char), n
        return (_RUN, merged, kind), n

    def _word(self, mode: int, merged: tuple, extra, char: str) -> tuple[tuple, int]:
        if mode == _FRESH:
            return self._begin(char)
        kind = self.class_of(char)
        if mode == _BLANKS:
            # ``merged`` is the run without its last character, ``extra``.
            longer, counted = self.merges.read(merged, extra)
            if kind == _SPACE:
                return (_BLANKS, longer, char), self.merges.read(longer, char)[1]
            if extra != " ":
                # The last one is a word by itself.
                after, n = self._begin(char)
                return after, n + self.merges.read(Merges.START, extra)[1] - counted
            first, n = self.merges.read(Merges.START, extra)
            first, more = self.merges.read(first, char)
            return (_RUN, first, kind), n + more - counted
        if mode == _QUOTE:
            if char in _SHORT:
                return (_FRESH, Merges.START, ""), self.merges.read(merged, char)[1]
            if char in _LONG:
                alone, n = self.merges.read(Merges.START, char)
                return (_QUOTE_LETTER, alone, char), n
            mode, extra = _RUN, _OTHER
        elif mode == _QUOTE_LETTER:
            if char == _LONG[extra]:
                apart = self._tokens("'") + self._tokens(extra)
                return (_FRESH, Merges.START, ""), self._tokens("'" + extra + char) - apart
            mode, extra = _RUN, _LETTER
        if kind == extra:
            merged, n = self.merges.read(merged, char)
            return (_RUN, merged, kind), n
        return self._begin(char)

    def _tokens(self, word: str) -> int:
        state, total = Merges.START, 0
        for c in word:
            state, n = self.merges.read(state, c)
            total += n
        return total

    def run(self, key: tuple, text: str) -> tuple[tuple, int]:
        """The state after ``text`` from the state ``key``, and the tokens added."""
        state, total = self.state(key), 0
        for char in text:
            state, n = state[char]
            total += n
        return state.key, total

    def count(self, text: str) -> int:
        return self.run(self.start, text)[1]

    def settled(self, text: str) -> int:
        """The first place of white space after another character, or -1."""
        before = _SPACE
        for i, char in enumerate(text):
            kind = self.class_of(char)
            if kind == _SPACE and before != _SPACE:
                return i
            before = kind
        return -1

    def map_of(self, text: str, first: bool) -> Map:
        """A chunk's state map; ``first``: it is entered in the start state."""
        if first:
            end, n = self.run(self.start, text)
            return Map("", n, end)
        at = self.settled(text)
        if at < 0:
            return Map(text, 0, None)
        end, n = self.run(self.start, text[at:])
        return Map(text[:at], n, end)

    def join(self, a: Map, b: Map) -> Map:
        """The map of ``a`` and then ``b``."""
        if a.end is None:
            return Map(a.head + b.head, b.n, b.end)
        end, n = self.run(a.end, b.head)
        if b.end is None:
            return Map(a.head, a.n + n, end)
        # White space ends what is open; its run begins with the settled part.
        return Map(a.head, a.n + n + b.n, b.end)


@dataclass
class Map:
    """A state map: what must be read in the state it is entered in, the tokens
    after that, and the state at the end (None: it depends on the entry)."""

    head: str
    n: int
    end: tuple | None


_LOADED: dict[int, Transducer] = {}


def _machine(spec: str) -> Transducer:
    """One machine for each file and Python worker."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Transducer(spec)
    return _LOADED[key]


def count_tokens(df: DataFrame, tokenizer_file: str, text: str = "text", name: str = "n_tokens", chunk: int = CHUNK) -> DataFrame:
    """``df`` with the tokens of ``text`` as the tokenizers library gives them with
    its defaults and no added special tokens; a special token's text inside a
    text is that token. The column gets leading underscores where ``name`` is taken.

    A null or empty text has 0 tokens. Texts may be of any length. Every row is
    kept, repeated ones too. An empty table stays empty. Only ``text`` is looked at.
    """
    small_batches(df.sparkSession)
    out, row, part, piece = fresh(df, [name, "_row", "_part", "_piece"])
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = f.read()
    Transducer._check(json.loads(spec))
    # The file itself: a constant of the vocabulary's size.
    shared = df.sparkSession.sparkContext.broadcast(spec)

    @F.pandas_udf("long")
    def counted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = _machine(shared.value)
        for batch in texts:
            yield batch.map(lambda t: machine.count(t or ""))

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r, t in zip(b[row], b[text], strict=True):
                for k in range(0, len(t), chunk):
                    yield pd.DataFrame({row: [r], part: [k // chunk], piece: [t[k : k + chunk]]})

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = _machine(shared.value)
        for b in batches:
            made = [machine.map_of(t, k == 0) for k, t in zip(b[part], b[piece], strict=True)]
            yield pd.DataFrame({row: b[row], part: b[part], "head": [m.head for m in made], "n": [m.n for m in made],
                                "end": [pickle.dumps(m.end) for m in made]})

    def joined(some: pd.DataFrame) -> pd.DataFrame:
        machine = _machine(shared.value)
        some = some.sort_values(part)
        whole = None
        for head, n, end in zip(some["head"], some["n"], some["end"], strict=True):
            m = Map(head, int(n), pickle.loads(end))
            whole = m if whole is None else machine.join(whole, m)
        return pd.DataFrame({row: some[row].to_numpy()[:1], part: [int(some[part].iloc[0]) // FAN], "head": [whole.head], "n": [whole.n],
                             "end": [pickle.dumps(whole.end)]})

    size = F.coalesce(F.length(text), F.lit(0))
    # Rows of long texts get a number that stays once it is written.
    long = materialize(df.where(size > chunk).withColumn(row, F.monotonically_increasing_id()), "token-long")
    deal = long.select(row, text).mapInPandas(chunks, f"`{row}` long, `{part}` int, `{piece}` string").repartition(row, part)
    kind = f"`{row}` long, `{part}` int, head string, n long, end binary"
    level = materialize(deal.mapInPandas(maps, kind), "token-maps")
    most = level.agg(F.max(part)).first()[0] or 0
    while most:
        level = level.groupBy(row, F.floor(F.col(part) / FAN).alias("_up")).applyInPandas(joined, kind)
        most //= FAN
    totals = level.select(row, F.col("n").alias(out))
    short = df.where(size <= chunk).withColumn(out, counted(F.col(text)))
    return short.unionByName(long.join(totals, row).select(*df.columns, out))
