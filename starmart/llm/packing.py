"""Best-fit packing of tokenized documents after a dominance reduction.

Lengths are whole numbers up to the sequence size, so the instance, however
many documents it has, is a histogram with one count for each length. On it:

1. Martello-Toth reduction: from the longest length down, look for a set with
   at most two items that dominates every other way to fill the longest item's
   sequence (it is alone, its exact complement exists, or nothing that fits
   beside it is worth more than the longest single partner). Such sets are in
   some optimal solution, so they are fixed, as often as the counts allow, and
   taken out; repeated until nothing changes.
2. Best fit of what remains, longest first: equal lengths are placed together,
   into the fullest sequences they fit, so the steps depend on the number of
   different lengths and never on the number of documents.

The solution is a list of patterns (which lengths fill a sequence) with their
multiplicities. Pieces are numbered within their length on the executors
(a very frequent length is split into chunks) and number plus length say
which sequence and offset a piece has.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.llm.common import fresh, number_within, small_batches

SEQUENCE = 2048
#: Words whose ids a worker remembers in each of two generations: when the young
#: one is full, it becomes the old one, and words met again come back from there.
CACHE_WORDS = 120_000

Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((length, how many), ...), multiplicity


# --- tokens ---------------------------------------------------------------

_TAIL = ".,;:!?*#$%&|"
#: Characters that Python's split() takes as blanks and the tokenizer doesn't.
_ODD_BLANKS = ("\x1c", "\x1d", "\x1e", "\x1f")


class WordIds:
    """Token ids of texts, remembered word by word.

    The tokenizer's pieces never cross a blank, so the ids of a text are those
    of its blank-separated words in turn. A word that is plain letters followed
    by plain punctuation is again two such parts. Special tokens' strings in
    a text are ordinary text.

    Plain letters, already in lower case, are one piece each that the
    tokenizer's normalizer leaves as it is, so its model gets them directly, in
    the byte alphabet of its vocabulary.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        bytelevel = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The alphabet's character for each letter below U+0130, as the pre-tokenizer writes it.
        letters = [chr(c) for c in range(128, 0x130) if chr(c).isalpha()]
        self.alphabet = {ord(c): bytelevel.pre_tokenize_str(c)[0][0] for c in letters}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode_plain(self, word: str) -> bytes:
        tokens = self.model.tokenize(word if word.isascii() else word.translate(self.alphabet))
        return array("I", [t.id for t in tokens]).tobytes()

    def _learn(self, words: set[str]) -> None:
        known, older = self.known, self.older
        for w in words:
            if w in older:
                known[w] = older[w]
                continue
            core = w.rstrip(_TAIL)
            if core.isalpha() and (core.isascii() or max(core) < "\u0130"):
                low, tail = core.lower(), w[len(core) :]
                ids = known.get(low) or older.get(low) or self._encode_plain(low)
                known[low] = ids
                if tail:
                    if tail not in known:
                        known[tail] = self._encode(tail)
                    ids += known[tail]
                known[w] = ids
            else:
                known[w] = self._encode(w)

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if any(c in text for c in _ODD_BLANKS):
            return self._encode(text)
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        words = text.split()
        missing = set(words).difference(self.known)
        if missing:
            self._learn(missing)
        return b"".join(map(self.known.__getitem__, words))


    def forget(self) -> None:
        """Give the remembered words' memory back (a worker outlives its tasks)."""
        self.known, self.older = {}, {}


_WORD_IDS: dict[str, WordIds] = {}


def pieces(
    df: DataFrame, tokenizer: str, text: str = "text", doc_id: str = "doc_id",
    size: int = SEQUENCE, end_id: int = 0, with_ids: bool = False, keep: Sequence[str] = (),
) -> DataFrame:
    """The documents' pieces: ``doc_id``, ``piece`` (from 0), ``start``,
    ``length``, ``ids_crc32`` and, if asked for, ``ids`` (little-endian
    unsigned 32-bit numbers). ``tokenizer`` is a file's path on every executor. Columns
    named in ``keep`` come along, last.

    A document is its ids and then ``end_id``; a null or empty text is
    ``end_id`` alone. Only a document longer than ``size`` is cut, into pieces
    of ``size`` (the last may be shorter).
    """
    small_batches(df.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = dict(df.dtypes)
    schema = f"`{doc_id}` {kind[doc_id]}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    schema += "".join(f", `{c}` {kind[c]}" for c in keep)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if tokenizer not in _WORD_IDS:
            _WORD_IDS[tokenizer] = WordIds(tokenizer)
        words = _WORD_IDS[tokenizer]
        try:
            for b in batches:
                out = []
                for row, t in enumerate(b[text]):
                    data = words.ids(t) + end
                    for k, at in enumerate(range(0, len(data), 4 * size)):
                        part = data[at : at + 4 * size]
                        out.append((row, k, at // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
                names = ["_row", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
                x = pd.DataFrame(out, columns=names)
                row = x.pop("_row").to_numpy()
                x.insert(0, doc_id, b[doc_id].to_numpy(dtype=object)[row] if out else [])
                for c in keep:
                    x[c] = b[c].to_numpy(dtype=object)[row] if out else []
                yield x
        finally:
            words.forget()

    return df.select(doc_id, text, *keep).mapInPandas(cut, schema)


# --- the reduced instance -------------------------------------------------


def reduce_dominated(counts: Mapping[int, int], size: int) -> tuple[list[Pattern], dict[int, int]]:
    """Fix dominating sets; (patterns fixed, what remains of the histogram)."""
    left = {s: n for s, n in counts.items() if n > 0}
    fixed: list[Pattern] = []

    def fix(*items: int) -> None:
        if len(items) == 2 and items[0] == items[1]:
            times, pattern = left[items[0]] // 2, ((items[0], 2),)
        else:
            times, pattern = min(left[s] for s in items), tuple((s, 1) for s in items)
        fixed.append((pattern, times))
        for s, k in pattern:
            left[s] -= k * times
            if not left[s]:
                del left[s]

    def has(order: list[int], s: int, beside: int) -> bool:
        return s in left and left[s] > (s == beside)

    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while j in left:
                order = sorted(left)
                room = size - j
                fits = [s for s in order if s <= room and has(order, s, j)]
                if not fits:
                    if left[j] > 1 and 2 * j <= size:
                        break
                    fix(j)
                elif fits[-1] == room or not _pair_beats(fits, left, j, room):
                    fix(j, fits[-1])
                else:
                    break
                changed = True
    return fixed, left


def _pair_beats(fits: list[int], left: Mapping[int, int], j: int, room: int) -> bool:
    """Whether two or more items beside j might be worth more than the longest
    single one, that is, can't be shown to be dominated by it."""
    spare = [s for s in fits for _ in range(min(3, left[s] - (s == j)))][:3]
    if len(spare) < 2 or spare[0] + spare[1] > room:
        return False  # no two fit
    if len(spare) > 2 and sum(spare) <= room:
        return True  # three fit: not examined
    best, lo, hi = 0, 0, len(fits) - 1
    while lo <= hi:
        a, b = fits[lo], fits[hi]
        if a + b > room or (lo == hi and left[a] - (a == j) < 2):
            hi -= 1
        else:
            best = max(best, a + b)
            lo += 1
    return best > fits[-1]


def best_fit(counts: Mapping[int, int], size: int) -> list[Pattern]:
    """Best fit decreasing over a histogram, equal lengths placed together."""
    open_by: dict[int, list[Pattern]] = {}  # free space -> patterns
    spaces: list[int] = []

    def put(pattern: tuple, times: int, space: int) -> None:
        if times:
            if space not in open_by:
                open_by[space] = []
                insort(spaces, space)
            open_by[space].append((pattern, times))

    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            at = bisect_left(spaces, s)
            if at == len(spaces):
                per = size // s
                put(((s, per),), n // per, size - per * s)
                put(((s, n % per),) if n % per else (), int(n % per > 0), size - (n % per) * s)
                break
            space = spaces[at]
            pattern, times = open_by[space].pop()
            if not open_by[space]:
                del open_by[space], spaces[at]
            per = space // s
            used = min(times, n // per)
            put((*pattern, (s, per)), used, space - per * s)
            n -= used * per
            if used < times and n:  # n < per: the last sequence takes what there is
                put((*pattern, (s, n)), 1, space - n * s)
                used, n = used + 1, 0
            put(pattern, times - used, space)
    return [p for group in open_by.values() for p in group]


def solve(counts: Mapping[int, int], size: int = SEQUENCE) -> list[Pattern]:
    fixed, rest = reduce_dominated(counts, size)
    return fixed + best_fit(rest, size)


# --- assignment -----------------------------------------------------------


def _intervals(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first number, per sequence, first sequence, offset) sorted
    by length and number. At most 63 different lengths fit a sequence of 2048,
    and patterns are a few for each length, so the table is bounded."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for s, per in pattern:
            first = taken.get(s, 0)
            rows.append((s, first, per, sequence, offset))
            taken[s] = first + per * times
            offset += s * per
        sequence += times
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def pack(df: DataFrame, length: str = "length", size: int = SEQUENCE) -> DataFrame:
    """``df`` with ``sequence_id`` and ``offset`` (longs): every row has a place
    in a sequence of at most ``size``, offsets are gapless from 0.

    Rows need a ``length`` from 1 to ``size``; others raise an error (null ones
    too). Existing columns of the new names are kept, the new ones then get
    leading underscores. Repeated rows are separate items; an empty table
    gives an empty table. ``df`` is stored once.
    """
    mid, order, number, place = fresh(df, ["_mid", "_order", "_number", "_place"])
    seq, off = fresh(df, ["sequence_id", "offset"])
    stored = materialize(df.withColumn(mid, F.monotonically_increasing_id()), "packing")
    histogram = stored.groupBy(F.col(length).cast("long").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    bad = histogram.where(F.col("s").isNull() | (F.col("s") < 1) | (F.col("s") > size)).first()
    if bad:
        raise ValueError(f"{bad['n']} rows have the length {bad['s']}; it must be from 1 to {size}")
    counts = {r["s"]: r["n"] for r in histogram.collect()}  # at most ``size`` rows
    table = df.sparkSession.sparkContext.broadcast(_intervals(solve(counts, size)))

    @F.pandas_udf("sequence long, offset long")
    def where(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        t = table.value
        s, n = lengths.to_numpy(np.int64), numbers.to_numpy(np.int64)
        if not len(s):
            return pd.DataFrame({"sequence": [], "offset": []}, dtype=np.int64)
        sequence, offset = _places(t, s, n)
        return pd.DataFrame({"sequence": sequence, "offset": offset})

    numbered = number_within(stored.withColumn(order, F.xxhash64(mid)), [length], order, number)
    return numbered.withColumn(place, where(F.col(length).cast("long"), F.col(number))).select(
        *df.columns, F.col(f"{place}.sequence").alias(seq), F.col(f"{place}.offset").alias(off)
    )


def _places(t: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the items of length ``s`` numbered ``n``, from ``_intervals``."""
    # Numbers stay below 2**50: the sort key joins length and number.
    row = t[np.searchsorted((t[:, 0] << 50) | t[:, 1], (s << 50) | n, side="right") - 1]
    beyond = n - row[:, 1]
    return row[:, 3] + beyond // row[:, 2], row[:, 4] + beyond % row[:, 2] * s


def pack_windows(df: DataFrame, window: str, order: Sequence[str], length: str = "length", size: int = SEQUENCE) -> DataFrame:
    """As ``pack``, but rows are packed with those of their ``window`` (a whole number) only,
    and the sequences of a window come before those of the next: the packed rows keep the order
    the windows stand for. Windows are to be small enough for a task (the caller cuts them).
    Within a length, rows fill sequences in the order of the columns ``order``. Each
    window may end with sequences that another one would have filled. Null windows are an error.
    """
    (local,) = fresh(df, ["_local"])
    seq, off = fresh(df, ["sequence_id", "offset"])
    kinds = dict(df.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in df.columns], f"`{local}` long", f"`{off}` long"])

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(list(order), kind="stable")
        s = group[length].to_numpy(np.int64)
        if group[window].isna().any() or (s < 1).any() or (s > size).any():
            raise ValueError(f"windows must not be null, and lengths be from 1 to {size}")
        kinds_of, n = np.unique(s, return_counts=True)
        table = _intervals(solve(dict(zip(kinds_of.tolist(), n.tolist(), strict=True)), size))
        number = group.groupby(length).cumcount().to_numpy(np.int64)
        group[local], group[off] = _places(table, s, number)
        return group

    stored = materialize(df.groupBy(window).applyInPandas(place, schema), "packing-windows")
    # One number for each window.
    used = stored.groupBy(window).agg((F.max(local) + 1).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(window).rowsBetween(Window.unboundedPreceding, -1))
    base = used.select(F.col(window).alias("_w"), F.coalesce(before, F.lit(0)).alias("_base"))
    return stored.join(base, F.col(window) == F.col("_w")).select(
        *df.columns, (F.col("_base") + F.col(local)).alias(seq), off
    )


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and ``ids`` in order of
    offset, from ``pack`` over ``pieces(..., with_ids=True)``. A group holds at
    most one sequence's ids."""
    at = F.sort_array(F.collect_list(F.struct("offset", F.hex(ids).alias("h"))))
    return packed.groupBy("sequence_id").agg(F.unhex(F.concat_ws("", F.transform(at, lambda x: x["h"]))).alias("ids"))
