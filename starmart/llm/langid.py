"""Language identification by prediction by partial matching (PPM).

For each language a byte context tree of order 3 is learned: the counts of the
byte that followed each context of 3, 2, 1 and 0 bytes. A byte's probability in
a context is PPM's method C with exclusion: a byte seen there has probability
count / (n + d) (n bytes seen, d of them different); the escape probability
d / (n + d) is shared among the bytes not seen there as the next shorter
context would, and below the empty context all are equal. The statistics are frozen after
training, so every (context, byte) has one exact code length, -log2 of that
probability, and a text's code length in a language is a sum over its bytes.
The language with the shortest code wins.

Bytes are folded to 64 symbols first: ASCII letters without case, all blanks as
one, all digits as one, the most frequent other bytes, and one for the rest.

Frozen code lengths fill a table for each language (context row x symbol): a row for
every context of 2 bytes and one for each context of 3 bytes that the language was seen to use
(a context seen once in all is none: it takes its order-2 row). No context is left out for room: a
language takes about 3 MB, sent to the executors. Scoring a text is two array look-ups a
byte and language, in slices, so memory doesn't grow with a text's length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.llm.common import fresh, small_batches, smallest

#: So many documents of each language are learned from (all, if there are fewer): a
#: documented bound on the labelled sample, those with the smallest hashes of id and text.
TRAIN_DOCS = 1500
UNKNOWN = "und"

_SYMBOLS = 64
_REST = _SYMBOLS - 1
_ORDER2 = _SYMBOLS**2
_SLICE = 1 << 18
_COMMON_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_COMMON_LETTER.search(text)) or any(map(str.isalpha, text))


def _folded() -> np.ndarray:
    """Each byte after folding: letters to lower case, blanks to a space,
    digits to a zero."""
    to = np.arange(256, dtype=np.uint8)
    to[65:91] += 32
    to[[9, 10, 11, 12, 13, 32]] = 32
    to[48:58] = 48
    return to


def symbol_map(histogram: np.ndarray) -> np.ndarray:
    """Byte to symbol, from the histogram of folded bytes: the 63 most frequent
    get their own symbol (ties to the smaller byte), the others share one."""
    ranked = sorted(np.flatnonzero(histogram), key=lambda b: (-histogram[b], b))[:_REST]
    own = np.full(256, _REST, dtype=np.uint8)
    own[ranked] = np.arange(len(ranked), dtype=np.uint8)
    return own[_folded()]


def _codes(symbols: np.ndarray, blank: int) -> np.ndarray:
    """For each symbol, its 3 predecessors and itself as one number."""
    s = np.concatenate([np.full(3, blank, dtype=np.uint32), symbols.astype(np.uint32)])
    return ((s[:-3] * _SYMBOLS + s[1:-2]) * _SYMBOLS + s[2:-1]) * _SYMBOLS + s[3:]


def _slices(text: str, to_symbol: np.ndarray) -> Iterator[np.ndarray]:
    """The codes of a text's bytes, slice by slice; each slice carries the last
    3 symbols of the one before."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    blank = int(to_symbol[32])
    for at in range(0, len(data), _SLICE):
        if at == 0:
            yield _codes(to_symbol[data[:_SLICE]], blank)
        else:
            yield _codes(to_symbol[data[at - 3 : at + _SLICE]], blank)[3:]


def _ppm(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Method C with exclusion: (contexts, symbols) counts and the shorter
    contexts' probabilities to probabilities that sum to 1."""
    seen = counts > 0
    n, d = counts.sum(1, keepdims=True), seen.sum(1, keepdims=True)
    rest = np.where(seen, 0.0, shorter)
    left = rest.sum(1, keepdims=True)
    full = left <= 0  # every symbol was seen: there is nothing to escape to
    total = np.where(full, n, n + d)
    escape = np.where(n > 0, d / np.maximum(n + d, 1), 1.0)
    return np.where(seen, counts / np.maximum(total, 1), escape * rest / np.where(full, 1.0, left))


@dataclass
class Ppm:
    """The frozen statistics: symbol map and (language, code, count) arrays."""

    languages: list[str]
    to_symbol: np.ndarray
    lang: np.ndarray
    code: np.ndarray
    count: np.ndarray
    _tables: list[tuple[np.ndarray, np.ndarray]] | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_tables": None}

    def tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each language: the row of each order-3 context, and code lengths by row and symbol."""
        if self._tables is None:
            weight = np.zeros(_SYMBOLS**3)
            np.add.at(weight, self.code // _SYMBOLS, self.count)
            self._tables = [self._table(k, weight > 1) for k in range(len(self.languages))]
        return self._tables

    def _table(self, k: int, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mine = self.lang == k
        code, count = self.code[mine], self.count[mine].astype(float)
        context = code // _SYMBOLS
        kept = np.unique(context[often[context]])
        row = (np.arange(_SYMBOLS**3) % _ORDER2).astype(np.int32)
        row[kept] = _ORDER2 + np.arange(len(kept), dtype=np.int32)
        low = [np.bincount(code % _SYMBOLS**o, count, _SYMBOLS**o).reshape(-1, _SYMBOLS) for o in (1, 2, 3)]
        p = np.full((1, _SYMBOLS), 1 / _SYMBOLS)
        for o, c in enumerate(low):
            # A context's shorter one drops its oldest, that is highest, symbol.
            p = _ppm(c, p[np.arange(len(c)) % len(p)] if o else p)
        third = np.zeros((len(kept), _SYMBOLS))
        at = row[context]
        own = at >= _ORDER2
        np.add.at(third, (at[own] - _ORDER2, code[own] % _SYMBOLS), count[own])
        lengths = np.empty((_ORDER2 + len(kept), _SYMBOLS), dtype=np.float32)
        lengths[:_ORDER2] = -np.log2(p)
        if len(kept):
            lengths[_ORDER2:] = -np.log2(_ppm(third, p[kept % _ORDER2]))
        return row, lengths.reshape(-1)

    def code_lengths(self, text: str) -> np.ndarray:
        """Bits the text takes in each language."""
        bits = np.zeros(len(self.languages))
        for code in _slices(text, self.to_symbol):
            context, symbol = code // _SYMBOLS, code % _SYMBOLS
            for k, (row, lengths) in enumerate(self.tables()):
                bits[k] += lengths.take(row[context].astype(np.int64) * _SYMBOLS + symbol).sum(dtype=np.float64)
        return bits

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of the shortest code (ties: the first by name), and its
        posterior probability if all are as likely beforehand."""
        if text is None or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        bits = self.code_lengths(text)
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = TRAIN_DOCS) -> Ppm:
    """Learn from labelled documents; rows with a null text or label are left out.

    The ``per_language`` documents of each language with the smallest hashes of id and text
    are used (all, if there are fewer; equal rows count once), so a group of copies with ids of
    their own is drawn row by row and no language is left out. Counting runs
    on the executors; the driver gets the summed counts, at most
    64**4 for each language and in practice as many as the sample has.
    """
    small_batches(docs.sparkSession)
    own = [c for c in ("doc_id",) if c in docs.columns]
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        *own, F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    sample = materialize(smallest(labelled, per_language, [*own, "text"], ["lang"]).select("lang", "text"), "langid-sample")
    fold = _folded()

    def bytes_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(256, dtype=np.int64)
        for b in batches:
            for t in b["text"]:
                total += np.bincount(fold[np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)], minlength=256)
        yield pd.DataFrame({"b": np.arange(256), "n": total})

    hist = np.zeros(256, dtype=np.int64)
    for b, n in sample.mapInPandas(bytes_of, "b int, n long").groupBy("b").agg(F.sum("n")).collect():
        hist[b] = n
    to_symbol = symbol_map(hist)

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, texts in b.groupby("lang")["text"]:
                parts = [np.unique(c, return_counts=True) for t in texts for c in _slices(t, to_symbol)]
                if parts:
                    code, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                    n = np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)
                    yield pd.DataFrame({"lang": name, "code": code.astype(np.int64), "n": n})

    counted = sample.mapInPandas(grams, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    got = counted.toPandas()
    languages = sorted(got["lang"].unique())
    return Ppm(
        languages, to_symbol, got["lang"].map({x: k for k, x in enumerate(languages)}).to_numpy(np.int64),
        got["code"].to_numpy(np.int64), got["n"].to_numpy(np.int64),
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: crc32 of its id as text is
    divisible by 5. A document without an id is neither held out nor learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def identify(df: DataFrame, model: Ppm, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``lang_score``; names that exist already
    get leading underscores. A text that is null or has no letter is ``und``
    with score 0, and so is everything if nothing was learned. Only ``text`` is
    looked at, whole."""
    pred, score, both = fresh(df, ["lang_pred", "lang_score", "_both"])
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("pred string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["pred", "score"])

    return df.withColumn(both, of(F.col(text))).select(
        *df.columns, F.col(f"{both}.pred").alias(pred), F.col(f"{both}.score").alias(score)
    )


def learnable(docs: DataFrame) -> DataFrame:
    """The documents that may be learned from: with an id, not held out."""
    return docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
