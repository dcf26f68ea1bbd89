"""Phrase collocation mining in the layout of external stream estimation.

Every word begins one window: itself and the (at most 4) words after it in its
piece. Sorted in prefix order, the windows that begin with a phrase stand
together, so one pass over the sorted stream adds up the counts of all phrases
of 3 to 5 words at once: a run of rows with the same first k words is the
phrase of those k words.

1. *Words* and then *pairs* of neighbours are counted, in tasks first. A phrase is
   at least as rare as its rarest pair, so a pair under ``least`` ends every window that
   meets it, as a word under ``least`` ends every pair. Which words or pairs are frequent
   is told by a bitmap of fixed size (``BITS``) of their hashes; an accident
   leaves a window longer than need be and changes no count.
2. *Windows* of 3 words or more are cut from the bytes of a few MB of text at a time, equal ones
   counted there, stored, range-partitioned and sorted in prefix order.
3. A *pass* over each sorted partition closes the runs. A run that touches the
   partition's first or last row may go on in the next one, so its part of the count is
   passed on whatever its size (at most 6 rows a partition); the others need
   ``least`` occurrences. Equal phrases are then added up.
4. The counts that are left are kept as two streams, one in the order of the
   phrases' first parts and one in that of their last parts, and both are
   merge-joined in lockstep with the sorted counts: first parts give ``l``, last
   parts give ``r``. The phrase without its last word and that without its first
   word are among those parts, so the same rows tell which phrases have
   an extension (to the right, to the left) that occurs as often.

A phrase inside a longer one that occurs as often is also inside one that is one
word longer and occurs as often, so extensions by one word are enough.

Sorting needs the windows of a phrase to stand together whatever bytes words hold:
blanks never occur in words, so in a stream's keys blanks and zero bytes change
places and the zero byte, smaller than all, separates words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.llm.common import small_batches

LONGEST = 5
#: Size of the bitmap of frequent words: 4 MB whatever the corpus.
BITS = 1 << 25
#: Bytes of text cut into windows at a time, and windows gathered at a time.
BLOCK = 6 << 20
GATHER = 1 << 18
#: Rows of the sorted stream looked at together, and bytes of neighbours compared at once.
ROWS = 1 << 16
WIDE = 48

_KEY = "key binary, n long"
_PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("n", pa.int64())])
_PHRASE = "lang string, phrase string, words int, n long"
_SWAP = bytes.maketrans(b"\x00\x20", b"\x20\x00")
_BREAK = re.compile(rb"[.,;:!?\x0a-\x0d]")

# What a byte is: 0 part of a word, 1 a blank between words, 2 the end of a piece.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def _escaped(lang: str) -> bytes:
    """A label as key bytes without a zero byte."""
    return lang.encode().replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01")


def _unescaped(key: bytes) -> str:
    return key.replace(b"\x01\x01", b"\x00").replace(b"\x01\x02", b"\x01").decode()


def _slices(texts: list[str]) -> Iterator[bytes]:
    """The texts in lower case (A-Z) as blocks of about ``BLOCK`` bytes, cut where
    pieces end. Only a piece that is longer makes a longer block."""
    held, size = [], 0
    for t in texts:
        data = t.encode().lower()
        while len(data) > BLOCK:
            cut = _BREAK.search(data, BLOCK)
            at = cut.end() if cut else len(data)
            yield data[:at]
            data = data[at:]
        held.append(data)
        size += len(data) + 1
        if size > BLOCK:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(label, block of its texts), a few MB of text at a time."""
    held: dict[str, list[str]] = {}
    size = 0
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size > BLOCK:
                for k, texts in held.items():
                    for block in _slices(texts):
                        yield k, block
                held, size = {}, 0
    for k, texts in held.items():
        for block in _slices(texts):
            yield k, block


def _words(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's words one after the other, each followed by a zero byte, with
    where each begins (and where one more would), and each word's piece."""
    data = np.frombuffer(block.translate(_SWAP_WORDS), dtype=np.uint8)
    kind = _KIND[np.frombuffer(block, dtype=np.uint8)]
    inside = kind == 0
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    # Every byte of a word, and the one after it, which becomes the separator.
    take = inside.copy()
    take[1:] |= inside[:-1]
    joined = np.where(inside, data, 0)[take]
    if len(block) and inside[-1]:
        joined = np.append(joined, np.uint8(0))
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts + 1, out=at[1:])
    return joined.astype(np.uint8, copy=False), at, np.cumsum(kind == 2)[starts]


# Inside words only the zero byte changes places (blanks don't occur there).
_SWAP_WORDS = bytes.maketrans(b"\x00", b"\x20")


def _gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The byte strings ``data[start : start + length]``."""
    offsets = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(length, out=offsets[1:])
    index = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[index]))]
    )


def _tallied(head: bytes, strings: pa.Array) -> pa.RecordBatch:
    """Equal strings once, with their counts, ``head`` put before each."""
    got = pc.value_counts(strings)
    return _keyed(head, got.field(0), got.field(1))


def _keyed(head: bytes, strings: pa.Array, n) -> pa.RecordBatch:
    keys = pc.binary_join_element_wise(pa.scalar(head, pa.large_binary()), strings, pa.scalar(b"\x00", pa.large_binary()))
    return pa.RecordBatch.from_arrays([keys.cast(pa.binary()), pa.array(n).cast(pa.int64())], names=["key", "n"])


def _told(found: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    """Keys, with their words and counts, as phrases of a label."""
    cols = ([], [], [], [])
    for key, words, n in found:
        lang, _, phrase = key.partition(b"\x00")
        for c, x in zip(cols, (_unescaped(lang), phrase.translate(_SWAP).decode(), words, n), strict=True):
            c.append(x)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _PHRASES.types, strict=True)], schema=_PHRASES)


def _as_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted words or pairs as phrases."""
    for b in batches:
        yield _told([(k, k.count(b"\x00"), n) for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label and word, count), and for a label alone its number of words."""
    for lang, block in _blocks(batches):
        data, at, _ = _words(block)
        if len(at) > 1:
            head = _escaped(lang)
            yield _tallied(head, _gathered(data, at[:-1], np.diff(at) - 1))
            yield pa.RecordBatch.from_arrays([pa.array([head], pa.binary()), pa.array([len(at) - 1], pa.int64())], names=["key", "n"])


def _hash(head: bytes, words: list[bytes]) -> np.ndarray:
    """A 64-bit number for each word of a label."""
    head += b"\x00"
    return np.array([xxhash.xxh64_intdigest(head + w, 42) for w in words], dtype=np.uint64)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One for each pair, from those of its words."""
    x = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _known(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = (hashes % np.uint64(BITS)).astype(np.int64)
    return ((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)


def _count_pairs(bitmap: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label and pair, count) of neighbours in a piece that are both frequent."""
    for lang, block in _blocks(batches):
        data, at, piece = _words(block)
        if len(at) < 3:
            continue
        head = _escaped(lang)
        coded = _gathered(data, at[:-1], np.diff(at) - 1).dictionary_encode()
        code, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        fine = _known(bitmap, _hash(head, words))[code]
        first = np.flatnonzero(fine[:-1] & fine[1:] & (piece[1:] == piece[:-1]))
        both, where, n = np.unique(code[first].astype(np.int64) * len(words) + code[first + 1], return_index=True, return_counts=True)
        first = first[where]
        for i in range(0, len(both), GATHER):
            some = first[i : i + GATHER]
            yield _keyed(head, _gathered(data, at[some], at[some + 2] - 1 - at[some]), n[i : i + GATHER])


def _windows(bitmap: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label and window, count) of windows of 3 words or more, ended by the first pair that
    isn't frequent."""
    for lang, block in _blocks(batches):
        data, at, piece = _words(block)
        n = len(at) - 1
        if n < 3:
            continue
        head = _escaped(lang)
        coded = _gathered(data, at[:-1], np.diff(at) - 1).dictionary_encode()
        each = _hash(head, coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        index = np.arange(n, dtype=np.int64)
        # For each word, the first one at which its window must have ended.
        stop = index + 1
        stop[:-1][_known(bitmap, _pair_hash(each[:-1], each[1:])) & (piece[1:] == piece[:-1])] = n
        end = np.minimum(np.minimum.accumulate(stop[::-1])[::-1], index + LONGEST)
        start = np.flatnonzero(end - index >= 3)
        for i in range(0, len(start), GATHER):
            some = start[i : i + GATHER]
            yield _tallied(head, _gathered(data, at[some], at[end[some]] - 1 - at[some]))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bit of each key's word or pair of words."""
    for b in batches:
        out = []
        for key in b.column(0).to_pylist():
            head, *words = key.split(b"\x00")
            each = _hash(head, words)
            out.append(int((each[0] if len(words) == 1 else _pair_hash(each[:1], each[1:])[0]) % np.uint64(BITS)))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["bit"])


def _bitmap(known: DataFrame) -> np.ndarray:
    """The bitmap of all keys of ``known``: ``BITS`` / 8 bytes come to the driver at most."""
    bits = known.select("key").mapInArrow(_bits, "bit long").select((F.col("bit") + 1).alias("bit"))
    parts = bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in parts.toLocalIterator():
        out[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def _agreement(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Bytes in which each row begins like the one before it (0 for the first)."""
    n = len(off) - 1
    size = np.diff(off)
    wide = np.minimum(off[:-1, None] + np.arange(WIDE), len(data) - 1)
    first = np.where(np.arange(WIDE) < size[:, None], data[wide].astype(np.int16), -1)
    differ = first[1:] != first[:-1]
    out = np.zeros(n, dtype=np.int64)
    if n > 1:
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), WIDE)
        for i in np.flatnonzero(out[1:] == WIDE) + 1:
            a, b = data[off[i - 1] : off[i]], data[off[i] : off[i + 1]]
            m = min(len(a), len(b))
            unlike = a[:m] != b[:m]
            out[i] = unlike.argmax() if unlike.any() else m
    return out


def _phrase_counts(least: int):
    """The pass over a sorted partition: runs of equal first words become counts."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # For k words: the run that is open (its key, its count, whether it began with the partition's first row).
        runs: list[tuple[bytes, int, bool] | None] = [None] * (LONGEST + 1)
        begun = False
        for table in _joined(batches):
            keys = table.column(0).combine_chunks()
            n = table.column(1).to_numpy()
            off = np.frombuffer(keys.buffers()[1], dtype=np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
            data = np.frombuffer(keys.buffers()[2], dtype=np.uint8)
            agree = _agreement(data, off)
            seps = np.flatnonzero(data[: off[-1]] == 0)
            seps = seps[seps >= off[0]]
            before = np.searchsorted(seps, off)
            words = np.diff(before)
            found: list[tuple[bytes, int, int]] = []
            for k in range(3, LONGEST + 1):
                have = words >= k
                # Where the first k words end: at the separator after them, or with the row.
                nth = np.minimum(before[:-1] + k, max(len(seps) - 1, 0))
                long = np.where(words > k, seps[nth] if len(seps) else 0, off[1:]) - off[:-1]
                same = np.zeros(len(have), dtype=bool)
                same[1:] = have[1:] & have[:-1] & (long[1:] == long[:-1]) & (agree[1:] >= long[1:])
                starts = np.flatnonzero(have & ~same)
                key_of = lambda i, long=long: data[off[i] : off[i] + long[i]].tobytes()
                sums = np.add.reduceat(np.where(have, n, 0), starts) if len(starts) else np.zeros(0, dtype=np.int64)
                at_start = not begun
                old, runs[k] = runs[k], None
                joins = old is not None and bool(have[0]) and key_of(0) == old[0]
                if old is not None and not joins and (old[2] or old[1] >= least):
                    found.append((old[0], k, old[1]))
                if joins:
                    sums[0] += old[1]
                first = (joins and old[2]) or (at_start and bool(have[0]))
                told_of = sums >= least
                if len(starts):
                    told_of[0] |= first
                    if have[-1]:
                        runs[k] = (key_of(starts[-1]), int(sums[-1]), bool(first and len(starts) == 1))
                        told_of[-1] = False
                found += [(key_of(starts[j]), k, int(sums[j])) for j in np.flatnonzero(told_of)]
            begun = True
            if found:
                yield _told(found)
        last = [(r[0], k, r[1]) for k, r in enumerate(runs) if r is not None]
        if last:
            yield _told(last)

    return scan


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about ``ROWS`` rows."""
    held, rows = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= ROWS:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def phrase_counts(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(``lang``, ``phrase``, ``words``, ``n``) for every phrase of 1 to
    ``LONGEST`` words that occurs ``least`` times or more in a language, and
    (``lang``, ``total``), all word occurrences of each language. Both are stored."""
    small_batches(docs.sparkSession)
    texts = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text")
    )
    alone = F.position(F.lit(b"\x00"), "key") == 0
    spark = docs.sparkSession
    counted = texts.mapInArrow(_count_words, _KEY).groupBy("key").agg(F.sum("n").alias("n"))
    words = materialize(counted.where(alone | (F.col("n") >= least)), "phrase-words")
    told = spark.sparkContext.broadcast(_bitmap(words.where(~alone)))
    counted = texts.mapInArrow(lambda b: _count_pairs(told.value, b), _KEY).groupBy("key").agg(F.sum("n").alias("n"))
    pairs = materialize(counted.where(F.col("n") >= least), "phrase-pairs")
    chained = spark.sparkContext.broadcast(_bitmap(pairs))
    stream = materialize(texts.mapInArrow(lambda b: _windows(chained.value, b), _KEY), "phrase-windows")
    ordered = stream.repartitionByRange("key").sortWithinPartitions("key")
    longer = ordered.mapInArrow(_phrase_counts(least), _PHRASE).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    shorter = words.where(~alone).unionAll(pairs).mapInArrow(_as_phrases, _PHRASE)
    counts = shorter.unionByName(longer.where(F.col("n") >= least))

    @F.pandas_udf("string")
    def label(keys: pd.Series) -> pd.Series:
        return keys.map(_unescaped)

    totals = words.where(alone).select(label("key").alias("lang"), F.col("n").alias("total"))
    return materialize(counts, "phrase-counts"), totals


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) in whole numbers of 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", (wide(a) * wide(n)).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)"), wide(left) * wide(right))


def collocations(docs: DataFrame, least: int = 100, best: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """Each language's ``best`` phrases of 2 to 5 words: ``lang``, ``rank``
    (from 1), ``phrase``, ``a`` (its occurrences), ``l`` and ``r`` (those of the two parts of
    its lowest-scoring cut, ties to the shorter first part), ``n`` (word
    occurrences of the language), ``score`` = floor(1000 * a * n / (l * r)).

    A-Z are taken as lower case; texts end pieces at ``. , ; : ! ?`` and at
    line ends, words at blanks and tabs; phrases don't cross pieces. A phrase inside a longer
    one that occurs as often is left out. Order: score and ``a`` descending, then phrase by
    its UTF-8 bytes.

    A null text is empty; a null label counts as ``und``, together with rows
    labelled so. Repeated rows count as often as they stand there. An empty table gives no rows, and
    neither do texts without words. Other columns are not looked at.
    """
    counts, totals = phrase_counts(docs, least, text, lang)
    whole = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = whole.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({
        "head": F.call_function("substring_index", "phrase", F.lit(" "), F.col("k")),
        "tail": F.call_function("substring_index", "phrase", F.lit(" "), F.col("k") - F.col("words")),
    })
    known = counts.select("lang", F.col("phrase").alias("part"), "n").hint("merge")
    # The stream in prefix order gives l, the one in suffix order r.
    prefix = cuts.join(known.withColumnsRenamed({"part": "head", "n": "l"}), ["lang", "head"])
    both = materialize(prefix.join(known.withColumnsRenamed({"part": "tail", "n": "r"}), ["lang", "tail"]), "phrase-cuts")
    right = both.where("k = words - 1 and k > 1 and a >= l").select("lang", F.col("head").alias("phrase"))
    left = both.where("k = 1 and words > 2 and a >= r").select("lang", F.col("tail").alias("phrase"))
    inside = right.unionAll(left).distinct()
    scored = both.join(totals, "lang").select(
        "lang", "phrase", "a", F.struct(_score(F.col("a"), F.col("total"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut"),
        F.col("total").alias("n"),
    )
    lowest = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("cut").alias("cut"))
    kept = lowest.join(inside, ["lang", "phrase"], "left_anti").select(
        "lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
    # A language's phrases are cut to the best of each salt before they meet.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = kept.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    top = some.where(F.col("rank") <= best).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return top.where(F.col("rank") <= best).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
