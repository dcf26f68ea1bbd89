"""Exact removal of repeated substrings by a distributed suffix merge sort.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else. To find those strings without sorting a suffix for each byte, each window
of ``LENGTH`` bytes is tied to one *anchor*: the start of its 16-byte gram with the smallest
hash (the leftmost). Equal windows have equal anchors at equal places, so it is
enough to compare windows with the same distance to their anchor. The windows of
one anchor are consecutive; together they are its *context*: the suffix to the
right of the anchor and, read backwards, the text to the left of it. An anchor's
windows are thus found again by comparing contexts, of which there is one for some 80 bytes.

Contexts are sorted by a merge sort that never compares a known prefix again:

1. a task sorts its contexts into runs; equal contexts of a run become one
   (their windows are repeats of each other, which settles them);
2. a run is cut at sampled splitters, and each part is front-coded: the length of the
   prefix shared with its predecessor and the rest;
3. a bucket's parts are merged by a loser tree that keeps, at every node, the
   length of the loser's common prefix with the last winner. Two players with different
   lengths are decided by them alone; only equal lengths are compared, from there on.

The merge yields each context's common prefix with its neighbours. With suffixes
first it gives the longest right match; a second sort, of the few contexts that
still may repeat, with left parts first, gives the longest left match. The windows
that the best neighbours repeat are certain, those beyond both maxima are
certainly unique. What may remain between them (windows for which the
best right and the best left neighbour differ) is listed window by window and
counted exactly, with the windows that may equal one of them. Each part also carries its run's
neighbours of the bucket where they may match something in it, so matches across bucket borders are exact.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.checkpoint import app_root, scratch_scope
from starmart.llm.common import small_batches

LENGTH = 200
GRAM = 16
#: Bytes of contexts that one sorted run and one bucket hold, about.
RUN_BYTES = 40 << 20
BUCKET_BYTES = 32 << 20
#: Sampled contexts for each bucket, from which splitters are taken.
SAMPLES = 40
#: Windows of a piece of text that is drawn for the first sample.
PIECE = 1024
#: Open windows of a context that are looked up together, as bits of a long.
SLOT = 50
#: Spark's setting that removes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SLICE = 1 << 17
_SEPARATOR, _PAD = b"\xff", b"\xfe"  # bytes that UTF-8 never has


# --- anchors --------------------------------------------------------------


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return out


@lru_cache(maxsize=2)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random odd byte codes, and powers of an odd base and of its inverse."""
    base = 0x9E3779B97F4A7C15
    codes = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return codes, _powers(base, n), _powers(pow(base, -1, 1 << 64), n)


def anchors(data: np.ndarray, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, first window, last window) arrays; the windows from 0 to
    ``len(data) - length`` are covered in order, each once."""
    codes, power, inverse = _tables(_SLICE + length)
    gram = min(GRAM, length)
    span = length - gram + 1  # grams of a window
    for low in range(0, len(data) - length + 1, _SLICE):
        part = data[low : low + _SLICE + length - 1]
        windows = len(part) - length + 1
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(codes[part] * power[: len(part)], out=total[1:])
        h = (total[gram:] - total[:-gram]) * inverse[: len(part) - gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        # The upper bits order grams; the place below makes ties go to the left.
        key = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
        blocks = -(-len(key) // span)
        padded = np.full(blocks * span, np.uint64((1 << 64) - 1))
        padded[: len(key)] = key
        grid = padded.reshape(blocks, span)
        upto = np.minimum.accumulate(grid, axis=1).ravel()
        since = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(since[:windows], upto[span - 1 : span - 1 + windows])
        at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(at[1:] != at[:-1]) + 1
        first = np.concatenate([[0], cut])
        yield at[first] + low, first + low, np.concatenate([cut - 1, [windows - 1]]) + low


def contexts(text: bytes, length: int = LENGTH) -> Iterator[tuple[int, bytes, bytes]]:
    """(anchor, suffix from the anchor, reversed text before it). Window number
    ``anchor - d`` belongs to it for d from ``length - len(suffix)`` to ``len(before)``."""
    if len(text) < length:
        return
    for at, first, last in anchors(np.frombuffer(text, dtype=np.uint8), length):
        for a, s, e in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
            yield a, text[a : e + length], text[s:a][::-1]


# --- runs and their merge -------------------------------------------------


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """The length of the common prefix, of which ``known`` bytes are known."""
    end, at = min(len(a), len(b)), known
    while at < end and a[at : at + 32] == b[at : at + 32]:
        at += 32
    if at >= end:
        return end
    while at < end and a[at] == b[at]:
        at += 1
    return at


def prefix_lengths(keys: list[bytes]) -> list[int]:
    """Each sorted, distinct key's common prefix with its predecessor (0 first)."""
    out = [0] if keys else []
    for low in range(0, len(keys), 4096):
        part = keys[max(0, low - 1) : low + 4096]
        if len(part) > 1:
            wide = max(map(len, part)) + 1
            grid = np.frombuffer(b"".join(k.ljust(wide, _PAD) for k in part), dtype=np.uint8).reshape(len(part), wide)
            out += (grid[1:] != grid[:-1]).argmax(axis=1).tolist()
    return out


_IDS = ("<i8", "<i4", "<i4", "<i8")  # k1, k2, anchor, known
_LEVEL = 9


def encode(keys: list[bytes], flags: list[int], ids: np.ndarray) -> bytes:
    """A front-coded part of a run. ``ids``: (n, 4) longs, as ``_IDS`` stores them."""
    shared = prefix_lengths(keys)
    tails = [k[c:] for k, c in zip(keys, shared, strict=True)]
    body = b"".join([
        np.array([len(keys)], "<u4").tobytes(), np.array(shared, "<u2").tobytes(), np.array([len(t) for t in tails], "<u2").tobytes(),
        np.array(flags, "u1").tobytes(), *(ids[:, n].astype(kind).tobytes() for n, kind in enumerate(_IDS)), *tails,
    ])
    return zstandard.ZstdCompressor(level=_LEVEL).compress(body)


def decode(data: bytes) -> tuple[list[bytes], list[int], list[int], np.ndarray]:
    """(keys, prefix lengths, flags, ids) of a front-coded part."""
    body = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(body, "<u4", 1)[0])
    shared = np.frombuffer(body, "<u2", n, 4).tolist()
    sizes = np.frombuffer(body, "<u2", n, 4 + 2 * n).tolist()
    flags = np.frombuffer(body, "u1", n, 4 + 4 * n).tolist()
    at, columns, last, keys = 4 + 5 * n, [], b"", []
    for kind in _IDS:
        columns.append(np.frombuffer(body, kind, n, at).astype(np.int64))
        at += columns[-1].size * np.dtype(kind).itemsize
    ids = np.column_stack(columns)
    for c, size in zip(shared, sizes, strict=True):
        last = last[:c] + body[at : at + size]
        keys.append(last)
        at += size
    return keys, shared, flags, ids


def merge(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Merge sorted runs (keys, prefix lengths) with a loser tree: (run,
    position, common prefix with the one before) in the order of the keys."""
    size = 1
    while size < len(runs):
        size *= 2
    now: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (size - len(runs))
    place, known, tree = [0] * size, [0] * size, [0] * size

    def play(i: int, j: int) -> tuple[int, int]:
        """(winner, loser); equal known lengths are compared from there on, and the
        loser keeps its common prefix with the winner."""
        a, b = now[i], now[j]
        if a is None or b is None:
            return (j, i) if a is None else (i, j)
        if known[i] != known[j]:
            return (i, j) if known[i] > known[j] else (j, i)
        c = common(a, b, known[i])
        if a[c:] <= b[c:]:
            known[j] = c
            return i, j
        known[i] = c
        return j, i

    def build(node: int) -> int:
        if node >= size:
            return node - size
        winner, tree[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    w = build(1) if size > 1 else 0
    while now[w] is not None:
        yield w, place[w], known[w]
        place[w] += 1
        keys, shared = runs[w]
        if place[w] < len(keys):
            now[w], known[w] = keys[place[w]], shared[place[w]]
        else:
            now[w] = None
        node = (w + size) >> 1
        while node:
            w, tree[node] = play(w, tree[node])
            node >>= 1


# --- windows of contexts --------------------------------------------------


def _pair(x: bytes, y: bytes, c: int, fx: int, fy: int, length: int, right_first: bool) -> tuple[int, int, int]:
    """Of two contexts with ``c`` bytes in common: the longest match of the first parts, and the windows
    (distance from, to) that both have; to < from if none. fx, fy: lengths of the first parts."""
    if c > fx:  # equal first parts and the separator
        first, second = fx, c - fx - 1
    else:
        first = c
        if first + min(len(x) - fx, len(y) - fy) - 1 < length:
            return first, 1, 0
        second = common(x[fx + 1 :], y[fy + 1 :])
    right, left = (first, second) if right_first else (second, first)
    return first, length - right, left


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint, not adjacent."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _holes(low: int, high: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What of low..high the disjoint spans leave open."""
    out = []
    for a, b in spans:
        if a > low:
            out.append((low, min(high, a - 1)))
        low = max(low, b + 1)
        if low > high:
            return out
    return [*out, (low, high)] if low <= high else out


SINGLE, MANY, GHOST, SETTLED = 0, 1, 2, 3  # flags of a key in a run
BLOCK, WINDOWS, NEXT, OPEN, NEAR = 0, 1, 2, 3, 4  # kinds of rows

_PART = "bucket int, kind int, payload binary"
_ROW = "kind int, k1 long, k2 int, low int, high int, anchor int, suffix binary, before binary, known long, settled boolean"
_NAMES = ["kind", "k1", "k2", "low", "high", "anchor", "suffix", "before", "known", "settled"]


def _parts(keys: list[bytes], flags: list[int], ids: np.ndarray, splitters: list[bytes], least: int) -> Iterator[tuple[int, int, bytes]]:
    """A run cut at the splitters; each part has the run's neighbours of the bucket as ghosts. What is beyond
    a border shares no more with the bucket's keys than with the border, so no ghost is needed that shares
    fewer than ``least`` bytes with it, the fewest that contexts with a common window share."""
    cuts = [0, *(bisect_left(keys, s) for s in splitters), len(keys)]
    for b, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)):
        low = i - 1 if i and common(keys[i - 1], splitters[b - 1]) >= least else i
        high = j + 1 if j < len(keys) and common(keys[j], splitters[b]) >= least else j
        mark = [GHOST] * (i - low) + flags[i:j] + [GHOST] * (high - j)
        if mark:
            yield b, BLOCK, encode(keys[low:high], mark, ids[low:high])


def _joined(spans: np.ndarray) -> np.ndarray:
    """Rows (k1, k2, first, last) of windows; consecutive ones of a document as one row."""
    x = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
    new = np.ones(len(x), dtype=bool)
    new[1:] = (x[1:, :2] != x[:-1, :2]).any(axis=1) | (x[1:, 2] > x[:-1, 3] + 1)
    start = np.flatnonzero(new)
    return np.column_stack([x[start, :3], np.maximum.reduceat(x[:, 3], start)])


def _run(rows: list[tuple], length: int, splitters: list[bytes], least: int) -> Iterator[tuple[int, int, bytes]]:
    """A run of (key, k1, k2, anchor, known, flag), sorted and cut. Equal unflagged keys become
    one: their windows repeat each other, which is settled here."""
    rows.sort()
    keys: list[bytes] = []
    flags: list[int] = []
    ids, done = [], []
    for n, (key, k1, k2, a, known, flag) in enumerate(rows):
        again = n > 0 and rows[n - 1][0] == key
        many = flag == SINGLE and (again or (n + 1 < len(rows) and rows[n + 1][0] == key))
        if many:
            right = key.index(_SEPARATOR)
            done.append((k1, k2, a - (len(key) - right - 1), a - (length - right)))
        if not (many and again):
            keys.append(key)
            flags.append(MANY if many else flag)
            ids.append((k1, k2, a, known))
    yield from _parts(keys, flags, np.array(ids, dtype=np.int64).reshape(-1, 4), splitters, least)
    if done:
        x = _joined(np.array(done, dtype=np.int64))
        yield int(x[0, 0]) % (len(splitters) + 1), WINDOWS, zstandard.ZstdCompressor().compress(x.astype("<i8").tobytes())


def _runs(rows: Iterator[tuple], length: int, splitters: list[bytes], least: int) -> Iterator[pd.DataFrame]:
    """Cut a stream of rows into runs of bounded size."""
    part, size = [], 0
    for r in rows:
        part.append(r)
        size += len(r[0]) + 100
        if size >= RUN_BYTES:
            yield pd.DataFrame(_run(part, length, splitters, least), columns=["bucket", "kind", "payload"])
            part, size = [], 0
    if part:
        yield pd.DataFrame(_run(part, length, splitters, least), columns=["bucket", "kind", "payload"])


def _neighbours(parts: list[bytes], length: int, right_first: bool) -> Iterator[list]:
    """For each context of a bucket: [key, flag, id, length of its first part, longest match of that with
    another context, spans of windows that a neighbour repeats, whether it equals the one before]."""
    runs = [decode(p) for p in parts]
    before = None
    for r, n, c in merge([(keys, shared) for keys, shared, _, _ in runs]):
        key = runs[r][0][n]
        now = [key, runs[r][2][n], runs[r][3][n], key.index(_SEPARATOR), 0, [], False]
        if before is not None:
            now[4], low, high = _pair(before[0], key, c, before[3], now[3], length, right_first)
            before[4] = max(before[4], now[4])
            if low <= high:
                before[5].append((low, high))
                now[5].append((low, high))
            now[6] = c == len(key) == len(before[0])
            if before[1] != GHOST:
                yield before
        before = now
    if before is not None and before[1] != GHOST:
        yield before


def _pack(longest: int, spans: list[tuple[int, int]]) -> int:
    """The longest right match and at most two spans in one number."""
    out = longest
    for low, high in [*spans, (1, 0), (1, 0)][:2]:
        out = (out << 24) | (low << 12) | high
    return out


def _unpack(known: int) -> tuple[int, list[tuple[int, int]]]:
    pairs = [((known >> at + 12) & 0xFFF, (known >> at) & 0xFFF) for at in (24, 0)]
    return known >> 48, [p for p in pairs if p[0] <= p[1]]


def _by_right(parts: list[bytes], length: int) -> Iterator[tuple]:
    """The first sort's outcome: windows that certainly repeat, and the contexts that go on."""
    for key, flag, (k1, k2, a, _), f, longest, spans, again in _neighbours(parts, length, True):
        reach = len(key) - f - 1
        if flag == MANY:
            longest, spans = f, [(length - f, reach)]
        if length - longest > reach:
            continue  # no window of it starts anywhere else
        spans = _union(spans)
        settled = not _holes(length - longest, reach, spans)
        if flag != MANY:
            for low, high in spans:
                yield WINDOWS, k1, k2, a - high, a - low, None, None, None, None, None
        if not (again and settled):
            yield NEXT, k1, k2, None, None, a, key[:f], key[f + 1 :], _pack(longest, spans), settled


def _by_left(parts: list[bytes], length: int) -> Iterator[tuple]:
    """The second sort's: more windows that repeat, those still open, and for each context
    the windows that may equal one of another, as far as its longest matches reach."""
    for key, flag, (k1, k2, a, known), f, longest, spans, _ in _neighbours(parts, length, False):
        right, before = _unpack(int(known))
        if length - right > longest:
            continue
        yield NEAR, k1, k2, length - right, longest, a, key[f + 1 :], key[:f], None, None
        if flag == SETTLED:
            continue
        spans = _union(spans + before)
        for low, high in spans:
            yield WINDOWS, k1, k2, a - high, a - low, None, None, None, None, None
        for low, high in _holes(length - right, longest, spans):
            yield OPEN, k1, k2, low, high, a, key[f + 1 :], key[:f], None, None


def _merge_buckets(parts: DataFrame, buckets: int, outcome, length: int) -> DataFrame:
    """Bring a bucket's parts together, merge them and give the outcome's rows."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by: dict[int, list[bytes]] = {}
        for b in batches:
            for bucket, kind, payload in zip(b["bucket"], b["kind"], b["payload"], strict=True):
                if kind == BLOCK:
                    by.setdefault(bucket, []).append(payload)
                else:
                    x = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), "<i8").reshape(-1, 4)
                    out = pd.DataFrame(None, index=range(len(x)), columns=_NAMES, dtype=object)
                    out["kind"] = WINDOWS
                    for n, name in enumerate(_NAMES[1:5]):
                        out[name] = x[:, n]
                    yield out
        for bucket in sorted(by):
            rows = []
            for row in outcome(by.pop(bucket), length):
                rows.append(row)
                if len(rows) == 10_000:
                    yield pd.DataFrame(rows, columns=_NAMES, dtype=object)
                    rows = []
            yield pd.DataFrame(rows, columns=_NAMES, dtype=object)

    return parts.repartitionById(buckets, "bucket").mapInPandas(work, _ROW)


def _stored(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """``materialize`` with a denser codec, for rows that hold much text. The shuffle files, larger than the
    table, go as soon as it is written, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = f"{folder or app_root(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, True)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _pieces(docs: DataFrame, share: float, length: int) -> DataFrame:
    """About ``share`` of the bytes: pieces of ``PIECE`` windows drawn by a hash of
    document and place, so a long document counts by its length."""
    last = F.floor((F.octet_length("data") - length) / PIECE)
    drawn = F.filter(
        F.sequence(F.lit(0).cast("long"), last),
        lambda i: F.pmod(F.xxhash64("k1", "k2", i, F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1,
    )
    x = docs.where(F.octet_length("data") >= length).select("data", F.explode(drawn).alias("piece"))
    return x.select(F.substring("data", (F.col("piece") * PIECE + 1).cast("int"), F.lit(PIECE + length - 1)).alias("data"))


def _splitters(keys: DataFrame, buckets: int) -> list[bytes]:
    """Evenly placed keys of a sample (a few dozen rows for each bucket)."""
    have = sorted({bytes(r[0]) for r in keys.collect()})
    return sorted({have[len(have) * b // buckets] for b in range(1, buckets)}) if have else []


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, low, high): windows low..high of the document with these keys start
    anywhere else, too; rows may overlap. ``docs``: k1, k2 (a long and an int that tell
    documents apart), data (binary, UTF-8). Rows with the same keys and data
    count as different documents."""
    spark = docs.sparkSession
    small_batches(spark)
    long = docs.where(F.octet_length("data") >= length)
    volume = long.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for b in batches:
            for k1, k2, data in zip(b["k1"], b["k2"], b["data"], strict=True):
                for a, suffix, before in contexts(data, length):
                    yield suffix + _SEPARATOR + before, k1, k2, a, 0, SINGLE

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for data in b["data"]:
                some = [x + _SEPARATOR + y for a, x, y in contexts(data, length) if a % 4 == 0]
                yield pd.DataFrame({"key": some})

    def cut_runs(splitters: list[bytes], stream, frame: DataFrame, least: int) -> DataFrame:
        shared = spark.sparkContext.broadcast(splitters)
        return frame.mapInPandas(lambda batches: _runs(stream(batches), length, shared.value, least), _PART)

    # About 3.4 bytes of contexts for each byte, in pieces of 80 bytes of text.
    buckets = max(2 * cores, int(3.4 * volume) // BUCKET_BYTES + 1)
    share = min(1.0, 4 * SAMPLES * buckets * 80 / max(1, volume))
    splitters = _splitters(_pieces(long, share, length).mapInPandas(sampled, "key binary"), buckets)
    runs = cut_runs(splitters, rows, long.select("k1", "k2", "data"), min(GRAM, length))  # with a window, contexts share its gram
    first = _stored(_merge_buckets(runs, len(splitters) + 1, _by_right, length), "suffix-right")

    going = first.where(F.col("kind") == NEXT)
    count, size = going.agg(F.count(F.lit(1)), F.sum(F.octet_length("suffix") + F.octet_length("before"))).first()
    windows = first.where(F.col("kind") == WINDOWS).select("k1", "k2", "low", "high")
    if not count or going.where("not settled").isEmpty():
        return windows

    def reversed_rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for b in batches:
            for r in b.itertuples(index=False):
                yield r.before + _SEPARATOR + r.suffix, r.k1, r.k2, r.anchor, r.known, SETTLED if r.settled else SINGLE

    buckets = max(2 * cores, int(size) // BUCKET_BYTES + 1)
    lot = F.pmod(F.xxhash64("k1", "k2", "anchor"), F.lit(1 << 20)) < int(min(1.0, SAMPLES * buckets / count) * (1 << 20)) + 1
    key = F.concat("before", F.lit(_SEPARATOR), "suffix").alias("key")
    splitters = _splitters(going.where(lot).select(key), buckets)
    runs = cut_runs(splitters, reversed_rows, going.select("k1", "k2", "anchor", "suffix", "before", "known", "settled"), 1)  # a window from the anchor on is settled by then
    second = _stored(_merge_buckets(runs, len(splitters) + 1, _by_left, length), "suffix-left")
    windows = windows.unionByName(second.where(F.col("kind") == WINDOWS).select("k1", "k2", "low", "high"))
    still = second.where(F.col("kind") == OPEN)
    return windows if still.isEmpty() else windows.unionByName(_listed(second.where(F.col("kind") == NEAR), still, length))


def _slots(rows: DataFrame, length: int) -> DataFrame:
    """Each row once for each slot of ``SLOT`` windows that its windows low..high reach, cut to the slot. ``core``
    is a hash of the text around the anchor that lies in all windows of the slot, so equal windows have equal cores."""
    start, least = F.col("slot") * SLOT, min(GRAM, length)
    core = F.xxhash64("slot", F.substring("before", F.lit(1), start), F.substring("suffix", F.lit(1), F.greatest(F.lit(least), length + 1 - SLOT - start)))
    x = rows.withColumn("slot", F.explode(F.sequence(F.floor(F.col("low") / SLOT).cast("int"), F.floor(F.col("high") / SLOT).cast("int"))))
    return x.withColumns({"core": core, "low": F.greatest("low", start), "high": F.least("high", start + (SLOT - 1))})


_ASKED = ["k1", "k2", "anchor", "suffix", "before", "low", "high", "open"]


def _strings(rows: DataFrame, length: int) -> DataFrame:
    """(k1, k2, low, window): the windows low..high, as strings, whose bits are set in ``open``."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["k1", "k2", "low", "window"]
        rows: list[tuple] = []
        for b in batches:
            for k1, k2, anchor, suffix, before, low, high, wanted in zip(*(b[c] for c in _ASKED), strict=True):
                text, at = before[::-1] + suffix, len(before)
                for d in range(low, high + 1):
                    if wanted >> d % SLOT & 1:
                        rows.append((k1, k2, anchor - d, text[at - d : at - d + length]))
                if len(rows) > 10_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
        yield pd.DataFrame(rows, columns=names)

    return rows.select(_ASKED).mapInPandas(work, "k1 long, k2 int, low int, window binary")


def _rivals(near: DataFrame, still: DataFrame, length: int) -> DataFrame:
    """The windows of ``near``, as strings, that have the place and the core of an open one."""
    bits = F.expr(f"shiftleft(shiftleft(1L, high - low + 1) - 1L, low - slot * {SLOT})")
    wanted = _slots(still, length).groupBy("core").agg(F.bit_or(bits).alias("open"))
    return _strings(_slots(near, length).join(wanted, "core"), length)


def _listed(near: DataFrame, still: DataFrame, length: int) -> DataFrame:
    """The open windows one by one: they and all that may equal one of them are listed as
    strings (``near`` has both), and equal strings are counted."""
    twice = _rivals(near, still, length).groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    asked = _strings(still.withColumn("open", F.lit(-1).cast("long")), length)
    return asked.join(twice, "window", "left_semi").select("k1", "k2", "low", F.col("low").alias("high"))


def remove_repeats(df: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Each row of ``df`` with what is left of its text: ``doc_id``, ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and, if
    asked for, ``kept`` (binary) and ``removed`` (arrays of first byte and end).

    Texts are UTF-8 bytes; a null text is empty; matches never cross rows.
    Repeated rows are different documents: such a text of ``length`` bytes or more goes whole.
    Strings are judged on the input. An empty table gives an empty table.
    """
    kind = dict(df.dtypes)[doc_id]
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    docs = df.select(F.col(doc_id).alias("doc_id"), data.alias("data")).withColumns(
        {"k1": F.xxhash64("doc_id", "data"), "k2": F.shiftright(F.xxhash64("data", F.lit(1)), 32).cast("int")}
    )
    folder = app_root(df.sparkSession)
    with scratch_scope(df.sparkSession):  # the sorts' tables go as soon as their outcome is stored
        found = _stored(repeated_windows(docs.select("k1", "k2", "data"), length), "suffix-windows", folder)
    spans = found.groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    schema = f"`{doc_id}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    names = [doc_id, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if with_text:
        schema, names = schema + ", kept binary, removed array<array<int>>", [*names, "kept", "removed"]

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield b.assign(data=[press.compress(x) for x in b["data"]])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for ident, packed, windows in zip(b["doc_id"].astype(object), b["data"], b["spans"], strict=True):
                whole = press.decompress(packed)
                # Bytes first..last of windows low..high; touching runs are one.
                gone = [] if windows is None else _union([(w["low"], w["high"] + length - 1) for w in windows])
                at, left = 0, []
                for i, j in gone:
                    left.append(whole[at:i])
                    at = j + 1
                kept = b"".join([*left, whole[at:]])
                row = [None if pd.isna(ident) else ident, len(whole), len(whole) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()]
                out.append(row + ([kept, [[i, j + 1] for i, j in gone]] if with_text else []))
            yield pd.DataFrame(out, columns=names)

    # Texts move once, for the join with their spans, and small.
    small = docs.select("doc_id", "k1", "k2", "data").mapInPandas(shrink, f"doc_id {kind}, k1 long, k2 int, data binary")
    return small.join(spans, ["k1", "k2"], "left").select("doc_id", "data", "spans").mapInPandas(cut, schema)
