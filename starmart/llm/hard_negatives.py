"""Hard-negative mining by Strassen products of whole-number tiles.

Vectors become whole numbers, so every score is an exact integer and ties are
real ties. Anchors and candidates are dealt into tiles of bounded size; a task
gets one tile of each kind and multiplies them by Strassen's recursion: seven
products of half the size instead of eight, down to tiles whose shortest side
is ``LEAF``, with zero rows and columns where a side can't be halved. All
sums are int64: adding wraps around, so intermediate sums can't spoil a result
that fits, and results do fit because squared lengths are checked to be under 2**62.

Two rounds over the tiles, each leaving heaps that merge:

1. *Positives.* An anchor's best candidates of its own label, by (score, id):
   each tile keeps the first ``positives``, and those of all tiles are merged.
2. *Windows.* With a positive's score known, a tile keeps its first ``negatives``
   candidates of another label within the positive's window of scores, and those of
   all tiles are merged.

Every candidate tile meets every anchor tile once a round: that is the stated query set
against all rows, in blocks. A tile's rows are dealt by a hash of the row, so no
label, vector or id makes a tile larger than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.llm.common import fresh

#: Shortest side of a product that isn't divided any more.
LEAF = 16
#: Rows of a tile of candidates and of one of anchors, about.
CANDIDATES = 8192
ANCHORS = 1024
#: Squared lengths must stay below this, so that every score fits 64 bits.
LIMIT = 2.0**62


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices; sides are padded with zeros to be halved."""
    (m, k), n = a.shape, b.shape[1]
    times = 0
    while min(m, k, n) >> (times + 1) >= leaf:
        times += 1
    if not times:
        return a @ b
    unit = 1 << times
    up = lambda x: -(-x // unit) * unit
    left, right = np.zeros((up(m), up(k)), dtype=np.int64), np.zeros((up(k), up(n)), dtype=np.int64)
    left[:m, :k], right[:k, :n] = a, b
    return _halved(left, right, times)[:m, :n]


def _halved(a: np.ndarray, b: np.ndarray, times: int) -> np.ndarray:
    """Seven products of quarters (Strassen 1969), ``times`` levels deep."""
    if not times:
        return np.ascontiguousarray(a) @ np.ascontiguousarray(b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    times -= 1
    p1 = _halved(a11 + a22, b11 + b22, times)
    p2 = _halved(a21 + a22, b11, times)
    p3 = _halved(a11, b12 - b22, times)
    p4 = _halved(a22, b21 - b11, times)
    p5 = _halved(a11 + a12, b22, times)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[:m, :n] = p1 + p4 - p5 + _halved(a12 - a22, b21 + b22, times)
    out[m:, n:] = p1 - p2 + p3 + _halved(a21 - a11, b11 + b12, times)
    return out


def whole_vectors(df: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """(``id``, ``label``, ``v`` array of longs) of the rows that take part, equal rows once."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = df.where(v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.col(label).isNotNull() & F.col(vec_id).isNotNull())
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    size = F.aggregate("w", F.lit(0.0), lambda s, x: s + x * x)
    checked = F.when(size < LIMIT, F.transform("w", lambda x: x.cast("long"))).otherwise(
        F.raise_error(F.lit("a vector is too long for exact 64-bit scores"))
    )
    return some.select(F.col(vec_id).alias("id"), F.col(label).cast("long").alias("label"), scaled.alias("w")).select(
        "id", "label", checked.alias("v")
    ).distinct()


def _matrices(a: pd.DataFrame, b: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor positions, candidate positions, scores), by vector length."""
    sizes_a, sizes_b = a["v"].map(len).to_numpy(), b["v"].map(len).to_numpy()
    for dim in np.intersect1d(sizes_a, sizes_b):
        i, j = np.flatnonzero(sizes_a == dim), np.flatnonzero(sizes_b == dim)
        x, y = (np.array(list(f["v"].iloc[at]), dtype=np.int64).reshape(len(at), dim) for f, at in ((a, i), (b, j)))
        yield i, j, strassen(x, np.ascontiguousarray(y.T))


def _first(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` by score descending, then id."""
    if len(scores) > most:
        # All that tie with the last one that counts stay until ids decide.
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:most]]


def _merged(df: DataFrame, keys: list[str], score: str, other: str, most: int) -> DataFrame:
    """The first ``most`` of each key over all tiles, with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), other)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _tiles(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Rows with a tile number, dealt by a hash of the row; and how many tiles there are."""
    tiles = max(1, -(-rows.count() // size))
    return rows.withColumn(name, F.pmod(F.xxhash64("id", "label", "v"), F.lit(tiles)).cast("int")), tiles


def hard_negatives(
    df: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    lowest: int = 80,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``.

    Anchors are the rows for which ``anchor`` holds. Components become
    floor(``scale`` * x); a score is the inner product. An anchor's positives are its first
    ``positives`` rows of the same label with another id; a positive's negatives are the
    first ``negatives`` rows of other labels with ``lowest`` / 100 * positive score <= score <=
    positive score. Higher scores come first, ties by smaller id; all, if there are fewer.

    Rows with a null id, label or vector, or with any null or non-finite
    component, take no part. Empty vectors score 0; vectors of different lengths are never compared.
    Repeated rows count once; rows that share an id but not the rest are rows of their own, and
    none of them is the other's positive (a negative it can be). A vector whose scores could pass 64 bits
    (squared length of 2**62 or more after scaling) is an error. An empty table gives no rows.
    """
    asked, = fresh(df, ["_asked"])
    flagged = df.withColumn(asked, F.coalesce(anchor, F.lit(False)))
    rows = materialize(whole_vectors(df, vec_id, vector, label, scale), "hard-rows")
    chosen = materialize(whole_vectors(flagged.where(F.col(asked)), vec_id, vector, label, scale), "hard-anchors")
    stored, count = _tiles(rows, CANDIDATES, "c")
    dealt, groups = _tiles(chosen, ANCHORS, "g")
    # Every tile of one kind meets every tile of the other.
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = stored.withColumn("g", every(groups))
    met = lambda left: left.withColumn("c", every(count)).groupBy("g", "c").cogroup(right.groupBy("g", "c"))

    def near(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        names, labels = b["id"].to_numpy(), b["label"].to_numpy()
        for i, j, score in _matrices(a, b):
            for k, s in zip(i, score, strict=True):
                at = np.flatnonzero((labels[j] == a["label"].iloc[k]) & (names[j] != a["id"].iloc[k]))
                best = at[_first(s[at], names[j][at], positives)]
                out += [(k, names[j][m], s[m]) for m in best]
        got = pd.DataFrame(out, columns=["k", "positive_id", "positive_score"])
        mine = a.iloc[got["k"].to_numpy(dtype=int)].reset_index(drop=True)
        return pd.DataFrame({"anchor_id": mine["id"], "label": mine["label"], "v": mine["v"],
                             "positive_id": got["positive_id"], "positive_score": got["positive_score"]})

    def window(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        names, labels = b["id"].to_numpy(), b["label"].to_numpy()
        for i, j, score in _matrices(a, b):
            for k, s in zip(i, score, strict=True):
                other = labels[j] != a["label"].iloc[k]
                for positive, top in zip(a["pids"].iloc[k], a["pscores"].iloc[k], strict=True):
                    # In whole numbers of any size: 100 * score passes 64 bits.
                    least = -(-lowest * int(top) // 100)
                    at = np.flatnonzero(other & (s <= top) & (s >= least))
                    out += [(a["id"].iloc[k], a["label"].iloc[k], a["vkey"].iloc[k], positive, names[j][m], top, s[m])
                            for m in at[_first(s[at], names[j][at], negatives)]]
        return pd.DataFrame(out, columns=["anchor_id", "label", "vkey", "positive_id", "negative_id", "positive_score", "negative_score"])

    kind = "anchor_id long, label long, v array<long>, positive_id long, positive_score long"
    heaps = met(dealt).applyInPandas(near, kind)
    best = _merged(heaps, ["anchor_id", "label", "v"], "positive_score", "positive_id", positives)
    known = best.groupBy(F.col("anchor_id").alias("id"), "label", "v").agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("p")
    )
    ready = materialize(
        known.select("id", "label", "v", F.xxhash64("v").alias("vkey"), F.col("p.positive_id").alias("pids"), F.col("p.positive_score").alias("pscores")),
        "hard-positives",
    )
    again, groups = _tiles(ready, ANCHORS, "g")
    right = stored.withColumn("g", every(groups))
    kind = "anchor_id long, label long, vkey long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = met(again).applyInPandas(window, kind)
    keys = ["anchor_id", "label", "vkey", "positive_id", "positive_score"]
    return _merged(found, keys, "negative_score", "negative_id", negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
