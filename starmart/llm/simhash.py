"""SimHash near-duplicate groups by a segment-popcount embedding.

Fingerprints that differ in few bits also have close bit counts: cut the 64
bits into 16 segments of 4 and count the ones of each. Flipping a bit moves one
count by one, so the Manhattan distance of the count vectors is a lower bound
of the bit distance. The count vectors are the cells of a grid, and the range
join with distance 2 meets in the middle: vectors at most 2 apart share a grid
cell that is at most 1 from each, so each fingerprint is put in its own cell and
its (at most 32) neighbour cells and only cells with two fingerprints go on.

The exact check meets in the middle too: fingerprints x, y differ in 2 bits or
fewer exactly if some z differs from each in 1 bit or none, and the cell of
such a z is shared by both. So each (cell, x) lists its points z inside the
cell, and fingerprints with a common z are linked, through the smallest one.
A point has at most 65 fingerprints around it, so nothing is quadratic in the
size of a group, and no link between different texts is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.llm.common import fresh, small_batches
from starmart.llm.components import components

SEGMENTS = 16  # of 4 bits: a count fits a hexadecimal digit
_BLOCK = 1 << 17  # shingles whose bits are counted at once


def simhash(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of a text: A-Z lower-cased, words without ASCII
    blanks, shingles with repeats (fewer words: the whole sequence; none: 0)."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a : b - 1], seed) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _BLOCK):
        h = np.array(hashes[at : at + _BLOCK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(h, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """``simhash`` of a string column, as the signed long of the same bits."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            got = np.array([simhash(t, shingle, seed) for t in texts], dtype=np.uint64)
            yield pd.Series(got.view(np.int64))

    return of(text)


def _cell(fp: Column) -> Column:
    """The count vector as one long, a hexadecimal digit for each segment."""
    ones = F.lit(0x1111111111111111)
    out = fp.bitwiseAND(ones)
    for k in (1, 2, 3):
        out = out + F.shiftrightunsigned(fp, k).bitwiseAND(ones)
    return out


def _probes(fps: DataFrame) -> DataFrame:
    """(fp, cell, seg, up): the fingerprint's own cell (seg null) and its
    neighbours, a count of segment ``seg`` up or down by one."""
    at = [F.struct(F.col("own").alias("cell"), F.lit(None).cast("int").alias("seg"), F.lit(None).cast("boolean").alias("up"))]
    for s in range(SEGMENTS):
        count = F.shiftrightunsigned("own", 4 * s).bitwiseAND(F.lit(7))
        for up in (True, False):
            there = F.col("own") + F.lit((1 if up else -1) * (1 << (4 * s)))
            to = F.struct(there.alias("cell"), F.lit(s).alias("seg"), F.lit(up).alias("up"))
            at.append(F.when(count < 4 if up else count > 0, to))
    own = fps.select("fp", _cell(F.col("fp")).alias("own"))
    return own.select("fp", F.explode(F.array(*at)).alias("p")).where("p is not null").select("fp", "p.*")


def _points() -> Column:
    """The points at most one flipped bit from ``fp`` inside the probe's cell."""
    flips = []
    for k in range(4):
        bit = F.expr(f"shiftleft(1L, 4 * seg + {k})")
        is_set = F.col("fp").bitwiseAND(bit) != 0
        flips.append(F.when(is_set != F.col("up"), F.col("fp").bitwiseXOR(bit)))
    return F.when(F.col("seg").isNull(), F.array("fp")).otherwise(F.array(*flips))


def links(fps: DataFrame) -> DataFrame:
    """Star edges (u, v) whose components are those of "2 bits or fewer apart".

    ``fps``: distinct longs ``fp``. Only a fingerprint with a partner appears.
    """
    probes = _probes(fps)
    shared = probes.groupBy("cell").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("cell")
    near = probes.join(shared, "cell", "left_semi")
    met = near.select("fp", F.explode(_points()).alias("z")).where("z is not null")
    hubs = met.groupBy("z").agg(F.min("fp").alias("v"), F.max("fp").alias("b")).where("v < b").select("z", "v")
    return met.join(hubs, "z").where("fp > v").select(F.col("fp").alias("u"), "v").distinct()


def simhash_groups(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, seed: int = 42, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, the columns in ``keep``,
    ``fp`` (signed long), ``group_id`` (the group's smallest fingerprint, never
    null) and ``component_id``, the smallest id of the documents that links of
    2 bits or fewer reach.

    A null text is an empty one: fingerprint 0, linked like any other. Null
    ids are never the smallest; a group that has only null ids gets null.
    Repeated rows give repeated rows. An empty table gives an empty table.
    """
    small_batches(df.sparkSession)
    fp, comp, group = fresh(df.select(doc_id, *keep), ["fp", "component_id", "group_id"])
    prints = materialize(df.select(doc_id, *keep, fingerprint(F.col(text), shingle, seed).alias(fp)), "simhash")
    by_print = materialize(
        prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("first_id")), "simhash-distinct"
    )
    nodes = components(materialize(links(by_print.select("fp")), "simhash-links"))
    rooted = by_print.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias(comp))
    by_print = rooted.join(firsts, "root").select(F.col("fp").alias(fp), F.col("root").alias(group), comp)
    return prints.join(by_print, fp).select(doc_id, *keep, fp, group, comp)


def hex64(x: Column) -> Column:
    """16 lowercase hexadecimal digits of a signed long's bits."""
    return F.lpad(F.lower(F.hex(x)), 16, "0")
