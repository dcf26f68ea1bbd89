"""A uniform shuffle into shards of exact sizes, by a communication matrix.

The rows lie in P input partitions. How many rows of partition p go to shard s
is drawn before any row moves: the rows of the P x S matrix are multivariate
hypergeometric draws without replacement from what the shards still lack, so
row sums are the partition sizes, column sums the shard sizes, and every
arrangement of rows is as likely as in a shuffle of the whole table. Then

1. each partition permutes its rows locally (sort by a hash; no shuffle) and
   the result is stored once, so positions can't change afterwards;
2. position and matrix row say to which shard a row goes;
3. rows are exchanged by (shard, chunk of a second hash) and permuted again.

Everything that touches rows is DataFrame functions. The driver only handles
the matrix: one number for each partition and shard, whatever the row count.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.llm.common import fresh, number_within

_POS_BITS = 33  # monotonically_increasing_id: partition above, position below


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes that differ by one at most; the larger shards come first."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` draws without replacement are good."""
    if not draws or not good:
        return 0
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    # numpy stops at 10**9. Beyond it: invert the distribution function over
    # all values within 13 standard deviations; the rest is below a double's
    # precision.
    total = good + bad
    mean = draws * good / total
    reach = 13 * math.sqrt(mean * (bad / total) * (total - draws) / (total - 1)) + 13
    low, high = max(0, draws - bad, int(mean - reach)), min(draws, good, int(mean + reach) + 1)
    k = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    log_p = np.concatenate([[0.0], np.cumsum(ratio)])
    cdf = np.cumsum(np.exp(log_p - log_p.max()))
    return low + int(np.searchsorted(cdf, rng.random() * cdf[-1], side="right"))


def communication_matrix(counts: list[int], sizes: list[int], seed: int = 42) -> list[list[int]]:
    """Row p: how many of partition p's ``counts[p]`` rows each shard gets."""
    rng = np.random.default_rng(seed)
    lack, matrix = list(sizes), []
    for n in counts:
        row, left, rest = [], n, sum(lack)
        for s, want in enumerate(lack):
            rest -= want
            k = _hypergeometric(rng, want, rest, left)
            row.append(k)
            left -= k
        lack = [a - b for a, b in zip(lack, row, strict=True)]
        matrix.append(row)
    return matrix


def shuffle_shards(df: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """``df`` with ``shard`` (int, from 0) and ``slot`` (long, from 0 without a
    gap in each shard): a uniform shuffle whose shard sizes differ by one at
    most. Existing columns of those names are kept, the new ones then get
    leading underscores.

    Nulls, empty and very long values are ordinary rows; repeated rows are
    separate rows; an empty table gives an empty table. The result depends on
    the seed and on how the input is split into partitions, and is fixed once
    the permuted rows are stored, so a lost executor changes nothing.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    mid, key, order = fresh(df, ["_mid", "_key", "_order"])
    shard, slot = fresh(df, ["shard", "slot"])
    # Equal rows get equal keys and are interchangeable, so ties do no harm.
    hashable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    permuted = df.withColumn(key, F.xxhash64(F.lit(seed), *hashable)).sortWithinPartitions(key, *hashable)
    stored = materialize(permuted.drop(key).withColumn(mid, F.monotonically_increasing_id()), "shards")

    part = F.shiftright(F.col(mid), _POS_BITS).cast("int")
    counts = dict(stored.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    per_part = [counts.get(p, 0) for p in range(max(counts, default=-1) + 1)]
    matrix = communication_matrix(per_part, shard_sizes(sum(per_part), shards), seed)
    # Running sums of each row: position < sums[s] for the first time at its shard.
    upto = [[sum(row[: s + 1]) for s in range(shards)] for row in matrix]
    sums = F.element_at(F.from_json(F.lit(json.dumps(upto)), "array<array<bigint>>"), part + 1)
    position = F.col(mid).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    dealt = stored.withColumn(
        shard, F.aggregate(sums, F.lit(0), lambda s, at: s + (at <= position).cast("int"))
    ).withColumn(order, F.xxhash64(F.lit(seed + 1), mid))
    return number_within(dealt, [shard], order, slot).drop(mid, order)
