"""Mixing sources to target weights by Pfair scheduling.

A source's rows are grouped into blocks. With target weight w, block j (from 0)
of a source is released at slot floor(j / w) and due by slot
ceil((j + 1) / w); in each slot the released block with the earliest deadline
is placed. With weights that sum to 1 every block meets its window, so after
any number of slots t each source has placed less than one block more or less
than w * t.

Weights are whole numbers of blocks in a period, so the windows repeat and one
period's schedule, computed once, gives every block's slot. When a
source has no blocks left a new phase starts, in which the remaining sources
keep their weights' proportions. The schedule's size depends on the number of
sources and the period alone; rows are numbered within their source on the
executors, a hot source split into chunks.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.llm.common import fresh, number_within

#: Blocks in a period: the resolution of weights that are given as fractions.
PERIOD = 10_000


def whole_weights(shares: Mapping[str | None, float], period: int = PERIOD) -> dict[str | None, int]:
    """Shares as whole blocks in a period, at least one for each source with a
    positive share (largest remainders; ties by name)."""
    total = sum(shares.values())
    exact = {k: v * period / total for k, v in shares.items() if v > 0}
    out = {k: max(1, int(x)) for k, x in exact.items()}
    missing = period - sum(out.values())
    for k in sorted(exact, key=lambda k: (int(exact[k]) - exact[k], str(k)))[: max(0, missing)]:
        out[k] += 1
    return out


def capped_shares(rows: Mapping[str | None, int], most: float = 1 / 3) -> dict[str | None, float]:
    """Target shares that follow the sources' sizes, but give none more than
    ``most`` (if there are too few sources for that, an equal share)."""
    total = sum(rows.values())
    shares = {k: n / total for k, n in rows.items() if n}
    limit = max(most, 1 / max(1, len(shares)))
    capped: set = set()
    while True:
        over = {k for k, v in shares.items() if k not in capped and v > limit}
        if not over:
            return shares
        capped |= over
        free = sum(rows[k] for k in shares if k not in capped)
        room = 1 - limit * len(capped)
        shares = {k: limit if k in capped else rows[k] / free * room for k in shares}


def pfair_period(weights: list[int]) -> list[int]:
    """Which source has each slot of one period, by earliest deadline first
    (ties to the earlier source)."""
    period = sum(weights)
    waiting = [(0, i, 0) for i, a in enumerate(weights) if a]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int]] = []
    out = []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // weights[i]), i, j))
        _, i, j = heapq.heappop(ready)
        out.append(i)
        if j + 1 < weights[i]:
            heapq.heappush(waiting, ((j + 1) * period // weights[i], i, j + 1))
    return out


@dataclass
class Phase:
    """Blocks ``first[i]`` up to the next phase's of source i, from slot ``base``."""

    base: int
    period: int
    first: list[int]
    weights: list[int]
    slots: list[np.ndarray]  # in a period, of each source's blocks

    def before(self, i: int, t: int) -> int:
        """How many of source i's blocks are in the phase's first t slots."""
        if not self.weights[i]:
            return 0
        return t // self.period * self.weights[i] + int(np.searchsorted(self.slots[i], t % self.period))


def phases(blocks: list[int], weights: list[int]) -> list[Phase]:
    """The schedule of sources with so many blocks: a phase ends with the last
    block of a source, the others go on. Sources of weight 0 are never placed."""
    done, base, out = [0] * len(blocks), 0, []
    while True:
        now = [w if n > d else 0 for w, n, d in zip(weights, blocks, done, strict=True)]
        if not any(now):
            return out
        order = np.array(pfair_period(now))
        p = Phase(base, sum(now), list(done), now, [np.flatnonzero(order == i) for i in range(len(now))])
        ends = []
        for i, w in enumerate(now):
            if w:
                k, m = divmod(blocks[i] - done[i] - 1, w)
                ends.append(k * p.period + int(p.slots[i][m]) + 1)
        length = min(ends)
        out.append(p)
        done = [d + p.before(i, length) for i, d in enumerate(done)]
        base += length


def _key(source: Column) -> Column:
    """A source as a non-null text; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def mix(
    df: DataFrame,
    source: str = "source",
    weights: Mapping[str | None, float] | None = None,
    block_rows: int = 8,
    period: int = PERIOD,
    most: float = 1 / 3,
    seed: int = 42,
) -> DataFrame:
    """``df`` with its place in the mix: ``mix_block`` (the source's block),
    ``mix_phase``, ``mix_slot`` (the block's slot among all blocks, from 0),
    ``mix_place`` (the row's place in its block) and ``mix_weight`` (the target
    share in the phase). Order by slot and place to read the mix.

    ``weights``: the target share of each source; by default the sources' sizes
    with none above ``most``. Null is a source like any other. Every row of a
    source with a positive weight has a place, once; rows of other sources have
    nulls. Within a source rows are in random order. Names that exist already get leading
    underscores. An empty table gives an empty table.

    The number of sources is meant to be that of a hand-written weight table:
    the schedule holds up to sources x ``period`` slots.
    """
    if block_rows < 1 or period < 1:
        raise ValueError("block_rows and period must be at least 1")
    mid, key, order, number, place = fresh(df, ["_mid", "_key", "_order", "_number", "_at"])
    names = fresh(df, ["mix_block", "mix_phase", "mix_slot", "mix_place", "mix_weight"])
    stored = materialize(
        df.withColumn(key, _key(F.col(source))).withColumn(mid, F.monotonically_increasing_id()), "mixing"
    )
    rows = {r[0]: r[1] for r in stored.groupBy(key).agg(F.count(F.lit(1))).collect()}
    if weights is None:
        shares = capped_shares(rows, most)
    else:
        shares = {("n" if k is None else f"s{k}"): v for k, v in weights.items()}
        if any(v < 0 for v in shares.values()):
            raise ValueError("weights must not be negative")
    whole = whole_weights({k: v for k, v in shares.items() if rows.get(k)}, max(period, len(rows))) if rows else {}
    sources = sorted(rows)
    plan = phases([-(-rows[k] // block_rows) for k in sources], [whole.get(k, 0) for k in sources])
    shared = df.sparkSession.sparkContext.broadcast((sources, plan))

    @F.pandas_udf("block long, phase int, slot long, place int, weight double")
    def at(keys: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        sources, plan = shared.value
        index = {k: i for i, k in enumerate(sources)}
        out = pd.DataFrame({
            "block": numbers // block_rows, "phase": pd.array([None] * len(keys), "Int32"),
            "slot": pd.array([None] * len(keys), "Int64"), "place": (numbers % block_rows).astype("int32"),
            "weight": np.nan,
        })
        for k, rows_of in out.groupby(keys.to_numpy()).groups.items():
            i = index[k]
            mine = [n for n, p in enumerate(plan) if p.weights[i]]
            if not mine:
                continue
            block = out.loc[rows_of, "block"].to_numpy()
            which = np.searchsorted([plan[n].first[i] for n in mine], block, side="right") - 1
            for w in np.unique(which):
                p, sel = plan[mine[w]], which == w
                cycle, m = np.divmod(block[sel] - p.first[i], p.weights[i])
                out.loc[rows_of[sel], "slot"] = p.base + cycle * p.period + p.slots[i][m]
                out.loc[rows_of[sel], "phase"] = mine[w]
                out.loc[rows_of[sel], "weight"] = p.weights[i] / p.period
        return out.astype({"weight": "float64"}).where(out["phase"].notna())

    numbered = number_within(stored.withColumn(order, F.xxhash64(F.lit(seed), mid)), [key], order, number)
    fields = ["block", "phase", "slot", "place", "weight"]
    return numbered.withColumn(place, at(F.col(key), F.col(number))).select(
        *df.columns, *[F.col(f"{place}.{f}").alias(n) for f, n in zip(fields, names, strict=True)]
    )
