"""Nearest neighbours by cosine with multiprobe p-stable hashing.

On the unit sphere the largest cosine is the smallest Euclidean distance, for
which projections on Gaussian vectors are 2-stable: a table's hash function is
``floor((a . x + b) / w)``, and a cell joins ``HASHES`` of them. A query visits
its own cell and then perturbed ones (each function down, same or up by one) in
the order of estimated success: the smaller the sum of squared distances to the
crossed cell walls, the earlier. The candidates of all tables are merged and reranked
by their exact cosine in double precision.

Every vector is indexed in every table. Equal vectors are one class, so a
vector that a third of the rows repeat is hashed once; a class keeps as many of
its smallest ids as any answer can use. Large cells are split into blocks of
bounded size, queries into batches, and a task multiplies a block's matrix with the queries of a
batch that visit it, so no cell and no crowd of queries has to fit one task and no pairs are stored.

A query for which the visited cells hold fewer candidates than it asks for (among few or
scattered vectors) is asked again, of all blocks of one table, which hold every vector: it gets
its exact answer, or all candidates there are.

How many cells must be visited for a recall depends on the data: for nearly
independent vectors the nearest are hardly nearer than others, and the default
probes then visit most of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.checkpoint import materialize

TABLES = 5
HASHES = 8
PROBES = 120
#: Wall distance in units of a projection's spread over unit vectors.
WIDTH = 2.5
#: Vectors of a cell that one block holds.
BLOCK = 4096
#: Vectors (of all tables) that one task's group holds, about.
GROUP = 32_768
#: Queries that meet a group at a time, about.
QUERIES = 4096


@lru_cache(maxsize=8)
def _functions(dim: int, tables: int, hashes: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.normal(size=(tables, dim, hashes)), rng.random((tables, 1, hashes)) * width


def _projected(x: np.ndarray, tables: int, hashes: int, width: float, seed: int) -> np.ndarray:
    """(tables, rows, hashes): projections in units of the wall distance."""
    a, b = _functions(x.shape[1], tables, hashes, width, seed)
    return (np.einsum("nd,tdk->tnk", x, a) + b) / width


def _cell(table: np.ndarray, dim: int, walls: np.ndarray) -> np.ndarray:
    """One 64-bit number for a table's cell. Accidents only add candidates."""
    out = np.full(walls.shape[:-1], np.uint64(dim)) * np.uint64(1_000_003) + table.astype(np.uint64)
    for k in range(walls.shape[-1]):
        out = (out ^ walls[..., k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


@lru_cache(maxsize=4)
def _moves(hashes: int) -> np.ndarray:
    """All perturbations of at most 4 functions, the unperturbed one first."""
    some = np.array([m for m in product((0, -1, 1), repeat=hashes) if np.count_nonzero(m) <= 4], dtype=np.int8)
    return some[np.argsort(np.count_nonzero(some, axis=1), kind="stable")]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither over- nor underflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_dim(vectors: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) for each vector length of a batch."""
    size = vectors.map(len).to_numpy()
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        yield at, np.array([np.asarray(vectors.iloc[i], dtype=np.float64) for i in at])


def usable(vector: str) -> F.Column:
    """Neither null, empty or zero nor with a null or non-finite component."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _classes(rows: DataFrame, most: int) -> DataFrame:
    """(vid, vector, ids): equal vectors once, with their ``most`` smallest ids.

    Ids are cut per (vector, salt) before they meet per vector, so the rows of a
    very frequent vector are reduced in many tasks.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(64))
    x = rows.select("id", F.transform("vector", lambda v: v.cast("double") + 0.0).alias("vector"), salt.alias("salt"))
    first = x.withColumn("n", F.row_number().over(Window.partitionBy("vector", "salt").orderBy("id"))).where(F.col("n") <= most)
    few = first.withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("n") <= most)
    grouped = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("vid"), "vector", "ids")


def nearest(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
    width: float = WIDTH,
    seed: int = 42,
) -> DataFrame:
    """For each row of ``queries`` (rows of ``df``, same columns) its ``k``
    nearest found among the other rows of ``df``: ``query_id``, ``rank`` (from
    1), ``vec_id``, ``score`` (the cosine), nearest first, ties to the smaller
    id. All candidates, if there are fewer than ``k``.

    Vectors that are null, empty or zero, or hold a null or non-finite
    component, and rows with a null id take no part. Vectors of different
    lengths are never neighbours. Repeated rows (same id and vector) count once.
    """
    rows = df.where(usable(vector) & F.col(vec_id).isNotNull()).select(F.col(vec_id).alias("id"), F.col(vector).alias("vector"))
    asked = queries.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).alias("query_id"), F.transform(vector, lambda v: v.cast("double") + 0.0).alias("vector")
    ).distinct()
    classes = materialize(_classes(rows.distinct(), k + 1), "ann-classes")
    wanted = materialize(asked.join(classes.select("vid", "vector"), "vector").select("query_id", "vid"), "ann-queries")

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at, x in _by_dim(b["vector"]):
                walls = np.floor(_projected(unit(x), tables, hashes, width, seed))
                ids, raw = b["vid"].to_numpy()[at], [r.tobytes() for r in x]
                for t in range(tables):
                    yield pd.DataFrame({"cell": _cell(np.array(t), x.shape[1], walls[t]), "vid": ids, "raw": raw, "first": t == 0})

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        moves = _moves(hashes)
        for b in batches:
            for at, x in _by_dim(b["vector"]):
                p = _projected(unit(x), tables, hashes, width, seed)
                walls = np.floor(p)
                below = p - walls
                for n, i in enumerate(at):
                    for t in range(tables):
                        down, up = below[t, n] ** 2, (1 - below[t, n]) ** 2
                        cost = (moves < 0) @ down + (moves > 0) @ up
                        first = np.argpartition(cost, min(probes, len(cost)) - 1)[:probes]
                        cells = _cell(np.array(t), x.shape[1], walls[t, n] + moves[first])
                        yield pd.DataFrame({"vid": b["vid"].iloc[i], "cell": np.unique(cells)})

    indexed = materialize(classes.select("vid", "vector").mapInPandas(index, "cell long, vid long, raw binary, first boolean"), "ann-index")
    sizes = materialize(
        indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        .select("cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "ann-cells"
    )
    groups = max(1, -(-indexed.count() // GROUP))
    group = F.pmod(F.xxhash64("cell", "block"), F.lit(groups)).cast("int").alias("g")
    stored = indexed.join(sizes, "cell").withColumn(
        "block", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int")
    ).select(group, "cell", "block", "vid", "raw", "first")
    hunted = classes.join(wanted.select("vid").distinct(), "vid", "left_semi").select("vid", "vector")
    visits = (
        hunted.mapInPandas(visit, "vid long, cell long").join(sizes, "cell")
        .select("vid", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .select("vid", group, F.struct("cell", "block").alias("at"))
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        best: dict[int, dict[int, float]] = {}
        if len(left) and len(right):
            vectors = [np.asarray(v, dtype=np.float64) for v in right["vector"]]
            asks: dict[tuple[int, int], list[int]] = {}
            every = list(left.groupby(["cell", "block"]).groups)
            for n, ats in enumerate(right["ats"]):
                for at in every if ats is None else ((a["cell"], a["block"]) for a in ats):
                    asks.setdefault(at, []).append(n)
            for at, part in left.groupby(["cell", "block"]):
                for dim in {len(vectors[n]) for n in asks.get(at, ())}:
                    who = [n for n in asks[at] if len(vectors[n]) == dim]
                    sel = part[part["raw"].map(len) == 8 * dim]
                    if not len(sel):
                        continue
                    ids = sel["vid"].to_numpy()
                    x = unit(np.frombuffer(b"".join(sel["raw"]), dtype=np.float64).reshape(-1, dim))
                    score = unit(np.array([vectors[n] for n in who])) @ x.T
                    for n, s in zip(who, score, strict=True):
                        few = np.argpartition(-s, k)[: k + 1] if len(s) > k + 1 else np.arange(len(s))
                        # Ties with the last one that counts come along.
                        few = np.flatnonzero(s >= s[few].min())
                        few = few[np.lexsort((ids[few], -s[few]))][: k + 1]
                        mine = best.setdefault(n, {})
                        mine.update(zip(ids[few].tolist(), s[few].tolist(), strict=True))
        out = []
        for n, mine in best.items():
            top = sorted(mine.items(), key=lambda x: (-x[1], x[0]))[: k + 1]
            out += [(right["vid"].iloc[n], v, s) for v, s in top]
        return pd.DataFrame(out, columns=["q", "vid", "score"])

    def hunt(rows: DataFrame, visits: DataFrame, n: int) -> DataFrame:
        """The ``k`` + 1 best classes found for each of ``n`` classes of queries; ``visits``:
        where each goes in a group (null: everywhere)."""
        crowds = max(1, -(-n // QUERIES))
        crowd = F.pmod(F.xxhash64("vid", F.lit(5)), F.lit(crowds)).cast("int").alias("crowd")
        sent = visits.select("g", crowd, "vid", "ats", "vector")
        offered = rows.drop("first").withColumn("crowd", F.explode(F.sequence(F.lit(0), F.lit(crowds - 1))))
        met = offered.groupBy("g", "crowd").cogroup(sent.groupBy("g", "crowd")).applyInPandas(search, "q long, vid long, score double")
        once = met.groupBy("q", "vid").agg(F.max("score").alias("score"))
        order = Window.partitionBy("q").orderBy(F.desc("score"), "vid")
        return once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([float(np.clip(_cosine(x, y), -1, 1)) for x, y in zip(a, b, strict=True)], dtype="float64")

    def answered(top: DataFrame, wanted: DataFrame) -> DataFrame:
        """Exact rerank of the merged candidates, then from classes to their rows."""
        both = top.join(classes.select(F.col("vid").alias("q"), F.col("vector").alias("qv")), "q").join(classes, "vid")
        scored = both.select("q", F.explode("ids").alias("id"), cosine("qv", "vector").alias("score"))
        answers = wanted.withColumnRenamed("vid", "q").join(scored, "q").where(F.col("query_id") != F.col("id"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
        return answers.select("query_id", rank.alias("rank"), F.col("id").alias("vec_id"), "score").where(F.col("rank") <= k)

    # A query goes to a group once, with all it visits there.
    visits = visits.groupBy("g", "vid").agg(F.collect_list("at").alias("ats")).join(hunted, "vid")
    found = materialize(answered(hunt(stored, visits, wanted.count()), wanted), "ann-found")
    full = found.where(F.col("rank") == k).select("query_id")
    short = materialize(wanted.join(full, "query_id", "left_anti"), "ann-short")
    left = short.count()
    if not left:
        return found
    # Every vector is in each table once: the first table's blocks are all rows.
    everywhere = hunted.join(short.select("vid").distinct(), "vid", "left_semi").select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "vid", "vector",
        F.lit(None).cast("array<struct<cell:bigint,block:int>>").alias("ats"),
    )
    rest = answered(hunt(stored.where("first"), everywhere, left), short)
    return found.join(full, "query_id", "left_semi").unionByName(rest)


def _cosine(a, b) -> float:
    """Of two vectors in double precision; scaled, so nothing overflows."""
    a, b = np.asarray(a, dtype=np.float64), np.asarray(b, dtype=np.float64)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
