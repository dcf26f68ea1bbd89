"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.checkpoint import materialize

# A document's words for the word-shingle operators: runs without ASCII blanks.
CHUNK_BITS = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Hold the Arrow batches that go to Python to a thousand rows and 8 MB
    (lower settings stay): texts are long, and a batch is in memory several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def fresh(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """A column name for each wanted one that clashes with none of ``df``'s
    (compared without case, as Spark does): underscores are put before it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def chunk_of(order: Column, bits: int = CHUNK_BITS) -> Column:
    """The top ``bits`` bits of a 64-bit hash, in the hash's signed order."""
    return F.shiftright(order, 64 - bits).cast("int")


def number_within(df: DataFrame, keys: Sequence[str], order: str, name: str, bits: int = CHUNK_BITS) -> DataFrame:
    """Number the rows of each key from 0, without a gap, by the column ``order``.

    ``order`` must be a spread-out 64-bit hash. A key's rows are split by the
    hash's top bits into ``2**bits`` chunks, so a key that holds a third of all
    rows is numbered by many tasks: rows are counted for each (key, chunk) with
    a map-side partial aggregate, the counts become starting offsets, and each
    chunk numbers its own rows. Keys must not be null; ``df`` is read twice, so
    it must be a stored table or otherwise repeatable. Equal hashes of one key
    are numbered in an arbitrary order.
    """
    chunk, n, off = fresh(df, ["_chunk", "_n", "_off"])
    parts = [*keys, chunk]
    x = df.withColumn(chunk, chunk_of(F.col(order), bits))
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = x.groupBy(*parts).agg(F.count(F.lit(1)).alias(n)).select(
        *parts, F.coalesce(F.sum(n).over(earlier), F.lit(0)).cast("long").alias(off)
    )
    within = x.withColumn(n, F.row_number().over(Window.partitionBy(*parts).orderBy(order)))
    return within.join(offsets.hint("shuffle_merge"), parts).select(
        *df.columns, (F.col(off) + F.col(n) - 1).cast("long").alias(name)
    )


def smallest(df: DataFrame, n: int, over: Sequence[str], by: Sequence[str] = (), seed: int = 7) -> DataFrame:
    """The rows of ``df`` with the ``n`` smallest hashes of the columns ``over``, for each
    value of the columns ``by`` (all, where there are fewer): a random sample that stays the
    same, holds at most ``n`` rows a group and is empty only where the group is. Rows equal in
    ``over`` count once. Hashes alone are ranked, per salt before they meet per
    group; the rows are then picked by the largest hash that is in.
    """
    h, salt, place, cut = fresh(df, ["_h", "_salt", "_place", "_cut"])
    hashed = df.withColumn(h, F.xxhash64(*over, F.lit(seed)))
    first = hashed.select(*by, h).distinct().withColumn(salt, F.pmod(F.col(h), F.lit(256)))
    for keys in ([*by, salt], list(by)):
        window = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(h)
        first = first.withColumn(place, F.row_number().over(window)).where(F.col(place) <= n)
    if by:
        # One row a group, stored: a join knows its size, and moves ``df`` only if there are very many.
        cuts = materialize(first.groupBy(*by).agg(F.max(h).alias(cut)), "smallest")
        picked = hashed.join(cuts, list(by)).where(F.col(h) <= F.col(cut))
    else:
        picked = hashed.where(F.col(h) <= first.agg(F.max(h)).scalar())
    return picked.dropDuplicates([*by, h]).select(*df.columns)
