"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch holds every shingle hash below a fixed fraction of the hash range, so
its size follows the document's, sketches of parts merge by union, and the
share of a sketch found in another estimates containment without bias even if
the documents differ much in length. The smallest hash is always held, so that a
short text has a sketch too.

All steps are DataFrame functions on arrays of one row. Words are hashed once,
and a shingle's hash is that of its words' hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import fresh

SHINGLE = 5
#: One in so many hashes is held; a power of two.
SCALE = 4
BLANKS = r"[\x20\x09-\x0D]+"


def with_sketch(df: DataFrame, text: Column, name: str, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """``df`` with the sketch of ``text`` as an array of distinct held hashes, sorted.

    Words are runs without ASCII blanks, lower-cased; a text with fewer words
    than a shingle is one shingle; one without words (or null) has an empty sketch.

    The steps are columns of their own, each used more than once, so that the
    optimizer doesn't fold one into the next one's inner loop.
    """
    w, h = fresh(df, ["_words", "_hashes"])
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BLANKS), "")
    x = df.withColumn(w, F.transform(words, lambda one: F.xxhash64(one)))
    at = F.sequence(F.lit(0), F.size(w) - shingle)
    many = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)]))
    whole = F.array(F.xxhash64(w))
    none = F.array().cast("array<bigint>")
    x = x.withColumn(h, F.when(F.size(w) >= shingle, many).when(F.size(w) > 0, whole).otherwise(none))
    # As unsigned numbers, below 2**64 / scale: the top bits are zero.
    top = scale.bit_length() - 1
    held = F.filter(h, lambda v: F.shiftrightunsigned(v, 64 - top) == 0) if top else F.col(h)
    least = F.array_compact(F.array(F.array_min(h)))
    return x.withColumn(name, F.sort_array(F.array_distinct(F.concat(held, least)))).drop(w, h)


def likeness(a: Column, b: Column) -> Column:
    """Estimated containment of the smaller document in the other: the share of
    the smaller sketch that is in the other. Two empty ones are alike (1), an
    empty one and another are not (0)."""
    least = F.least(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(least == 0, F.lit(0.0)).otherwise(both / least)


def merge(df: DataFrame, keys: list[str], sketch: str, scale: int = SCALE) -> DataFrame:
    """The sketch of the union of each key's documents, pre-aggregated map-side: the hashes
    under the threshold of ``scale`` that any of them holds, and the least of all, as
    ``with_sketch`` holds them. What another document held only as its least one goes."""
    every = df.select(*keys, F.explode(sketch).alias(sketch)).groupBy(*keys).agg(F.collect_set(sketch).alias(sketch))
    top = scale.bit_length() - 1
    held = F.filter(sketch, lambda v: F.shiftrightunsigned(v, 64 - top) == 0) if top else F.col(sketch)
    least = F.array_compact(F.array(F.array_min(sketch)))
    return every.withColumn(sketch, F.sort_array(F.array_distinct(F.concat(held, least))))


def as_text(sketch: Column) -> Column:
    """A sketch as a string: 16 lowercase hexadecimal digits for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(df: DataFrame, order: str, tie: Column, columns: list[str], name: str, bytes_per_bucket: int = 8 << 20) -> DataFrame:
    """``df`` with a struct ``name`` of the next row's ``columns`` in ascending
    ``order`` (an integer column, nulls first; ties by ``tie``); the row after
    the last is the first.

    The rows are dealt into buckets of consecutive values that begin at values
    that occur, so a bucket finds its last row's successor by also borrowing the
    rows of the next bucket's first value (the last bucket those of the first).
    Wide rows move once; buckets are sorted each for itself.
    """
    spark = df.sparkSession
    key = F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63)))
    volume, low = df.agg(F.sum(F.octet_length(columns[0])), F.min(key)).first()
    if low is None:
        return df.withColumn(name, F.struct(*columns))
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), (volume or 0) // bytes_per_bucket)
    marks = [k / buckets for k in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(key, marks, 20 * buckets)).first()[0] or []
    cuts = sorted({low, *cuts})
    # A two-level search: blocks of about the root of the number of cuts.
    step = max(1, round(len(cuts) ** 0.5))
    coarse, fine = cuts[::step], [cuts[i : i + step] for i in range(0, len(cuts), step)]

    at, ties, block, bucket, copy, to, lent = fresh(df, ["_at", "_tie", "_block", "_bucket", "_copy", "_to", "_lent"])

    def upto(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda n, c: n + (c <= F.col(at)).cast("int"))

    def longs(values: list, kind: str) -> Column:
        return F.from_json(F.lit(str(values)), kind)

    mine = F.element_at(longs(fine, "array<array<bigint>>"), F.col(block))
    x = df.withColumn(at, key).withColumn(ties, tie).withColumn(block, upto(longs(coarse, "array<bigint>")))
    x = x.withColumn(bucket, (F.col(block) - 1) * step + upto(mine) - 1)
    begins = F.get(mine, F.col(bucket) - (F.col(block) - 1) * step) == F.col(at)
    back = F.when(F.col(bucket) == 0, F.lit(len(cuts) - 1)).otherwise(F.col(bucket) - 1)
    own = F.struct(F.col(bucket).alias("to"), F.lit(0).alias("lent"))
    also = F.struct(back.alias("to"), F.lit(1).alias("lent"))
    dealt = x.withColumn(copy, F.explode_outer(F.when(begins, F.array(own, also)).otherwise(F.array(own)))).select(
        *df.columns, at, ties, F.col(f"{copy}.to").alias(to), F.col(f"{copy}.lent").alias(lent)
    )
    line = Window.partitionBy(to).orderBy(lent, at, ties)
    return dealt.withColumn(name, F.lead(F.struct(*columns)).over(line)).where(F.col(lent) == 0).select(*df.columns, name)
