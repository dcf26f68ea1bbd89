"""Properties of dense_key: gap-free, ordered, partition-count independent,
no data-sized single-partition exchange, hot groups spread out."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.operators.keys import dense_key
from starmart.sources.adapter import trips_from_tables

from star_data import SF_SMALL


def test_ids_are_dense_and_follow_the_order(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("v"), (F.col("id") % 3).alias("g"))
    keyed = dense_key(df, ["v"], name="k")
    rows = keyed.orderBy("k").collect()
    assert [r.k for r in rows] == list(range(1, 5001))
    assert [r.v for r in rows] == sorted(r.v for r in rows)


def test_first_id_and_nulls_first(spark):
    df = spark.createDataFrame([(3,), (None,), (1,), (2,)], "v int")
    rows = dense_key(df, ["v"], name="k", first_id=0).orderBy("k").collect()
    assert [(r.k, r.v) for r in rows] == [(0, None), (1, 1), (2, 2), (3, 3)]


def test_ids_do_not_depend_on_shuffle_partitions(spark):
    trips = trips_from_tables(spark, SF_SMALL)
    pairs = trips.select("pickup_datetime", "dropoff_datetime").distinct()
    a = dense_key(pairs, ["pickup_datetime", "dropoff_datetime"], num_partitions=3)
    b = dense_key(pairs, ["pickup_datetime", "dropoff_datetime"], num_partitions=17)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.agg(F.min("id"), F.max("id"), F.count("*")).first() == (1, 4599, 4599)


def test_unordered_ids_are_dense(spark):
    df = spark.range(0, 1000, numPartitions=7)
    ids = sorted(r.k for r in dense_key(df, None, name="k").collect())
    assert ids == list(range(1, 1001))


def test_hot_identical_rows_are_spread(spark):
    # A third of the rows are identical; they must not all land in one task.
    hot = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    keyed = dense_key(hot, ["v"], name="k", unique=False, num_partitions=8)
    ids = keyed.select("k")
    assert ids.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first() == (1, 30000, 30000)
    # ids of the hot value are consecutive, after the values below it
    hot_ids = keyed.where("v = -1").agg(F.min("k"), F.max("k")).first()
    assert (hot_ids[0], hot_ids[1]) == (1, 10000)
    # the written partitions hold the hot group in more than one of them
    per_part = (
        keyed.where("v = -1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    )
    assert len(per_part) > 1


def test_no_data_sized_single_partition_exchange(spark):
    """Neither the numbering that is written nor a join of a large dimension
    brings rows to one partition."""
    from starmart.operators.joins import lookup_join
    from starmart.operators.keys import numbered

    pair = ["pickup_datetime", "dropoff_datetime"]
    trips = trips_from_tables(spark, SF_SMALL)
    staged = numbered(trips.select(*pair).distinct(), pair)
    joined = lookup_join(trips, staged.select(*[F.col(c).alias(f"_{c}") for c in pair]), [(c, f"_{c}") for c in pair])
    for df in (staged, joined):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" in plan and "SinglePartition" not in plan
