"""The fact table: trips with their dimension keys, measures and duration.

``null_keys="drop"`` resolves keys by inner equi-joins, so a trip whose key
is NULL (or absent from a dimension) has no fact; with ``grain="per_row"``
dimensions, k equal (pickup, dropoff) pairs fan out into k*k facts, as in the
SQL lane. ``null_keys="match"`` uses left joins with ``<=>``: a NULL key finds
the dimension's NULL member and every trip is kept.

``build_star`` numbers timestamp pairs and facts of the distinct grain in one range
pass (``onepass``), so their facts are never joined to the datetime dimension;
``build`` joins trips to dimensions that are given.

The small dimensions (payment, passenger and usually location) are joined
first, so NULL-key rows are gone before the one large join on the timestamp
pair. Which joins are broadcast follows from the dimensions' sizes (``joins``);
AQE splits a skewed pair's partition.

The per-row grain makes k*k facts of a pair's k trips and exists for users who
ask for those rows. Its aggregates need none of them: ``weigh`` gives each fact
of the distinct grain the number of facts it stands for.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.checkpoint import materialize
from starmart.functions.dates import datetime_parts, duration_seconds
from starmart.jobs import concurrently
from starmart.operators import dims as D
from starmart.operators.joins import lookup_join
from starmart.operators.keys import dense_key
from starmart.operators.onepass import SEQUENCE, number_both, ranges_of, with_sequence
from starmart.schema import COORD_COLUMNS, FACT, FACT_ZONE, TRIPS_COORD, TRIPS_ZONE
from starmart.sources.staging import stage


@dataclass
class Star:
    """The five tables of a star (DataFrames; ids already fixed)."""

    datetime: DataFrame
    location: DataFrame
    payment: DataFrame
    passenger: DataFrame
    fact: DataFrame
    variant: str = "coords"

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_datetime": self.datetime,
            "dim_location": self.location,
            "dim_payment": self.payment,
            "dim_passenger": self.passenger,
            "fact_trips": self.fact,
        }


def _policy(null_keys: str) -> tuple[str, bool]:
    if null_keys == "drop":
        return "inner", False
    if null_keys == "match":
        return "left", True
    raise ValueError(f"null_keys must be 'drop' or 'match', not {null_keys!r}")


def build(
    trips: DataFrame,
    dim_datetime: DataFrame,
    dim_location: DataFrame,
    dim_payment: DataFrame,
    dim_passenger: DataFrame,
    null_keys: str = "drop",
    duration_unit: str = "int",
    first_id: int = 1,
    order_ids: bool = True,
) -> DataFrame:
    """Fact rows of coordinate trips against the four dimensions.

    ``trip_id`` is dense, ordered by every staging column then ``datetime_id``.
    ``order_ids=False`` numbers the facts where they are (dense and gap-free,
    fixed once written, but not ordered by business key), which skips the
    global sort: the costliest step of the build at large scale.
    """
    how, null_safe = _policy(null_keys)
    staging = TRIPS_COORD.fieldNames()
    # Trips are told apart where they are read, so that nothing is sorted for it behind the joins.
    x = trips.select(*staging)
    ranges = ranges_of(x)
    x = with_sequence(x, staging) if order_ids else x

    dt = dim_datetime.select(
        "datetime_id", F.col("pickup_datetime").alias("_k_pickup"), F.col("dropoff_datetime").alias("_k_dropoff")
    )
    x = _with_small_keys(x, dim_location, dim_payment, dim_passenger, how, null_safe)
    x = lookup_join(x, dt, [("pickup_datetime", "_k_pickup"), ("dropoff_datetime", "_k_dropoff")], how, null_safe)

    order = [*staging, "datetime_id", SEQUENCE] if order_ids else None
    x = x.select(*(order or [*staging, "datetime_id"]), "location_id", "payment_id", "passenger_id")
    return dense_key(x, order, name="trip_id", first_id=first_id, num_partitions=ranges, keep=_own(duration_unit)).select(
        *FACT.fieldNames()
    )


def _own(duration_unit: str) -> list[Column]:
    """A fact's columns but its id, the duration made of the trip's times."""
    made = {"trip_duration": duration_seconds("pickup_datetime", "dropoff_datetime", duration_unit).alias("trip_duration")}
    return [made.get(c, F.col(c)) for c in FACT.fieldNames() if c != "trip_id"]


def _with_small_keys(
    x: DataFrame, dim_location: DataFrame, dim_payment: DataFrame, dim_passenger: DataFrame, how: str, null_safe: bool
) -> DataFrame:
    """Trips with the ids of every dimension but datetime."""
    pay = dim_payment.select("payment_id", F.col("payment_type").cast("long").alias("_k_payment"))
    pas = dim_passenger.select("passenger_id", F.col("passenger_count").alias("_k_passenger"))
    loc = dim_location.select("location_id", *[F.col(c).alias(f"_k_{c}") for c in COORD_COLUMNS])
    x = lookup_join(x, pay, [("payment_type", "_k_payment")], how, null_safe)
    x = lookup_join(x, pas, [("passenger_count", "_k_passenger")], how, null_safe)
    return lookup_join(x, loc, [(c, f"_k_{c}") for c in COORD_COLUMNS], how, null_safe)


def build_both(
    trips: DataFrame,
    dim_location: DataFrame,
    dim_payment: DataFrame,
    dim_passenger: DataFrame,
    null_keys: str = "drop",
    week_start: str = "sunday",
    duration_unit: str = "int",
    first_id: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """(datetime dimension, facts) of the distinct grain from one range pass:
    what ``datetime_dim`` and ``build`` give, without joining one to the other.

    The dimensions are those ``dims`` makes of these trips: their ids are in key order, so
    the facts are sorted by ids in the keys' stead, and only ids, times and measures are shuffled.
    """
    null_safe = _policy(null_keys)[1]
    staging = TRIPS_COORD.fieldNames()
    pair = ["pickup_datetime", "dropoff_datetime"]
    ids = ["location_id", "payment_id", "passenger_id"]
    # Left joins: a trip that is no fact still has a timestamp pair.
    x = trips.select(*staging)
    ranges = ranges_of(x)
    x = with_sequence(x, staging)
    x = _with_small_keys(x, dim_location, dim_payment, dim_passenger, "left", null_safe).select(*BY_IDS, SEQUENCE)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*pair, *ids]])
    fact, pairs = number_both(x, pair, BY_IDS, F.lit(True) if null_safe else known, BY_IDS, "datetime_id", "trip_id", first_id, ranges)
    return D.datetime_columns(pairs, week_start), fact.select("trip_id", *_own(duration_unit))


#: The staging order with the ids of a trip's members in the place of their keys.
BY_IDS = list(dict.fromkeys(
    {**dict.fromkeys(COORD_COLUMNS, "location_id"), "passenger_count": "passenger_id", "payment_type": "payment_id"}.get(c, c)
    for c in TRIPS_COORD.fieldNames()
))


def _unfolded(x: DataFrame) -> DataFrame:
    """Trips with their pair's first id ``_low`` and its ``_k`` ids as one row for each id,
    dealt evenly over the partitions by ranges of ids."""
    # A trip without a pair (left joins always find one) would keep a row with a NULL id.
    last = F.greatest(F.lit(0), F.floor((F.col("_k") - 1) / RANGE).cast("int"))
    x = x.withColumn("_range", F.explode_outer(F.sequence(F.lit(0), last)))
    # A fixed number: adaptive execution would merge these small rows again.
    x = x.repartition(int(x.sparkSession.conf.get("spark.sql.shuffle.partitions")), SEQUENCE, "_range")
    low = F.col("_low") + F.col("_range").cast("long") * RANGE
    high = F.least(low + (RANGE - 1), F.col("_low") + F.col("_k") - 1)
    return x.withColumn("datetime_id", F.explode_outer(F.sequence(low, high)))


#: Ids of a pair's range that one row stands for before it is unfolded.
RANGE = 1024


def build_per_row(
    trips: DataFrame,
    dim_datetime: DataFrame,
    dim_location: DataFrame,
    dim_payment: DataFrame,
    dim_passenger: DataFrame,
    null_keys: str = "drop",
    duration_unit: str = "int",
    first_id: int = 1,
    order_ids: bool = True,
) -> DataFrame:
    """``build`` against the per-row datetime dimension ``datetime_dim`` makes, whose k
    rows of a pair have k ids in a row.

    A pair is therefore one row here, its first id and k, and no k x k join is made: a trip meets
    its pair once, its k ids are cut into ranges of ``RANGE``, the (trip, range) rows are
    dealt evenly whatever their pair, and only then unfolded to facts. So the facts of a pair
    with a third of all trips are made by all tasks. The other dimensions are those ``dims`` makes of these
    trips (ids in key order): from their joins on a row has ids in the keys' place.
    """
    how, null_safe = _policy(null_keys)
    staging = TRIPS_COORD.fieldNames()
    pair = ["pickup_datetime", "dropoff_datetime"]
    found = F.count(F.lit(1))
    in_a_row = F.max("datetime_id") - F.min("datetime_id") + 1 == found
    pairs = dim_datetime.groupBy(*[F.col(c).alias(f"_k_{c}") for c in pair]).agg(
        F.min("datetime_id").alias("_low"),
        F.when(in_a_row, found).otherwise(F.raise_error(F.lit("a pair's ids are not in a row"))).alias("_k"),
    )
    x = with_sequence(trips.select(*staging), staging)
    x = _with_small_keys(x, dim_location, dim_payment, dim_passenger, how, null_safe).select(*BY_IDS, SEQUENCE)
    x = lookup_join(x, pairs, [(c, f"_k_{c}") for c in pair], how, null_safe).select(*BY_IDS, SEQUENCE, "_low", "_k")
    # (staging, datetime id) repeats for equal trips, which are told apart by a number.
    order = [*BY_IDS, "datetime_id", SEQUENCE]
    x = _unfolded(x).select(*order)
    return dense_key(
        x, order if order_ids else None, name="trip_id", first_id=first_id, keep=_own(duration_unit)
    ).select(*FACT.fieldNames())


def weigh(fact: DataFrame, dim_datetime: DataFrame, trips: DataFrame) -> DataFrame:
    """``fact`` (distinct grain) with ``weight``: how many facts of the per-row
    grain each row stands for, that is, how many of all staged ``trips`` share its
    timestamp pair. Pairs are counted map-side and joined to the dimension's distinct pairs;
    no pair of trips is ever formed. Facts without a datetime row get 1."""
    counts = trips.groupBy(
        F.col("pickup_datetime").alias("_k_pickup"), F.col("dropoff_datetime").alias("_k_dropoff")
    ).agg(F.count(F.lit(1)).alias("weight"))
    ids = lookup_join(
        dim_datetime.select(F.col("datetime_id").alias("_k_id"), "pickup_datetime", "dropoff_datetime"),
        counts, [("pickup_datetime", "_k_pickup"), ("dropoff_datetime", "_k_dropoff")],
    ).select("_k_id", "weight")
    return lookup_join(fact, ids, [("datetime_id", "_k_id")], "left").select(
        *fact.columns, F.coalesce("weight", F.lit(1)).cast("long").alias("weight")
    )


def build_star(
    trips: DataFrame,
    grain: str = "distinct",
    null_keys: str = "drop",
    week_start: str = "sunday",
    duration_unit: str = "int",
    first_id: int = 1,
    stage_input: bool = True,
    order_ids: bool = True,
) -> Star:
    """Coordinate lane: four dimensions, then the fact that references them.

    ``stage_input`` writes the trips once first (they are read five times).
    """
    D.check_grain(grain)
    if stage_input:
        trips = stage(trips)
    small = [
        lambda: D.location_dim(trips, first_id=first_id),
        lambda: D.payment_dim(trips, first_id=first_id),
        lambda: D.passenger_dim(trips, first_id=first_id),
    ]
    if grain == "distinct" and order_ids:
        loc, pay, pas = concurrently(*small)
        dt, fact = build_both(trips, loc, pay, pas, null_keys, week_start, duration_unit, first_id)
        return Star(dt, loc, pay, pas, fact, "coords")
    dt, loc, pay, pas = concurrently(
        lambda: D.datetime_dim(trips, grain=grain, week_start=week_start, first_id=first_id), *small
    )
    make = build_per_row if grain == "per_row" else build
    fact = make(
        trips, dt, loc, pay, pas, null_keys=null_keys, duration_unit=duration_unit, first_id=first_id, order_ids=order_ids
    )
    return Star(dt, loc, pay, pas, fact, "coords")


def build_zone_star(trips: DataFrame, first_id: int = 0, stage_input: bool = True, order_ids: bool = True) -> Star:
    """Zone lane: one datetime and one location row per trip (their ids are
    the trip id, made once in the same projection), pickup parts only with
    Monday=0, undecoded payment, fractional duration, zone ids kept on the
    fact, and every trip kept (NULL codes find their NULL member)."""
    if stage_input:
        trips = stage(trips)
    staging = TRIPS_ZONE.fieldNames()
    keyed, pay, pas = concurrently(
        lambda: dense_key(
            trips.select(*staging), staging if order_ids else None, name="trip_id", first_id=first_id, unique=False
        ),
        lambda: D.payment_dim(trips, decode=False, first_id=first_id),
        lambda: D.passenger_dim(trips, first_id=first_id),
    )
    dt, loc, fact = zone_rows(keyed, pay, pas)
    return Star(dt, loc, pay, pas, fact, "zones")


def zone_rows(keyed: DataFrame, pay: DataFrame, pas: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Datetime rows, location rows and facts of numbered zone trips."""
    dt = keyed.select(
        F.col("trip_id").alias("datetime_id"),
        "pickup_datetime",
        *datetime_parts("pickup_datetime", "pickup", "monday"),
    )
    loc = keyed.select(F.col("trip_id").alias("location_id"), "pickup_location_id", "dropoff_location_id")

    x = keyed.select(
        *keyed.columns,
        F.col("trip_id").alias("datetime_id"),
        duration_seconds("pickup_datetime", "dropoff_datetime", "double").alias("trip_duration"),
    )
    x = lookup_join(x, pay.withColumnRenamed("payment_name", "_k_payment"), [("payment_type", "_k_payment")], "left", True)
    x = lookup_join(
        x, pas.withColumnRenamed("passenger_count", "_k_passenger"), [("passenger_count", "_k_passenger")], "left", True
    )
    return dt, loc, x.select(*FACT_ZONE.fieldNames())


def resolve_batch(
    stored: dict[str, DataFrame],
    next_id: dict[str, int],
    trips: DataFrame,
    variant: str = "coords",
    null_keys: str = "drop",
    week_start: str = "sunday",
    duration_unit: str = "int",
    order_ids: bool = True,
) -> tuple[Star, Star]:
    """(new, seen) for a batch of staged trips against the ``stored`` dimensions: what
    is to be appended, and the same facts with the batch's whole dimensions (members the store had and
    new ones).

    A dimension's stored rows are joined with the batch's distinct keys, the smaller
    side, and only keys without a stored member get ids, from ``next_id`` on in key order.
    NULL is a key like others. The stored facts are not read. In the zone star a trip's
    datetime and location rows are its own, so only payments and passengers are looked up.
    """
    coords = variant == "coords"

    def member(name: str, keys: list[str], id_name: str, own: list[str], rows) -> tuple[DataFrame, DataFrame]:
        wanted = materialize(trips.select(*keys).distinct(), f"batch-{name}", compact=True)
        pairs = list(zip(keys, [f"_k_{k}" for k in keys], strict=True))
        dim = stored[name].select(F.col(id_name), *[F.col(o).cast(wanted.schema[k].dataType).alias(f"_k_{k}") for k, o in zip(keys, own, strict=True)])
        known = materialize(
            lookup_join(dim, wanted, [(b, a) for a, b in pairs], "inner", null_safe=True).select(id_name, *keys),
            f"known-{name}", compact=True,
        )
        had = known.select(*[F.col(a).alias(b) for a, b in pairs])
        fresh = lookup_join(wanted, had, pairs, "left_anti", null_safe=True)
        keyed = dense_key(fresh, keys, name=id_name, first_id=next_id[name])
        return rows(keyed), rows(keyed.unionByName(known))

    jobs = [
        lambda: member("dim_payment", ["payment_type"], "payment_id", ["payment_type" if coords else "payment_name"],
                       lambda k: D.payment_columns(k, decode=coords)),
        lambda: member("dim_passenger", ["passenger_count"], "passenger_id", ["passenger_count"], lambda k: k),
    ]
    if coords:
        pair = ["pickup_datetime", "dropoff_datetime"]
        jobs += [
            lambda: member("dim_datetime", pair, "datetime_id", pair, lambda k: D.datetime_columns(k, week_start)),
            lambda: member("dim_location", COORD_COLUMNS, "location_id", COORD_COLUMNS, D.location_columns),
        ]
        (pay, pays), (pas, pass_), (dt, dts), (loc, locs) = concurrently(*jobs)
        fact = build(trips, dts, locs, pays, pass_, null_keys, duration_unit, next_id["fact_trips"], order_ids)
    else:
        staging = TRIPS_ZONE.fieldNames()
        jobs.append(lambda: dense_key(
            trips.select(*staging), staging if order_ids else None, name="trip_id", first_id=next_id["fact_trips"], unique=False
        ))
        (pay, pays), (pas, pass_), keyed = concurrently(*jobs)
        dt, loc, fact = zone_rows(keyed, pays, pass_)
        dts, locs = dt, loc
    return Star(dt, loc, pay, pas, fact, variant), Star(dts, locs, pays, pass_, fact, variant)
