"""Aggregate marts over the star, the overall summary and the payment share.

Each mart joins the fact to one dimension on its id and groups; Spark plans a
partial aggregate before the shuffle, so only one row per group and task
crosses the network after the join. Marts carry no ORDER BY (Spark drops a
sort under later operators); ``MART_ORDER`` is applied where a mart is exported or shown.

A fact with a column ``weight`` (``facts.weigh``) counts each row that often, which
gives the per-row grain's marts without its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import lookup_join

WEIGHT = "weight"

# Sink order of each mart as (column, descending); ties broken by the keys.
MART_ORDER: dict[str, list[tuple[str, bool]]] = {
    "hourly": [("pickup_hour", False)],
    "popular_locations": [("num_pickups", True), ("pickup_latitude", False), ("pickup_longitude", False)],
    "payment": [("payment_name", False)],
    "daily": [("pickup_year", False), ("pickup_month", False), ("pickup_day", False)],
    "payment_distribution": [("trip_count", True), ("payment_name", False)],
}


def mart_order(name: str) -> list[Column]:
    """Sort columns for exporting or showing mart ``name``."""
    return [F.col(c).desc() if desc else F.col(c).asc() for c, desc in MART_ORDER[name]]


def _with_dim(fact: DataFrame, fact_cols: list[str], dim: DataFrame, key: str, dim_cols: list[str]) -> DataFrame:
    d = dim.select(F.col(key).alias("_k_id"), *dim_cols)
    own = [WEIGHT] if WEIGHT in fact.columns else []
    return lookup_join(fact.select(key, *fact_cols, *own), d, [(key, "_k_id")], "inner")


def _count(df: DataFrame) -> Column:
    """Rows of ``df``, or the weights they stand for."""
    return F.coalesce(F.sum(WEIGHT), F.lit(0)) if WEIGHT in df.columns else F.count(F.lit(1))


def _sum(df: DataFrame, c: str) -> Column:
    return F.sum(F.col(c) * F.col(WEIGHT)) if WEIGHT in df.columns else F.sum(c)


def _avg(df: DataFrame, c: str) -> Column:
    if WEIGHT not in df.columns:
        return F.avg(c)
    return _sum(df, c) / F.sum(F.when(F.col(c).isNotNull(), F.col(WEIGHT)))


def _pick(columns: str, wide: list[Column], narrow_count: int) -> list[Column]:
    if columns == "wide":
        return wide
    if columns == "narrow":
        return wide[:narrow_count]
    raise ValueError(f"columns must be 'wide' or 'narrow', not {columns!r}")


def hourly(fact: DataFrame, dim_datetime: DataFrame, columns: str = "wide") -> DataFrame:
    """By pickup hour: avg fare, trip count, avg tip, avg total."""
    j = _with_dim(fact, ["fare_amount", "tip_amount", "total_amount"], dim_datetime, "datetime_id", ["pickup_hour"])
    aggs = _pick(
        columns,
        [
            _avg(j, "fare_amount").alias("avg_fare"),
            _count(j).alias("num_trips"),
            _avg(j, "tip_amount").alias("avg_tip"),
            _avg(j, "total_amount").alias("avg_total"),
        ],
        2,
    )
    return j.groupBy("pickup_hour").agg(*aggs)


def popular_locations(fact: DataFrame, dim_location: DataFrame, columns: str = "wide") -> DataFrame:
    """By pickup coordinates: count, avg fare, avg distance, avg duration."""
    j = _with_dim(
        fact,
        ["fare_amount", "trip_distance", "trip_duration"],
        dim_location,
        "location_id",
        ["pickup_latitude", "pickup_longitude"],
    )
    aggs = _pick(
        columns,
        [
            _count(j).alias("num_pickups"),
            _avg(j, "fare_amount").alias("avg_fare"),
            _avg(j, "trip_distance").alias("avg_distance"),
            _avg(j, "trip_duration").alias("avg_duration"),
        ],
        2,
    )
    return j.groupBy("pickup_latitude", "pickup_longitude").agg(*aggs)


def payment(fact: DataFrame, dim_payment: DataFrame, columns: str = "wide") -> DataFrame:
    """By payment name: count, avg fare, tip, total and distance."""
    j = _with_dim(
        fact,
        ["fare_amount", "tip_amount", "total_amount", "trip_distance"],
        dim_payment,
        "payment_id",
        ["payment_name"],
    )
    aggs = _pick(
        columns,
        [
            _count(j).alias("num_trips"),
            _avg(j, "fare_amount").alias("avg_fare"),
            _avg(j, "tip_amount").alias("avg_tip"),
            _avg(j, "total_amount").alias("avg_total"),
            _avg(j, "trip_distance").alias("avg_distance"),
        ],
        3,
    )
    return j.groupBy("payment_name").agg(*aggs)


def daily(fact: DataFrame, dim_datetime: DataFrame) -> DataFrame:
    """By pickup date: count, avg fare, revenue, avg distance, avg duration."""
    j = _with_dim(
        fact,
        ["fare_amount", "total_amount", "trip_distance", "trip_duration"],
        dim_datetime,
        "datetime_id",
        ["pickup_year", "pickup_month", "pickup_day"],
    )
    return j.groupBy("pickup_year", "pickup_month", "pickup_day").agg(
        _count(j).alias("num_trips"),
        _avg(j, "fare_amount").alias("avg_fare"),
        _sum(j, "total_amount").alias("total_revenue"),
        _avg(j, "trip_distance").alias("avg_distance"),
        _avg(j, "trip_duration").alias("avg_duration"),
    )


_HOUR_SET = ("pickup_hour",)
_DAY_SET = ("pickup_year", "pickup_month", "pickup_day")


def datetime_rollup(fact: DataFrame, dim_datetime: DataFrame) -> DataFrame:
    """Both datetime marts in one pass: one fact-to-dimension join, then one
    aggregate over the grouping sets (hour) and (year, month, day).

    Spark expands each joined row once per set *before* the partial
    aggregate, so a single shuffle of partial aggregates serves both marts;
    the result has 24 + (number of days) rows.
    """
    j = _with_dim(
        fact,
        ["fare_amount", "tip_amount", "total_amount", "trip_distance", "trip_duration"],
        dim_datetime,
        "datetime_id",
        [*_HOUR_SET, *_DAY_SET],
    )
    keys = [*_HOUR_SET, *_DAY_SET]
    return j.groupingSets([list(_HOUR_SET), list(_DAY_SET)], *keys).agg(
        F.grouping_id(*keys).alias("_set"),
        F.count(F.lit(1)).alias("num_trips"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg("total_amount").alias("avg_total"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration").alias("avg_duration"),
    )


def split_datetime_rollup(rollup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hourly, daily) marts, wide form, from ``datetime_rollup``."""
    # grouping_id bits: 1 marks a column rolled away. The hour set rolls away
    # the three date columns (binary 0111 = 7), the day set the hour (1000 = 8).
    hourly = rollup.where(F.col("_set") == 7).select(
        "pickup_hour", "avg_fare", "num_trips", "avg_tip", "avg_total"
    )
    daily = rollup.where(F.col("_set") == 8).select(
        "pickup_year", "pickup_month", "pickup_day", "num_trips", "avg_fare", "total_revenue", "avg_distance",
        "avg_duration",
    )
    return hourly, daily


# Each published mart's dimension and grouping columns.
_GRAND = {
    "hourly": ("datetime", _HOUR_SET),
    "daily": ("datetime", _DAY_SET),
    "popular_locations": ("location", ("pickup_latitude", "pickup_longitude")),
    "payment": ("payment", ("payment_name",)),
}
_MEASURES = ("fare_amount", "tip_amount", "total_amount", "trip_distance", "trip_duration")


def grand_rollup(star) -> DataFrame:
    """All marts of a star in one scan of its facts: the joins with its dimensions
    (left ones: a fact that one dimension lacks still counts in the others' marts),
    then one aggregate over the grouping sets (hour), (day), (pickup place) and (payment).

    ``mart`` names the set a row belongs to, ``matched`` whether its dimension had
    the fact. Counts and sums are kept, so the averages and the report follow from them.
    A zone star, whose locations have no coordinates, has no set for them.
    """
    sets = {m: (d, keys) for m, (d, keys) in _GRAND.items() if m != "popular_locations" or star.variant == "coords"}
    j = star.fact
    for d in dict.fromkeys(d for d, _ in sets.values()):
        columns = [c for dim, keys in sets.values() if dim == d for c in keys]
        dim = getattr(star, d).select(F.col(f"{d}_id").alias(f"_k_{d}"), *columns)
        j = lookup_join(j, dim, [(f"{d}_id", f"_k_{d}")], "left").withColumn(f"_has_{d}", F.col(f"_k_{d}").isNotNull())
    every = [c for _, keys in sets.values() for c in keys]
    flags = list(dict.fromkeys(f"_has_{d}" for d, _ in sets.values()))
    grouped = j.groupingSets([[f"_has_{d}", *keys] for d, keys in sets.values()], *flags, *every)
    # A set is known by what it has rolled away.
    name, matched = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for m, (d, keys) in sets.items():
        mine = F.grouping(keys[0]) == 0
        name, matched = F.when(mine, m).otherwise(name), F.when(mine, F.col(f"_has_{d}")).otherwise(matched)
    return grouped.agg(
        name.alias("mart"), matched.alias("matched"), F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"{c}_sum") for c in _MEASURES], *[F.count(c).alias(f"{c}_n") for c in _MEASURES],
    ).drop(*flags)


def split_grand_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    """The marts, wide form, from ``grand_rollup``."""
    avg = lambda c, name: (F.col(f"{c}_sum") / F.col(f"{c}_n")).alias(name)
    n = lambda name: F.col("n").alias(name)
    fare, tip, total = avg("fare_amount", "avg_fare"), avg("tip_amount", "avg_tip"), avg("total_amount", "avg_total")
    distance, duration = avg("trip_distance", "avg_distance"), avg("trip_duration", "avg_duration")
    columns = {
        "hourly": [fare, n("num_trips"), tip, total],
        "daily": [n("num_trips"), fare, F.col("total_amount_sum").alias("total_revenue"), distance, duration],
        "popular_locations": [n("num_pickups"), fare, distance, duration],
        "payment": [n("num_trips"), fare, tip, total, distance],
    }
    return {
        m: rollup.where((F.col("mart") == m) & F.col("matched")).select(*keys, *columns[m])
        for m, (_, keys) in _GRAND.items() if keys[0] in rollup.columns
    }


def summary(fact: DataFrame) -> DataFrame:
    """One row: trips, revenue, avg distance, avg duration in minutes.

    An empty fact gives one row with a 0 count and NULL figures.
    """
    return fact.agg(
        _count(fact).alias("total_trips"),
        _sum(fact, "total_amount").alias("total_revenue"),
        _avg(fact, "trip_distance").alias("avg_distance"),
        (_avg(fact, "trip_duration") / F.lit(60.0)).alias("avg_duration_minutes"),
    )


def payment_distribution(fact: DataFrame, dim_payment: DataFrame, ndigits: int = 2) -> DataFrame:
    """By payment name: trip count and its share of *all* facts, in percent.

    The denominator is an uncorrelated scalar subquery over the fact (facts
    without a payment row still count in it), evaluated once.
    """
    total = fact.agg(_count(fact)).scalar()
    j = _with_dim(fact, [], dim_payment, "payment_id", ["payment_name"])
    counts = j.groupBy("payment_name").agg(_count(j).alias("trip_count"))
    return counts.select(
        "payment_name",
        "trip_count",
        F.round(F.col("trip_count") * F.lit(100.0) / total, ndigits).alias("percentage"),
    )


def summary_report(fact: DataFrame, dim_payment: DataFrame, ndigits: int = 2) -> DataFrame:
    """One row: ``overall_stats`` (rounded) and the ``payment_distribution``
    records, sorted by count descending then name.

    The fact is scanned once: it is pre-aggregated per ``payment_id`` (counts
    and sums), names are attached by a left join (a fact whose payment has no
    dimension row still counts in the totals, as in the scalar-subquery
    form), and the few rows are grouped per name.
    """
    per_id = fact.groupBy("payment_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{c}_{k}") for c in _REPORTED for k, f in (("sum", F.sum), ("n", F.count))],
    )
    names = dim_payment.select(F.col("payment_id").alias("_k_id"), "payment_name")
    named = lookup_join(per_id, names, [("payment_id", "_k_id")], "left").withColumn(
        "matched", F.col("_k_id").isNotNull()
    )
    sums = [c for c in per_id.columns if c != "payment_id"]
    return _report(named.groupBy("payment_name", "matched").agg(*[F.sum(c).alias(c) for c in sums]), ndigits)


def rollup_report(rollup: DataFrame, ndigits: int = 2) -> DataFrame:
    """``summary_report`` from ``grand_rollup``: every fact is in one row of the
    payment set, matched or not."""
    return _report(rollup.where(F.col("mart") == "payment"), ndigits)


_REPORTED = ("total_amount", "trip_distance", "trip_duration")


def _report(per_name: DataFrame, ndigits: int) -> DataFrame:
    """The report from one row per payment name (and whether it was matched): one
    final aggregate gives the overall figures, the total and the records. Averages are
    sums over counts, as ``avg`` computes them. There is one record for each payment
    name: five at most by the decode table, whatever the dimension's size.
    """
    # One row per payment name into one task.
    final = per_name.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("_total"),
        *[F.sum(f"{c}_{k}").alias(f"{c}_{k}") for c in _REPORTED for k in ("sum", "n")],
        F.collect_list(
            F.when(F.col("matched"), F.struct("payment_name", F.col("n").alias("trip_count")))
        ).alias("_records"),
    )
    by_count = F.array_sort(
        F.col("_records"),
        lambda a, b: F.when(a.trip_count > b.trip_count, -1)
        .when(a.trip_count < b.trip_count, 1)
        .when(a.payment_name < b.payment_name, -1)
        .when(a.payment_name > b.payment_name, 1)
        .otherwise(0),
    )
    overall = F.struct(
        F.col("_total").alias("total_trips"),
        F.round("total_amount_sum", ndigits).alias("total_revenue"),
        F.round(F.col("trip_distance_sum") / F.col("trip_distance_n"), ndigits).alias("avg_distance"),
        F.round(F.col("trip_duration_sum") / F.col("trip_duration_n") / F.lit(60.0), ndigits).alias("avg_duration_minutes"),
    ).alias("overall_stats")
    records = F.transform(
        by_count,
        lambda r: F.struct(
            r.payment_name.alias("payment_name"),
            r.trip_count.alias("trip_count"),
            F.round(r.trip_count * F.lit(100.0) / F.col("_total"), ndigits).alias("percentage"),
        ),
    ).alias("payment_distribution")
    return final.select(overall, records)


def marts(star, columns: str = "wide") -> dict[str, DataFrame]:
    """The four marts of a coordinate star, by name."""
    return {
        "hourly": hourly(star.fact, star.datetime, columns),
        "popular_locations": popular_locations(star.fact, star.location, columns),
        "payment": payment(star.fact, star.payment, columns),
        "daily": daily(star.fact, star.datetime),
    }
