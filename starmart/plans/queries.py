"""Named queries over the driver's tables: every operator of the star as a
callable ``(spark, sf_dir) -> DataFrame``.

Trips come from ``lineitem JOIN orders`` (``sources.adapter``); each query
builds what it needs of the star from them. Built dimensions and facts are
kept per session and folder, so a run of many queries builds each table once
(they are materialized under the checkpoint folder, so reuse is cheap and
survives a lost executor). The star is the one ``build_star`` builds, and the
``built_*`` and ``published_*`` queries read back what ``pipeline.build`` and
``pipeline.publish`` have written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.checkpoint import app_root, delete_folder
from starmart.operators import dims as D
from starmart.operators import facts as FT
from starmart.operators import marts as M
from starmart.operators import quality as Q
from starmart.operators.profile import profile
from starmart.plans import pipeline as P
from starmart.sources.adapter import trips_from_tables, zone_months_from_tables
from starmart.sources.staging import stage
from starmart.sources.trips import normalize, read_trips_csv, read_trips_parquet, union_months

_CACHE: dict[tuple, object] = {}


def _memo(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _CACHE:
        _CACHE[key] = make()
    return _CACHE[key]


def release(spark: SparkSession, sf_dir: str | None = None) -> int:
    """Forget what this application's queries keep (of one folder, or of all), and
    delete the application's intermediate tables once nothing is kept any more; how many things were
    kept. DataFrames of earlier queries can't be read after that."""
    app = spark.sparkContext.applicationId
    mine = [k for k in _CACHE if k[0] == app and (sf_dir is None or k[1] == sf_dir.rstrip("/"))]
    for k in mine:
        del _CACHE[k]
    if not any(k[0] == app for k in _CACHE):
        delete_folder(spark, app_root(spark))
    return len(mine)


def _trips(spark: SparkSession, sf_dir: str, variant: str = "coords") -> DataFrame:
    """The staged trips of ``sf_dir`` (written once, read by every step)."""
    return _memo(spark, sf_dir, f"trips:{variant}", lambda: stage(trips_from_tables(spark, sf_dir, variant)))


def star(spark: SparkSession, sf_dir: str, grain: str = "distinct", null_keys: str = "drop") -> FT.Star:
    """The coordinate star of ``sf_dir`` (built once per session)."""
    make = lambda: FT.build_star(_trips(spark, sf_dir), grain=grain, null_keys=null_keys, stage_input=False)
    return _memo(spark, sf_dir, f"star:{grain}:{null_keys}", make)


def weighted_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct grain's facts with the number of per-row facts each stands for."""
    s = star(spark, sf_dir)
    return FT.weigh(s.fact, s.datetime, _trips(spark, sf_dir))


def zone_star(spark: SparkSession, sf_dir: str) -> FT.Star:
    """The zone star of ``sf_dir``, from the two raw monthly frames."""
    return _memo(spark, sf_dir, "zstar", lambda: FT.build_zone_star(trips_normalized(spark, sf_dir)))  # stages its input


def trips_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = zone_months_from_tables(spark, sf_dir)
    return normalize(union_months([first, second]))


def _scratch(spark: SparkSession, label: str) -> str:
    return f"{app_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Raw files as they are often kept: a header in each, gzip.
_CSV = {"header": "true", "compression": "gzip"}


def trips_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's trips written as CSV with a header, then read back with
    the declared schema (the CSV lane's reader over data of every size)."""

    def make() -> str:
        path = _scratch(spark, "csv")
        trips_from_tables(spark, sf_dir).write.options(**_CSV).csv(path)
        return path

    return read_trips_csv(spark, _memo(spark, sf_dir, "csv", make))


def trips_parquet_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two monthly Parquet files with the source's column names, read, renamed
    and selected by the zone lane's reader."""

    def make() -> list[str]:
        paths = [_scratch(spark, f"month{k}") for k in (1, 2)]
        for path, month in zip(paths, zone_months_from_tables(spark, sf_dir), strict=True):
            month.write.option("compression", "zstd").parquet(path)
        return paths

    return normalize(read_trips_parquet(spark, _memo(spark, sf_dir, "months", make)))


def trips_nan_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone trips whose passenger counts come as doubles, NaN where missing."""
    months = union_months(list(zone_months_from_tables(spark, sf_dir)))
    nan = F.coalesce(F.col("passenger_count").cast("double"), F.lit(float("nan")))
    return normalize(months.withColumn("passenger_count", nan))


def trips_half_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips, each with an odd number of fare units half a second longer."""
    odd = F.pmod((F.col("fare_amount") * 1024).cast("long"), F.lit(2)) == 1
    longer = F.expr("dropoff_datetime + INTERVAL '0.5' SECOND")
    x = _trips(spark, sf_dir)
    return x.withColumn("dropoff_datetime", F.when(odd, longer).otherwise(F.col("dropoff_datetime")))


def _half_star(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    return _memo(spark, sf_dir, f"half:{unit}", lambda: FT.build_star(trips_half_seconds(spark, sf_dir), duration_unit=unit)).fact


def _built(spark: SparkSession, sf_dir: str) -> FT.Star:
    """The star as ``extract`` (CSV), ``build`` (written, checked) and ``load_star`` give it."""

    def make() -> FT.Star:
        csv, out = _scratch(spark, "raw"), _scratch(spark, "star")
        trips_from_tables(spark, sf_dir).write.options(**_CSV).csv(csv)
        P.build(P.extract(spark, csv).trips, out, stage_input=False)
        return P.load_star(spark, out)

    return _memo(spark, sf_dir, "built", make)


def _published(spark: SparkSession, sf_dir: str) -> str:
    def make() -> str:
        out = _scratch(spark, "published")
        P.publish(_built(spark, sf_dir), out, single_file=True)
        return out

    return _memo(spark, sf_dir, "published", make)


#: The first batch of the appended star: some members come with the second only.
FIRST_BATCH = "trip_distance < 6 AND payment_type <> 3 AND coalesce(passenger_count, 0) <> 2"


def _appended(spark: SparkSession, sf_dir: str) -> FT.Star:
    """A versioned star of one batch, to which the other one was appended."""

    def make() -> FT.Star:
        out, trips = _scratch(spark, "versions"), _trips(spark, sf_dir)
        # The batches are read from the staged trips: no second staging.
        P.build(trips.where(FIRST_BATCH), out, versions=True, stage_input=False)
        P.append(spark, trips.where(f"NOT ({FIRST_BATCH})"), out, stage_input=False)
        return P.load_star(spark, out)

    return _memo(spark, sf_dir, "appended", make)


def staged_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row count ``extract`` reports, and the rows it has staged."""
    trips_from_csv(spark, sf_dir)
    ex = P.extract(spark, _memo(spark, sf_dir, "csv", str), staging_path=_scratch(spark, "staged"))
    return ex.trips.agg(F.count(F.lit(1)).alias("stored")).select(F.lit(ex.row_count).cast("long").alias("reported"), "stored")


def _zone_run(spark: SparkSession, sf_dir: str) -> str:
    """Where the zone lane's whole run over two monthly files has put its results."""

    def make() -> str:
        out = _scratch(spark, "zone-run")
        trips_parquet_months(spark, sf_dir)
        P.run(spark, _memo(spark, sf_dir, "months", list), out, source="parquet")
        return out

    return _memo(spark, sf_dir, "zone-run", make)


_STATS = "struct<min:double,max:double,mean:double,median:double>"
_PROFILE = f"struct<row_count:bigint,columns:array<string>,null_counts:map<string,bigint>,numeric_columns:map<string,{_STATS}>>"


def _profile_rows(profile: DataFrame, *keys: str) -> DataFrame:
    """A column ``p`` of profile documents as one row per profiled column."""
    x = profile.select(*keys, "p.row_count", "p.null_counts", "p.numeric_columns", F.posexplode("p.columns").alias("ordinal", "column"))
    at = F.col("numeric_columns")[F.col("column")]
    return x.select(
        *keys, "column", "ordinal", "row_count", F.col("null_counts")[F.col("column")].alias("null_count"),
        at["min"].alias("min"), at["max"].alias("max"), F.round(at["mean"], MEAN_DIGITS).alias("mean"), at["median"].alias("median"),
    )


def run_zones_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone run's one profile JSON, keyed by mart: one row per mart and column."""
    text = spark.read.text(f"{_zone_run(spark, sf_dir)}/processed/analytics_stats.json")
    docs = text.select(F.explode(F.from_json("value", f"map<string,{_PROFILE}>")).alias("mart", "p"))
    return _profile_rows(docs, "mart")


def published_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is published of a star whose payments have no names, failures skipped:
    each mart's status and the rows its file has."""
    s = star(spark, sf_dir)
    broken = FT.Star(s.datetime, s.location, s.payment.drop("payment_name"), s.passenger, s.fact)
    out = _scratch(spark, "skipped")
    status = P.publish(broken, out, on_error="skip")
    rows = None
    for name, told in status.items():
        good = told == "ok"
        file = spark.read.option("header", True).csv(f"{out}/{name}.csv") if good else spark.range(0)
        one = file.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("mart"), F.lit(told.split(":")[0]).alias("status"), "rows"
        )
        rows = one if rows is None else rows.unionAll(one)
    return rows


def _exported(name: str, like: str):
    """A published CSV with each row's position in the file."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = QUERIES[like](spark, sf_dir).schema
        # One file, one partition: ids follow the lines.
        rows = spark.read.option("header", True).schema(schema).csv(f"{_published(spark, sf_dir)}/{name}.csv")
        return rows.withColumn("pos", F.monotonically_increasing_id())

    return q


def published_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published profile JSON of the daily mart, one row per column."""
    text = spark.read.text(f"{_published(spark, sf_dir)}/profiles/mart=vw_daily_stats")
    return _profile_rows(text.select(F.from_json("value", _PROFILE).alias("p")))


def published_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment records of the published report JSON, in their order."""
    report = spark.read.json(f"{_published(spark, sf_dir)}/summary_report.json")
    return report.select(F.posexplode("payment_distribution").alias("pos", "r")).select(
        F.col("pos").cast("long").alias("pos"), "r.payment_name", "r.trip_count", "r.percentage"
    )


def summary_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's overall figures, rounded to 2 places."""
    return M.summary_report(star(spark, sf_dir).fact, star(spark, sf_dir).payment).select("overall_stats.*")


def summary_report_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report's payment records with their position in the array."""
    s = star(spark, sf_dir)
    report = M.summary_report(s.fact, s.payment)
    return report.select(F.posexplode("payment_distribution").alias("pos", "r")).select(
        F.col("pos").cast("long").alias("pos"), "r.payment_name", "r.trip_count", "r.percentage"
    )


def _mart(fn, grain="distinct", null_keys="drop", dim="datetime", **kw):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = star(spark, sf_dir, grain, null_keys)
        return fn(s.fact, getattr(s, dim), **kw)

    return q


#: A mean of doubles depends on the order of summation in its last bits; the
#: compared queries round it to so many digits.
MEAN_DIGITS = 6


def _profile_of(query: Callable[[SparkSession, str], DataFrame]):
    return lambda spark, sf_dir: profile(query(spark, sf_dir)).withColumn("mean", F.round("mean", MEAN_DIGITS))


def _weighted(fn, dim=None, **kw):
    """A mart of the per-row grain, from weighted facts of the distinct one."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact = weighted_fact(spark, sf_dir)
        return fn(fact, getattr(star(spark, sf_dir), dim), **kw) if dim else fn(fact, **kw)

    return q


def check_orphans_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-row dimension's ids checked against the distinct one: those
    beyond its last id are orphans."""
    ids = D.datetime_dim(_trips(spark, sf_dir), grain="per_row").select("datetime_id")
    return Q.check_orphans(ids, star(spark, sf_dir).tables(), {"datetime_id": "dim_datetime"})


def check_orphans_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star's facts against dimensions without their last members."""
    s = star(spark, sf_dir)
    tables = dict(s.tables())
    tables["dim_location"] = s.location.where("location_id % 7 <> 3")
    tables["dim_payment"] = s.payment.where("payment_name <> 'Cash'")
    tables["dim_passenger"] = s.passenger.where("passenger_count < 4")
    return Q.check_orphans(s.fact, tables)


def check_unique_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that share a datetime id with another one."""
    return Q.check_unique(star(spark, sf_dir).fact, "datetime_id", "fact_trips")


def check_non_negative_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measure that is negative for many facts: tip minus fare."""
    fact = star(spark, sf_dir).fact
    return Q.check_non_negative(fact.select((F.col("tip_amount") - F.col("fare_amount")).alias("margin")), ["margin"])


def _check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = star(spark, sf_dir)
    keys = [("fact_trips", s.fact, "trip_id"), ("dim_datetime", s.datetime, "datetime_id"),
            ("dim_location", s.location, "location_id"), ("dim_payment", s.payment, "payment_id"),
            ("dim_passenger", s.passenger, "passenger_id")]
    out = None
    for table, df, key in keys:
        r = Q.check_unique(df, key, table)
        out = r if out is None else out.unionAll(r)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources
    "trips_normalized": trips_normalized,
    "trips_from_csv": trips_from_csv,
    "trips_staged": lambda s, d: _trips(s, d),
    # dimensions
    "trips_parquet_months": trips_parquet_months,
    "trips_nan_codes": trips_nan_codes,
    "dim_datetime_distinct": lambda s, d: star(s, d).datetime,
    "dim_datetime_per_row": lambda s, d: D.datetime_dim(_trips(s, d), grain="per_row"),
    "dim_datetime_monday": lambda s, d: zone_star(s, d).datetime,
    "dim_location": lambda s, d: star(s, d).location,
    "dim_location_zones": lambda s, d: zone_star(s, d).location,
    "dim_payment": lambda s, d: star(s, d).payment,
    "dim_payment_raw": lambda s, d: zone_star(s, d).payment,
    "dim_passenger": lambda s, d: star(s, d).passenger,
    "dim_passenger_zones": lambda s, d: zone_star(s, d).passenger,
    # facts
    "fact_distinct": lambda s, d: star(s, d).fact,
    "fact_per_row": lambda s, d: star(s, d, "per_row").fact,
    "fact_null_match": lambda s, d: star(s, d, "distinct", "match").fact,
    "fact_per_row_null_match": lambda s, d: star(s, d, "per_row", "match").fact,
    "fact_zones": lambda s, d: zone_star(s, d).fact,
    "fact_half_seconds": lambda s, d: _half_star(s, d, "int"),
    "fact_half_seconds_double": lambda s, d: _half_star(s, d, "double"),
    # through the entry points: extract, build, publish, read back
    "built_fact": lambda s, d: _built(s, d).fact,
    "built_dim_datetime": lambda s, d: _built(s, d).datetime,
    "built_dim_payment": lambda s, d: _built(s, d).payment,
    "appended_fact": lambda s, d: _appended(s, d).fact,
    "appended_dim_datetime": lambda s, d: _appended(s, d).datetime,
    "appended_dim_location": lambda s, d: _appended(s, d).location,
    "appended_dim_payment": lambda s, d: _appended(s, d).payment,
    "appended_dim_passenger": lambda s, d: _appended(s, d).passenger,
    "staged_count": staged_count,
    "run_zones_fact": lambda s, d: P.load_star(s, f"{_zone_run(s, d)}/star", "zones").fact,
    # marts
    "mart_hourly": _mart(M.hourly),
    "mart_locations": _mart(M.popular_locations, dim="location"),
    "mart_payment": _mart(M.payment, dim="payment"),
    "mart_daily": _mart(M.daily),
    "mart_hourly_narrow": _mart(M.hourly, columns="narrow"),
    "mart_locations_narrow": _mart(M.popular_locations, dim="location", columns="narrow"),
    "mart_payment_narrow": _mart(M.payment, dim="payment", columns="narrow"),
    "mart_hourly_per_row": _weighted(M.hourly, "datetime"),
    "mart_locations_per_row": _weighted(M.popular_locations, "location"),
    "mart_payment_per_row": _weighted(M.payment, "payment"),
    "mart_daily_per_row": _weighted(M.daily, "datetime"),
    "mart_hourly_null_match": _mart(M.hourly, null_keys="match"),
    "mart_hourly_rollup": lambda s, d: M.split_datetime_rollup(M.datetime_rollup(star(s, d).fact, star(s, d).datetime))[0],
    "mart_daily_rollup": lambda s, d: M.split_datetime_rollup(M.datetime_rollup(star(s, d).fact, star(s, d).datetime))[1],
    # summary
    "summary_overall": lambda s, d: M.summary(star(s, d).fact),
    "summary_overall_per_row": _weighted(M.summary),
    "summary_zones": lambda s, d: M.summary(zone_star(s, d).fact),
    "mart_hourly_zones": lambda s, d: M.hourly(zone_star(s, d).fact, zone_star(s, d).datetime),
    "mart_payment_zones": lambda s, d: M.payment(zone_star(s, d).fact, zone_star(s, d).payment),
    "mart_daily_zones": lambda s, d: M.daily(zone_star(s, d).fact, zone_star(s, d).datetime),
    "summary_rounded": summary_rounded,
    "summary_report_records": summary_report_records,
    "payment_distribution": _mart(M.payment_distribution, dim="payment"),
    "payment_distribution_per_row": _weighted(M.payment_distribution, "payment"),
    "payment_distribution_null_match": _mart(M.payment_distribution, null_keys="match", dim="payment"),
    # checks
    "check_not_null": lambda s, d: Q.check_not_null(zone_star(s, d).fact, Q.ZONE_KEY_FIELDS),
    "check_non_negative": lambda s, d: Q.check_non_negative(zone_star(s, d).fact, Q.NON_NEGATIVE_FIELDS),
    "check_not_null_trips": lambda s, d: Q.check_not_null(_trips(s, d), _trips(s, d).columns),
    "check_unique": _check_unique,
    "check_orphans": lambda s, d: Q.check_orphans(star(s, d).fact, star(s, d).tables()),
    "check_orphans_per_row": check_orphans_per_row,
    "check_orphans_gaps": check_orphans_gaps,
    "check_unique_repeated": check_unique_repeated,
    "check_non_negative_margin": check_non_negative_margin,
    "check_orphans_null_match": lambda s, d: Q.check_orphans(
        star(s, d, "distinct", "match").fact, star(s, d, "distinct", "match").tables()
    ),
}

QUERIES.update(
    {
        "profile_hourly": _profile_of(QUERIES["mart_hourly"]),
        "profile_daily": _profile_of(QUERIES["mart_daily"]),
        "profile_locations": _profile_of(QUERIES["mart_locations"]),
        "profile_payment": _profile_of(QUERIES["mart_payment"]),
        "profile_trips": _profile_of(_trips),
        "published_hourly": _exported("vw_hourly_fares", "mart_hourly"),
        "published_locations": _exported("vw_popular_locations", "mart_locations"),
        "published_payment": _exported("vw_payment_analysis", "mart_payment"),
        "published_daily": _exported("vw_daily_stats", "mart_daily"),
        "published_profile_daily": published_profile,
        "published_report_records": published_report,
        "published_skipping": published_skipping,
        "run_zones_profiles": run_zones_profiles,
    }
)
