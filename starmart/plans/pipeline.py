"""The job as a user runs it: extract -> build the star -> checks -> publish.

Each step is a function over DataFrames. The star's tables are written (one
Parquet folder each) before marts read them, so ids are fixed once and a
rerun overwrites instead of duplicating.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.checkpoint import materialize, scratch_scope
from starmart.operators import marts as M
from starmart.operators import quality as Q
from starmart.jobs import concurrently
from starmart.operators.facts import Star, build_star, build_zone_star, resolve_batch
from starmart.operators.profile import profile_docs
from starmart.schema import STAR_SCHEMAS, TRIPS_COORD, conform
from starmart.sinks import versions as V
from starmart.sinks.writers import export_all, export_json, save, save_bucketed, save_table_with_schema
from starmart.sources.staging import stage
from starmart.sources.trips import normalize, read_trips_csv, read_trips_parquet


@dataclass
class Extracted:
    trips: DataFrame
    row_count: int


def extract(
    spark: SparkSession,
    paths: str | Sequence[str],
    source: str = "csv",
    staging_path: str | None = None,
    mode: str = "overwrite",
) -> Extracted:
    """Check the input's columns, read it with a declared schema and write it
    once as the staging table, counting its rows during that same write.

    ``source="csv"``: coordinate trips. ``source="parquet"``: zone trips from
    one or more monthly files, renamed and selected. ``staging_path`` names
    the staging table (``mode="ignore"`` keeps an existing one, as a
    create-if-absent does); without it the table goes to the checkpoint folder.
    """
    if source == "csv":
        trips = read_trips_csv(spark, paths, TRIPS_COORD)
    elif source == "parquet":
        trips = normalize(read_trips_parquet(spark, paths))
    else:
        raise ValueError(f"source must be 'csv' or 'parquet', not {source!r}")
    obs = Observation("staging")
    observed = trips.observe(obs, F.count(F.lit(1)).alias("rows"))
    if staging_path is None:
        staged = stage(observed)
    else:
        save(observed, staging_path, mode=mode)
        staged = spark.read.parquet(staging_path)
        if mode == "ignore":
            # The write may have been skipped; the kept table's count is metadata.
            return Extracted(staged, staged.count())
    return Extracted(staged, int(obs.get["rows"]))


def build(
    trips: DataFrame,
    out_dir: str | None = None,
    variant: str = "coords",
    grain: str = "distinct",
    null_keys: str = "drop",
    check: bool = True,
    stage_input: bool = True,
    buckets: int | None = None,
    table_prefix: str = "starmart_",
    mode: str = "overwrite",
    week_start: str = "sunday",
    duration_unit: str = "int",
    first_id: int | None = None,
    order_ids: bool = True,
    versions: bool = False,
) -> Star:
    """Build the star; write its tables under ``out_dir`` with their declared
    schemas and re-read them; run the lane's checks (raising on failure).

    ``mode="append"`` adds to the tables that are there; give ``first_id`` the
    next free id then. ``first_id`` is by default 1, and 0 for zones. The zone
    star has one grain and keeps every trip: other choices are an error.

    With ``buckets``, the fact and the datetime dimension are written as
    catalog tables (``table_prefix`` + name) bucketed and sorted by
    ``datetime_id``, so the marts and checks that join them on that key
    later shuffle neither side.

    With ``versions`` the star becomes the next version of a versioned store (``sinks.versions``):
    it is checked before it replaces the one before, readers see one or the other, and
    ``append`` can add batches to it.
    """
    if versions and (buckets or mode != "overwrite" or not out_dir):
        raise ValueError("a versioned star needs out_dir, is not bucketed, and is appended to with append()")
    if variant == "coords":
        star = build_star(
            trips, grain=grain, null_keys=null_keys, week_start=week_start, duration_unit=duration_unit,
            first_id=1 if first_id is None else first_id, stage_input=stage_input, order_ids=order_ids,
        )
    else:
        if (grain, null_keys, week_start, duration_unit) != ("distinct", "drop", "sunday", "int"):
            raise ValueError("the zone star has no grain, null_keys, week_start or duration_unit to choose")
        star = build_zone_star(trips, first_id=first_id or 0, stage_input=stage_input, order_ids=order_ids)
    if versions:
        options = {"null_keys": null_keys, "week_start": week_start, "duration_unit": duration_unit, "order_ids": order_ids, "grain": grain}
        before = V.version(trips.sparkSession, out_dir)
        new = V.Version(1 + (before.number if before else 0), variant, options)
        start = (1 if variant == "coords" else 0) if first_id is None else first_id
        return _write_version(trips.sparkSession, out_dir, new, star, None, dict.fromkeys(star.tables(), start), check)
    if out_dir:
        spark = trips.sparkSession
        tables = {}
        for name, df in star.tables().items():
            if buckets and name in ("fact_trips", "dim_datetime"):
                df = conform(df, STAR_SCHEMAS[star.variant][name])
                save_bucketed(df, f"{table_prefix}{name}", f"{out_dir}/{name}", "datetime_id", buckets, mode=mode)
                tables[name] = spark.table(f"{table_prefix}{name}")
            else:
                save_table_with_schema(df, f"{out_dir}/{name}", STAR_SCHEMAS[star.variant][name], mode=mode)
                tables[name] = spark.read.parquet(f"{out_dir}/{name}")
        star = Star(
            tables["dim_datetime"], tables["dim_location"], tables["dim_payment"],
            tables["dim_passenger"], tables["fact_trips"], star.variant,
        )
    if check:
        Q.run_checks(checks(star))
    return star


def _write_version(
    spark: SparkSession, root: str, new: V.Version, rows: Star, seen: Star | None, first: dict[str, int], check: bool
) -> Star:
    """Write the rows to new folders, check them, and only then make ``new`` visible
    (what it has in ``folders`` before stays in front). ``seen``: the dimensions the rows' facts refer to, if not their own."""
    tables = rows.tables()
    folders = concurrently(*[lambda n=n, df=df: V.write_table(df, root, n, new.variant) for n, df in tables.items()])
    written = {}
    for name, folder in zip(tables, folders, strict=True):
        new.folders.setdefault(name, []).append(folder)
        written[name] = spark.read.schema(STAR_SCHEMAS[new.variant][name]).parquet(f"{root}/{folder}")
    star = _star(written, new.variant)
    if check:
        # The new facts may refer to every member there is, and ids in a row prove themselves.
        whole = star if seen is None else replace(_star({name: V.read_table(spark, root, name, new) for name in tables}, new.variant), fact=star.fact)
        # A batch's ids begin where the ids before end, so its own are all that can clash.
        Q.run_checks(checks(whole) if seen is None else [*checks(star)[:-1], Q.check_orphans(star.fact, whole.tables())]
                     if new.variant == "coords" else checks(star))
    for name, n in zip(tables, concurrently(*[df.count for df in written.values()]), strict=True):
        new.next_id[name] = first[name] + n
        new.rows[name] = new.rows.get(name, 0) + n
    V.commit(spark, root, new)
    return _star({name: V.read_table(spark, root, name, new) for name in tables}, new.variant)


def append(spark: SparkSession, trips: DataFrame, star_dir: str, check: bool = True, stage_input: bool = True) -> Star:
    """Add a batch of trips to the versioned star in ``star_dir``, as its next version.

    Members that the stored dimensions have keep their ids; only new ones are added, with
    the next ids, and so are the batch's facts (``facts.resolve_batch``). The lane and its options
    are those the star was built with. Two batches hold what one build of both
    would, up to the order of ids. The per-row grain, where a later trip changes the facts of
    earlier ones, can't be appended to. An empty batch makes a version with the same rows.
    """
    now = V.version(spark, star_dir)
    if now is None:
        raise ValueError(f"no versioned star in {star_dir}: build one with versions=True")
    options = dict(now.options)
    if options.pop("grain") != "distinct":
        raise ValueError("a star of the per-row grain can't be appended to")
    trips = stage(trips) if stage_input else trips
    stored = {name: V.read_table(spark, star_dir, name, now) for name in now.folders}
    new, seen = resolve_batch(stored, now.next_id, trips, now.variant, **options)
    after = V.Version(now.number + 1, now.variant, now.options, {k: list(v) for k, v in now.folders.items()}, {}, dict(now.rows))
    return _write_version(spark, star_dir, after, new, seen, now.next_id, check)


def _star(t: dict[str, DataFrame], variant: str) -> Star:
    return Star(t["dim_datetime"], t["dim_location"], t["dim_payment"], t["dim_passenger"], t["fact_trips"], variant)


def load_star(spark: SparkSession, star_dir: str, variant: str = "coords", version: int | None = None) -> Star:
    """Read a star written by ``build``: the newest (or the asked) version of a versioned
    one, else the Parquet folders under ``star_dir``."""
    at = V.version(spark, star_dir, version)
    if at is not None:
        return _star({name: V.read_table(spark, star_dir, name, at) for name in at.folders}, at.variant)
    t = {name: spark.read.parquet(f"{star_dir}/{name}") for name in
         ("dim_datetime", "dim_location", "dim_payment", "dim_passenger", "fact_trips")}
    return _star(t, variant)


def checks(star: Star) -> list[DataFrame]:
    """The checks of each lane: key uniqueness and orphans for the coordinate
    star; NULL keys and negative measures for the zone star."""
    if star.variant == "zones":
        return [
            Q.check_not_null(star.fact, Q.ZONE_KEY_FIELDS),
            Q.check_non_negative(star.fact, Q.NON_NEGATIVE_FIELDS),
        ]
    return [
        Q.check_unique(star.fact, "trip_id", "fact_trips"),
        Q.check_unique(star.datetime, "datetime_id", "dim_datetime"),
        Q.check_unique(star.location, "location_id", "dim_location"),
        Q.check_unique(star.payment, "payment_id", "dim_payment"),
        Q.check_unique(star.passenger, "passenger_id", "dim_passenger"),
        Q.check_orphans(star.fact, star.tables()),
    ]


def _builders(star: Star) -> dict[str, Callable[[], DataFrame]]:
    """The marts as they are published, each built on demand."""
    out = {"vw_hourly_fares": lambda: M.hourly(star.fact, star.datetime)}
    if star.variant == "coords":
        out["vw_popular_locations"] = lambda: M.popular_locations(star.fact, star.location)
    out["vw_payment_analysis"] = lambda: M.payment(star.fact, star.payment)
    out["vw_daily_stats"] = lambda: M.daily(star.fact, star.datetime)
    return out


# The published marts and the sink order of each.
PUBLISHED = {
    "vw_hourly_fares": "hourly",
    "vw_popular_locations": "popular_locations",
    "vw_payment_analysis": "payment",
    "vw_daily_stats": "daily",
}


def publish(
    star: Star,
    out_dir: str,
    on_error: str = "raise",
    profile_layout: str = "per_mart",
    single_file: bool = False,
) -> dict[str, str]:
    """Marts to CSV (sorted), a profile of each mart to JSON, and the summary
    report to JSON. ``profile_layout="per_mart"`` writes one JSON per mart
    (``profiles/mart=<name>/``), ``"combined"`` one JSON keyed
    by mart name. A zone star has no
    coordinates, so its location mart is reported as skipped.

    ``on_error="raise"``: the first failure ends the publication; all marts and the
    report come from one scan of the fact (``marts.grand_rollup``), stored once.
    ``"skip"``: building, exporting and profiling one mart fail or succeed together, its
    status holds the error, and the others are written, so each mart is a scan and a stored
    table of its own; a failing report has a status ``summary_report``.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError(f"on_error must be 'raise' or 'skip', not {on_error!r}")
    builders, rollup, built = _builders(star), None, {}
    if on_error == "raise":
        rollup = materialize(M.grand_rollup(star), "rollup")
        split = M.split_grand_rollup(rollup)
        builders = {k: (lambda k=k: split[PUBLISHED[k]]) for k in builders}

    def build_one(name: str) -> DataFrame:
        # Computed once: read by the CSV and by the profile.
        built[name] = builders[name]() if rollup is not None else materialize(builders[name](), f"mart-{name}")
        return built[name]

    def profile_one(name: str, df: DataFrame) -> None:
        # Under "skip" a mart whose profile fails must fail by itself.
        if on_error == "skip":
            docs[name] = materialize(profile_docs({name: df}), f"profile-{name}")

    docs: dict[str, DataFrame] = {}
    status = export_all(
        {k: (lambda k=k: build_one(k)) for k in builders}, out_dir,
        {k: M.mart_order(PUBLISHED[k]) for k in builders}, on_error, single_file, profile_one,
    )
    if star.variant == "zones":
        status["vw_popular_locations"] = "skipped: the zone star has no coordinates"
    ok = {k: built[k] for k in builders if status.get(k) == "ok"}

    def all_docs() -> DataFrame:
        return reduce(DataFrame.unionAll, [docs[k] for k in ok]) if on_error == "skip" else profile_docs(ok)

    def write_profiles() -> None:
        if profile_layout == "per_mart" and ok:
            export_json(all_docs(), f"{out_dir}/profiles", single_file=False, partition_by=["mart"])
        elif ok:
            entry = F.concat(F.to_json(F.array("mart")).substr(F.lit(2), F.length(F.to_json(F.array("mart"))) - 2), F.lit(":"), "json")
            # One document per mart: bounded by the marts.
            one = all_docs().agg(F.array_sort(F.collect_list(entry)).alias("e"))
            export_json(one.select(F.concat(F.lit("{"), F.array_join("e", ","), F.lit("}")).alias("json")), f"{out_dir}/analytics_stats.json")

    def report() -> None:
        try:
            found = M.rollup_report(rollup) if rollup is not None else M.summary_report(star.fact, star.payment)
            export_json(found, f"{out_dir}/summary_report.json")
        except Exception as e:
            if on_error == "raise":
                raise
            status["summary_report"] = f"error: {e}"

    concurrently(write_profiles, report)
    return status


def run(
    spark: SparkSession,
    paths: str | Sequence[str],
    out_dir: str,
    source: str = "csv",
    release_intermediates: bool = True,
    **build_options,
) -> dict[str, str]:
    """extract -> build (tables under ``out_dir/star``) -> publish.

    Intermediate tables under the checkpoint folder are deleted at the end
    (``release_intermediates``); the star and the exports stay in ``out_dir``.
    """
    with scratch_scope(spark, release=release_intermediates):
        return _run(spark, paths, out_dir, source, **build_options)


def _run(spark, paths, out_dir, source, **build_options) -> dict[str, str]:
    ex = extract(spark, paths, source)
    variant = "coords" if source == "csv" else "zones"
    # extract already wrote the staging table
    star = build(ex.trips, f"{out_dir}/star", variant=variant, stage_input=False, **build_options)
    if variant == "zones":
        # As the zone lane does: failing marts are reported and skipped, and
        # the profiles go to one JSON keyed by mart.
        return publish(star, f"{out_dir}/processed", on_error="skip", profile_layout="combined")
    return publish(star, f"{out_dir}/processed")


__all__ = ["extract", "append", "build", "checks", "publish", "run"]
