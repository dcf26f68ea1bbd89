"""Bench: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. Steps, in order:
  stage            trips (lineitem JOIN orders) written once as the staging table
  dense_key        the datetime dimension from staging (distinct pairs + ids)
  star_distinct    all four dimensions and the fact, distinct grain, from staging
  star_distinct_unordered_ids   the same with trip ids not ordered (no global sort)
  star_per_row     the same, per-row grain
  fact_zones       the zone-lane star from the two raw monthly frames
  mart_* / summary_overall / payment_distribution / check_* / profile_daily
                   over the distinct star built above (as the marts run over
                   the stored star in production)
  publish          all four marts to CSV, their profiles to JSON, the report
Each step ends in an action that consumes the whole result.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from starmart.session import local_session

    spark = local_session(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")),
                          app="starmart-bench")
    from pyspark.sql import functions as F

    from starmart.operators import dims as D
    from starmart.operators import facts as FT
    from starmart.operators import marts as M
    from starmart.operators import quality as Q
    from starmart.operators.profile import profile
    from starmart.plans.queries import trips_normalized
    from starmart.sources.adapter import trips_from_tables
    from starmart.sources.staging import stage

    spark.range(1000).agg(F.sum("id")).collect()  # JVM / codegen warm-up, not timed

    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    raw = trips_from_tables(spark, sf_dir)
    trips = timed("stage", lambda: stage(raw, partitions=int(cpus)))
    timed("dense_key", lambda: D.datetime_dim(trips).count())

    def star_of(grain):
        s = FT.build_star(trips, grain=grain, stage_input=False)
        s.fact.count()
        return s

    star = timed("star_distinct", lambda: star_of("distinct"))
    timed("star_distinct_unordered_ids",
          lambda: FT.build_star(trips, stage_input=False, order_ids=False).fact.count())
    timed("star_per_row", lambda: star_of("per_row"))
    timed("weigh", lambda: FT.weigh(star.fact, star.datetime, trips).count())
    timed("fact_zones", lambda: FT.build_zone_star(trips_normalized(spark, sf_dir)).fact.count())

    timed("mart_hourly", lambda: M.hourly(star.fact, star.datetime).collect())
    timed("mart_locations", lambda: M.popular_locations(star.fact, star.location).collect())
    timed("mart_payment", lambda: M.payment(star.fact, star.payment).collect())
    timed("mart_daily", lambda: M.daily(star.fact, star.datetime).collect())
    timed("summary_overall", lambda: M.summary(star.fact).collect())
    timed("payment_distribution", lambda: M.payment_distribution(star.fact, star.payment).collect())
    timed("check_orphans", lambda: Q.check_orphans(star.fact, star.tables()).collect())
    timed("check_unique", lambda: Q.check_unique(star.fact, "trip_id").collect())
    timed("profile_daily", lambda: profile(M.daily(star.fact, star.datetime)).collect())

    from starmart.checkpoint import app_root
    from starmart.plans.pipeline import publish

    out = f"{app_root(spark)}/bench-publish"
    timed("publish", lambda: publish(star, out))

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
