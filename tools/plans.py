"""Write PLANS.md: the physical plans of the headline operators at a scale.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from starmart.operators import facts as FT
    from starmart.operators import marts as M
    from starmart.operators import quality as Q
    from starmart.plans.queries import _trips, star
    from starmart.session import local_session

    spark = local_session()
    s = star(spark, sf_dir)
    trips = _trips(spark, sf_dir)

    captured = {}
    original = FT.dense_key

    def spy(df, *a, **k):
        captured["pre_key_fact"] = df
        return original(df, *a, **k)

    FT.dense_key = spy
    FT.build(trips, s.datetime, s.location, s.payment, s.passenger)
    FT.dense_key = original

    items = {
        "fact build: joins before the trip-id key": captured["pre_key_fact"],
        "mart: hourly": M.hourly(s.fact, s.datetime),
        "marts: hourly + daily by grouping sets": M.datetime_rollup(s.fact, s.datetime),
        "all marts and the report: one scan of the fact (grand_rollup)": M.grand_rollup(s),
        "facts: a projection of what the one range pass has stored": s.fact,
        "mart: popular locations": M.popular_locations(s.fact, s.location),
        "payment distribution (scalar subquery)": M.payment_distribution(s.fact, s.payment),
        "summary report (one scan of the fact)": M.summary_report(s.fact, s.payment),
        "check: orphans": Q.check_orphans(s.fact, s.tables()),
        "check: unique trip_id": Q.check_unique(s.fact, "trip_id", "fact_trips"),
    }
    out = [f"# Physical plans at {os.path.basename(sf_dir)}", "",
           "Generated by `tools/plans.py` (final adaptive plans after one run).", ""]
    for title, df in items.items():
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln[:200] for ln in plan.splitlines()]
        out += [f"## {title}", "", "```", *lines, "```", ""]
    # The same operators as they plan when the datetime dimension is too big
    # to broadcast (as at 100 TB): Spark's size-based broadcasts are off.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    FT.dense_key = spy
    FT.build(trips, s.datetime, s.location, s.payment, s.passenger)
    FT.dense_key = original
    from starmart.operators.keys import numbered
    from starmart.schema import TRIPS_COORD

    fact_order = [*TRIPS_COORD.fieldNames(), "datetime_id"]
    at_scale = {
        "at scale: fact build joins (datetime by sort-merge)": captured["pre_key_fact"],
        "at scale: trip-id numbering written by dense_key (range exchange, local sorts)":
            numbered(captured["pre_key_fact"], fact_order, unique=False),
        "at scale: all marts from one scan (grand_rollup)": M.grand_rollup(s),
        "at scale: hourly + daily by grouping sets": M.datetime_rollup(s.fact, s.datetime),
        "at scale: check orphans": Q.check_orphans(s.fact, s.tables()),
    }
    for title, df in at_scale.items():
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln[:200] for ln in plan.splitlines()]
        out += [f"## {title}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
