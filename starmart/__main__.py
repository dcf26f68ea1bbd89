"""Command line: the job's steps as a user runs them.

    spark-submit --py-files starmart.zip starmart/__main__.py run --input trips.csv --out /data/taxi
    python -m starmart run --input trips.csv --out /data/taxi
    python -m starmart extract --input trips.csv --staging /data/taxi/staging
    python -m starmart build   --input /data/taxi/staging --source staged --star /data/taxi/star
    python -m starmart build   --input jan.csv --star /data/taxi/star --versions
    python -m starmart append  --input feb.csv --star /data/taxi/star
    python -m starmart publish --star /data/taxi/star --out /data/taxi/processed

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings are those of ``spark-submit``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="starmart")
    sub = p.add_subparsers(dest="command", required=True)

    def common(sp, star_options=True, sources=("csv", "parquet")):
        sp.add_argument("--input", action="append", required=True, help="input path (repeat for several files)")
        sp.add_argument("--source", choices=list(sources), default="csv",
                        help="csv (coordinates), parquet (zone-id months) or staged (a staging table)")
        if star_options:
            sp.add_argument("--grain", choices=["distinct", "per_row"], default="distinct")
            sp.add_argument("--null-keys", choices=["drop", "match"], default="drop")
            sp.add_argument("--buckets", type=int, default=None)
            sp.add_argument("--week-start", choices=["sunday", "monday"], default="sunday")
            sp.add_argument("--duration-unit", choices=["int", "double"], default="int")
            sp.add_argument("--first-id", type=int, default=None)
            sp.add_argument("--unordered-ids", action="store_true", help="number facts without sorting them")
            sp.add_argument("--write-mode", choices=["overwrite", "append"], default="overwrite")

    ex = sub.add_parser("extract", help="check columns, write the staging table, print its row count")
    common(ex, star_options=False)
    ex.add_argument("--staging", required=True)
    ex.add_argument("--mode", choices=["overwrite", "ignore", "error"], default="overwrite")

    bd = sub.add_parser("build", help="dimensions and fact to --star, then the checks")
    common(bd, sources=("csv", "parquet", "staged"))
    bd.add_argument("--star", required=True)
    bd.add_argument("--variant", choices=["coords", "zones"], default=None,
                    help="default: zones for parquet months, coords for csv; a staged table by its columns")

    bd.add_argument("--versions", action="store_true", help="write the next version of a versioned star")

    ap = sub.add_parser("append", help="add a batch of trips to a versioned star")
    common(ap, star_options=False, sources=("csv", "parquet", "staged"))
    ap.add_argument("--star", required=True)

    pb = sub.add_parser("publish", help="marts, profiles and report from a built star")
    pb.add_argument("--star", required=True)
    pb.add_argument("--out", required=True)
    pb.add_argument("--variant", choices=["coords", "zones"], default="coords")
    pb.add_argument("--on-error", choices=["raise", "skip"], default="raise")
    pb.add_argument("--profile-layout", choices=["per_mart", "combined"], default="per_mart")

    pb.add_argument("--single-file", action="store_true", help="one CSV file per mart")

    rn = sub.add_parser("run", help="extract, build and publish")
    common(rn)
    rn.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("starmart").getOrCreate()
    # Trip times have no zone: a zoned Parquet timestamp is read as its UTC wall time.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    from starmart.checkpoint import scratch_scope

    # Intermediate tables of the command are deleted when it ends.
    with scratch_scope(spark):
        result = _command(args, spark)
    print(json.dumps(result))
    return result


def _command(args: argparse.Namespace, spark: SparkSession) -> dict:
    from starmart.plans import pipeline as P

    options = {} if args.command in ("extract", "publish", "append") else {
        "grain": args.grain, "null_keys": args.null_keys, "buckets": args.buckets, "week_start": args.week_start,
        "duration_unit": args.duration_unit, "first_id": args.first_id, "order_ids": not args.unordered_ids, "mode": args.write_mode,
    }
    if args.command == "extract":
        ex = P.extract(spark, args.input, args.source, staging_path=args.staging, mode=args.mode)
        result = {"staging": args.staging, "rows": ex.row_count}
    elif args.command == "build":
        trips = spark.read.parquet(*args.input) if args.source == "staged" else P.extract(spark, args.input, args.source).trips
        variant = args.variant or ("coords" if "pickup_latitude" in trips.columns else "zones")
        P.build(trips, args.star, variant=variant, stage_input=False, versions=args.versions, **options)
        result = {"star": args.star}
    elif args.command == "append":
        trips = spark.read.parquet(*args.input) if args.source == "staged" else P.extract(spark, args.input, args.source).trips
        P.append(spark, trips, args.star, stage_input=False)
        result = {"star": args.star}
    elif args.command == "publish":
        star = P.load_star(spark, args.star, args.variant)
        result = P.publish(star, args.out, on_error=args.on_error, profile_layout=args.profile_layout,
                           single_file=args.single_file)
    else:
        result = P.run(spark, args.input, args.out, source=args.source, **options)
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
