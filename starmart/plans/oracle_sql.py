"""Plain-SQL statements (DuckDB dialect) equal to each named query.

They spell out the star's semantics a second way, over the same parquet
tables, and are what ``__spark_entry__.oracle_sql`` hands to the driver.
Ordered numbers use ``NULLS FIRST`` everywhere (Spark's ascending default).
"""

from __future__ import annotations

from starmart.functions.payment import LOCATION_NAME, PAYMENT_CODES, UNKNOWN_DESCRIPTION, UNKNOWN_NAME

COORDS = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
STAGING = ["pickup_datetime", "dropoff_datetime", *COORDS, "passenger_count", "trip_distance",
           "fare_amount", "tip_amount", "total_amount", "payment_type"]
ZONE = ["pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "pickup_location_id",
        "dropoff_location_id", "payment_type", "fare_amount", "tip_amount", "total_amount"]

_D = "CAST({} AS DOUBLE)"


def _ord(cols, alias=""):
    return ", ".join(f"{alias}{c} NULLS FIRST" for c in cols)


TRIPS = f"""
base AS (
  SELECT l.l_orderkey AS k, l.l_linenumber AS ln, l.l_partkey AS pk, l.l_suppkey AS sk,
         l.l_quantity AS qty, o.o_orderdate AS order_date,
         o.o_orderdate + to_seconds(CAST((l.l_orderkey * 7919 + l.l_linenumber * 613) % 86400 AS BIGINT)) AS pickup,
         floor(l.l_extendedprice) / CAST(1024 AS DOUBLE) AS fare,
         CAST(l.l_linenumber % 5 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS tip
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
trips AS (
  SELECT
    CAST(pickup AS TIMESTAMP) AS pickup_datetime,
    CAST(pickup + to_seconds(CAST(300 + (k % 40) * 60 AS BIGINT)) AS TIMESTAMP) AS dropoff_datetime,
    CAST(40.5 AS DOUBLE) + CAST(sk % 20 AS DOUBLE) * CAST(0.015625 AS DOUBLE) AS pickup_latitude,
    CAST(-74.25 AS DOUBLE) + CAST(sk % 16 AS DOUBLE) * CAST(0.03125 AS DOUBLE) AS pickup_longitude,
    CAST(40.5 AS DOUBLE) + CAST(pk % 20 AS DOUBLE) * CAST(0.015625 AS DOUBLE) AS dropoff_latitude,
    CAST(-74.25 AS DOUBLE) + CAST(pk % 16 AS DOUBLE) * CAST(0.03125 AS DOUBLE) AS dropoff_longitude,
    CAST(CASE WHEN ln = 7 THEN NULL ELSE ln END AS INTEGER) AS passenger_count,
    qty * CAST(0.25 AS DOUBLE) AS trip_distance,
    fare AS fare_amount,
    tip AS tip_amount,
    fare + tip + CAST(0.5 AS DOUBLE) AS total_amount,
    CAST(1 + sk % 5 AS BIGINT) AS payment_type,
    CAST(1 + sk % 263 AS BIGINT) AS pickup_location_id,
    CAST(1 + pk % 263 AS BIGINT) AS dropoff_location_id,
    order_date
  FROM base
)"""


def _parts(ts: str, prefix: str, week: str = "sunday") -> str:
    wd = f"dayofweek({ts})" if week == "sunday" else f"isodow({ts}) - 1"
    return (
        f"CAST(hour({ts}) AS INTEGER) AS {prefix}_hour, CAST(day({ts}) AS INTEGER) AS {prefix}_day, "
        f"CAST(month({ts}) AS INTEGER) AS {prefix}_month, CAST(year({ts}) AS INTEGER) AS {prefix}_year, "
        f"CAST({wd} AS INTEGER) AS {prefix}_weekday"
    )


def _dt(grain: str) -> str:
    src = "(SELECT DISTINCT pickup_datetime, dropoff_datetime FROM trips)" if grain == "distinct" else "trips"
    return f"""
dt AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY pickup_datetime NULLS FIRST, dropoff_datetime NULLS FIRST) AS BIGINT) AS datetime_id,
         pickup_datetime, {_parts('pickup_datetime', 'pickup')},
         dropoff_datetime, {_parts('dropoff_datetime', 'dropoff')}
  FROM {src} x
)"""


LOC = f"""
loc AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_ord(COORDS)}) AS BIGINT) AS location_id,
         {', '.join(COORDS)},
         '{LOCATION_NAME}' AS pickup_location_name, '{LOCATION_NAME}' AS dropoff_location_name
  FROM (SELECT DISTINCT {', '.join(COORDS)} FROM trips) x
)"""

def _case(pick: int, fallback: str) -> str:
    whens = " ".join(f"WHEN {code} THEN '{labels[pick]}'" for code, labels in PAYMENT_CODES.items())
    return f"CASE payment_type {whens} ELSE '{fallback}' END"


PAY = f"""
pay AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY payment_type NULLS FIRST) AS BIGINT) AS payment_id,
         CAST(payment_type AS VARCHAR) AS payment_type,
         {_case(0, UNKNOWN_NAME)} AS payment_name,
         {_case(1, UNKNOWN_DESCRIPTION)} AS payment_description
  FROM (SELECT DISTINCT payment_type FROM trips) x
)"""

PAS = """
pas AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY passenger_count NULLS FIRST) AS BIGINT) AS passenger_id, passenger_count
  FROM (SELECT DISTINCT passenger_count FROM trips) x
)"""

_DURATION = "CAST(date_diff('microsecond', {0}.pickup_datetime, {0}.dropoff_datetime) AS DOUBLE) / CAST(1000000 AS DOUBLE)"


def _fact(null_keys: str) -> str:
    if null_keys == "drop":
        join, eq = "JOIN", "="
    else:
        join, eq = "LEFT JOIN", "IS NOT DISTINCT FROM"
    on_loc = " AND ".join(f"l.{c} {eq} s.{c}" for c in COORDS)
    return f"""
fct AS (
  SELECT {', '.join('s.' + c for c in STAGING)},
         d.datetime_id, l.location_id, p.payment_id, ps.passenger_id,
         CAST(round_even({_DURATION.format('s')}, 0) AS INTEGER) AS trip_duration
  FROM trips s
  {join} dt d ON d.pickup_datetime {eq} s.pickup_datetime AND d.dropoff_datetime {eq} s.dropoff_datetime
  {join} loc l ON {on_loc}
  {join} pay p ON CAST(p.payment_type AS BIGINT) {eq} s.payment_type
  {join} pas ps ON ps.passenger_count {eq} s.passenger_count
),
fact AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_ord(STAGING)}, datetime_id NULLS FIRST) AS BIGINT) AS trip_id,
         datetime_id, location_id, payment_id, passenger_id,
         trip_distance, fare_amount, tip_amount, total_amount, trip_duration
  FROM fct
)"""


def star_with(grain: str = "distinct", null_keys: str = "drop", trips_table: str | None = None) -> str:
    """The star as CTEs; ``trips_table`` replaces the adapter with a table of
    coordinate trips (used by the randomised tests)."""
    trips = TRIPS if trips_table is None else f"\ntrips AS (SELECT * FROM {trips_table})"
    return "WITH " + ",".join([trips, _dt(grain), LOC, PAY, PAS, _fact(null_keys)])


def _zone_mart(sql: str) -> str:
    """A mart statement pointed at the zone star's tables."""
    return sql.replace("FROM fact f", "FROM zfact f").replace("JOIN dt d", "JOIN zdt d").replace("JOIN pay p", "JOIN zpay p")


ZONE_STAR = "WITH " + ",".join([
    TRIPS,
    f"""
ztrips AS (SELECT {', '.join(ZONE)} FROM trips)""",
    f"""
zkeyed AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY {_ord(ZONE)}) - 1 AS BIGINT) AS trip_id, {', '.join(ZONE)} FROM ztrips
)""",
    f"""
zdt AS (SELECT trip_id AS datetime_id, pickup_datetime, {_parts('pickup_datetime', 'pickup', 'monday')} FROM zkeyed)""",
    """
zpay AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY payment_type NULLS FIRST) - 1 AS BIGINT) AS payment_id, payment_type AS payment_name
  FROM (SELECT DISTINCT payment_type FROM ztrips) x
)""",
    """
zpas AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY passenger_count NULLS FIRST) - 1 AS BIGINT) AS passenger_id, passenger_count
  FROM (SELECT DISTINCT passenger_count FROM ztrips) x
)""",
    f"""
zfact AS (
  SELECT z.trip_id, z.trip_id AS datetime_id, z.pickup_location_id, z.dropoff_location_id,
         p.payment_id, ps.passenger_id, z.trip_distance,
         {_DURATION.format('z')} AS trip_duration,
         z.fare_amount, z.tip_amount, z.total_amount
  FROM zkeyed z
  LEFT JOIN zpay p ON z.payment_type IS NOT DISTINCT FROM p.payment_name
  LEFT JOIN zpas ps ON z.passenger_count IS NOT DISTINCT FROM ps.passenger_count
)""",
])


# ---- marts ---------------------------------------------------------------

MART_HOURLY = """
SELECT d.pickup_hour, AVG(f.fare_amount) AS avg_fare, COUNT(*) AS num_trips,
       AVG(f.tip_amount) AS avg_tip, AVG(f.total_amount) AS avg_total
FROM fact f JOIN dt d ON f.datetime_id = d.datetime_id
GROUP BY d.pickup_hour"""
MART_HOURLY_NARROW = """
SELECT d.pickup_hour, AVG(f.fare_amount) AS avg_fare, COUNT(*) AS num_trips
FROM fact f JOIN dt d ON f.datetime_id = d.datetime_id
GROUP BY d.pickup_hour"""
MART_LOCATIONS = """
SELECT l.pickup_latitude, l.pickup_longitude, COUNT(*) AS num_pickups, AVG(f.fare_amount) AS avg_fare,
       AVG(f.trip_distance) AS avg_distance, AVG(f.trip_duration) AS avg_duration
FROM fact f JOIN loc l ON f.location_id = l.location_id
GROUP BY l.pickup_latitude, l.pickup_longitude"""
MART_LOCATIONS_NARROW = """
SELECT l.pickup_latitude, l.pickup_longitude, COUNT(*) AS num_pickups, AVG(f.fare_amount) AS avg_fare
FROM fact f JOIN loc l ON f.location_id = l.location_id
GROUP BY l.pickup_latitude, l.pickup_longitude"""
MART_PAYMENT = """
SELECT p.payment_name, COUNT(*) AS num_trips, AVG(f.fare_amount) AS avg_fare, AVG(f.tip_amount) AS avg_tip,
       AVG(f.total_amount) AS avg_total, AVG(f.trip_distance) AS avg_distance
FROM fact f JOIN pay p ON f.payment_id = p.payment_id
GROUP BY p.payment_name"""
MART_PAYMENT_NARROW = """
SELECT p.payment_name, COUNT(*) AS num_trips, AVG(f.fare_amount) AS avg_fare, AVG(f.tip_amount) AS avg_tip
FROM fact f JOIN pay p ON f.payment_id = p.payment_id
GROUP BY p.payment_name"""
MART_DAILY = """
SELECT d.pickup_year, d.pickup_month, d.pickup_day, COUNT(*) AS num_trips, AVG(f.fare_amount) AS avg_fare,
       SUM(f.total_amount) AS total_revenue, AVG(f.trip_distance) AS avg_distance, AVG(f.trip_duration) AS avg_duration
FROM fact f JOIN dt d ON f.datetime_id = d.datetime_id
GROUP BY d.pickup_year, d.pickup_month, d.pickup_day"""

SUMMARY = """
SELECT COUNT(*) AS total_trips, SUM(total_amount) AS total_revenue, AVG(trip_distance) AS avg_distance,
       AVG(trip_duration) / CAST(60 AS DOUBLE) AS avg_duration_minutes
FROM {fact}"""

PAYMENT_DISTRIBUTION = """
SELECT p.payment_name, COUNT(*) AS trip_count,
       ROUND(CAST(COUNT(*) AS DOUBLE) * CAST(100 AS DOUBLE) / CAST((SELECT COUNT(*) FROM fact) AS DOUBLE), 2) AS percentage
FROM fact f JOIN pay p ON f.payment_id = p.payment_id
GROUP BY p.payment_name"""


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


def _not_null(table: str, cols: list[tuple[str, bool]]) -> str:
    return _union([
        f"SELECT 'not_null' AS \"check\", '{c}' AS \"column\", "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL{f' OR isnan({c})' if is_double else ''}) AS BIGINT) AS failures FROM {table}"
        for c, is_double in cols
    ])


def _non_negative(table: str, cols: list[str]) -> str:
    return _union([
        f"SELECT 'non_negative' AS \"check\", '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} < 0) AS BIGINT) AS failures FROM {table}"
        for c in cols
    ])


def _unique(items: list[tuple[str, str, str]]) -> str:
    out = []
    for label, table, key in items:
        out.append(f"SELECT 'unique' AS \"check\", '{label}.{key}' AS \"column\", "
                   f"CAST(count({key}) - count(DISTINCT {key}) AS BIGINT) AS failures FROM {table}")
        out.append(f"SELECT 'not_null' AS \"check\", '{label}.{key}' AS \"column\", "
                   f"CAST(count(*) - count({key}) AS BIGINT) AS failures FROM {table}")
    return _union(out)


def _orphans() -> str:
    fks = [("datetime_id", "dim_datetime", "dt"), ("location_id", "dim_location", "loc"),
           ("payment_id", "dim_payment", "pay"), ("passenger_id", "dim_passenger", "pas")]
    return _union([
        f"SELECT 'orphans' AS \"check\", '{fk}->{dim}' AS \"column\", CAST(count(*) AS BIGINT) AS failures "
        f"FROM fact f LEFT JOIN {t} d ON f.{fk} = d.{fk} WHERE f.{fk} IS NOT NULL AND d.{fk} IS NULL"
        for fk, dim, t in fks
    ])


def _profile(mart_sql: str, cols: list[tuple[str, str]]) -> str:
    """cols: (name, kind) with kind in {'int', 'double', 'text'}."""
    parts = []
    for i, (c, kind) in enumerate(cols):
        if kind == "text":
            stats = ", ".join(f"CAST(NULL AS DOUBLE) AS \"{s}\"" for s in ("min", "max", "mean", "median"))
            null = f"{c} IS NULL"
        else:
            v = f"CAST({c} AS DOUBLE)" if kind == "int" else f"(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)"
            null = f"{c} IS NULL" + (f" OR isnan({c})" if kind == "double" else "")
            lst = f"list_sort(list({v}) FILTER (WHERE {v} IS NOT NULL))"
            n = f"count({v})"
            stats = (f"min({v}) AS \"min\", max({v}) AS \"max\", round(avg({v}), 6) AS \"mean\", "
                     f"({lst}[({n} + 1) // 2] + {lst}[({n} + 2) // 2]) / 2 AS \"median\"")
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST({i} AS INTEGER) AS ordinal, CAST(count(*) AS BIGINT) AS row_count, "
            f"CAST(count(*) FILTER (WHERE {null}) AS BIGINT) AS null_count, {stats} FROM m"
        )
    return star_with() + f",\nm AS ({mart_sql})\n" + _union(parts)


def _zone_trips_union() -> str:
    cols = ", ".join(ZONE)
    return (
        "WITH " + TRIPS + "\n"
        f"SELECT {cols} FROM trips WHERE order_date < TIMESTAMP '1998-01-01'\n"
        f"UNION ALL\nSELECT {cols} FROM trips WHERE NOT coalesce(order_date < TIMESTAMP '1998-01-01', false)"
    )


def _trip_cols_kinds() -> list[tuple[str, bool]]:
    doubles = set(COORDS) | {"trip_distance", "fare_amount", "tip_amount", "total_amount"}
    return [(c, c in doubles) for c in STAGING]


def _half_second_star() -> str:
    """The star over trips of which those with an odd number of fare units
    take half a second longer."""
    trips = TRIPS.replace("trips AS (", "whole AS (") + """,
trips AS (
  SELECT * REPLACE (CASE WHEN CAST(fare_amount * 1024 AS BIGINT) % 2 = 1 THEN dropoff_datetime + to_milliseconds(500)
                         ELSE dropoff_datetime END AS dropoff_datetime)
  FROM whole
)"""
    return "WITH " + ",".join([trips, _dt("distinct"), LOC, PAY, PAS, _fact("drop")])


def _appended_star() -> str:
    """The star of two batches: a member's id follows the first batch it is in, then its key."""
    first = "trip_distance < 6 AND payment_type <> 3 AND coalesce(passenger_count, 0) <> 2"
    trips = TRIPS.replace("trips AS (", "whole AS (") + f""",
trips AS (SELECT *, CASE WHEN {first} THEN 1 ELSE 2 END AS batch FROM whole)"""
    dims = []
    for dim, keys in ((_dt("distinct"), "pickup_datetime, dropoff_datetime"), (LOC, ", ".join(COORDS)), (PAY, "payment_type"), (PAS, "passenger_count")):
        members = f"(SELECT {keys}, min(batch) AS batch FROM trips GROUP BY {keys})"
        dims.append(dim.replace(f"(SELECT DISTINCT {keys} FROM trips)", members).replace("OVER (ORDER BY ", "OVER (ORDER BY batch, "))
    fact = _fact("drop").replace("SELECT s.pickup_datetime", "SELECT s.batch, s.pickup_datetime").replace("OVER (ORDER BY ", "OVER (ORDER BY batch, ")
    return "WITH " + ",".join([trips, *dims, fact])


def _zone_profiles() -> str:
    """The zone marts' profiles as one table with the mart's published name."""
    marts = [
        ("vw_hourly_fares", MART_HOURLY, [("pickup_hour", "int"), ("avg_fare", "double"), ("num_trips", "int"), ("avg_tip", "double"), ("avg_total", "double")]),
        ("vw_payment_analysis", MART_PAYMENT, [("payment_name", "int"), ("num_trips", "int"), ("avg_fare", "double"),
                                               ("avg_tip", "double"), ("avg_total", "double"), ("avg_distance", "double")]),
        ("vw_daily_stats", MART_DAILY, _PROFILE_DAILY),
    ]
    ctes, selects = [], []
    for name, mart, cols in marts:
        rows = _profile("", cols).split("m AS ()\n")[1]
        ctes.append(f"{name} AS ({_zone_mart(mart)})")
        selects.append(f"SELECT '{name}' AS mart, p.* FROM ({rows.replace(' FROM m', f' FROM {name}')}) p")
    return ZONE_STAR + ",\n" + ",\n".join(ctes) + "\n" + _union(selects)


def _positioned(mart: str, order: str) -> str:
    return star_with() + f", m AS ({mart})\nSELECT *, CAST(ROW_NUMBER() OVER (ORDER BY {order}) - 1 AS BIGINT) AS pos FROM m"


_PROFILE_DAILY = [("pickup_year", "int"), ("pickup_month", "int"), ("pickup_day", "int"),
                  ("num_trips", "int"), ("avg_fare", "double"), ("total_revenue", "double"),
                  ("avg_distance", "double"), ("avg_duration", "double")]


ORACLE: dict[str, str] = {
    "trips_normalized": _zone_trips_union(),
    "trips_from_csv": "WITH " + TRIPS + f"\nSELECT {', '.join(STAGING)} FROM trips",
    "trips_staged": "WITH " + TRIPS + f"\nSELECT {', '.join(STAGING)} FROM trips",
    "dim_datetime_distinct": star_with() + "\nSELECT * FROM dt",
    "dim_datetime_per_row": star_with("per_row") + "\nSELECT * FROM dt",
    "dim_datetime_monday": ZONE_STAR
    + f"\nSELECT trip_id AS datetime_id, pickup_datetime, {_parts('pickup_datetime', 'pickup', 'monday')} FROM zkeyed",
    "dim_location": star_with() + "\nSELECT * FROM loc",
    "dim_location_zones": ZONE_STAR + "\nSELECT trip_id AS location_id, pickup_location_id, dropoff_location_id FROM zkeyed",
    "dim_payment": star_with() + "\nSELECT * FROM pay",
    "dim_payment_raw": ZONE_STAR + "\nSELECT * FROM zpay",
    "dim_passenger": star_with() + "\nSELECT * FROM pas",
    "dim_passenger_zones": ZONE_STAR + "\nSELECT * FROM zpas",
    "fact_distinct": star_with() + "\nSELECT * FROM fact",
    "fact_per_row": star_with("per_row") + "\nSELECT * FROM fact",
    "fact_null_match": star_with("distinct", "match") + "\nSELECT * FROM fact",
    "fact_per_row_null_match": star_with("per_row", "match") + "\nSELECT * FROM fact",
    "fact_zones": ZONE_STAR + "\nSELECT * FROM zfact",
    "mart_hourly": star_with() + MART_HOURLY,
    "mart_locations": star_with() + MART_LOCATIONS,
    "mart_payment": star_with() + MART_PAYMENT,
    "mart_daily": star_with() + MART_DAILY,
    "mart_hourly_narrow": star_with() + MART_HOURLY_NARROW,
    "mart_locations_narrow": star_with() + MART_LOCATIONS_NARROW,
    "mart_payment_narrow": star_with() + MART_PAYMENT_NARROW,
    "mart_hourly_per_row": star_with("per_row") + MART_HOURLY,
    "mart_locations_per_row": star_with("per_row") + MART_LOCATIONS,
    "mart_payment_per_row": star_with("per_row") + MART_PAYMENT,
    "mart_daily_per_row": star_with("per_row") + MART_DAILY,
    "mart_hourly_null_match": star_with("distinct", "match") + MART_HOURLY,
    "mart_hourly_rollup": star_with() + MART_HOURLY,
    "mart_daily_rollup": star_with() + MART_DAILY,
    "summary_overall": star_with() + SUMMARY.format(fact="fact"),
    "summary_overall_per_row": star_with("per_row") + SUMMARY.format(fact="fact"),
    "summary_zones": ZONE_STAR + SUMMARY.format(fact="zfact"),
    "mart_hourly_zones": ZONE_STAR + _zone_mart(MART_HOURLY),
    "mart_payment_zones": ZONE_STAR + _zone_mart(MART_PAYMENT),
    "mart_daily_zones": ZONE_STAR + _zone_mart(MART_DAILY),
    "summary_rounded": star_with() + """
SELECT total_trips, ROUND(total_revenue, 2) AS total_revenue, ROUND(avg_distance, 2) AS avg_distance,
       ROUND(avg_duration_minutes, 2) AS avg_duration_minutes
FROM (""" + SUMMARY.format(fact="fact") + ") s",
    "payment_distribution": star_with() + PAYMENT_DISTRIBUTION,
    "summary_report_records": star_with() + ", d AS (" + PAYMENT_DISTRIBUTION + """)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY trip_count DESC, payment_name NULLS FIRST) - 1 AS BIGINT) AS pos,
       payment_name, trip_count, percentage
FROM d""",
    "payment_distribution_per_row": star_with("per_row") + PAYMENT_DISTRIBUTION,
    "payment_distribution_null_match": star_with("distinct", "match") + PAYMENT_DISTRIBUTION,
    "check_not_null": ZONE_STAR + "\n" + _not_null("zfact", [(c, False) for c in
        ["trip_id", "datetime_id", "pickup_location_id", "dropoff_location_id", "payment_id", "passenger_id"]]),
    "check_non_negative": ZONE_STAR + "\n" + _non_negative("zfact", ["trip_distance", "trip_duration", "fare_amount"]),
    "check_not_null_trips": "WITH " + TRIPS + "\n" + _not_null("trips", _trip_cols_kinds()),
    "check_unique": star_with() + "\n" + _unique([
        ("fact_trips", "fact", "trip_id"), ("dim_datetime", "dt", "datetime_id"), ("dim_location", "loc", "location_id"),
        ("dim_payment", "pay", "payment_id"), ("dim_passenger", "pas", "passenger_id")]),
    "trips_parquet_months": _zone_trips_union(),
    "trips_nan_codes": _zone_trips_union(),
    "fact_half_seconds": _half_second_star() + "\nSELECT * FROM fact",
    "fact_half_seconds_double": _half_second_star().replace("CAST(round_even(", "(").replace(", 0) AS INTEGER) AS trip_duration", ") AS trip_duration")
    + "\nSELECT * FROM fact",
    "appended_fact": _appended_star() + "\nSELECT * FROM fact",
    "appended_dim_datetime": _appended_star() + "\nSELECT * FROM dt",
    "appended_dim_location": _appended_star() + "\nSELECT * FROM loc",
    "appended_dim_payment": _appended_star() + "\nSELECT * FROM pay",
    "appended_dim_passenger": _appended_star() + "\nSELECT * FROM pas",
    "staged_count": "WITH " + TRIPS + "\nSELECT count(*) AS reported, count(*) AS stored FROM trips",
    "run_zones_fact": ZONE_STAR + "\nSELECT * FROM zfact",
    "published_skipping": star_with() + f"""
SELECT 'vw_hourly_fares' AS mart, 'ok' AS status, (SELECT count(*) FROM ({MART_HOURLY}) m) AS "rows"
UNION ALL SELECT 'vw_popular_locations', 'ok', (SELECT count(*) FROM ({MART_LOCATIONS}) m)
UNION ALL SELECT 'vw_payment_analysis', 'error', 0
UNION ALL SELECT 'vw_daily_stats', 'ok', (SELECT count(*) FROM ({MART_DAILY}) m)
UNION ALL SELECT 'summary_report', 'error', 0""",
    "built_fact": star_with() + "\nSELECT * FROM fact",
    "built_dim_datetime": star_with() + "\nSELECT * FROM dt",
    "built_dim_payment": star_with() + "\nSELECT * FROM pay",
    "published_hourly": _positioned(MART_HOURLY, "pickup_hour"),
    "published_locations": _positioned(MART_LOCATIONS, "num_pickups DESC, pickup_latitude, pickup_longitude"),
    "published_payment": _positioned(MART_PAYMENT, "payment_name"),
    "published_daily": _positioned(MART_DAILY, "pickup_year, pickup_month, pickup_day"),
    "check_orphans_per_row": star_with() + """, ids AS (
  SELECT ROW_NUMBER() OVER () AS datetime_id FROM trips
)
SELECT 'orphans' AS "check", 'datetime_id->dim_datetime' AS "column",
       CAST((SELECT COUNT(*) FROM ids WHERE datetime_id NOT IN (SELECT datetime_id FROM dt)) AS BIGINT) AS failures""",
    "check_orphans_gaps": star_with() + """,
gloc AS (SELECT * FROM loc WHERE location_id % 7 <> 3),
gpay AS (SELECT * FROM pay WHERE payment_name <> 'Cash'),
gpas AS (SELECT * FROM pas WHERE passenger_count < 4)
""" + _orphans().replace("JOIN loc d", "JOIN gloc d").replace("JOIN pay d", "JOIN gpay d").replace("JOIN pas d", "JOIN gpas d"),
    "check_unique_repeated": star_with() + "\n" + _unique([("fact_trips", "fact", "datetime_id")]),
    "check_non_negative_margin": star_with() + ", margins AS (SELECT tip_amount - fare_amount AS margin FROM fact)\n"
    + _non_negative("margins", ["margin"]),
    "check_orphans": star_with() + "\n" + _orphans(),
    "check_orphans_null_match": star_with("distinct", "match") + "\n" + _orphans(),
}


PROFILE_SQL: dict[str, str] = {
    "profile_hourly": _profile(MART_HOURLY, [("pickup_hour", "int"), ("avg_fare", "double"), ("num_trips", "int"),
                                             ("avg_tip", "double"), ("avg_total", "double")]),
    "profile_daily": _profile(MART_DAILY, _PROFILE_DAILY),
    "published_profile_daily": _profile(MART_DAILY, _PROFILE_DAILY),
    "profile_trips": _profile("SELECT * FROM trips0", [
        (c, "text" if c.endswith("datetime") else "int" if c in ("passenger_count", "payment_type") else "double") for c in STAGING])
    .replace("FROM trips0", "FROM (SELECT " + ", ".join(STAGING) + " FROM trips)"),
    "profile_locations": _profile(MART_LOCATIONS, [("pickup_latitude", "double"), ("pickup_longitude", "double"),
                                                   ("num_pickups", "int"), ("avg_fare", "double"),
                                                   ("avg_distance", "double"), ("avg_duration", "double")]),
    "profile_payment": _profile(MART_PAYMENT, [("payment_name", "text"), ("num_trips", "int"), ("avg_fare", "double"),
                                               ("avg_tip", "double"), ("avg_total", "double"), ("avg_distance", "double")]),
}

ORACLE.update(PROFILE_SQL)
ORACLE["run_zones_profiles"] = _zone_profiles()
ORACLE["published_report_records"] = ORACLE["summary_report_records"]
