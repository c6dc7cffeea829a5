"""Independent DuckDB SQL for every registered query.

Written from the reference's SQL (bronze/silver/gold models and the
questions) over the raw test tables, not from Spark output.  Casts mirror
``catalog.normalize``: integral -> BIGINT, decimals -> DOUBLE, dates -> text.  Means use
the same exact fixed-point definition as ``questions.exact_mean``, so they
are equal bit for bit; interpolated percentiles are rounded to 6 places.
"""

from __future__ import annotations

from cabflow.params import FIXTURE_PARAMS as P
from cabflow.schemas import PAYMENT_TYPES, RATECODES, VENDORS

MIN = P.min_date.isoformat()
Y0 = P.year_start.isoformat()
Y1 = P.next_year_start.isoformat()
YE = P.year_end.isoformat()


def _values(rows) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


TRIPS = """
trips AS (
  SELECT CAST(nullif(l_suppkey % 4, 3) AS INT) AS vendor_id,
         o_orderdate + to_minutes(CAST((l_orderkey*17 + l_linenumber*61) % 1440 AS INT)) AS pickup_ts,
         o_orderdate + to_minutes(CAST((l_orderkey*17 + l_linenumber*61) % 1440
                                       + (l_partkey*7 + l_linenumber*13) % 200 - 5 AS INT)) AS dropff_ts,
         nullif(p_size, 13) AS passengers_count,
         CAST(l_quantity - 1 AS DECIMAL(14,2)) AS trip_distance,
         c_nationkey AS pickup_location, s_nationkey AS dropff_location,
         l_linenumber AS ratecode_id,
         nullif(CAST(substr(o_orderpriority, 1, 1) AS INT), 5) AS payment_type,
         CAST(CASE WHEN l_quantity = 1 THEN 0 ELSE l_extendedprice END AS DECIMAL(14,2)) AS fare_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS tip_amount,
         CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS tolls_amount,
         CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -l_extendedprice
                   ELSE l_extendedprice END AS DECIMAL(14,2)) AS total_amount,
         CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS service_type,
         strftime(CASE WHEN l_linenumber = 7 THEN l_shipdate ELSE o_orderdate END, '%Y-%m') AS source_month,
         CAST('2026-01-01 00:00:00' AS TIMESTAMP) AS ingest_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN customer ON c_custkey = o_custkey
),
zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone_name,
         CAST(NULL AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey <> 24
),
bronze AS (
  SELECT *, CAST(date_diff('microsecond', pickup_ts, dropff_ts) AS DOUBLE) / 60000000.0
            AS trip_duration_minutes
  FROM trips
)"""

RULES = [(f"null_{c}", f"{c} IS NOT NULL") for c in (
    "pickup_ts", "dropff_ts", "trip_distance", "pickup_location", "dropff_location",
    "total_amount", "service_type", "source_month", "ingest_ts", "trip_duration_minutes")] + [
    ("pickup_after_dropoff", "pickup_ts <= dropff_ts"),
    ("negative_distance", "trip_distance >= 0"),
    ("negative_total", "total_amount >= 0"),
    ("pickup_before_min_date", f"pickup_ts >= TIMESTAMP '{MIN}'"),
    ("dropoff_before_min_date", f"dropff_ts >= TIMESTAMP '{MIN}'"),
    ("wrong_source_month", "date_trunc('month', pickup_ts) = try_strptime(source_month, '%Y-%m')"),
    ("unknown_pickup_zone", "_pk"),
    ("unknown_dropoff_zone", "_dk"),
]
# the rules on a row's own columns, as silver's filter
CLEAN = "\n    AND ".join(c for _, c in RULES[:-2])

SILVER = f"""{TRIPS},
clean_trips AS (
  SELECT coalesce(vendor_id, 0) AS vendor_id, pickup_ts, dropff_ts,
         CASE WHEN passengers_count IS NULL THEN 0 WHEN passengers_count < 0 THEN 0
              WHEN passengers_count > 10 THEN 10 ELSE passengers_count END AS passengers_count,
         trip_distance, pickup_location, dropff_location, ratecode_id,
         coalesce(payment_type, 0) AS payment_type,
         fare_amount, tip_amount, tolls_amount, total_amount,
         service_type, source_month, ingest_ts, trip_duration_minutes
  FROM bronze
  WHERE {CLEAN}
),
silver AS (
  SELECT ct.*, zp.zone_name AS pickup_location_name, zd.zone_name AS dropoff_location_name,
         zp.borough AS pickup_borough, zd.borough AS dropoff_borough
  FROM clean_trips ct
  JOIN zones zp ON ct.pickup_location = zp.location_id
  JOIN zones zd ON ct.dropff_location = zd.location_id
)"""

GOLD = f"""{SILVER},
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INT) AS date_key, full_date,
         year(full_date) AS year, month(full_date) AS month, day(full_date) AS day,
         dayofweek(full_date) AS day_of_week, weekofyear(full_date) AS week_of_year,
         quarter(full_date) AS quarter
  FROM (SELECT CAST(pickup_ts AS DATE) AS full_date FROM silver
        UNION SELECT CAST(dropff_ts AS DATE) FROM silver)
),
dim_time AS (
  SELECT hour * 100 + minute AS time_key, hour, minute,
         CASE WHEN hour BETWEEN 5 AND 11 THEN 'morning'
              WHEN hour BETWEEN 12 AND 16 THEN 'afternoon'
              WHEN hour BETWEEN 17 AND 21 THEN 'evening'
              ELSE 'night' END AS time_period
  FROM (SELECT hour(pickup_ts) AS hour, minute(pickup_ts) AS minute FROM silver
        UNION SELECT hour(dropff_ts), minute(dropff_ts) FROM silver)
),
dim_zone AS (
  SELECT pickup_location AS zone_key, pickup_location_name AS zone_name, pickup_borough AS borough FROM silver
  UNION
  SELECT dropff_location, dropoff_location_name, dropoff_borough FROM silver
),
dim_service_type AS (SELECT DISTINCT service_type AS service_type_key, service_type FROM silver),
dim_payment_type AS (
  SELECT * FROM (VALUES {_values(PAYMENT_TYPES)}) AS t(payment_type_key, payment_type, payment_category)),
dim_vendor AS (SELECT * FROM (VALUES {_values(VENDORS)}) AS t(vendor_key, vendor_name)),
dim_ratecode AS (SELECT * FROM (VALUES {_values(RATECODES)}) AS t(ratecode_key, ratecode_name)),
fct_trips AS (
  SELECT CAST(date_trunc('day', t.pickup_ts) AS DATE) AS pickup_date,
         dp.date_key AS pickup_date_key, dd.date_key AS dropoff_date_key,
         pt.time_key AS pickup_time_key, dt.time_key AS dropoff_time_key,
         p.zone_key AS pickup_location_key, d.zone_key AS dropoff_location_key,
         pay.payment_type_key, v.vendor_key, r.ratecode_key, serty.service_type_key,
         t.passengers_count, t.trip_distance, t.fare_amount, t.tip_amount, t.tolls_amount,
         t.total_amount, CAST(round(t.trip_duration_minutes) AS INT) AS trip_duration_minutes
  FROM (SELECT * FROM silver WHERE dropff_ts IS NOT NULL) t
  LEFT JOIN dim_date dp ON CAST(date_trunc('day', t.pickup_ts) AS DATE) = dp.full_date
  LEFT JOIN dim_date dd ON CAST(date_trunc('day', t.dropff_ts) AS DATE) = dd.full_date
  LEFT JOIN dim_time pt ON hour(t.pickup_ts) = pt.hour AND minute(t.pickup_ts) = pt.minute
  LEFT JOIN dim_time dt ON hour(t.dropff_ts) = dt.hour AND minute(t.dropff_ts) = dt.minute
  LEFT JOIN dim_zone p ON t.pickup_location = p.zone_key
  LEFT JOIN dim_zone d ON t.dropff_location = d.zone_key
  LEFT JOIN dim_payment_type pay ON t.payment_type = pay.payment_type_key
  LEFT JOIN dim_vendor v ON t.vendor_id = v.vendor_key
  LEFT JOIN dim_ratecode r ON t.ratecode_id = r.ratecode_key
  LEFT JOIN dim_service_type serty ON t.service_type = serty.service_type_key
)"""

def _mean(x: str, scale: str = "1.0") -> str:
    """Exact mean of an integral expression, divided once in double."""
    return (f"CAST(SUM(CAST({x} AS DECIMAL(38,0))) AS DOUBLE) / CAST(NULLIF(COUNT({x}), 0) AS DOUBLE)"
            f" / CAST({scale} AS DOUBLE)")


TIP_E9 = ("(CAST(f.tip_amount * 100 AS HUGEINT) * 1000000000) "
          "// NULLIF(CAST(f.fare_amount * 100 AS HUGEINT), 0)")
TIP = _mean(TIP_E9, "1e7")
YEAR_F = f"f.pickup_date >= DATE '{Y0}' AND f.pickup_date < DATE '{Y1}'"
SINCE_F = f"f.pickup_date >= DATE '{MIN}'"


def _w(body: str, cte: str = GOLD) -> str:
    return f"WITH {cte.strip()}\n{body}"


def _round6(x: str) -> str:
    return f"ROUND(CAST({x} AS DOUBLE), 6)"


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


QUESTIONS_SQL = {
    "q01": f"""SELECT CAST(d.month AS BIGINT) AS month, COUNT(*) AS total_trips
FROM fct_trips f JOIN dim_date d ON f.pickup_date_key = d.date_key
WHERE f.pickup_date >= DATE '{Y0}' AND f.pickup_date <= DATE '{YE}'
GROUP BY d.month ORDER BY d.month""",
    "q02": """SELECT s.service_type, CAST(d.month AS BIGINT) AS month, COUNT(*) AS total_trips
FROM fct_trips f JOIN dim_service_type s ON f.service_type_key = s.service_type_key
JOIN dim_date d ON f.pickup_date_key = d.date_key
GROUP BY s.service_type, d.month ORDER BY d.month""",
    "q03": f"""SELECT z.zone_name, COUNT(*) AS total_trips
FROM fct_trips f JOIN dim_zone z ON f.pickup_location_key = z.zone_key
WHERE {YEAR_F} GROUP BY 1 ORDER BY total_trips DESC, zone_name LIMIT {P.top_k}""",
    "q04": f"""SELECT z.zone_name, COUNT(*) AS total_trips
FROM fct_trips f JOIN dim_zone z ON f.dropoff_location_key = z.zone_key
WHERE {YEAR_F} GROUP BY 1 ORDER BY total_trips DESC, zone_name LIMIT {P.top_k}""",
    "q05": f"""SELECT borough, CAST(month AS BIGINT) AS month, total_trips, CAST(rnk AS BIGINT) AS rnk FROM (
  SELECT z.borough, EXTRACT(MONTH FROM f.pickup_date) AS month, COUNT(*) AS total_trips,
         RANK() OVER (PARTITION BY EXTRACT(MONTH FROM f.pickup_date) ORDER BY COUNT(*) DESC) AS rnk
  FROM fct_trips f JOIN dim_zone z ON f.pickup_location_key = z.zone_key
  WHERE {YEAR_F} GROUP BY 1, 2) t WHERE rnk <= {P.top_per_group}""",
    "q06": f"""SELECT CAST(day_of_week AS BIGINT) AS day_of_week, CAST(hour AS BIGINT) AS hour, total_trips,
       CAST(rnk AS BIGINT) AS rnk FROM (
  SELECT d.day_of_week, t.hour, COUNT(*) AS total_trips,
         RANK() OVER (PARTITION BY d.day_of_week ORDER BY COUNT(*) DESC) AS rnk
  FROM fct_trips f JOIN dim_date d ON f.pickup_date_key = d.date_key
  JOIN dim_time t ON f.pickup_time_key = t.time_key
  GROUP BY d.day_of_week, t.hour) hr WHERE rnk <= {P.top_per_group}""",
    "q07": """SELECT CAST(d.day_of_week AS BIGINT) AS day_of_week, COUNT(*) AS total_trips
FROM fct_trips f JOIN dim_date d ON f.pickup_date_key = d.date_key
GROUP BY d.day_of_week ORDER BY total_trips DESC""",
    "q08": f"""SELECT CAST(d.month AS BIGINT) AS month, {_dbl('SUM(f.total_amount)')} AS total_revenue
FROM fct_trips f JOIN dim_date d ON f.pickup_date_key = d.date_key
GROUP BY d.month ORDER BY d.month""",
    "q09": f"""SELECT f.service_type_key, CAST(EXTRACT(MONTH FROM f.pickup_date) AS BIGINT) AS month,
       {_dbl('SUM(f.total_amount)')} AS total_revenue
FROM fct_trips f WHERE {YEAR_F} GROUP BY 1, 2 ORDER BY 2""",
    "q10": f"""SELECT CAST(EXTRACT(MONTH FROM f.pickup_date) AS BIGINT) AS month, {_dbl(TIP)} AS avg_tip_pct
FROM fct_trips f WHERE {YEAR_F} GROUP BY 1 ORDER BY 1""",
    "q11": f"""SELECT z.borough, CAST(EXTRACT(MONTH FROM f.pickup_date) AS BIGINT) AS month, {_dbl(TIP)} AS avg_tip_pct
FROM fct_trips f JOIN dim_zone z ON f.pickup_location_key = z.zone_key
WHERE {YEAR_F} GROUP BY 1, 2 ORDER BY 2""",
    "q12": f"""SELECT z.zone_name, {_dbl('SUM(f.total_amount)')} AS total_revenue
FROM fct_trips f JOIN dim_zone z ON f.pickup_location_key = z.zone_key
WHERE {SINCE_F} GROUP BY 1 ORDER BY SUM(f.total_amount) DESC, zone_name LIMIT {P.top_k}""",
    "q13": f"""SELECT zone_name, {_dbl('pct')} AS avg_tip_pct FROM (
  SELECT z.zone_name, {TIP} AS pct
  FROM fct_trips f JOIN dim_zone z ON f.pickup_location_key = z.zone_key
  WHERE {SINCE_F} GROUP BY 1 HAVING COUNT(*) >= {P.min_trips}
  ORDER BY pct DESC, zone_name LIMIT {P.top_k})""",
    "q14": f"""SELECT CAST(f.payment_type_key AS BIGINT) AS payment_type_key, COUNT(*) AS total_trips,
       {_dbl('SUM(f.total_amount)')} AS total_revenue, {_dbl(TIP)} AS avg_tip_pct
FROM fct_trips f WHERE {SINCE_F} GROUP BY 1""",
    "q15": f"""SELECT CAST(EXTRACT(MONTH FROM f.pickup_date) AS BIGINT) AS month,
       {_mean('f.trip_duration_minutes')} AS avg_duration
FROM fct_trips f WHERE {YEAR_F} GROUP BY 1 ORDER BY 1""",
    "q16": f"""SELECT CAST(EXTRACT(MONTH FROM f.pickup_date) AS BIGINT) AS month,
       {_mean('CAST(f.trip_distance * 100 AS BIGINT)', '100')} AS avg_distance
FROM fct_trips f WHERE {YEAR_F} GROUP BY 1 ORDER BY 1""",
    "q17": f"""SELECT z.borough, CAST(f.pickup_time_key // 100 AS BIGINT) AS hour_slot,
       {_mean('(CAST(f.trip_distance * 100 AS HUGEINT) * 600000000) // NULLIF(f.trip_duration_minutes, 0)', '1e9')} AS avg_speed_mph
FROM fct_trips f JOIN dim_zone z ON f.pickup_location_key = z.zone_key
WHERE {SINCE_F} GROUP BY 1, 2""",
    "q17_ref": f"""SELECT z.borough, CAST(f.pickup_time_key // 60 AS BIGINT) AS hour_slot,
       {_mean('(CAST(f.trip_distance * 100 AS HUGEINT) * 10000000) // NULLIF(f.trip_duration_minutes // 60, 0)', '1e9')} AS avg_speed_mph
FROM fct_trips f JOIN dim_zone z ON f.pickup_location_key = z.zone_key
WHERE {SINCE_F} GROUP BY 1, 2""",
    "q18": f"""SELECT z.borough,
       {_round6('quantile_cont(f.trip_duration_minutes, 0.5)')} AS p50,
       {_round6('quantile_cont(f.trip_duration_minutes, 0.9)')} AS p90
FROM fct_trips f JOIN dim_zone z ON f.pickup_location_key = z.zone_key
WHERE {SINCE_F} GROUP BY 1""",
    "q19": f"""SELECT zone_name, {_round6('p90')} AS p90 FROM (
  SELECT z.zone_name, quantile_cont(f.trip_duration_minutes, 0.9) AS p90
  FROM fct_trips f JOIN dim_zone z ON f.pickup_location_key = z.zone_key
  WHERE {SINCE_F} GROUP BY 1 ORDER BY ROUND(p90, 6) DESC, zone_name LIMIT {P.top_k})""",
    "q20": f"""SELECT zp.borough AS p_bor, zd.borough AS d_bor, COUNT(*) AS total
FROM fct_trips f JOIN dim_zone zp ON f.pickup_location_key = zp.zone_key
JOIN dim_zone zd ON f.dropoff_location_key = zd.zone_key
WHERE {SINCE_F} GROUP BY 1, 2 ORDER BY total DESC, p_bor, d_bor LIMIT {P.top_k}""",
    "pruned_count": f"""SELECT COUNT(*) AS total_trips FROM fct_trips f
WHERE f.pickup_date >= DATE '{P.year}-01-01' AND f.pickup_date <= DATE '{P.year}-01-31'""",
}

# ------------------------------------------------------------ layer tables
I, M, D, X = "int", "money", "double", "keep"
BRONZE_T = [("vendor_id", I), ("pickup_ts", X), ("dropff_ts", X), ("passengers_count", I),
            ("trip_distance", M), ("pickup_location", I), ("dropff_location", I), ("ratecode_id", I),
            ("payment_type", I), ("fare_amount", M), ("tip_amount", M), ("tolls_amount", M),
            ("total_amount", M), ("service_type", X), ("source_month", X), ("ingest_ts", X),
            ("trip_duration_minutes", D)]
SILVER_T = BRONZE_T + [("pickup_location_name", X), ("dropoff_location_name", X),
                       ("pickup_borough", X), ("dropoff_borough", X)]
DT = "date"
FACT_T = ([("pickup_date", DT)] + [(k, I) for k in (
    "pickup_date_key", "dropoff_date_key", "pickup_time_key", "dropoff_time_key",
    "pickup_location_key", "dropoff_location_key", "payment_type_key", "vendor_key",
    "ratecode_key")] + [("service_type_key", X), ("passengers_count", I)]
    + [(m, M) for m in ("trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount")]
    + [("trip_duration_minutes", I), ("pickup_month", DT)])
RAW_T = [("vendorid", I), ("tpep_pickup_datetime", X), ("tpep_dropoff_datetime", X),
         ("passenger_count", D), ("trip_distance", D), ("ratecodeid", D), ("pulocationid", I),
         ("dolocationid", I), ("payment_type", D), ("fare_amount", D), ("tip_amount", D),
         ("tolls_amount", D), ("total_amount", D), ("service_type", X), ("source_month", X)]


def _norm(cols, src: str = "") -> str:
    out = []
    for name, kind in cols:
        ref = f"{src}{name}"
        if kind == I:
            out.append(f"CAST({ref} AS BIGINT) AS {name}")
        elif kind == M:
            out.append(f"{_dbl(ref)} AS {name}")
        elif kind == D:
            out.append(f"{_dbl(ref)} AS {name}")
        elif kind == "date":
            out.append(f"strftime({ref}, '%Y-%m-%d') AS {name}")
        else:
            out.append(f"{ref} AS {name}")
    return ", ".join(out)


RAW = """raw AS (
  SELECT vendor_id AS vendorid, pickup_ts AS tpep_pickup_datetime, dropff_ts AS tpep_dropoff_datetime,
         CAST(passengers_count AS DOUBLE) AS passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance,
         CAST(ratecode_id AS DOUBLE) AS ratecodeid, pickup_location AS pulocationid,
         dropff_location AS dolocationid, CAST(payment_type AS DOUBLE) AS payment_type,
         CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(tip_amount AS DOUBLE) AS tip_amount,
         CAST(tolls_amount AS DOUBLE) AS tolls_amount, CAST(total_amount AS DOUBLE) AS total_amount,
         service_type, source_month, ingest_ts
  FROM trips)"""

FLAGGED = """flagged AS (
  SELECT b.*, zp.location_id IS NOT NULL AS _pk, zd.location_id IS NOT NULL AS _dk
  FROM bronze b
  LEFT JOIN (SELECT DISTINCT location_id FROM zones) zp ON b.pickup_location = zp.location_id
  LEFT JOIN (SELECT DISTINCT location_id FROM zones) zd ON b.dropff_location = zd.location_id)"""


def _unpivot_counts(counts: list[tuple[str, str]], src: str, name: str, value: str) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS {name}, CAST(count_if({c}) AS BIGINT) AS {value} FROM {src}"
                              for k, c in counts)


def _first_reason() -> str:
    whens = " ".join(f"WHEN NOT coalesce({c}, false) THEN '{k}'" for k, c in RULES)
    return f"CASE {whens} ELSE 'kept' END"


def _grid(src: str) -> str:
    return f"""grid AS (
  SELECT svc.service_type, CAST(year(m) AS BIGINT) AS year, strftime(m, '%m') AS month,
         strftime(m, '%Y-%m') AS source_month
  FROM (SELECT unnest(generate_series(min(strptime(source_month, '%Y-%m')),
                                      max(strptime(source_month, '%Y-%m')), INTERVAL 1 MONTH)) AS m
        FROM {src}) months,
       (VALUES {", ".join(f"('{s}')" for s in P.services)}) svc(service_type))"""


SILVER_NOT_NULL = ["pickup_ts", "dropff_ts", "pickup_location", "dropff_location", "passengers_count",
                   "trip_distance", "total_amount", "service_type", "source_month", "vendor_id",
                   "payment_type"]
GOLD_NOT_NULL = ["pickup_date_key", "dropoff_date_key", "trip_distance", "total_amount", "passengers_count"]
REL = [
    ("silver_pickup_location", "silver", "pickup_location", "zones", "location_id"),
    ("silver_dropff_location", "silver", "dropff_location", "zones", "location_id"),
    ("fct_pickup_date_key", "fct_trips", "pickup_date_key", "dim_date", "date_key"),
    ("fct_dropoff_date_key", "fct_trips", "dropoff_date_key", "dim_date", "date_key"),
    ("fct_pickup_time_key", "fct_trips", "pickup_time_key", "dim_time", "time_key"),
    ("fct_dropoff_time_key", "fct_trips", "dropoff_time_key", "dim_time", "time_key"),
    ("fct_pickup_location_key", "fct_trips", "pickup_location_key", "dim_zone", "zone_key"),
    ("fct_dropoff_location_key", "fct_trips", "dropoff_location_key", "dim_zone", "zone_key"),
    ("fct_payment_type_key", "fct_trips", "payment_type_key", "dim_payment_type", "payment_type_key"),
    ("fct_vendor_key", "fct_trips", "vendor_key", "dim_vendor", "vendor_key"),
    ("fct_ratecode_key", "fct_trips", "ratecode_key", "dim_ratecode", "ratecode_key"),
    ("fct_service_type_key", "fct_trips", "service_type_key", "dim_service_type", "service_type_key"),
]


def _median_sql(col: str) -> str:
    return (f"(SELECT x FROM (SELECT {col} AS x, row_number() OVER (ORDER BY {col}) - 1 AS i, "
            f"count(*) OVER () AS n FROM pf WHERE {col} IS NOT NULL) WHERE i = n // 2)")


PASSENGERS = """pf AS (
  SELECT CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS Age,
         CASE WHEN l_partkey % 5 <> 0 THEN l_extendedprice END AS Fare,
         CASE WHEN l_suppkey % 3 <> 0 THEN l_linenumber END AS Parch,
         l_linenumber % 3 + 1 AS Pclass,
         CASE WHEN l_orderkey % 11 <> 0 THEN CAST(round(l_discount * 100) AS INT) END AS SibSp,
         CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_orderkey % 2 AS INT) END AS Survived
  FROM lineitem)"""
IMPUTE_T = [("Age", D), ("Fare", D), ("Parch", I), ("Pclass", I), ("SibSp", I), ("Survived", I)]


def _q(name: str) -> str:
    return f"({QUESTIONS_SQL[name]})"


# The test tables' regions: the boroughs, columns of a pivot by borough.
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

LAYER_SQL = {
    "scan_trips": _w(f"""SELECT {_norm(RAW_T)}, ingest_ts,
       CASE WHEN service_type = 'yellow' AND source_month = '1996-06' THEN CAST(1.75 AS DOUBLE) END AS airport_fee
FROM raw""", f"{TRIPS},\n{RAW}"),
    "scan_zones": _w("SELECT CAST(location_id AS BIGINT) AS location_id, borough, zone_name, service_zone FROM zones "
                     "UNION ALL SELECT CAST(n_nationkey + 240 AS BIGINT), NULL, NULL, NULL FROM nation "
                     "WHERE n_nationkey = 24", TRIPS),
    "narrow_types": _w("SELECT " + ", ".join(
        f"{_dbl(f'CAST({n} AS FLOAT)')} AS {n}" if k == D else
        (f"CAST({n} AS BIGINT) AS {n}" if k == I else n) for n, k in RAW_T) + " FROM raw",
        f"{TRIPS},\n{RAW}"),
    "bronze_trips": _w(f"SELECT {_norm(BRONZE_T)} FROM bronze", TRIPS),
    "silver_trips": _w(f"SELECT {_norm(SILVER_T)} FROM silver", SILVER),
    "reject_reasons": _w(_unpivot_counts([(k, f"NOT coalesce({c}, false)") for k, c in RULES],
                                         "flagged", "rule", "rejected"), f"{TRIPS},\n{FLAGGED}"),
    "reject_first_reason": _w(f"SELECT {_first_reason()} AS first_reason, COUNT(*) AS trips "
                              "FROM flagged GROUP BY 1", f"{TRIPS},\n{FLAGGED}"),
    "dim_date": _w("SELECT CAST(date_key AS BIGINT) AS date_key, strftime(full_date, '%Y-%m-%d') AS full_date, "
                   "CAST(year AS BIGINT) AS year, "
                   "CAST(month AS BIGINT) AS month, CAST(day AS BIGINT) AS day, "
                   "CAST(day_of_week AS BIGINT) AS day_of_week, CAST(week_of_year AS BIGINT) AS week_of_year, "
                   "CAST(quarter AS BIGINT) AS quarter FROM dim_date"),
    "dim_time": _w("SELECT CAST(time_key AS BIGINT) AS time_key, CAST(hour AS BIGINT) AS hour, "
                   "CAST(minute AS BIGINT) AS minute, time_period FROM dim_time"),
    "dim_zone": _w("SELECT CAST(zone_key AS BIGINT) AS zone_key, zone_name, borough FROM dim_zone"),
    "dim_service_type": _w("SELECT service_type_key, service_type FROM dim_service_type"),
    "dim_payment_type": _w("SELECT CAST(d.payment_type_key AS BIGINT) AS payment_type_key, d.payment_type, "
                           "d.payment_category, coalesce(u.trips, 0) AS trips FROM dim_payment_type d LEFT JOIN "
                           "(SELECT payment_type_key, COUNT(*) AS trips FROM fct_trips GROUP BY 1) u "
                           "USING (payment_type_key)"),
    "dim_vendor": _w("SELECT CAST(d.vendor_key AS BIGINT) AS vendor_key, d.vendor_name, coalesce(u.trips, 0) AS trips "
                     "FROM dim_vendor d LEFT JOIN (SELECT vendor_key, COUNT(*) AS trips FROM fct_trips GROUP BY 1) u "
                     "USING (vendor_key)"),
    "dim_ratecode": _w("SELECT CAST(d.ratecode_key AS BIGINT) AS ratecode_key, d.ratecode_name, "
                       "coalesce(u.trips, 0) AS trips FROM dim_ratecode d LEFT JOIN "
                       "(SELECT ratecode_key, COUNT(*) AS trips FROM fct_trips GROUP BY 1) u USING (ratecode_key)"),
    "fct_trips": _w(f"SELECT {_norm(FACT_T)} FROM (SELECT *, CAST(date_trunc('month', pickup_date) AS DATE) "
                    "AS pickup_month FROM fct_trips)"),
    "unmatched_keys": _w(" UNION ALL ".join(
        f"SELECT '{k}' AS key_column, CAST(count_if({k} IS NULL) AS BIGINT) AS unmatched FROM fct_trips"
        for k, _ in FACT_T[1:11])),
    "fact_rowcount_invariant": _w("SELECT 'silver' AS layer, COUNT(*) AS row_count FROM silver "
                                  "UNION ALL SELECT 'fact', COUNT(*) FROM fct_trips"),
    "slice_grid": _w("SELECT service_type, year, month, source_month FROM grid", f"{TRIPS},\n{_grid('bronze')}"),
    "month_partitions": _w("""SELECT 'fct_trips_' || strftime(m, '%Y_%m') AS partition_name,
       strftime(CAST(m AS DATE), '%Y-%m-%d') AS range_start,
       strftime(CAST(m + INTERVAL 1 MONTH AS DATE), '%Y-%m-%d') AS range_end
FROM (SELECT unnest(generate_series(date_trunc('month', min(pickup_date)), date_trunc('month', max(pickup_date)),
                                    INTERVAL 1 MONTH)) AS m FROM fct_trips)"""),
    "coverage": _w(f"""SELECT service_type, source_month,
       coalesce(bronze_rows, 0) AS bronze_rows, coalesce(silver_rows, 0) AS silver_rows,
       coalesce(bronze_rows, 0) - coalesce(silver_rows, 0) AS rejected,
       CASE WHEN coalesce(bronze_rows, 0) > 0 THEN CAST(bronze_rows - coalesce(silver_rows, 0) AS DOUBLE)
            * CAST(100.0 AS DOUBLE) / CAST(bronze_rows AS DOUBLE) END AS reject_pct,
       CASE WHEN coalesce(bronze_rows, 0) = 0 THEN 'missing' ELSE 'ok' END AS status
FROM (SELECT service_type, source_month FROM grid) g
FULL JOIN (SELECT service_type, source_month, COUNT(*) AS bronze_rows FROM bronze GROUP BY 1, 2) b
  USING (service_type, source_month)
LEFT JOIN (SELECT service_type, source_month, COUNT(*) AS silver_rows FROM silver GROUP BY 1, 2) s
  USING (service_type, source_month)""", f"{SILVER},\n{_grid('bronze')}"),
    "replace_slice_rerun": _w("SELECT service_type, source_month, COUNT(*) AS trips FROM bronze GROUP BY 1, 2",
                              TRIPS),
    "list_partition_counts": _w("""SELECT 'dim_service_type' AS table_name, service_type AS partition_value,
       COUNT(*) AS row_count FROM dim_service_type GROUP BY 2
UNION ALL SELECT 'dim_payment_type', d.payment_category, COUNT(f.pickup_date)
FROM dim_payment_type d LEFT JOIN fct_trips f USING (payment_type_key) GROUP BY 2"""),
    "replace_slice_empty": _w("SELECT service_type, COUNT(*) AS trips FROM bronze GROUP BY 1", TRIPS),
    "materialize_kinds": _w("SELECT kind, service_type, source_month, COUNT(*) AS trips FROM bronze, "
                            "(VALUES ('table'), ('view'), ('incremental')) k(kind) GROUP BY 1, 2, 3", TRIPS),
    "csv_round_trip": _w("SELECT CAST(Age AS DOUBLE) AS Age, CAST(Parch AS BIGINT) AS Parch, "
                         "CAST(Survived AS BIGINT) AS Survived FROM pf", PASSENGERS),
    "fact_rebuild": _w("SELECT 'silver' AS layer, COUNT(*) AS row_count FROM silver "
                       "UNION ALL SELECT 'fact', COUNT(*) FROM fct_trips").replace(MIN, "1998-01-01"),
    "partition_domain_violations": _w(f"""SELECT CAST(count_if(pickup_date IS NULL) AS BIGINT) AS null_rows,
       CAST(count_if(pickup_date < DATE '{MIN}') AS BIGINT) AS below_range,
       CAST(count_if(pickup_date >= DATE '{Y1}') AS BIGINT) AS above_range FROM fct_trips"""),
    "dq_not_null_silver": _w(_unpivot_counts([(f"not_null_{c}", f"{c} IS NULL") for c in SILVER_NOT_NULL],
                                             "silver", "test", "failures"), SILVER),
    "dq_not_null_gold": _w(_unpivot_counts([(f"not_null_{c}", f"{c} IS NULL") for c in GOLD_NOT_NULL],
                                           "fct_trips", "test", "failures")),
    "dq_accepted_values": _w(_unpivot_counts([
        ("accepted_values_passengers_count",
         "passengers_count IS NOT NULL AND passengers_count NOT IN (0,1,2,3,4,5,6,7,8,9,10)"),
        ("accepted_values_service_type", "service_type IS NOT NULL AND service_type NOT IN ('yellow','green')"),
    ], "silver", "test", "failures"), SILVER),
    "dq_expressions": _w(
        _unpivot_counts([(f"expression_silver_{k}", f"NOT coalesce({e}, false)") for k, e in (
            ("pickup_le_dropoff", "pickup_ts <= dropff_ts"), ("distance_ge_0", "trip_distance >= 0"),
            ("total_ge_0", "total_amount >= 0"))], "silver", "test", "failures")
        + " UNION ALL " +
        _unpivot_counts([(f"expression_gold_{k}", f"NOT coalesce({e}, false)") for k, e in (
            ("distance_ge_0", "trip_distance >= 0"), ("total_ge_0", "total_amount >= 0"),
            ("passengers_ge_0", "passengers_count >= 0"))], "fct_trips", "test", "failures")),
    "dq_relationships": _w(" UNION ALL ".join(
        f"SELECT '{n}' AS test, CAST(COUNT(*) AS BIGINT) AS failures FROM {c} "
        f"WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {pk} FROM {pt} WHERE {pk} IS NOT NULL)"
        for n, c, k, pt, pk in REL)),
    "impute_median": _w("SELECT " + ", ".join(
        (f"{_dbl(f'coalesce(pf.{c}, med.{c})')} AS {c}" if k == D else
         f"CAST(coalesce(pf.{c}, med.{c}) AS BIGINT) AS {c}") for c, k in IMPUTE_T)
        + " FROM pf, (SELECT " + ", ".join(f"{_median_sql(c)} AS {c}" for c, _ in IMPUTE_T) + ") med",
        PASSENGERS),
    "pivot_month_borough": _w("SELECT month, " + ", ".join(
        f"max(total_trips) FILTER (borough = '{b}') AS \"{b}\"" for b in REGIONS) + f" FROM {_q('q05')} GROUP BY month"),
    "pivot_dow_hour": _w("SELECT * FROM (PIVOT " + _q("q06") + " ON hour IN ("
                         + ", ".join(str(h) for h in range(24)) + ") USING first(total_trips) GROUP BY day_of_week)"),
    "pivot_borough_hour": _w("SELECT * FROM (PIVOT " + _q("q17") + " ON hour_slot IN ("
                             + ", ".join(str(h) for h in range(24)) + ") USING first(avg_speed_mph) GROUP BY borough)"),
    "unpivot_payment": _w(f"""SELECT payment_type_key, 'total_trips' AS measure, {_dbl('total_trips')} AS value FROM q14
UNION ALL SELECT payment_type_key, 'total_revenue', {_dbl('total_revenue')} FROM q14
UNION ALL SELECT payment_type_key, 'avg_tip_pct', {_dbl('avg_tip_pct')} FROM q14""",
                          GOLD + f""",
q14 AS (SELECT CAST(f.payment_type_key AS BIGINT) AS payment_type_key, COUNT(*) AS total_trips,
               SUM(f.total_amount) AS total_revenue, {TIP} AS avg_tip_pct
        FROM fct_trips f WHERE {SINCE_F} GROUP BY 1)"""),
    "route_edges": _w("""SELECT CAST(s.node_id AS BIGINT) AS source, CAST(d.node_id AS BIGINT) AS target,
       r.total AS value, r.p_bor AS source_label, r.d_bor AS target_label
FROM routes r JOIN nodes s ON r.p_bor = s.label JOIN nodes d ON r.d_bor = d.label""",
                      GOLD + f""",
routes AS {_q('q20')},
nodes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS node_id
          FROM (SELECT p_bor AS label FROM routes UNION SELECT d_bor FROM routes))"""),
    "stream_ingest": _w(f"SELECT service_type, source_month, COUNT(*) AS trips, {_dbl('SUM(total_amount)')} "
                        "AS total_amount FROM bronze GROUP BY 1, 2", TRIPS),
}


def _murmur3_int(src: str, key: str, seed: int = 42) -> str:
    """CTE steps computing Spark's ``hash(int)`` (Murmur3 x86_32, seed 42) in
    32-bit unsigned arithmetic; the last step ``_h12`` carries column ``x``."""
    m = "CAST(4294967295 AS UBIGINT)"

    def u(v):
        return f"CAST({v} AS UBIGINT)"
    steps = [
        f"CAST(CAST({key} AS BIGINT) & 4294967295 AS UBIGINT)",
        f"(x * {u(0xCC9E2D51)}) & {m}",
        f"((x << 15) | (x >> 17)) & {m}",
        f"(x * {u(0x1B873593)}) & {m}",
        f"xor(x, {u(seed)})",
        f"((x << 13) | (x >> 19)) & {m}",
        f"(x * {u(5)} + {u(0xE6546B64)}) & {m}",
        f"xor(x, {u(4)})",
        "xor(x, x >> 16)",
        f"(x * {u(0x85EBCA6B)}) & {m}",
        "xor(x, x >> 13)",
        f"(x * {u(0xC2B2AE35)}) & {m}",
        "xor(x, x >> 16)",
    ]
    out, prev = [], src
    for i, e in enumerate(steps):
        keep = "*" if i == 0 else "* EXCLUDE (x)"
        out.append(f"_h{i} AS (SELECT {keep}, {e} AS x FROM {prev})")
        prev = f"_h{i}"
    return ",\n".join(out)


LAYER_SQL["hash_bucket"] = _w(
    "SELECT CAST(zone_key AS BIGINT) AS zone_key, zone_name, borough, "
    "CAST((((CASE WHEN x >= 2147483648 THEN CAST(x AS BIGINT) - 4294967296 ELSE CAST(x AS BIGINT) END) % 4)"
    " + 4) % 4 AS BIGINT) AS bucket FROM _h12",
    GOLD + ",\n" + _murmur3_int("dim_zone", "zone_key"))


def _types(layer: str, cols, src: str) -> str:
    """Native types of a layer's columns and their counts; codes and ids are
    cast as the models state it."""
    expr = [f"CAST({c} AS INTEGER)" if k == I else (f"CAST({c} AS FLOAT)" if k == "float" else c) for c, k in cols]
    return (f"SELECT '{layer}' AS layer, unnest([{', '.join(repr(c) for c, _ in cols)}]) AS column_name, "
            f"unnest([{', '.join(f'any_value(typeof({e}))' for e in expr)}]) AS type, "
            f"unnest([{', '.join(f'CAST(count({e}) AS BIGINT)' for e in expr)}]) AS present FROM {src}")


LAYER_SQL["fact_increment"] = LAYER_SQL["gold_by_name"] = LAYER_SQL["fct_trips"]
LAYER_SQL["landing_manifest"] = LAYER_SQL["replace_slice_rerun"]
LAYER_SQL["zone_bucket_join"] = _w(
    "SELECT CAST(z.zone_key AS BIGINT) AS zone_key, z.zone_name, z.borough, coalesce(u.trips, 0) AS trips FROM dim_zone z "
    "LEFT JOIN (SELECT pickup_location_key AS zone_key, COUNT(*) AS trips FROM fct_trips GROUP BY 1) u USING (zone_key)")
LAYER_SQL["layer_types"] = _w(" UNION ALL ".join([
    _types("narrowed", [(c, "float" if k == D else k) for c, k in RAW_T], "raw"),
    _types("bronze", BRONZE_T, "bronze"),
    _types("silver", SILVER_T, "silver"),
    _types("fct_trips", FACT_T, "(SELECT *, CAST(date_trunc('month', pickup_date) AS DATE) AS pickup_month FROM fct_trips)"),
    _types("dim_date", [("date_key", I), ("full_date", X)] + [(c, I) for c in (
        "year", "month", "day", "day_of_week", "week_of_year", "quarter")], "dim_date"),
]), f"{GOLD},\n{RAW}")


def oracle_queries() -> dict[str, str]:
    out = {k: _w(v) for k, v in QUESTIONS_SQL.items()}
    out.update(LAYER_SQL)
    return out
