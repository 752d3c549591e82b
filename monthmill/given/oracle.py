"""The same questions as SQL on the given tables, each over whole tables."""

from __future__ import annotations

from monthmill.given.loads import LOADS_ORACLE
from monthmill.given.months import MONTHS_ORACLE
from monthmill.given.queries import MIN_CARD_TRIPS, MIN_TRIPS, MONTH, PICKED, YEAR


def _fixed(value: str, places: int) -> str:
    """Rounds as Spark does: half up on the decimal digits."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38, 12)), {places}) AS DOUBLE)"


def _key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


def _int(value: str) -> str:
    return f"CAST({value} AS INTEGER)"


def _long(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


_TRIPS = f"""trips AS (
  SELECT l_shipdate AS pickup_time, {_key('l_shipdate')} AS pickup_date_key,
         {_long('s_nationkey')} AS pickup_location_id, l_returnflag AS payment_type,
         l_linestatus AS rate_code_id, {_long('l_linenumber')} AS passenger_count,
         l_quantity AS trip_distance, l_extendedprice AS fare_amount, l_discount AS tip_amount,
         l_extendedprice + l_discount + l_tax AS total_amount,
         {_int('year(l_shipdate)')} AS year, {_int('month(l_shipdate)')} AS month
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey)"""

_EVENTS = f"""happenings AS (
  SELECT ts, {_int('hour(ts)')} AS h, {_key('ts')} AS day_key, isodow(ts) > 5 AS weekend,
         day(ts) AS dom FROM events)"""

_PLACES = """places AS (
  SELECT n_nationkey AS place_id, n_name AS zone, r_name AS borough
  FROM nation JOIN region ON r_regionkey = n_regionkey)"""


def _calendar(first: str, last: str) -> str:
    return f"""SELECT CAST(d AS DATE) AS d FROM generate_series({first}, {last}, INTERVAL 1 DAY) g(d)"""


_DAYS = f"""days AS (
  SELECT {_key('d')} AS day_key, {_int('year(d)')} AS yr, {_int('month(d)')} AS mo,
         {_int('day(d)')} AS dom, isodow(d) > 5 AS weekend
  FROM ({_calendar("DATE '1995-01-01'", "DATE '2000-12-31'")}))"""

_DAILY = f"""daily AS (
  SELECT pickup_date_key, pickup_location_id, payment_type, COUNT(*) AS trips,
         COUNT(CASE WHEN tip_amount > 0 THEN 1 END) AS tipped_trips,
         {_fixed('SUM(fare_amount)', 2)} AS total_fare, {_fixed('SUM(tip_amount)', 2)} AS total_tip,
         {_fixed('SUM(total_amount)', 2)} AS total_revenue,
         {_fixed('SUM(trip_distance)', 2)} AS total_distance, year
  FROM trips GROUP BY pickup_date_key, pickup_location_id, payment_type, year)"""

_PAYMENTS = """payments(payment_type, payment_desc) AS (
  VALUES ('R', 'Credit card'), ('A', 'Cash'), ('N', 'No charge'))"""
_RATES = "rates(rate_code_id, rate_code_desc) AS (VALUES ('F', 'Standard rate'))"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_FACT = _with(_TRIPS, _PLACES, _DAYS, _PAYMENTS, _RATES)
_ROLL = _with(_TRIPS, _PLACES, _DAYS, _PAYMENTS, _DAILY)
_BY_DAY = "JOIN days ON day_key = pickup_date_key"
_BY_PLACE = "JOIN places ON place_id = pickup_location_id"
_PICKED = ", ".join(str(year) for year in PICKED)


def _share(part: str, whole: str, places: int = 2) -> str:
    return _fixed(f"100.0::DOUBLE * {part} / NULLIF({whole}, 0)", places)


_TIPPED = "COUNT(CASE WHEN tip_amount <> 0 THEN 1 END)"
_WEEK = """COUNT(CASE WHEN NOT weekend THEN 1 END) AS weekday_trips,
           COUNT(CASE WHEN weekend THEN 1 END) AS weekend_trips"""

# Dashboard frames, as the queries that derive from them see them.
_SERIES = f"""series AS (
  SELECT yr, mo, {_long('SUM(trips)')} AS trips, SUM(total_revenue) AS revenue,
         SUM(total_fare) AS fare,
         {_long("SUM(CASE WHEN payment_type = 'R' THEN trips END)")} AS card_trips,
         {_long("SUM(CASE WHEN payment_type = 'R' THEN tipped_trips END)")} AS card_tipped
  FROM daily {_BY_DAY} GROUP BY yr, mo)"""
_ZONE_YEARS = f"""zone_years AS (
  SELECT zone, borough, yr, {_long('SUM(trips)')} AS trips
  FROM daily {_BY_PLACE} {_BY_DAY} GROUP BY zone, borough, yr)"""
_PAYMENT_YEARS = f"""payment_years AS (
  SELECT payment_desc, yr, {_long('SUM(trips)')} AS trips, {_long('SUM(tipped_trips)')} AS tipped,
         SUM(total_tip) AS tip_total
  FROM daily JOIN payments USING (payment_type) {_BY_DAY} GROUP BY payment_desc, yr)"""
_BOROUGH_YEARS = f"""borough_years AS (
  SELECT borough, yr, {_long('SUM(trips)')} AS trips,
         {_long("SUM(trips) FILTER (payment_type = 'R')")} AS card_trips,
         {_long("SUM(tipped_trips) FILTER (payment_type = 'R')")} AS card_tipped,
         SUM(total_tip) FILTER (payment_type = 'R') AS card_tip_total
  FROM daily {_BY_PLACE} {_BY_DAY} WHERE borough <> 'MIDDLE EAST' GROUP BY borough, yr)"""

_SERIES = f"{_ROLL}, {_SERIES} "
_ZONE_YEARS = f"{_ROLL}, {_ZONE_YEARS} "
_PAYMENT_YEARS = f"{_ROLL}, {_PAYMENT_YEARS} "
_BOROUGH_YEARS = f"{_ROLL}, {_BOROUGH_YEARS} "

_RAW = f"""raw AS (
  SELECT l_linenumber AS vendor, o_orderdate AS began, l_shipdate AS ended, quality, toxic,
         l_quantity - 3.0::DOUBLE AS distance,
         CASE WHEN quality IS NOT NULL THEN o_orderstatus END AS flag,
         s_nationkey AS from_id, c_nationkey AS to_id, {_int('ascii(l_returnflag)')} AS pay,
         CASE WHEN c_acctbal < 0 THEN -l_extendedprice ELSE l_extendedprice END AS fare,
         l_tax, l_discount, l_extendedprice,
         CASE WHEN quality IS NOT NULL AND toxic = 0 THEN l_tax END AS congestion,
         CASE WHEN quality IS NOT NULL THEN l_linenumber - 2.0::DOUBLE END AS airport
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN labels ON doc_id = l_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey)"""
_ALL_NULL = """(quality IS NULL AND toxic IS NULL AND flag IS NULL AND congestion IS NULL
                AND airport IS NULL)"""
_ANY_NULL = """(quality IS NULL OR toxic IS NULL OR flag IS NULL OR congestion IS NULL
                OR airport IS NULL)"""
_REVERSED = "COALESCE(ended < began, FALSE)"
_REFUND = "COALESCE(fare < 0 AND distance > 0, FALSE)"
_NEAR = """near AS (SELECT n_nationkey AS id FROM nation JOIN region ON r_regionkey = n_regionkey
  WHERE r_name IN ('ASIA', 'EUROPE'))"""
_LOST = "(from_id NOT IN (SELECT id FROM near) AND to_id NOT IN (SELECT id FROM near))"

_LABELLED = "(SELECT * FROM documents LEFT JOIN labels USING (doc_id))"
_DOC_TYPES = {
    "doc_id": "bigint",
    "text": "string",
    "lang": "string",
    "source": "string",
    "n_chars": "bigint",
    "quality": "int",
    "toxic": "int",
}
_ITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


def _profile(relation: str, types: dict[str, str]) -> str:
    rows = [
        f"""SELECT '{name}' AS "column", '{kind}' AS dtype, COUNT(*) - COUNT({name}) AS missing_count,
        {_share(f'(COUNT(*) - COUNT({name}))', 'COUNT(*)')} AS missing_pct,
        COUNT(DISTINCT {name}) + {_long(f'COUNT(*) > COUNT({name})')} AS unique_count FROM {relation}"""
        for name, kind in types.items()
    ]
    return "\nUNION ALL ".join(rows)


def _describe(relation: str, names: list[str]) -> str:
    rows = [
        f"""SELECT '{n}' AS "column", COUNT({n}) AS count, {_fixed(f'AVG({n})', 9)} AS mean,
        {_fixed(f'STDDEV_SAMP({n})', 6)} AS std, MIN({n}) AS min,
        {_fixed(f'QUANTILE_CONT({n}, 0.25)', 6)} AS q25, {_fixed(f'QUANTILE_CONT({n}, 0.5)', 6)} AS q50,
        {_fixed(f'QUANTILE_CONT({n}, 0.75)', 6)} AS q75, MAX({n}) AS max FROM {relation}"""
        for n in names
    ]
    return "\nUNION ALL ".join(rows)


def _repeats(name: str, table: str, columns: str) -> str:
    return f"""SELECT '{name}' AS table_name, {_long(0)} AS null_keys,
      COUNT(CASE WHEN n > 1 THEN 1 END) AS repeated_keys, {_long('SUM(n - 1)')} AS extra_rows
      FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {columns})"""


def _orphans(name: str, child: str, key: str, known: str) -> str:
    return f"""SELECT '{name}' AS constraint_name, COUNT(DISTINCT {key}) AS orphan_keys,
      COUNT(*) AS orphan_rows FROM {child} WHERE {key} IS NOT NULL AND {key} NOT IN ({known})"""


def _months(name: str, table: str, when: str) -> str:
    return f"""{name} AS (SELECT DISTINCT {_int(f'year({when})')} AS year,
      {_int(f'month({when})')} AS month FROM {table})"""


_SHIPPED = _months("shipped", "lineitem", "l_shipdate")
_ORDERED = _months("ordered", "orders", "o_orderdate")
_GRID = """grid AS (SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month
  FROM range({0}, {1}) a(y), range(1, 13) b(m))"""
_STATUS = """statuses AS (SELECT g.year, g.month, CASE WHEN o.year IS NOT NULL THEN 'skipped'
  WHEN s.year IS NOT NULL THEN 'uploaded' ELSE 'unpublished' END AS status
  FROM grid g LEFT JOIN ordered o ON o.year = g.year AND o.month = g.month
  LEFT JOIN shipped s ON s.year = g.year AND s.month = g.month)"""
_COVERAGE = _with(_SHIPPED, _ORDERED, _GRID.format(1994, 2003), _STATUS)

_RAW_DAILY = f"""{_with(_TRIPS.replace('l_returnflag AS payment_type',
                                        'CAST(ascii(l_returnflag) AS BIGINT) AS payment_type'), _DAILY)}"""

_ARROW_TYPES = """CASE data_type WHEN 'INTEGER' THEN 'int32' WHEN 'BIGINT' THEN 'int64'
  WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp[us]'
  WHEN 'FLOAT[]' THEN 'list<element: float>' ELSE data_type END"""

ORACLE: dict[str, str] = {
    "q01_top_zones_fact": f"""{_FACT} SELECT zone, COUNT(*) AS trips FROM trips LEFT {_BY_PLACE}
      WHERE year = {YEAR} GROUP BY zone ORDER BY trips DESC, zone NULLS LAST LIMIT 10""",
    "q02_top_zones_rollup": f"""{_ROLL} SELECT zone, {_long('SUM(trips)')} AS trips
      FROM daily LEFT {_BY_PLACE} WHERE year = {YEAR}
      GROUP BY zone ORDER BY trips DESC, zone NULLS LAST LIMIT 10""",
    "q03_borough_months": f"""{_ROLL} SELECT yr AS year, mo AS month, borough,
      {_long('SUM(trips)')} AS trips, {_fixed('SUM(total_revenue)', 2)} AS revenue,
      {_fixed('ROUND(SUM(total_tip), 6) / SUM(trips)', 2)} AS avg_tip_per_trip,
      {_share('SUM(tipped_trips)', 'SUM(trips)')} AS pct_tipped
      FROM daily {_BY_DAY} {_BY_PLACE} WHERE year = {YEAR} GROUP BY yr, mo, borough""",
    "q04_card_tip_share": f"""{_FACT} SELECT {_share(_TIPPED, 'COUNT(*)')} AS pct_tipped
      FROM trips WHERE year = {YEAR} AND payment_type = 'R'""",
    "q05_week_parts_unmatched": f"""{_FACT} SELECT {_WEEK},
      COUNT(CASE WHEN weekend IS NULL THEN 1 END) AS unmatched_dates FROM trips LEFT {_BY_DAY}""",
    "q06_star_report": f"""{_FACT} SELECT payment_desc, rate_code_desc, borough,
      weekend AS is_weekend, COUNT(*) AS trips,
      {_fixed('ROUND(SUM(tip_amount), 6) / COUNT(tip_amount)', 2)} AS avg_tip
      FROM trips LEFT JOIN payments USING (payment_type) LEFT JOIN rates USING (rate_code_id)
      LEFT {_BY_PLACE} LEFT {_BY_DAY} WHERE year = {YEAR} AND month = {MONTH}
      GROUP BY ALL ORDER BY trips DESC, payment_desc NULLS LAST, rate_code_desc NULLS LAST,
      borough NULLS LAST, weekend NULLS LAST LIMIT 20""",
    "q07_hourly_anomalies": f"""WITH hours AS (SELECT date_trunc('hour', ts) AS hour_bucket,
        {_int('hour(ts)')} AS hour_of_day, COUNT(*) AS trips FROM events GROUP BY ALL),
      history AS (SELECT hour_of_day, AVG(trips) AS usual, STDDEV_SAMP(trips) AS spread
        FROM hours GROUP BY hour_of_day)
      SELECT hour_bucket, hour_of_day, trips, {_fixed('(trips - usual) / NULLIF(spread, 0)', 6)} AS z
      FROM hours JOIN history USING (hour_of_day)
      ORDER BY ABS((trips - usual) / NULLIF(spread, 0)) DESC NULLS LAST, hour_bucket LIMIT 20""",
    "q07_hourly_anomalies_years": f"""WITH moved AS (
        SELECT l_shipdate + to_hours({_int('l_quantity % 24')}) AS ts FROM lineitem
        WHERE year(l_shipdate) BETWEEN {PICKED[0]} AND {PICKED[-1]}),
      hours AS (SELECT date_trunc('hour', ts) AS hour_bucket,
        {_int('hour(ts)')} AS hour_of_day, COUNT(*) AS trips FROM moved GROUP BY ALL),
      history AS (SELECT hour_of_day, AVG(trips) AS usual, STDDEV_SAMP(trips) AS spread
        FROM hours GROUP BY hour_of_day)
      SELECT hour_bucket, hour_of_day, trips, {_fixed('(trips - usual) / NULLIF(spread, 0)', 6)} AS z
      FROM hours JOIN history USING (hour_of_day)
      ORDER BY ABS((trips - usual) / NULLIF(spread, 0)) DESC NULLS LAST, hour_bucket LIMIT 20""",
    "q08_busiest_hours": f"""{_with(_EVENTS)} SELECT h AS pickup_hour, COUNT(*) AS trips
      FROM happenings GROUP BY h ORDER BY trips DESC, h LIMIT 10""",
    "q09_average_fare_by_borough": f"""{_FACT} SELECT borough,
      {_fixed('ROUND(SUM(fare_amount), 6) / COUNT(fare_amount)', 6)} AS average_fare
      FROM trips LEFT {_BY_PLACE} GROUP BY borough""",
    "q10_tipped_by_borough": f"""{_FACT} SELECT borough, {_share(_TIPPED, 'COUNT(*)')} AS pct_tipped
      FROM trips LEFT {_BY_PLACE} GROUP BY borough""",
    "q11_tipped_overall": f"""{_FACT} SELECT {_share(_TIPPED, 'COUNT(*)')} AS pct_tipped FROM trips""",
    "q12_payment_most_tips": f"""{_FACT} SELECT payment_desc AS payment_description,
      {_fixed('SUM(tip_amount)', 2)} AS total_tip FROM trips LEFT JOIN payments USING (payment_type)
      GROUP BY payment_desc ORDER BY SUM(tip_amount) DESC NULLS LAST LIMIT 1""",
    "q13_week_parts_by_hour": f"""{_with(_EVENTS)} SELECT h AS time_of_day, {_WEEK}
      FROM happenings GROUP BY h""",
    "q14_week_parts_by_zone": f"""{_FACT} SELECT zone, {_WEEK} FROM trips LEFT {_BY_DAY}
      LEFT {_BY_PLACE} GROUP BY zone""",
    "q15_week_parts_by_borough": f"""{_FACT} SELECT borough, {_WEEK} FROM trips LEFT {_BY_DAY}
      LEFT {_BY_PLACE} GROUP BY borough""",
    "q16_ranked_days": f"""{_FACT}, counts AS (SELECT dom AS day_of_month, COUNT(*) AS total_count
        FROM trips LEFT {_BY_DAY} GROUP BY dom)
      SELECT {_int('rank_day')} AS rank_day, day_of_month, total_count FROM (SELECT *, ROW_NUMBER()
        OVER (ORDER BY total_count DESC, day_of_month NULLS LAST) AS rank_day FROM counts)
      WHERE rank_day <= 10""",
    "q17_rolling_three_days": f"""{_with(_EVENTS)}, counts AS (SELECT {_int('dom')} AS day_of_month,
        COUNT(*) AS total_count FROM happenings GROUP BY dom)
      SELECT {_fixed('AVG(total_count) OVER (ORDER BY day_of_month ROWS 2 PRECEDING)', 6)}
        AS rolling_avg, day_of_month, total_count FROM counts""",
    "q18_unusual_hours": f"""{_with(_EVENTS)}, counts AS (SELECT h AS pickup_hour,
        COUNT(*) AS number_of_trip FROM happenings GROUP BY h)
      SELECT pickup_hour, number_of_trip, {_fixed('''(number_of_trip - AVG(number_of_trip) OVER ())
        / NULLIF(STDDEV_SAMP(number_of_trip) OVER (), 0)''', 6)} AS z_score FROM counts""",
    "q19_monthly_series": f"""{_SERIES} SELECT yr, mo, trips, {_fixed('revenue', 2)} AS revenue,
      {_fixed('fare', 2)} AS fare, card_trips, card_tipped FROM series""",
    "q20_zone_years": f"{_ZONE_YEARS} SELECT * FROM zone_years",
    "q21_payment_years": f"""{_PAYMENT_YEARS} SELECT payment_desc, yr, trips, tipped,
      {_fixed('tip_total', 2)} AS tip_total FROM payment_years""",
    "q22_borough_years": f"""{_BOROUGH_YEARS} SELECT borough, yr, trips, card_trips, card_tipped,
      {_fixed('card_tip_total', 2)} AS card_tip_total FROM borough_years""",
    "q23_headline": f"""{_SERIES} SELECT {_long('SUM(trips)')} AS trips,
      {_fixed('SUM(revenue)', 2)} AS revenue,
      {_fixed('ROUND(SUM(fare), 6) / SUM(trips)', 6)} AS avg_fare,
      {_share('SUM(card_tipped)', 'SUM(card_trips)', 6)} AS pct_card_tipped
      FROM series WHERE yr IN ({_PICKED})""",
    "q24_monthly_trend": f"""{_SERIES} SELECT make_date(yr, mo, 1) AS period, yr, mo, trips,
      {_fixed('revenue', 2)} AS revenue FROM series WHERE yr IN ({_PICKED})""",
    "q25_top_zones_picked": f"""{_ZONE_YEARS} SELECT zone, {_long('SUM(trips)')} AS trips
      FROM zone_years WHERE yr IN ({_PICKED}) GROUP BY zone ORDER BY 2 DESC, zone LIMIT 10""",
    "q26_tip_visibility": f"""{_PAYMENT_YEARS} SELECT payment_desc, {_long('SUM(trips)')} AS trips,
      {_long('SUM(tipped)')} AS tipped, {_share('SUM(tipped)', 'SUM(trips)', 6)} AS pct
      FROM payment_years WHERE yr IN ({_PICKED}) GROUP BY payment_desc
      HAVING SUM(trips) > {MIN_TRIPS}""",
    "q27_card_rate_by_borough": f"""{_BOROUGH_YEARS} SELECT borough,
      {_long('SUM(card_trips)')} AS card_trips, {_long('SUM(card_tipped)')} AS card_tipped,
      {_share('SUM(card_tipped)', 'SUM(card_trips)', 6)} AS pct
      FROM borough_years WHERE yr IN ({_PICKED}) GROUP BY borough
      HAVING SUM(card_trips) > {MIN_CARD_TRIPS}""",
    "week_parts": f"{_FACT} SELECT {_WEEK} FROM trips LEFT {_BY_DAY}",
    "picked_year_list": f"{_FACT} SELECT DISTINCT yr FROM trips {_BY_DAY}",
    "fact_view": f"{_FACT} SELECT * FROM trips",
    "fact_era_union": f"""SELECT l_shipdate AS pickup_time,
      l_shipdate + to_hours({_int('l_quantity')}) AS dropoff_time,
      {_key('l_shipdate')} AS pickup_date_key, {_long('s_nationkey')} AS pickup_location_id,
      l_suppkey AS dropoff_location_id, {_long('ascii(l_returnflag)')} AS payment_type,
      {_long('ascii(l_linestatus)')} AS rate_code_id, {_long('l_linenumber')} AS passenger_count,
      l_quantity AS trip_distance, l_extendedprice AS fare_amount, l_discount AS tip_amount,
      l_extendedprice + l_discount + l_tax AS total_amount,
      {_int('year(l_shipdate)')} AS year, {_int('month(l_shipdate)')} AS month
      FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey""",
    "fact_narrow": f"""{_FACT} SELECT year, month, COUNT(*) AS trips FROM trips
      WHERE year BETWEEN 1996 AND 2001 GROUP BY year, month""",
    "fact_wide": f"""{_with(_RAW)} SELECT vendor AS vendor_id, {_key('began')} AS pickup_date_key,
      {_key('ended')} AS dropoff_date_key, from_id AS pickup_location_id,
      to_id AS dropoff_location_id, toxic AS rate_code_id, pay AS payment_type,
      flag AS store_and_fwd_flag, {_int('date_diff(\'second\', date_trunc(\'day\', began), began)')}
      AS pickup_time, {_int('date_diff(\'second\', date_trunc(\'day\', ended), ended)')} AS dropoff_time,
      quality AS passenger_count, distance AS trip_distance, fare AS fare_amount,
      0.5::DOUBLE AS extra, l_tax AS mta_tax, l_discount AS tip_amount, 0.0::DOUBLE AS tolls_amount,
      1.0::DOUBLE AS improvement_surcharge, congestion AS congestion_surcharge,
      airport AS airport_fee, l_discount AS cbd_congestion_fee, l_extendedprice AS total_amount
      FROM raw WHERE NOT {_ALL_NULL} AND NOT {_REVERSED} AND NOT {_REFUND}""",
    "hourly_trips": f"""SELECT date_trunc('hour', ts) AS hour_bucket, {_int('hour(ts)')} AS hour_of_day,
      COUNT(*) AS trips FROM events GROUP BY ALL""",
    "time_split": f"""WITH ends AS (SELECT event_id, ts, ts + to_seconds(event_id % 90000) AS te FROM events)
      SELECT event_id, CAST(ts AS DATE) AS "Pickup_date", CAST(te AS DATE) AS "Dropoff_date",
      {_int('hour(ts) * 3600 + minute(ts) * 60 + second(ts)')} AS "Pickup_time",
      {_int('hour(te) * 3600 + minute(te) * 60 + second(te)')} AS "Dropoff_time" FROM ends""",
    "dim_date_fixed": f"""WITH counts AS (SELECT CAST(l_shipdate AS DATE) AS d, COUNT(*) AS trips
        FROM lineitem GROUP BY 1), span AS ({_calendar("DATE '1995-01-01'", "DATE '2000-12-31'")})
      SELECT {_key('d')} AS date_key, d AS full_date, {_int('year(d)')} AS year,
      {_int('month(d)')} AS month, {_int('day(d)')} AS day_of_month, {_int('isodow(d)')} AS dow,
      isodow(d) >= 6 AS is_weekend, COALESCE(trips, 0) AS trips FROM span LEFT JOIN counts USING (d)""",
    "dim_date_from_data": f"""WITH dates AS (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem
        UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders),
      ends AS (SELECT MIN(d) AS lo, MAX(d) AS hi FROM dates),
      span AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM ends)
      SELECT {_key('d')} AS date_key, d AS full_date, {_int('day(d)')} AS day,
      {_int('month(d)')} AS month, monthname(d) AS month_name, {_int('quarter(d)')} AS quarter,
      {_int('year(d)')} AS year, {_int('isodow(d)')} AS day_of_week, dayname(d) AS day_name,
      isodow(d) >= 6 AS is_weekend, {_int('week(d)')} AS week_of_year FROM span""",
    "dim_location_lakehouse": f"""SELECT {_long('p_size')} AS location_id, p_brand AS borough,
      ' ' || p_name || ' ' AS zone, CASE p_type WHEN 'SMALL' THEN 'N/A' ELSE p_type END AS service_zone
      FROM part""",
    "dim_location_notebook": f"""SELECT {_long('p_size')} AS location_id, p_brand AS borough,
      p_name AS zone, CASE p_type WHEN 'SMALL' THEN 'Unknown' ELSE p_type END AS service_zone
      FROM part QUALIFY ROW_NUMBER() OVER (PARTITION BY p_size ORDER BY p_partkey) = 1""",
    "dim_location_null_ids": f"""SELECT {_long('p_size')} AS location_id, p_brand AS borough,
      ' ' || p_name || ' ' AS zone, CASE p_type WHEN 'SMALL' THEN 'N/A' ELSE p_type END AS service_zone
      FROM part WHERE p_partkey % 5 <> 0""",
    "tip_rules": """SELECT l_returnflag AS payment_type, COUNT(*) FILTER (ROUND(l_discount - 0.05, 2) > 0) AS above_zero,
      COUNT(*) FILTER (ROUND(l_discount - 0.05, 2) <> 0) AS not_zero FROM lineitem GROUP BY 1""",
    "whole_codes": f"""SELECT {_long('CASE WHEN l_quantity % 7 <> 0 THEN ROUND(l_quantity / 4) END')} AS code,
      COUNT(*) AS trips FROM lineitem GROUP BY 1""",
    "dim_values": f"""{_FACT} SELECT payment_desc, rate_code_desc, COUNT(*) AS trips FROM trips
      LEFT JOIN payments USING (payment_type) LEFT JOIN rates USING (rate_code_id) GROUP BY ALL""",
    "rollup_build": f"{_ROLL} SELECT * FROM daily",
    "rollup_reconcile": f"""{_ROLL} SELECT year, {_long('COUNT(*)')} AS fact_trips,
      {_long('COUNT(*)')} AS rollup_trips, {_long(0)} AS difference
      FROM trips GROUP BY GROUPING SETS ((year), ())""",
    "rollup_rebuild": f"{_ROLL} SELECT * FROM daily",
    "rollup_refresh": f"{_FACT} SELECT year, month, COUNT(*) AS trips FROM trips GROUP BY year, month",
    "clean_steps": f"""{_with(_RAW, _NEAR)}, tested AS (SELECT {_ALL_NULL} AS bad1,
        {_ANY_NULL} AS any1, {_REVERSED} AS bad2, {_REFUND} AS bad3, {_LOST} AS lost FROM raw),
      n AS (SELECT COUNT(*) AS n0, COUNT(*) FILTER (NOT bad1) AS n1,
        COUNT(*) FILTER (NOT bad1 AND NOT bad2) AS n2,
        COUNT(*) FILTER (NOT bad1 AND NOT bad2 AND NOT bad3) AS n3,
        COUNT(*) FILTER (any1) AS f1,
        COUNT(*) FILTER (NOT bad1 AND NOT bad2 AND NOT bad3 AND lost) AS f4 FROM tested)
      SELECT 1 AS step_no, 'drop_all_missing' AS step, n0 AS rows_before, n0 - n1 AS dropped,
        n1 AS rows_after, f1 AS flagged FROM n
      UNION ALL SELECT 2, 'drop_reversed', n1, n1 - n2, n2, 0 FROM n
      UNION ALL SELECT 3, 'drop_refunds', n2, n2 - n3, n3, 0 FROM n
      UNION ALL SELECT 4, 'report_unknown_locations', n3, 0, n3, f4 FROM n""",
    "drop_all_null": """SELECT doc_id, lang, n_chars, quality, toxic FROM documents
      LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL OR toxic IS NOT NULL""",
    "any_null": f"""{_with(_RAW)} SELECT COUNT(*) FILTER {_ANY_NULL} AS rows_with_missing FROM raw""",
    "refund_filter": f"""{_with(_RAW)} SELECT vendor AS "VendorID", distance AS trip_distance,
      fare AS fare_amount, l_extendedprice AS total_amount, l_tax - 0.05::DOUBLE AS mta_tax,
      l_discount - 0.05::DOUBLE AS cbd_congestion_fee FROM raw WHERE NOT COALESCE(distance > 0
      AND (fare < 0 OR l_tax - 0.05::DOUBLE < 0 OR l_discount - 0.05::DOUBLE < 0), FALSE)""",
    "order_check": """SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate FROM lineitem
      LEFT JOIN orders ON o_orderkey = l_orderkey WHERE COALESCE(l_shipdate >= o_orderdate, TRUE)""",
    "negative_distance": f"""{_with(_RAW)} SELECT COUNT(*) FILTER (distance < 0) AS negative_distances
      FROM raw""",
    "profile_columns": _profile(_LABELLED, _DOC_TYPES),
    "profile_trips": _profile("lineitem", _ITEM_TYPES),
    "columns_with_missing": f"""SELECT * FROM ({_profile(_LABELLED, _DOC_TYPES)})
      WHERE missing_count > 0""",
    "columns_without_missing": f"""SELECT "column" FROM ({_profile(_LABELLED, _DOC_TYPES)})
      WHERE missing_count = 0""",
    "missing_counts": f"""{_with(_RAW)} SELECT * FROM (
      SELECT 'passenger_count' AS "column", COUNT(*) - COUNT(quality) AS missing_count FROM raw
      UNION ALL SELECT 'RatecodeID', COUNT(*) - COUNT(toxic) FROM raw
      UNION ALL SELECT 'store_and_fwd_flag', COUNT(*) - COUNT(flag) FROM raw
      UNION ALL SELECT 'congestion_surcharge', COUNT(*) - COUNT(congestion) FROM raw
      UNION ALL SELECT 'Airport_fee', COUNT(*) - COUNT(airport) FROM raw) WHERE missing_count > 0""",
    "describe_numeric": _describe(
        "lineitem",
        """l_orderkey l_partkey l_suppkey l_linenumber
        l_quantity l_extendedprice l_discount l_tax""".split(),
    ),
    "negative_columns": f"""{_with(_RAW)} SELECT * FROM (
      SELECT 'trip_distance' AS "column", COUNT(*) FILTER (distance < 0) AS negative_count FROM raw
      UNION ALL SELECT 'fare_amount', COUNT(*) FILTER (fare < 0) FROM raw
      UNION ALL SELECT 'Airport_fee', COUNT(*) FILTER (airport < 0) FROM raw)
      WHERE negative_count > 0""",
    "duplicate_rows": f"""SELECT {_long('SUM(n)')} AS total_rows, {_long('SUM(n - 1)')} AS duplicate_rows
      FROM (SELECT COUNT(*) AS n FROM (SELECT * FROM lineitem UNION ALL
        SELECT * FROM lineitem WHERE l_returnflag = 'R') GROUP BY l_orderkey, l_partkey,
        l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
        l_linestatus, l_shipdate)""",
    "duplicate_documents": f"""SELECT {_long('SUM(n)')} AS total_rows,
      {_long('SUM(n - 1)')} AS duplicate_rows
      FROM (SELECT COUNT(*) AS n FROM (SELECT * FROM documents UNION ALL
        SELECT * FROM documents WHERE lang <> 'en') GROUP BY doc_id, text, lang, source, n_chars)""",
    "dedupe_first": """SELECT * FROM lineitem QUALIFY ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
    "both_locations_unknown": f"""{_with(_RAW, _NEAR)} SELECT {_LOST} AS both_unknown,
      COUNT(*) AS trips FROM raw GROUP BY 1""",
    "pk_check": "\nUNION ALL ".join(
        [
            _repeats("nation", "nation", "n_nationkey"),
            _repeats("supplier", "supplier", "s_suppkey"),
            _repeats("orders", "orders", "o_orderkey"),
            _repeats("lineitem", "lineitem", "l_orderkey, l_linenumber"),
        ]
    ),
    "fk_check": "\nUNION ALL ".join(
        [
            _orphans("item_order", "lineitem", "l_orderkey", "SELECT o_orderkey FROM orders"),
            _orphans("item_part", "lineitem", "l_partkey", "SELECT p_partkey FROM part"),
            _orphans("item_supplier", "lineitem", "l_suppkey", "SELECT s_suppkey FROM supplier"),
            _orphans("order_customer", "orders", "o_custkey", "SELECT c_custkey FROM customer"),
            _orphans(
                "supplier_asia",
                "supplier",
                "s_nationkey",
                "SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey "
                "WHERE r_name = 'ASIA'",
            ),
            _orphans("order_label", "orders", "o_orderkey", "SELECT doc_id FROM labels"),
        ]
    ),
    "partition_coverage": f"{_COVERAGE} SELECT * FROM statuses",
    "landing_totals": f"""{_COVERAGE} SELECT COUNT(*) FILTER (status = 'uploaded') AS uploaded,
      COUNT(*) FILTER (status = 'skipped') AS skipped,
      COUNT(*) FILTER (status = 'unpublished') AS unpublished FROM statuses""",
    "landing_plan": f"""{_COVERAGE}, recent AS (SELECT * FROM statuses
        WHERE year * 12 + month BETWEEN 2000 * 12 + 12 AND 2001 * 12 + 11),
      counted AS (SELECT *, COUNT(*) FILTER (status = 'uploaded') OVER (ORDER BY year DESC, month DESC
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS done FROM recent)
      SELECT year, month, CASE WHEN done >= 2 THEN 'not_reached' ELSE status END AS status
      FROM counted""",
    "months_absent": f"""{_with(_SHIPPED, _ORDERED)} SELECT * FROM shipped s WHERE NOT EXISTS
      (SELECT 1 FROM ordered o WHERE o.year = s.year AND o.month = s.month)""",
    "landing_rerun": f"""{_with(_SHIPPED, _GRID.format(1995, 2003))} SELECT g.year, g.month,
      CASE WHEN s.year IS NULL THEN 'unpublished' ELSE 'skipped' END AS status
      FROM grid g LEFT JOIN shipped s ON s.year = g.year AND s.month = g.month""",
    "landed_trips": f"""SELECT {_int('year(l_shipdate)')} AS year, {_int('month(l_shipdate)')} AS month,
      {_long('ascii(l_linestatus)')} AS rate_code_id, COUNT(*) AS trips,
      {_long('SUM(l_linenumber)')} AS passengers FROM lineitem GROUP BY 1, 2, 3""",
    "schema_eras": f"""WITH months AS (SELECT DISTINCT {_int('year(l_shipdate) * 100 + month(l_shipdate)')}
        AS m FROM lineitem)
      SELECT CASE WHEN m < 199702 THEN 'ratecodeid double, passenger_count double'
        ELSE 'ratecodeid int64, passenger_count int64' END AS signature,
      MIN(m) AS first_month, MAX(m) AS last_month FROM months GROUP BY 1""",
    "schema_signatures": f"""SELECT table_name, column_name AS "column", {_ARROW_TYPES} AS type
      FROM information_schema.columns WHERE table_name IN ('region', 'nation', 'customer', 'supplier',
      'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark',
      'labels', 'conversations')""",
    "stream_rollup": f"{_RAW_DAILY} SELECT * FROM daily",
    **LOADS_ORACLE,
    **MONTHS_ORACLE,
    "ledger_rollup": f"{_RAW_DAILY} SELECT * FROM daily",
    "rollup_rebuilt_over": f"{_ROLL} SELECT * FROM daily",
}

ORACLE["cleaned_and_audited"] = f"""SELECT * FROM ({ORACLE["clean_steps"]}) CROSS JOIN ({_with(_RAW)}
    SELECT COUNT(*) AS rows_written, CAST(SUM(hour(ended) * 3600 + minute(ended) * 60 + second(ended)) AS BIGINT) AS seconds
    FROM raw WHERE NOT {_ALL_NULL} AND NOT {_REVERSED} AND NOT {_REFUND})"""
ORACLE["describe_in_two_scans"] = ORACLE["describe_numeric"]
