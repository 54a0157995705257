"""The registered queries once more, written for DuckDB independently of the Spark code."""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def rnd(x: str, digits: int) -> str:
    return f"(round_even(({x}) * 1e{digits}, 0) / 1e{digits})"


def sql_round(x: str, digits: int) -> str:
    """Half away from zero on the shortest decimal text of the double."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38, 15)), {digits}) AS DOUBLE)"


def pct(top: str, bottom: str) -> str:
    return f"coalesce({rnd(f'CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0) * 1e2', 1)}, 0e0)"


def title(x: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all(lower({x}), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), '')"


CITY_LIST = "['Mumbai','Pune','Nashik','Nagpur','Aurangabad','Kolhapur','Goa','Solapur']"
CONDITIONS = "['Clear','Partly Cloudy','Overcast','Light Rain','Heavy Rain','Fog','Thunderstorm']"
RISKS = "[5e0,15e0,25e0,40e0,70e0,65e0,85e0]"
K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

# ---- the three feeds ---------------------------------------------------------------------

DIST = "(CASE WHEN sn.n_nationkey = cn.n_nationkey THEN 0 ELSE 100 + (sn.n_nationkey * 37 + cn.n_nationkey * 91) % 750 END)"
BK = f"""bk AS (
  SELECT 'bk' || l_orderkey || '-' || l_linenumber || ' ' AS booking_id, c_name AS customer_name,
    sn.n_name AS origin_city, cn.n_name AS destination_city, ' ' || p_type AS cargo_type,
    l_quantity * 240 AS cargo_weight_kg, l_extendedprice * 5 AS cargo_value_inr,
    'V-' || lpad(CAST((l_suppkey * 7) % 50 + 1 AS VARCHAR), 3, '0') AS assigned_vehicle_id,
    o_orderdate AS booking_timestamp, l_shipdate AS estimated_delivery,
    CASE WHEN l_returnflag = 'R' THEN 'delayed' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'DELIVERED'
      WHEN l_returnflag = 'A' THEN 'IN_TRANSIT' WHEN l_linestatus = 'F' THEN 'BOOKED'
      WHEN o_orderstatus = 'P' THEN 'CANCELLED' ELSE 'DELIVERED' END AS delivery_status,
    CAST({DIST} AS DOUBLE) AS distance_km,
    CAST(CASE WHEN {DIST} = 0 THEN 0 ELSE {DIST} * (18 + l_partkey % 15)
      + (CASE WHEN o_orderpriority = '1-URGENT' THEN 5000 ELSE 0 END) END AS DOUBLE) AS freight_charge_inr,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'EXPRESS' ELSE 'NORMAL' END AS priority,
    l_linenumber % 5 < 3 AS is_insured, {CONDITIONS}[sn.n_nationkey % 7 + 1] AS origin_weather,
    CASE WHEN l_linenumber <> 7 THEN {RISKS}[sn.n_nationkey % 7 + 1] END AS origin_delay_risk,
    CAST(sn.n_nationkey % 7 >= 4 AS INTEGER) AS origin_has_severe,
    l_partkey, l_suppkey, sn.n_nationkey AS s_nationkey, cn.n_nationkey AS c_nationkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN part ON l_partkey = p_partkey)"""

FIRST = "ROW_NUMBER() OVER (PARTITION BY booking_id ORDER BY booking_timestamp NULLS FIRST, estimated_delivery NULLS FIRST, l_partkey, l_suppkey)"

BK_COLS = [
    "booking_id", "customer_name", "origin_city", "destination_city", "cargo_type", "cargo_weight_kg",
    "cargo_value_inr", "assigned_vehicle_id", "booking_timestamp", "estimated_delivery", "delivery_status",
    "distance_km", "freight_charge_inr", "priority", "is_insured", "origin_weather", "origin_delay_risk",
    "origin_has_severe",
]
COLS = ", ".join(BK_COLS)

BK_NUMERIC = ["cargo_weight_kg", "cargo_value_inr", "distance_km", "freight_charge_inr", "origin_delay_risk", "origin_has_severe"]


def bk_tidy(full: bool) -> str:
    numeric = BK_NUMERIC if full else BK_NUMERIC[:-1]
    medians = ", ".join(f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in numeric)
    fills = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in numeric)
    texts = ", ".join(
        [f"trim(upper({c})) AS {c}" for c in ["delivery_status", "priority", *(["booking_id"] if full else [])]]
        + [f"trim({title(c)}) AS {c}" for c in ["origin_city", "destination_city", "cargo_type"]]
    )
    return f"""{BK}, bk_med AS (SELECT {medians} FROM bk),
  bk_tidy AS (SELECT bk.* REPLACE ({fills}, {texts}) FROM bk, bk_med),
  bk_first AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {FIRST} AS rn FROM bk_tidy) WHERE rn = 1)"""


BK_CLEAN = f"""{bk_tidy(True)}, bk_clean AS (SELECT * FROM bk_first WHERE distance_km > 0 AND freight_charge_inr > 0
  AND booking_id IS NOT NULL AND origin_city IS NOT NULL AND destination_city IS NOT NULL)"""

FLAGS = """CASE WHEN delivery_status = 'DELAYED' THEN 1 ELSE 0 END AS is_delayed,
  CASE WHEN priority = 'EXPRESS' THEN 1 ELSE 0 END AS is_express,
  CASE WHEN distance_km > 500 THEN 1 ELSE 0 END AS is_long_haul,
  CASE WHEN cargo_weight_kg > 8000 THEN 1 ELSE 0 END AS is_heavy_cargo"""
REV = rnd("freight_charge_inr / (CASE WHEN distance_km = 0 THEN 1e0 ELSE distance_km END)", 2)
VALUE_CLASS = """CASE WHEN cargo_value_inr > 0 AND cargo_value_inr <= 50000 THEN 'LOW'
  WHEN cargo_value_inr > 50000 AND cargo_value_inr <= 200000 THEN 'MEDIUM'
  WHEN cargo_value_inr > 200000 THEN 'HIGH' ELSE 'nan' END"""
BK_FEATURES = f"""{FLAGS}, {REV} AS revenue_per_km, {VALUE_CLASS} AS cargo_value_category,
  {rnd('origin_delay_risk * distance_km / 1e2', 2)} AS weather_distance_risk"""
BK_FEAT = f"""{BK_CLEAN}, bk_feat AS (SELECT *, {BK_FEATURES}, CAST(hour(booking_timestamp) AS INTEGER) AS booking_hour,
  dayname(booking_timestamp) AS booking_day FROM bk_clean)"""
BK_LARGE = f"{bk_tidy(False)}, large AS (SELECT *, {BK_FEATURES} FROM bk_first)"
NO_HELPERS = "* EXCLUDE (l_partkey, l_suppkey, s_nationkey, c_nationkey)"

IOT = f"""iot AS (
  SELECT event_id, 'v-' || lpad(CAST((user_id * 7) % 50 + 1 AS VARCHAR), 3, '0') AS vehicle_id,
    CASE WHEN (user_id * 7) % 50 + 1 <= 17 THEN 'old' WHEN (user_id * 7) % 50 + 1 <= 35 THEN 'mid' ELSE 'new' END AS vehicle_tier,
    ts AS timestamp, 15e0 + (event_id * 13 % 650) / 1e2 AS gps_latitude, 725e-1 + (event_id * 29 % 800) / 1e2 AS gps_longitude,
    value AS speed_kmh, CAST({K} AS DOUBLE) AS fuel_level_pct, CAST({K} % 7 AS DOUBLE) AS fuel_consumed_L,
    60e0 + {K} * 8e-1 AS engine_temp_C, CAST(500 + (event_id * 37) % 4500 AS DOUBLE) AS engine_rpm,
    115e-1 + (event_id % 34) / 1e1 AS battery_voltage, 28e0 + (event_id % 100) / 1e1 AS tyre_pressure_psi,
    CAST(500 + (event_id * 53) % 9500 AS DOUBLE) AS cargo_weight_kg,
    CASE event_type WHEN 'error' THEN 'warn' WHEN 'signup' THEN NULL ELSE 'ok' END AS brake_status,
    event_type = 'error' AS alert_flag FROM events)"""
IOT_NUMERIC = [
    "speed_kmh", "fuel_level_pct", "fuel_consumed_L", "engine_temp_C", "engine_rpm", "battery_voltage",
    "tyre_pressure_psi", "cargo_weight_kg",
]


def iot_fill(columns: list[str]) -> str:
    medians = ", ".join(f"median({c}) AS m_{c}" for c in columns)
    return f"iot_med AS (SELECT {medians} FROM iot)"


GPS = ["gps_latitude", "gps_longitude"]
IOT_CLEAN = f"""{IOT}, {iot_fill(IOT_NUMERIC + GPS)}, iot_clean AS (
  SELECT DISTINCT iot.* REPLACE ({", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in IOT_NUMERIC + GPS)},
    trim(upper(vehicle_id)) AS vehicle_id, trim(upper(vehicle_tier)) AS vehicle_tier,
    coalesce(upper(brake_status), 'UNKNOWN') AS brake_status)
  FROM iot, iot_med WHERE coalesce(speed_kmh, m_speed_kmh) >= 0 AND coalesce(fuel_level_pct, m_fuel_level_pct) BETWEEN 0 AND 100
    AND coalesce(engine_temp_C, m_engine_temp_C) BETWEEN 50 AND 135)"""
HEALTH = "1e2 - (engine_temp_C - 70) / 60 * 35 - (engine_rpm - 700) / 4300 * 25 + (battery_voltage - 11.5e0) / 3.3e0 * 10"
IOT_FEATURES = f"""{rnd("speed_kmh / (CASE WHEN fuel_consumed_L = 0 THEN 0.1e0 ELSE fuel_consumed_L END)", 2)} AS fuel_efficiency_kmpl,
  {rnd(f"greatest(least({HEALTH}, 1e2), 0e0)", 1)} AS engine_health_score,
  CASE WHEN speed_kmh > 200 OR speed_kmh <= -1 THEN 'nan' WHEN speed_kmh > 90 THEN 'OVERSPEEDING' WHEN speed_kmh > 60 THEN 'FAST'
    WHEN speed_kmh > 30 THEN 'MODERATE' WHEN speed_kmh > 0 THEN 'SLOW' WHEN speed_kmh <= 0 THEN 'STOPPED' ELSE 'nan' END AS speed_category,
  CASE WHEN fuel_level_pct > 101 OR fuel_level_pct <= -1 THEN 'nan' WHEN fuel_level_pct > 50 THEN 'NORMAL'
    WHEN fuel_level_pct > 20 THEN 'LOW' WHEN fuel_level_pct <= 20 THEN 'CRITICAL' ELSE 'nan' END AS fuel_status,
  CASE WHEN vehicle_tier = 'OLD' THEN 1 ELSE 0 END AS is_old_truck"""
IOT_FEAT = f"""{IOT_CLEAN}, iot_feat AS (SELECT *, {IOT_FEATURES},
  CASE WHEN engine_temp_C > 108 OR fuel_level_pct < 15 THEN 'CRITICAL'
    WHEN alert_flag OR brake_status = 'WARN' OR engine_temp_C > 100 THEN 'WARNING' ELSE 'NONE' END AS alert_severity FROM iot_clean)"""
IOT_FLAG = f"{IOT_FEAT}, flagged AS (SELECT *, CASE WHEN speed_kmh > 100 THEN 1 ELSE 0 END AS hit FROM iot_feat)"

WX = f"""wx AS (
  SELECT event_id, lower({CITY_LIST}[event_id % 8 + 1]) AS city, ts AS timestamp, {CONDITIONS}[{K} % 7 + 1] AS weather_condition,
    {RISKS}[{K} % 7 + 1] AS delay_risk_score, CAST(15 + {K} % 34 AS DOUBLE) AS temperature_C, CAST({K} + 5 AS DOUBLE) AS humidity_pct,
    value / 5 AS wind_speed_kmh, value / 4 AS rainfall_mm, CAST({K} % 31 AS DOUBLE) AS visibility_km,
    {K} % 7 = 5 AS fog_alert, value / 4 > 50 AS flood_alert, CAST(({K} * 3) % 120 AS DOUBLE) AS traffic_congestion FROM events)"""
WX_NUMERIC = [
    "temperature_C", "humidity_pct", "wind_speed_kmh", "rainfall_mm", "visibility_km", "delay_risk_score", "traffic_congestion",
]
WX_LIMITS = {"humidity_pct": 100, "delay_risk_score": 100, "visibility_km": 50, "traffic_congestion": 100}


def _wx_value(c: str) -> str:
    value = f"coalesce({c}, m_{c})"
    if c in WX_LIMITS:
        value = f"greatest(least({value}, {WX_LIMITS[c]}e0), 0e0)"
    return f"{value} AS {c}"


WX_CLEAN = f"""{WX}, wx_med AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in WX_NUMERIC)} FROM wx),
  wx_clean AS (SELECT DISTINCT wx.* REPLACE ({", ".join(_wx_value(c) for c in WX_NUMERIC)}, trim({title("city")}) AS city,
    trim({title("weather_condition")}) AS weather_condition) FROM wx, wx_med)"""
WX_FEAT = f"""{WX_CLEAN}, wx_feat AS (SELECT *,
  CASE WHEN delay_risk_score > 101 OR delay_risk_score <= -1 THEN 'nan' WHEN delay_risk_score > 75 THEN 'SEVERE' WHEN delay_risk_score > 50 THEN 'HIGH'
    WHEN delay_risk_score > 20 THEN 'MODERATE' WHEN delay_risk_score <= 20 THEN 'LOW' ELSE 'nan' END AS weather_severity,
  CASE WHEN delay_risk_score >= 75 THEN 'DO NOT TRAVEL' WHEN delay_risk_score >= 50 THEN 'TRAVEL WITH CAUTION'
    WHEN delay_risk_score >= 20 THEN 'MINOR DELAYS EXPECTED' ELSE 'CLEAR TO TRAVEL' END AS travel_advisory,
  {rnd("temperature_C + (0.33e0 * (humidity_pct / 100) * 6.105e0) - (0.70e0 * (wind_speed_kmh / 3.6e0)) - 4e0", 1)} AS "heat_index_C",
  CASE WHEN rainfall_mm > 30 OR wind_speed_kmh > 50 OR visibility_km < 2 OR fog_alert OR flood_alert THEN 1 ELSE 0 END AS is_severe_weather,
  {rnd("delay_risk_score * 0.6e0 + traffic_congestion * 0.4e0", 1)} AS combined_risk_score,
  CAST(hour(timestamp) AS INTEGER) AS reading_hour FROM wx_clean)"""
FIRST_OF = "first({0} ORDER BY timestamp, {0}) FILTER (WHERE {0} IS NOT NULL)"
CITY_WX = f"""city_wx AS (SELECT city AS nearest_city, {rnd("avg(temperature_C)", 6)} AS "avg_temp_C",
  {rnd("avg(humidity_pct)", 6)} AS avg_humidity_pct, {rnd("avg(delay_risk_score)", 6)} AS avg_delay_risk,
  {rnd("avg(traffic_congestion)", 6)} AS avg_congestion, {FIRST_OF.format("weather_condition")} AS weather_condition,
  {rnd("avg(visibility_km)", 6)} AS avg_visibility_km, max(is_severe_weather) AS has_severe_weather,
  {FIRST_OF.format("travel_advisory")} AS travel_advisory, {rnd("avg(combined_risk_score)", 6)} AS combined_risk_score
  FROM wx_feat WHERE city IS NOT NULL GROUP BY city)"""
ORIGIN_WX = f"""origin_wx AS (SELECT city AS origin_city, {FIRST_OF.format("weather_condition")} AS origin_weather_w,
  {rnd("avg(delay_risk_score)", 6)} AS origin_delay_risk_w, {rnd("avg(visibility_km)", 6)} AS origin_visibility_km,
  {rnd("avg(traffic_congestion)", 6)} AS origin_congestion, max(is_severe_weather) AS origin_has_severe_w,
  {rnd("avg(combined_risk_score)", 6)} AS origin_combined_risk FROM wx_feat WHERE city IS NOT NULL GROUP BY city)"""

# ---- cleaning ----------------------------------------------------------------------------

ORACLES["bookings_clean"] = f"WITH {BK_CLEAN} SELECT {COLS} FROM bk_clean"
ORACLES["bookings_dedup"] = f"WITH {BK} SELECT {COLS} FROM (SELECT *, {FIRST} AS rn FROM bk) WHERE rn = 1"
ORACLES["iot_clean"] = f"WITH {IOT_CLEAN} SELECT * FROM iot_clean"
ORACLES["iot_dedup"] = f"WITH {IOT} SELECT DISTINCT * EXCLUDE (event_id) FROM iot"
ORACLES["weather_clean"] = f"WITH {WX_CLEAN} SELECT * FROM wx_clean"
ORACLES["large_bookings"] = f"WITH {BK_LARGE} SELECT {NO_HELPERS} FROM large"
ORACLES["large_iot"] = f"""WITH {IOT}, {iot_fill(IOT_NUMERIC)},
  tidy AS (SELECT iot.* REPLACE ({", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in IOT_NUMERIC)}) FROM iot, iot_med)
  SELECT *, {IOT_FEATURES} FROM tidy"""
GAPPY = f"""{IOT}, gappy AS (SELECT event_id, vehicle_tier,
  CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 THEN NULL ELSE speed_kmh END AS speed_kmh,
  CASE WHEN event_id % 5 <> 0 THEN engine_rpm END AS engine_rpm FROM iot)"""
ORACLES["median_impute"] = f"""WITH {GAPPY}, med AS (SELECT median(speed_kmh) AS s, median(engine_rpm) AS r FROM gappy)
  SELECT event_id, coalesce(speed_kmh, s) AS speed_kmh, coalesce(engine_rpm, r) AS engine_rpm FROM gappy, med"""
ORACLES["tier_median_impute"] = f"""WITH {GAPPY}, med AS (SELECT vehicle_tier, median(speed_kmh) AS s, median(engine_rpm) AS r FROM gappy GROUP BY ALL)
  SELECT event_id, vehicle_tier, coalesce(speed_kmh, s) AS speed_kmh, coalesce(engine_rpm, r) AS engine_rpm FROM gappy JOIN med USING (vehicle_tier)"""
RAW_TEXT = "' l&t ' || lower(p_name) || '-' || lower(p_type) || ' '"
ORACLES["text_normalize"] = f"""SELECT p_partkey, trim({title(RAW_TEXT)}) AS title_text, trim(upper({RAW_TEXT})) AS upper_text,
  {title("p_brand")} AS brand_title FROM part"""
ORACLES["parse_timestamps"] = """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'not a time'
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS text,
  CASE WHEN event_id % 9 <> 0 THEN ts END AS instant FROM events"""
ORACLES["etl_run_summary"] = f"""WITH {bk_tidy(True)}, marked AS (SELECT *, coalesce(distance_km > 0 AND freight_charge_inr > 0
    AND booking_id IS NOT NULL AND origin_city IS NOT NULL AND destination_city IS NOT NULL, false) AS ok FROM bk_first)
  SELECT (SELECT count(*) FROM bk) AS rows_in, (SELECT count(*) FROM bk) - count(*) AS duplicates_removed,
    count(*) FILTER (NOT ok) AS invalid_removed, count(*) FILTER (ok) AS rows_out,
    count(*) FILTER (ok AND delivery_status = 'DELAYED') AS delayed_orders,
    count(*) FILTER (ok AND priority = 'EXPRESS') AS express_orders,
    {pct("count(*) FILTER (ok AND delivery_status = 'DELAYED')", "count(*) FILTER (ok)")} AS delayed_pct FROM marked"""

# ---- features ----------------------------------------------------------------------------

ORACLES["bookings_features"] = f"WITH {BK_FEAT} SELECT {NO_HELPERS} FROM bk_feat"
CARGO_FLAGS = """CASE WHEN cargo_value_inr > 200000 THEN 1 ELSE 0 END AS is_high_value,
  CASE WHEN cargo_weight_kg > 8000 AND distance_km > 500 THEN 1 ELSE 0 END AS heavy_long_haul"""
EXPRESS = "(CASE WHEN priority = 'EXPRESS' THEN 1 ELSE 0 END)"


def interactions(r) -> str:
    return f"""{r("cargo_weight_kg * distance_km / 1e5", 2)} AS cargo_stress_index,
  {r("distance_km * cargo_weight_kg / 1e6", 4)} AS distance_cargo_risk, {r(f"{EXPRESS} * distance_km / 1e2", 2)} AS express_risk_score"""


TYPED = f"""{BK}, typed AS (SELECT * REPLACE (upper(trim(booking_id)) AS booking_id, trim(cargo_type) AS cargo_type,
    replace(upper(delivery_status), 'IN_TRANSIT', 'IN TRANSIT') AS delivery_status) FROM bk),
  sql_first AS (SELECT * EXCLUDE (rn) FROM (SELECT *, {FIRST} AS rn FROM typed) WHERE rn = 1),
  sql_clean AS (SELECT * REPLACE (coalesce(cargo_value_inr, 0) AS cargo_value_inr, coalesce(origin_delay_risk, 0) AS origin_delay_risk,
    coalesce(origin_has_severe, 0) AS origin_has_severe, replace(delivery_status, ' ', '') AS delivery_status)
    FROM sql_first WHERE distance_km > 0 AND freight_charge_inr > 0 AND cargo_weight_kg IS NOT NULL),
  sql_feat AS (SELECT *, {FLAGS}, {CARGO_FLAGS}, {sql_round("freight_charge_inr / distance_km", 2)} AS revenue_per_km,
    {interactions(sql_round)}, CASE WHEN cargo_value_inr <= 50000 THEN 'LOW' WHEN cargo_value_inr <= 200000 THEN 'MEDIUM' ELSE 'HIGH' END AS cargo_value_category
    FROM sql_clean)"""
ORACLES["spark_etl_features"] = f"WITH {TYPED} SELECT {NO_HELPERS} FROM sql_feat"
ORACLES["iot_features"] = f"WITH {IOT_FEAT} SELECT * FROM iot_feat"
# a tier's lowest share by interpolated quantile: so many of n different scores lie below it
ORACLES["iforest_rates"] = f"""WITH {IOT_FEAT} SELECT vehicle_tier, count(*) AS readings,
  CAST(ceil((count(*) - 1) * CASE vehicle_tier WHEN 'OLD' THEN 9 WHEN 'MID' THEN 5 WHEN 'NEW' THEN 2 END / 1e2) AS BIGINT) AS flagged
  FROM iot_feat GROUP BY 1"""
ORACLES["weather_features"] = f"WITH {WX_FEAT} SELECT * FROM wx_feat"
ML_BASE = f"""{BK_LARGE}, ml AS (SELECT *, is_delayed AS target, {CARGO_FLAGS}, {interactions(rnd)} FROM large)"""
CATS = ["origin_city", "destination_city", "cargo_type", "priority"]


def codes(source: str) -> str:
    parts = [
        f"""code_{c} AS (SELECT l, CAST(row_number() OVER (ORDER BY l) - 1 AS DOUBLE) AS code FROM (SELECT DISTINCT coalesce({c}, 'nan') AS l FROM {source}))"""
        for c in CATS
    ]
    return ", ".join(parts)


CODE_JOINS = " ".join(f"LEFT JOIN code_{c} ON coalesce({c}, 'nan') = code_{c}.l" for c in CATS)
CODE_COLS = ", ".join(f"code_{c}.code AS {c}_enc" for c in CATS)
ORACLES["ml_features"] = f"""WITH {ML_BASE}, {codes("ml")} SELECT booking_id, distance_km, cargo_weight_kg, cargo_value_inr,
  freight_charge_inr, is_express, is_long_haul, is_heavy_cargo, is_high_value, heavy_long_haul, revenue_per_km, cargo_stress_index,
  distance_cargo_risk, express_risk_score, {CODE_COLS}, target FROM ml {CODE_JOINS}"""
ORACLES["night_shift_flag"] = """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour_of_day,
  CASE WHEN hour(ts) >= 20 OR hour(ts) <= 5 THEN 1 ELSE 0 END AS is_night_shift FROM events"""
ORACLES["weather_risk_lookup"] = f"""WITH {WX}, c AS (SELECT event_id, city, CASE WHEN event_id % 17 = 0 THEN 'Hail' ELSE weather_condition END AS w FROM wx)
  SELECT event_id, CASE w WHEN 'Clear' THEN 5 WHEN 'Partly Cloudy' THEN 15 WHEN 'Overcast' THEN 25 WHEN 'Light Rain' THEN 40
      WHEN 'Heavy Rain' THEN 70 WHEN 'Thunderstorm' THEN 85 WHEN 'Fog' THEN CASE WHEN city IN ('mumbai', 'goa') THEN 80 ELSE 65 END
      ELSE 10 END AS risk,
    CASE WHEN w IN ('Thunderstorm', 'Fog', 'Heavy Rain') THEN 1 ELSE 0 END AS has_severe FROM c"""
ORACLES["road_condition"] = f"""WITH {WX} SELECT event_id, CASE WHEN rainfall_mm > 30 THEN 'Poor' WHEN rainfall_mm > 10 THEN 'Moderate' ELSE 'Good' END AS road_condition,
  CASE WHEN rainfall_mm > 50 THEN 1 ELSE 0 END AS is_flood, CASE WHEN weather_condition = 'Fog' THEN 1 ELSE 0 END AS is_fog FROM wx"""
ORACLES["delay_rules"] = f"""WITH {BK}, f AS (SELECT * FROM (SELECT *, {FIRST} AS rn FROM bk) WHERE rn = 1),
  m AS (SELECT booking_id, greatest(
    CASE WHEN origin_weather IN ('Thunderstorm', 'Fog') THEN 1 ELSE 0 END, CASE WHEN origin_weather = 'Heavy Rain' THEN 2 ELSE 0 END,
    CASE WHEN distance_km > 500 AND origin_delay_risk >= 40 THEN 3 ELSE 0 END, CASE WHEN priority = 'EXPRESS' AND cargo_weight_kg > 9000 THEN 4 ELSE 0 END,
    CASE WHEN l_partkey % 9 = 1 AND distance_km > 400 THEN 5 ELSE 0 END,
    CASE WHEN distance_km < 200 AND origin_weather IN ('Clear', 'Partly Cloudy') THEN 6 ELSE 0 END,
    CASE WHEN l_partkey % 9 = 0 THEN 7 ELSE 0 END) AS r FROM f)
  SELECT booking_id, CASE WHEN r = 0 THEN 8 ELSE CAST(r AS INTEGER) END AS rule,
    [0.45e0, 0.9e0, 0.75e0, 0.85e0, 0.8e0, 0.7e0, 0.92e0, 0.75e0][r + 1] AS share,
    CASE WHEN r BETWEEN 1 AND 5 THEN 'DELAYED' ELSE 'DELIVERED' END AS status FROM m"""
ORACLES["tier_from_id"] = """SELECT event_id, CASE WHEN (user_id * 7) % 50 + 1 <= 17 THEN 'OLD' WHEN (user_id * 7) % 50 + 1 <= 35 THEN 'MID' ELSE 'NEW' END AS tier FROM events"""

# ---- joins -------------------------------------------------------------------------------

POINTS = """pts(i, name, la, lo) AS (VALUES (0, 'Mumbai', 19.0760e0, 72.8777e0), (1, 'Pune', 18.5204e0, 73.8567e0), (2, 'Nashik', 19.9975e0, 73.7898e0),
  (3, 'Nagpur', 21.1458e0, 79.0882e0), (4, 'Aurangabad', 19.8762e0, 75.3433e0), (5, 'Kolhapur', 16.7050e0, 74.2433e0),
  (6, 'Goa', 15.2993e0, 74.1240e0), (7, 'Solapur', 17.6599e0, 75.9064e0))"""


def nearest(source: str, lat: str) -> str:
    d = f"sqrt(({lat} - la) * ({lat} - la) + (gps_longitude - lo) * (gps_longitude - lo))"
    return f"""near AS (SELECT event_id AS eid, coalesce(first(name ORDER BY {d}, i) FILTER (WHERE {d} IS NOT NULL), 'Mumbai') AS nearest_city
  FROM {source}, pts GROUP BY event_id)"""


ORACLES["weather_city_summary"] = f"WITH {WX_FEAT}, {CITY_WX} SELECT * FROM city_wx"
ORACLES["weather_origin_summary"] = f"WITH {WX_FEAT}, {ORIGIN_WX} SELECT * FROM origin_wx"
ORACLES["nearest_city"] = f"""WITH {IOT}, {POINTS}, {nearest("iot", "(CASE WHEN event_id % 10 <> 0 THEN gps_latitude END)")}
  SELECT eid AS event_id, nearest_city FROM near"""
ORACLES["iot_enriched"] = f"""WITH {IOT_FEAT}, {WX_FEAT}, {CITY_WX}, {POINTS}, {nearest("iot_feat", "gps_latitude")}
  SELECT iot_feat.*, near.nearest_city, city_wx.* EXCLUDE (nearest_city) FROM iot_feat JOIN near ON event_id = eid LEFT JOIN city_wx USING (nearest_city)"""
BRIDGE = f"(CASE WHEN s_nationkey < 24 THEN {CITY_LIST}[s_nationkey % 8 + 1] ELSE origin_city END)"
ORACLES["bookings_enriched"] = f"""WITH {BK_FEAT}, {WX_FEAT}, {ORIGIN_WX},
  b AS (SELECT * REPLACE ({BRIDGE} AS origin_city) FROM bk_feat), j AS (SELECT b.*, origin_wx.* EXCLUDE (origin_city) FROM b LEFT JOIN origin_wx USING (origin_city)),
  m AS (SELECT median(origin_delay_risk_w) AS a, median(origin_visibility_km) AS v, median(origin_congestion) AS c, median(origin_combined_risk) AS k FROM j)
  SELECT j.* EXCLUDE (l_partkey, l_suppkey, s_nationkey, c_nationkey) REPLACE (coalesce(origin_weather_w, 'Unknown') AS origin_weather_w,
    {rnd("coalesce(origin_delay_risk_w, a)", 6)} AS origin_delay_risk_w, {rnd("coalesce(origin_visibility_km, v)", 6)} AS origin_visibility_km,
    {rnd("coalesce(origin_congestion, c)", 6)} AS origin_congestion, {rnd("coalesce(origin_combined_risk, k)", 6)} AS origin_combined_risk) FROM j, m"""
ROUTES = """routes(a, b, km) AS (VALUES ('Mumbai','Pune',148),('Mumbai','Nashik',167),('Mumbai','Aurangabad',335),('Mumbai','Nagpur',834),
  ('Mumbai','Goa',594),('Mumbai','Solapur',455),('Pune','Nashik',211),('Pune','Aurangabad',233),('Pune','Nagpur',714),('Pune','Kolhapur',228),
  ('Pune','Solapur',248),('Nashik','Nagpur',668),('Nashik','Aurangabad',183),('Nagpur','Aurangabad',503),('Kolhapur','Mumbai',373),
  ('Goa','Pune',453),('Solapur','Nagpur',494),('Aurangabad','Kolhapur',393))"""
ORACLES["route_distance"] = f"""WITH {BK}, {ROUTES}, f AS (SELECT booking_id, {BRIDGE} AS origin_city, {CITY_LIST}[c_nationkey % 8 + 1] AS destination_city
    FROM (SELECT *, {FIRST} AS rn FROM bk) WHERE rn = 1)
  SELECT f.*, CAST(km AS DOUBLE) AS route_km FROM f LEFT JOIN routes ON (origin_city = a AND destination_city = b) OR (origin_city = b AND destination_city = a)"""

# ---- aggregates --------------------------------------------------------------------------

FLEET = f"""SELECT count(DISTINCT vehicle_id) AS total_vehicles, count(*) AS total_readings, {rnd("avg(speed_kmh)", 2)} AS avg_speed_kmh,
  {rnd("max(speed_kmh)", 2)} AS max_speed_kmh, {rnd("avg(fuel_level_pct)", 2)} AS avg_fuel_level_pct,
  {rnd("avg(engine_health_score)", 2)} AS avg_engine_health, {rnd("avg(fuel_efficiency_kmpl)", 2)} AS avg_fuel_efficiency_kmpl"""
ORACLES["fleet_kpis"] = f"WITH {IOT_FEAT} {FLEET} FROM iot_feat"
THREE_AVGS = f"""{rnd("avg(speed_kmh)", 2)} AS avg_speed, {rnd("avg(fuel_level_pct)", 2)} AS avg_fuel, {rnd("avg(engine_health_score)", 2)} AS avg_health"""
ORACLES["tier_breakdown"] = f"WITH {IOT_FEAT} SELECT vehicle_tier, count(vehicle_id) AS reading_count, {THREE_AVGS} FROM iot_feat GROUP BY vehicle_tier"
ORACLES["speed_distribution"] = f"WITH {IOT_FEAT} SELECT speed_category, count(*) AS reading_count FROM iot_feat GROUP BY 1"
ORACLES["vehicle_summary"] = f"""WITH {IOT_FEAT} SELECT vehicle_id, min(vehicle_tier) AS tier, {THREE_AVGS}, count(speed_kmh) AS total_readings
  FROM iot_feat GROUP BY vehicle_id"""
ORACLES["tier_performance"] = f"""WITH {IOT_FEAT} SELECT vehicle_tier, count(vehicle_id) AS total_readings, {THREE_AVGS},
  {rnd("avg(fuel_efficiency_kmpl)", 2)} AS avg_efficiency, count(DISTINCT vehicle_id) AS vehicle_count,
  CASE vehicle_tier WHEN 'OLD' THEN 9e0 WHEN 'MID' THEN 5e0 WHEN 'NEW' THEN 2e0 END AS anomaly_rate_pct,
  CASE vehicle_tier WHEN 'OLD' THEN 'Poor' WHEN 'MID' THEN 'Average' WHEN 'NEW' THEN 'Excellent' END AS health_status FROM iot_feat GROUP BY vehicle_tier"""


def status_count(s: str) -> str:
    return f"count(*) FILTER (delivery_status = '{s}')"


DELIVERY = f"""SELECT count(*) AS total_orders, {status_count("DELIVERED")} AS total_delivered, {status_count("DELAYED")} AS total_delayed,
  {status_count("CANCELLED")} AS total_cancelled, {status_count("IN_TRANSIT")} AS total_in_transit, {status_count("BOOKED")} AS total_booked,
  {rnd("sum(freight_charge_inr)", 0)} AS total_revenue_inr, {rnd("avg(freight_charge_inr)", 0)} AS avg_freight_charge_inr,
  {rnd("avg(distance_km)", 1)} AS avg_distance_km, count(*) FILTER (priority = 'EXPRESS') AS express_orders,
  {pct(status_count("DELIVERED"), "count(*)")} AS on_time_rate_pct, {pct(status_count("DELAYED"), "count(*)")} AS delay_rate_pct,
  {pct(status_count("CANCELLED"), "count(*)")} AS cancellation_rate_pct, {pct("count(*) FILTER (priority = 'EXPRESS')", "count(*)")} AS express_pct"""
ORACLES["delivery_kpis"] = f"WITH {BK_LARGE} {DELIVERY} FROM large"
ORACLES["top_routes"] = f"""WITH {BK_LARGE} SELECT origin_city, destination_city, sum(freight_charge_inr) AS total_revenue, count(freight_charge_inr) AS order_count
  FROM large GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10"""
ORACLES["delay_by_cargo_top5"] = f"""WITH {BK_LARGE} SELECT cargo_type, count(*) AS delayed_orders FROM large WHERE delivery_status = 'DELAYED'
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
ORACLES["revenue_by_city"] = f"WITH {BK_LARGE} SELECT origin_city, {rnd('sum(freight_charge_inr)', 0)} AS total_revenue FROM large GROUP BY 1"
ORACLES["route_analysis"] = f"""WITH {BK_LARGE} SELECT origin_city, destination_city, count(booking_id) AS total_orders,
  {rnd("sum(freight_charge_inr)", 0)} AS total_revenue, {rnd("avg(distance_km)", 1)} AS avg_distance, CAST(sum(is_delayed) AS BIGINT) AS delay_count,
  {rnd("avg(cargo_weight_kg)", 1)} AS avg_weight, {rnd("CAST(sum(is_delayed) AS DOUBLE) / count(booking_id) * 1e2", 1)} AS delay_rate_pct,
  origin_city || ' to ' || destination_city AS route FROM large GROUP BY 1, 2"""
# the same on bookings with gaps, which count as 0
GAPS = f"""{BK_LARGE}, gaps AS (SELECT * REPLACE (CASE WHEN booking_id LIKE '%-3' THEN 0 ELSE freight_charge_inr END AS freight_charge_inr,
  CASE WHEN booking_id LIKE '%-5' THEN 0 ELSE distance_km END AS distance_km) FROM large)"""
ORACLES["delivery_kpis_gaps"] = f"WITH {GAPS} {DELIVERY} FROM gaps"
for _name in ("top_routes", "route_analysis", "revenue_by_city"):
    ORACLES[f"{_name}_gaps"] = ORACLES[_name].replace(f"WITH {BK_LARGE}", f"WITH {GAPS}").replace("FROM large GROUP", "FROM gaps GROUP").replace("FROM large\n", "FROM gaps\n")
ORACLES["status_breakdown"] = f"""WITH {TYPED}, n AS (SELECT delivery_status, count(*) AS order_count FROM sql_feat GROUP BY 1)
  SELECT delivery_status, order_count, {sql_round("order_count * 1e2 / (SELECT sum(order_count) FROM n)", 1)} AS pct FROM n"""
DELAYED_PCT = sql_round("sum(is_delayed) * 1e2 / count(*)", 1)
ORACLES["city_revenue_top5"] = f"""WITH {TYPED} SELECT origin_city, count(*) AS total_orders, {sql_round("sum(freight_charge_inr)", 0)} AS total_revenue,
  {sql_round("avg(distance_km)", 1)} AS avg_distance_km, {DELAYED_PCT} AS delay_rate_pct FROM sql_feat GROUP BY 1 ORDER BY total_revenue DESC, origin_city LIMIT 5"""
ORACLES["delay_by_priority"] = f"""WITH {TYPED} SELECT priority, count(*) AS total_orders, CAST(sum(is_delayed) AS BIGINT) AS delayed_orders,
  {DELAYED_PCT} AS delay_rate_pct, {sql_round("avg(freight_charge_inr)", 0)} AS avg_freight_inr FROM sql_feat GROUP BY 1"""
ORACLES["delay_by_cargo"] = f"""WITH {TYPED} SELECT cargo_type, count(*) AS total_orders, CAST(sum(is_delayed) AS BIGINT) AS delayed_orders,
  {DELAYED_PCT} AS delay_rate_pct FROM sql_feat GROUP BY 1"""
ORACLES["booking_kpis"] = f"""WITH {TYPED} SELECT count(booking_id) AS total_orders, CAST(sum(is_delayed) AS BIGINT) AS total_delayed,
  sum(freight_charge_inr) AS total_revenue, {rnd("avg(distance_km)", 4)} AS avg_distance, {rnd("avg(freight_charge_inr)", 4)} AS avg_freight,
  CAST(sum(is_express) AS BIGINT) AS express_orders, {pct("sum(is_delayed)", "count(booking_id)")} AS delay_rate_pct,
  {pct("sum(is_express)", "count(booking_id)")} AS express_pct FROM sql_feat"""
ORACLES["class_balance"] = f"""WITH {BK_LARGE} SELECT is_delayed AS target, count(*) AS class_count, {pct("count(*)", "(SELECT count(*) FROM large)")} AS pct
  FROM large GROUP BY 1"""
ORACLES["anomalous_vehicles"] = f"""WITH {IOT_FLAG} SELECT vehicle_id, min(vehicle_tier) AS vehicle_tier, CAST(sum(hit) AS BIGINT) AS anomaly_count,
  {pct("sum(hit)", "count(*)")} AS anomaly_rate_pct, {rnd("avg(speed_kmh)", 1)} AS avg_speed, {rnd("avg(fuel_level_pct)", 1)} AS avg_fuel_pct
  FROM flagged GROUP BY 1 HAVING sum(hit) > 0 ORDER BY 3 DESC, 1 LIMIT 10"""
ORACLES["tier_anomaly_rate"] = f"""WITH {IOT_FLAG} SELECT t AS vehicle_tier, count(*) FILTER (hit = 1) AS anomaly_count,
  {pct("count(*) FILTER (hit = 1)", "count(vehicle_tier)")} AS anomaly_rate_pct
  FROM (VALUES ('OLD'), ('MID'), ('NEW')) AS tiers(t) LEFT JOIN flagged ON vehicle_tier = t GROUP BY t"""
ORACLES["sensor_compare"] = f"""WITH {IOT_FLAG}, long AS (UNPIVOT (SELECT hit, speed_kmh, fuel_level_pct, engine_rpm, battery_voltage FROM flagged)
    ON speed_kmh, fuel_level_pct, engine_rpm, battery_voltage INTO NAME sensor VALUE v)
  SELECT sensor, {rnd("avg(v) FILTER (hit = 0)", 2)} AS normal_avg, {rnd("avg(v) FILTER (hit = 1)", 2)} AS anomaly_avg FROM long GROUP BY 1"""
HEALTHY = f"""SELECT count(*) AS total_records, count(*) FILTER (hit = 1) AS anomaly, count(*) FILTER (hit = 0) AS normal,
  {pct("count(*) FILTER (hit = 0)", "count(*)")} AS healthy_pct, {pct("count(*) FILTER (hit = 1)", "count(*)")} AS anomaly_pct"""
ORACLES["fleet_health"] = f"WITH {IOT_FLAG} {HEALTHY} FROM flagged"


def kpi_rows(source: str, rows: list[tuple[str, str, str]], category: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS \"KPI\", CAST({col} AS DOUBLE) AS \"Value\", '{unit}' AS \"Unit\", '{category}' AS \"Category\" FROM {source}"
        for label, col, unit in rows
    )


ORACLES["kpi_summary"] = f"""WITH {IOT_FLAG}, {BK_LARGE}, fk AS ({FLEET} FROM flagged), fh AS ({HEALTHY} FROM flagged), dk AS ({DELIVERY} FROM large)
  {kpi_rows("fk", [("Total Vehicles", "total_vehicles", "vehicles"), ("Avg Speed", "avg_speed_kmh", "km/h"), ("Avg Fuel Level", "avg_fuel_level_pct", "%"),
    ("Avg Engine Health", "avg_engine_health", "/100")], "Fleet")} UNION ALL
  {kpi_rows("fh", [("Fleet Health", "healthy_pct", "%"), ("Anomalies Detected", "anomaly", "readings"), ("Anomaly Rate", "anomaly_pct", "%")], "Fleet")} UNION ALL
  {kpi_rows("dk", [("Total Orders", "total_orders", "orders"), ("Total Delivered", "total_delivered", "orders"), ("Total Delayed", "total_delayed", "orders"),
    ("On-Time Rate", "on_time_rate_pct", "%"), ("Delay Rate", "delay_rate_pct", "%"), ("Total Revenue", "total_revenue_inr", "INR"),
    ("Avg Freight Charge", "avg_freight_charge_inr", "INR"), ("Express Orders", "express_orders", "orders")], "Delivery")}"""
ORACLES["fleet_extract"] = f"""WITH {IOT_FEAT} SELECT vehicle_id, vehicle_tier, speed_kmh, fuel_level_pct, fuel_efficiency_kmpl, engine_health_score,
    cargo_weight_kg, engine_rpm, speed_category, fuel_status, CASE WHEN speed_kmh > 100 THEN 1 ELSE 0 END AS is_anomaly,
    CASE WHEN speed_kmh > 110 THEN 'CRITICAL' WHEN speed_kmh > 100 THEN 'WARNING' ELSE 'NONE' END AS alert_severity
  FROM iot_feat"""
ORACLES["delivery_extract"] = f"""WITH {BK_LARGE} SELECT booking_id, origin_city, destination_city, cargo_type, delivery_status, priority, distance_km,
    freight_charge_inr, cargo_weight_kg, cargo_value_inr, is_delayed, is_express, is_long_haul
  FROM large"""

# ---- quality -----------------------------------------------------------------------------


def check(table: str, name: str, bad: str, fail: str, detail: str, source: str, failing: str | None = None) -> str:
    return f"""SELECT '{table}' AS table_name, '{name}' AS check_name, CASE WHEN {failing or f"({bad}) > 0"} THEN '{fail}' ELSE 'PASSED' END AS status,
  CAST({bad} AS BIGINT) AS violations, {detail} AS detail FROM {source}"""


def breakdown(table: str, column: str, source: str) -> str:
    return f"""SELECT '{table}', '{column}: ' || {column}, 'INFO', CAST(0 AS BIGINT), CAST(count(*) AS VARCHAR) FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


ORACLES["dq_bookings"] = f"""WITH {bk_tidy(True)}
  {check("bookings", "booking_id unique", "count(*) - count(DISTINCT booking_id)", "WARNING", "CAST(count(DISTINCT booking_id) AS VARCHAR) || ' distinct'", "bk_tidy")}
  UNION ALL {check("bookings", "delivery_status valid", "count(*) FILTER (NOT coalesce(delivery_status IN ('BOOKED','IN_TRANSIT','DELIVERED','DELAYED','CANCELLED'), false))", "WARNING", "'allowed values'", "bk_tidy")}
  UNION ALL {check("bookings", "freight not negative", "count(*) FILTER (freight_charge_inr < 0)", "FAILED", "'freight_charge_inr >= 0'", "bk_tidy")}
  UNION ALL {breakdown("bookings", "delivery_status", "bk_tidy")}"""
TIER_N = "(count(DISTINCT vehicle_tier) + max(CAST(vehicle_tier IS NULL AS INTEGER)))"
ORACLES["dq_iot"] = f"""WITH {IOT}
  {check("iot", "vehicle_id present", "count(*) FILTER (vehicle_id IS NULL)", "FAILED", "'no null ids'", "iot")}
  UNION ALL {check("iot", "speed at most 150", "count(*) FILTER (speed_kmh > 150)", "WARNING", "'speed_kmh <= 150'", "iot")}
  UNION ALL {check("iot", "several tiers", f"CASE WHEN {TIER_N} < 2 THEN 1 ELSE 0 END", "WARNING", f"CAST({TIER_N} AS VARCHAR) || ' tiers'", "iot")}
  UNION ALL {check("iot", "no future readings", "count(*) FILTER (timestamp > TIMESTAMP '2024-01-20 00:00:00')", "WARNING", "'timestamp <= as_of'", "iot")}"""
ORACLES["dq_weather"] = f"""WITH {WX_FEAT}
  {check("weather", "all cities present", "CASE WHEN count(DISTINCT city) <> 8 THEN 1 ELSE 0 END", "WARNING", "CAST(count(DISTINCT city) AS VARCHAR) || ' cities'", "wx_feat")}
  UNION ALL {check("weather", "temperature in 5-50", "count(*) FILTER (NOT coalesce(temperature_C BETWEEN 5 AND 50, false))", "WARNING", "'temperature_C'", "wx_feat")}
  UNION ALL {check("weather", "risk in 0-100", "count(*) FILTER (NOT coalesce(delay_risk_score BETWEEN 0 AND 100, false))", "FAILED", "'delay_risk_score'", "wx_feat")}
  UNION ALL {breakdown("weather", "weather_condition", "wx_feat")}"""

# ---- sampling, scaling, measures ---------------------------------------------------------


def hash8(seed: int, key: str) -> str:
    return f"substr(md5('{seed}:' || {key}), 1, 8)"


SPLIT = f"""{BK_LARGE}, split AS (SELECT booking_id, is_delayed AS target, {hash8(42, "booking_id")} < '33333333' AS is_test FROM large)"""


def balanced(factor: str) -> str:
    return f"""WITH {SPLIT}, train AS (SELECT * FROM split WHERE NOT is_test),
  n AS (SELECT least(count(*) FILTER (target = 1) * {factor}, count(*) FILTER (target = 0)) / count(*) FILTER (target = 0) AS share FROM train),
  mark AS (SELECT CASE WHEN share >= 1 THEN 'g' ELSE lpad(lower(to_hex(CAST(floor(share * 4294967296e0) AS BIGINT))), 8, '0') END AS edge FROM n)
  SELECT booking_id, target FROM train, mark WHERE target = 1 OR {hash8(43, "booking_id")} < edge"""


ORACLES["stratified_split"] = f"WITH {SPLIT} SELECT * FROM split"
ORACLES["balanced_train"] = balanced("2e0")
ORACLES["balanced_train_even"] = balanced("1e0")
ORACLES["label_encode"] = f"""WITH {BK_LARGE}, le AS (SELECT booking_id, origin_city, destination_city,
    CASE WHEN length(booking_id) % 10 <> 0 THEN cargo_type END AS cargo_type, priority FROM large), {codes("le")}
  SELECT le.*, {CODE_COLS} FROM le {CODE_JOINS}"""
SCALED = ["speed_kmh", "engine_rpm", "battery_voltage"]


def z(c: str, over: str = "()") -> str:
    return rnd(f"({c} - avg({c}) OVER {over}) / (CASE WHEN stddev_pop({c}) OVER {over} = 0 THEN 1 ELSE stddev_pop({c}) OVER {over} END)", 6) + f" AS {c}"


ORACLES["standard_scale"] = f"WITH {IOT_FEAT} SELECT event_id, {', '.join(z(c) for c in SCALED)}, 0e0 AS constant FROM iot_feat"
TIER_Z = ", ".join(z(c, "(PARTITION BY vehicle_tier)") for c in SCALED)
ORACLES["tier_scale"] = f"WITH {IOT_FEAT} SELECT event_id, vehicle_tier, {TIER_Z} FROM iot_feat"
ORACLES["class_weights"] = f"""WITH {BK_LARGE}, n AS (SELECT count(*) FILTER (is_delayed = 0) AS n0, count(*) FILTER (is_delayed = 1) AS n1 FROM large)
  SELECT label, CASE label WHEN 0 THEN n0 ELSE n1 END AS class_count, {rnd("(n0 + n1) / (2e0 * CASE label WHEN 0 THEN n0 ELSE n1 END)", 6)} AS balanced_weight,
    {rnd("CAST(n0 AS DOUBLE) / n1", 6)} AS positive_weight FROM n, (VALUES (0), (1)) AS l(label)"""
SCORED = f"{ML_BASE}, scored AS (SELECT booking_id, priority, target, cargo_stress_index AS score, distance_cargo_risk AS score_b FROM ml)"
COUNTS = """count(*) FILTER (score >= 20 AND target = 1) AS true_positives, count(*) FILTER (score < 20 AND target = 1) AS false_negatives,
  count(*) FILTER (score >= 20 AND target = 0) AS false_positives, count(*) FILTER (score < 20 AND target = 0) AS true_negatives"""
TWO_PCTS = f"""{rnd("(true_positives + true_negatives) / CAST(true_positives + true_negatives + false_positives + false_negatives AS DOUBLE) * 1e2", 2)} AS accuracy_pct,
  coalesce({rnd("true_positives / nullif(CAST(true_positives + false_negatives AS DOUBLE), 0) * 1e2", 2)}, 0e0) AS recall_pct"""
ORACLES["confusion_metrics"] = f"""WITH {SCORED}, c AS (SELECT priority, {COUNTS} FROM scored GROUP BY priority) SELECT *, {TWO_PCTS} FROM c"""


def mann_whitney(source: str, by: str) -> str:
    return f"""(SELECT {by}, (sum(r) FILTER (target = 1) - count(*) FILTER (target = 1) * (count(*) FILTER (target = 1) + 1) / 2e0)
    / (CAST(count(*) FILTER (target = 1) AS DOUBLE) * count(*) FILTER (target = 0)) AS auc
  FROM (SELECT {by}, target, rank() OVER (PARTITION BY {by} ORDER BY score) + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2e0 AS r FROM {source}) GROUP BY {by})"""


ORACLES["auc"] = f"WITH {SCORED} SELECT priority, {rnd('auc', 9)} AS auc FROM {mann_whitney('scored', 'priority')}"
ORACLES["classification_report"] = f"""WITH {SCORED}, c AS (SELECT {COUNTS} FROM scored),
  m AS (SELECT 'On Time' AS class, coalesce(true_negatives / nullif(CAST(true_negatives + false_negatives AS DOUBLE), 0), 0) AS precision,
      coalesce(true_negatives / nullif(CAST(true_negatives + false_positives AS DOUBLE), 0), 0) AS recall, true_negatives + false_positives AS support FROM c
    UNION ALL SELECT 'Delayed', coalesce(true_positives / nullif(CAST(true_positives + false_positives AS DOUBLE), 0), 0),
      coalesce(true_positives / nullif(CAST(true_positives + false_negatives AS DOUBLE), 0), 0), true_positives + false_negatives FROM c),
  f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m),
  every AS (SELECT * FROM f UNION ALL SELECT 'macro avg', avg(precision), avg(recall), CAST(sum(support) AS BIGINT), avg(f1) FROM f
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), CAST(sum(support) AS BIGINT), sum(f1 * support) / sum(support) FROM f)
  SELECT class, {rnd("precision", 4)} AS precision, {rnd("recall", 4)} AS recall, {rnd("f1", 4)} AS f1, support FROM every"""
ORACLES["model_select"] = f"""WITH {SCORED}, both_models AS (SELECT 'stress' AS model, target, score FROM scored UNION ALL SELECT 'risk x 40', target, score_b * 40 FROM scored),
  c AS (SELECT model, {COUNTS} FROM both_models GROUP BY model), p AS (SELECT *, {TWO_PCTS} FROM c),
  a AS (SELECT model, {rnd("auc * 1e2", 2)} AS auc_pct FROM {mann_whitney("both_models", "model")})
  SELECT p.*, auc_pct, {rnd("4e-1 * auc_pct + 6e-1 * recall_pct", 4)} AS selection_score FROM p JOIN a USING (model) ORDER BY selection_score DESC, model LIMIT 1"""
ORACLES["contamination_cut"] = f"""WITH {IOT_FEAT}, s AS (SELECT event_id, vehicle_tier, engine_health_score + speed_kmh / 7 AS score FROM iot_feat),
  q AS (SELECT vehicle_tier, CASE vehicle_tier WHEN 'OLD' THEN quantile_cont(score, 0.09) WHEN 'MID' THEN quantile_cont(score, 0.05)
    WHEN 'NEW' THEN quantile_cont(score, 0.02) ELSE quantile_cont(score, 0.05) END AS cut FROM s GROUP BY vehicle_tier)
  SELECT event_id, vehicle_tier, CASE WHEN score < cut THEN 1 ELSE 0 END AS is_low FROM s JOIN q USING (vehicle_tier)"""

# ---- alarms, metrics, streams ------------------------------------------------------------

SERIES = f"""SELECT event_type AS metric, time_bucket(INTERVAL 300 SECONDS, ts) AS period_start, {rnd("avg(value)", 6)} AS average,
  {rnd("sum(value)", 6)} AS total, count(value) AS samples FROM events GROUP BY 1, 2"""
ORACLES["metric_series"] = SERIES
ORACLES["stream_fleet_metrics"] = SERIES
ORACLES["stream_weather_features"] = ORACLES["weather_features"]
ORACLES["alarm_states"] = f"""WITH rules(alarm, metric, op, threshold, stat, period, periods, missing) AS (VALUES
    ('Click-Low', 'click', '<', 20e0, 'Average', 300, 2, false), ('View-High', 'view', '>', 30e0, 'Average', 300, 2, false),
    ('Error-Missing', 'error', '<', 5e0, 'Average', 300, 1, true), ('Signup-Low', 'signup', '<', 18e0, 'Average', 3600, 1, false),
    ('Purchase-Spike', 'purchase', '>', 150e0, 'Sum', 3600, 2, false)),
  samples AS (SELECT alarm, CAST(floor(epoch(ts) / period) * period AS BIGINT) AS b, avg(value) AS a, sum(value) AS s
    FROM events JOIN rules ON event_type = metric GROUP BY 1, 2),
  grid AS (SELECT rules.*, unnest(generate_series(lo, hi, period)) AS b FROM rules JOIN (SELECT alarm, min(b) AS lo, max(b) AS hi FROM samples GROUP BY 1) USING (alarm)),
  v AS (SELECT grid.*, {rnd("CASE WHEN stat = 'Sum' THEN s ELSE a END", 6)} AS value FROM grid LEFT JOIN samples USING (alarm, b)),
  j AS (SELECT *, CASE WHEN value IS NULL THEN CAST(missing AS INTEGER) WHEN op = '<' THEN CAST(value < threshold AS INTEGER)
    ELSE CAST(value > threshold AS INTEGER) END AS breach FROM v),
  k AS (SELECT *, lag(breach, 1, 0) OVER (PARTITION BY alarm ORDER BY b) AS before FROM j)
  SELECT alarm, metric, make_timestamp(b * 1000000) AS period_start, value, breach,
    CASE WHEN breach = 1 AND (periods = 1 OR before = 1) THEN 'ALARM' ELSE 'OK' END AS state FROM k"""
ORACLES["stream_iot_features"] = f"""WITH {IOT}, iot_clean AS (SELECT iot.* REPLACE (trim(upper(vehicle_id)) AS vehicle_id, trim(upper(vehicle_tier)) AS vehicle_tier,
    coalesce(upper(brake_status), 'UNKNOWN') AS brake_status) FROM iot WHERE speed_kmh >= 0 AND fuel_level_pct BETWEEN 0 AND 100 AND engine_temp_C BETWEEN 50 AND 135)
  SELECT *, {IOT_FEATURES}, CASE WHEN engine_temp_C > 108 OR fuel_level_pct < 15 THEN 'CRITICAL'
    WHEN alert_flag OR brake_status = 'WARN' OR engine_temp_C > 100 THEN 'WARNING' ELSE 'NONE' END AS alert_severity FROM iot_clean"""
ORACLES["stream_iot_enriched"] = ORACLES["iot_enriched"]
ORACLES["stream_first_orders"] = "SELECT DISTINCT 'BK' || l_orderkey || '-' || l_linenumber AS booking_id FROM lineitem"
ORACLES["published_metrics"] = f"""WITH {IOT_FLAG}, {BK_LARGE}, fk AS ({FLEET} FROM flagged), fh AS ({HEALTHY} FROM flagged), dk AS ({DELIVERY} FROM large),
  m(metric, value, unit, dimension) AS (
    SELECT 'RecordsIngested', CAST(count(*) AS DOUBLE), 'Count', 'Pipeline=Ingestion' FROM bk
    UNION ALL SELECT 'IngestionSuccessRate', {rnd("count(booking_id) * 1e2 / count(*)", 1)}, 'Percent', 'Pipeline=Ingestion' FROM bk
    UNION ALL SELECT 'RecordsProcessed', CAST(count(*) AS DOUBLE), 'Count', 'Pipeline=ETL' FROM large
    UNION ALL SELECT 'ETLSuccessRate', {rnd("count(*) * 1e2 / (SELECT count(*) FROM bk)", 1)}, 'Percent', 'Pipeline=ETL' FROM large
    UNION ALL SELECT 'AnomaliesDetected', CAST(anomaly AS DOUBLE), 'Count', 'Pipeline=ML' FROM fh
    UNION ALL SELECT 'FleetHealthScore', healthy_pct, 'Percent', 'Fleet=Fleet' FROM fh
    UNION ALL SELECT 'ActiveVehicles', CAST(total_vehicles AS DOUBLE), 'Count', 'Fleet=Fleet' FROM fk
    UNION ALL SELECT 'DelayRate', delay_rate_pct, 'Percent', 'Delivery=Delivery' FROM dk
    UNION ALL SELECT 'TotalOrders', CAST(total_orders AS DOUBLE), 'Count', 'Delivery=Delivery' FROM dk
    UNION ALL SELECT 'TotalRevenue', total_revenue_inr, 'Count', 'Delivery=Delivery' FROM dk) SELECT * FROM m"""

SENSORS = ["speed_kmh", "fuel_level_pct", "engine_rpm", "battery_voltage", "tyre_pressure_psi", "cargo_weight_kg", "engine_health_score", "fuel_efficiency_kmpl"]
LOF_POINTS = ", ".join(f"round_even(({c} - m_{c}) / (CASE WHEN d_{c} = 0 THEN 1e0 ELSE d_{c} END) * 1e6, 0) AS {c}" for c in SENSORS)
LOF_D2 = " + ".join(f"(p.{c} - q.{c}) * (p.{c} - q.{c})" for c in SENSORS)
ORACLES["lof"] = f"""WITH {IOT_FEAT}, st AS (SELECT vehicle_tier AS tier, {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in SENSORS)} FROM iot_feat GROUP BY 1),
  pt AS (SELECT vehicle_tier AS tier, event_id, {LOF_POINTS} FROM iot_feat JOIN st ON vehicle_tier = tier),
  e AS (SELECT a, b, sqrt(d2) AS d FROM (SELECT p.event_id AS a, q.event_id AS b, {LOF_D2} AS d2 FROM pt p JOIN pt q ON p.tier = q.tier AND p.event_id <> q.event_id)
    QUALIFY row_number() OVER (PARTITION BY a ORDER BY d2, b) <= 20),
  kd AS (SELECT a AS b, max(d) AS far FROM e GROUP BY 1),
  dn AS (SELECT a, 1e0 / (avg(greatest(far, d)) + 1e-10) AS density FROM e JOIN kd USING (b) GROUP BY a),
  f AS (SELECT e.a AS event_id, avg(nb.density) / any_value(dn.density) AS lof FROM e JOIN dn nb ON nb.a = e.b JOIN dn ON dn.a = e.a GROUP BY e.a),
  s AS (SELECT tier, event_id, lof FROM pt LEFT JOIN f USING (event_id)),
  cuts AS (SELECT tier, CASE tier WHEN 'OLD' THEN quantile_cont(-lof, 0.09) WHEN 'MID' THEN quantile_cont(-lof, 0.05) WHEN 'NEW' THEN quantile_cont(-lof, 0.02)
    ELSE quantile_cont(-lof, 0.05) END AS cut FROM s GROUP BY 1)
  SELECT tier, event_id, {rnd("lof", 4)} AS lof, CASE WHEN -lof < cut THEN 1 ELSE 0 END AS lof_anomaly FROM s JOIN cuts USING (tier)"""
