"""Source schemas and the step that brings any frame to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, DOUBLE, INT, TIMESTAMP, BOOLEAN = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampType(), T.BooleanType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Columns and types of the three sources.
BOOKINGS = _struct(
    booking_id=STRING,
    customer_name=STRING,
    origin_city=STRING,
    destination_city=STRING,
    cargo_type=STRING,
    cargo_weight_kg=DOUBLE,
    cargo_value_inr=DOUBLE,
    assigned_vehicle_id=STRING,
    booking_timestamp=TIMESTAMP,
    estimated_delivery=TIMESTAMP,
    delivery_status=STRING,
    distance_km=DOUBLE,
    freight_charge_inr=DOUBLE,
    priority=STRING,
    is_insured=BOOLEAN,
    origin_weather=STRING,
    origin_delay_risk=DOUBLE,
    origin_has_severe=INT,
)
IOT = _struct(
    vehicle_id=STRING,
    vehicle_tier=STRING,
    driver_name=STRING,
    route=STRING,
    route_distance_km=DOUBLE,
    timestamp=TIMESTAMP,
    hour_of_day=INT,
    is_night_shift=INT,
    gps_latitude=DOUBLE,
    gps_longitude=DOUBLE,
    speed_kmh=DOUBLE,
    fuel_level_pct=DOUBLE,
    fuel_consumed_L=DOUBLE,
    engine_temp_C=DOUBLE,
    engine_rpm=DOUBLE,
    odometer_km=DOUBLE,
    battery_voltage=DOUBLE,
    tyre_pressure_psi=DOUBLE,
    cargo_weight_kg=DOUBLE,
    brake_status=STRING,
    ignition_status=STRING,
    alert_flag=BOOLEAN,
)
WEATHER = _struct(
    city=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    timestamp=TIMESTAMP,
    weather_condition=STRING,
    temperature_C=DOUBLE,
    humidity_pct=DOUBLE,
    wind_speed_kmh=DOUBLE,
    wind_direction=STRING,
    rainfall_mm=DOUBLE,
    visibility_km=DOUBLE,
    road_condition=STRING,
    fog_alert=BOOLEAN,
    flood_alert=BOOLEAN,
    delay_risk_score=DOUBLE,
    traffic_congestion=DOUBLE,
    usd_inr_rate=DOUBLE,
    data_source=STRING,
)

# What a bookings feed without these columns is given.
BOOKING_DEFAULTS = {
    "origin_has_severe": 0,
    "origin_delay_risk": 0.0,
    "origin_weather": "Clear",
    "customer_name": "Unknown Customer",
    "assigned_vehicle_id": "Unassigned",
    "is_insured": True,
}


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns read as text, for feeds whose numbers may be unreadable."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Select exactly the schema's columns: cast leniently, add absent ones (default or NULL)."""
    defaults = defaults or {}
    present = set(df.columns)

    def pick(f: T.StructField):
        if f.name not in present:
            return F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)
        value = F.col(f.name)
        if df.schema[f.name].dataType == f.dataType:
            return value
        if isinstance(f.dataType, T.IntegerType):
            return value.try_cast("double").try_cast("int").alias(f.name)
        return value.try_cast(f.dataType).alias(f.name)

    return df.select(*[pick(f) for f in schema])
