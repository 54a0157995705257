"""Names, thresholds and lookup entries that results depend on."""

# --- fixed values: cities -----------------------------------------------------------------
# (name, latitude, longitude); the first city is also the answer for a missing position.
CITIES = [
    ("Mumbai", 19.0760, 72.8777),
    ("Pune", 18.5204, 73.8567),
    ("Nashik", 19.9975, 73.7898),
    ("Nagpur", 21.1458, 79.0882),
    ("Aurangabad", 19.8762, 75.3433),
    ("Kolhapur", 16.7050, 74.2433),
    ("Goa", 15.2993, 74.1240),
    ("Solapur", 17.6599, 75.9064),
]

# --- fixed values: weather ----------------------------------------------------------------
CONDITION_RISK = {
    "Clear": 5,
    "Partly Cloudy": 15,
    "Overcast": 25,
    "Light Rain": 40,
    "Heavy Rain": 70,
    "Fog": 65,
    "Thunderstorm": 85,
}
UNKNOWN_CONDITION_RISK = 10
SEVERE_CONDITIONS = ["Thunderstorm", "Fog", "Heavy Rain"]
FOG_RISK_CITIES = ["Mumbai", "Goa"]
FOG_RISK_EXTRA = 15

# --- fixed values: routes (one direction is listed, both are meant) -----------------------
ROUTE_KM = [
    ("Mumbai", "Pune", 148),
    ("Mumbai", "Nashik", 167),
    ("Mumbai", "Aurangabad", 335),
    ("Mumbai", "Nagpur", 834),
    ("Mumbai", "Goa", 594),
    ("Mumbai", "Solapur", 455),
    ("Pune", "Nashik", 211),
    ("Pune", "Aurangabad", 233),
    ("Pune", "Nagpur", 714),
    ("Pune", "Kolhapur", 228),
    ("Pune", "Solapur", 248),
    ("Nashik", "Nagpur", 668),
    ("Nashik", "Aurangabad", 183),
    ("Nagpur", "Aurangabad", 503),
    ("Kolhapur", "Mumbai", 373),
    ("Goa", "Pune", 453),
    ("Solapur", "Nagpur", 494),
    ("Aurangabad", "Kolhapur", 393),
]

# --- fixed values: bookings ---------------------------------------------------------------
DELIVERY_STATUSES = ["BOOKED", "IN_TRANSIT", "DELIVERED", "DELAYED", "CANCELLED"]
LONG_HAUL_KM = 500
HEAVY_CARGO_KG = 8000
HIGH_VALUE_INR = 200000
VALUE_EDGES = [0, 50000, 200000, float("inf")]
VALUE_LABELS = ["LOW", "MEDIUM", "HIGH"]

# --- fixed values: telemetry --------------------------------------------------------------
SPEED_EDGES = [-1, 0, 30, 60, 90, 200]
SPEED_LABELS = ["STOPPED", "SLOW", "MODERATE", "FAST", "OVERSPEEDING"]
FUEL_EDGES = [-1, 20, 50, 101]
FUEL_LABELS = ["CRITICAL", "LOW", "NORMAL"]
RISK_EDGES = [-1, 20, 50, 75, 101]
RISK_LABELS = ["LOW", "MODERATE", "HIGH", "SEVERE"]
TRUTHY_TEXT = ["True", "true", "1"]

# --- fixed values: vehicle tiers (expected anomaly share, label, last vehicle number) -----
TIERS = ["OLD", "MID", "NEW"]
TIER_LAST_NUMBER = [17, 35, 50]
TIER_CONTAMINATION = {"OLD": 0.09, "MID": 0.05, "NEW": 0.02}
OTHER_CONTAMINATION = 0.05
TIER_HEALTH = {"OLD": "Poor", "MID": "Average", "NEW": "Excellent"}

# --- fixed values: models -----------------------------------------------------------------
SENSOR_FEATURES = [
    "speed_kmh",
    "fuel_level_pct",
    "engine_rpm",
    "battery_voltage",
    "tyre_pressure_psi",
    "cargo_weight_kg",
    "engine_health_score",
    "fuel_efficiency_kmpl",
]
DELAY_CATEGORIES = ["origin_city", "destination_city", "cargo_type", "priority"]
DELAY_FEATURES = [
    "distance_km",
    "cargo_weight_kg",
    "cargo_value_inr",
    "freight_charge_inr",
    "is_express",
    "is_long_haul",
    "is_heavy_cargo",
    "is_high_value",
    "heavy_long_haul",
    "revenue_per_km",
    "cargo_stress_index",
    "distance_cargo_risk",
    "express_risk_score",
    "origin_city_enc",
    "destination_city_enc",
    "cargo_type_enc",
    "priority_enc",
]
DECISION_THRESHOLD = 0.45
SPLIT_SEED = 42

# --- fixed values: alarm rules ------------------------------------------------------------
# name, metric, operator, threshold, statistic, period seconds, periods, missing data
ALARM_RULES = [
    ("FleetHealth-Critical", "FleetHealthScore", "<", 85.0, "Average", 300, 2, "notBreaching"),
    ("DelayRate-High", "DelayRate", ">", 50.0, "Average", 300, 2, "notBreaching"),
    ("Ingestion-Failed", "IngestionSuccessRate", "<", 95.0, "Average", 300, 1, "breaching"),
    ("MLModel-Degraded", "ModelAUCScore", "<", 60.0, "Average", 3600, 1, "notBreaching"),
    ("Anomaly-Spike", "AnomaliesDetected", ">", 60000.0, "Sum", 300, 2, "notBreaching"),
]

# --- fixed values: columns of the dashboard extracts ---------------------------------------
FLEET_EXTRACT = [
    "vehicle_id",
    "vehicle_tier",
    "driver_name",
    "route",
    "speed_kmh",
    "fuel_level_pct",
    "fuel_efficiency_kmpl",
    "engine_health_score",
    "cargo_weight_kg",
    "engine_rpm",
    "speed_category",
    "fuel_status",
    "is_night_shift",
]
DELIVERY_EXTRACT = [
    "booking_id",
    "origin_city",
    "destination_city",
    "cargo_type",
    "delivery_status",
    "priority",
    "distance_km",
    "freight_charge_inr",
    "cargo_weight_kg",
    "cargo_value_inr",
    "is_delayed",
    "is_express",
    "is_long_haul",
]
