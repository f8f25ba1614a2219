"""Column names, schemas and thresholds of the booking domain."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: they must equal the names and numbers users already rely on ---
ID_COLUMN = "Booking_ID"
TARGET = "booking_status"
TARGET_LABELS = ("Canceled", "Not_Canceled")
CATEGORICAL = ("type_of_meal_plan", "room_type_reserved", "market_segment_type")
NUMERICAL = ("lead_time", "no_of_weekend_nights", "no_of_week_nights")
DATE_PARTS = ("arrival_date", "arrival_month", "arrival_year")
FEATURE_TABLE = (
    "booking_id",
    "event_timestamp",
    "booking_date",
    "lead_time",
    "avg_price_per_room",
    "no_of_special_requests",
    "arrival_date",
    "arrival_month",
    "booking_status",
)
MODEL_FEATURES = (
    "lead_time",
    "avg_price_per_room",
    "no_of_special_requests",
    "arrival_date",
    "arrival_month",
)
PCA_COLUMNS = (
    "lead_time",
    "avg_price_per_room",
    "no_of_special_requests",
    "arrival_date",
    "arrival_month",
    "market_segment_type",
    "total_nights_stayed",
    "no_of_week_nights",
)
ID_NAME_PATTERNS = ("booking_id", "Booking_ID", "id")
IMPORTANCE_THRESHOLD = 0.05
DEPLOYMENT_THRESHOLD = 0.85
TUNING_THRESHOLD = 0.85
DRIFT_THRESHOLDS = {"data_drift": 0.2, "model_drift": 0.1, "prediction_accuracy": 0.8}
RETRAIN_DRIFT = 0.1
RETRAIN_ACCURACY = 0.8
LATENCY_BUCKETS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)
# --- end of fixed values ---

RAW_SCHEMA = T.StructType(
    [
        T.StructField("Booking_ID", T.StringType()),
        T.StructField("no_of_weekend_nights", T.LongType()),
        T.StructField("no_of_week_nights", T.LongType()),
        T.StructField("type_of_meal_plan", T.StringType()),
        T.StructField("required_car_parking_space", T.LongType()),
        T.StructField("room_type_reserved", T.StringType()),
        T.StructField("lead_time", T.LongType()),
        T.StructField("arrival_year", T.LongType()),
        T.StructField("arrival_month", T.LongType()),
        T.StructField("arrival_date", T.LongType()),
        T.StructField("market_segment_type", T.StringType()),
        T.StructField("repeated_guest", T.LongType()),
        T.StructField("no_of_previous_cancellations", T.LongType()),
        T.StructField("no_of_previous_bookings_not_canceled", T.LongType()),
        T.StructField("avg_price_per_room", T.DoubleType()),
        T.StructField("no_of_special_requests", T.LongType()),
        T.StructField("booking_status", T.StringType()),
    ]
)

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("lead_time", T.DoubleType()),
        T.StructField("avg_price_per_room", T.DoubleType()),
        T.StructField("no_of_special_requests", T.LongType()),
        T.StructField("arrival_date", T.LongType()),
        T.StructField("arrival_month", T.LongType()),
    ]
)
