"""Declared schemas of the raw export, the models and the results. The export
is read with these; the driver's Parquet tables carry their own."""

from __future__ import annotations

from pyspark.sql import types as T

PARAM_VALUE = T.StructType(
    [
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
    ]
)

EVENT_PARAM = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", PARAM_VALUE),
    ]
)

ITEM = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("price_in_usd", T.DoubleType()),
    ]
)

DEVICE = T.StructType([T.StructField("category", T.StringType())])
GEO = T.StructType([T.StructField("country", T.StringType())])
TRAFFIC_SOURCE = T.StructType(
    [T.StructField("medium", T.StringType()), T.StructField("source", T.StringType())]
)
ECOMMERCE = T.StructType([T.StructField("purchase_revenue_in_usd", T.DoubleType())])

# The nested fields, in export order. They travel as JSON in the interchange file.
NESTED_FIELDS = ("event_params", "device", "geo", "traffic_source", "ecommerce", "items")

# Raw event, one row per event. ``event_id`` is the driver table's key, carried
# so that events equal on every other column stay distinct.
RAW_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_date", T.StringType()),  # yyyyMMdd, the day shard
        T.StructField("event_timestamp", T.LongType()),  # micros since epoch
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("event_params", T.ArrayType(EVENT_PARAM)),
        T.StructField("device", DEVICE),
        T.StructField("geo", GEO),
        T.StructField("traffic_source", TRAFFIC_SOURCE),
        T.StructField("ecommerce", ECOMMERCE),
        T.StructField("items", T.ArrayType(ITEM)),
    ]
)

# The same event as landed in the second warehouse: nested fields are
# schema-on-read VARIANT columns.
LANDED_EVENT = T.StructType(
    [f if f.name not in NESTED_FIELDS else T.StructField(f.name, T.VariantType()) for f in RAW_EVENT.fields]
)

# Name of the day partition column of the on-disk raw dataset.
DAY_PARTITION = "event_day"

STAGED_EVENT = T.StructType(
    [
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("ga_session_id", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("page_location", T.StringType()),
        T.StructField("device_category", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("traffic_medium", T.StringType()),
        T.StructField("traffic_source", T.StringType()),
        T.StructField("purchase_revenue_usd", T.DoubleType()),
    ]
)

SESSION = T.StructType(
    [
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("ga_session_id", T.LongType()),
        T.StructField("session_key", T.StringType()),
        T.StructField("session_start", T.TimestampType()),
        T.StructField("session_end", T.TimestampType()),
        T.StructField("session_date", T.DateType()),
        T.StructField("device_category", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("traffic_medium", T.StringType()),
        T.StructField("page_views", T.LongType()),
        T.StructField("view_item_events", T.LongType()),
        T.StructField("did_view_item", T.BooleanType()),
        T.StructField("did_add_to_cart", T.BooleanType()),
        T.StructField("did_begin_checkout", T.BooleanType()),
        T.StructField("did_purchase", T.BooleanType()),
        T.StructField("revenue_usd", T.DoubleType()),
    ]
)

MODEL_REGISTRY = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("layer", T.StringType(), False),
        T.StructField("owner", T.StringType()),
        T.StructField("owner_slack", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

CHECK_RESULT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("failures", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
