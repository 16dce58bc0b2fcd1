"""Fixed schemas of the ad-event data model.

The raw layout is nine text columns, exactly as the CSV parts carry them.
The typed layout adds four calendar buckets derived from ``ts``.  All
schemas are declared, never inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The raw column names of an event part, in file order.
RAW_COLUMNS = (
    "ts",
    "type",
    "auction_id",
    "advertiser_id",
    "publisher_id",
    "bid_price",
    "user_id",
    "total_price",
    "country",
)

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# The typed event columns, in canonical order.
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("week", T.TimestampNTZType(), True),
        T.StructField("day", T.DateType(), True),
        T.StructField("hour", T.TimestampNTZType(), True),
        T.StructField("minute", T.StringType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("auction_id", T.StringType(), True),
        T.StructField("advertiser_id", T.IntegerType(), True),
        T.StructField("publisher_id", T.IntegerType(), True),
        T.StructField("bid_price", T.DoubleType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("total_price", T.DoubleType(), True),
        T.StructField("country", T.StringType(), True),
    ]
)
EVENT_COLUMNS = tuple(f.name for f in EVENTS_SCHEMA.fields)

# Hive partition columns of the event store.
STORE_PARTITIONS = ("type", "day")

# Pattern of an event part's base name.
PART_GLOB = "events_part_*.csv"
