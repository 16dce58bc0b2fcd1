"""Driver tables -> ad events.

The driver ships a generic ``events`` table ``(event_id, ts, user_id,
event_type, value, props)``.  This module maps it, deterministically and
row for row, onto the ad-event layout the library works on.  No row is
dropped; a small deterministic share of prices is blanked so that
NULL-skipping aggregates (``COUNT(col)`` versus ``COUNT(*)``) have work to
do.  ``raw_events`` renders the same rows as the nine text columns of an
event part, which is what the CSV, zip and streaming sources read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adevents.functions.typing import ts_to_epoch_millis, with_calendar
from adevents.schema import RAW_COLUMNS

# event_type -> ad event type (others keep their name).
TYPE_NAMES = {"view": "impression", "signup": "serve"}
# user_id % 6 -> country; 5 has no country (NULL).
COUNTRIES = ["US", "JP", "DE", "BR", "IN"]
# Every 89th impression bid and every 83rd purchase price is
# blank (by event_id) so NULL prices exist.
BLANK_BID_EVERY = 89
BLANK_PRICE_EVERY = 83
ADVERTISERS = 20


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ad_type(kind: Column) -> Column:
    out = None
    for src, dst in TYPE_NAMES.items():
        out = (F.when(kind == src, F.lit(dst)) if out is None else out.when(kind == src, F.lit(dst)))
    return out.otherwise(kind)


def _country(user: Column) -> Column:
    slot = user % (len(COUNTRIES) + 1)
    out = None
    for i, name in enumerate(COUNTRIES):
        out = F.when(slot == i, F.lit(name)) if out is None else out.when(slot == i, F.lit(name))
    return out


def ad_events(events: DataFrame) -> DataFrame:
    """Typed 13-column ad events from the driver ``events`` table."""
    kind = F.col("event_type")
    eid = F.col("event_id")
    typed = events.select(
        F.col("ts"),
        _ad_type(kind).alias("type"),
        F.concat(F.lit("a"), eid.cast("string")).alias("auction_id"),
        (F.col("user_id") % ADVERTISERS).cast("int").alias("advertiser_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("publisher_id"),
        F.when((kind == "view") & (eid % BLANK_BID_EVERY != 0), F.col("value")).alias("bid_price"),
        F.col("user_id"),
        F.when((kind == "purchase") & (eid % BLANK_PRICE_EVERY != 0), F.col("value")).alias("total_price"),
        _country(F.col("user_id")).alias("country"),
    )
    return with_calendar(typed)


def raw_events(ad: DataFrame) -> DataFrame:
    """The nine text columns of an event part (``ts`` as epoch ms)."""
    cols = {c: F.col(c).cast("string") for c in RAW_COLUMNS}
    cols["ts"] = ts_to_epoch_millis(F.col("ts")).cast("string")
    return ad.select(*[cols[c].alias(c) for c in RAW_COLUMNS])


def load_ad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_events(load_table(spark, sf_dir, "events"))
