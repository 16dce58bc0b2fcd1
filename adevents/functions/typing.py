"""Typing rules: raw text event columns -> typed, enriched events.

Every rule is a built-in Column expression, so the whole projection stays
inside whole-stage codegen and runs wherever the rows are.

* ids and ``ts`` fail soft: text that is not a plain integer (or number,
  for ``ts``) becomes NULL and the row is kept;
* prices fail loud: empty text is NULL, any other text that is not a
  number raises (or becomes NULL with ``bad_price="null"``);
* calendar buckets are UTC wall-clock values of ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adevents.schema import EVENT_COLUMNS, RAW_COLUMNS


def _epoch() -> Column:
    """Epoch origin as a time-zone-free timestamp: arithmetic on it never
    consults the session time zone."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


#: What counts as a number: no type suffix as in ``1d``, which a cast alone would take.
_NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)\s*$"


def soft_double(text: Column) -> Column:
    """``TRY_CAST(x AS DOUBLE)``: NULL unless ``x`` is a number."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def soft_int(text: Column, kind: str = "int") -> Column:
    """``TRY_CAST(x AS INTEGER/BIGINT)``: NULL unless ``x`` is a plain integer."""
    return text.try_cast(kind)


def strict_double(text: Column, name: str, bad: str = "error") -> Column:
    """``NULLIF(x, '')::DOUBLE``: empty is NULL, malformed text raises."""
    if bad not in ("error", "null"):
        raise ValueError(f"bad must be 'error' or 'null', not {bad!r}")
    value = F.nullif(text, F.lit(""))
    parsed = soft_double(value)
    if bad == "null":
        return parsed
    message = F.concat(F.lit(f"malformed {name}: "), value)
    return F.when(value.isNotNull() & parsed.isNull(), F.raise_error(message)).otherwise(parsed)


def epoch_millis_to_ts(text: Column) -> Column:
    """Epoch milliseconds (text, may carry a fraction) -> UTC timestamp.

    The value is rounded to whole microseconds before it becomes a
    timestamp, so integral milliseconds convert exactly.
    """
    micros = F.round(soft_double(text) * F.lit(1000.0)).try_cast("long")
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def ts_to_epoch_millis(ts: Column) -> Column:
    """UTC timestamp -> epoch milliseconds (the raw text form of ``ts``)."""
    return F.timestamp_diff("MILLISECOND", _epoch(), ts)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Week (Monday), day, hour and ``yyyy-MM-dd HH:mm`` minute of ``ts``."""
    return {
        "week": F.date_trunc("week", ts).cast("timestamp_ntz"),
        "day": F.to_date(ts),
        "hour": F.date_trunc("hour", ts).cast("timestamp_ntz"),
        "minute": F.date_format(ts, "yyyy-MM-dd HH:mm"),
    }


def with_calendar(df: DataFrame) -> DataFrame:
    """Add the calendar buckets of ``ts`` and return canonical column order."""
    return df.withColumns(calendar_columns(F.col("ts"))).select(*EVENT_COLUMNS)


def type_events(raw: DataFrame, bad_price: str = "error") -> DataFrame:
    """Raw nine-text-column events -> the typed 13-column event layout."""
    missing = [c for c in RAW_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"raw events lack columns {missing}")
    typed = raw.select(
        epoch_millis_to_ts(F.col("ts")).alias("ts"),
        F.col("type"),
        F.col("auction_id"),
        soft_int(F.col("advertiser_id")).alias("advertiser_id"),
        soft_int(F.col("publisher_id")).alias("publisher_id"),
        strict_double(F.col("bid_price"), "bid_price", bad_price).alias("bid_price"),
        soft_int(F.col("user_id"), "bigint").alias("user_id"),
        strict_double(F.col("total_price"), "total_price", bad_price).alias("total_price"),
        F.col("country"),
    )
    return with_calendar(typed)
