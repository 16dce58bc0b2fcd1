"""Filter conditions ``{col, op, val}`` -> Column predicates.

Values are compared as what they are and never cut down to the column's type:
``advertiser_id < 12.5`` keeps 12, ``= 12.7`` matches nothing and ``< 3000000000``
matches every non-NULL int.  On an integer column a condition is rewritten to
the exact integer bound, so it stays a plain comparison that Catalyst pushes to
the Parquet scan (or turns into a partition filter).  Dates must be whole days:
a time of day against a date column raises.  Names are checked against the
frame; unknown operators raise instead of being dropped.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable, Mapping
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The comparison operators of a filter condition.
OPERATORS = ("eq", "neq", "lt", "lte", "gt", "gte", "between", "in")

_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _column_types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields}


def _number(value) -> Decimal:
    """The exact value of a number or of its text."""
    try:
        return Decimal(value.strip() if isinstance(value, str) else value)
    except (InvalidOperation, TypeError, ValueError) as exc:
        raise ValueError(f"not a number: {value!r}") from exc


def _integer_predicate(c: Column, kind: T.DataType, op: str, value) -> Column:
    """``c op value`` for an integer column, by the nearest whole bound."""
    v = _number(value)
    top = 2 ** (_INTEGER_BITS[type(kind)] - 1) - 1
    if v.is_nan():  # larger than every number and equal to none
        v = Decimal("Infinity")
    whole = not v.is_infinite() and v == v.to_integral_value()
    if op in ("eq", "neq"):
        inside = whole and -top - 1 <= v <= top
        if op == "eq":
            return c == F.lit(int(v)).cast(kind) if inside else F.lit(False)
        return c != F.lit(int(v)).cast(kind) if inside else c.isNotNull()
    upper = op in ("lt", "lte")
    if v.is_infinite() or not -top - 1 <= v <= top:
        return c.isNotNull() if (v > 0) == upper else F.lit(False)
    if upper:
        bound = math.ceil(v) - 1 if op == "lt" else math.floor(v)
        return c <= F.lit(bound).cast(kind) if bound >= -top - 1 else F.lit(False)
    bound = math.floor(v) + 1 if op == "gt" else math.ceil(v)
    return c >= F.lit(bound).cast(kind) if bound <= top else F.lit(False)


def _day(value) -> str:
    """A whole day as text; a time of day raises."""
    if isinstance(value, str):
        try:
            value = dt.datetime.fromisoformat(value.strip())
        except ValueError as exc:
            raise ValueError(f"not a date: {value!r}") from exc
    if isinstance(value, dt.datetime):
        if value.time() != dt.time() or value.tzinfo is not None:
            raise ValueError(f"a date column cannot be compared with a time of day: {value}")
        value = value.date()
    if not isinstance(value, dt.date):
        raise ValueError(f"not a date: {value!r}")
    return value.isoformat()


def _literal(kind: T.DataType, value) -> Column:
    if isinstance(kind, T.DateType):
        return F.lit(_day(value)).cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.lit(float(_number(value)))
    if isinstance(kind, T.DecimalType):
        return F.lit(_number(value))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) and isinstance(value, (dt.date, dt.datetime)):
        return F.lit(value.isoformat()).cast(kind)
    return F.lit(value).cast(kind)


def _compare(c: Column, kind: T.DataType, op: str, value) -> Column:
    if value is None:  # a comparison with NULL is never true
        return F.lit(False)
    if type(kind) in _INTEGER_BITS:
        return _integer_predicate(c, kind, op, value)
    v = _literal(kind, value)
    return {"eq": c == v, "neq": c != v, "lt": c < v, "lte": c <= v, "gt": c > v, "gte": c >= v}[op]


def predicate(df: DataFrame, cond: Mapping, types: dict | None = None) -> Column:
    """One condition -> Column; ``neq`` drops NULL rows as SQL does."""
    types = types if types is not None else _column_types(df)
    try:
        col, op, val = cond["col"], cond["op"], cond["val"]
    except KeyError as exc:
        raise ValueError(f"condition needs col, op and val: {dict(cond)}") from exc
    if col not in types:
        raise ValueError(f"unknown column in condition: {col!r}")
    c, kind = F.col(col), types[col]
    if op == "between":
        if isinstance(val, (str, bytes)) or len(val) != 2:
            raise ValueError(f"between needs [low, high]: {val!r}")
        return _compare(c, kind, "gte", val[0]) & _compare(c, kind, "lte", val[1])
    if op == "in":
        if isinstance(val, (str, bytes)):
            raise ValueError(f"in needs a list of values: {val!r}")
        values = [v for v in val if v is not None]
        if type(kind) in _INTEGER_BITS:
            top = 2 ** (_INTEGER_BITS[type(kind)] - 1) - 1
            numbers = [_number(v) for v in values]
            values = [int(v) for v in numbers if v.is_finite() and v == v.to_integral_value() and -top - 1 <= v <= top]
        return c.isin(*[_literal(kind, v) for v in values]) if values else F.lit(False)
    if op not in OPERATORS:
        raise ValueError(f"unknown operator {op!r}; expected one of {OPERATORS}")
    return _compare(c, kind, op, val)


def conjunction(df: DataFrame, conds: Iterable[Mapping] | None) -> Column | None:
    """AND of all conditions; ``None`` when there are none."""
    conds = list(conds or [])
    if not conds:
        return None
    types = _column_types(df)
    preds = [predicate(df, c, types) for c in conds]
    if not preds:
        return None
    return reduce(lambda a, b: a & b, preds)


def apply_filters(df: DataFrame, conds: Iterable[Mapping] | None) -> DataFrame:
    cond = conjunction(df, conds)
    return df if cond is None else df.where(cond)
