"""Aggregate items of a report: parsing, naming and Column builders.

A select item is either a column name, a function text such as
``"AVG(total_price)"`` / ``"COUNT(*)"`` / ``"COUNT(DISTINCT user_id)"``, or
a dict ``{FUNC: col, ...}`` where every key is one output column.  Every
aggregate gets an explicit, engine-independent name ``<func>_<col>``
(``count_star`` for ``COUNT(*)``), so results never depend on an engine's
default column naming.

All builders are Spark built-ins: they aggregate partially on the map side
before the shuffle, so a hot group never travels as raw rows.  The one
exception is ``median``, whose exact value is computed by
:func:`adevents.operators.quantiles.exact_median` as a separate,
distributed plan (see there).  ``mode`` keeps a group's distinct values in one
buffer; use it for columns with few values.

Scalar functions of one column (``{"UPPER": "country"}``, ``"MONTH(day)"``) may
be selected and grouped by, and are named ``<func>_<col>`` too.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Allowed aggregate functions (lower-case) and their aliases.
FUNCTION_ALIASES = {
    "mean": "avg",
    "std": "stddev",
    "stddev_samp": "stddev",
    "var_samp": "variance",
    "var": "variance",
    "countdistinct": "count_distinct",
}
BUILDERS: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "avg": F.avg,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "sum_distinct": F.sum_distinct,
    "min": F.min,
    "max": F.max,
    "stddev": F.stddev_samp,
    "stddev_pop": F.stddev_pop,
    "variance": F.var_samp,
    "var_pop": F.var_pop,
    "approx_count_distinct": F.approx_count_distinct,
    "any_value": F.any_value,
    "first": F.first,
    "last": F.last,
    "mode": lambda c: F.mode(c, deterministic=True),
    "skewness": F.skewness,
    "kurtosis": F.kurtosis,
    "bool_and": F.bool_and,
    "bool_or": F.bool_or,
}
# Scalar functions of one column, for select and group_by.
SCALARS: dict[str, Callable[[Column], Column]] = {
    "upper": F.upper,
    "lower": F.lower,
    "length": F.length,
    "abs": F.abs,
    "round": F.round,
    "year": F.year,
    "month": F.month,
    "dayofweek": F.dayofweek,
}
# Aggregates computed by a dedicated distributed plan, not a Column.
PLANNED = ("median",)

_CALL = re.compile(r"^\s*([A-Za-z_][A-Za-z0-9_]*)\s*\(\s*(.*?)\s*\)\s*$")
_DISTINCT = re.compile(r"^DISTINCT\s+(\S+)$", re.IGNORECASE)


@dataclass(frozen=True)
class AggItem:
    """One aggregate output column: ``func`` over ``col`` (``*`` = rows)."""

    func: str
    col: str

    @property
    def name(self) -> str:
        return f"{self.func}_{'star' if self.col == '*' else self.col}"

    @property
    def planned(self) -> bool:
        return self.func in PLANNED

    @property
    def sql_name(self) -> str:
        """The name a SQL engine gives the aggregate by default,
        e.g. ``sum(bid_price)``, ``count_star()``, ``count(DISTINCT user_id)``."""
        if self.col == "*":
            return "count_star()"
        if self.func.endswith("_distinct"):
            return f"{self.func[: -len('_distinct')]}(DISTINCT {self.col})"
        return f"{self.func}({self.col})"


@dataclass(frozen=True)
class ScalarItem:
    """A scalar function of one column; its output is named ``<func>_<col>``."""

    func: str
    col: str

    @property
    def name(self) -> str:
        return f"{self.func}_{self.col}"

    def column(self) -> Column:
        return SCALARS[self.func](F.col(self.col))


def make_item(func: str, arg: str) -> AggItem | ScalarItem:
    if func.strip().lower() in SCALARS:
        return ScalarItem(func.strip().lower(), arg.strip())
    return make_agg(func, arg)


def parse_scalar(text: str) -> ScalarItem | None:
    """``"UPPER(country)"`` -> its item; ``None`` for anything but a scalar function."""
    m = _CALL.match(text)
    if not m or m.group(1).lower() not in SCALARS:
        return None
    return ScalarItem(m.group(1).lower(), m.group(2))


def parse_call(text: str) -> AggItem | ScalarItem | None:
    """``"UPPER(country)"`` or ``"SUM(bid_price)"`` -> its item; ``None`` for a plain name."""
    m = _CALL.match(text)
    return make_item(m.group(1), m.group(2)) if m else None


def make_agg(func: str, arg: str) -> AggItem:
    func = func.strip().lower()
    func = FUNCTION_ALIASES.get(func, func)
    arg = arg.strip()
    m = _DISTINCT.match(arg)
    if m:
        if func not in ("count", "sum"):
            raise ValueError(f"DISTINCT is supported in COUNT and SUM, not {func.upper()}")
        func, arg = f"{func}_distinct", m.group(1)
    if func not in BUILDERS and func not in PLANNED:
        raise ValueError(f"unsupported aggregate function {func.upper()!r}")
    if arg == "*" and func != "count":
        raise ValueError(f"{func.upper()}(*) is not an aggregate")
    return AggItem(func, arg)


def parse_agg_text(text: str) -> AggItem | None:
    """``"SUM(bid_price)"`` -> AggItem; ``None`` for a plain name."""
    m = _CALL.match(text)
    if not m:
        return None
    return make_agg(m.group(1), m.group(2))


def parse_select_item(item) -> list:
    """A select item -> list of column names (str), AggItems and ScalarItems."""
    if isinstance(item, str):
        call = parse_call(item)
        return [call if call is not None else item.strip()]
    if isinstance(item, dict):
        if not item:
            raise ValueError("empty function item in select")
        return [make_item(func, col) for func, col in item.items()]
    raise ValueError(f"select item must be a name, an aggregate text or a dict: {item!r}")


def aggregate_column(agg: AggItem) -> Column:
    """The built-in aggregate Column for an item (not for planned ones)."""
    if agg.planned:
        raise ValueError(f"{agg.func} is computed by its own plan")
    if agg.col == "*":
        return F.count(F.lit(1)).alias(agg.name)
    return BUILDERS[agg.func](F.col(agg.col)).alias(agg.name)
