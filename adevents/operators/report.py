"""Aggregate reports: ``select / where / group_by / order_by / limit``.

``report(events, select=..., where=..., group_by=..., order_by=..., limit=...)``
turns the five clauses of a report into one DataFrame plan.  Nothing is
executed here; Catalyst pushes the filters into the scan (partition filters
on ``type``/``day`` for the event store), prunes columns, aggregates
partially before the shuffle and turns ``order_by`` + ``limit`` into a
bounded top-k.

Clause rules:

* ``select`` items are column names, aggregate texts (``"COUNT(*)"``) or
  ``{FUNC: col}`` dicts; output columns keep the select order and aggregates
  are named ``<func>_<col>``.  ``"*"`` selects every column.
* ``where`` is an AND of ``{col, op, val}`` conditions (see
  :mod:`adevents.functions.predicates`).
* ``group_by`` without aggregates returns the distinct groups.  Scalar functions
  of one column (``{"UPPER": "country"}``, ``"MONTH(day)"``) may be selected,
  grouped and ordered by.
* ``order_by`` items ``{col, dir}`` name an output column, a group key, an
  aggregate text or (without aggregation) any input column; NULLs sort
  last in both directions.
* ``limit=None`` returns every row, ``limit=n`` the first ``n``.
* ``names="sql"`` renames aggregate columns to the default SQL names
  (``sum(bid_price)``, ``count_star()``) as a final projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adevents.functions.aggregates import AggItem, ScalarItem, aggregate_column, parse_agg_text, parse_scalar, parse_select_item
from adevents.functions.predicates import apply_filters


@dataclass(frozen=True)
class Spec:
    """A report in clause form; built by :func:`spec`."""

    select: tuple
    where: tuple = ()
    group_by: tuple = ()
    order_by: tuple = ()
    limit: int | None = None
    items: tuple = field(default=(), compare=False)
    #: scalar functions that the clauses name; in ``items`` they are plain names
    scalars: tuple = field(default=(), compare=False)

    @property
    def aggregates(self) -> list[AggItem]:
        return [i for i in self.items if isinstance(i, AggItem)]

    @property
    def names(self) -> list[str]:
        return [i for i in self.items if isinstance(i, str)]

    @property
    def aggregating(self) -> bool:
        return bool(self.group_by) or bool(self.aggregates)


def spec(
    select: Sequence,
    where: Sequence[Mapping] | None = None,
    group_by: Sequence[str] | None = None,
    order_by: Sequence[Mapping] | None = None,
    limit: int | None = None,
) -> Spec:
    if isinstance(select, (str, dict)):
        select = [select]
    if not select:
        raise ValueError("select needs at least one item")
    items: list = []
    for item in select:
        items.extend(parse_select_item(item))
    scalars = [i for i in items if isinstance(i, ScalarItem)]

    def plain(text):
        """A grouping or ordering text; a scalar function becomes its name."""
        call = parse_scalar(text)
        if call is None:
            return text
        scalars.append(call)
        return call.name

    if isinstance(group_by, (str, dict)):
        group_by = [group_by]
    groups = []
    for g in group_by or []:
        parsed = parse_select_item(g) if isinstance(g, dict) else [plain(g)]
        scalars.extend(i for i in parsed if isinstance(i, ScalarItem))
        groups.extend(i.name if isinstance(i, ScalarItem) else i for i in parsed)
    items = [i.name if isinstance(i, ScalarItem) else i for i in items]
    if limit is not None and (not isinstance(limit, int) or limit < 0):
        raise ValueError(f"limit must be a non-negative int or None: {limit!r}")
    order = []
    for o in order_by or []:
        if isinstance(o, str):
            o = {"col": o}
        direction = str(o.get("dir", "asc")).lower()
        if direction not in ("asc", "desc"):
            raise ValueError(f"order direction must be asc or desc: {o!r}")
        order.append({"col": plain(o["col"]), "dir": direction})
    return Spec(
        select=tuple(select),
        where=tuple(dict(w) for w in (where or [])),
        group_by=tuple(groups),
        order_by=tuple(order),
        limit=limit,
        items=tuple(items),
        scalars=tuple(dict.fromkeys(scalars)),
    )


def _check_names(df: DataFrame, names, columns: Sequence[str] | None = None) -> None:
    columns = df.columns if columns is None else columns
    missing = [n for n in names if n != "*" and n not in columns]
    if missing:
        raise ValueError(f"unknown columns {missing}; available {list(columns)}")


def _expand_star(columns: Sequence[str], items: Sequence) -> list:
    out: list = []
    for i in items:
        out.extend(columns if i == "*" else [i])
    return out


def output_names(s: Spec, columns: Sequence[str]) -> list[str]:
    names: list[str] = []
    for i in s.items:
        if isinstance(i, AggItem):
            names.append(i.name)
        elif i == "*":
            names.extend(columns)
        else:
            names.append(i)
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate output columns {names}")
    return names


def _order_key(s: Spec, o: Mapping, out_names: Sequence[str]):
    """Resolve one order item -> (output name or AggItem or input name)."""
    text = o["col"]
    if text in out_names:
        return text
    by_sql_name = {a.sql_name: a for a in s.aggregates}
    if text in by_sql_name:
        return by_sql_name[text].name
    agg = parse_agg_text(text)
    if agg is not None:
        return agg.name if agg.name in out_names else agg
    return text


def _direction(c: Column, direction: str) -> Column:
    return c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last()


def finish(
    result: DataFrame,
    s: Spec,
    out_names: Sequence[str],
    hidden: Sequence[str] = (),
    unique_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Apply order_by and limit, then drop helper columns.

    Rows that tie on the order keys have no defined order, so trailing
    tie-breakers are added: the group keys (unique per output row) or, for
    plain projections, a hash of the row.  A global sort then range-
    partitions on a key with few ties, so a value shared by a third of
    all rows is still spread over many sort tasks, and results with a
    limit are deterministic.
    """
    if s.order_by:
        keys = []
        used = []
        for o in s.order_by:
            key = _order_key(s, o, out_names)
            name = key.name if isinstance(key, AggItem) else key
            if name not in result.columns:
                raise ValueError(f"cannot order by {o['col']!r}: not an output, key or aggregate")
            keys.append(_direction(F.col(name), o["dir"]))
            used.append(name)
        if unique_keys is not None:
            keys.extend(F.col(k).asc_nulls_last() for k in unique_keys if k not in used and k in result.columns)
        else:
            keys.append(F.xxhash64(*[F.col(c) for c in out_names]).asc())
        result = result.orderBy(*keys)
    if hidden:
        result = result.select(*out_names)
    if s.limit is not None:
        result = result.limit(s.limit)
    return result


# Output naming styles of aggregate columns.
NAMING = ("plain", "sql")


def named(result: DataFrame, s: Spec, names: str) -> DataFrame:
    """Rename aggregate columns to the chosen style (a final projection).

    ``plain`` keeps ``sum_bid_price``; ``sql`` gives the names a SQL engine
    uses by default (``sum(bid_price)``, ``count_star()``), so results can
    be compared header for header with files written by SQL tools.
    """
    if names not in NAMING:
        raise ValueError(f"names must be one of {NAMING}")
    if names == "plain":
        return result
    return result.withColumnsRenamed({a.name: a.sql_name for a in dict.fromkeys(s.aggregates)})


def report(
    df: DataFrame,
    select=None,
    where=None,
    group_by=None,
    order_by=None,
    limit=None,
    *,
    names: str = "plain",
    spec_: Spec | None = None,
) -> DataFrame:
    """Build the report DataFrame over ``df`` (events or any frame)."""
    s = spec_ or spec(select, where, group_by, order_by, limit)
    return named(_report(df, s), s, names)


def _report(df: DataFrame, s: Spec) -> DataFrame:
    star = df.columns
    _check_names(df, [x.col for x in s.scalars], star)
    taken = [x.name for x in s.scalars if x.name in star]
    if taken:
        raise ValueError(f"function results would be named like the columns {taken}")
    if s.scalars:
        df = df.withColumns({x.name: x.column() for x in s.scalars})
    columns = df.columns
    _check_names(df, s.names + list(s.group_by) + [a.col for a in s.aggregates if a.col != "*"], columns)
    out_names = output_names(s, star)
    filtered = apply_filters(df, s.where)

    if not s.aggregating:
        hidden = []
        for o in s.order_by:
            key = _order_key(s, o, out_names)
            if isinstance(key, AggItem):
                raise ValueError(f"cannot order a plain projection by {o['col']!r}")
            if key not in out_names:
                _check_names(df, [key], columns)
                hidden.append(key)
        cols = _expand_star(star, s.names) + [h for h in hidden if h not in out_names]
        return finish(filtered.select(*cols), s, out_names, hidden)

    keys = list(s.group_by)
    bare = [n for n in _expand_star(star, s.names) if n not in keys]
    if bare:
        raise ValueError(f"selected columns {bare} are neither grouped nor aggregated")

    aggs = list(dict.fromkeys(s.aggregates))
    hidden: list[str] = []
    for o in s.order_by:
        key = _order_key(s, o, out_names)
        if isinstance(key, AggItem):
            _check_names(df, [] if key.col == "*" else [key.col], columns)
            if key not in aggs:
                aggs.append(key)
                hidden.append(key.name)
        elif key not in out_names:
            if key not in keys:
                raise ValueError(f"cannot order by {key!r}: not grouped or aggregated")
            hidden.append(key)

    result = aggregate(filtered, keys, aggs)
    return finish(result.select(*out_names, *hidden), s, out_names, hidden, unique_keys=keys)


# The keys of a report given as one dict.
QUERY_KEYS = ("select", "from", "where", "group_by", "order_by", "limit")


def clauses_of(query: Mapping) -> tuple[str, dict]:
    """Split a query dict into its source name and the report clauses."""
    unknown = sorted(set(query) - set(QUERY_KEYS))
    if unknown:
        raise ValueError(f"unknown query keys {unknown}; expected {QUERY_KEYS}")
    clauses = {k: query[k] for k in QUERY_KEYS[2:] if k in query}
    clauses["select"] = query.get("select", [])
    return query.get("from", "events"), clauses


def report_query(query: Mapping, tables: Mapping[str, DataFrame], names: str = "plain") -> DataFrame:
    """Report from a dict ``{select, from, where, group_by, order_by, limit}``.

    ``from`` names a frame in ``tables`` (default ``"events"``).
    """
    source, clauses = clauses_of(query)
    if source not in tables:
        raise ValueError(f"unknown table {source!r}; available {sorted(tables)}")
    return report(tables[source], **clauses, names=names)


def aggregate(df: DataFrame, keys: Sequence[str], aggs: Sequence[AggItem]) -> DataFrame:
    """Group ``df`` by ``keys`` and compute ``aggs`` (distinct groups if none)."""
    from adevents.operators.quantiles import exact_medians

    plain = [aggregate_column(a) for a in aggs if not a.planned]
    planned = [a for a in aggs if a.planned]
    if plain:
        result = df.groupBy(*keys).agg(*plain) if keys else df.agg(*plain)
    elif keys:
        result = df.select(*keys).distinct()
    else:
        result = None
    if not planned:
        return result
    med = exact_medians(df, keys, [(a.col, a.name) for a in planned])
    if result is None:
        return med
    if not keys:
        return _attach_scalar(result, med)
    cond = [result[k].eqNullSafe(med[k]) for k in keys]
    return result.join(med, cond, "left").select(result["*"], *[med[a.name] for a in planned])


def _attach_scalar(one_row: DataFrame, scalar: DataFrame) -> DataFrame:
    """Put the columns of two single-row frames side by side.

    The rows are unioned (each column is set on one of the two rows) and
    folded by a global aggregate -- no join, so nothing can turn into a
    cartesian product.
    """
    cols = one_row.columns + [c for c in scalar.columns if c not in one_row.columns]
    both = one_row.unionByName(scalar, allowMissingColumns=True)
    return both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
