"""URL verdicts: prefix rules first, then a list of canonical URLs.

The list is tested in two steps.  A blocked Bloom filter (one row of eight
64-bit words per block, one bit per word and URL) is built with ``bit_or`` and
joined to the pages by block number; only pages whose eight bits are all set
go on to an exact hash join with the list, which removes false positives.
Pages the filter rules out never take part in that join.

The filter is broadcast while it is below ``broadcast_bytes``, which its block
count proves; a larger one is joined by a shuffle on the block number.

Cases: a null URL or one without ``://`` has an empty host, path and canonical
form, fits no rule and is never listed; nulls, repeats and an empty list are
fine; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adevents.llm.common import ascii_lower, saved

#: (action, host, path) of the production rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Names of sites whose pages make up the production list, under any subdomain and ending.
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
WORDS = 8
BITS_PER_URL = 16


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host and path without scheme, fragment, tracking parameters and end slashes.

    Parameters named ``utm_*`` or ``ref`` are dropped, the others sorted.
    """
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    params = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[^=]*|ref)(=|$)"))
    )
    path = F.regexp_replace(path_of(url), r"/+$", "")
    tail = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.concat(host_of(url), path, tail)


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (``host/path``) and its action; null when none fits."""
    rule = action = None
    for act, r_host, r_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2])):
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path)
        name = r_host + r_path
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        action = F.when(fits, act) if action is None else action.when(fits, act)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, action)


def _masks(url: Column) -> list[Column]:
    """One bit for each of the block's words."""
    second = F.xxhash64(url, F.lit("bits"))
    return [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * i).bitwiseAND(63).cast("int"))
        for i in range(WORDS)
    ]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def build_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """``listed(url)`` -> one row per used block: ``block, w0 .. w7``."""
    url = F.col("url")
    masks = [m.alias(f"m{i}") for i, m in enumerate(_masks(url))]
    return (
        listed.select(_block(url, blocks).alias("block"), *masks)
        .groupBy("block")
        .agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])
    )


def mark_listed(pages: DataFrame, listed: DataFrame, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``pages`` (with a canonical ``url``) plus ``possible`` and ``listed`` booleans.

    ``listed`` has one column ``url``; repeats, nulls and empty strings in it
    don't count.
    """
    listed = saved(listed.select("url").where("url <> ''").distinct(), "listed")
    blocks = max(1, math.ceil(listed.count() * BITS_PER_URL / (64 * WORDS)))
    bloom = build_filter(listed, blocks)
    if blocks * 8 * (WORDS + 1) <= broadcast_bytes:  # at most one row per block
        bloom = F.broadcast(bloom)
    url = F.col("url")
    hit = F.lit(True)
    for i, mask in enumerate(_masks(url)):
        hit = hit & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    probed = (
        pages.withColumn("block", _block(url, blocks))
        .join(bloom, "block", "left")
        .withColumn("possible", F.coalesce(hit & (url != ""), F.lit(False)))
        .drop("block", *[f"w{i}" for i in range(WORDS)])
    )
    probed = saved(probed, "probed")  # URLs only; both branches read it
    out = probed.where(~F.col("possible")).withColumn("listed", F.lit(False))
    exact = (
        probed.where("possible")
        .join(listed.withColumn("found", F.lit(True)), "url", "left")
        .withColumn("listed", F.coalesce("found", F.lit(False)))
        .drop("found")
    )
    return out.unionByName(exact)


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the list's two flags."""
    at = F.col("page_url")
    rows = pages.select(F.col("page_id"), F.col("url").alias("page_url")).select(
        "page_id", host_of(at).alias("host"), path_of(at).alias("path"), canonical(at).alias("url")
    )
    rule, action = rule_columns(F.col("host"), F.col("path"), rules)
    return mark_listed(rows, listed, broadcast_bytes).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(action, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        F.col("url").alias("canonical_url"),
        "listed",
    )


def listed_pages(pages: DataFrame, names: Sequence[str] = LISTED_NAMES) -> DataFrame:
    """The production list: canonical URLs seen on hosts with one of the names among their labels."""
    at = F.col("url")
    named = host_of(at).rlike(rf"(^|\.)({'|'.join(map(re.escape, names))})(\.|:|$)")
    return pages.where(named).select(canonical(at).alias("url"))
