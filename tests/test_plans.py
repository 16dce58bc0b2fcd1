"""Plan guards (scale regressions); test_oracle.py checks every query's plan too."""

from __future__ import annotations

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def test_store_reports_read_only_needed_columns(spark):
    for key in ("q1_daily_revenue", "q2_publisher_revenue", "q5_minute_revenue", "hourly_revenue"):
        plan = entry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
        assert schema.count(":") <= 3, (key, schema)
        assert "PartitionFilters: [isnotnull(type" in plan, key
