"""adevents: ad-event analytics on Spark DataFrames.

Read raw event parts (CSV folders, zip archives, or a stream of arriving
parts), type and enrich them, keep them as Parquet partitioned by event
type and day, build summary tables, and answer filtered, grouped, ordered
and limited aggregate reports from the events or from a covering summary
table.  Everything is a lazy DataFrame plan.
"""

from adevents.session import get_session, prepare_session

__all__ = ["get_session", "prepare_session"]
