"""Task retries: a failed first attempt must not leave duplicate output.

Runs in a separate process because it needs a local master that allows
task retries (``local[2,3]``).
"""

from __future__ import annotations

import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = textwrap.dedent(
    """
    import sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import functions as F
    from adevents.session import get_session, scratch_path
    from adevents.plans.adapter import load_ad_events, raw_events
    from adevents.functions.typing import type_events
    from adevents.sources import csv_parts
    from adevents.sources.csv_parts import read_event_parts
    from adevents.schema import RAW_COLUMNS

    spark = get_session("local[2,3]", spark__sql__shuffle__partitions="4")
    spark.sparkContext.setLogLevel("OFF")
    raw = raw_events(load_ad_events(spark, "/root/testdata/sf0.001")).repartition(3)
    folder = scratch_path(spark, "retry")
    writer = csv_parts._part_writer(folder, False)

    def flaky(batches):
        out = list(writer(batches))          # writes and publishes the part
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("executor lost after writing")
        yield from out

    summary = raw.select(*RAW_COLUMNS).withColumn("__pid", F.spark_partition_id()).mapInArrow(
        flaky, "file string, rows long").collect()
    back = type_events(read_event_parts(spark, folder))
    want = type_events(raw)
    assert sum(r.rows for r in summary) == raw.count() == back.count(), (summary, back.count())
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0
    print("RETRY-OK", len(summary))
    """
)


def test_part_writer_survives_retried_tasks(tmp_path):
    script = tmp_path / "retry.py"
    script.write_text(SCRIPT.format(root=str(ROOT)))
    proc = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=300)
    assert "RETRY-OK 3" in proc.stdout, proc.stdout[-2000:] + proc.stderr[-3000:]
