"""Results do not depend on the time zone of the process or of the session handed in."""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
    import sys
    sys.path[:0] = [{root!r}, {tests!r}]
    from pyspark.sql import SparkSession
    spark = (
        SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "America/New_York").config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
    )
    import __spark_entry__ as entry_points
    from oracle import connect, compare
    sf = "/root/testdata/sf0.001"
    con = connect(sf)
    for name in ("archive_expired", "retain_hot", "archive_manifest", "kpi_velocity", "kpi_by_calendar", "latest_kpi_run",
                 "clean_valid", "live_count_hot", "stream_fraud", "stream_ingest", "kpi_refresh_incremental"):
        difference = compare(entry_points.queries()[name](spark, sf), con, entry_points.oracle_sql()[name])
        assert difference is None, (name, difference)
    print("all equal")
"""


def test_a_session_and_process_in_another_zone(tmp_path):
    script = textwrap.dedent(SCRIPT).format(root=str(ROOT), tests=str(ROOT / "tests"))
    run = subprocess.run(
        [sys.executable, "-c", script, str(tmp_path)],
        env={**os.environ, "TZ": "America/New_York"}, capture_output=True, text=True, timeout=600,
    )
    assert "all equal" in run.stdout, run.stderr[-2000:]
