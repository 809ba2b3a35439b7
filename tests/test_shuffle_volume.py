"""Hot keys cross each shuffle about once per map task (measured from the event log of
a separate Spark process; see shuffle_check.py)."""

import json
import os
import subprocess
import sys


def test_hot_keys_cross_shuffle_once_per_task():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "shuffle_check.py")
    out = subprocess.run([sys.executable, script, "800000"], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stdout[-1000:] + out.stderr[-2000:]
    rec = json.loads([line for line in out.stdout.splitlines() if line.startswith("{")][-1])
    shuffled = rec["shuffle_records"]
    assert shuffled["hourly_counts"] <= rec["bound_per_shuffle"] < rec["input_rows"] / 40
    assert shuffled["distinct_files"] <= rec["files_bound"]
    # one row per number, IMSI and IMEI and task, then one per number and task
    assert shuffled["profile_partials"] <= 36 * rec["bound_per_shuffle"]
    # no task has the whole of the hot day, though k is beyond Spark's own limit
    assert rec["largest_task_read"]["top_of_hot_day"] < rec["input_rows"] * 0.98 / 2
