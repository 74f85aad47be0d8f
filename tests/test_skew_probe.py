"""Regression guard: with one key holding a third of all rows, no task may receive
that hot group. Runs tools/skew_probe.py in its own process (event logging must be
configured when the session starts) and reads its JSON summary."""
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_no_task_receives_a_hot_group():
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_probe.py"),
                          "/root/testdata/sf0.01", "--json"],
                         capture_output=True, text=True, timeout=600, check=True).stdout
    report = json.loads(out.strip().splitlines()[-1])
    assert len(report) >= 8
    for name, r in report.items():
        assert r["max_task_rows"] > 0, name
        assert r["max_task_rows"] < r["hot_rows"] / 4, (name, r)
