"""Task failures during the global index are retried and give the same result."""

from __future__ import annotations

import os
import subprocess
import sys


def test_global_index_survives_task_failures():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fault_injection_job.py")
    r = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert r.stdout.strip().splitlines()[-1] == "OK", r.stdout[-2000:] + r.stderr[-3000:]
