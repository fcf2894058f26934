"""Keys stay right when tasks fail and are retried (separate process, since
the retry setting is part of the master URL)."""

from __future__ import annotations

import os
import subprocess
import sys

from tests.conftest import SMALL


def test_row_index_survives_failed_task_attempts():
    job = os.path.join(os.path.dirname(os.path.abspath(__file__)), "resilience_job.py")
    out = subprocess.run([sys.executable, job, SMALL], capture_output=True, text=True, timeout=600)
    assert "RESULT OK" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
