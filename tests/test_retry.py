"""Task failures (as on a lost executor) change nothing in what is stored."""

import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_load_survives_failed_task_attempts(tmp_dir):
    script = os.path.join(ROOT, "tests", "scripts", "retry_run.py")
    run = subprocess.run(
        [sys.executable, script, ROOT, SF_SMALL, tmp_dir], capture_output=True, text=True, timeout=600
    )
    lines = [line for line in run.stdout.splitlines() if line.startswith(("RESULT", "EXPECT"))]
    assert run.returncode == 0, run.stderr[-3000:]
    expect = lines[-1].split()
    for line in lines[:-1]:
        stored, distinct = (int(part.split("=")[1]) for part in line.split()[2:4])
        assert (stored, distinct) == (int(expect[1]), int(expect[2])), line
    assert len(lines) == 3
    # failures really happened, in several stages
    assert len(os.listdir(os.path.join(tmp_dir, "failed-attempts"))) >= 4
