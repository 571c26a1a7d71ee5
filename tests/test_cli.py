import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_lists_queries_and_jobs():
    out = subprocess.run([sys.executable, "-m", "linewise", "list"], cwd=ROOT, capture_output=True, text=True,
                         timeout=120, check=True).stdout
    assert "q01_boundary_group_totals" in out and "top_records_total" in out
