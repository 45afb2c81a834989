import os
import subprocess
import sys

import pytest

JOB = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from riskloom.session import local_session
spark = local_session(2)
print("rows", entry.queries()[{name!r}](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize(("name", "rows"), [("op3_token_counts", 200), ("op10_top_k", 50)])
def test_operators_run_from_any_folder(tmp_path, name, rows):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", JOB.format(root=root, name=name)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0 and f"rows {rows}" in done.stdout, done.stderr[-2000:]
