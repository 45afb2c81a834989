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
rows = entry.queries()["auc_difference_one_group"](spark, "/root/testdata/sf0.001").collect()
print("rows", len(rows))
"""


def test_pandas_jobs_find_the_package_from_any_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", JOB.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0 and "rows 1" in done.stdout, done.stderr[-2000:]


HIDDEN = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{name!r}] = None  # importing it fails
import __spark_entry__ as entry
names = entry.queries()
print("core", sum(not (n.startswith("op") or n == "pipeline") for n in names), "of", len(names))
"""


@pytest.mark.parametrize("name", ["public_tokenizers", "regex", "corpus_pipeline"])
def test_the_core_queries_load_without_the_libraries_of_others(name):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", HIDDEN.format(root=root, name=name)], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    _, core, _, every = done.stdout.split()
    assert core == every and int(core) >= 222
