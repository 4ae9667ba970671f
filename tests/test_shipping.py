"""Queries whose functions run in Python workers, started from a folder that is not the repository."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, {here!r})
import __spark_entry__ as e
from tidemark.session import local_session
spark = local_session(2)
for name in ("vector_topk", "rag_prompts", "udf_chunk"):
    print(name, e.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_find_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(here=HERE)
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    counts = dict(line.split() for line in done.stdout.splitlines() if line.split()[0] in CODE)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(counts) == 3 and all(int(n) > 0 for n in counts.values())
