"""The queries on workers that cannot import this repository."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from sparkrank.session import local_session
from sparkrank.llm.queries import QUERIES
spark = local_session(4, "workers")
spark.sparkContext.setCheckpointDir({shared!r})

def seen(_):
    try:
        import sparkrank
        return [True]
    except ModuleNotFoundError:
        return [False]

assert spark.sparkContext.parallelize([0], 1).mapPartitions(seen).collect() == [False]
for name in ("op5_multi_index", "op10_quality", "op12_jaccard", "op13_periodic"):
    print(name, QUERIES[name](spark, {tables!r}).count())
"""


def test_without_the_package(tmp_path, sf_dir):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not os.path.exists(os.path.join(p, "sparkrank"))]
    env = os.environ | {"PYTHONPATH": os.pathsep.join(paths)}
    code = SCRIPT.format(repo=repo, shared=str(tmp_path), tables=sf_dir)
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False)
    assert out.returncode == 0, out.stderr[-2000:]
    assert len(out.stdout.split()) == 8
