import os
import subprocess
import sys

import dayline

SCRIPT = """
import importlib.util, sys
sys.path.insert(0, {repo!r})
from dayline.session import build_session
spark = build_session("away", "local[1]", spark__ui__enabled="false")
def run(batches):
    import dayline.models.least_squares as m
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([m.__file__])], names=["f"])
print("FROM", spark.range(1, numPartitions=1).mapInArrow(run, "f string").first()[0])
spark.stop()
"""


def test_workers_get_the_package_from_an_empty_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(dayline.__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True,
                          text=True, timeout=120)
    assert "FROM" in done.stdout and ".zip" in done.stdout, done.stderr[-2000:]
