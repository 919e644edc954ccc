"""The package reaches the Python workers from any working directory."""

import os
import subprocess
import sys

from conftest import ROOT

PROGRAM = """
import sys
sys.path.insert(0, {root!r})
from quillstream.session import build_session, ship_package
spark = build_session("local[2]", app_name="shipping")
ship_package(spark)
ship_package(spark)

def run(batches):
    from quillstream.functions import text
    for batch in batches:
        assert text.__name__ == "quillstream.functions.text"
        yield batch

print("rows", spark.range(3).mapInArrow(run, "id long").count())
spark.stop()
"""


def test_workers_import_the_package(scratch):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM.format(root=ROOT)], cwd=scratch, env=env, capture_output=True, text=True, timeout=200)
    assert "rows 3" in done.stdout, done.stderr[-2000:]
