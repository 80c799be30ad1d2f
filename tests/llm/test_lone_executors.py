"""Every operator where the Python workers have no copy of the package."""

import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from spanshade.session import local_session
from spanshade.llm.queries import queries

spark = local_session(4, shuffle_partitions=4)

def missing(batches):
    try:
        import spanshade
    except ModuleNotFoundError:
        yield from batches

assert spark.range(3).mapInArrow(missing, "id long").count() == 3, "the workers have the package"
for name, query in queries().items():
    query(spark, {SF!r}).write.format("noop").mode("overwrite").save()
    print("done", name, flush=True)
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_workers_need_no_copy_of_the_package(tmp_path):
    from spanshade.llm.queries import queries

    (tmp_path / "run.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-3000:]
    assert [x.split()[1] for x in run.stdout.splitlines() if x.startswith("done ")] == list(queries())
