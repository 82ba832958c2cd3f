"""The launcher's settings stay, and the shared folder is asked for."""

import os
import subprocess
import sys

import pytest

from tillflow import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_launch_settings_survive(tmp_path):
    code = (
        "from tillflow.session import get_session, scratch_path\n"
        "s = get_session()\n"
        "p = scratch_path(s, 'x')\n"
        "s.range(1).write.parquet(p)\n"
        "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.driver.memory'), p)\n"
    )
    args = f"--master local[2] --driver-memory 700m --conf spark.sql.shuffle.partitions=64 --conf spark.ui.enabled=false --conf spark.checkpoint.dir={tmp_path} pyspark-shell"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, env=os.environ | {"PYSPARK_SUBMIT_ARGS": args, "PYTHONPATH": ROOT})
    got = out.stdout.split("GOT ")[1].split()
    assert got[:3] == ["local[2]", "64", "700m"] and got[3].startswith(str(tmp_path)), out.stderr[-2000:]
    assert not os.path.exists(got[3])  # scratch goes with the session


class _Cluster:
    class sparkContext:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class conf:
        get = staticmethod(lambda key, default: default)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Cluster)
