"""Sessions: the submit configuration holds, and no machine-local folder on a cluster."""

import json
import os
import subprocess
import sys

import pytest

from lakeline import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class FakeContext:
    def __init__(self, master, **conf):
        self.master, self.conf = master, conf

    def getConf(self):
        return self.conf

    def setCheckpointDir(self, path):
        self.dir = path


class FakeConf(dict):
    def set(self, k, v):
        self[k] = v


class FakeSpark:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = FakeContext(master, **conf), FakeConf()


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_root(FakeSpark(master))
    assert session.checkpoint_root(FakeSpark("yarn", **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    assert session.checkpoint_root(FakeSpark("local[2]")).startswith("/tmp/")


def test_the_submit_configuration_survives_the_command_line(tmp_path):
    """A fresh process with submit arguments: master and shuffle partitions stay as given."""
    code = ("import json; from lakeline.session import submitted_session; s = submitted_session(); "
            "print('GOT', json.dumps([s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions')])); s.stop()")
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS":
                        "--master local[2] --conf spark.sql.shuffle.partitions=33 --conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=tmp_path)
    line = [x for x in out.stdout.splitlines() if x.startswith("GOT")][0]
    assert json.loads(line[4:]) == ["local[2]", "33"]
