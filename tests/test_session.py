"""The package reaches executors, and intermediates a shared folder."""

import os
import subprocess
import sys

import pytest

from tabulyte import session


def test_archive_is_importable_from_another_folder(tmp_path):
    path = session.package_archive(str(tmp_path))
    code = "import tabulyte.operators.neighbours, tabulyte.plans.registry; print(tabulyte.operators.neighbours.__file__)"
    said = subprocess.run([sys.executable, "-c", code], cwd="/", env=os.environ | {"PYTHONPATH": path}, capture_output=True, text=True, check=True)
    assert path in said.stdout


class _Remote:
    """What `checkpoint_root` and `shipped` see of a session on a cluster."""

    def __init__(self, root=None):
        self.sparkContext, self.conf, self.files, self.root = self, self, [], root
        self.master, self.applicationId = "spark://host:7077", f"app-{id(self)}"

    def get(self, key, default=None):
        return self.root

    def addPyFile(self, path):
        self.files.append(path)

    def getCheckpointDir(self):
        return self.root


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Remote())
    assert session.checkpoint_root(_Remote("hdfs://store/tmp/")) == "hdfs://store/tmp"


def test_the_package_is_shipped_once():
    remote = _Remote("x")
    session.shipped(session.shipped(remote))
    assert len(remote.files) == 1 and remote.files[0].endswith("tabulyte.zip")
