from types import SimpleNamespace

import pytest

from clicklake.session import scratch_path


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, configured=None):
    conf = SimpleNamespace(get=lambda key, default: configured if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=FakeContext(master))


def test_scratch_is_in_the_configured_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(fake("yarn", "hdfs://n/c/"), "x").startswith("hdfs://n/c/clicklake/x-")


def test_only_a_local_master_may_use_a_local_folder():
    local = fake("local[2]")
    assert scratch_path(local, "x").startswith(local.sparkContext.folder)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(fake("yarn"), "x")
