from types import SimpleNamespace

import pytest

from tidemark.session import pin, shared_dir, sized_for

TB = 1024**4


@pytest.mark.parametrize("size, partitions, scan_mib", [(10**9, 200, 128), (TB, 5243, 128), (100 * TB, 40_000, 1024)])
def test_sizes(size, partitions, scan_mib):
    got = sized_for(size)
    assert int(got["spark.sql.shuffle.partitions"]) == partitions
    assert int(got["spark.sql.files.maxPartitionBytes"]) // 1024**2 == scan_mib


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake_session(master, configured):
    conf = SimpleNamespace(get=lambda key, default: configured if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=FakeContext(master))


def test_shared_folder_comes_from_the_session():
    assert shared_dir(fake_session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_dir(fake_session("local[2]", "/named")) == "/named"


def test_only_a_local_session_makes_its_own_folder():
    local = fake_session("local[2]", None)
    assert shared_dir(local) == shared_dir(local) == local.sparkContext.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake_session("yarn", None))


def test_pin_cuts_lineage(spark):
    pinned = pin(spark.range(10).selectExpr("id * 2 AS v"))
    assert sorted(r.v for r in pinned.collect()) == list(range(0, 20, 2))
    assert "Range" not in pinned._jdf.queryExecution().analyzed().toString()
