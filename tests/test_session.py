from types import SimpleNamespace

import pytest

from orgloom.session import work_dir


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_the_shared_folder_is_read_from_the_session(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_dir(session("yarn", "hdfs://shared"), "x").startswith("hdfs://shared/orgloom/x-")


def test_without_a_shared_folder(tmp_path):
    one, two = work_dir(session("local[2]"), "x"), work_dir(session("local[2]"), "y")
    assert one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(session("spark://host:7077"), "x")
