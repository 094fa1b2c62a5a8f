from __future__ import annotations

from types import SimpleNamespace

import pytest

from tallywright.session import settings, work_dir


class Context:
    def __init__(self, master):
        self.master, self.applicationId, self.folder = master, f"app-{master}", None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, named=None):
    return SimpleNamespace(sparkContext=Context(master), conf=SimpleNamespace(get=lambda key, default: named))


def test_named_folder_is_used():
    fake = session("yarn", "hdfs:///shared/")
    assert work_dir(fake) == "hdfs:///shared"
    assert fake.sparkContext.folder == "hdfs:///shared/"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError):
        work_dir(session("yarn"))


def test_local_master_gets_one_folder():
    fake = session("local[2]")
    assert work_dir(fake) == work_dir(fake) == fake.sparkContext.folder


def test_settings_are_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with settings(spark, {key: "3", "spark.tallywright.test": "x"}):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.tallywright.test", None) is None
