"""The scratch folder."""

import pytest

from wortfund.session import drop_scratch, scratch_path


class Conf:
    def __init__(self, folder):
        self.folder = folder

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default


class Session:
    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = Conf(folder)


def test_scratch_lies_in_the_folder_of_the_cluster():
    session = Session("yarn", "hdfs://shared/checkpoints/")
    first, second = scratch_path(session, "a"), scratch_path(session, "a")
    assert first.startswith("hdfs://shared/checkpoints/a-") and first != second


def test_a_cluster_without_that_folder_is_an_error():
    with pytest.raises(ValueError):
        scratch_path(Session("yarn"), "a")


def test_a_local_session_may_do_without():
    assert "wortfund-" in scratch_path(Session("local[2]"), "a")


def test_scratch_tables_are_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    assert not (tmp_path / "t").exists()
