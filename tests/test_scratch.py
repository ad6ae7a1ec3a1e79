import pytest

from checks.scratch import scratch_folder


class Session:
    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: folder)})


def test_the_folder_named_by_the_session_is_used():
    folder = scratch_folder(Session("yarn", "hdfs:///shared/"))
    assert folder.startswith("hdfs:///shared/panelspan-")


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session("yarn", None))


def test_tests_on_this_machine_may_go_without(spark):
    assert scratch_folder(spark) != scratch_folder(spark)
