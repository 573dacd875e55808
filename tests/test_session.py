import pytest

from stayline import session


class Cluster:
    """A session on a cluster, as far as the folder is concerned."""

    def __init__(self, folder):
        self.folder, self.used = folder, None
        self.sparkContext, self.conf = self, self
        self.master = "spark://somewhere:7077"

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.folder or default

    def getCheckpointDir(self):
        return self.used

    def setCheckpointDir(self, folder):
        self.used = folder


def test_the_session_names_the_folder(spark):
    folder = session.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert folder in spark.sparkContext.getCheckpointDir()


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster(None))
    named = Cluster("hdfs:///shared")
    assert session.shared_folder(named) == "hdfs:///shared" == named.used


@pytest.mark.parametrize("master, own", [("local", True), ("local[4]", True), ("local[*]", True), ("local-cluster[2,1,1024]", False)])
def test_only_tasks_in_the_driver_may_go_without(master, own):
    there = Cluster(None)
    there.master, there.applicationId = master, "app"
    if own:
        assert "stayline-app" in session.shared_folder(there)
    else:
        with pytest.raises(ValueError):
            session.shared_folder(there)
