"""Working data never goes to one machine's disk where there are several machines."""

from __future__ import annotations

import pytest

from weirflow.scratch import scratch_dir


class Session:
    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_is_used():
    session = Session(**{"spark.checkpoint.dir": "hdfs://shared/", "spark.master": "yarn"})
    assert scratch_dir(session, "x").startswith("hdfs://shared/weirflow/")


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,1024]", "spark://host:7077"])
def test_cluster_without_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(**{"spark.master": master}), "x")


def test_local_session_gets_a_folder():
    assert "weirflow" in scratch_dir(Session(**{"spark.master": "local[2]"}), "x")
