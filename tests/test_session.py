"""Where data that must outlive an executor goes."""

from types import SimpleNamespace

import pytest

from tallyward.session import scratch_path, shared_root


def _session(configured=None, current=None, master="yarn"):
    chosen = [current]
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: chosen[0],
        setCheckpointDir=lambda path: chosen.__setitem__(0, path),
    )
    return SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default: configured)
    )


def test_the_cluster_names_the_folder():
    session = _session(configured="hdfs://shared/checkpoints")
    assert shared_root(session) == "hdfs://shared/checkpoints"
    assert session.sparkContext.getCheckpointDir() == "hdfs://shared/checkpoints"


def test_a_folder_set_on_the_context_is_kept():
    session = _session(current="hdfs://other/here")
    assert shared_root(session) == "hdfs://other/here"
    assert scratch_path(session, "marts").startswith("hdfs://other/here/marts-")


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        shared_root(_session())


def test_a_local_session_may_use_a_temporary_folder():
    session = _session(master="local[2]")
    assert shared_root(session) == session.sparkContext.getCheckpointDir()
