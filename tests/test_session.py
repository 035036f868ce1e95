from types import SimpleNamespace

import pytest

from starledger.session import scratch_path, shared_dir


def session(master, setting=None, current=None):
    conf = SimpleNamespace(get=lambda name, default: setting or default)
    made = []
    sc = SimpleNamespace(
        master=master,
        getConf=lambda: conf,
        getCheckpointDir=lambda: made[-1] if made else current,
        setCheckpointDir=made.append,
    )
    return SimpleNamespace(sparkContext=sc)


def test_named_folder_is_used():
    assert shared_dir(session("yarn", "/shared/x/")) == "/shared/x"
    assert scratch_path(session("yarn", "/shared/x"), "a").startswith("/shared/x/starledger-a-")


def test_folder_set_on_the_context_is_used():
    assert shared_dir(session("yarn", None, "hdfs://x/y")) == "hdfs://x/y"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(session("yarn"))


def test_local_session_keeps_its_own_folder():
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local)
