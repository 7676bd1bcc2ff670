from types import SimpleNamespace

import pytest

from trasvase.session import scratch_path, shared_dir


def session(master, named=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: named or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_named_folder_is_used():
    assert shared_dir(session("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"
    first, second = (scratch_path(session("yarn", "hdfs://shared/x"), "roles") for _ in range(2))
    assert first.startswith("hdfs://shared/x/trasvase/roles-") and first != second


def test_only_a_local_session_falls_back_on_a_temporary_folder():
    assert shared_dir(session("local[2]")) == shared_dir(session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))
