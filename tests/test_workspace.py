import os
from types import SimpleNamespace

import pytest

from topup_analytics.plans.workspace import new_folder


def session(shared, master):
    conf = SimpleNamespace(get=lambda key, default: shared)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_of_the_session():
    first, second = (new_folder(session("hdfs://x/shared/", "yarn")) for _ in range(2))
    assert first.startswith("hdfs://x/shared/topup-") and first != second


def test_local_session_without_the_setting():
    folder = new_folder(session(None, "local[8]"))
    assert os.path.isdir(os.path.dirname(folder))


def test_cluster_without_the_setting():
    with pytest.raises(ValueError):
        new_folder(session(None, "spark://host:7077"))
