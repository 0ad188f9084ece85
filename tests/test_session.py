from types import SimpleNamespace

import pytest

from docsift.session import CHECKPOINT_DIR, work_folder


def session(master, **conf):
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize(
    ("master", "conf", "want"),
    [
        ("spark://host", {CHECKPOINT_DIR: "file:/shared"}, "file:/shared"),
        ("local[8]", {"spark.sql.warehouse.dir": "file:/w"}, "file:/w"),
        ("spark://host", {"spark.sql.warehouse.dir": "hdfs://n/w"}, "hdfs://n/w"),
    ],
)
def test_work_folder(master, conf, want):
    assert work_folder(session(master, **conf)) == want


@pytest.mark.parametrize("conf", [{}, {"spark.sql.warehouse.dir": "file:/w"}, {"spark.sql.warehouse.dir": "/w"}])
def test_cluster_needs_a_shared_folder(conf):
    with pytest.raises(RuntimeError, match="executor"):
        work_folder(session("spark://host", **conf))
