from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from panelwright import session


def _fake(folder, master, app):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId=app),
    )


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(_fake("hdfs:///shared/", "yarn", "a")) == "hdfs:///shared"
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_only_a_local_session_may_use_a_folder_of_its_own():
    local = _fake(None, "local[2]", "b")
    assert session.shared_folder(local) == session.shared_folder(local)
    with pytest.raises(ValueError):
        session.shared_folder(_fake(None, "spark://host:7077", "c"))


def test_landed_rows_are_read_back_until_cleaned(spark):
    rows = session.landed(spark.range(10))
    assert rows.count() == 10
    path = rows.inputFiles()[0]
    session.clean(spark)
    assert not os.path.exists(path.removeprefix("file://"))
