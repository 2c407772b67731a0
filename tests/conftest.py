from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shoplake.config import LakeConfig  # noqa: E402
from shoplake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(
        4,
        "tests",
        **{
            "spark.checkpoint.dir": str(folder),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cfg(tmp_path, request):
    name = "".join(c if c.isalnum() else "_" for c in request.node.name)
    return LakeConfig(root=str(tmp_path / "lake"), database=f"db_{name}")


def rows(df):
    """Rows in a comparable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def executed_plan(df) -> str:
    """The plan that ran, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
