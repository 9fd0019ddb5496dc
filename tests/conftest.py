from __future__ import annotations

import contextlib
import io
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lakestream.session import local_session

    # failed tasks are retried, as on a cluster
    s = local_session(4, shuffle_partitions=4, app="lakestream-tests", task_attempts=4)
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from lakestream.session import scratch_path

    return lambda name="t": scratch_path(spark, name)


def plan_text(df, mode: str | None = None) -> str:
    """The physical plan as ``explain`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()
