import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("strata-tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="strata-wh-"),
    })
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Collected values of `cols` (all columns when none given), in order."""
    sel = df.select(*[f"`{c}`" for c in cols]) if cols else df
    return [tuple(r) for r in sel.collect()]
