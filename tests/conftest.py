from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from partnerkpi.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", app="partnerkpi-tests", extra={"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_ctx(spark):
    """sf0.001, derived inputs written to a temporary folder, with a month threshold of 1 order (every part has rows)."""
    from partnerkpi.context import KpiContext
    from partnerkpi.params import FIXTURE_PARAMS
    from partnerkpi.sources.catalog import materialize_fixture

    with tempfile.TemporaryDirectory(prefix="partnerkpi-tests-") as root:
        wh = materialize_fixture(spark, SF_SMALL, f"{root}/inputs")
        with KpiContext(spark, wh, FIXTURE_PARAMS.with_(min_month_orders=1), staging=True) as ctx:
            yield ctx
