"""Every registered query beside its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from checks import load_all
from checks.compare import difference
from checks.registry import ORACLES

load_all()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    found, rows = difference(spark, "/root/testdata/sf0.001", name)
    assert found is None
