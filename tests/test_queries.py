"""Every registered query that has SQL gives the SQL's rows."""

import pytest
from compare import differences, duck
from ledgerline.plans.registry import load

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n, r in load().items() if r.sql))
def test_same_rows(spark, con, name):
    entry = load()[name]
    assert differences(entry.run(spark, SF), con, entry.sql) == ""


@pytest.mark.parametrize("name", sorted(n for n, r in load().items() if not r.sql))
def test_runs(spark, name):
    assert load()[name].run(spark, SF).count() >= 0
