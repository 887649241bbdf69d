"""Every registered query against its SQL, and the inventory that the queries cover."""

import pytest

import __spark_entry__ as driver
from checks import coverage
from checks.catalog import ENTRIES
from checks.compare import arrow_rows, connect, difference
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n in ENTRIES if not n.startswith("job_paid")])
def test_query_equals_its_sql(spark, duck, name):
    got = arrow_rows(ENTRIES[name].run(spark, SMALL).toArrow())
    wanted = arrow_rows(duck.sql(ENTRIES[name].sql).to_arrow_table())
    assert difference(got, wanted) is None
    assert len(got) > 0 or name == "rpt_funnel_health_old"


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.columns[:3] == ["date", "platform", "campaign_id"] and df.count() > 0


def test_every_query_has_sql():
    assert set(ENTRIES) <= set(driver.queries()) and set(ENTRIES) <= set(driver.oracle_sql())


def test_whole_inventory_is_covered():
    listed = set(coverage.inventory())
    covered = {c for e in ENTRIES.values() for c in e.covers}
    assert len(listed) > 180
    assert listed - covered - set(coverage.WITHOUT_QUERY) == set()
    assert (coverage.ROOT / "COVERAGE.md").read_text() == coverage.table()
