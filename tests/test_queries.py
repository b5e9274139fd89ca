"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    assert difference(spark, duck, name, SF) is None


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 243


def test_batch_summary(spark):
    rows = contract.queries()["run_batch_summary"](spark, SF).collect()
    got = {(r["step"], r["stage"], r["metric"]): r["value"] for r in rows}
    total = sum(int(v) for (_, stage, metric), v in got.items()
                if stage == "bronze" and metric == "records_ingested")
    assert total == 6000
    assert got[2, "gold", "batch_date"] == "1998-06-01"
    assert {r["stage"]: r["status"] for r in rows} == {
        "bronze": "SUCCESS", "silver": "DQ_WARNING", "gold": "SUCCESS", "checks": "FAIL"}
