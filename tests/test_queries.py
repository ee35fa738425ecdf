"""Every query with SQL is held against it on the small tables."""

import datetime
import decimal
import os

import duckdb
import pytest

import __spark_entry__
from docledger.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, (bool, str)):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return "None" if v != v else str(round(float(v), 5))
    return str(v.date()) if isinstance(v, datetime.datetime) else str(v)


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted([plain(r[c]) for c in names] for r in df.collect())
    if name not in catalogue.ORACLES:
        assert got
        return
    table = duck.execute(catalogue.ORACLES[name]).to_arrow_table() if hasattr(duck, "to_arrow_table") else duck.execute(catalogue.ORACLES[name]).fetch_arrow_table()
    assert sorted(table.column_names) == names
    want = sorted([plain(r[c]) for c in names] for r in table.to_pylist())
    assert got == want


def test_plan_of_bank_matches_is_small(spark):
    """Spark keeps and logs a plan's text again at each step, so the tables of `fold` mustn't stand in it dozens of times."""
    plan = catalogue.QUERIES["q_bank_interval_match"](spark, SF)._jdf.queryExecution()
    assert len(plan.executedPlan().toString()) < 300_000


def test_policy_pages_are_extracted(spark):
    """The whole table of papers has the amounts, totals and folios of policy pages."""
    got = {(r.label, r.normalized_value[:2]) for r in __spark_entry__.queries()["q_entity_extract"](spark, SF).where("label = 'total' or normalized_value like 'P-%'").collect()}
    assert ("folio o referencia", "P-") in got and "total" in {x for x, _ in got}


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
