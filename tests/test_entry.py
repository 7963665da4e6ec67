"""Driver contract: entry, every registered query, and the oracle match."""

import duckdb
import pytest

import __spark_entry__ as E
from hirescope.plans import registry
from hirescope.sources.tables import TABLES
from tests.conftest import SF_SMALL


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["skill_name", "jobs_requiring_skill", "skill_demand_score", "skill_rarity_score",
                          "demand_category"]


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    """Rows, column names and column types (the query runs once)."""
    import tools.compare as C
    df = registry.QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = registry.ORACLE.get(name)
    if sql is None:
        return
    rel = con.sql(sql)
    kinds = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields} == kinds
    assert C.digest(df.columns, rows)[0] == C.digest(rel.columns, rel.fetchall())[0]
