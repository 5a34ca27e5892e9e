"""Every registered query against its SQL counterpart, values and types."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle.statements import statements

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    with duckdb.connect() as connection:
        for table in TABLES:
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
            )
        yield connection


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


@pytest.mark.parametrize("name", sorted(statements()))
def test_matches_sql(spark, sf_dir, oracle, name):
    frame = queries()[name](spark, sf_dir)
    expected = oracle.execute(oracle_sql()[name])
    types = {column[0]: TYPES[str(column[1])] for column in expected.description}
    assert dict(frame.dtypes) == types
    columns = sorted(types)
    order = [list(types).index(column) for column in columns]
    theirs = [tuple(row[i] for i in order) for row in expected.fetchall()]
    ours = [tuple(row) for row in frame.select(*columns).collect()]
    assert ours, "a registered query should find something in the test tables"
    assert _sorted(ours) == _sorted(theirs)


def test_every_query_has_an_oracle():
    # The queries on training data have tests of their own.
    own = {name for name in queries() if not name.startswith("op") and name != "pipeline"}
    assert own == set(statements()) <= set(oracle_sql())


def test_entry_is_the_flagship(spark):
    result = entry(spark)
    assert result.columns == ["region", "year", "avg_cost", "prev_year_cost", "yoy_pct_change"]
    assert result.count() > 0
