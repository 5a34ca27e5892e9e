"""Queries that write files do not join the claims again for the quality table."""

import pytest

import __spark_entry__ as entry
from tallyward.plans import quality_metrics as quality_mart


@pytest.mark.parametrize("name", ["read_tables", "write_datasets"])
def test_quality_table_comes_from_the_stored_claims(monkeypatch, spark, sf_dir, name):
    read: list[str] = []
    measure = quality_mart.quality_metrics

    def seen(claims):
        read.extend(claims.inputFiles())
        return measure(claims)

    monkeypatch.setattr(quality_mart, "quality_metrics", seen)
    found = {row["table_name"]: row["rows"] for row in entry.queries()[name](spark, sf_dir).collect()}
    assert found.keys() == {"patients", "claims", "quality_metrics"} and all(found.values())
    assert read and all(file.endswith(".csv") for file in read)
