"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tallyward.operators import cost, quality, ranking, slicing, utilization
from tallyward.plans import dashboard, marts, measures
from tallyward.schemas import CLAIMS, PATIENTS
from tallyward.session import materialize
from tallyward.sinks import files
from tallyward.sources import testbed

EAGER = {  # write files or numbered rows while they are built
    "read_tables", "write_datasets", "write_qc_report", "export_marts", "export_dashboard",
    "store_claims",
    "patient_ntile", "high_cost_cohort", "cost_percentiles",
}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(frame) -> list[str]:
    """Columns read by each scan of the plan."""
    return re.findall(r"ReadSchema: struct<([^\n]*)>", plan(frame))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Claims and patients as parquet, large enough for Spark not to know."""
    root = str(tmp_path_factory.mktemp("stored"))
    files.store_claims(testbed.claims(spark, sf_dir), f"{root}/claims")
    testbed.patients(spark, sf_dir).write.parquet(f"{root}/patients")
    return (
        spark.read.schema(CLAIMS).parquet(f"{root}/claims"),
        spark.read.schema(PATIENTS).parquet(f"{root}/patients"),
    )


@pytest.mark.parametrize("name", sorted(set(queries()) - EAGER))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_year_filter_prunes_partitions(stored):
    claims, _ = stored
    text = plan(cost.monthly_spend(slicing.slice_rows(claims, service_year=[1997], region=["West"])))
    assert re.search(r"PartitionFilters: \[[^\]]*service_year", text)
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(region,West\)", text)


def test_scans_read_only_what_is_needed(stored):
    claims, patients = stored
    assert scans(utilization.facility_utilization(claims)) == [
        "facility_type:string,total_cost:decimal(12,2)"
    ]
    assert scans(quality.qc_orphans(claims, patients)) == ["patient_id:bigint", "patient_id:bigint"]


def test_unused_dimensions_are_not_joined(spark, sf_dir):
    lines_only = queries()["monthly_volume"](spark, sf_dir)
    assert len(scans(lines_only)) == 1
    assert scans(lines_only) == ["l_extendedprice:double,l_shipdate:timestamp_ntz"]
    assert len(scans(queries()["measure_avg_cost"](spark, sf_dir))) == 1


def test_partial_aggregation_before_every_shuffle(stored):
    text = plan(marts.mart_claims_summary(stored[0]))
    assert text.count("Exchange") == 1
    assert "partial_count" in text.split("Exchange")[1]


def test_large_sides_are_not_broadcast(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        text = plan(queries()["cost_by_payer"](spark, sf_dir))
        assert "BroadcastHashJoin" not in text
        # Customers meet the orders, not the line items, which are shuffled once.
        assert text.count("SortMergeJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orphans_are_counted_before_the_anti_join(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(quality.qc_orphans(*stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in text
    before, after = text.split("LeftAnti")
    assert after.index("HashAggregate") < after.index("FileScan")


def test_rank_never_gathers_rows(stored):
    tiled = ranking.patient_ntile(stored[0])
    text = plan(tiled)
    # Only the per-partition sizes go through a single partition.
    single = text.split("SinglePartition")[1]
    assert "HashAggregate" in single.split("Scan")[0]
    numbered = text.split("BroadcastExchange")[0]
    assert "Window" not in numbered and "SinglePartition" not in numbered


def test_summary_grain_does_not_change_sums(stored):
    claims, _ = stored
    full = marts.mart_claims_summary(claims)
    coarse = marts.summary_at(claims, [], ["total_spend", "claims", "readmissions"])
    for measure in (
        measures.measure_spend_m,
        measures.measure_claims,
        measures.measure_avg_cost,
        measures.measure_readmit_pct,
        measures.cost_per_readmission,
    ):
        assert measure(full).collect() == measure(coarse).collect()


def _same(one, other):
    assert one.dtypes == other.dtypes
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_cubes_serve_marts_and_panels_like_raw_claims(stored):
    claims, patients = stored
    by_patient = materialize(marts.patient_cube(claims))
    cube = materialize(
        marts.claims_cube(claims, dashboard.PANEL_KEYS, dashboard.PANEL_BLOCKS)
    )
    for build in (marts.all_marts, dashboard.dashboard):
        direct = build(claims, claims, patients)
        cubed = build(cube, by_patient, patients)
        assert set(cubed) == set(direct)
        for name, expected in direct.items():
            _same(cubed[name], expected)


def test_keys_of_the_test_tables_are_unique(spark, sf_dir):
    for table, key in (("orders", "o_orderkey"), ("part", "p_partkey"), ("customer", "c_custkey"), ("nation", "n_nationkey")):
        frame = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        assert frame.groupBy(key).count().filter(F.col("count") > 1).isEmpty()
