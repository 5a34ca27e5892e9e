"""The distributed rank, NTILE and percentiles against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.operators import percentiles, ranking
from tests.fixtures import claims, rows


def _ntile(count, tiles):
    """Tile numbers of `count` ordered rows."""
    larger, size = count % tiles, count // tiles
    sizes = [size + 1] * larger + [size] * (tiles - larger)
    return [tile for tile, n in enumerate(sizes, start=1) for _ in range(n)]


@pytest.mark.parametrize("count", [1, 7, 19, 20, 21, 39, 300])
def test_ntile_sizes(spark, count):
    ranks = spark.range(1, count + 1).select(F.col("id").alias("rank"), F.lit(count).alias("of"))
    tiles = ranks.select("rank", ranking.ntile_of("rank", "of", 20)).orderBy("rank")
    assert [tile for _, tile in rows(tiles)] == _ntile(count, 20)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_rank_across_many_partitions_with_ties(spark, adaptive):
    random.seed(7)
    # A third of the rows share one cost.
    data = [(i, random.choice([500, random.randrange(1000), random.randrange(1000)])) for i in range(2000)]
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        frame = spark.createDataFrame(data, "id long, cost long").repartition(16)
        ranked = ranking.global_rank(frame, [F.desc("cost"), F.asc("id")])
        found = {row.id: row["rank"] for row in ranked.collect()}
        assert {row.rank_of for row in ranked.select("rank_of").distinct().collect()} == {2000}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    expected = sorted(data, key=lambda row: (-row[1], row[0]))
    assert found == {row[0]: position for position, row in enumerate(expected, start=1)}


def test_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "id long")
    assert rows(ranking.global_rank(empty, [F.asc("id")])) == []


def test_tied_patients_are_ordered_by_id(spark):
    data = claims(spark, *[{"patient_id": i} for i in (3, 1, 2)])
    tiles = ranking.patient_ntile(data, tiles=2).orderBy("patient_id")
    assert rows(tiles) == [(1, 100.0, 1), (2, 100.0, 1), (3, 100.0, 2)]


def test_cohort_of_a_small_population(spark):
    data = claims(
        spark, *[{"patient_id": i, "total_cost": f"{i}.50"} for i in range(1, 22)], {"patient_id": 5, "total_cost": "1.00"}
    )
    # 21 patients: the first of 20 tiles holds the two most expensive.
    assert rows(ranking.high_cost_cohort(data)) == [
        ("Top 5% high-cost patients", 2, 42.0, round(42.0 / 242.5 * 100, 2))
    ]


def test_cohort_of_nothing(spark):
    none = claims(spark, {}).filter("claim_id < 0")
    assert rows(ranking.high_cost_cohort(none)) == [("Top 5% high-cost patients", 0, None, None)]


def test_percentiles_against_numpy(spark):
    random.seed(11)
    amounts = {
        "one": [random.randrange(1, 10**7)],
        "two": [random.randrange(1, 10**7) for _ in range(2)],
        "wide": [random.randrange(-(10**11), 10**11) for _ in range(501)],
        "narrow": [random.choice([7, 7, 7, random.randrange(300_000)]) for _ in range(800)],
        None: [random.randrange(10**6) for _ in range(100)],
    }
    data = [(name, cents / 100) for name, values in amounts.items() for cents in values]
    data += [("narrow", None), ("missing", None)]
    frame = spark.createDataFrame(data, "region string, total_cost double").repartition(8)
    points = {"low": "0", "third": "0.333", "p50": "0.5", "p90": "0.9", "top": "1"}
    found = {
        row.region: row for row in percentiles.grouped_percentiles(frame, ["region"], points=points).collect()
    }
    assert set(found) == {*amounts, "missing"}
    for name, values in amounts.items():
        for point, fraction in points.items():
            exact = np.percentile(np.array(values, dtype="float64"), float(fraction) * 100)
            assert found[name][point] == pytest.approx(exact / 100, abs=0.0051)
        assert found[name]["mean"] == pytest.approx(np.mean(values) / 100, abs=0.0051)
    assert tuple(found["missing"])[1:] == (None,) * (len(points) + 1)


def test_percentiles_need_a_group(spark):
    with pytest.raises(ValueError):
        percentiles.grouped_percentiles(claims(spark, {}), [])
