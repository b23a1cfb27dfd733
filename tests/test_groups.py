"""D* group-context operators: single-member groups, spans, and brute-force neighbour counts."""

import random

from pyspark.sql import functions as F

from lathe.operators import groups as grp


def test_group_size_and_zscore_single_member(spark):
    df = spark.createDataFrame([("g1", 10.0), ("g1", 20.0), ("g2", 5.0)], "TravelGroup string, TotalSpending double")
    out = {(r.TravelGroup, r.TotalSpending): r for r in grp.group_zscore(grp.group_size(df), "TotalSpending").collect()}
    assert out[("g2", 5.0)].GroupSize == 1
    assert out[("g2", 5.0)].GroupSpendingZScore == 0.0          # std of one member -> 0, (x - mean) = 0
    std = 7.0710678118654755
    assert abs(out[("g1", 10.0)].GroupSpendingZScore - (-5.0 / (std + 1))) < 1e-12


def test_minmax_position_span_zero_and_null(spark):
    df = spark.createDataFrame([("A", 5), ("A", 5), ("B", 0), ("B", 10), ("C", None)], "Deck string, CabinNumber int")
    got = sorted((r.Deck, r.CabinNumber_DeckPercentile) for r in grp.minmax_position(df).collect())
    assert got == [("A", 0.0), ("A", 0.0), ("B", 0.0), ("B", 1.0), ("C", 0.5)]


def test_neighborhood_density_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("ABU"), rnd.randint(0, 400)) for _ in range(400)] + [("U", 0)] * 5
    df = spark.createDataFrame(rows, "Deck string, CabinNumber int").withColumn("rid", F.monotonically_increasing_id())
    got = sorted((r.Deck, r.CabinNumber, r.CabinNeighborhoodDensity) for r in grp.neighborhood_density(df).collect())
    want = sorted((d, c, float(sum(1 for d2, c2 in rows if d2 == d and abs(c2 - c) <= 50) - 1)) for d, c in rows)
    assert got == want
    assert sum(x[2] for x in got) % 2 == 0                         # every neighbour pair counted twice


def test_name_frequency_null_is_one(spark):
    df = spark.createDataFrame([("A Lee",), ("B Lee",), (None,), ("  ",), ("C Kim",)], "Name string")
    got = sorted(r.FamilySizeFromName for r in grp.name_frequency(df).collect())
    assert got == [1, 1, 1, 2, 2]


def test_side_spending_diff_missing_side_is_zero(spark):
    df = spark.createDataFrame([(1, "P", 10.0), (1, "S", 4.0), (2, "P", 7.0)], "CabinNumber int, Side string, TotalSpending double")
    got = sorted((r.CabinNumber, r.SideSpendingDiff) for r in grp.side_spending_diff(df).collect())
    assert got == [(1, 6.0), (1, 6.0), (2, 7.0)]


def test_group_features_plan_has_no_python_and_no_cartesian(spark):
    df = spark.createDataFrame([("g1", 1.0)], "TravelGroup string, TotalSpending double")
    plan = grp.group_share(df, F.col("TotalSpending"))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan and "EvalPython" not in plan
