"""Ids beyond the fixture's range, and the split of a hot group in the final plan."""

import pytest
from pyspark.sql import functions as F

from lathe.operators import groups, impute, lookup
from lathe.plans import q_eval
from lathe.sources import fixtures


def test_large_order_numbers_keep_ids_and_hashes_apart(spark):
    big = [10**12 + i for i in range(50)]
    df = spark.createDataFrame([(k, 10**10 + k % 7) for k in big], "k long, c long")
    pid = F.concat(F.lpad((F.col("c") * 4 + F.col("k") % 4).cast("string"), fixtures.ID_WIDTH, "0"), F.lit("_"),
                   F.lpad(F.col("k").cast("string"), fixtures.ID_WIDTH, "0"))
    out = fixtures.with_score(df.select("k", pid.alias("PassengerId")).withColumn("h", q_eval.split_hash())).collect()
    assert len({r["PassengerId"] for r in out}) == 50 and len({r["h"] for r in out}) == 50
    assert all(r["h"] == (r["k"] % 2**31 * 2654435761) % 2**32 and r["score"] == r["k"] * 7919 % 1000 / 1000 for r in out)


@pytest.fixture
def hot(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 30_000).cast("string"))).alias("TravelGroup"),
        (F.col("id") % 80).cast("double").alias("Age"), F.col("id").cast("string").alias("note"))
    yield rows.repartition(16)
    for k in conf:
        spark.conf.unset(k)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("operator", [
    groups.group_size,
    lambda df: groups.group_zscore(df, "Age"),
    lambda df: lookup.semi_join_flag(df, df.select("TravelGroup"), "TravelGroup", "known"),
    lambda df: impute.impute_group_median(df.withColumn("Age", F.when(F.col("Age") > 5, F.col("Age")))),
])
def test_a_hot_group_is_split(hot, operator):
    assert "skew=true" in final_plan(operator(hot))


SETS = ["fs_001", "fs_005", "fs_007", "fs_013"]


@pytest.mark.parametrize("name", SETS)
def test_a_hot_travel_group_is_split_in_whole_row_pipelines(spark, hot, name):
    """A third of the rows in one travel group: the production settings split its rows in the feature sets' row pipelines."""
    from lathe.plans.featuresets import FEATURE_SETS
    from lathe.plans.q_featuresets import FIXTURE_BINDING
    n = F.col("id")
    pid = F.concat(F.when(n % 3 == 0, "0001").otherwise(F.lpad((n % 30_000 + 2).cast("string"), 5, "0")), F.lit("_"), n.cast("string"))
    people = spark.range(150_000).select(
        pid.alias("PassengerId"), F.when(n % 7 > 0, "EUROPE").alias("HomePlanet"), (n % 2 == 0).alias("CryoSleep"),
        F.concat(F.when(n % 2 == 0, "A").otherwise("B"), F.lit("/"), (n % 900).cast("string"), F.lit("/P")).alias("Cabin"),
        F.lit("5-LOW").alias("Destination"), F.when(n % 5 > 0, (n % 80).cast("double")).alias("Age"), F.lit(False).alias("VIP"),
        *[F.when(n % (k + 3) > 0, (n % 1000).cast("double")).alias(x) for k, x in enumerate(FIXTURE_BINDING.spend)],
        F.concat(F.lit("N "), (n % 5000).cast("string")).alias("Name"), (n % 2 == 1).alias("Transported")).repartition(16)
    rows = FEATURE_SETS[name].rows(people, FIXTURE_BINDING, train=True)
    assert "skew=true" in final_plan(rows.agg(*[F.count(f"`{x}`") for x in rows.columns]))


def test_nan_is_null_for_every_statistic(spark):
    from lathe.plans.featuresets import FEATURE_SETS
    from lathe.plans.q_featuresets import FIXTURE_BINDING
    b, nan = FIXTURE_BINDING, float("nan")
    cols = ["PassengerId", "HomePlanet", "CryoSleep", "Cabin", "Destination", "Age", "VIP", *b.spend, "Name", "Transported"]
    kinds = "PassengerId string, HomePlanet string, CryoSleep boolean, Cabin string, Destination string, Age double, VIP boolean, " \
        + ", ".join(f"{x} double" for x in b.spend) + ", Name string, Transported boolean"
    made = [[(f"000{i}_{i}", "EUROPE", False, "A/1/P", "5-LOW", float(20 + i) if i else gap, False, gap, 2.0, 3.0, gap, 1.0, "A B", i % 2 == 0)
             for i in range(6)] for gap in (nan, None)]
    fs = FEATURE_SETS["fs_006"]
    with_nan, with_null = (sorted(map(str, fs.rows(spark.createDataFrame(rows, kinds).select(*cols), b, train=True).collect())) for rows in made)
    assert with_nan == with_null and len(with_nan) == 5 and "nan" not in "".join(with_nan).lower()
