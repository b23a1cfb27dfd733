"""Properties from the test strategy: partition-independence, bounded shares, consistent group sizes."""

from pyspark.sql import functions as F

from lathe.plans.featuresets import FEATURE_SETS
from lathe.plans.q_featuresets import FIXTURE_BINDING, round_doubles
from lathe.sources.fixtures import passengers
from tests.conftest import SF0001


def test_transform_independent_of_partitioning(spark):
    df = passengers(spark, SF0001)
    fit = FEATURE_SETS["fs_005"].fit(df, FIXTURE_BINDING)
    a = round_doubles(fit.transform(df, train=True))
    b = round_doubles(fit.transform(df.repartition(7, "Name"), train=True))
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_group_shares_and_sizes(spark):
    df = passengers(spark, SF0001)
    rows = FEATURE_SETS["fs_013"].rows(df, FIXTURE_BINDING, train=True)
    assert rows.where(F.col("SpendShare") > 1).count() == 0
    per_group = rows.groupBy("TravelGroup").agg(F.count(F.lit(1)).alias("n"), F.min("GroupSize").alias("lo"),
                                                F.max("GroupSize").alias("hi"))
    assert per_group.where((F.col("n") != F.col("lo")) | (F.col("lo") != F.col("hi"))).count() == 0
