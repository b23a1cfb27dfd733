"""Streaming: per-record features on a file stream, and micro-batch scoring end to end."""

from pyspark.sql import functions as F

from lathe.operators import models as ml
from lathe.plans.featuresets import FEATURE_SETS
from lathe.plans.q_featuresets import FIXTURE_BINDING
from lathe.session import scratch_path
from lathe.sources.fixtures import passengers
from lathe.streaming.scoring import score_stream, stateless_features
from tests.conftest import SF0001


def test_stateless_features_on_stream_match_batch(spark):
    df = passengers(spark, SF0001)
    src = scratch_path(spark, "stream-src")
    df.write.parquet(src)
    fitted = FEATURE_SETS["fs_004"].fit(df, FIXTURE_BINDING)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = (stateless_features(stream, fitted).writeStream.format("memory").queryName("lathe_stream_feats")
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.sql("SELECT * FROM lathe_stream_feats")
    batch = stateless_features(df, fitted)
    assert got.count() == df.count()
    cols = [c for c in got.columns if c in ("PassengerId", "Deck_TE", "CabinNumber", "Destination_2-HIGH")]
    assert got.select(*[F.col(f"`{c}`") for c in cols]).exceptAll(batch.select(*[F.col(f"`{c}`") for c in cols])).count() == 0


def test_score_stream_micro_batches(spark):
    df = passengers(spark, SF0001)
    src = scratch_path(spark, "stream-src2")
    df.drop("Transported").write.parquet(src)
    fitted = FEATURE_SETS["fs_012"].fit(df, FIXTURE_BINDING)
    m = ml.assemble(fitted.transform(df, train=True), fitted.feature_cols, "Transported", "PassengerId")
    model = ml.catalogue()["LogisticRegression"].estimator(m.df.count()).fit(m.df)
    out = scratch_path(spark, "stream-out")
    stream = spark.readStream.schema(df.drop("Transported").schema).parquet(src)
    q = score_stream(stream, fitted, model, out, scratch_path(spark, "stream-ckpt2"), threshold=0.4106)
    q.awaitTermination(180)
    res = spark.read.parquet(out)
    assert res.count() == df.count()
    assert set(res.columns) >= {"PassengerId", "Transported"}
