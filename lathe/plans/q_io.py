"""Registered keys for sources and sinks (A1-A5): write / read round trips.

Each key writes Spark-derived data to a fresh folder under the session's
checkpoint directory (a shared folder on a cluster) and reads it back, so
the oracle compares the re-read table with the same SQL as the source.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.functions.columns import rnd

from lathe.operators import encode as enc
from lathe.plans.base import register, with_passengers
from lathe.plans.featuresets import FEATURE_SETS
from lathe.plans.q_eval import _SCORES_CTE, score_tables
from lathe.plans.q_featuresets import encode_sql, fitted, round_doubles
from lathe.plans.q_rows import base
from lathe.plans.sqlfrag import base_cte
from lathe.sources import io
from lathe.sources.fixtures import ID_COL, TARGET, passengers
from lathe.operators import evaluate as ev
from lathe.operators import lookup as lk
from lathe.session import scratch_path


@register("scan_entities", with_passengers("SELECT * FROM passengers"))
def q_scan_entities(spark, sf):
    """A1: the raw entity table as header CSV, read back with the declared schema ('' -> null)."""
    path = scratch_path(spark, "entities")
    passengers(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    return io.scan_entities(spark, path, fmt="csv")


_FS4 = FEATURE_SETS["fs_004"]


@register("write_features", encode_sql(_FS4))
def q_write_features(spark, sf):
    """A2: raw and scaled fs_004 tables written under feature_set=/kind= folders; scaled re-read."""
    root = scratch_path(spark, "features")
    fit = fitted(spark, sf, "fs_004")
    io.write_features(round_doubles(fit.train_matrix(scaled=False)), root, "fs_004", "raw")
    io.write_features(round_doubles(fit.train_matrix()), root, "fs_004", "scaled")
    return io.read_features(spark, root, "fs_004", "scaled")


_A3_COLS = ["PassengerId", "Transported", "Age", "Deck_TE", "HomePlanet_TE", "Destination_4-NOT SPECIFIED"]


@register("read_features", "SELECT " + ", ".join(f'"{c}"' for c in _A3_COLS) + " FROM (" + encode_sql(_FS4) + ")")
def q_read_features(spark, sf):
    """A3: partition-pruned, column-pruned reload of a feature table (X and y selected)."""
    root = scratch_path(spark, "features")
    io.write_features(round_doubles(fitted(spark, sf, "fs_004").train_matrix()), root, "fs_004", "scaled")
    return io.read_features(spark, root, "fs_004", "scaled", columns=_A3_COLS)


@register("write_predictions", with_passengers(
    "SELECT PassengerId, m1 * CAST(0.25 AS DOUBLE) + m2 * CAST(0.5 AS DOUBLE) + m3 * CAST(0.25 AS DOUBLE) >= 0.5 "
    "AS Transported FROM st", _SCORES_CTE))
def q_write_predictions(spark, sf):
    """A4: (id, boolean prediction) written as partitioned header CSV and read back."""
    wide = lk.join_scores(score_tables(spark, sf), ID_COL, "score")
    _, pred = ev.soft_vote(wide, ["m1", "m2", "m3"], [1.0, 2.0, 1.0])
    path = scratch_path(spark, "predictions")
    io.write_predictions(wide.withColumn(TARGET, pred), path)
    return spark.read.schema("PassengerId string, Transported boolean").option("header", True).csv(path)


@register("fit_state_io", with_passengers(
    "SELECT t.PassengerId, round(coalesce(te.mean, (SELECT avg(mean) FROM te)), 6) AS Deck_TE FROM b t "
    "LEFT JOIN te ON t.Deck = te.value",
    base_cte() + ",\nte AS (SELECT Deck AS value, avg(CAST(Transported AS DOUBLE)) AS mean FROM b "
    "WHERE Deck NOT IN ('A', 'T') GROUP BY Deck)"))
def q_fit_state_io(spark, sf):
    """A5: a fitted target encoder saved as a Parquet fit table + metadata, reloaded and applied."""
    df = base(spark, sf)
    te = enc.target_encode_fit(df.where(~F.col("Deck").isin("A", "T")), "Deck", TARGET)
    root = scratch_path(spark, "fit_state")
    io.save_fit_state({"Deck": te.table}, {"column": "Deck", "default": te.default}, root)
    tables, meta = io.load_fit_state(spark, root, ["Deck"])
    loaded = enc.TargetEncoding(meta["column"], tables["Deck"], meta["default"])
    return loaded.apply(df, "Deck_TE").select(ID_COL, rnd("Deck_TE", 6).alias("Deck_TE"))
