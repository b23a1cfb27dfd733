"""Structured Streaming use of the fitted state.

The reference has no stream source; what carries over is scoring new entity
rows as they arrive. Two entry points:

* ``stateless_features`` - per-record steps only (cabin / id parsing, spend
  totals, age bins, constant fills, label encodes, target encoding against a
  static broadcast fit table, one-hot, scaling). Valid on any streaming
  DataFrame, no state.
* ``score_stream`` - the full fitted chain, including group features, run per
  micro-batch through ``foreachBatch``. Group statistics then cover the rows of
  one micro-batch (a group split across batches is scored per part); each batch
  writes to its own ``batch_id`` folder, so a replayed batch overwrites itself
  (idempotent after an executor or driver restart).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.functions import columns as col
from lathe.operators import encode as enc
from lathe.plans.featuresets import Binding, FittedFeatureSet


def stateless_features(stream: DataFrame, fitted: FittedFeatureSet) -> DataFrame:
    """Per-record part of a fitted feature set (no group features, no age median of the stream)."""
    b: Binding = fitted.binding
    df = col.split_group_key(col.split_cabin(stream), b.id_col, b.group)
    df = col.spend_totals(df, list(b.spend)).withColumn("AgeCategory", col.age_category("Age"))
    fills = {x: F.coalesce(F.col(x), F.lit(col.UNKNOWN)) for x in b.categorical_fill
             if dict(df.dtypes).get(x) == "string"}
    fills.update({x: F.coalesce(F.col(x), F.lit(0.0)) for x in b.spend})
    if fitted.age_median is not None:
        fills["Age"] = F.coalesce(F.col("Age"), F.lit(fitted.age_median))
    df = df.withColumns(fills).withColumns({"CryoSleep_Encoded": col.tri_state("CryoSleep", -1),
                                            "Side_Encoded": col.side_code("Side")})
    for x, te in fitted.target_encoders.items():
        if x in df.columns:
            df = te.apply(df, f"{x}_TE", fill_unseen=True)
    df = enc.one_hot_apply(df, {k: v for k, v in fitted.one_hot.items() if k in df.columns})
    keep = [b.id_col]
    present = [x for x in fitted.feature_cols if x in df.columns]
    out = df.select(*keep, *[F.col(f"`{x}`") for x in present])
    return fitted.scaler.apply(out)


def score_stream(stream: DataFrame, fitted: FittedFeatureSet, model, out_path: str, checkpoint: str,
                 threshold: float = 0.5, trigger_once: bool = True):
    """Score every micro-batch with the full fitted chain and a fitted Spark ML model."""
    from lathe.operators import models as ml
    b = fitted.binding

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        matrix = fitted.transform(batch, train=False)
        m = ml.assemble(matrix, fitted.feature_cols, None, b.id_col)
        pred = model.transform(m.df).select(b.id_col, ml.vector_to_array("probability")[1].alias(ml.P1),
                                             "prediction")
        ml.score(pred, threshold).select(b.id_col, F.col("pred").alias(b.target)) \
            .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
