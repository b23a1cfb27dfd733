"""Deterministic evaluation operators on score tables.

A score table has an id, a 0/1 truth column and a probability column. All
metrics are aggregates; threshold scans bucket the scores on the grid so one
pass serves every threshold. Splits rank rows inside each class without a
class-wide window (see ``ranks.exclusive_prefix``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathe.functions.columns import c, rnd
from lathe.operators.lookup import join_small
from lathe.operators.ranks import exclusive_prefix, roc_auc


# ------------------------------------------------------------------ J1/J2
def class_rank(df: DataFrame, label: str, order: Column, id_col: str, buckets: int | None = None) -> DataFrame:
    """0-based rank of each row inside its class by ``(order, id)``; adds ``__rank``, ``__n_class``.

    Null labels are a class of their own, so every row has a rank."""
    cls = F.when(c(label).isNull(), "null").otherwise(F.concat(F.lit("="), c(label).cast("string")))
    t = df.withColumns({"__cls": cls, "__ord": order.cast("double"), "__one": F.lit(1)})
    ranked = exclusive_prefix(t, ["__cls"], "__ord", ["__one"], buckets, suffix="_rank", tiebreak=[id_col])
    sizes = t.groupBy("__cls").agg(F.count(F.lit(1)).alias("__n_class"))
    out = join_small(ranked, sizes, on="__cls", how="left", max_rows=1_000)  # one row per class
    return out.withColumnRenamed("__one_rank", "__rank").drop("__one", "__ord", "__cls")


def stratified_split(df: DataFrame, label: str, id_col: str, order: Column, test_size: float = 0.2) -> DataFrame:
    """Exact stratified hold-out: per class the first ``round(test_size * n_class)`` rows
    by ``order`` (a hash of the id) are validation. Adds ``is_val`` (boolean)."""
    r = class_rank(df, label, order, id_col)
    n_val = F.floor(F.col("__n_class") * F.lit(test_size) + F.lit(0.5))
    return r.withColumn("is_val", F.col("__rank") < n_val).drop("__rank", "__n_class")


def stratified_kfold(df: DataFrame, label: str, id_col: str, order: Column, k: int = 5) -> DataFrame:
    """fold = rank within the class modulo k (balanced classes per fold)."""
    r = class_rank(df, label, order, id_col)
    return r.withColumn("fold", (F.col("__rank") % k).cast("int")).drop("__rank", "__n_class")


def id_hash(id_col: str) -> Column:
    """Default split order: 64-bit hash of the id (deterministic, data-independent)."""
    return F.xxhash64(c(id_col))


# ------------------------------------------------------------------ J6/J7
def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """2x2 counts (rows = truth, cols = prediction)."""
    return df.groupBy(c(truth).cast("int").alias("y_true"), c(pred).cast("int").alias("y_pred")) \
        .agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, truth: str, score: str, threshold: float = 0.5, dp: int = 4) -> DataFrame:
    """Accuracy, ROC-AUC and per-class precision / recall / F1 / support.

    One aggregate for the confusion counts, one rank aggregate for the AUC.
    """
    y = c(truth).cast("int")
    p = (c(score) >= F.lit(threshold)).cast("int")
    cm = df.agg(F.sum(y * p).alias("tp"), F.sum((1 - y) * p).alias("fp"),
                F.sum(y * (1 - p)).alias("fn"), F.sum((1 - y) * (1 - p)).alias("tn")).first()
    auc_row = roc_auc(df.select(c(truth).cast("int").alias("__y"), c(score).alias("__s")), "__s", "__y").first()
    auc = float(auc_row["roc_auc"]) if auc_row and auc_row["roc_auc"] is not None else None
    tp, fp, fn, tn = (int(cm[k] or 0) for k in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    rows = []
    for cls, (tp_c, fp_c, fn_c) in ((1, (tp, fp, fn)), (0, (tn, fn, fp))):
        prec = tp_c / (tp_c + fp_c) if tp_c + fp_c else 0.0
        rec = tp_c / (tp_c + fn_c) if tp_c + fn_c else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        rows.append((cls, prec, rec, f1, tp_c + fn_c))
    base = df.sparkSession.createDataFrame(rows, "class int, precision double, recall double, f1 double, support long")
    return base.select("class", *[rnd(x, dp).alias(x) for x in ("precision", "recall", "f1")], "support",
                       rnd(F.lit((tp + tn) / n if n else None).cast("double"), dp).alias("accuracy"),
                       rnd(F.lit(auc).cast("double"), dp).alias("roc_auc"))


# ------------------------------------------------------------------ J8
def threshold_grid(i: Column, start: float, stop: float, num: int) -> Column:
    """Grid value i of ``start + i * (stop - start) / (num - 1)`` (double arithmetic)."""
    return F.lit(float(start)) + i.cast("double") * F.lit(float(stop - start)) / F.lit(float(num - 1))


def threshold_search(df: DataFrame, truth: str, score: str, start: float = 0.3, stop: float = 0.7,
                     num: int = 200, grid: Column | None = None, dp: int = 4) -> DataFrame:
    """Accuracy at every grid threshold (pred = score >= t); the first maximum wins.

    Scores are bucketed by how many grid points they reach (one pass, at most
    ``num + 1`` buckets), then two running sums over the tiny bucket table give
    TP and TN for every threshold.
    """
    spark = df.sparkSession
    g = grid if grid is not None else None

    def t(i: Column) -> Column:
        return g(i) if callable(g) else threshold_grid(i, start, stop, num)
    s = c(score).cast("double")
    step = (stop - start) / (num - 1)
    k0 = F.least(F.greatest(F.floor((s - F.lit(start)) / F.lit(step)), F.lit(-1)), F.lit(num - 1)).cast("int")
    # exact count of grid points <= s (the estimate is off by at most one either way)
    k = (F.when((k0 + 1 < num) & (t(k0 + 1) <= s), k0 + 2)
         .when((k0 >= 0) & (t(k0) <= s), k0 + 1)
         .otherwise(F.when(k0 >= 1, F.when(t(k0 - 1) <= s, k0).otherwise(k0 - 1)).otherwise(F.lit(0))))
    y = c(truth).cast("int")
    buckets = df.select(k.alias("k"), y.alias("y")).groupBy("k").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    # every bucket index 0..num exists once: a bounded table of num + 1 rows
    full = (spark.range(num + 1).select(F.col("id").cast("int").alias("k"))
            .join(F.broadcast(buckets), on="k", how="left").fillna(0, subset=["pos", "neg"]))
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    curve = full.select("k", F.sum("pos").over(w).alias("cum_pos"), F.sum("neg").over(w).alias("cum_neg"),
                        F.sum("pos").over(Window.partitionBy()).alias("all_pos"),
                        F.sum(F.col("pos") + F.col("neg")).over(Window.partitionBy()).alias("n"))
    # grid point i predicts positive for buckets k > i: TP = all_pos - cum_pos(i), TN = cum_neg(i)
    curve = (curve.where(F.col("k") < num)
             .select(F.col("k").alias("i"),
                     ((F.col("all_pos") - F.col("cum_pos") + F.col("cum_neg")) / F.col("n")).alias("accuracy"))
             .withColumn("threshold", t(F.col("i"))))
    best = curve.orderBy(F.desc("accuracy"), F.asc("i")).limit(1)
    return best.select(rnd("threshold", dp).alias("best_threshold"), rnd("accuracy", dp).alias("best_accuracy"))


# ------------------------------------------------------------------ J9
def segment_errors(df: DataFrame, truth: str, pred: str, segments: dict[str, Column], dp: int = 4) -> DataFrame:
    """N, errors, error rate per segment value, for several segment columns at once."""
    err = (c(truth).cast("int") != c(pred).cast("int")).cast("int")
    items = [F.struct(F.lit(k).alias("segment_var"), e.cast("string").alias("segment")) for k, e in segments.items()]
    long = df.select(err.alias("__e"), F.inline(F.array(*items)))
    return (long.groupBy("segment_var", "segment")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("__e").cast("long").alias("errors"))
            .withColumn("error_rate", rnd(F.col("errors") / F.col("n"), dp))
            .orderBy("segment_var", F.desc("error_rate")))


# ------------------------------------------------------------------ J12/J14/J16
def soft_vote(df: DataFrame, scores: list[str], weights: list[float] | None = None,
              threshold: float = 0.5) -> tuple[Column, Column]:
    """Normalised-weight average of probabilities and its thresholded prediction."""
    w = weights or [1.0] * len(scores)
    tot = float(sum(w))
    proba = None
    for s, wi in zip(scores, w):
        term = c(s) * F.lit(wi / tot)
        proba = term if proba is None else proba + term
    return proba, proba >= F.lit(threshold)


def champion(candidates: DataFrame, name: str = "model", metric: str = "val_accuracy",
             order: str = "order", current: float | None = None) -> DataFrame:
    """Best candidate (first wins ties) and whether it beats the current champion strictly."""
    best = candidates.agg(F.max_by(F.struct(c(name).alias("winner"), c(metric).alias("metric")),
                                   F.struct(c(metric), -c(order))).alias("b")).select("b.*")
    promoted = F.lit(True) if current is None else F.col("metric") > F.lit(current)
    return best.select("winner", F.col("metric").alias(metric), promoted.alias("promoted"))


def promote(best: DataFrame, tuned: DataFrame, metric: str = "val_accuracy", current: float | None = None) -> DataFrame:
    """The winner's accuracy after threshold tuning, and whether it is promoted.

    ``best`` is ``champion``'s row, ``tuned`` the winner's ``threshold_search`` row. The tuned
    threshold is kept only if it is strictly better than the default 0.5; the effective accuracy
    has to beat ``current`` strictly (no champion yet: promoted)."""
    t = tuned.first()                                 # one row
    better = F.coalesce(F.lit(t["best_accuracy"]) > F.col(metric), F.lit(False)) if t else F.lit(False)
    out = best.select("winner", F.col(metric).alias("val_accuracy_default_threshold"),
                      F.when(better, F.lit(t["best_accuracy"] if t else None)).otherwise(F.col(metric)).alias(metric),
                      F.when(better, F.lit(t["best_threshold"] if t else None)).otherwise(F.lit(0.5)).alias("best_threshold"))
    return out.withColumn("promoted", F.lit(True) if current is None else F.col(metric) > F.lit(current))


def prediction_distribution(df: DataFrame, pred: str, dp: int = 2) -> DataFrame:
    """Counts and % of each predicted class."""
    counts = df.groupBy(c(pred).alias(pred)).agg(F.count(F.lit(1)).alias("count"))
    n = df.count()
    return counts.withColumn("pct", rnd(F.col("count") * 100.0 / F.lit(n), dp))
