"""Registered keys for deterministic evaluation on score tables.

The fixture score (``sources.fixtures.with_score``) stands in for model
probabilities so every metric has an exact DuckDB equivalent.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.functions.columns import rnd

from lathe.functions import columns as col
from lathe.operators import evaluate as ev
from lathe.operators import lookup as lk
from lathe.plans.base import register, with_passengers
from lathe.plans.q_rows import base
from lathe.plans.sqlfrag import base_cte
from lathe.sources.fixtures import ID_COL, SCORE_SQL, TARGET, passengers, with_score

ORDER_NO = "CAST(split_part(PassengerId, '_', 2) AS BIGINT)"
HASH_SQL = f"CAST(({ORDER_NO} % 2147483648 * 2654435761) % 4294967296 AS DOUBLE)"
Y = "CAST(Transported AS INTEGER)"


def order_no():
    return F.split_part(F.col(ID_COL), F.lit("_"), F.lit(2)).cast("bigint")


def split_hash():
    """Arithmetic id hash shared with the SQL oracle (any id hash works in the library)."""
    return ((order_no() % F.lit(2147483648) * F.lit(2654435761)) % F.lit(4294967296)).cast("double")


def scored(spark, sf):
    return with_score(passengers(spark, sf))


def split_cte(src: str = "passengers") -> str:
    """SQL: the J1 split of ``src`` (``sp`` with rank and class size, ``val`` the hold-out rows)."""
    return (f"sp AS (SELECT *, {SCORE_SQL} AS score, row_number() OVER (PARTITION BY Transported ORDER BY {HASH_SQL}, "
            f"PassengerId) - 1 AS rn, count(*) OVER (PARTITION BY Transported) AS ncls FROM {src}),\n"
            "val AS (SELECT * FROM sp WHERE rn < floor(ncls * 0.2 + 0.5))")


_SPLIT_CTE = split_cte()


def val_rows(spark, sf):
    df = ev.stratified_split(scored(spark, sf), TARGET, ID_COL, split_hash())
    return df.where(F.col("is_val")).drop("is_val")


@register("stratified_split", with_passengers(
    "SELECT PassengerId, Transported, rn < floor(ncls * 0.2 + 0.5) AS is_val FROM sp", _SPLIT_CTE))
def q_stratified_split(spark, sf):
    df = passengers(spark, sf).select(ID_COL, TARGET)
    return ev.stratified_split(df, TARGET, ID_COL, split_hash())


@register("stratified_kfold", with_passengers(
    "SELECT PassengerId, Transported, CAST(rn % 5 AS INTEGER) AS fold FROM sp", _SPLIT_CTE))
def q_stratified_kfold(spark, sf):
    df = passengers(spark, sf).select(ID_COL, TARGET)
    return ev.stratified_kfold(df, TARGET, ID_COL, split_hash(), k=5)


def _report_sql() -> str:
    ctes = (f"s AS (SELECT {Y} AS y, {SCORE_SQL} AS score, CAST({SCORE_SQL} >= 0.5 AS INTEGER) AS p FROM passengers),\n"
            "cm AS (SELECT sum(y * p) AS tp, sum((1 - y) * p) AS fp, sum(y * (1 - p)) AS fn, sum((1 - y) * (1 - p)) AS tn FROM s),\n"
            "cells AS (SELECT score, sum(y) AS n1, sum(1 - y) AS n0 FROM s GROUP BY score),\n"
            "pre AS (SELECT *, coalesce(sum(n0) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n0b "
            "FROM cells),\n"
            "auc AS (SELECT sum(n1 * (n0b + CAST(n0 AS DOUBLE) / 2)) / (CAST(sum(n1) AS DOUBLE) * sum(n0)) AS roc_auc FROM pre),\n"
            "pc AS (SELECT 1 AS class, tp AS a, fp AS b, fn AS c FROM cm UNION ALL SELECT 0, tn, fn, fp FROM cm),\n"
            "m AS (SELECT class, CASE WHEN a + b > 0 THEN CAST(a AS DOUBLE) / (a + b) ELSE 0 END AS prec, "
            "CASE WHEN a + c > 0 THEN CAST(a AS DOUBLE) / (a + c) ELSE 0 END AS rec, CAST(a + c AS BIGINT) AS support FROM pc)")
    body = ("SELECT class, round(prec, 4) AS precision, round(rec, 4) AS recall, "
            "round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END, 4) AS f1, support, "
            "(SELECT round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 4) FROM cm) AS accuracy, "
            "(SELECT round(roc_auc, 4) FROM auc) AS roc_auc FROM m")
    return with_passengers(body, ctes)


@register("eval_metrics", _report_sql())
def q_eval_metrics(spark, sf):
    return ev.classification_report(scored(spark, sf), TARGET, "score")


@register("confusion_matrix", with_passengers(
    f"SELECT {Y} AS y_true, CAST({SCORE_SQL} >= 0.5 AS INTEGER) AS y_pred, count(*) AS n FROM passengers GROUP BY 1, 2"))
def q_confusion(spark, sf):
    df = scored(spark, sf).withColumn("pred", F.col("score") >= 0.5)
    return ev.confusion(df, TARGET, "pred")


# np.linspace(0.3, 0.7, 200): t_i = i * ((0.7 - 0.3) / 199) + 0.3, last point exactly 0.7
LINSPACE_STEP = (0.7 - 0.3) / 199
# np.arange(0.30, 0.71, 0.01): t_i = 0.3 + i * ((0.3 + 0.01) - 0.3), 41 points
ARANGE_DELTA = (0.3 + 0.01) - 0.3


def linspace_t(i):
    return F.when(i == 199, F.lit(0.7)).otherwise(i.cast("double") * F.lit(LINSPACE_STEP) + F.lit(0.3))


def arange_t(i):
    return F.lit(0.3) + i.cast("double") * F.lit(ARANGE_DELTA)


_D = "CAST({} AS DOUBLE)"
LINSPACE_SQL = (f"CASE WHEN i = 199 THEN {_D.format(0.7)} ELSE CAST(i AS DOUBLE) * (({_D.format(0.7)} - {_D.format(0.3)}) / "
                f"{_D.format(199)}) + {_D.format(0.3)} END")
ARANGE_SQL = f"{_D.format(0.3)} + CAST(i AS DOUBLE) * (({_D.format(0.3)} + {_D.format(0.01)}) - {_D.format(0.3)})"


def _thr_sql(tsql: str, num: int, src: str = "passengers") -> str:
    ctes = (f"s AS (SELECT {Y} AS y, {SCORE_SQL} AS score FROM {src}),\n"
            f"g AS (SELECT i, {tsql} AS t FROM range({num}) r(i)),\n"
            "acc AS (SELECT i, t, avg(CASE WHEN (score >= t) = (y = 1) THEN 1.0 ELSE 0.0 END) AS a FROM g, s GROUP BY i, t)")
    return with_passengers("SELECT round(t, 4) AS best_threshold, round(CAST(a AS DOUBLE), 4) AS best_accuracy "
                           "FROM acc ORDER BY a DESC, i LIMIT 1", ctes)


@register("threshold_search", _thr_sql(LINSPACE_SQL, 200))
def q_threshold_search(spark, sf):
    return ev.threshold_search(scored(spark, sf), TARGET, "score", 0.3, 0.7, 200, grid=linspace_t)


@register("threshold_search_41", _thr_sql(ARANGE_SQL, 41))
def q_threshold_search_41(spark, sf):
    return ev.threshold_search(scored(spark, sf), TARGET, "score", 0.3, 0.7, 41, grid=arange_t)


_SEG_SQL = {
    "CryoSleep": "CASE WHEN CryoSleep THEN 'Cryo' WHEN NOT CryoSleep THEN 'Active' ELSE 'Unknown' END",
    "HomePlanet": "coalesce(HomePlanet, 'Unknown')", "Destination": "coalesce(Destination, 'Unknown')",
    "AgeCategory": "AgeCategory", "Deck": "Deck",
}


@register("segment_errors", with_passengers(
    "SELECT segment_var, segment, count(*) AS n, CAST(sum(e) AS BIGINT) AS errors, "
    "round(CAST(sum(e) AS DOUBLE) / count(*), 4) AS error_rate FROM (" + "\nUNION ALL ".join(
        f"SELECT '{k}' AS segment_var, {v} AS segment, CAST({Y} <> CAST(score >= 0.5 AS INTEGER) AS INTEGER) AS e FROM vb"
        for k, v in _SEG_SQL.items()) + ") GROUP BY 1, 2",
    base_cte() + ",\n" + split_cte("b") + ",\nvb AS (SELECT * FROM val)"))
def q_segment_errors(spark, sf):
    df = with_score(base(spark, sf))
    df = ev.stratified_split(df, TARGET, ID_COL, split_hash()).where(F.col("is_val"))
    df = df.withColumn("pred", F.col("score") >= 0.5)
    cryo = col.tri_state("CryoSleep", -1)
    segs = {
        "CryoSleep": F.when(cryo == 1, "Cryo").when(cryo == 0, "Active").otherwise("Unknown"),
        "HomePlanet": F.coalesce(F.col("HomePlanet"), F.lit("Unknown")),
        "Destination": F.coalesce(F.col("Destination"), F.lit("Unknown")),
        "AgeCategory": F.col("AgeCategory"), "Deck": F.col("Deck"),
    }
    return ev.segment_errors(df, TARGET, "pred", segs)


SCORE2_SQL = f"CAST(({ORDER_NO} * 104729) % 1000 AS DOUBLE) / 1000"
SCORE3_SQL = f"CAST(({ORDER_NO} * 7) % 1000 AS DOUBLE) / 1000"


def score_tables(spark, sf):
    df = passengers(spark, sf)
    s1 = with_score(df).select(ID_COL, "score")
    s2 = df.select(ID_COL, (((order_no() * 104729) % 1000).cast("double") / 1000.0).alias("score"))
    s3 = df.where(F.col("Age").isNotNull()).select(ID_COL, (((order_no() * 7) % 1000).cast("double") / 1000.0).alias("score"))
    return {"m1": s1, "m2": s2, "m3": s3}


_SCORES_CTE = (f"st AS (SELECT a.PassengerId, {SCORE_SQL.replace('PassengerId', 'a.PassengerId')} AS m1, "
               f"{SCORE2_SQL.replace('PassengerId', 'a.PassengerId')} AS m2, {SCORE3_SQL.replace('PassengerId', 'a.PassengerId')} AS m3 "
               "FROM passengers a JOIN (SELECT PassengerId FROM passengers WHERE Age IS NOT NULL) c ON a.PassengerId = c.PassengerId)")


@register("oof_join", with_passengers("SELECT PassengerId, m1, m2, m3 FROM st", _SCORES_CTE))
def q_oof_join(spark, sf):
    return lk.join_scores(score_tables(spark, sf), ID_COL, "score")


@register("soft_vote", with_passengers(
    "SELECT PassengerId, round(m1 * CAST(0.25 AS DOUBLE) + m2 * CAST(0.5 AS DOUBLE) + m3 * CAST(0.25 AS DOUBLE), 6) AS proba, "
    "m1 * CAST(0.25 AS DOUBLE) + m2 * CAST(0.5 AS DOUBLE) + m3 * CAST(0.25 AS DOUBLE) >= 0.5 AS Transported FROM st",
    _SCORES_CTE))
def q_soft_vote(spark, sf):
    wide = lk.join_scores(score_tables(spark, sf), ID_COL, "score")
    proba, pred = ev.soft_vote(wide, ["m1", "m2", "m3"], [1.0, 2.0, 1.0])
    return wide.select(ID_COL, rnd(proba, 6).alias("proba"), pred.alias(TARGET))


@register("champion_select", with_passengers(
    "SELECT best.model AS winner, acc AS val_accuracy_default_threshold, greatest(acc, thr.a) AS val_accuracy, "
    "CASE WHEN thr.a > acc THEN thr.t ELSE 0.5 END AS best_threshold, greatest(acc, thr.a) > 0.5 AS promoted "
    "FROM best JOIN thr ON true",
    _SPLIT_CTE + ",\nsc AS (" + "\nUNION ALL ".join(
        f"SELECT '{m}' AS model, {o} AS ord, {Y} AS y, {s} AS score FROM val"
        for o, (m, s) in enumerate([("m1", SCORE_SQL), ("m2", SCORE2_SQL), ("m3", SCORE3_SQL)])) + "),\n"
    "cand AS (SELECT model, ord, round(avg(CAST((score >= 0.5) = (y = 1) AS INTEGER)), 4) AS acc FROM sc GROUP BY model, ord),\n"
    "best AS (SELECT * FROM cand ORDER BY acc DESC, ord LIMIT 1),\n"
    f"g AS (SELECT i, {LINSPACE_SQL} AS t FROM range(200) r(i)),\n"
    "grid AS (SELECT i, t, avg(CASE WHEN (score >= t) = (y = 1) THEN 1.0 ELSE 0.0 END) AS a "
    "FROM g, (SELECT * FROM sc WHERE model = (SELECT model FROM best)) GROUP BY i, t),\n"
    "thr AS (SELECT round(t, 4) AS t, round(CAST(a AS DOUBLE), 4) AS a FROM grid ORDER BY grid.a DESC, i LIMIT 1)"))
def q_champion(spark, sf):
    """The best of three score tables, its threshold tuned, promoted over a champion at 0.5."""
    df = passengers(spark, sf)
    val = ev.stratified_split(df, TARGET, ID_COL, split_hash()).where(F.col("is_val"))
    y = F.col(TARGET).cast("int")
    sc = {"m1": with_score(val)["score"], "m2": ((order_no() * 104729) % 1000).cast("double") / 1000.0,
          "m3": ((order_no() * 7) % 1000).cast("double") / 1000.0}
    with_s = with_score(val).withColumns({k: v for k, v in sc.items() if k != "m1"})
    accs = with_s.agg(*[rnd(F.avg(((F.col(k if k != "m1" else "score") >= 0.5).cast("int") == y).cast("int")), 4)
                        .alias(k) for k in sc])
    cands = accs.select(F.inline(F.array(*[F.struct(F.lit(k).alias("model"), F.lit(i).alias("order"),
                                                     F.col(k).alias("val_accuracy")) for i, k in enumerate(sc)])))
    best = ev.champion(cands)
    winner = best.first()["winner"]
    tuned = ev.threshold_search(with_s, TARGET, "score" if winner == "m1" else winner, 0.3, 0.7, 200, grid=linspace_t)
    return ev.promote(best, tuned, current=0.5)


@register("prediction_distribution", with_passengers(
    f"SELECT {SCORE_SQL} >= 0.5 AS Transported, count(*) AS count, "
    "round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM passengers), 2) AS pct FROM passengers GROUP BY 1"))
def q_prediction_distribution(spark, sf):
    df = scored(spark, sf).withColumn(TARGET, F.col("score") >= 0.5)
    return ev.prediction_distribution(df, TARGET)
