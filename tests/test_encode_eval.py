"""H* encoders and J* evaluation operators (scaler zero variance, unseen categories, thresholds, splits)."""

import random

import numpy as np
from pyspark.sql import functions as F

from lathe.operators import encode as enc
from lathe.operators import evaluate as ev
from lathe.operators import models as ml
from lathe.operators import ranks


def test_target_encoding_unseen_gets_mean_of_means(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "k string, y int")
    te = enc.target_encode_fit(train, "k", "y")
    test = spark.createDataFrame([("a",), ("b",), ("z",)], "k string")
    got = {r.k: r.k_TE for r in te.apply(test).collect()}
    assert got == {"a": 0.5, "b": 1.0, "z": 0.75}                    # unweighted mean of 0.5 and 1.0


def test_one_hot_null_is_all_zero_and_names(spark):
    df = spark.createDataFrame([("x y",), ("x.z",), (None,)], "c string")
    vals = enc.one_hot_fit(enc.category_stats(df.withColumn("t", F.lit(1)), ["c"], "t"), ["c"])
    out = enc.one_hot_apply(df, vals)
    assert out.columns == ["c_x y", "c_x.z"]
    assert [tuple(r) for r in out.collect()] == [(1, 0), (0, 1), (0, 0)]


def test_scaler_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    sc = enc.standard_scale_fit(df, ["a", "b"])
    assert sc.stats["a"] == (2.0, 1.0) and sc.stats["b"] == (5.0, 1.0)
    assert [tuple(r) for r in sc.apply(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_threshold_search_matches_numpy_loop(spark):
    rnd = random.Random(5)
    grid = np.linspace(0.3, 0.7, 200)
    scores = [float(rnd.choice(list(grid[:20]) + [rnd.random() for _ in range(5)])) for _ in range(600)]
    ys = [int(rnd.random() < s) for s in scores]
    best_t, best_acc = 0.5, 0.0
    for t in grid:
        acc = float(np.mean((np.array(scores) >= t).astype(int) == np.array(ys)))
        if acc > best_acc:
            best_t, best_acc = float(t), acc
    df = spark.createDataFrame(list(zip(ys, scores)), "y int, s double")
    step = (0.7 - 0.3) / 199

    def lin(i):
        return F.when(i == 199, F.lit(0.7)).otherwise(i.cast("double") * F.lit(step) + F.lit(0.3))
    got = ev.threshold_search(df, "y", "s", 0.3, 0.7, 200, grid=lin).first()
    assert got.best_threshold == round(best_t, 4) and got.best_accuracy == round(best_acc, 4)


def test_stratified_split_exact_counts(spark):
    rows = [(f"id{i:04d}", int(i % 3 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id string, y int")
    out = ev.stratified_split(df, "y", "id", ev.id_hash("id"), test_size=0.2)
    counts = {(r.y, r.is_val): r["count"] for r in out.groupBy("y", "is_val").count().collect()}
    assert counts[(1, True)] == round(0.2 * 334) and counts[(0, True)] == round(0.2 * 666)
    folds = ev.stratified_kfold(df, "y", "id", ev.id_hash("id"), k=5)
    sizes = sorted(r["count"] for r in folds.groupBy("fold").count().collect())
    assert sizes[-1] - sizes[0] <= 2


def test_champion_first_wins_ties(spark):
    c = spark.createDataFrame([("m1", 0, 0.8), ("m2", 1, 0.81), ("m3", 2, 0.81)], "model string, order int, val_accuracy double")
    r = ev.champion(c, current=0.81).first()
    assert r.winner == "m2" and r.promoted is False


def test_promote_keeps_the_tuned_threshold_only_if_better(spark):
    best = spark.createDataFrame([("m2", 0.81)], "winner string, val_accuracy double")
    worse = spark.createDataFrame([(0.4, 0.81)], "best_threshold double, best_accuracy double")
    r = ev.promote(best, worse, current=0.81).first()
    assert (r.best_threshold, r.val_accuracy, r.promoted) == (0.5, 0.81, False)
    better = spark.createDataFrame([(0.4, 0.82)], "best_threshold double, best_accuracy double")
    r = ev.promote(best, better, current=0.81).first()
    assert (r.best_threshold, r.val_accuracy, r.val_accuracy_default_threshold, r.promoted) == (0.4, 0.82, 0.81, True)
    assert ev.promote(best, better).first().promoted is True


def test_split_ranks_null_labels_as_a_class(spark):
    rows = [(f"id{i:04d}", None if i % 10 == 0 else i % 2) for i in range(500)]
    df = spark.createDataFrame(rows, "id string, y int")
    out = ev.stratified_split(df, "y", "id", ev.id_hash("id"), test_size=0.2)
    got = {(r.y, r.is_val): r["count"] for r in out.groupBy("y", "is_val").count().collect()}
    assert got[(None, True)] == 10 and got[(None, False)] == 40 and sum(got.values()) == 500


def test_mixture_of_experts_scores_every_row(spark):
    rows = [(f"t{i}", None if i % 7 == 0 else i % 2, float(i % 5), float(i % 3), int(i % 5 > 2)) for i in range(120)]
    df = spark.createDataFrame(rows, "id string, gate int, a double, b double, y int")
    for least, experts in ((20, {"gated", "rest"}), (60, {"rest"}), (1000, {"none"})):
        out = ml.mixture_of_experts(df, df, ["a", "b"], "y", "id", "gate",
                                    lambda: ml.LogisticRegression(maxIter=5, featuresCol=ml.FEATURES, labelCol=ml.LABEL),
                                    min_segment=least).collect()
        assert len(out) == 120 and {r.expert for r in out} == experts
        assert all(r.p1 is not None and r.prediction == float(r.p1 >= 0.5) for r in out)


def test_experts_are_trained_side_by_side(spark, monkeypatch):
    import threading
    both, plain = threading.Barrier(2, timeout=60), ml.held_out

    def held_out(m, models, folds):
        both.wait()                                     # breaks unless the other expert is being trained too
        return plain(m, models, folds)
    monkeypatch.setattr(ml, "held_out", held_out)
    df = spark.createDataFrame([(f"t{i}", i % 2, float(i % 5), int(i % 5 > 2)) for i in range(120)], "id string, gate int, a double, y int")
    out = ml.mixture_of_experts(df, df, ["a"], "y", "id", "gate", ml.Logistic(iterations=5)).collect()
    assert len(out) == 120 and {(r.id, r.expert) for r in out} == {(f"t{i}", "gated" if i % 2 else "rest") for i in range(120)}


def test_quantiles_of_no_values_keep_their_columns(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert ranks.exact_quantiles(df, ["k"], "v", [0.5]).columns == ["k", "q_index", "quantile"]
    assert ranks.exact_quantiles(df, [], "v", [0.5]).collect() == []


def test_saved_feature_set_transforms_alike(spark, tmp_path):
    from lathe.plans.featuresets import FEATURE_SETS, FittedFeatureSet
    from lathe.plans.q_featuresets import FIXTURE_BINDING
    from lathe.sources.fixtures import ID_COL, passengers
    from tests.conftest import SF0001
    people = passengers(spark, SF0001)
    ids = people.where("Age is not null and xxhash64(PassengerId) % 5 <> 0").select(ID_COL)
    fit = FEATURE_SETS["fs_012"].fit(people, FIXTURE_BINDING, train_ids=ids)
    again = FittedFeatureSet.load(spark, fit.save(spark, str(tmp_path / "fit")))
    a, b = (f.transform(people.drop("Transported")).orderBy(ID_COL).collect() for f in (fit, again))
    assert a == b and len(a) == people.count()
    # what the held-out rows say never reaches the fit
    held = people.join(ids, on=ID_COL, how="left_anti").select(ID_COL, F.lit(1).alias("h"))
    turned = people.join(held, on=ID_COL, how="left") \
        .withColumn("Transported", F.when(F.col("h").isNull(), F.col("Transported")).otherwise(~F.col("Transported"))).drop("h")
    other = FEATURE_SETS["fs_012"].fit(turned.select(people.columns), FIXTURE_BINDING, train_ids=ids)
    assert np.allclose(other.scaler.stats["Route_TE"], fit.scaler.stats["Route_TE"], rtol=1e-12)


def test_a_fit_runs_the_row_pipeline_once_and_its_matrix_is_the_transform(spark, monkeypatch):
    from dataclasses import replace
    from lathe.plans.featuresets import FEATURE_SETS
    from lathe.plans.q_featuresets import FIXTURE_BINDING
    from lathe.sources.fixtures import passengers
    people = passengers(spark, "/root/testdata/sf0.001")
    ids = people.where("cast(Age AS int) % 4 > 0").select("PassengerId")
    for name in ("fs_006", "fs_012"):
        fs, ran = FEATURE_SETS[name], []
        counted = replace(fs, pipeline=lambda *a: ran.append(1) or fs.pipeline(*a))
        for train_ids in ((None,) if name == "fs_006" else (ids.unionAll(ids),)):
            ran.clear()
            fit = counted.fit(people, FIXTURE_BINDING, train_ids=train_ids)
            got = [fit.train_matrix(scaled, True) for scaled in (True, False)]
            assert len(ran) == 1
            for scaled, m in zip((True, False), got):
                want = fit.transform(people, train=True, scaled=scaled, fill_unseen=True)
                assert m.columns == want.columns
                assert sorted(map(str, m.collect())) == sorted(map(str, want.collect()))


def test_group_size_counts_the_rows_that_stay(spark):
    from lathe.plans.featuresets import FEATURE_SETS
    from lathe.plans.q_featuresets import FIXTURE_BINDING
    from lathe.sources.fixtures import passengers
    people = passengers(spark, "/root/testdata/sf0.001")
    for name in ("fs_006", "fs_008"):
        for train in (True, False):
            rows = FEATURE_SETS[name].rows(people, FIXTURE_BINDING, train=train)
            wrong = rows.groupBy("TravelGroup").agg(F.count("*").alias("n"), F.min("GroupSize").alias("a"), F.max("GroupSize").alias("b"))
            assert rows.columns[-1] == "GroupSize" and wrong.where("a <> n OR b <> n").isEmpty()
