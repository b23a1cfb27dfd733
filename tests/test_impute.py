"""E* imputation and ordered domain rules."""

import pytest
from pyspark.sql import functions as F

from lathe.operators import impute as imp

SPEND = ["s1", "s2"]


def test_group_first_uses_id_order(spark):
    df = spark.createDataFrame([("g_02", "g", None), ("g_01", "g", "Mars"), ("g_03", "g", "Venus"), ("h_01", "h", None)],
                               "PassengerId string, TravelGroup string, HomePlanet string")
    from pyspark.sql import functions as F
    out = {r.PassengerId: r.HomePlanet for r in
           imp.impute_group_first(df, {"HomePlanet": F.col("HomePlanet").isNotNull()}).collect()}
    assert out == {"g_02": "Mars", "g_01": "Mars", "g_03": "Venus", "h_01": None}


def test_domain_rules_order(spark):
    rows = [
        # group a: planet known on a later row, deck unknown on one row
        ("a_01", "a", None, "Unknown", "Unknown", None, 30.0, None, 5.0),
        ("a_02", "a", "Earth", "B", "P", True, 40.0, None, None),
        # group b: nobody knows the planet, deck A -> lookup (rule 2 on the pre-repair deck)
        ("b_01", "b", None, "A", "S", None, 10.0, None, None),
    ]
    df = spark.createDataFrame(rows, "PassengerId string, TravelGroup string, HomePlanet string, Deck string, "
                                     "Side string, CryoSleep boolean, Age double, s1 double, s2 double")
    out = {r.PassengerId: r for r in imp.apply_domain_rules(df, SPEND).collect()}
    assert out["a_01"].HomePlanet == "Earth" and out["a_01"].Deck == "B" and out["a_01"].Side == "P"
    assert out["a_01"].CryoSleep is False                     # spend > 0 and cryo unknown -> False
    assert out["a_02"].s1 == 0.0 and out["a_02"].s2 == 0.0    # cryo -> null spend = 0
    assert out["b_01"].HomePlanet == "Europa"                  # deck rule
    assert out["b_01"].s1 == 0.0 and out["b_01"].s2 == 0.0    # age <= 12 -> null spend = 0
    assert out["b_01"].CryoSleep is None


def test_spend_group_aware(spark):
    df = spark.createDataFrame([("g", True, None), ("g", False, None), ("g", False, 4.0), ("g", False, 8.0),
                                ("h", None, None), ("k", False, 100.0)],
                               "TravelGroup string, CryoSleep boolean, s1 double")
    got = sorted(((r.CryoSleep, r.s1) for r in imp.impute_spend_group_aware(df, ["s1"]).collect()),
                 key=lambda t: (str(t[0]), t[1]))
    # cryo -> 0; group median 6; group h has no value -> global median of (4, 8, 100) = 8
    assert sorted(x[1] for x in got) == [0.0, 4.0, 6.0, 8.0, 8.0, 100.0]


def test_group_median_and_global_median(spark):
    df = spark.createDataFrame([("g", 10.0), ("g", 20.0), ("g", None), ("h", None)], "TravelGroup string, Age double")
    assert sorted([r.Age for r in imp.impute_group_median(df).collect()], key=lambda v: (v is None, v)) == \
        [10.0, 15.0, 20.0, None]
    assert sorted(r.Age for r in imp.impute_global_median(df).collect()) == [10.0, 15.0, 15.0, 20.0]


def test_group_medians_of_a_hot_group(spark, monkeypatch):
    import random
    from statistics import median
    from lathe.operators import ranks
    monkeypatch.setattr(ranks, "TOGETHER", 100)
    rnd = random.Random(4)
    rows = [("hot", rnd.random() * 100) for _ in range(300)] + [(f"g{i % 40}", rnd.random() * 10) for i in range(200)] + [(None, 3.0), ("empty", None)]
    df = spark.createDataFrame(rows, "TravelGroup string, s1 double")
    got = {r.TravelGroup: r["__gm_s1"] for r in imp.group_medians(df, "TravelGroup", ["s1"]).collect()}
    assert set(got) == {g for g, v in rows if v is not None}
    assert all(abs(got[g] - median(v for k, v in rows if k == g)) < 1e-9 for g in got)


def test_global_medians_without_ranking_all_values(spark, monkeypatch):
    """Odd and even counts, ties, gaps and one value only come out of the sketch's bracket; a missed bracket is ranked."""
    import numpy as np
    from lathe.operators import ranks
    r = np.random.default_rng(5)
    n = 20_001
    table = {"a": r.normal(size=n), "ties": np.round(r.normal(size=n)), "same": np.full(n, 3.0), "gaps": np.where(r.random(n) < 0.3, np.nan, r.random(n)),
             "none": np.full(n, np.nan)}
    df = spark.createDataFrame(list(zip(*(x.tolist() for x in table.values()))), ", ".join(f"{x} double" for x in table)).repartition(5)
    want = {x: (None if np.isnan(v).all() else float(np.nanmedian(v))) for x, v in table.items()}
    asked = []
    whole = ranks.quantile_values
    monkeypatch.setattr(ranks, "quantile_values", lambda *a: asked.append(a) or whole(*a))
    even = {x: (None if np.isnan(v).all() else float(np.nanmedian(v[:-1]))) for x, v in table.items()}
    got = imp.global_medians(df, list(table))
    assert not asked and got == pytest.approx(want)
    assert imp.global_medians(df.limit(0), list(table)) == dict.fromkeys(table)
    rows = spark.createDataFrame([(v,) for v in table["a"][:-1].tolist()], "a double")
    assert imp.global_medians(rows, ["a"])["a"] == pytest.approx(even["a"]) and not asked
    monkeypatch.setattr(imp, "BESIDE", -0.1)                       # edges that miss the median
    assert imp.global_medians(df, ["a", "same"]) == pytest.approx({x: want[x] for x in ("a", "same")}) and asked


def test_group_medians_with_hot_groups_and_extra(spark, monkeypatch):
    import statistics
    rows = [("hot", float(i % 37), None) for i in range(60)] + [(g, float(i), i * 2.0 if i % 2 else None) for g in ("a", "b", None) for i in range(5)]
    rows += [("blank", None, None)]
    df = spark.createDataFrame(rows, "TravelGroup string, s1 double, s2 double")
    want = {}
    for g in {r[0] for r in rows}:
        cols = [[r[k] for r in rows if r[0] == g and r[k] is not None] for k in (1, 2)]
        want[g] = (*(statistics.median(v) if v else None for v in cols), sum(r[0] == g for r in rows))
    for limit in (1 << 16, 10):
        monkeypatch.setattr(imp, "HOT_ROWS", limit)
        got = imp.group_medians(df, "TravelGroup", ["s1", "s2"], extra={"GroupSize": F.count(F.lit(1))}).collect()
        assert len(got) == len(want) and {r[0]: (r["__gm_s1"], r["__gm_s2"], r["GroupSize"]) for r in got} == want
