"""G7/G9/G2 statistics: known p-values, Yates rule, bias-corrected moments, ranks vs brute force."""

import math
import random

import pytest

import pandas as pd
from pyspark.sql import functions as F

from lathe.functions.stats import chi2_sf, normal_two_sided
from lathe.operators import profile as pf
from lathe.operators.ranks import mann_whitney, roc_auc


def test_chi2_sf_known_values():
    assert abs(chi2_sf(3.841458820694124, 1) - 0.05) < 1e-10
    assert abs(chi2_sf(5.991464547107979, 2) - 0.05) < 1e-10
    assert abs(chi2_sf(10.0, 3) - 0.018566135463043) < 1e-9
    assert abs(chi2_sf(0.5, 4) - 0.9735009788392561) < 1e-10
    assert chi2_sf(5.0, 0) == 1.0


def test_normal_two_sided_known_values():
    assert abs(normal_two_sided(1.959963984540054) - 0.05) < 1e-12
    assert abs(normal_two_sided(-2.5758293035489) - 0.01) < 1e-10


def _chi2(table, yates):
    r = [sum(row) for row in table]
    c = [sum(col) for col in zip(*table)]
    n = sum(r)
    out = 0.0
    for i, row in enumerate(table):
        for j, o in enumerate(row):
            e = r[i] * c[j] / n
            d = abs(o - e)
            if yates:
                d = max(d - 0.5, 0.0)
            out += d * d / e
    return out


def test_chi2_yates_only_for_2x2(spark):
    rows = [("a", True)] * 30 + [("a", False)] * 10 + [("b", True)] * 15 + [("b", False)] * 25
    df = spark.createDataFrame(rows, "x string, y boolean")
    got = pf.chi2_summary(df, ["x"], "y").first()
    assert got.dof == 1 and abs(got.chi2 - round(_chi2([[30, 10], [15, 25]], True), 2)) < 1e-9
    rows3 = rows + [(None, True)] * 7 + [(None, False)] * 3
    got3 = pf.chi2_summary(spark.createDataFrame(rows3, "x string, y boolean"), ["x"], "y").first()
    assert got3.dof == 2 and abs(got3.chi2 - round(_chi2([[30, 10], [15, 25], [7, 3]], False), 2)) < 1e-9
    assert abs(got3.p_value - chi2_sf(_chi2([[30, 10], [15, 25], [7, 3]], False), 2)) < 1e-12


def test_numeric_stats_matches_pandas(spark):
    rnd = random.Random(3)
    vals = [rnd.expovariate(0.1) for _ in range(300)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = pf.numeric_stats(df, ["x"]).first()
    s = pd.Series(vals, dtype="float64")
    assert r["count"] == s.count()
    assert abs(r.skew - round(s.skew(), 3)) < 1e-9
    assert abs(r.kurtosis - round(s.kurtosis(), 3)) < 1e-9
    assert abs(r.q25 - round(s.quantile(0.25), 2)) < 1e-9


def _brute_u(xs, ys):
    return sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in xs for b in ys)


def test_mann_whitney_and_auc_with_ties(spark):
    rnd = random.Random(11)
    rows = [(float(rnd.randint(0, 20)), rnd.random() < 0.4) for _ in range(500)]
    df = spark.createDataFrame(rows, "v double, y boolean").withColumn("y", F.col("y").cast("int"))
    got = mann_whitney(df, "v", "y", buckets=7).first()
    pos = [v for v, y in rows if y]
    neg = [v for v, y in rows if not y]
    u = _brute_u(pos, neg)
    assert abs(got.U - u) < 1e-9
    n1, n0 = len(pos), len(neg)
    n = n1 + n0
    counts = pd.Series([v for v, _ in rows]).value_counts()
    ties = float(((counts ** 3) - counts).sum())
    sigma = math.sqrt(n1 * n0 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = (max(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5) / sigma
    assert abs(got.z - z) < 1e-9
    auc = roc_auc(df, "v", "y", buckets=5).first().roc_auc
    assert abs(auc - u / (n1 * n0)) < 1e-12


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    from lathe.operators.ranks import quantile_values
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), float(rnd.randint(0, 40)) if rnd.random() > 0.1 else None) for _ in range(999)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = quantile_values(df, ["g"], "v", probs)
    for g in "ab":
        xs = [v for gg, v in rows if gg == g and v is not None]
        assert np.allclose(got[(g,)], np.quantile(xs, probs))
    allv = [v for _, v in rows if v is not None]
    assert np.allclose(quantile_values(df, [], "v", [0.5])[()], [np.median(allv)])


def test_bucket_index_binary_search(spark):
    from lathe.operators.ranks import bucket_index
    bounds = [1.0, 2.0, 2.0, 5.0, 8.0, 9.0, 9.5]          # 8 buckets -> 7 sorted bounds
    vals = [0.5, 1.0, 1.5, 2.0, 4.0, 5.0, 8.9, 9.2, 9.5, 100.0]
    df = spark.createDataFrame([(v, bounds) for v in vals], "x double, b array<double>")
    got = [r.k for r in bucket_index(df, "x", "b", 8, "k").orderBy("x").collect()]
    assert got == [sum(1 for b in bounds if b <= v) for v in vals]


@pytest.mark.parametrize("together", [1 << 16, 3])
def test_exact_quantiles_of_any_parts(spark, monkeypatch, together):
    import numpy as np
    from lathe.operators import ranks
    monkeypatch.setattr(ranks, "TOGETHER", together)
    rnd = random.Random(21)
    tiny = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 2.0 ** -1022, 1.0, -1.0, 0.1, 3.0, 1024.0, 1023.9999999999999, 1.7976931348623157e308, -2.5]
    rows = [(rnd.choice(["a", None]), float(rnd.randint(0, 30))) for _ in range(500)]
    rows += [("near", rnd.choice(tiny)) for _ in range(200)] + [("real", rnd.gauss(0, 1e3)) for _ in range(300)]
    rows += [("one", 7.5), ("none", None), ("none", float("nan")), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = ranks.quantile_values(df, ["g"], "v", probs)
    assert set(got) == {("a",), (None,), ("near",), ("real",), ("one",)}
    for (g,), q in got.items():
        xs = [v for gg, v in rows if gg == g and v is not None and v == v]
        assert np.allclose(q, np.quantile(xs, probs), rtol=1e-12, atol=0), g
    all_ = [v for g, v in rows if g in ("a", None) and v == v]
    assert np.allclose(ranks.quantile_values(df.where("g IS NULL OR g = 'a'"), [], "v", probs)[()], np.quantile(all_, probs))
    assert ranks.quantile_values(df.where("false"), ["g"], "v", probs) == {} == ranks.quantile_values(df.where("false"), [], "v", probs)


def test_ordered_bits_are_the_bits(spark):
    import struct
    from pyspark.sql import functions as F
    from lathe.operators.ranks import ordered_bits
    rnd = random.Random(2)
    xs = [struct.unpack("<d", rnd.getrandbits(64).to_bytes(8, "little"))[0] for _ in range(3000)]
    xs = [x for x in xs if x == x] + [2.0 ** k * s * f for k in range(-1074, 1023, 7) for s in (1, -1) for f in (1, 0.9999999999999999)] + [float("inf"), -float("inf")]
    for x, b in spark.createDataFrame([(x,) for x in xs], "x double").select("x", ordered_bits(F.col("x"))).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert b == (-bits if x < 0 else bits), x
