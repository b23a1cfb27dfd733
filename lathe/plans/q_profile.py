"""Registered keys for profiling and association statistics (G*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lathe.functions.columns import rnd

from lathe.functions import columns as col
from lathe.operators import groups as grp
from lathe.operators import impute as imp
from lathe.operators import profile as pf
from lathe.plans.base import register, with_passengers
from lathe.plans.q_rows import FIXTURE_DECK_TO_PLANET, base
from lathe.plans.sqlfrag import CABNUM_EDA, DECK, SIDE, SPEND, any_pos_sql, base_cte, total_sql
from lathe.sources.fixtures import SPEND_COLS, TARGET, passengers

RAW_COLS = ["PassengerId", "HomePlanet", "CryoSleep", "Cabin", "Destination", "Age", "VIP", *SPEND_COLS,
            "Name", "Transported"]
RAW_NUMERIC = ["Age", *SPEND_COLS]
RAW_CATEGORICAL = ["HomePlanet", "CryoSleep", "Destination", "VIP"]
SPARK_TYPES = {"PassengerId": "string", "HomePlanet": "string", "CryoSleep": "boolean", "Cabin": "string",
               "Destination": "string", "Age": "double", "VIP": "boolean", "Name": "string",
               "Transported": "boolean", **{x: "double" for x in SPEND_COLS}}
Y = "CAST(Transported AS INTEGER)"


def union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


# ------------------------------------------------------------------ G1-G6
@register("null_summary", with_passengers(
    "SELECT * FROM (" + union([
        f"SELECT '{x}' AS \"column\", count(*) - count({x}) AS nulls, "
        f"round(CAST(count(*) - count({x}) AS DOUBLE) * 100 / count(*), 2) AS pct_nulls FROM passengers"
        for x in RAW_COLS]) + ") WHERE nulls > 0"))
def q_null_summary(spark, sf):
    return pf.null_summary(passengers(spark, sf))


@register("numeric_stats", with_passengers(union([
    f"SELECT '{x}' AS \"column\", count({x}) AS count, round(avg({x}),2) AS mean, round(stddev_samp({x}),2) AS std, "
    f"round(min({x}),2) AS min, round(quantile_cont({x},0.25),2) AS q25, round(quantile_cont({x},0.5),2) AS q50, "
    f"round(quantile_cont({x},0.75),2) AS q75, round(max({x}),2) AS max, round(skewness({x}),3) AS skew, "
    f"round(kurtosis({x}),3) AS kurtosis FROM passengers" for x in RAW_NUMERIC])))
def q_numeric_stats(spark, sf):
    return pf.numeric_stats(passengers(spark, sf), RAW_NUMERIC)


@register("schema_profile", with_passengers(union([
    f"SELECT '{x}' AS \"column\", '{SPARK_TYPES[x]}' AS dtype, count(DISTINCT {x}) AS n_unique FROM passengers"
    for x in RAW_COLS])))
def q_schema_profile(spark, sf):
    return pf.schema_profile(passengers(spark, sf), RAW_COLS)


@register("duplicate_rows", with_passengers(
    f"SELECT CAST(sum(n) AS BIGINT) AS n_rows, {len(RAW_COLS)} AS n_cols, CAST(sum(n - 1) AS BIGINT) AS n_duplicates "
    f"FROM (SELECT count(*) AS n FROM passengers GROUP BY {', '.join(RAW_COLS)})"))
def q_duplicate_rows(spark, sf):
    """Whole-row duplicates, all 14 columns."""
    return pf.duplicate_rows(passengers(spark, sf), RAW_COLS)


@register("target_balance", with_passengers(
    "SELECT Transported, count(*) AS count, round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM passengers), 2) "
    "AS pct FROM passengers GROUP BY Transported"))
def q_target_balance(spark, sf):
    return pf.value_share(passengers(spark, sf), TARGET)


_OBJ_COLS = ["PassengerId", "HomePlanet", "CryoSleep", "Cabin", "Destination", "VIP", "Name"]


@register("categorical_describe", with_passengers(
    "SELECT variable, CAST(sum(n) AS BIGINT) AS count, count(*) AS \"unique\", first(value ORDER BY n DESC, value) AS top, "
    "max(n) AS freq FROM cnt GROUP BY variable",
    "st AS (" + union([f"SELECT '{x}' AS variable, CAST({x} AS VARCHAR) AS value FROM passengers" for x in _OBJ_COLS])
    + "),\ncnt AS (SELECT variable, value, count(*) AS n FROM st WHERE value IS NOT NULL GROUP BY variable, value)"))
def q_categorical_describe(spark, sf):
    return pf.categorical_describe(passengers(spark, sf), _OBJ_COLS)


# ------------------------------------------------------------------ G7 family (shared SQL template)
def chi2_sql(src: str, variables: dict[str, str], extra_select: str = "") -> tuple[str, str]:
    """Returns (ctes, body) computing the G7 table in SQL from ``src``."""
    st = union([f"SELECT '{v}' AS variable, CAST({e} AS VARCHAR) AS category, {Y} AS y FROM {src}"
                for v, e in variables.items()])
    dev1 = "abs(n1 - n * tn1 / tn)"
    dev0 = "abs((n - n1) - n * (tn - tn1) / tn)"

    def term(dev, colsum):
        d = f"CASE WHEN dof = 1 THEN greatest({dev} - 0.5, 0) ELSE {dev} END"
        return f"CASE WHEN {colsum} > 0 THEN ({d}) * ({d}) / (n * {colsum} / tn) ELSE 0 END"
    ctes = f"""st AS ({st}),
cells AS (SELECT variable, category, count(*) AS n, CAST(sum(y) AS BIGINT) AS n1 FROM st GROUP BY variable, category),
tot AS (SELECT variable, CAST(sum(n) AS BIGINT) AS tn, CAST(sum(n1) AS BIGINT) AS tn1, count(*) AS r FROM cells GROUP BY variable),
j AS (SELECT c.*, t.tn, t.tn1, (t.r - 1) * (CAST(t.tn1 > 0 AS INTEGER) + CAST(t.tn - t.tn1 > 0 AS INTEGER) - 1) AS dof
      FROM cells c JOIN tot t USING (variable)),
chi AS (SELECT variable, sum(CASE WHEN dof > 0 THEN {term(dev1, 'tn1')} + {term(dev0, '(tn - tn1)')} ELSE 0 END) AS chi2,
        max(dof) AS dof FROM j GROUP BY variable)"""
    body = ("SELECT j.variable, j.category, j.n AS count, round(CAST(j.n AS DOUBLE) * 100 / j.tn, 2) AS pct, "
            "round(CAST(j.n1 AS DOUBLE) / j.n, 4) AS target_rate, round(chi.chi2, 2) AS chi2, CAST(chi.dof AS INTEGER) AS dof"
            f"{extra_select} FROM j JOIN chi USING (variable)")
    return ctes, body


_ct, _cb = chi2_sql("passengers", {x: x for x in RAW_CATEGORICAL})


@register("chi2_test", with_passengers(_cb, _ct))
def q_chi2_test(spark, sf):
    return pf.chi2_test(passengers(spark, sf), RAW_CATEGORICAL, TARGET)


@register("chi2_pvalues")
def q_chi2_pvalues(spark, sf):
    """chi2, dof and p per raw categorical (p has no DuckDB equivalent: unit-tested)."""
    return pf.chi2_summary(passengers(spark, sf), RAW_CATEGORICAL, TARGET)


@register("category_rate", with_passengers(
    f"SELECT HomePlanet, round(avg({Y}),4) AS target_rate, count(*) AS n FROM passengers "
    "WHERE HomePlanet IS NOT NULL GROUP BY HomePlanet"))
def q_category_rate(spark, sf):
    return pf.category_rate(passengers(spark, sf), "HomePlanet", TARGET)


def _mw_sql() -> str:
    st = union([f"SELECT '{x}' AS variable, CAST({x} AS DOUBLE) AS value, {Y} AS y FROM passengers" for x in RAW_NUMERIC])
    ctes = f"""st AS ({st}),
cells AS (SELECT variable, value, CAST(sum(y) AS BIGINT) AS n1, CAST(sum(1 - y) AS BIGINT) AS n0 FROM st
          WHERE value IS NOT NULL GROUP BY variable, value),
pre AS (SELECT *, coalesce(sum(n0) OVER (PARTITION BY variable ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND
        1 PRECEDING), 0) AS n0b FROM cells),
agg AS (SELECT variable, CAST(sum(n1) AS DOUBLE) AS n1, CAST(sum(n0) AS DOUBLE) AS n0,
        sum(n1 * (n0b + CAST(n0 AS DOUBLE) / 2)) AS U,
        sum(power(CAST(n1 + n0 AS DOUBLE), 3) - (n1 + n0)) AS ties FROM pre GROUP BY variable),
mom AS (SELECT variable, round(avg(CASE WHEN y = 1 THEN value END),3) AS mean_true,
        round(avg(CASE WHEN y = 0 THEN value END),3) AS mean_false, round(corr(value, y),4) AS r_pearson
        FROM st WHERE value IS NOT NULL GROUP BY variable)"""
    sigma = "sqrt(n1 * n0 / 12 * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1))))"
    body = (f"SELECT variable, round(U, 0) AS U, round((greatest(U, n1 * n0 - U) - n1 * n0 / 2 - 0.5) / {sigma}, 6) AS z, "
            "mean_true, mean_false, r_pearson, CAST(n1 AS BIGINT) AS n_true, CAST(n0 AS BIGINT) AS n_false "
            "FROM agg JOIN mom USING (variable)")
    return with_passengers(body, ctes)


@register("mann_whitney", _mw_sql())
def q_mann_whitney(spark, sf):
    return pf.mann_whitney_table(passengers(spark, sf), RAW_NUMERIC, TARGET)


@register("mann_whitney_pvalues")
def q_mann_whitney_p(spark, sf):
    """G9 with the two-sided normal p-value (no DuckDB equivalent: unit-tested)."""
    return pf.mann_whitney_table(passengers(spark, sf), RAW_NUMERIC, TARGET, with_p=True)


_PT = {"TotalSpending": total_sql(), "TotalSpending_Log": f"ln(1 + {total_sql()})", **{x: x for x in RAW_NUMERIC}}


@register("pearson_target", with_passengers(
    "SELECT feature, r_pearson, abs(r_pearson) AS abs_r FROM (" + union([
        f"SELECT '{k}' AS feature, round(corr({e}, {Y}), 4) AS r_pearson FROM passengers" for k, e in _PT.items()]) + ")"))
def q_pearson_target(spark, sf):
    feats = {"TotalSpending": col.total(SPEND_COLS), "TotalSpending_Log": F.log1p(col.total(SPEND_COLS)),
             **{x: F.col(x) for x in RAW_NUMERIC}}
    return pf.pearson_target(passengers(spark, sf), feats, TARGET)


def _corr_sql() -> str:
    pairs = sorted({tuple(sorted((a, b))) for a in RAW_NUMERIC for b in RAW_NUMERIC})
    name = {p: f"r{i}" for i, p in enumerate(pairs)}
    one = "one AS (SELECT " + ", ".join(f"corr({a}, {b}) AS {name[(a, b)]}" for a, b in pairs) + " FROM passengers)"
    body = union([f"SELECT '{a}' AS col_a, '{b}' AS col_b, round({name[tuple(sorted((a, b)))]}, 6) AS r FROM one"
                  for a in RAW_NUMERIC for b in RAW_NUMERIC])
    return with_passengers(body, one)


@register("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf):
    return pf.correlation_matrix(passengers(spark, sf), RAW_NUMERIC)


_dct, _dcb = chi2_sql("g", {"GroupSize": "GroupSize", "SpendingCategories": "SpendingCategories"},
                      extra_select=f", (SELECT round(corr({total_sql()}, {Y}), 4) FROM passengers) AS r_raw"
                                   f", (SELECT round(corr(ln(1 + {total_sql()}), {Y}), 4) FROM passengers) AS r_log")


@register("derived_analysis", with_passengers(
    _dcb, base_cte() + ",\ng AS (SELECT *, count(*) OVER (PARTITION BY TravelGroup) AS GroupSize FROM b),\n" + _dct))
def q_derived_analysis(spark, sf):
    """chi2 of GroupSize and SpendingCategories, with the correlation of raw and log total spending."""
    df = grp.group_size(base(spark, sf))
    total = col.total(SPEND_COLS)
    r = passengers(spark, sf).agg(*[rnd(F.corr(e, F.col(TARGET).cast("double")), 4).alias(n)
                                    for n, e in (("r_raw", total), ("r_log", F.log1p(total)))]).first()
    return pf.chi2_test(df, ["GroupSize", "SpendingCategories"], TARGET) \
        .withColumns({n: F.lit(r[n]).cast("double") for n in ("r_raw", "r_log")})


_cct, _ccb = chi2_sql("cab", {"Deck": "Deck", "Side": "Side"},
                      extra_select=", (SELECT round(CAST(count(*) - count(Cabin) AS DOUBLE) * 100 / count(*), 2) "
                                   "FROM passengers) AS cabin_null_pct")


@register("cabin_analysis", with_passengers(
    _ccb, f"cab AS (SELECT *, {DECK} AS Deck, {SIDE} AS Side, {CABNUM_EDA} AS CabinNumber FROM passengers),\n" + _cct))
def q_cabin_analysis(spark, sf):
    df = col.split_cabin(passengers(spark, sf), number_default=None)
    null_pct = pf.null_summary(df, ["Cabin"]).first()
    pct = float(null_pct["pct_nulls"]) if null_pct else 0.0
    return pf.chi2_test(df, ["Deck", "Side"], TARGET).withColumn("cabin_null_pct", F.lit(pct))


@register("cabin_home_deck", with_passengers(
    f"SELECT HomePlanet, Deck, count(*) AS n FROM (SELECT HomePlanet, {DECK} AS Deck FROM passengers WHERE Cabin IS NOT NULL) "
    "WHERE HomePlanet IS NOT NULL AND Deck IS NOT NULL GROUP BY HomePlanet, Deck"))
def q_cabin_home_deck(spark, sf):
    """Passengers per HomePlanet and Deck, in long form (an absent pair has none)."""
    df = col.split_cabin(passengers(spark, sf).where(F.col("Cabin").isNotNull()), number_default=None)
    df = df.where(F.col("HomePlanet").isNotNull() & F.col("Deck").isNotNull())
    return df.groupBy("HomePlanet", "Deck").agg(F.count(F.lit(1)).alias("n"))


@register("pivot_rate", with_passengers(
    f"SELECT HomePlanet, round(avg(CASE WHEN NOT CryoSleep THEN {Y} END),4) AS \"False\", "
    f"round(avg(CASE WHEN CryoSleep THEN {Y} END),4) AS \"True\" FROM passengers "
    "WHERE HomePlanet IS NOT NULL AND CryoSleep IS NOT NULL GROUP BY HomePlanet"))
def q_pivot_rate(spark, sf):
    df = passengers(spark, sf).withColumn("CryoSleep_str", imp.tri_state_label("CryoSleep"))
    df = df.where(F.col("CryoSleep").isNotNull())
    return pf.pivot_rate(df, "HomePlanet", "CryoSleep_str", TARGET, ["False", "True"])


_DECKS = list("ABCDEFGT")


@register("pivot_count", with_passengers(
    "SELECT HomePlanet, " + ", ".join(f"count(CASE WHEN Deck = '{d}' THEN 1 END) AS \"{d}\"" for d in _DECKS)
    + " FROM b WHERE HomePlanet IS NOT NULL AND Cabin IS NOT NULL GROUP BY HomePlanet", base_cte()))
def q_pivot_count(spark, sf):
    df = base(spark, sf).where(F.col("Cabin").isNotNull())
    return pf.pivot_count(df, "HomePlanet", "Deck")


@register("segment_stats", with_passengers(
    "SELECT CASE WHEN CryoSleep THEN 'True' WHEN NOT CryoSleep THEN 'False' ELSE 'Unknown' END AS segment, "
    f"round(avg(Age),3) AS mean_age, round(avg({total_sql()}),3) AS mean_spending, round(avg({Y}),3) AS transport_rate, "
    "count(Transported) AS n FROM passengers GROUP BY 1"))
def q_segment_stats(spark, sf):
    return pf.segment_stats(passengers(spark, sf), imp.tri_state_label("CryoSleep"), "Age", SPEND_COLS, TARGET)


@register("per_service_stats", with_passengers(union([
    f"SELECT '{x}' AS service, round(avg(CAST(coalesce({x},0) = 0 AS INTEGER)) * 100, 2) AS pct_zero, "
    f"round(corr(ln(1 + coalesce({x},0)), {Y}), 4) AS r_pearson_log, "
    f"CASE WHEN avg(CASE WHEN coalesce({x},0) > 0 THEN {Y} END) <> 0 THEN round(avg(CASE WHEN coalesce({x},0) > 0 THEN {Y} END), 4) END AS rate_spender, "
    f"round(avg(CASE WHEN NOT coalesce({x},0) > 0 THEN {Y} END), 4) AS rate_non_spender, "
    f"round(coalesce(median(CASE WHEN coalesce({x},0) > 0 THEN coalesce({x},0) END), 0), 1) AS median_spender "
    f"FROM passengers" for x in SPEND])))
def q_per_service_stats(spark, sf):
    return pf.per_service_stats(passengers(spark, sf), SPEND_COLS, TARGET)


def _zero_sql() -> str:
    allz = "(" + " AND ".join(f"coalesce({x},0) = 0" for x in SPEND) + ")"
    parts = [f"SELECT '{x}' AS segment, 'service' AS kind, round(avg(CAST(coalesce({x},0) = 0 AS INTEGER)) * 100, 2) "
             f"AS pct_zero, count(*) AS n FROM passengers" for x in SPEND]
    parts.append(f"SELECT 'all', 'all_zero', round(avg(CAST({allz} AS INTEGER)) * 100, 2), count(*) FROM passengers")
    parts.append(f"SELECT 'CryoSleep=True', 'all_zero', round(avg(CASE WHEN coalesce(CryoSleep,false) THEN "
                 f"CAST({allz} AS INTEGER) END) * 100, 2), count(CASE WHEN coalesce(CryoSleep,false) THEN 1 END) FROM passengers")
    parts.append(f"SELECT 'CryoSleep=False/Unknown', 'all_zero', round(avg(CASE WHEN NOT coalesce(CryoSleep,false) THEN "
                 f"CAST({allz} AS INTEGER) END) * 100, 2), count(CASE WHEN NOT coalesce(CryoSleep,false) THEN 1 END) "
                 "FROM passengers")
    return with_passengers(union(parts))


@register("zero_inflation", _zero_sql())
def q_zero_inflation(spark, sf):
    return pf.zero_inflation(passengers(spark, sf), SPEND_COLS, "CryoSleep")


_FIXTURE_DECK_RULES = [(["A", "B", "C"], "EUROPE"), (["G"], "AMERICA")]


def _rules_sql() -> str:
    sp = any_pos_sql()
    dk = "split_part(Cabin,'/',1)"
    conds = {
        "R1": f"coalesce(CryoSleep,false) AND {sp}",
        "R2": f"{sp} AND CryoSleep IS NULL",
        "R3": f"Age IS NOT NULL AND coalesce(Age <= 12, false) AND {sp}",
        "R4": f"coalesce({dk} IN ('A','B','C'), false) AND HomePlanet IS NOT NULL AND coalesce(HomePlanet <> 'EUROPE', false)",
        "R5": f"coalesce({dk} = 'G', false) AND HomePlanet IS NOT NULL AND coalesce(HomePlanet <> 'AMERICA', false)",
    }
    return with_passengers(union([
        f"SELECT '{k}' AS rule, count(CASE WHEN {v} THEN 1 END) AS violations, "
        f"round(CAST(count(CASE WHEN {v} THEN 1 END) AS DOUBLE) * 100 / count(*), 3) AS pct FROM passengers"
        for k, v in conds.items()]))


@register("rule_violations", _rules_sql())
def q_rule_violations(spark, sf):
    return pf.rule_violations(passengers(spark, sf), SPEND_COLS, deck_rules=_FIXTURE_DECK_RULES)


def _imp_sql() -> str:
    grp_ = "split_part(PassengerId,'_',1)"
    dk = "split_part(Cabin,'/',1)"
    ctes = (f"io AS (SELECT *, max(CAST(HomePlanet IS NOT NULL AS INTEGER)) OVER (PARTITION BY {grp_}) AS ghp, "
            f"max(CAST(Cabin IS NOT NULL AS INTEGER)) OVER (PARTITION BY {grp_}) AS gcb, "
            f"max(CAST(Age IS NOT NULL AS INTEGER)) OVER (PARTITION BY {grp_}) AS gag FROM passengers),\n"
            f"cnt AS (SELECT count(CASE WHEN HomePlanet IS NULL THEN 1 END) AS hp_n, "
            f"count(CASE WHEN HomePlanet IS NULL AND ghp = 1 THEN 1 END) + count(CASE WHEN HomePlanet IS NULL AND ghp = 0 AND "
            f"coalesce({dk} IN ('A','B','C','G'), false) THEN 1 END) AS hp_r, "
            f"count(CASE WHEN Cabin IS NULL THEN 1 END) AS cb_n, count(CASE WHEN Cabin IS NULL AND gcb = 1 THEN 1 END) AS cb_r, "
            f"count(CASE WHEN Age IS NULL THEN 1 END) AS ag_n, count(CASE WHEN Age IS NULL AND gag = 1 THEN 1 END) AS ag_r, "
            f"count(CASE WHEN CryoSleep IS NULL THEN 1 END) AS cr_n, count(CASE WHEN CryoSleep IS NULL AND {any_pos_sql()} "
            f"THEN 1 END) AS cr_r FROM io)")
    rows = [("HomePlanet", "hp", "TravelGroup + deck rule"), ("Cabin/Deck/Side", "cb", "TravelGroup"),
            ("Age", "ag", "TravelGroup median"), ("CryoSleep", "cr", "spend > 0 -> not cryo")]
    body = union([f"SELECT '{v}' AS variable, {k}_n AS nulls, {k}_r AS resolvable, "
                  f"round(CAST({k}_r AS DOUBLE) * 100 / greatest({k}_n, 1), 1) AS pct_resolvable, '{m}' AS method FROM cnt"
                  for v, k, m in rows])
    return with_passengers(body, ctes)


@register("imputation_opportunities", _imp_sql())
def q_imputation_opportunities(spark, sf):
    df = col.split_group_key(passengers(spark, sf))
    return pf.imputation_opportunities(df, SPEND_COLS)


@register("crosstab_pct", with_passengers(
    "SELECT HomePlanet, Transported, n, round(CAST(n AS DOUBLE) * 100 / sum(n) OVER (PARTITION BY HomePlanet), 4) AS pct "
    "FROM (SELECT HomePlanet, Transported, count(*) AS n FROM passengers WHERE HomePlanet IS NOT NULL GROUP BY 1, 2)"))
def q_crosstab_pct(spark, sf):
    return pf.crosstab_pct(passengers(spark, sf), "HomePlanet", TARGET)


_IQR_COLS = [*RAW_NUMERIC, "TotalSpending"]


def _iqr_sql() -> str:
    src = f"ts AS (SELECT *, {total_sql()} AS TotalSpending FROM passengers)"
    q = "q AS (SELECT " + ", ".join(
        f"quantile_cont({x}, 0.25) AS a{i}, quantile_cont({x}, 0.75) AS b{i}" for i, x in enumerate(_IQR_COLS)) + " FROM ts)"
    parts = []
    for i, x in enumerate(_IQR_COLS):
        lo, hi = f"(a{i} - 1.5 * (b{i} - a{i}))", f"(b{i} + 1.5 * (b{i} - a{i}))"
        parts.append(f"SELECT '{x}' AS variable, round(a{i}, 6) AS q1, round(b{i}, 6) AS q3, round({lo}, 2) AS lower_bound, "
                     f"round({hi}, 2) AS upper_bound, count(CASE WHEN {x} < {lo} OR {x} > {hi} THEN 1 END) AS n_outliers, "
                     f"round(CAST(count(CASE WHEN {x} < {lo} OR {x} > {hi} THEN 1 END) AS DOUBLE) * 100 / count(*), 2) "
                     f"AS pct_outliers FROM ts, q GROUP BY a{i}, b{i}")
    return with_passengers(union(parts), src + ",\n" + q)


@register("iqr_outliers", _iqr_sql())
def q_iqr_outliers(spark, sf):
    df = passengers(spark, sf).withColumn("TotalSpending", col.total(SPEND_COLS))
    out = pf.iqr_outliers(df, _IQR_COLS)
    return out.withColumns({"q1": rnd("q1", 6), "q3": rnd("q3", 6)})


def _hist_sql(bins: int = 60) -> str:
    st = union([f"SELECT '{k}' AS variable, CAST({e} AS DOUBLE) AS value, {Y} AS y FROM passengers"
                for k, e in {"TotalSpending": total_sql(), "TotalSpending_Log": f"ln(1 + {total_sql()})"}.items()])
    ctes = (f"st AS ({st}),\nrg AS (SELECT variable, min(value) AS lo, max(value) AS hi FROM st GROUP BY variable),\n"
            f"bn AS (SELECT st.*, lo, hi, CAST(CASE WHEN (hi - lo) / {bins} > 0 THEN least(floor((value - lo) / ((hi - lo) / {bins})), "
            f"{bins - 1}) ELSE 0 END AS INTEGER) AS bin FROM st JOIN rg USING (variable))")
    body = (f"SELECT variable, bin, round(lo + bin * (hi - lo) / {bins}, 6) AS bin_lo, round(lo + (bin + 1) * (hi - lo) / {bins}, 6) "
            "AS bin_hi, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_true, count(*) - CAST(sum(y) AS BIGINT) AS n_false "
            "FROM bn GROUP BY variable, bin, lo, hi")
    return with_passengers(body, ctes)


@register("histogram_by_class", _hist_sql())
def q_histogram(spark, sf):
    df = passengers(spark, sf).withColumn("TotalSpending", col.total(SPEND_COLS)) \
        .withColumn("TotalSpending_Log", F.log1p("TotalSpending"))
    return pf.histogram(df, ["TotalSpending", "TotalSpending_Log"], TARGET, bins=60)


@register("box_summary", with_passengers(union([
    f"SELECT '{x}' AS variable, CAST(Transported AS VARCHAR) AS class, min({x}) AS min, round(quantile_cont({x},0.25),6) AS q1, "
    f"round(quantile_cont({x},0.5),6) AS median, round(quantile_cont({x},0.75),6) AS q3, max({x}) AS max, count({x}) AS n "
    f"FROM passengers WHERE {x} IS NOT NULL GROUP BY Transported" for x in RAW_NUMERIC])))
def q_box_summary(spark, sf):
    return pf.box_summary(passengers(spark, sf), RAW_NUMERIC, by=TARGET)
