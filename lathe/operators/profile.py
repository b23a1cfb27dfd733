"""Profiling and association statistics (G*).

Each profile is one (or a few) aggregate passes. Wide results are produced
as one aggregate row and turned long with ``inline`` of an array of structs,
so the scan is shared by every column. Per-category work is a ``groupBy``
on ``(variable, category)`` after stacking, never a window over raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.functions.columns import c, is_true, row_all_zero, row_any_positive, total, rnd
from lathe.functions.stats import bias_corrected_kurtosis, bias_corrected_skew
from lathe.operators.lookup import bounded_table, join_back, join_small
from lathe.operators.ranks import exact_quantiles, mann_whitney, quantile_values


def _long(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One aggregate row of structs -> one output row per struct."""
    return df.select(F.inline(F.array(*structs)))


def stack(df: DataFrame, cols: list[str], name: str = "variable", value: str = "value",
          keep: list[str] | None = None, cast: str | None = None) -> DataFrame:
    """Unpivot ``cols`` into ``(name, value)`` rows (values cast to one type)."""
    keep = keep or []
    items = [F.struct(F.lit(x).alias(name), (c(x).cast(cast) if cast else c(x)).alias(value)) for x in cols]
    return df.select(*[c(k) for k in keep], F.inline(F.array(*items)))


def row_count(df: DataFrame) -> int:
    """Fit step: one scalar (the table size), used as a literal downstream."""
    return df.count()


# ------------------------------------------------------------------ G1
def null_summary(df: DataFrame, cols: list[str] | None = None, dp: int = 2) -> DataFrame:
    """Per column: nulls and % nulls; only columns that have nulls."""
    cols = cols or df.columns
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(c(x).isNull()).alias(f"__z{i}") for i, x in enumerate(cols)])
    structs = [F.struct(F.lit(x).alias("column"), F.col(f"__z{i}").alias("nulls"),
                        rnd(F.col(f"__z{i}") * 100.0 / F.col("__n"), dp).alias("pct_nulls"))
               for i, x in enumerate(cols)]
    return _long(one, structs).where(F.col("nulls") > 0)


# ------------------------------------------------------------------ G2
def numeric_stats(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """describe() + bias-corrected skew and excess kurtosis, one aggregate pass."""
    aggs = []
    quart = quantile_values(stack(df, cols, cast="double"), ["variable"], "value", [0.25, 0.5, 0.75]) if exact else {}
    for i, x in enumerate(cols):
        v = c(x)
        if exact:
            qs = quart.get((x,), [None, None, None])
            q = F.array(*[F.lit(a).cast("double") for a in qs])
        else:
            q = F.percentile_approx(v, [0.25, 0.5, 0.75], 10_000)
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), (F.first(q) if exact else q).alias(f"q{i}"), F.max(v).alias(f"hi{i}"),
                 F.skewness(v).alias(f"g1{i}"), F.kurtosis(v).alias(f"g2{i}")]
    one = df.agg(*aggs)
    structs = []
    for i, x in enumerate(cols):
        n = F.col(f"n{i}")
        structs.append(F.struct(
            F.lit(x).alias("column"), n.alias("count"),
            rnd(F.col(f"m{i}"), 2).alias("mean"), rnd(F.col(f"s{i}"), 2).alias("std"),
            rnd(F.col(f"lo{i}"), 2).alias("min"),
            rnd(F.col(f"q{i}")[0], 2).alias("q25"), rnd(F.col(f"q{i}")[1], 2).alias("q50"),
            rnd(F.col(f"q{i}")[2], 2).alias("q75"), rnd(F.col(f"hi{i}"), 2).alias("max"),
            rnd(bias_corrected_skew(F.col(f"g1{i}"), n), 3).alias("skew"),
            rnd(bias_corrected_kurtosis(F.col(f"g2{i}"), n), 3).alias("kurtosis")))
    return _long(one, structs)


# ------------------------------------------------------------------ G3/G4
def schema_profile(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Column, declared type and number of distinct non-null values."""
    cols = cols or df.columns
    types = dict(df.dtypes)
    cd = (lambda v: F.approx_count_distinct(v)) if approx else (lambda v: F.count_distinct(v))
    one = df.agg(*[cd(c(x)).alias(f"d{i}") for i, x in enumerate(cols)])
    structs = [F.struct(F.lit(x).alias("column"), F.lit(types[x]).alias("dtype"), F.col(f"d{i}").alias("n_unique"))
               for i, x in enumerate(cols)]
    return _long(one, structs)


def duplicate_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row (nulls compare equal), plus the shape."""
    cols = cols or df.columns
    groups = df.groupBy(*[c(x) for x in cols]).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.sum("__n").alias("n_rows"), F.lit(len(cols)).alias("n_cols"),
                      F.sum(F.col("__n") - 1).alias("n_duplicates"))


# ------------------------------------------------------------------ G5/G6
def value_share(df: DataFrame, col: str, dp: int = 2) -> DataFrame:
    """Value counts and % of the total (null counted as its own value)."""
    counts = df.groupBy(c(col).alias(col)).agg(F.count(F.lit(1)).alias("count"))
    n = row_count(df)
    return counts.select(col, "count", rnd(F.col("count") * 100.0 / F.lit(n), dp).alias("pct"))


def categorical_describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """describe(include='object'): count, unique, top (ties -> smallest value), freq."""
    long = stack(df, cols, cast="string")
    counts = long.where(F.col("value").isNotNull()).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("variable").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"))


# ------------------------------------------------------------------ G7
def contingency(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """(variable, category, n, n1): category as string, null kept as its own category."""
    y = c(target).cast("int")
    long = stack(df.withColumn("__y", y), cols, keep=["__y"], cast="string")
    return long.groupBy("variable", F.col("value").alias("category")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("__y").cast("long").alias("n1"))


def chi2_from_cells(cells: DataFrame) -> DataFrame:
    """chi2 and dof per variable from contingency cells; Yates correction when dof = 1."""
    tot = cells.groupBy("variable").agg(F.sum("n").alias("__N"), F.sum("n1").alias("__N1"),
                                        F.count(F.lit(1)).alias("__r"))
    j = join_small(cells, tot, on="variable", how="inner")
    N, N1 = F.col("__N").cast("double"), F.col("__N1").cast("double")
    N0 = N - N1
    ncls = (F.col("__N1") > 0).cast("int") + ((F.col("__N") - F.col("__N1")) > 0).cast("int")
    dof = (F.col("__r") - 1) * (ncls - 1)
    j = j.withColumn("__dof", dof)
    terms = []
    for obs, colsum in ((F.col("n1").cast("double"), N1), ((F.col("n") - F.col("n1")).cast("double"), N0)):
        exp = F.col("n").cast("double") * colsum / N
        dev = F.abs(obs - exp)
        dev = F.when(F.col("__dof") == 1, F.greatest(dev - 0.5, F.lit(0.0))).otherwise(dev)
        terms.append(F.when(colsum > 0, dev * dev / exp).otherwise(F.lit(0.0)))
    j = j.withColumn("__term", F.when(F.col("__dof") > 0, terms[0] + terms[1]).otherwise(F.lit(0.0)))
    return j.groupBy("variable").agg(F.sum("__term").alias("chi2"), F.first("__dof").alias("dof"),
                                     F.first("__N").alias("n_total"))


def chi2_test(df: DataFrame, cols: list[str], target: str, dp: int = 2) -> DataFrame:
    """Per (variable, category): count, %, target rate, and the variable's chi2 and dof."""
    cells = contingency(df, cols, target)
    stats = chi2_from_cells(cells)
    j = join_small(cells, stats, on="variable", how="inner")
    return j.select("variable", "category", F.col("n").alias("count"),
                    rnd(F.col("n") * 100.0 / F.col("n_total"), 2).alias("pct"),
                    rnd(F.col("n1") / F.col("n"), 4).alias("target_rate"),
                    rnd("chi2", dp).alias("chi2"), F.col("dof").cast("int").alias("dof"))


def chi2_summary(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """One row per variable: chi2, dof and p-value."""
    from lathe.functions.stats import chi2_pvalue
    stats = chi2_from_cells(contingency(df, cols, target))
    return stats.select("variable", rnd("chi2", 2).alias("chi2"), F.col("dof").cast("int").alias("dof"),
                        chi2_pvalue(F.col("chi2"), F.col("dof")).alias("p_value"))


# ------------------------------------------------------------------ G8
def category_rate(df: DataFrame, col: str, target: str, dp: int = 4) -> DataFrame:
    """mean(target) and n per category (null categories dropped), sorted by rate."""
    return (df.where(c(col).isNotNull()).groupBy(c(col).alias(col))
            .agg(rnd(F.avg(c(target).cast("int")), dp).alias("target_rate"), F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("target_rate")))


def category_summary(df: DataFrame, col: str, target: str) -> DataFrame:
    """frequency (null kept) joined with target rate; one aggregate gives both."""
    counts = df.groupBy(c(col).alias(col)).agg(F.count(F.lit(1)).alias("count"),
                                              rnd(F.avg(c(target).cast("int")), 4).alias("target_rate"))
    n = row_count(df)
    return counts.select(col, "count", rnd(F.col("count") * 100.0 / F.lit(n), 2).alias("pct"), "target_rate")


# ------------------------------------------------------------------ G9/G10/G11
def mann_whitney_table(df: DataFrame, cols: list[str], target: str, with_p: bool = False) -> DataFrame:
    """Per numeric column: U, z, class means, Pearson r with the target."""
    long = stack(df.withColumn("__y", c(target).cast("int")), cols, keep=["__y"], cast="double")
    mw = mann_whitney(long, "value", "__y", part=["variable"])
    means = long.where(F.col("value").isNotNull()).groupBy("variable").agg(
        rnd(F.avg(F.when(F.col("__y") == 1, F.col("value"))), 3).alias("mean_true"),
        rnd(F.avg(F.when(F.col("__y") == 0, F.col("value"))), 3).alias("mean_false"),
        rnd(F.corr("value", F.col("__y").cast("double")), 4).alias("r_pearson"))
    out = mw.join(means, on="variable").select(
        "variable", rnd("U", 0).alias("U"), rnd("z", 6).alias("z"), "mean_true", "mean_false", "r_pearson",
        F.col("n1").alias("n_true"), F.col("n0").alias("n_false"))
    if with_p:
        from lathe.functions.stats import normal_pvalue_two_sided
        out = out.withColumn("p_value", normal_pvalue_two_sided(F.col("z")))
    return out


def pearson_target(df: DataFrame, features: dict[str, Column], target: str, dp: int = 4) -> DataFrame:
    """Pearson r of several features with the target in one aggregate, ranked by |r|."""
    y = c(target).cast("double")
    one = df.agg(*[F.corr(e.cast("double"), y).alias(f"r{i}") for i, e in enumerate(features.values())])
    structs = [F.struct(F.lit(name).alias("feature"), rnd(F.col(f"r{i}"), dp).alias("r_pearson"))
               for i, name in enumerate(features)]
    return _long(one, structs).withColumn("abs_r", F.abs("r_pearson")).orderBy(F.desc("abs_r"))


def correlation_matrix(df: DataFrame, cols: list[str], dp: int = 6) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form (K*K rows), one aggregate."""
    pairs = [(a, b) for a in cols for b in cols]
    idx = {}
    aggs = []
    for a, b in pairs:
        key = tuple(sorted((a, b)))
        if key not in idx:
            idx[key] = f"r{len(idx)}"
            aggs.append(F.corr(c(key[0]).cast("double"), c(key[1]).cast("double")).alias(idx[key]))
    one = df.agg(*aggs)
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                        rnd(F.col(idx[tuple(sorted((a, b)))]), dp).alias("r")) for a, b in pairs]
    return _long(one, structs)


# ------------------------------------------------------------------ G14/G15/G21
def pivot_rate(df: DataFrame, row: str, col: str, target: str, values: list, dp: int = 4) -> DataFrame:
    """Row x col -> mean target; a missing cell stays null. Rows with a null key dropped."""
    d = df.where(c(row).isNotNull() & c(col).isNotNull())
    return (d.groupBy(c(row).alias(row)).pivot(col, values)
            .agg(rnd(F.avg(c(target).cast("int")), dp)))


def distinct_values(df: DataFrame, col: str, max_values: int = 1000) -> list:
    """Fit step for pivots/one-hot: sorted distinct non-null values, size-checked."""
    t = bounded_table(df.where(c(col).isNotNull()).select(c(col).alias("v")).distinct(), max_values)
    if t is None:
        raise ValueError(f"{col}: more than {max_values} distinct values; refusing to pivot")
    return sorted(r["v"] for r in t.collect())


def pivot_count(df: DataFrame, row: str, col: str, values: list | None = None) -> DataFrame:
    """Row x col -> count; missing cell = 0. Values fitted (size-checked) if not given."""
    d = df.where(c(row).isNotNull() & c(col).isNotNull())
    vals = values if values is not None else distinct_values(d, col)
    return d.groupBy(c(row).alias(row)).pivot(col, vals).count().fillna(0, subset=[str(v) for v in vals])


def crosstab_pct(df: DataFrame, row: str, col: str, dp: int = 4) -> DataFrame:
    """Row-normalised crosstab in %, long form (rows with a null key dropped)."""
    d = df.where(c(row).isNotNull() & c(col).isNotNull())
    cells = d.groupBy(c(row).alias(row), c(col).alias(col)).agg(F.count(F.lit(1)).alias("n"))
    tot = cells.groupBy(row).agg(F.sum("n").alias("__t"))
    return (cells.join(tot, on=row)
            .select(row, col, "n", rnd(F.col("n") * 100.0 / F.col("__t"), dp).alias("pct")))


# ------------------------------------------------------------------ G16-G20
def segment_stats(df: DataFrame, segment: Column, age: str, spend_cols: list[str], target: str,
                  dp: int = 3) -> DataFrame:
    """Per segment: mean age, mean total spend, target rate, n."""
    return (df.withColumn("__seg", segment).groupBy(F.col("__seg").alias("segment"))
            .agg(rnd(F.avg(c(age)), dp).alias("mean_age"),
                 rnd(F.avg(total(spend_cols)), dp).alias("mean_spending"),
                 rnd(F.avg(c(target).cast("int")), dp).alias("transport_rate"),
                 F.count(c(target)).alias("n")))


def per_service_stats(df: DataFrame, spend_cols: list[str], target: str) -> DataFrame:
    """Per spend column: % zero, r(log1p, target), rate for spenders / non-spenders, median of spenders."""
    long = stack(df.withColumn("__y", c(target).cast("int")), spend_cols, name="service", keep=["__y"],
                 cast="double").withColumn("value", F.coalesce("value", F.lit(0.0)))
    spender = F.col("value") > 0
    agg = long.groupBy("service").agg(
        rnd(F.avg((F.col("value") == 0).cast("int")) * 100, 2).alias("pct_zero"),
        rnd(F.corr(F.log1p("value"), F.col("__y").cast("double")), 4).alias("r_pearson_log"),
        F.avg(F.when(spender, F.col("__y"))).alias("__rs"),
        rnd(F.avg(F.when(~spender, F.col("__y"))), 4).alias("rate_non_spender"))
    med = (exact_quantiles(long.where(spender), ["service"], "value", [0.5])
           .select("service", F.col("quantile").alias("__med")))
    agg = agg.join(med, on="service", how="left")
    # a rate of exactly 0 is reported as missing, as the reference does
    return agg.select("service", "pct_zero", "r_pearson_log",
                      F.when(F.col("__rs") != 0, rnd("__rs", 4)).alias("rate_spender"),
                      "rate_non_spender", rnd(F.coalesce("__med", F.lit(0.0)), 1).alias("median_spender"))


def zero_inflation(df: DataFrame, spend_cols: list[str], cryo: str) -> DataFrame:
    """% zero per service, % all-zero overall and by cryo vs the rest, with n."""
    allz = row_all_zero(spend_cols).cast("int")
    ct = is_true(cryo)
    one = df.agg(F.count(F.lit(1)).alias("__n"), F.avg(allz).alias("__all"),
                 F.avg(F.when(ct, allz)).alias("__cz"), F.count_if(ct).alias("__cn"),
                 F.avg(F.when(~ct, allz)).alias("__az"), F.count_if(~ct).alias("__an"),
                 *[F.avg((F.coalesce(c(x), F.lit(0.0)) == 0).cast("int")).alias(f"__z{i}")
                   for i, x in enumerate(spend_cols)])
    rows = [F.struct(F.lit(x).alias("segment"), F.lit("service").alias("kind"),
                     rnd(F.col(f"__z{i}") * 100, 2).alias("pct_zero"), F.col("__n").alias("n"))
            for i, x in enumerate(spend_cols)]
    rows += [
        F.struct(F.lit("all").alias("segment"), F.lit("all_zero").alias("kind"),
                 rnd(F.col("__all") * 100, 2).alias("pct_zero"), F.col("__n").alias("n")),
        F.struct(F.lit("CryoSleep=True").alias("segment"), F.lit("all_zero").alias("kind"),
                 rnd(F.col("__cz") * 100, 2).alias("pct_zero"), F.col("__cn").alias("n")),
        F.struct(F.lit("CryoSleep=False/Unknown").alias("segment"), F.lit("all_zero").alias("kind"),
                 rnd(F.col("__az") * 100, 2).alias("pct_zero"), F.col("__an").alias("n")),
    ]
    return _long(one, rows)


def rule_violations(df: DataFrame, spend_cols: list[str], cryo: str = "CryoSleep", age: str = "Age",
                    planet: str = "HomePlanet", cabin: str = "Cabin", child_age: float = 12,
                    deck_rules: list[tuple[list[str], str]] | None = None, dp: int = 3) -> DataFrame:
    """R1..R5 violation counts and % of rows, one aggregate pass.

    R1 cryo & spend; R2 spend & cryo unknown; R3 child & spend; R4/R5 deck
    group -> expected planet (``deck_rules``: list of (decks, planet)).
    """
    deck_rules = deck_rules or [(["A", "B", "C"], "Europa"), (["G"], "Earth")]
    spend = row_any_positive(spend_cols)
    deck = F.split_part(c(cabin), F.lit("/"), F.lit(1))
    conds = [("R1", is_true(cryo) & spend), ("R2", spend & c(cryo).isNull()),
             ("R3", c(age).isNotNull() & is_true(c(age) <= child_age) & spend)]
    for i, (decks, p) in enumerate(deck_rules):
        conds.append((f"R{4 + i}", F.coalesce(deck.isin(decks), F.lit(False)) & c(planet).isNotNull()
                      & is_true(c(planet) != p)))
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(e).alias(f"__{k}") for k, e in conds])
    structs = [F.struct(F.lit(k).alias("rule"), F.col(f"__{k}").alias("violations"),
                        rnd(F.col(f"__{k}") * 100.0 / F.col("__n"), dp).alias("pct")) for k, _ in conds]
    return _long(one, structs)


def imputation_opportunities(df: DataFrame, spend_cols: list[str], key: str = "TravelGroup",
                             planet: str = "HomePlanet", cabin: str = "Cabin", age: str = "Age",
                             cryo: str = "CryoSleep", deck_keys: list[str] | None = None) -> DataFrame:
    """Per variable: nulls, resolvable by group / rule, % resolvable, method."""
    deck_keys = deck_keys or ["A", "B", "C", "G"]
    grp = df.groupBy(key).agg(F.max(c(planet).isNotNull().cast("int")).alias("__hp"),
                              F.max(c(cabin).isNotNull().cast("int")).alias("__cb"),
                              F.max(c(age).isNotNull().cast("int")).alias("__ag"))
    j = join_back(df, grp, [key])
    deck = F.split_part(c(cabin), F.lit("/"), F.lit(1))
    hp_null = c(planet).isNull()
    hp_group = hp_null & (F.col("__hp") == 1)
    hp_deck = hp_null & ~is_true(hp_group) & F.coalesce(deck.isin(deck_keys), F.lit(False))
    one = j.agg(
        F.count_if(hp_null).alias("hp_n"), F.count_if(is_true(hp_group)).alias("hp_g"),
        F.count_if(hp_deck).alias("hp_d"),
        F.count_if(c(cabin).isNull()).alias("cb_n"), F.count_if(c(cabin).isNull() & (F.col("__cb") == 1)).alias("cb_r"),
        F.count_if(c(age).isNull()).alias("ag_n"), F.count_if(c(age).isNull() & (F.col("__ag") == 1)).alias("ag_r"),
        F.count_if(c(cryo).isNull()).alias("cr_n"), F.count_if(c(cryo).isNull() & row_any_positive(spend_cols)).alias("cr_r"))

    def row(var, n, res, method):
        pct = rnd(res * 100.0 / F.greatest(n, F.lit(1)), 1)
        return F.struct(F.lit(var).alias("variable"), n.alias("nulls"), res.alias("resolvable"),
                        pct.alias("pct_resolvable"), F.lit(method).alias("method"))
    return _long(one, [
        row("HomePlanet", F.col("hp_n"), F.col("hp_g") + F.col("hp_d"), "TravelGroup + deck rule"),
        row("Cabin/Deck/Side", F.col("cb_n"), F.col("cb_r"), "TravelGroup"),
        row("Age", F.col("ag_n"), F.col("ag_r"), "TravelGroup median"),
        row("CryoSleep", F.col("cr_n"), F.col("cr_r"), "spend > 0 -> not cryo"),
    ])


# ------------------------------------------------------------------ G22-G24
def iqr_outliers(df: DataFrame, cols: list[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """Q1, Q3, k*IQR bounds, rows outside and % of all rows. Two passes (quantiles, then count)."""
    if exact:
        got = quantile_values(stack(df, cols, cast="double"), ["variable"], "value", [0.25, 0.75])
        qv = {x: got.get((x,), [None, None]) for x in cols}
    else:
        row = df.agg(*[F.percentile_approx(c(x), [0.25, 0.75], 10_000).alias(f"q{i}") for i, x in enumerate(cols)]).first()
        qv = {x: (row[f"q{i}"] or [None, None]) for i, x in enumerate(cols)}
    bounds = {}
    for i, x in enumerate(cols):
        q1, q3 = qv[x]
        if q1 is None:
            bounds[x] = (None, None, None, None)
            continue
        iqr = q3 - q1
        bounds[x] = (q1, q3, q1 - k * iqr, q3 + k * iqr)
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if((c(x) < F.lit(bounds[x][2])) | (c(x) > F.lit(bounds[x][3]))).alias(f"o{i}")
                   for i, x in enumerate(cols)])
    structs = [F.struct(F.lit(x).alias("variable"), F.lit(bounds[x][0]).cast("double").alias("q1"),
                        F.lit(bounds[x][1]).cast("double").alias("q3"),
                        rnd(F.lit(bounds[x][2]).cast("double"), 2).alias("lower_bound"),
                        rnd(F.lit(bounds[x][3]).cast("double"), 2).alias("upper_bound"),
                        F.col(f"o{i}").alias("n_outliers"),
                        rnd(F.col(f"o{i}") * 100.0 / F.col("__n"), 2).alias("pct_outliers"))
               for i, x in enumerate(cols)]
    return _long(one, structs)


def histogram(df: DataFrame, cols: list[str], target: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed), counts overall and per class."""
    long = stack(df.withColumn("__y", c(target).cast("int")), cols, keep=["__y"], cast="double") \
        .where(F.col("value").isNotNull())
    rng = long.groupBy("variable").agg(F.min("value").alias("__lo"), F.max("value").alias("__hi"))
    j = join_small(long, rng, on="variable", how="inner")
    width = (F.col("__hi") - F.col("__lo")) / bins
    b = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("__lo")) / width), F.lit(bins - 1))) \
        .otherwise(F.lit(0)).cast("int")
    return (j.withColumn("bin", b).groupBy("variable", "bin", "__lo", "__hi")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("__y").cast("long").alias("n_true"))
            .select("variable", "bin",
                    rnd(F.col("__lo") + F.col("bin") * (F.col("__hi") - F.col("__lo")) / bins, 6).alias("bin_lo"),
                    rnd(F.col("__lo") + (F.col("bin") + 1) * (F.col("__hi") - F.col("__lo")) / bins, 6).alias("bin_hi"),
                    "n", "n_true", (F.col("n") - F.col("n_true")).alias("n_false")))


def box_summary(df: DataFrame, cols: list[str], by: str | None = None, exact: bool = True) -> DataFrame:
    """Min, Q1, median, Q3, max per column (and per class when ``by`` is given)."""
    long = stack(df, cols, keep=[by] if by else [], cast="double").where(F.col("value").isNotNull())
    if by:
        long = long.withColumn("class", c(by).cast("string")).drop(by)
    part = ["variable"] + (["class"] if by else [])
    stats = long.groupBy(*part).agg(F.min("value").alias("min"), F.max("value").alias("max"),
                                    F.count(F.lit(1)).alias("n"))
    if exact:
        qs = (exact_quantiles(long, part, "value", [0.25, 0.5, 0.75])
              .groupBy(*part).pivot("q_index", [0, 1, 2]).agg(F.first("quantile")))
        stats = stats.join(qs, on=part, how="left")
        q1, q2, q3 = F.col("0"), F.col("1"), F.col("2")
    else:
        stats = stats.join(long.groupBy(*part).agg(F.percentile_approx("value", [0.25, 0.5, 0.75], 10_000)
                                                   .alias("__q")), on=part, how="left")
        q1, q2, q3 = F.col("__q")[0], F.col("__q")[1], F.col("__q")[2]
    return stats.select(*part, "min", rnd(q1, 6).alias("q1"), rnd(q2, 6).alias("median"), rnd(q3, 6).alias("q3"),
                        "max", "n")

