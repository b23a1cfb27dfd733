"""Imputation and ordered domain rules (E*).

Global statistics (medians) are fitted by one aggregate and used as
literals, so no cross join is needed. Group statistics reuse the
groupBy + join-back pattern of ``groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.functions.columns import UNKNOWN, c, is_true, positive_count
from lathe.operators.groups import group_stats
from lathe.operators.lookup import join_back, mapping_expr
from lathe.session import cut_lineage


def median_expr(x: Column, exact: bool = True, accuracy: int = 10_000) -> Column:
    """Interpolated median (pandas semantics); ``exact=False`` switches to a sketch."""
    return F.median(x) if exact else F.percentile_approx(x, 0.5, accuracy)


def global_medians(df: DataFrame, cols: list[str], exact: bool = True) -> dict[str, float | None]:
    """Fit step: one median per column (a few numbers reach the driver).

    Exact medians are bracketed by a sketch, then found among the distinct values inside
    the bracket (a share of 2 * ``BESIDE`` of the rows, and the sketch's error); a median that the
    bracket misses, or with too many values inside, goes through the distributed
    ``ranks.exact_quantiles``. ``exact=False`` uses one ``percentile_approx`` pass.
    """
    if not exact:
        row = df.agg(*[median_expr(c(x), False).alias(x) for x in cols]).first()
        return {x: (None if row[x] is None else float(row[x])) for x in cols}
    from lathe.operators.profile import stack
    from lathe.operators.ranks import quantile_values
    long = stack(df, cols, cast="double").where(F.col("value").isNotNull() & ~F.isnan("value"))
    sides = F.percentile_approx("value", [0.5 - BESIDE, 0.5 + BESIDE], 10_000)
    edges = {r["variable"]: r["q"] for r in long.groupBy("variable").agg(sides.alias("q")).collect()}     # a row per column
    out: dict[str, float | None] = dict.fromkeys(cols)
    if not edges:
        return out
    low, high = (mapping_expr("variable", {x: q[i] for x, q in edges.items()}) for i in (0, 1))
    place = F.when(F.col("value") < low, -1).when(F.col("value") > high, 1).otherwise(0)
    counts = long.groupBy("variable", place.alias("place"), F.when(place == 0, F.col("value")).alias("value")).agg(F.count("*").alias("n"))
    cells = counts.limit(BRACKET_VALUES * len(cols) + 1).collect()
    found = {} if len(cells) > BRACKET_VALUES * len(cols) else {x: _bracketed([r for r in cells if r["variable"] == x]) for x in edges}
    missed = [x for x in edges if found.get(x) is None]
    if missed:
        got = quantile_values(stack(df, missed, cast="double"), ["variable"], "value", [0.5])
        found |= {x: got[(x,)][0] for x in missed}
    return out | found


#: Half the share of rows between the sketched quantiles beside a median, and the distinct values inside that are collected per column.
BESIDE = 2e-4
BRACKET_VALUES = 1 << 16


def _bracketed(cells: list) -> float | None:
    """The median from (place below / inside / above, value, n); None if it isn't inside."""
    n, before = sum(r["n"] for r in cells), sum(r["n"] for r in cells if r["place"] < 0)
    inside = sorted((r["value"], r["n"]) for r in cells if r["place"] == 0)
    picked = []
    for rank in ((n - 1) // 2, n // 2):
        run = before
        for value, times in inside:
            if run <= rank < run + times:
                picked.append(value)
            run += times
    a, b = picked if len(picked) == 2 else (None, None)
    return None if a is None else a + (b - a) * 0.5


def group_medians(df: DataFrame, key: str, cols: list[str], exact: bool = True, extra: dict[str, Column] | None = None) -> DataFrame:
    """Per-group medians ``(key, __gm_<col>...)`` and the aggregates ``extra``, a row per group; without ``extra``,
    groups that have no value have no row.

    A group's values are sorted where they meet in one aggregate. Groups of more than ``HOT_ROWS`` rows, if there are
    any, go through ``ranks.exact_quantiles`` instead, so they are spread like any other part."""
    names = {x: f"__gm_{x}" for x in cols}
    extra = extra or {}
    more = [e.alias(n) for n, e in extra.items()]
    if not exact:
        return df.groupBy(key).agg(*[median_expr(c(x), False).alias(n) for x, n in names.items()], *more)
    hot = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > HOT_ROWS).select(F.col(key).alias("__hot"))
    if hot.isEmpty():
        return _sorted_medians(df, key, names, more)
    from lathe.operators.profile import stack
    from lathe.operators.ranks import exact_quantiles
    hot = cut_lineage(hot)
    same = c(key).eqNullSafe(F.col("__hot"))
    large = df.join(hot, same, "left_semi")
    q = exact_quantiles(stack(large, cols, keep=[key], cast="double"), [key, "variable"], "value", [0.5])
    # with extra statistics, groups without a value have a row as well
    q = large.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *more).join(
        q.select(F.col(key).alias("__hot"), "variable", "quantile"), same, "left" if extra else "inner")
    medians = q.groupBy(key).agg(*[F.max(F.when(F.col("variable") == x, F.col("quantile"))).alias(n) for x, n in names.items()],
                                 *[F.first(n).alias(n) for n in extra])
    return _sorted_medians(df.join(hot, same, "left_anti"), key, names, more).unionByName(medians)


#: Rows of a group whose values one task sorts.
HOT_ROWS = 1 << 16


def _sorted_medians(df: DataFrame, key: str, names: dict[str, str], more: list[Column]) -> DataFrame:
    values = F.struct(*[c(x).cast("double").alias(n) for x, n in names.items()])
    lists = df.groupBy(key).agg(F.collect_list(values).alias("__gl"), *more)

    def median(n: str) -> Column:
        known = F.sort_array(F.filter(F.col("__gl")[n], lambda v: v.isNotNull() & ~F.isnan(v)))

        def middle(v: Column) -> Column:
            at = F.size(v) - 1
            a, b = v[F.floor(at / 2).cast("int")], v[F.ceil(at / 2).cast("int")]
            return F.when(F.size(v) > 0, a + (b - a) * 0.5)
        return F.transform(F.array(known), middle)[0]
    out = lists.withColumns({n: median(n) for n in names.values()}).drop("__gl")
    return out if more else out.dropna("all", subset=list(names.values()))


# ------------------------------------------------------------------ E1/E2
def impute_constant(df: DataFrame, categorical: list[str], numeric: list[str],
                    unknown: str = UNKNOWN, zero: float = 0.0) -> DataFrame:
    """Categorical null -> 'Unknown', numeric null -> 0.

    Boolean (tri-state) columns keep null as their unknown state: every
    encoder treats null exactly as the reference treats the 'Unknown' label.
    """
    dtypes = dict(df.dtypes)
    fills = {}
    for x in categorical:
        if dtypes.get(x) == "string":
            fills[x] = F.coalesce(c(x), F.lit(unknown))
    for x in numeric:
        fills[x] = F.coalesce(c(x), F.lit(zero))
    return df.withColumns(fills) if fills else df


def tri_state_label(col: str, unknown: str = UNKNOWN) -> Column:
    """Boolean tri-state rendered as the reference's labels 'True'/'False'/'Unknown'."""
    x = c(col)
    return F.when(x, F.lit("True")).when(~x, F.lit("False")).otherwise(F.lit(unknown))


def impute_global_median(df: DataFrame, col: str = "Age", median: float | None = None,
                         exact: bool = True) -> DataFrame:
    """Null -> median of ``df`` (or of a fitted ``median``)."""
    m = median if median is not None else global_medians(df, [col], exact)[col]
    if m is None:
        return df
    return df.withColumn(col, F.coalesce(c(col), F.lit(m)))


def drop_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """``dropna(subset=cols)``."""
    return df.dropna(subset=cols)


# ------------------------------------------------------------------ E3
def impute_group_median(df: DataFrame, col: str = "Age", key: str = "TravelGroup",
                        exact: bool = True) -> DataFrame:
    """Null -> median of the group (stays null if the group has none)."""
    med = group_medians(df, key, [col], exact)
    tmp = join_back(df, med, [key])
    return tmp.withColumn(col, F.coalesce(c(col), F.col(f"__gm_{col}"))).drop(f"__gm_{col}")


# ------------------------------------------------------------------ E4
def impute_spend_group_aware(df: DataFrame, cols: list[str], key: str = "TravelGroup",
                             cryo: str = "CryoSleep", exact: bool = True, extra: dict[str, Column] | None = None) -> DataFrame:
    """Null & cryo -> 0; null & not cryo -> group median -> global median -> 0.

    ``extra`` group statistics ride on the medians' aggregate."""
    gmed = global_medians(df, cols, exact)
    tmp = join_back(df, group_medians(df, key, cols, exact, extra), [key])
    cryo_true = is_true(cryo)
    upd = {}
    for x in cols:
        g = F.col(f"__gm_{x}")
        fallback = F.coalesce(g, F.lit(gmed[x]), F.lit(0.0)) if gmed[x] is not None else F.coalesce(g, F.lit(0.0))
        upd[x] = F.when(c(x).isNotNull(), c(x)).when(cryo_true, F.lit(0.0)).otherwise(fallback)
    return tmp.withColumns(upd).drop(*[f"__gm_{x}" for x in cols])


# ------------------------------------------------------------------ E5/E6
def first_known(value: str, known: Column, order: str) -> Column:
    """Value of the first row (by ``order``) where ``known`` holds; deterministic."""
    return F.min_by(c(value), F.when(known, c(order)))


def impute_group_first(df: DataFrame, cols: dict[str, Column], key: str = "TravelGroup",
                       order: str = "PassengerId", unknown: str | None = None) -> DataFrame:
    """E5: unknown -> first known value in the group (row order = ``order``).

    ``cols`` maps column -> "is known" predicate. Rows stay unknown when the
    group has no known value (``unknown`` label, or null).
    """
    aggs = {f"__gf_{x}": first_known(x, is_true(k), order) for x, k in cols.items()}
    tmp = group_stats(df, key, aggs)
    upd = {}
    for x, k in cols.items():
        filled = F.col(f"__gf_{x}")
        if unknown is not None:
            filled = F.coalesce(filled, F.lit(unknown))
        upd[x] = F.when(is_true(k), c(x)).otherwise(filled)
    return tmp.withColumns(upd).drop(*aggs.keys())


# Deck -> home planet rule of the reference (A, B, C: Europa; G: Earth).
DECK_TO_PLANET = {"A": "Europa", "B": "Europa", "C": "Europa", "G": "Earth"}


def impute_lookup(df: DataFrame, target: str = "HomePlanet", source: str = "Deck",
                  mapping: dict | None = None) -> DataFrame:
    """Fill a null ``target`` from a small fixed mapping of ``source``."""
    m = mapping if mapping is not None else DECK_TO_PLANET
    return df.withColumn(target, F.coalesce(c(target), mapping_expr(source, m)))


# ------------------------------------------------------------------ E7
def apply_domain_rules(df: DataFrame, spend_cols: list[str], key: str = "TravelGroup",
                       order: str = "PassengerId", planet: str = "HomePlanet", deck: str = "Deck",
                       side: str = "Side", cryo: str = "CryoSleep", age: str = "Age",
                       deck_to_planet: dict | None = None, child_age: float = 12,
                       unknown: str = UNKNOWN, extra: dict[str, Column] | None = None) -> DataFrame:
    """Six ordered rules, one group aggregate for the three group rules.

    1 planet <- first known planet of the group; 2 planet <- deck lookup (on the
    deck *before* rule 3); ``extra`` group statistics ride on that aggregate; 3 deck, side <- first known of the group; 4 cryo ->
    null spend = 0; 5 spend > 0 & cryo null -> False; 6 age <= limit -> null spend = 0.
    """
    m = deck_to_planet if deck_to_planet is not None else DECK_TO_PLANET
    known_deck = c(deck) != unknown
    known_side = c(side) != unknown
    aggs = {
        "__dr_planet": first_known(planet, c(planet).isNotNull(), order),
        "__dr_deck": first_known(deck, is_true(known_deck), order),
        "__dr_side": first_known(side, is_true(known_side), order),
    }
    tmp = group_stats(df, key, {**aggs, **(extra or {})})
    planet_new = F.coalesce(c(planet), F.col("__dr_planet"), mapping_expr(deck, m))
    deck_new = F.when(c(deck) == unknown, F.coalesce(F.col("__dr_deck"), F.lit(unknown))).otherwise(c(deck))
    side_new = F.when(c(side) == unknown, F.coalesce(F.col("__dr_side"), F.lit(unknown))).otherwise(c(side))
    tmp = tmp.withColumns({planet: planet_new, deck: deck_new, side: side_new}).drop(*aggs.keys())

    cryo_true = is_true(cryo)
    tmp = tmp.withColumns({x: F.when(cryo_true & c(x).isNull(), F.lit(0.0)).otherwise(c(x)) for x in spend_cols})
    spending = positive_count(spend_cols) > 0
    tmp = tmp.withColumn(cryo, F.when(spending & c(cryo).isNull(), F.lit(False)).otherwise(c(cryo)))
    child = c(age).isNotNull() & (c(age) <= child_age)
    return tmp.withColumns({x: F.when(child & c(x).isNull(), F.lit(0.0)).otherwise(c(x)) for x in spend_cols})
