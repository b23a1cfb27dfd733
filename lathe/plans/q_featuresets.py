"""Registered keys for the encoders (H*) and the 13 feature sets (I*).

Each ``fs_*`` key fits the feature set on the fixture table (train mode,
fit on the full table as the reference does) and returns the scaled matrix
with the id and the integer target. The oracle SQL re-states the same row
pipeline with DuckDB window functions, then target encoding, one-hot and
population-std scaling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.functions.columns import rnd
from pyspark.sql import types as T

from lathe.operators import encode as enc
from lathe.operators.evaluate import stratified_kfold
from lathe.plans.base import register, with_passengers
from lathe.plans.featuresets import FEATURE_SETS, Binding, FeatureSet, FittedFeatureSet
from lathe.plans.q_eval import HASH_SQL, split_hash
from lathe.plans.q_rows import FIXTURE_DECK_TO_PLANET
from lathe.plans.sqlfrag import (AGECAT, CABNUM, CRYO_ENC, CRYO_INT, DECK, FIXTURE_DECK_PLANET, GROUP, LAST,
                                 SIDE, SIDE_ENC, SPEND, any_pos_sql, base_cte, cats_sql, total_sql)
from lathe.sources.fixtures import ID_COL, TARGET, passengers

FIXTURE_BINDING = Binding(deck_to_planet=tuple(FIXTURE_DECK_TO_PLANET.items()))

# Fixed values of the fixture definition: the category domains the one-hot
# columns come from (TPC-H region names and order priorities, deck letters).
PLANETS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "Unknown"]
DESTINATIONS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "Unknown"]
DECKS = ["A", "B", "C", "D", "E", "F", "G", "T", "Unknown"]
AGE_CATS = ["Adult", "Child", "Senior", "Teen", "YoungAdult"]


def domain(column: str, sep: str = "_") -> list[str]:
    if column == "HomePlanet":
        return PLANETS
    if column == "Destination":
        return DESTINATIONS
    if column == "Deck":
        return DECKS
    if column == "AgeCategory":
        return AGE_CATS
    if column == "Route":
        return sorted(f"{p}{sep}{d}" for p in PLANETS for d in DESTINATIONS)
    raise KeyError(column)


_FITTED: dict[tuple[str, str, str], FittedFeatureSet] = {}


def fitted(spark, sf: str, name: str) -> FittedFeatureSet:
    """Fit once per (session, data, feature set); the fit state is a few small tables."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FITTED:
        _FITTED[key] = FEATURE_SETS[name].fit(passengers(spark, sf), FIXTURE_BINDING)
    return _FITTED[key]


def round_doubles(df: DataFrame, dp: int = 6) -> DataFrame:
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({x: rnd(F.col(f"`{x}`"), dp) for x in dbl}) if dbl else df


# ======================================================================= SQL: row pipelines (train mode)
G = "PARTITION BY TravelGroup"
FILLS = ("coalesce(HomePlanet,'Unknown') AS HomePlanet, coalesce(Destination,'Unknown') AS Destination, "
         + ", ".join(f"coalesce({x},0) AS {x}" for x in SPEND))


def _fs001_sql(src: str = "b") -> tuple[str, str]:
    ctes = (base_cte() + ",\n"
            f"f1 AS (SELECT * REPLACE ({FILLS}) FROM {src} WHERE Age IS NOT NULL),\n"
            f"r1 AS (SELECT *, count(*) OVER ({G}) AS GroupSize FROM f1)")
    return ctes, "r1"


def _fs003_sql():
    ctes, r = _fs001_sql()
    return ctes + (f",\nr3 AS (SELECT *, CAST(GroupSize = 1 AS INTEGER) AS IsAlone, CAST(coalesce(Age < 13, false) AS INTEGER) "
                   f"AS IsChild, TotalSpending / (SpendingCategories + 1) AS SpendingIntensity FROM {r})"), "r3"


def _entropy(total: str = "TotalSpending") -> str:
    terms = " + ".join(f"CASE WHEN coalesce({x},0)/({total} + 1e-10) > 0 THEN -(coalesce({x},0)/({total} + 1e-10)) * "
                       f"ln(coalesce({x},0)/({total} + 1e-10)) ELSE 0 END" for x in SPEND)
    return f"CASE WHEN {total} > 0 THEN {terms} ELSE 0 END"


def _fs005_sql():
    ctes, r = _fs001_sql()
    profile = " || ".join(f"CASE WHEN coalesce({x},0) > 0 THEN '1' ELSE '0' END" for x in SPEND)
    return ctes + (
        f",\nr5 AS (SELECT *, {_entropy()} AS SpendingEntropy, "
        f"(TotalSpending - avg(TotalSpending) OVER g) / (coalesce(stddev_samp(TotalSpending) OVER g, 0) + 1) AS GroupSpendingZScore, "
        "CAST(count(*) OVER (PARTITION BY Deck ORDER BY CabinNumber RANGE BETWEEN 50 PRECEDING AND 50 FOLLOWING) - 1 AS DOUBLE) "
        "AS CabinNeighborhoodDensity, "
        f"CAST(CASE WHEN {LAST} IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY {LAST}) END AS INTEGER) AS FamilySizeFromName, "
        f"greatest(avg({CRYO_INT}) OVER g, 1 - avg({CRYO_INT}) OVER g) AS GroupCryoAlignment, "
        f"{profile} AS SpendingCategoryProfile, coalesce(stddev_samp(Age) OVER g, 0) AS GroupAgeDispersion "
        f"FROM {r} WINDOW g AS ({G}))"), "r5"


def _fs010_sql():
    ctes, r = _fs001_sql()
    return ctes + (
        f",\nr10 AS (SELECT *, {CRYO_INT} * coalesce(TotalSpending, 0) AS CryoSpendingAnomaly, "
        f"avg(CAST(coalesce(TotalSpending, 0) = 0 AS INTEGER)) OVER ({G}) AS GroupTransportedProxy, "
        "abs(coalesce(avg(CASE WHEN Side='P' THEN TotalSpending END) OVER (PARTITION BY CabinNumber), 0) - "
        "coalesce(avg(CASE WHEN Side='S' THEN TotalSpending END) OVER (PARTITION BY CabinNumber), 0)) AS SideSpendingDiff, "
        f"{CRYO_ENC} AS CryoSleepBinary FROM {r})"), "r10"


def _fs011_sql():
    ctes, r = _fs001_sql()
    return ctes + (
        f",\nc11 AS (SELECT *, CAST(coalesce(Age < 13, false) AS INTEGER) AS IsChild FROM {r}),\n"
        f"r11 AS (SELECT *, max(IsChild) OVER ({G}) AS GroupHasChild, avg(IsChild) OVER ({G}) AS GroupChildRate, "
        "coalesce(HomePlanet,'Unknown') || '_' || coalesce(Destination,'Unknown') AS Route FROM c11)"), "r11"


def _fs013_sql():
    raw = total_sql()
    ctes = (base_cte() + ",\n"
            f"a1 AS (SELECT * REPLACE (coalesce(Age, median(Age) OVER ({G})) AS Age) FROM b),\n"
            f"a2 AS (SELECT * REPLACE ({AGECAT} AS AgeCategory) FROM a1),\n"
            f"a3 AS (SELECT *, min({CRYO_INT}) OVER g AS GroupAllCryo, max({CRYO_INT}) OVER g AS GroupAnyCryo, "
            f"{raw} / (sum({raw}) OVER g + 1) AS SpendShare, ln(1 + (sum({raw}) OVER g - {raw})) AS GroupSpendOthers_Log "
            f"FROM a2 WINDOW g AS ({G})),\n"
            f"f13 AS (SELECT * REPLACE ({FILLS}) FROM a3 WHERE Age IS NOT NULL),\n"
            f"r13 AS (SELECT *, count(*) OVER ({G}) AS GroupSize FROM f13)")
    return ctes, "r13"


def _pct_sql(src: str) -> str:
    span = "(max(CabinNumber) OVER (PARTITION BY Deck) - min(CabinNumber) OVER (PARTITION BY Deck))"
    return (f"SELECT *, coalesce((CabinNumber - min(CabinNumber) OVER (PARTITION BY Deck)) / CASE WHEN {span} = 0 THEN 1 "
            f"ELSE {span} END, 0.5) AS CabinNumber_DeckPercentile FROM {src}")


def _fs002_sql():
    ctes, r = _fs001_sql()
    return ctes + (
        f",\nc2 AS (SELECT *, coalesce(HomePlanet,'Unknown') || '_to_' || coalesce(Destination,'Unknown') AS Route, "
        f"avg({CRYO_INT}) OVER ({G}) AS GroupCryoSleepRate, avg(TotalSpending) OVER ({G}) AS GroupSpendingMean, "
        f"CAST(coalesce(CryoSleep, false) AND {total_sql()} > 0 AS INTEGER) AS CryoSleepViolation, "
        f"(coalesce(Spa,0) + coalesce(VRDeck,0)) / (TotalSpending + 1) AS LuxurySpendingRatio FROM {r}),\n"
        f"r2 AS ({_pct_sql('c2')})"), "r2"


def _spending_cols_sql() -> str:
    return (f"{total_sql()} AS TotalSpending, CAST({total_sql()} > 0 AS INTEGER) AS HasSpending, {cats_sql()} AS SpendingCategories, "
            f"ln(1 + {total_sql()}) AS TotalSpending_Log")


def _parsed_cte(name: str = "p") -> str:
    return (f"{name} AS (SELECT *, {DECK} AS Deck, {CABNUM} AS CabinNumber, {SIDE} AS Side, {GROUP} AS TravelGroup "
            "FROM passengers)")


def _fs006_sql():
    e4 = ", ".join(f"CASE WHEN {x} IS NOT NULL THEN {x} WHEN coalesce(CryoSleep,false) THEN 0 ELSE "
                   f"coalesce(median({x}) OVER ({G}), (SELECT median({x}) FROM passengers), 0) END AS {x}" for x in SPEND)
    ctes = (_parsed_cte() + ",\n"
            f"c6 AS (SELECT * REPLACE (coalesce(HomePlanet,'Unknown') AS HomePlanet, coalesce(Destination,'Unknown') "
            f"AS Destination), {AGECAT} AS AgeCategory FROM p),\n"
            f"e6 AS (SELECT * REPLACE ({e4}) FROM c6),\n"
            f"s6 AS (SELECT *, {_spending_cols_sql()} FROM e6 WHERE Age IS NOT NULL),\n"
            f"r6 AS (SELECT *, count(*) OVER ({G}) AS GroupSize FROM s6)")
    return ctes, "r6"


def _domain_rules_ctes(src: str) -> tuple[str, str]:
    hp = (f"coalesce(HomePlanet, arg_min(HomePlanet, PassengerId) FILTER (WHERE HomePlanet IS NOT NULL) OVER ({G}), "
          f"{FIXTURE_DECK_PLANET.format(d='Deck')})")

    def first(col):
        return (f"CASE WHEN {col} <> 'Unknown' THEN {col} ELSE coalesce(arg_min({col}, PassengerId) FILTER "
                f"(WHERE {col} <> 'Unknown') OVER ({G}), 'Unknown') END")
    cryo0 = ", ".join(f"CASE WHEN coalesce(CryoSleep,false) AND {x} IS NULL THEN 0 ELSE {x} END AS {x}" for x in SPEND)
    child0 = ", ".join(f"CASE WHEN Age IS NOT NULL AND Age <= 12 AND {x} IS NULL THEN 0 ELSE {x} END AS {x}" for x in SPEND)
    ctes = (f"d1 AS (SELECT * REPLACE ({hp} AS HomePlanet, {first('Deck')} AS Deck, {first('Side')} AS Side) FROM {src}),\n"
            f"d2 AS (SELECT * REPLACE ({cryo0}) FROM d1),\n"
            f"d3 AS (SELECT * REPLACE (CASE WHEN {any_pos_sql()} AND CryoSleep IS NULL THEN false ELSE CryoSleep END AS CryoSleep) "
            "FROM d2),\n"
            f"d4 AS (SELECT * REPLACE ({child0}) FROM d3)")
    return ctes, "d4"


def _fs007_sql(with_pct: bool = False):
    dr, d = _domain_rules_ctes("p")
    ctes = (_parsed_cte() + ",\n" + dr + ",\n"
            f"d5 AS (SELECT *, {AGECAT} AS AgeCategory FROM {d}),\n"
            f"d6 AS (SELECT * REPLACE ({FILLS}) FROM d5 WHERE Age IS NOT NULL),\n"
            f"d7 AS (SELECT *, {_spending_cols_sql()} FROM d6)")
    last = "d7"
    if with_pct:
        ctes += f",\nd8 AS ({_pct_sql('d7')})"
        last = "d8"
    ctes += f",\nr7 AS (SELECT *, count(*) OVER ({G}) AS GroupSize FROM {last})"
    return ctes, "r7"


ROW_SQL = {"fs_001": _fs001_sql, "fs_003": _fs003_sql, "fs_004": _fs001_sql, "fs_005": _fs005_sql,
           "fs_010": _fs010_sql, "fs_011": _fs011_sql, "fs_012": _fs011_sql, "fs_013": _fs013_sql,
           "fs_002": _fs002_sql, "fs_006": _fs006_sql, "fs_007": _fs007_sql, "fs_008": _fs007_sql,
           "fs_009": lambda: _fs007_sql(with_pct=True)}


# ======================================================================= SQL: encoders
def _fitted_ctes(fs: FeatureSet) -> str:
    """The row pipeline (``le``), its target encodings (``te0``, ...), the encoded matrix (``x``) and its scaler (``sc``)."""
    ctes, rows = ROW_SQL[fs.name]()
    ctes += (f",\nle AS (SELECT *, {CRYO_ENC} AS CryoSleep_Encoded, {SIDE_ENC.format(s='Side')} AS Side_Encoded "
             f"FROM {rows})")
    te_joins, te_cols = [], []
    for i, x in enumerate(fs.target_encode):
        ctes += (f",\nte{i} AS (SELECT CAST({x} AS VARCHAR) AS v, avg(CAST(Transported AS DOUBLE)) AS m FROM le "
                 f"WHERE {x} IS NOT NULL GROUP BY 1)")
        te_joins.append(f"LEFT JOIN te{i} ON CAST(le.{x} AS VARCHAR) = te{i}.v")
        te_cols.append(f"te{i}.m AS {x}_TE")
    sep = "_to_" if fs.name == "fs_002" else "_"
    ohe = []
    for x in fs.categorical:
        for v in domain(x, sep):
            ohe.append(f"CAST(coalesce(CAST(le.{x} AS VARCHAR) = '{v}', false) AS INTEGER) AS \"{x}_{v}\"")
    drop = list(dict.fromkeys([*fs.drop, "CryoSleep", "Side", *fs.target_encode, *fs.categorical]))
    drop = [x for x in drop if x not in (ID_COL,)]
    sel = ", ".join(["le.*", *te_cols, *ohe])
    ctes += f",\nen AS (SELECT {sel} FROM le {' '.join(te_joins)})"
    ctes += ",\nx AS (SELECT * EXCLUDE (" + ", ".join(drop) + ") REPLACE (CAST(Transported AS INTEGER) AS Transported) FROM en)"
    nums = list(fs.numeric)
    ctes += (",\nsc AS (SELECT " + ", ".join(f"avg(CAST({x} AS DOUBLE)) AS m{i}, stddev_pop(CAST({x} AS DOUBLE)) AS s{i}"
                                          for i, x in enumerate(nums)) + " FROM x)")
    return ctes


def _scale_sql(i: int) -> str:
    return f"CASE WHEN s{i} IS NULL OR s{i} < {enc.ZERO_SCALE!r} THEN 1 ELSE s{i} END"


def encode_sql(fs: FeatureSet) -> str:
    rep = ", ".join(f"round((CAST({x} AS DOUBLE) - m{i}) / {_scale_sql(i)}, 6) AS {x}" for i, x in enumerate(fs.numeric))
    return with_passengers(f"SELECT x.* REPLACE ({rep}) FROM x, sc", _fitted_ctes(fs))


def state_sql(fs: FeatureSet) -> str:
    """Oracle of :meth:`FittedFeatureSet.state`."""
    parts = [f"SELECT 'scaler' AS kind, '{x}' AS name, '{item}' AS item, round({value}, 6) AS value FROM sc"
             for i, x in enumerate(fs.numeric) for item, value in (("mean", f"m{i}"), ("scale", _scale_sql(i)))]
    for i, x in enumerate(fs.target_encode):
        parts += [f"SELECT 'target_encoding', '{x}', v, round(m, 6) FROM te{i}", f"SELECT 'unseen', '{x}', '', round(avg(m), 6) FROM te{i}"]
    parts += [f"SELECT DISTINCT 'one_hot', '{x}', CAST({x} AS VARCHAR), 1.0 FROM le" for x in fs.categorical]
    parts += ["SELECT 'median', 'Age', '', round(median(Age), 6) FROM le",
              f"SELECT 'features', 'all', '', CAST(count(*) AS DOUBLE) FROM (UNPIVOT (SELECT * EXCLUDE ({ID_COL}, {TARGET}) FROM x LIMIT 1) ON COLUMNS(*))"]
    return with_passengers("\nUNION ALL ".join(parts), _fitted_ctes(fs))


def _make(name: str):
    def q(spark, sf):
        return round_doubles(fitted(spark, sf, name).train_matrix())
    q.__name__ = f"q_{name}"
    q.__doc__ = f"Feature set {name}: {FEATURE_SETS[name].description}"
    return q


for _name, _fs in FEATURE_SETS.items():
    register(_name, encode_sql(_fs))(_make(_name))


# ======================================================================= H keys
_TE_SQL = base_cte() + ",\n" + "te AS (SELECT Deck AS value, avg(CAST(Transported AS DOUBLE)) AS mean FROM b GROUP BY Deck)"


@register("target_encode_fit", with_passengers("SELECT value, round(mean, 6) AS mean FROM te", _TE_SQL))
def q_te_fit(spark, sf):
    from lathe.plans.q_rows import base
    te = enc.target_encode_fit(base(spark, sf), "Deck", TARGET)
    return te.table.select("value", rnd("mean", 6).alias("mean"))


@register("target_encode_apply", with_passengers(
    "SELECT t.PassengerId, round(coalesce(te.mean, (SELECT avg(mean) FROM te)), 6) AS Deck_TE FROM b t "
    "LEFT JOIN te ON t.Deck = te.value",
    base_cte() + ",\nte AS (SELECT Deck AS value, avg(CAST(Transported AS DOUBLE)) AS mean FROM b "
    "WHERE Deck NOT IN ('A', 'T') GROUP BY Deck)"))
def q_te_apply(spark, sf):
    """Fit on part of the table (decks A and T unseen), apply to all rows: unseen -> mean of means."""
    from lathe.plans.q_rows import base
    df = base(spark, sf)
    te = enc.target_encode_fit(df.where(~F.col("Deck").isin("A", "T")), "Deck", TARGET)
    return te.apply(df, "Deck_TE").select(ID_COL, rnd("Deck_TE", 6).alias("Deck_TE"))


_FOLD_SQL = (base_cte() + f",\nfo AS (SELECT PassengerId, Deck, CAST(Transported AS INTEGER) AS y, (row_number() OVER (PARTITION BY Transported "
             f"ORDER BY {HASH_SQL}, PassengerId) - 1) % 5 AS fold, {HASH_SQL} AS h FROM b)")


@register("target_encode_oof", with_passengers(
    "SELECT PassengerId, fold, round(coalesce((sum(y) OVER (PARTITION BY Deck) - sum(y) OVER (PARTITION BY Deck, fold)) / "
    "nullif(CAST(count(*) OVER (PARTITION BY Deck) - count(*) OVER (PARTITION BY Deck, fold) AS DOUBLE), 0), "
    "(sum(y) OVER () - sum(y) OVER (PARTITION BY fold)) / CAST(count(*) OVER () - count(*) OVER (PARTITION BY fold) AS DOUBLE)), 6) AS Deck_TE "
    "FROM fo", _FOLD_SQL))
def q_te_oof(spark, sf):
    """H1 out of fold (Q1): each row's deck encoded from the other four folds' rows."""
    from lathe.plans.q_rows import base
    df = base(spark, sf).select(ID_COL, "Deck", TARGET)
    folded = stratified_kfold(df, TARGET, ID_COL, split_hash(), k=5)
    return enc.target_encode_out_of_fold(folded, "Deck", TARGET, "fold").select(ID_COL, F.col("fold").cast("long").alias("fold"), rnd("Deck_TE", 6).alias("Deck_TE"))


@register("ordered_target_stats", with_passengers(
    "SELECT PassengerId, round((coalesce(sum(y) OVER w, 0) + 0.5) / (count(*) OVER w + 1.0), 6) AS Deck_OTS FROM fo "
    f"WINDOW w AS (PARTITION BY Deck ORDER BY h, PassengerId ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", _FOLD_SQL))
def q_ordered_target_stats(spark, sf):
    """Ordered target statistics of the deck along the permutation that the id hash gives."""
    from lathe.plans.q_rows import base
    df = base(spark, sf).select(ID_COL, "Deck", TARGET)
    return enc.ordered_target_statistics(df, "Deck", TARGET, split_hash(), ID_COL).select(ID_COL, rnd("Deck_OTS", 6).alias("Deck_OTS"))


@register("one_hot", with_passengers(
    "SELECT PassengerId, " + ", ".join(f"CAST(coalesce(HomePlanet = '{v}', false) AS INTEGER) AS \"HomePlanet_{v}\""
                                       for v in PLANETS[:-1]) + " FROM passengers"))
def q_one_hot(spark, sf):
    df = passengers(spark, sf)
    vals = enc.one_hot_fit(enc.category_stats(df, ["HomePlanet"], TARGET), ["HomePlanet"])
    return enc.one_hot_apply(df.select(ID_COL, "HomePlanet"), vals)


_SCALE_COLS = ["Age", "CabinNumber", "TotalSpending_Log", "HasSpending"]


@register("standard_scale", with_passengers(
    "SELECT PassengerId, " + ", ".join(
        f"round((CAST({x} AS DOUBLE) - (SELECT avg({x}) FROM b)) / CASE WHEN (SELECT stddev_pop({x}) FROM b) < 1e-14 "
        f"THEN 1 ELSE (SELECT stddev_pop({x}) FROM b) END, 6) AS {x}" for x in _SCALE_COLS) + ", CAST(0 AS DOUBLE) AS Const FROM b",
    base_cte()))
def q_standard_scale(spark, sf):
    from lathe.plans.q_rows import base
    df = base(spark, sf).withColumn("Const", F.lit(3.5))
    sc = enc.standard_scale_fit(df, [*_SCALE_COLS, "Const"])
    out = sc.apply(df.select(ID_COL, *_SCALE_COLS, "Const"))
    return round_doubles(out)


@register("feature_pipeline", encode_sql(FEATURE_SETS["fs_004"]))
def q_feature_pipeline(spark, sf):
    """H5: fit + train-mode transform of the default TE feature set (same as fs_004)."""
    return round_doubles(fitted(spark, sf, "fs_004").train_matrix())


def apply_sql(fs: FeatureSet, known: str) -> str:
    """Oracle of a fit on the rows ``known`` (with an age) and of its test mode on every row (production row pipeline)."""
    def rows(t: str, src: str, age: str, where: str) -> str:
        return (f"{t}1 AS (SELECT * REPLACE ({FILLS}{age}) FROM {src} {where}),\n"
                f"{t}2 AS (SELECT *, count(*) OVER ({G}) AS GroupSize, CAST(coalesce(Age < 13, false) AS INTEGER) AS IsChild FROM {t}1),\n"
                f"{t}3 AS (SELECT *, max(IsChild) OVER ({G}) AS GroupHasChild, avg(IsChild) OVER ({G}) AS GroupChildRate, "
                f"HomePlanet || '_' || Destination AS Route, {CRYO_ENC} AS CryoSleep_Encoded, {SIDE_ENC.format(s='Side')} AS Side_Encoded FROM {t}2)")
    ctes = base_cte() + ",\n" + rows("k", "b", "", f"WHERE Age IS NOT NULL AND {known}") + ",\nmed AS (SELECT median(Age) AS m FROM k1),\n" \
        + rows("e", "b", ", coalesce(Age, (SELECT m FROM med)) AS Age", "")
    for i, x in enumerate(fs.target_encode):
        ctes += f",\nte{i} AS (SELECT {x} AS v, avg(CAST(Transported AS DOUBLE)) AS m FROM k3 GROUP BY 1)"
    for t in "ke":
        cols = ", ".join(f"coalesce(te{i}.m, (SELECT avg(m) FROM te{i})) AS {x}_TE" for i, x in enumerate(fs.target_encode))
        joins = " ".join(f"LEFT JOIN te{i} ON {t}3.{x} = te{i}.v" for i, x in enumerate(fs.target_encode))
        ctes += f",\n{t}4 AS (SELECT {t}3.*, {cols} FROM {t}3 {joins})"
    ctes += ",\nsc AS (SELECT " + ", ".join(f"avg(CAST({x} AS DOUBLE)) AS m{i}, stddev_pop(CAST({x} AS DOUBLE)) AS s{i}"
                                            for i, x in enumerate(fs.numeric)) + " FROM k4)"
    values = {"Destination": [x for x in DESTINATIONS if x != "5-LOW"], "AgeCategory": AGE_CATS}
    ohe = ", ".join(f"CAST({x} = '{v}' AS INTEGER) AS \"{x}_{v}\"" for x in fs.categorical for v in values[x])
    scaled = ", ".join(f"round((CAST({x} AS DOUBLE) - m{i}) / CASE WHEN s{i} IS NULL OR s{i} < {enc.ZERO_SCALE!r} THEN 1 ELSE s{i} END, 6) AS {x}"
                       for i, x in enumerate(fs.numeric))
    drop = [x for x in dict.fromkeys([*fs.drop, "CryoSleep", "Side", *fs.target_encode, *fs.categorical]) if x != ID_COL]
    drop += [f"{p}{i}" for i in range(len(fs.numeric)) for p in "ms"]
    return with_passengers(f"SELECT * EXCLUDE ({', '.join(drop)}) REPLACE (CAST(Transported AS INTEGER) AS Transported, {scaled}), {ohe} FROM e4, sc", ctes)


@register("feature_pipeline_state", state_sql(FEATURE_SETS["fs_004"]))
def q_feature_pipeline_state(spark, sf):
    """H5: what the fit of the default TE feature set keeps: encodings, categories, scaler, median, number of features."""
    return fitted(spark, sf, "fs_004").state(spark).select("kind", "name", "item", rnd("value", 6).alias("value"))


@register("feature_pipeline_apply", apply_sql(FEATURE_SETS["fs_012"], "Destination IS DISTINCT FROM '5-LOW'"))
def q_feature_pipeline_apply(spark, sf):
    """H6: fit on rows with a known age, apply in test mode to every row (ages imputed
    with the fitted median, unseen categories -> TE mean of means / all-zero one-hot)."""
    fs = FEATURE_SETS["fs_012"]
    df = passengers(spark, sf)
    fit = fs.fit(df.where(F.col("Age").isNotNull() & ~F.col("Destination").eqNullSafe("5-LOW")), FIXTURE_BINDING)
    return round_doubles(fit.transform(df, train=False))
