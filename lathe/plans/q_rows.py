"""Registered keys for row operators: projections (B), filters (C), group
context (D), imputation (E) and joins (F), bound to the ``passengers`` fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.functions import columns as col
from lathe.operators import groups as grp
from lathe.operators import impute as imp
from lathe.operators import lookup as lk
from lathe.functions.columns import rnd
from lathe.plans.base import r, register, with_passengers
from lathe.plans.sqlfrag import (AGECAT, CABNUM, CABNUM_EDA, CRYO_ENC, CRYO_INT, DECK, FIXTURE_DECK_PLANET,
                                 GROUP, LAST, SIDE, SIDE_ENC, SPEND, any_pos_sql, base_cte, cats_sql,
                                 total_sql)
from lathe.sources.fixtures import ID_COL, SPEND_COLS, TARGET, passengers

# Fixture binding of the deck -> planet rule (region names stand in for planets).
FIXTURE_DECK_TO_PLANET = {"A": "EUROPE", "B": "EUROPE", "C": "EUROPE", "G": "AMERICA"}


def base(spark: SparkSession, sf: str) -> DataFrame:
    """B1 + B2 + B3 + B5 over the fixture: the first steps of every row pipeline."""
    df = passengers(spark, sf)
    df = col.split_cabin(df)
    df = col.split_group_key(df)
    df = col.spend_totals(df, SPEND_COLS)
    return df.withColumn("AgeCategory", col.age_category("Age"))


# ======================================================================= flagship
@register("deck_groupsize_summary", with_passengers(
    f"SELECT Deck, GroupSize, round(avg(CAST(Transported AS INTEGER)),6) AS transport_rate, "
    f"round(CAST(sum(CAST(round(TotalSpending * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100, 6) AS mean_spending, "
    f"count(*) AS n FROM g GROUP BY Deck, GroupSize",
    base_cte() + ", g AS (SELECT *, count(*) OVER (PARTITION BY TravelGroup) AS GroupSize FROM b)"))
def q_deck_groupsize(spark, sf):
    """Minimum slice: scan -> parse -> group context -> aggregate."""
    df = grp.group_size(base(spark, sf))
    # money mean from exact integer cents: identical in every engine and partitioning
    cents = F.sum(rnd(F.col("TotalSpending") * 100).cast("long"))
    return df.groupBy("Deck", "GroupSize").agg(
        r(F.avg(F.col(TARGET).cast("int"))).alias("transport_rate"),
        r(cents / F.count(F.lit(1)) / 100.0).alias("mean_spending"),
        F.count(F.lit(1)).alias("n"))


# ======================================================================= B
@register("split_cabin", with_passengers(
    f"SELECT PassengerId, {DECK} AS Deck, {CABNUM} AS CabinNumber, {SIDE} AS Side FROM passengers"))
def q_split_cabin(spark, sf):
    return col.split_cabin(passengers(spark, sf)).select(ID_COL, "Deck", "CabinNumber", "Side")


@register("split_cabin_eda", with_passengers(
    f"SELECT PassengerId, {DECK} AS Deck, {CABNUM_EDA} AS CabinNumber, {SIDE} AS Side FROM passengers"))
def q_split_cabin_eda(spark, sf):
    df = col.split_cabin(passengers(spark, sf), number_default=None)
    return df.select(ID_COL, "Deck", "CabinNumber", "Side")


@register("split_group_key", with_passengers(
    f"SELECT PassengerId, {GROUP} AS TravelGroup FROM passengers"))
def q_split_group_key(spark, sf):
    return col.split_group_key(passengers(spark, sf)).select(ID_COL, "TravelGroup")


@register("spend_totals", with_passengers(
    f"SELECT PassengerId, round({total_sql()},6) AS TotalSpending, CAST({total_sql()} > 0 AS INTEGER) AS HasSpending, "
    f"{cats_sql()} AS SpendingCategories, round(ln(1 + {total_sql()}),6) AS TotalSpending_Log FROM passengers"))
def q_spend_totals(spark, sf):
    df = col.spend_totals(passengers(spark, sf), SPEND_COLS)
    return df.select(ID_COL, r("TotalSpending").alias("TotalSpending"), "HasSpending", "SpendingCategories",
                     r("TotalSpending_Log").alias("TotalSpending_Log"))


@register("row_any_all", with_passengers(
    f"SELECT PassengerId, {any_pos_sql()} AS any_positive, "
    f"({' AND '.join(f'coalesce({x},0) = 0' for x in SPEND)}) AS all_zero FROM passengers"))
def q_row_any_all(spark, sf):
    return passengers(spark, sf).select(ID_COL, col.row_any_positive(SPEND_COLS).alias("any_positive"),
                                        col.row_all_zero(SPEND_COLS).alias("all_zero"))


@register("age_bins", with_passengers(f"SELECT PassengerId, Age, {AGECAT} AS AgeCategory FROM passengers"))
def q_age_bins(spark, sf):
    return passengers(spark, sf).select(ID_COL, "Age", col.age_category("Age").alias("AgeCategory"))


@register("tri_state_encode", with_passengers(
    f"SELECT PassengerId, {CRYO_ENC} AS CryoSleep_Encoded, {CRYO_INT} AS CryoSleep_Int, "
    f"CASE WHEN VIP THEN 1 WHEN NOT VIP THEN 0 ELSE -1 END AS VIP_Encoded FROM passengers"))
def q_tri_state(spark, sf):
    return passengers(spark, sf).select(ID_COL, col.tri_state("CryoSleep", -1).alias("CryoSleep_Encoded"),
                                        col.tri_state("CryoSleep", 0).alias("CryoSleep_Int"),
                                        col.tri_state("VIP", -1).alias("VIP_Encoded"))


@register("side_encode", with_passengers(
    f"SELECT PassengerId, {SIDE} AS Side, {SIDE_ENC.format(s=SIDE)} AS Side_Encoded FROM passengers"))
def q_side_encode(spark, sf):
    df = col.split_cabin(passengers(spark, sf))
    return df.select(ID_COL, "Side", col.side_code("Side").alias("Side_Encoded"))


@register("route_concat", with_passengers(
    "SELECT PassengerId, coalesce(HomePlanet,'Unknown') || '_to_' || coalesce(Destination,'Unknown') AS Route_fs002, "
    "coalesce(HomePlanet,'Unknown') || '_' || coalesce(Destination,'Unknown') AS Route_fs011 FROM passengers"))
def q_route(spark, sf):
    return passengers(spark, sf).select(ID_COL, col.route(sep="_to_").alias("Route_fs002"),
                                        col.route(sep="_").alias("Route_fs011"))


@register("spend_ratios", with_passengers(
    "SELECT PassengerId, round((coalesce(Spa,0) + coalesce(VRDeck,0)) / (TotalSpending + 1), 6) AS LuxurySpendingRatio, "
    "round(TotalSpending / (SpendingCategories + 1), 6) AS SpendingIntensity FROM b", base_cte()))
def q_spend_ratios(spark, sf):
    df = base(spark, sf)
    lux = col.ratio_plus_one(col.zero_if_null("Spa") + col.zero_if_null("VRDeck"), F.col("TotalSpending"))
    inten = col.ratio_plus_one(F.col("TotalSpending"), F.col("SpendingCategories"))
    return df.select(ID_COL, r(lux).alias("LuxurySpendingRatio"), r(inten).alias("SpendingIntensity"))


def _entropy_sql() -> str:
    terms = " + ".join(
        f"CASE WHEN coalesce({x},0)/(TotalSpending + 1e-10) > 0 THEN -(coalesce({x},0)/(TotalSpending + 1e-10)) * "
        f"ln(coalesce({x},0)/(TotalSpending + 1e-10)) ELSE 0 END" for x in SPEND)
    return f"CASE WHEN TotalSpending > 0 THEN {terms} ELSE 0 END"


@register("spend_entropy", with_passengers(
    f"SELECT PassengerId, round({_entropy_sql()}, 6) AS SpendingEntropy FROM b", base_cte()))
def q_spend_entropy(spark, sf):
    df = base(spark, sf)
    return df.select(ID_COL, r(col.spend_entropy(SPEND_COLS)).alias("SpendingEntropy"))


@register("spend_profile", with_passengers(
    "SELECT PassengerId, " + " || ".join(f"CASE WHEN coalesce({x},0) > 0 THEN '1' ELSE '0' END" for x in SPEND)
    + " AS SpendingCategoryProfile FROM passengers"))
def q_spend_profile(spark, sf):
    return passengers(spark, sf).select(ID_COL, col.spend_profile(SPEND_COLS).alias("SpendingCategoryProfile"))


@register("indicator_flags", with_passengers(
    "SELECT PassengerId, CAST(GroupSize = 1 AS INTEGER) AS IsAlone, CAST(coalesce(Age < 13, false) AS INTEGER) AS IsChild, "
    "CAST(coalesce(CryoSleep, false) AND TotalSpending > 0 AS INTEGER) AS CryoSleepViolation, "
    f"round({CRYO_INT} * TotalSpending, 6) AS CryoSpendingAnomaly FROM g",
    base_cte() + ", g AS (SELECT *, count(*) OVER (PARTITION BY TravelGroup) AS GroupSize FROM b)"))
def q_indicator_flags(spark, sf):
    df = grp.group_size(base(spark, sf))
    return df.select(
        ID_COL,
        col.flag(F.col("GroupSize") == 1).alias("IsAlone"),
        col.flag(F.col("Age") < 13).alias("IsChild"),
        col.flag(col.is_true("CryoSleep") & (F.col("TotalSpending") > 0)).alias("CryoSleepViolation"),
        r(grp.cryo_int() * F.col("TotalSpending")).alias("CryoSpendingAnomaly"))


@register("last_token", with_passengers(f"SELECT PassengerId, {LAST} AS LastName FROM passengers"))
def q_last_token(spark, sf):
    return passengers(spark, sf).select(ID_COL, col.last_token("Name").alias("LastName"))


_DROP = ["Name", "Cabin", "TravelGroup", "CryoSleep", "VIP", "Side", "TotalSpending", "NotAColumn"]


@register("drop_and_select", with_passengers(
    "SELECT PassengerId, HomePlanet, Destination, Age, RoomService, FoodCourt, ShoppingMall, Spa, VRDeck, Transported, "
    "Deck, CabinNumber, HasSpending, SpendingCategories, round(TotalSpending_Log,6) AS TotalSpending_Log, AgeCategory FROM b",
    base_cte()))
def q_drop_and_select(spark, sf):
    df = col.drop_if_present(base(spark, sf), _DROP)
    return df.withColumn("TotalSpending_Log", r("TotalSpending_Log"))


@register("bool_to_int", with_passengers(
    "SELECT PassengerId, CAST(CryoSleep AS INTEGER) AS CryoSleep, CAST(VIP AS INTEGER) AS VIP, "
    "CAST(Transported AS INTEGER) AS Transported FROM passengers"))
def q_bool_to_int(spark, sf):
    df = passengers(spark, sf).select(ID_COL, "CryoSleep", "VIP", TARGET)
    return col.bool_to_int(df)


_ALIGN = ["Age", "CabinNumber", "Deck_A", "Deck_Z", "Spa", "Room Service"]


@register("align_schema", with_passengers(
    "SELECT PassengerId, Age, CabinNumber, CAST(Deck = 'A' AS INTEGER) AS Deck_A, 0 AS Deck_Z, Spa, "
    "RoomService AS \"Room Service\" FROM b", base_cte()))
def q_align_schema(spark, sf):
    df = base(spark, sf).withColumns({"Deck_A": (F.col("Deck") == "A").cast("int"),
                                      "Room_Service": F.col("RoomService")})
    return col.align_schema(df, _ALIGN, keep=[ID_COL])


@register("select_by_type", with_passengers(
    "SELECT Age, RoomService, FoodCourt, ShoppingMall, Spa, VRDeck FROM passengers"))
def q_select_by_type(spark, sf):
    df = passengers(spark, sf)
    return df.select(*col.select_by_type(df, "numeric"))


# ======================================================================= C
@register("drop_null_age", with_passengers("SELECT * FROM passengers WHERE Age IS NOT NULL"))
def q_drop_null_age(spark, sf):
    return imp.drop_null(passengers(spark, sf), ["Age"])


@register("masked_update", with_passengers(
    "SELECT PassengerId, CASE WHEN coalesce(CryoSleep, false) AND Spa IS NULL THEN 0 ELSE Spa END AS Spa, "
    "CASE WHEN coalesce(Age <= 12, false) THEN 0 ELSE VRDeck END AS VRDeck FROM passengers"))
def q_masked_update(spark, sf):
    df = passengers(spark, sf)
    return df.select(ID_COL,
                     col.masked_update("Spa", F.col("CryoSleep") & F.col("Spa").isNull(), 0.0).alias("Spa"),
                     col.masked_update("VRDeck", F.col("Age") <= 12, 0.0).alias("VRDeck"))


@register("isin_predicate", with_passengers(
    f"SELECT PassengerId, coalesce({DECK} IN ('A','B','C'), false) AS deck_abc, "
    "coalesce(HomePlanet IN ('EUROPE','ASIA'), false) AS planet_in, "
    "NOT coalesce(HomePlanet IN ('EUROPE','ASIA'), false) AS planet_not_in FROM passengers"))
def q_isin(spark, sf):
    df = col.split_cabin(passengers(spark, sf))
    planet_in = col.isin_safe("HomePlanet", ["EUROPE", "ASIA"])
    return df.select(ID_COL, col.isin_safe("Deck", ["A", "B", "C"]).alias("deck_abc"),
                     planet_in.alias("planet_in"), (~planet_in).alias("planet_not_in"))


@register("class_split", with_passengers(
    "SELECT Transported, count(*) AS n, round(avg(Age),6) AS mean_age, round(avg(" + total_sql() + "),6) AS mean_spending "
    "FROM passengers GROUP BY Transported"))
def q_class_split(spark, sf):
    df = passengers(spark, sf)
    return df.groupBy(TARGET).agg(F.count(F.lit(1)).alias("n"), r(F.avg("Age")).alias("mean_age"),
                                  r(F.avg(col.total(SPEND_COLS))).alias("mean_spending"))


# ======================================================================= D
_G = "PARTITION BY TravelGroup"


@register("group_size", with_passengers(
    f"SELECT PassengerId, TravelGroup, count(*) OVER ({_G}) AS GroupSize FROM b", base_cte()))
def q_group_size(spark, sf):
    return grp.group_size(base(spark, sf)).select(ID_COL, "TravelGroup", "GroupSize")


@register("group_mean_rate", with_passengers(
    f"SELECT PassengerId, round(avg({CRYO_INT}) OVER ({_G}),6) AS GroupCryoSleepRate, "
    f"round(avg(TotalSpending) OVER ({_G}),6) AS GroupSpendingMean, "
    f"round(avg(CAST(TotalSpending = 0 AS INTEGER)) OVER ({_G}),6) AS GroupTransportedProxy, "
    f"round(avg(CAST(coalesce(Age < 13, false) AS INTEGER)) OVER ({_G}),6) AS GroupChildRate FROM b", base_cte()))
def q_group_mean_rate(spark, sf):
    df = grp.group_stats(base(spark, sf), "TravelGroup", {
        "GroupCryoSleepRate": F.avg(grp.cryo_int()),
        "GroupSpendingMean": F.avg("TotalSpending"),
        "GroupTransportedProxy": F.avg((F.col("TotalSpending") == 0).cast("int")),
        "GroupChildRate": F.avg(col.flag(F.col("Age") < 13)),
    })
    return df.select(ID_COL, *[r(x).alias(x) for x in
                               ["GroupCryoSleepRate", "GroupSpendingMean", "GroupTransportedProxy", "GroupChildRate"]])


@register("group_all_any", with_passengers(
    f"SELECT PassengerId, min({CRYO_INT}) OVER ({_G}) AS GroupAllCryo, max({CRYO_INT}) OVER ({_G}) AS GroupAnyCryo, "
    f"max(CAST(coalesce(Age < 13, false) AS INTEGER)) OVER ({_G}) AS GroupHasChild FROM b", base_cte()))
def q_group_all_any(spark, sf):
    df = grp.group_stats(base(spark, sf), "TravelGroup", {
        "GroupAllCryo": F.min(grp.cryo_int()), "GroupAnyCryo": F.max(grp.cryo_int()),
        "GroupHasChild": F.max(col.flag(F.col("Age") < 13))})
    return df.select(ID_COL, "GroupAllCryo", "GroupAnyCryo", "GroupHasChild")


@register("group_alignment", with_passengers(
    f"SELECT PassengerId, round(greatest(avg({CRYO_INT}) OVER ({_G}), 1 - avg({CRYO_INT}) OVER ({_G})),6) "
    "AS GroupCryoAlignment FROM b", base_cte()))
def q_group_alignment(spark, sf):
    df = grp.group_stats(base(spark, sf), "TravelGroup", {"__rate": F.avg(grp.cryo_int())})
    return df.select(ID_COL, r(grp.group_alignment(F.col("__rate"))).alias("GroupCryoAlignment"))


@register("group_zscore", with_passengers(
    f"SELECT PassengerId, round((TotalSpending - avg(TotalSpending) OVER ({_G})) / "
    f"(coalesce(stddev_samp(TotalSpending) OVER ({_G}), 0) + 1),6) AS GroupSpendingZScore FROM b", base_cte()))
def q_group_zscore(spark, sf):
    df = grp.group_zscore(base(spark, sf), "TotalSpending")
    return df.select(ID_COL, r("GroupSpendingZScore").alias("GroupSpendingZScore"))


@register("group_dispersion", with_passengers(
    f"SELECT PassengerId, round(coalesce(stddev_samp(Age) OVER ({_G}), 0),6) AS GroupAgeDispersion FROM b",
    base_cte()))
def q_group_dispersion(spark, sf):
    df = grp.group_stats(base(spark, sf), "TravelGroup", {"GroupAgeDispersion": grp.std_or_zero(F.col("Age"))})
    return df.select(ID_COL, r("GroupAgeDispersion").alias("GroupAgeDispersion"))


@register("group_share", with_passengers(
    f"SELECT PassengerId, round(TotalSpending / (sum(TotalSpending) OVER ({_G}) + 1),6) AS SpendShare, "
    f"round(ln(1 + (sum(TotalSpending) OVER ({_G}) - TotalSpending)),6) AS GroupSpendOthers_Log FROM b",
    base_cte()))
def q_group_share(spark, sf):
    df = grp.group_share(base(spark, sf), col.total(SPEND_COLS))
    return df.select(ID_COL, r("SpendShare").alias("SpendShare"), r("GroupSpendOthers_Log").alias("GroupSpendOthers_Log"))


@register("minmax_position", with_passengers(
    "SELECT PassengerId, round(coalesce((CabinNumber - min(CabinNumber) OVER (PARTITION BY Deck)) / "
    "CASE WHEN max(CabinNumber) OVER (PARTITION BY Deck) - min(CabinNumber) OVER (PARTITION BY Deck) = 0 THEN 1 "
    "ELSE max(CabinNumber) OVER (PARTITION BY Deck) - min(CabinNumber) OVER (PARTITION BY Deck) END, 0.5),6) "
    "AS CabinNumber_DeckPercentile FROM b", base_cte()))
def q_minmax_position(spark, sf):
    df = grp.minmax_position(base(spark, sf))
    return df.select(ID_COL, r("CabinNumber_DeckPercentile").alias("CabinNumber_DeckPercentile"))


@register("neighborhood_density", with_passengers(
    "SELECT PassengerId, CAST(count(*) OVER (PARTITION BY Deck ORDER BY CabinNumber RANGE BETWEEN 50 PRECEDING AND "
    "50 FOLLOWING) - 1 AS DOUBLE) AS CabinNeighborhoodDensity FROM b", base_cte()))
def q_neighborhood_density(spark, sf):
    df = grp.neighborhood_density(base(spark, sf))
    return df.select(ID_COL, "CabinNeighborhoodDensity")


@register("name_frequency", with_passengers(
    f"SELECT PassengerId, CAST(CASE WHEN ln IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY ln) END AS INTEGER) "
    f"AS FamilySizeFromName FROM (SELECT *, {LAST} AS ln FROM passengers)"))
def q_name_frequency(spark, sf):
    return grp.name_frequency(passengers(spark, sf)).select(ID_COL, "FamilySizeFromName")


@register("side_spending_diff", with_passengers(
    "SELECT PassengerId, round(abs(coalesce(avg(CASE WHEN Side='P' THEN TotalSpending END) OVER (PARTITION BY CabinNumber),0)"
    " - coalesce(avg(CASE WHEN Side='S' THEN TotalSpending END) OVER (PARTITION BY CabinNumber),0)),6) "
    "AS SideSpendingDiff FROM b", base_cte()))
def q_side_spending_diff(spark, sf):
    df = grp.side_spending_diff(base(spark, sf))
    return df.select(ID_COL, r("SideSpendingDiff").alias("SideSpendingDiff"))


# ======================================================================= E
_E1_SQL = ("SELECT PassengerId, coalesce(HomePlanet,'Unknown') AS HomePlanet, coalesce(Destination,'Unknown') AS Destination, "
           "CASE WHEN CryoSleep THEN 'True' WHEN NOT CryoSleep THEN 'False' ELSE 'Unknown' END AS CryoSleep, "
           "CASE WHEN VIP THEN 'True' WHEN NOT VIP THEN 'False' ELSE 'Unknown' END AS VIP, "
           + ", ".join(f"coalesce({x},0) AS {x}" for x in SPEND) + " FROM passengers")


@register("impute_constant", with_passengers(_E1_SQL))
def q_impute_constant(spark, sf):
    df = imp.impute_constant(passengers(spark, sf), ["HomePlanet", "Destination"], SPEND_COLS)
    return df.select(ID_COL, "HomePlanet", "Destination", imp.tri_state_label("CryoSleep").alias("CryoSleep"),
                     imp.tri_state_label("VIP").alias("VIP"), *SPEND_COLS)


@register("impute_global_median", with_passengers(
    "SELECT PassengerId, coalesce(Age, (SELECT median(Age) FROM passengers)) AS Age FROM passengers"))
def q_impute_global_median(spark, sf):
    return imp.impute_global_median(passengers(spark, sf), "Age").select(ID_COL, "Age")


@register("impute_group_median", with_passengers(
    f"SELECT PassengerId, coalesce(Age, median(Age) OVER ({_G})) AS Age FROM b", base_cte()))
def q_impute_group_median(spark, sf):
    return imp.impute_group_median(base(spark, sf), "Age").select(ID_COL, "Age")


def _e4_sql() -> str:
    parts = []
    for x in SPEND:
        parts.append(f"round(CASE WHEN {x} IS NOT NULL THEN {x} WHEN coalesce(CryoSleep,false) THEN 0 ELSE "
                     f"coalesce(median({x}) OVER ({_G}), (SELECT median({x}) FROM passengers), 0) END,6) AS {x}")
    return "SELECT PassengerId, " + ", ".join(parts) + " FROM b"


@register("impute_spend_group_aware", with_passengers(_e4_sql(), base_cte()))
def q_impute_spend(spark, sf):
    df = imp.impute_spend_group_aware(base(spark, sf), SPEND_COLS)
    return df.select(ID_COL, *[r(x).alias(x) for x in SPEND_COLS])


@register("impute_group_first", with_passengers(
    "SELECT PassengerId, coalesce(HomePlanet, arg_min(HomePlanet, PassengerId) FILTER (WHERE HomePlanet IS NOT NULL) "
    f"OVER ({_G})) AS HomePlanet, CASE WHEN Deck <> 'Unknown' THEN Deck ELSE coalesce(arg_min(Deck, PassengerId) "
    f"FILTER (WHERE Deck <> 'Unknown') OVER ({_G}), 'Unknown') END AS Deck, CASE WHEN Side <> 'Unknown' THEN Side "
    f"ELSE coalesce(arg_min(Side, PassengerId) FILTER (WHERE Side <> 'Unknown') OVER ({_G}), 'Unknown') END AS Side FROM b",
    base_cte()))
def q_impute_group_first(spark, sf):
    df = base(spark, sf)
    df = imp.impute_group_first(df, {"HomePlanet": F.col("HomePlanet").isNotNull()})
    df = imp.impute_group_first(df, {"Deck": F.col("Deck") != "Unknown", "Side": F.col("Side") != "Unknown"},
                                unknown="Unknown")
    return df.select(ID_COL, "HomePlanet", "Deck", "Side")


@register("impute_lookup", with_passengers(
    f"SELECT PassengerId, coalesce(HomePlanet, {FIXTURE_DECK_PLANET.format(d='Deck')}) AS HomePlanet FROM b",
    base_cte()))
def q_impute_lookup(spark, sf):
    return imp.impute_lookup(base(spark, sf), mapping=FIXTURE_DECK_TO_PLANET).select(ID_COL, "HomePlanet")


def _e7_sql() -> str:
    hp = (f"coalesce(HomePlanet, arg_min(HomePlanet, PassengerId) FILTER (WHERE HomePlanet IS NOT NULL) OVER ({_G}), "
          f"{FIXTURE_DECK_PLANET.format(d='Deck')})")
    deck = (f"CASE WHEN Deck <> 'Unknown' THEN Deck ELSE coalesce(arg_min(Deck, PassengerId) FILTER (WHERE Deck <> 'Unknown') "
            f"OVER ({_G}), 'Unknown') END")
    side = (f"CASE WHEN Side <> 'Unknown' THEN Side ELSE coalesce(arg_min(Side, PassengerId) FILTER (WHERE Side <> 'Unknown') "
            f"OVER ({_G}), 'Unknown') END")
    r1 = (f"r1 AS (SELECT PassengerId, TravelGroup, {hp} AS HomePlanet, {deck} AS Deck, {side} AS Side, CryoSleep, Age, "
          + ", ".join(f"CASE WHEN coalesce(CryoSleep,false) AND {x} IS NULL THEN 0 ELSE {x} END AS {x}" for x in SPEND)
          + " FROM b)")
    r2 = ("r2 AS (SELECT * REPLACE (CASE WHEN " + any_pos_sql() + " AND CryoSleep IS NULL THEN false ELSE CryoSleep END "
          "AS CryoSleep) FROM r1)")
    body = ("SELECT PassengerId, HomePlanet, Deck, Side, CryoSleep, "
            + ", ".join(f"CASE WHEN Age IS NOT NULL AND Age <= 12 AND {x} IS NULL THEN 0 ELSE {x} END AS {x}" for x in SPEND)
            + " FROM r2")
    return with_passengers(body, base_cte() + ",\n" + r1 + ",\n" + r2)


@register("apply_domain_rules", _e7_sql())
def q_apply_domain_rules(spark, sf):
    df = imp.apply_domain_rules(base(spark, sf), SPEND_COLS, deck_to_planet=FIXTURE_DECK_TO_PLANET)
    return df.select(ID_COL, "HomePlanet", "Deck", "Side", "CryoSleep", *SPEND_COLS)


# ======================================================================= F
@register("lookup_join", with_passengers(
    "SELECT PassengerId, coalesce(m.rate, -1) AS deck_rate FROM b LEFT JOIN "
    "(SELECT Deck AS k, round(avg(CAST(Transported AS INTEGER)),6) AS rate FROM b WHERE Deck <> 'T' GROUP BY Deck) m "
    "ON b.Deck = m.k", base_cte()))
def q_lookup_join(spark, sf):
    df = base(spark, sf)
    table = (df.where(F.col("Deck") != "T").groupBy("Deck")
             .agg(r(F.avg(F.col(TARGET).cast("int"))).alias("rate")))
    return lk.lookup_join(df, table, "Deck", "rate", "deck_rate", default=-1.0).select(ID_COL, "deck_rate")


@register("left_join_summary", with_passengers(
    "SELECT HomePlanet, count(*) AS count, round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM passengers), 2) AS pct, "
    "round(avg(CAST(Transported AS INTEGER)),4) AS target_rate FROM passengers GROUP BY HomePlanet"))
def q_left_join_summary(spark, sf):
    from lathe.operators.profile import category_summary
    return category_summary(passengers(spark, sf), "HomePlanet", TARGET)


@register("semi_join_flag", with_passengers(
    "SELECT PassengerId, CASE WHEN HomePlanet IS NULL AND TravelGroup IN (SELECT TravelGroup FROM b WHERE HomePlanet "
    "IS NOT NULL) THEN 1 ELSE 0 END AS hp_resolvable FROM b", base_cte()))
def q_semi_join_flag(spark, sf):
    df = base(spark, sf)
    known = df.where(F.col("HomePlanet").isNotNull())
    flagged = lk.semi_join_flag(df, known, "TravelGroup", "__in")
    return flagged.select(ID_COL, F.when(F.col("HomePlanet").isNull(), F.col("__in")).otherwise(F.lit(0))
                          .alias("hp_resolvable"))


@register("id_align_join", with_passengers(
    f"SELECT t.PassengerId, CAST(t.Transported AS INTEGER) AS y_true, s.score FROM passengers t JOIN "
    f"(SELECT PassengerId, cast((cast(split_part(PassengerId,'_',2) AS bigint)%1000*7919)%1000 AS double)/1000 AS score "
    f"FROM passengers WHERE Age IS NOT NULL) s ON t.PassengerId = s.PassengerId"))
def q_id_align(spark, sf):
    from lathe.sources.fixtures import with_score
    df = passengers(spark, sf)
    truth = df.select(ID_COL, F.col(TARGET).cast("int").alias("y_true"))
    scores = with_score(df.where(F.col("Age").isNotNull())).select(ID_COL, "score")
    return lk.id_align(truth, scores, ID_COL)
