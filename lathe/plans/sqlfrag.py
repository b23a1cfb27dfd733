"""SQL fragments for the DuckDB oracle (independent re-statement of each operator).

These strings are test-side: they let DuckDB compute the same results from
the same Parquet tables, so the Spark plans can be checked value by value.
"""

from __future__ import annotations

from lathe.sources.fixtures import SPEND_COLS

SPEND = SPEND_COLS


def total_sql(cols=SPEND) -> str:
    return "(" + " + ".join(f"coalesce({x},0)" for x in cols) + ")"


def cats_sql(cols=SPEND) -> str:
    return "(" + " + ".join(f"CAST(coalesce({x},0) > 0 AS INTEGER)" for x in cols) + ")"


def any_pos_sql(cols=SPEND) -> str:
    return "(" + " OR ".join(f"coalesce({x},0) > 0" for x in cols) + ")"


DECK = "coalesce(split_part(Cabin,'/',1),'Unknown')"
SIDE = "coalesce(split_part(Cabin,'/',3),'Unknown')"
CABNUM = "CASE WHEN Cabin IS NULL THEN 0 ELSE TRY_CAST(split_part(Cabin,'/',2) AS INTEGER) END"
CABNUM_EDA = "TRY_CAST(split_part(Cabin,'/',2) AS INTEGER)"
GROUP = "split_part(PassengerId,'_',1)"
AGECAT = ("CASE WHEN Age IS NULL THEN 'Unknown' WHEN Age < 13 THEN 'Child' WHEN Age < 18 THEN 'Teen' "
          "WHEN Age < 30 THEN 'YoungAdult' WHEN Age < 60 THEN 'Adult' ELSE 'Senior' END")
LAST = "nullif(regexp_extract(Name, '(\\S+)\\s*$', 1), '')"
CRYO_INT = "CAST(coalesce(CryoSleep, false) AS INTEGER)"
CRYO_ENC = "CASE WHEN CryoSleep THEN 1 WHEN NOT CryoSleep THEN 0 ELSE -1 END"
SIDE_ENC = "CASE WHEN {s}='P' THEN 0 WHEN {s}='S' THEN 1 ELSE -1 END"
# Fixture binding of the deck -> planet rule (region names stand in for planets).
FIXTURE_DECK_PLANET = "CASE WHEN {d} IN ('A','B','C') THEN 'EUROPE' WHEN {d}='G' THEN 'AMERICA' END"


def base_cte(name: str = "b", src: str = "passengers") -> str:
    """Columns of the first steps of every row pipeline: B1, B2, B3, B5."""
    return f"""{name} AS (
 SELECT *, {DECK} AS Deck, {CABNUM} AS CabinNumber, {SIDE} AS Side, {GROUP} AS TravelGroup,
  {total_sql()} AS TotalSpending, CAST({total_sql()} > 0 AS INTEGER) AS HasSpending,
  {cats_sql()} AS SpendingCategories, ln(1 + {total_sql()}) AS TotalSpending_Log,
  {AGECAT} AS AgeCategory
 FROM {src})"""
