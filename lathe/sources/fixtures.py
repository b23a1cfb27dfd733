"""Input binding: derive an entity ("passengers") table from the TPC-H-ish tables.

The shipped tables hold no passenger table and no nulls, so the entity table
is derived: one row per order, the travel group is customer x 4 buckets,
five spend columns come from line items per part type, and nulls are injected
deterministically. The same definition exists as SQL text (``PASSENGERS_SQL``)
that DuckDB runs for the oracle; the Spark version below is DataFrame API.

Scale notes: lineitem -> part is a shuffle join (both sides grow with the
data), the spend aggregate is partial+final on ``l_orderkey`` and the left
join to orders reuses that partitioning. ``nation`` (25 rows) and ``region``
(5 rows) have a fixed size by the TPC-H definition, so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.functions.columns import rnd

from lathe.sources.io import read_table

# Fixed values of the fixture definition: part types that become the five
# spend columns (in column order) and the spend column names.
SPEND_PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
SPEND_COLS = ["RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck"]
# null injection: column -> (modulus, remainder) on o_orderkey
NULL_RULES = {
    "HomePlanet": (47, 3), "CryoSleep": (43, 4), "Cabin": (53, 7),
    "Destination": (59, 9), "Age": (41, 5), "VIP": (61, 2),
    "RoomService": (31, 1), "FoodCourt": (37, 1), "ShoppingMall": (29, 1),
    "Spa": (67, 1), "VRDeck": (71, 1), "Name": (73, 1),
}
# Digits of either id part: wider than any 64-bit number, so padding never cuts one.
ID_WIDTH = 20
DECK_LETTERS = "ABCDEFGT"

ID_COL = "PassengerId"
TARGET = "Transported"


def _null_unless(key: Column, col: str, value: Column) -> Column:
    m, r = NULL_RULES[col]
    return F.when(key % m == r, F.lit(None)).otherwise(value)


_ENTITY_PATHS: dict[tuple[int, str], str] = {}


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity table, derived once per session and stored as Parquet.

    In a deployment the entity table is a stored table; here it is derived
    from the TPC-H tables (``derive_passengers``) and written once into the
    session's checkpoint folder (a shared folder on a cluster). Every key then
    scans it with column pruning and filter pushdown.
    """
    from lathe.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    path = _ENTITY_PATHS.get(key)
    if path is None:
        path = scratch_path(spark, "passengers")
        derive_passengers(spark, sf_dir).write.mode("overwrite").parquet(path)
        _ENTITY_PATHS[key] = path
    return spark.read.parquet(path)


def derive_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity table with the raw 14-column schema of the reference input."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    spend_aggs = [
        F.sum(F.when(F.col("p_type") == t, F.col("l_extendedprice")).otherwise(F.lit(0.0))).alias(f"s{i + 1}")
        for i, t in enumerate(SPEND_PART_TYPES)
    ]
    spend = (li.join(part, li.l_partkey == part.p_partkey)
             .groupBy("l_orderkey")
             .agg(*spend_aggs, F.min("p_name").alias("nm")))

    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    customer = (read_table(spark, sf_dir, "customer")
                .select("c_custkey", "c_nationkey", "c_mktsegment")
                .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
                .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")

    base = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(spend, F.col("o_orderkey") == F.col("l_orderkey"), "left"))

    k = F.col("o_orderkey")
    c = F.col("o_custkey")
    finished = F.col("o_orderstatus") == "F"
    pid = F.concat(F.lpad((c * 4 + k % 4).cast("string"), ID_WIDTH, "0"), F.lit("_"),
                   F.lpad(k.cast("string"), ID_WIDTH, "0"))
    cabin = F.concat(F.substring(F.lit(DECK_LETTERS), (F.lit(1) + c % 8).cast("int"), F.lit(1)),
                     F.lit("/"), (k % 1900).cast("string"), F.lit("/"),
                     F.when(k % 2 == 0, F.lit("P")).otherwise(F.lit("S")))
    cols = [
        pid.alias("PassengerId"),
        _null_unless(k, "HomePlanet", F.col("r_name")).alias("HomePlanet"),
        _null_unless(k, "CryoSleep", finished).alias("CryoSleep"),
        _null_unless(k, "Cabin", cabin).alias("Cabin"),
        _null_unless(k, "Destination", F.col("o_orderpriority")).alias("Destination"),
        _null_unless(k, "Age", ((k % 80 * 37) % 80).cast("double")).alias("Age"),
        _null_unless(k, "VIP", F.col("c_mktsegment") == "BUILDING").alias("VIP"),
    ]
    for i, name in enumerate(SPEND_COLS):
        amount = F.when(finished, F.lit(0.0)).otherwise(rnd(F.coalesce(F.col(f"s{i + 1}"), F.lit(0.0)), 2))
        cols.append(_null_unless(k, name, amount).alias(name))
    cols.append(_null_unless(k, "Name", F.col("nm")).alias("Name"))
    cols.append((finished != (k % 5 == 0)).alias(TARGET))
    return base.select(*cols)


def with_score(df: DataFrame, id_col: str = ID_COL, name: str = "score") -> DataFrame:
    """Deterministic probability column used by score-based keys (no model needed)."""
    order_no = F.split_part(F.col(id_col), F.lit("_"), F.lit(2)).cast("bigint")
    return df.withColumn(name, ((order_no % 1000 * 7919) % 1000).cast("double") / 1000.0)


# ---------------------------------------------------------------------------
# Same fixture as SQL text (DuckDB oracle side). Kept verbatim from FIXTURES.md.
# ---------------------------------------------------------------------------
PASSENGERS_CTE = """WITH spend AS (
 SELECT l_orderkey,
  SUM(CASE WHEN p_type='ECONOMY' THEN l_extendedprice ELSE 0 END) s1,
  SUM(CASE WHEN p_type='LARGE' THEN l_extendedprice ELSE 0 END) s2,
  SUM(CASE WHEN p_type='MEDIUM' THEN l_extendedprice ELSE 0 END) s3,
  SUM(CASE WHEN p_type='PROMO' THEN l_extendedprice ELSE 0 END) s4,
  SUM(CASE WHEN p_type='SMALL' THEN l_extendedprice ELSE 0 END) s5,
  MIN(p_name) AS nm
 FROM lineitem JOIN part ON l_partkey=p_partkey GROUP BY l_orderkey),
passengers AS (
SELECT concat(lpad(cast(o_custkey*4 + o_orderkey%4 AS varchar(20)),20,'0'),'_',lpad(cast(o_orderkey AS varchar(20)),20,'0')) AS PassengerId,
 CASE WHEN o_orderkey%47=3 THEN NULL ELSE r_name END AS HomePlanet,
 CASE WHEN o_orderkey%43=4 THEN NULL WHEN o_orderstatus='F' THEN true ELSE false END AS CryoSleep,
 CASE WHEN o_orderkey%53=7 THEN NULL ELSE concat(substr('ABCDEFGT',cast(1+o_custkey%8 AS int),1),'/',cast(o_orderkey%1900 AS varchar(20)),'/',CASE WHEN o_orderkey%2=0 THEN 'P' ELSE 'S' END) END AS Cabin,
 CASE WHEN o_orderkey%59=9 THEN NULL ELSE o_orderpriority END AS Destination,
 CASE WHEN o_orderkey%41=5 THEN NULL ELSE cast((o_orderkey*37)%80 AS double) END AS Age,
 CASE WHEN o_orderkey%61=2 THEN NULL ELSE c_mktsegment='BUILDING' END AS VIP,
 CASE WHEN o_orderkey%31=1 THEN NULL ELSE CASE WHEN o_orderstatus='F' THEN 0 ELSE round(coalesce(s1,0),2) END END AS RoomService,
 CASE WHEN o_orderkey%37=1 THEN NULL ELSE CASE WHEN o_orderstatus='F' THEN 0 ELSE round(coalesce(s2,0),2) END END AS FoodCourt,
 CASE WHEN o_orderkey%29=1 THEN NULL ELSE CASE WHEN o_orderstatus='F' THEN 0 ELSE round(coalesce(s3,0),2) END END AS ShoppingMall,
 CASE WHEN o_orderkey%67=1 THEN NULL ELSE CASE WHEN o_orderstatus='F' THEN 0 ELSE round(coalesce(s4,0),2) END END AS Spa,
 CASE WHEN o_orderkey%71=1 THEN NULL ELSE CASE WHEN o_orderstatus='F' THEN 0 ELSE round(coalesce(s5,0),2) END END AS VRDeck,
 CASE WHEN o_orderkey%73=1 THEN NULL ELSE nm END AS Name,
 (o_orderstatus='F') <> (o_orderkey%5=0) AS Transported
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey
LEFT JOIN spend ON o_orderkey=l_orderkey)"""

SCORE_SQL = "cast((cast(split_part(PassengerId,'_',2) AS bigint)%1000*7919)%1000 AS double)/1000"
