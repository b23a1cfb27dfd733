"""Sources and sinks (A1-A5).

Readers take an explicit schema where one is known; writers keep the output
partitioned (no ``coalesce(1)``) and always overwrite atomically per path.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lathe.functions.columns import nan_to_null

# Raw entity schema (reference input table, 14 columns).
ENTITY_SCHEMA = T.StructType([
    T.StructField("PassengerId", T.StringType(), False),
    T.StructField("HomePlanet", T.StringType()),
    T.StructField("CryoSleep", T.BooleanType()),
    T.StructField("Cabin", T.StringType()),
    T.StructField("Destination", T.StringType()),
    T.StructField("Age", T.DoubleType()),
    T.StructField("VIP", T.BooleanType()),
    T.StructField("RoomService", T.DoubleType()),
    T.StructField("FoodCourt", T.DoubleType()),
    T.StructField("ShoppingMall", T.DoubleType()),
    T.StructField("Spa", T.DoubleType()),
    T.StructField("VRDeck", T.DoubleType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Transported", T.BooleanType()),
])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_entities(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType | None = ENTITY_SCHEMA, with_target: bool = True) -> DataFrame:
    """A1: read the raw entity table; CSV uses a declared schema and '' -> null; NaN -> null (T5)."""
    if fmt == "csv":
        sch = schema
        if sch is not None and not with_target:
            sch = T.StructType([f for f in sch.fields if f.name != "Transported"])
        reader = spark.read.option("header", True).option("nullValue", "").option("emptyValue", None)
        df = reader.schema(sch).csv(path) if sch is not None else reader.option("inferSchema", True).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return nan_to_null(df)


def write_features(df: DataFrame, root: str, feature_set: str, kind: str) -> str:
    """A2: persist a feature table under ``root/feature_set=<fs>/kind=<raw|scaled>``."""
    path = f"{root.rstrip('/')}/feature_set={feature_set}/kind={kind}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_features(spark: SparkSession, root: str, feature_set: str, kind: str = "scaled",
                  columns: list[str] | None = None) -> DataFrame:
    """A3: reload one feature table. Raw and scaled tables differ in column types,
    so the single partition folder is read directly (no schema merge across kinds);
    ``columns`` prunes the Parquet scan to the selected columns."""
    df = spark.read.parquet(f"{root.rstrip('/')}/feature_set={feature_set}/kind={kind}")
    return df.select(*[f"`{x}`" for x in columns]) if columns else df


def write_predictions(df: DataFrame, path: str, id_col: str = "PassengerId",
                      pred_col: str = "Transported", fmt: str = "csv") -> str:
    """A4: ``(id, bool prediction)`` per row, partitioned output with a header."""
    out = df.select(id_col, df[pred_col].cast("boolean").alias(pred_col))
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def save_fit_state(state: dict[str, DataFrame], meta: dict, root: str, spark: SparkSession | None = None) -> str:
    """A5: fitted state = small Parquet fit tables + one JSON metadata row."""
    root = root.rstrip("/")
    for name, table in state.items():
        table.write.mode("overwrite").parquet(f"{root}/{name}")
    spark = spark or (next(iter(state.values())).sparkSession if state else SparkSession.active())
    spark.createDataFrame([(json.dumps(meta),)], "meta string") \
        .coalesce(1).write.mode("overwrite").text(f"{root}/_meta")
    return root


def load_fit_state(spark: SparkSession, root: str, names: list[str]) -> tuple[dict[str, DataFrame], dict]:
    root = root.rstrip("/")
    tables = {n: spark.read.parquet(f"{root}/{n}") for n in names}
    meta_row = spark.read.text(f"{root}/_meta").first()
    return tables, json.loads(meta_row[0]) if meta_row else {}
