"""Joins (F*) and the size-checked broadcast used for small fit tables.

Rule: a side is broadcast only after its row count was checked against a
bound; beyond the bound the same join runs as a shuffle join (AQE may still
split skewed partitions of the big side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bound (rows) for a table we are willing to ship to every executor.
DEFAULT_BROADCAST_ROWS = 100_000


def bounded_table(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame | None:
    """Materialise ``df`` as a local table if it has at most ``max_rows`` rows.

    Reads at most ``max_rows + 1`` rows, so the driver never holds more than
    the bound. Returns ``None`` when the table is larger.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join a (probably) small table: broadcast when its size is proven, shuffle otherwise."""
    local = bounded_table(small, max_rows)
    if local is not None:
        return big.join(F.broadcast(local), on=on, how=how)
    return big.join(small, on=on, how=how)


def lookup_join(df: DataFrame, table: DataFrame, key: str, value: str, out: str,
                default=None, table_key: str | None = None,
                max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``Series.map(mapping)`` with a default for unmatched keys."""
    tk = table_key or key
    t = table.select(F.col(tk).alias("__lk_key"), F.col(value).alias("__lk_val"))
    joined = join_small(df, t, on=F.col(key) == F.col("__lk_key"), how="left", max_rows=max_rows)
    val = F.col("__lk_val") if default is None else F.coalesce(F.col("__lk_val"), F.lit(default))
    return joined.withColumn(out, val).drop("__lk_key", "__lk_val")


def mapping_expr(col: str | Column, mapping: dict, default=None) -> Column:
    """Literal lookup for a tiny fixed mapping (a ``when`` chain, no join)."""
    x = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == k, F.lit(v)) if expr is None else expr.when(x == k, F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def join_back(df: DataFrame, stats: DataFrame, on: list[str]) -> DataFrame:
    """Left join of rows with a table of one row per key that was aggregated by that key.

    The aggregate is already partitioned by the key, so a plain join would put no
    shuffle above it and AQE could not split a hot key's rows. Its keys go through
    an expression that keeps their value and hides the partitioning: both sides
    then have a shuffle of their own.
    """
    kinds = dict(stats.dtypes)
    keys = []
    for k in on:
        x = F.col(k)
        if kinds[k] == "string":
            x = F.concat(x, F.lit(""))
        elif kinds[k] in ("tinyint", "smallint", "int", "bigint", "float", "double"):
            x = (x + F.lit(0)).cast(kinds[k])
        keys.append(x.alias(k))
    values = [F.col(k) for k in stats.columns if k not in on]
    return df.join(stats.select(*keys, *values), on=on, how="left")


def semi_join_flag(df: DataFrame, known: DataFrame, key: str, out: str,
                   known_key: str | None = None) -> DataFrame:
    """1 if ``key`` occurs in ``known`` (``isin(index)``), else 0; null key -> 0."""
    kk = known_key or key
    keys = known.select(F.col(kk).alias("__sj_key")).where(F.col("__sj_key").isNotNull()).distinct() \
        .withColumn("__sj_hit", F.lit(1))
    return (join_back(df, keys.withColumnRenamed("__sj_key", key), [key])
            .withColumn(out, F.coalesce(F.col("__sj_hit"), F.lit(0)))
            .drop("__sj_hit"))


def id_align(left: DataFrame, right: DataFrame, id_col: str) -> DataFrame:
    """explicit id equi-join instead of positional alignment."""
    return left.join(right, on=id_col, how="inner")


def join_scores(tables: dict[str, DataFrame], id_col: str, score_col: str) -> DataFrame:
    """K per-model score tables side by side (inner join on id)."""
    out = None
    for name, t in tables.items():
        s = t.select(id_col, F.col(score_col).alias(name))
        out = s if out is None else out.join(s, on=id_col, how="inner")
    return out
