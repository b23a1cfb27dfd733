"""Group-context operators (D*): an aggregate per group broadcast back to rows.

Pattern: ``groupBy(key).agg(...)`` (partial + final aggregation, so a hot
group is pre-combined map-side and never collected into one task) followed
by one left join back on the key (``lookup.join_back``). All statistics of one
key share one aggregate and one join; both join sides have their own shuffle,
so AQE's skew-join can split a hot key on the row side.
Keys with few, huge groups (deck, side) use a size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.functions.columns import c, last_token
from lathe.operators.lookup import join_back, join_small


def group_stats(df: DataFrame, key: str | list[str], aggs: dict[str, Column]) -> DataFrame:
    """Generic D: compute ``aggs`` per key in one aggregate and join them back."""
    keys = [key] if isinstance(key, str) else list(key)
    clash = [n for n in aggs if n in df.columns]
    base = df.drop(*clash) if clash else df
    stats = df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])
    return join_back(base, stats, keys)


def cryo_int(col: str = "CryoSleep") -> Column:
    """True -> 1, anything else (False, unknown, null) -> 0."""
    return F.coalesce(c(col), F.lit(False)).cast("int")


# ------------------------------------------------------------------ D1-D7
def group_size(df: DataFrame, key: str = "TravelGroup", out: str = "GroupSize") -> DataFrame:
    """Members per group (recompute it after any row drop)."""
    return group_stats(df, key, {out: F.count(F.lit(1))})


def group_mean(expr: Column) -> Column:
    """Group mean of a per-row expression (null rows ignored)."""
    return F.avg(expr)


def group_alignment(rate: Column) -> Column:
    """Consensus level ``max(r, 1 - r)``."""
    return F.greatest(rate, F.lit(1.0) - rate)


def std_or_zero(x: Column) -> Column:
    """ddof=1 standard deviation, single member (null) -> 0."""
    return F.coalesce(F.stddev_samp(x), F.lit(0.0))


def group_zscore(df: DataFrame, value: str, key: str = "TravelGroup", out: str = "GroupSpendingZScore") -> DataFrame:
    """(x - mean) / (std_ddof1 + 1), std null -> 0."""
    tmp = group_stats(df, key, {"__zs_mean": F.avg(c(value)), "__zs_std": std_or_zero(c(value))})
    return (tmp.withColumn(out, (c(value) - F.col("__zs_mean")) / (F.col("__zs_std") + F.lit(1.0)))
            .drop("__zs_mean", "__zs_std"))


def group_share(df: DataFrame, value: Column, key: str = "TravelGroup", share: str = "SpendShare",
                others_log: str = "GroupSpendOthers_Log") -> DataFrame:
    """X / (group_sum + 1) and log1p(group_sum - x)."""
    tmp = df.withColumn("__gs_x", value)
    tmp = group_stats(tmp, key, {"__gs_sum": F.sum("__gs_x")})
    return (tmp.withColumns({
        share: F.col("__gs_x") / (F.col("__gs_sum") + F.lit(1.0)),
        others_log: F.log1p(F.greatest(F.col("__gs_sum") - F.col("__gs_x"), F.lit(0.0))),
    }).drop("__gs_x", "__gs_sum"))


# ------------------------------------------------------------------ D8
def minmax_position(df: DataFrame, value: str = "CabinNumber", key: str = "Deck",
                    out: str = "CabinNumber_DeckPercentile", missing: float = 0.5,
                    max_groups: int = 100_000) -> DataFrame:
    """(x - min) / (max - min) within the key; span 0 -> 1; null -> ``missing``.

    Few keys hold many rows, so no window on the key: a groupBy gives one row
    per key and that table is broadcast after its size was checked.
    """
    rng = df.groupBy(key).agg(F.min(c(value)).alias("__mm_lo"), F.max(c(value)).alias("__mm_hi"))
    joined = join_small(df, rng, on=key, how="left", max_rows=max_groups)
    span = F.col("__mm_hi") - F.col("__mm_lo")
    span = F.when(span == 0, F.lit(1)).otherwise(span)
    pos = (c(value) - F.col("__mm_lo")) / span
    return joined.withColumn(out, F.coalesce(pos.cast("double"), F.lit(missing))).drop("__mm_lo", "__mm_hi")


# ------------------------------------------------------------------ D9
def neighborhood_density(df: DataFrame, key: str = "Deck", position: str = "CabinNumber",
                         radius: int = 50, out: str = "CabinNeighborhoodDensity") -> DataFrame:
    """Number of *other* rows with the same key and ``|position diff| <= radius``.

    Exact, and never O(n^2): rows are first counted per distinct
    ``(key, position)`` cell; positions are integers, so a block of width
    ``radius`` holds at most ``radius`` cells and every cell meets at most
    ``3 * radius`` partner cells (blocks b-1, b, b+1). The partner join is on
    ``(key, block)``, so a key with many rows is spread over its blocks.
    """
    cells = (df.groupBy(key, position).agg(F.count(F.lit(1)).alias("__nd_n"))
             .where(F.col(position).isNotNull()))
    blk = F.floor(F.col(position) / F.lit(radius))
    build = cells.select(F.col(key), blk.alias("__nd_blk"), F.col(position).alias("__nd_pos"), "__nd_n")
    probe = cells.select(F.col(key), F.col(position),
                         F.explode(F.array(blk - 1, blk, blk + 1)).alias("__nd_blk"))
    dens = (probe.join(build, on=[key, "__nd_blk"])
            .where(F.abs(F.col(position) - F.col("__nd_pos")) <= radius)
            .groupBy(key, position)
            .agg((F.sum("__nd_n") - 1).cast("double").alias(out)))
    base = df.drop(out) if out in df.columns else df
    # rows whose key or position is null have no neighbours by this rule
    return join_back(base, dens, [key, position]).withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))


# ------------------------------------------------------------------ D10
def name_frequency(df: DataFrame, name_col: str = "Name", out: str = "FamilySizeFromName") -> DataFrame:
    """Rows sharing the last name token; null name -> 1."""
    tmp = df.withColumn("__nf_last", last_token(name_col))
    counts = (tmp.where(F.col("__nf_last").isNotNull())
              .groupBy("__nf_last").agg(F.count(F.lit(1)).alias("__nf_n")))
    return (join_back(tmp, counts, ["__nf_last"])
            .withColumn(out, F.coalesce(F.col("__nf_n"), F.lit(1)).cast("int"))
            .drop("__nf_last", "__nf_n"))


# ------------------------------------------------------------------ D11
def side_spending_diff(df: DataFrame, key: str = "CabinNumber", side: str = "Side",
                       value: str = "TotalSpending", sides: tuple[str, str] = ("P", "S"),
                       out: str = "SideSpendingDiff") -> DataFrame:
    """|mean value on side A - mean value on side B| per key; a side with no rows -> 0."""
    a, b = sides
    stats = df.groupBy(key).agg(
        F.avg(F.when(c(side) == a, c(value))).alias("__sd_a"),
        F.avg(F.when(c(side) == b, c(value))).alias("__sd_b"))
    return (join_back(df, stats, [key])
            .withColumn(out, F.abs(F.coalesce(F.col("__sd_a"), F.lit(0.0)) - F.coalesce(F.col("__sd_b"), F.lit(0.0))))
            .drop("__sd_a", "__sd_b"))
