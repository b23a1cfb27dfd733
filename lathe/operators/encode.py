"""Fitted encoders (H1-H4) with a clean fit / transform split.

Fit steps run small aggregates and keep their result as fit tables
(category statistics) or literals (means, standard deviations). Transform
steps are projections plus, for target encoding, one join to the fit table,
broadcast only when its size was checked.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.functions.columns import c
from lathe.operators.lookup import DEFAULT_BROADCAST_ROWS, bounded_table, join_small
from lathe.operators.ranks import exclusive_prefix

# sklearn-compatible "zero variance" threshold (10 * float64 machine epsilon)
ZERO_SCALE = 10 * 2.220446049250313e-16


# ------------------------------------------------------------------ category statistics
def category_stats(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """One pass over ``df`` for many columns: (column, value, target mean, n).

    Values are compared as strings so several columns share one table; null
    categories are dropped (as a pandas groupby does).
    """
    y = c(target).cast("double")
    items = [F.struct(F.lit(x).alias("column"), c(x).cast("string").alias("value")) for x in cols]
    long = df.select(y.alias("__y"), F.inline(F.array(*items))).where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.avg("__y").alias("mean"), F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ H1/H2 target encoding
@dataclass
class TargetEncoding:
    """Fitted target encoder for one column: category -> mean(target)."""
    column: str
    table: DataFrame            # (value string, mean double); local when small
    default: float | None       # unweighted mean of the category means (unseen categories)
    local: bool = False

    def apply(self, df: DataFrame, out: str | None = None, fill_unseen: bool = True) -> DataFrame:
        out = out or f"{self.column}_TE"
        t = self.table.select(F.col("value").alias("__te_v"), F.col("mean").alias("__te_m"))
        t = F.broadcast(t) if self.local else t
        j = df.join(t, c(self.column).cast("string") == F.col("__te_v"), "left")
        val = F.col("__te_m")
        if fill_unseen and self.default is not None:
            val = F.coalesce(val, F.lit(self.default))
        return j.withColumn(out, val).drop("__te_v", "__te_m")


def fit_target_encoding(stats: DataFrame, column: str,
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> TargetEncoding:
    t = stats.where(F.col("column") == column).select("value", "mean")
    default_row = t.agg(F.avg("mean").alias("d")).first()
    default = None if default_row is None or default_row["d"] is None else float(default_row["d"])
    local = bounded_table(t, max_broadcast_rows)
    if local is not None:
        return TargetEncoding(column, local, default, local=True)
    return TargetEncoding(column, t, default, local=False)


def target_encode_fit(df: DataFrame, column: str, target: str) -> TargetEncoding:
    """H1: category -> mean(target) on the full table, no smoothing, no folds."""
    return fit_target_encoding(category_stats(df, [column], target), column)


def _category(column: str) -> Column:
    """The category as a key; null is one of its own."""
    return F.coalesce(F.concat(F.lit("="), c(column).cast("string")), F.lit("null"))


def target_encode_out_of_fold(df: DataFrame, column: str, target: str, fold: str, out: str | None = None,
                              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """H1 without leakage: each row gets its category's target mean over the rows of all other folds.

    One aggregate by (category, fold); a row is encoded by the category's sums less its own fold's. A null
    category, and one that only the row's own fold has, gets the other folds' overall mean. Rows with a null
    target count nowhere and are encoded all the same."""
    y = c(target).cast("double")
    cells = (df.select(_category(column).alias("__k"), c(fold).cast("int").alias("__f"), y.alias("__y")).where(F.col("__y").isNotNull())
             .groupBy("__k", "__f").agg(F.sum("__y").alias("s"), F.count("*").alias("n")))
    folds = {r["__f"]: (r["s"], r["n"]) for r in cells.groupBy("__f").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}   # a row per fold
    all_s, all_n = (sum(x[i] for x in folds.values()) for i in (0, 1))
    own = [(F.col("__f").eqNullSafe(F.lit(f)), s, n) for f, (s, n) in folds.items()]
    rest = [F.lit(float(all_s)), F.lit(float(all_n))]
    for is_own, s, n in own:
        rest = [F.when(is_own, all_s - s).otherwise(rest[0]), F.when(is_own, float(all_n - n)).otherwise(rest[1])]
    fallback = F.try_divide(rest[0], rest[1])
    totals = cells.where(F.col("__k") != "null").groupBy("__k").agg(
        F.sum("s").alias("__s"), F.sum("n").alias("__n"), F.map_from_entries(F.collect_list(F.struct(F.coalesce("__f", F.lit(-1)), F.struct("s", "n")))).alias("__by"))
    rows = df.withColumns({"__k": _category(column), "__f": c(fold).cast("int")})
    mine = F.try_element_at("__by", F.coalesce("__f", F.lit(-1)))
    s, n = F.col("__s") - F.coalesce(mine["s"], F.lit(0.0)), F.col("__n") - F.coalesce(mine["n"], F.lit(0))
    joined = join_small(rows, totals, on="__k", how="left", max_rows=max_broadcast_rows)
    return joined.withColumn(out or f"{column}_TE", F.when(n > 0, s / n).otherwise(fallback)).drop("__k", "__f", "__s", "__n", "__by")


def ordered_target_statistics(df: DataFrame, column: str, target: str, order: Column, id_col: str, out: str | None = None,
                              prior: float = 0.5, weight: float = 1.0) -> DataFrame:
    """Category statistics from earlier rows only: (sum of earlier targets + weight * prior) / (earlier rows + weight).

    "Earlier" is by ``order`` (a hash of the id stands for a random permutation), then id, among rows of the same
    category; so no row's own target, nor a later one, reaches its statistic. Prefix sums are range-partitioned
    (``ranks.exclusive_prefix``): a category of any size is spread over its ranges. Null is a category; a null
    target counts as absent."""
    y = c(target).cast("double")
    rows = df.withColumns({"__k": _category(column), "__ord": order.cast("double"), "__y": F.coalesce(y, F.lit(0.0)),
                           "__one": F.when(y.isNotNull(), 1).otherwise(0)})
    ranked = exclusive_prefix(rows, ["__k"], "__ord", ["__y", "__one"], suffix="_earlier", tiebreak=[id_col])
    value = (F.col("__y_earlier") + weight * prior) / (F.col("__one_earlier") + weight)
    return ranked.withColumn(out or f"{column}_OTS", value).drop("__k", "__ord", "__y", "__one", "__y_earlier", "__one_earlier")


# ------------------------------------------------------------------ H3 one-hot
def one_hot_fit(stats: DataFrame, columns: list[str], max_values: int = 1000) -> dict[str, list[str]]:
    """Sorted distinct values per column, size-checked (one small collect)."""
    t = bounded_table(stats.where(F.col("column").isin(columns)).select("column", "value"),
                      max_values * max(1, len(columns)))
    if t is None:
        raise ValueError(f"one-hot: more than {max_values} categories per column; use target encoding")
    out: dict[str, list[str]] = {x: [] for x in columns}
    for r in t.collect():
        out[r["column"]].append(r["value"])
    return {k: sorted(v) for k, v in out.items()}


def one_hot_apply(df: DataFrame, values: dict[str, list[str]], drop_source: bool = True) -> DataFrame:
    """``get_dummies(drop_first=False)``: ``<col>_<value>`` INT columns, null -> all 0."""
    new = {}
    for col, vals in values.items():
        for v in vals:
            new[f"{col}_{v}"] = F.coalesce((c(col).cast("string") == F.lit(v)), F.lit(False)).cast("int")
    out = df.withColumns(new) if new else df
    return out.drop(*values.keys()) if drop_source else out


# ------------------------------------------------------------------ H4 standard scaling
@dataclass
class Scaler:
    """Population-std scaler (sklearn ``StandardScaler`` semantics); std 0 -> 1."""
    stats: dict[str, tuple[float | None, float]] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        upd = {}
        for x, (mean, scale) in self.stats.items():
            if x in df.columns and mean is not None:
                upd[x] = (c(x).cast("double") - F.lit(mean)) / F.lit(scale)
        return df.withColumns(upd) if upd else df


def standard_scale_fit(df: DataFrame, cols: list[str]) -> Scaler:
    """One aggregate: mean and population std of every column (2 literals per column)."""
    if not cols:
        return Scaler({})
    row = df.agg(*[F.avg(c(x).cast("double")).alias(f"m{i}") for i, x in enumerate(cols)],
                 *[F.stddev_pop(c(x).cast("double")).alias(f"s{i}") for i, x in enumerate(cols)]).first()
    stats = {}
    for i, x in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        scale = 1.0 if s is None or s < ZERO_SCALE else float(s)
        stats[x] = (None if m is None else float(m), scale)
    return Scaler(stats)
