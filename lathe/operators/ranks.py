"""Ordered statistics without a single-task window.

``exclusive_prefix`` computes, for every row of a table with one row per
distinct ``(part, order)`` value, the sum of ``values`` over all rows of the
same part that sort before it. The order axis is cut into buckets at
approximate quantiles of the data (a deterministic function of the values,
not of the physical partitioning), bucket totals give the offsets, and a
window runs only inside one ``(part, bucket)``. The bucket count grows with the
largest part (about two million rows per bucket), so no task holds more than
a bounded slice of a part; a row finds its bucket by binary search.

On top of it: Mann-Whitney U with tie correction (G9) and ROC-AUC (J6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lathe.operators.lookup import join_small
from lathe.session import cut_lineage


ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 1 << 16


def _pow2(n: int) -> int:
    return 1 << max(0, (int(n) - 1).bit_length())


def choose_buckets(df: DataFrame, part: list[str], minimum: int = 64,
                   rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Bucket count so that one bucket of the largest part holds about ``rows_per_bucket`` rows."""
    sizes = df.groupBy(*part).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("m")).first()
    biggest = int(sizes["m"] or 0) if sizes else 0
    return min(MAX_BUCKETS, max(_pow2(minimum), _pow2(-(-biggest // rows_per_bucket))))


def bucket_index(df: DataFrame, value: str, bounds: str, buckets: int, out: str) -> DataFrame:
    """``out`` = number of ``bounds`` (sorted, length buckets - 1) that are <= ``value``.

    Binary search in log2(buckets) projections; each step reads the previous
    index once, so the plan stays linear in the number of steps.
    """
    x = F.col(value).cast("double")
    df = df.withColumn(out, F.lit(0))
    step = buckets // 2
    while step >= 1:
        cand = F.col(out) + F.lit(step)
        df = df.withColumn(out, F.when(F.element_at(F.col(bounds), cand) <= x, cand).otherwise(F.col(out)))
        step //= 2
    return df


def exclusive_prefix(df: DataFrame, part: list[str], order: str, values: list[str],
                     buckets: int | None = None, suffix: str = "_before", tiebreak: list[str] | None = None) -> DataFrame:
    """Sum of ``values`` over rows of the same part that sort before each row.

    Rows must be unique per ``(part, order, *tiebreak)``; equal ``order``
    values always land in one bucket, and ``tiebreak`` orders them there.
    ``buckets`` (rounded up to a power of two) defaults to a size-based choice.
    """
    part = list(part)
    tiebreak = list(tiebreak or [])
    buckets = _pow2(buckets) if buckets else choose_buckets(df, part)
    probs = [i / buckets for i in range(1, buckets)]
    accuracy = max(10_000, 10 * buckets)
    qs = df.groupBy(*part).agg(F.percentile_approx(F.col(order).cast("double"), probs, accuracy).alias("__px_b"))
    # bounds: one array of buckets - 1 doubles per part; broadcast only while <= ~10M numbers in total
    with_b = (join_small(df, qs, on=part, how="left", max_rows=max(1, 10_000_000 // buckets)) if part
              else _attach_global(df, qs))
    t = bucket_index(with_b, order, "__px_b", buckets, "__px_k").drop("__px_b")
    tot = t.groupBy(*part, "__px_k").agg(*[F.sum(v).alias(f"__px_t_{v}") for v in values])
    w_off = Window.partitionBy(*part).orderBy("__px_k").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*part, "__px_k", *[F.coalesce(F.sum(f"__px_t_{v}").over(w_off), F.lit(0)).alias(f"__px_o_{v}")
                                        for v in values])
    w_in = Window.partitionBy(*part, "__px_k").orderBy(order, *tiebreak).rowsBetween(Window.unboundedPreceding, -1)
    inner = t.select("*", *[F.coalesce(F.sum(v).over(w_in), F.lit(0)).alias(f"__px_i_{v}") for v in values])
    res = join_small(inner, off, on=[*part, "__px_k"], how="left", max_rows=200_000)
    return (res.withColumns({f"{v}{suffix}": F.col(f"__px_i_{v}") + F.col(f"__px_o_{v}") for v in values})
            .drop("__px_k", *[f"__px_i_{v}" for v in values], *[f"__px_o_{v}" for v in values]))


def _attach_global(df: DataFrame, qs: DataFrame) -> DataFrame:
    row = qs.first()
    bounds = list(row["__px_b"]) if row is not None and row["__px_b"] is not None else []
    return df.withColumn("__px_b", F.array(*[F.lit(float(b)) for b in bounds]).cast("array<double>"))


def class_cells(df: DataFrame, value: str, label: str, part: list[str] | None = None) -> DataFrame:
    """One row per distinct value (per part) with positive / negative class counts."""
    y = F.col(label).cast("int")
    return (df.where(F.col(value).isNotNull() & F.col(label).isNotNull())
            .groupBy(*(part or []), value)
            .agg(F.sum(y).cast("long").alias("n1"), F.sum(1 - y).cast("long").alias("n0")))


def mann_whitney(df: DataFrame, value: str, label: str, part: list[str] | None = None,
                 buckets: int | None = None) -> DataFrame:
    """U of the positive class vs the negative class, tie-corrected z with continuity 0.5.

    Returns one row per part: n1, n0, U (for the positive sample), z.
    """
    part = list(part or [])
    cells = class_cells(df, value, label, part).withColumn("nt", F.col("n1") + F.col("n0"))
    pref = exclusive_prefix(cells, part, value, ["n0"], buckets)
    u_terms = F.col("n1") * (F.col("n0_before") + F.col("n0") / 2.0)
    agg = pref.groupBy(*part).agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"),
        F.sum(u_terms).alias("U"),
        F.sum(F.col("nt").cast("double") ** 3 - F.col("nt")).alias("__ties"))
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    n = n1 + n0
    mu = n1 * n0 / 2.0
    sigma = F.sqrt(n1 * n0 / 12.0 * ((n + 1) - F.col("__ties") / (n * (n - 1))))
    u_big = F.greatest(F.col("U"), n1 * n0 - F.col("U"))
    z = (u_big - mu - 0.5) / sigma
    return agg.withColumn("z", F.when(sigma > 0, z)).drop("__ties")


def roc_auc(df: DataFrame, score: str, label: str, part: list[str] | None = None,
            buckets: int | None = None) -> DataFrame:
    """Exact ROC-AUC (ties count one half) = U / (n1 * n0); one row per part."""
    mw = mann_whitney(df, score, label, part, buckets)
    return mw.select(*(part or []), (F.col("U") / (F.col("n1") * F.col("n0"))).alias("roc_auc"), "n1", "n0")


# ------------------------------------------------------------------ radix selection
#: Bits of a slice, and the slices of a double from the top.
SLICE = 16
SHIFTS = (48, 32, 16, 0)


def ordered_bits(x: Column) -> Column:
    """A double's bit pattern as a long of the same order (negative numbers mirrored; both zeros are 0), from exact arithmetic."""
    a = F.abs(x)
    guess = F.floor(F.log2(a)).cast("int")                           # can be one off beside a power of two
    near = a / F.pow(F.lit(2.0), guess)
    e = guess + F.when(near >= 2, 1).when(near < 1, -1).otherwise(0)
    mantissa = ((a / F.pow(F.lit(2.0), e) - 1) * float(1 << 52)).cast("long")
    bits = F.when(a == 0, F.lit(0).cast("long")).when(a == float("inf"), F.lit(2047 << 52)) \
        .when(a < 2.0 ** -1022, (a * 2.0 ** 537 * 2.0 ** 537).cast("long")) \
        .otherwise((e + 1023).cast("long") * F.lit(1 << 52) + mantissa)
    return F.when(x < 0, -bits).otherwise(bits)


#: Distinct values that are ranked together.
TOGETHER = 1 << SLICE


def exact_quantiles(long: DataFrame, part: list[str], value: str, probs: list[float]) -> DataFrame:
    """Exact quantiles (linear interpolation between order statistics, as pandas / numpy), any number of parts.

    ``long`` holds one observation per row; null and NaN are no observations, a null part is a part. Distinct
    values are counted once (partial aggregation) and ranked by running sums, up to ``TOGETHER`` of them side by
    side. Parts with more are opened from the top of the values' ordered bit patterns, 16 bits a pass: the slice
    that covers a wanted rank is found by running sums over the slices (at most 65,536) and opens the next pass,
    so a part of any size is spread over its slices. Nothing is collected but whether such parts exist.
    Returns ``(*part, q_index, quantile)``.
    """
    part = list(part)
    x = F.col(value).cast("double")
    rows = long.select((F.struct(*part) if part else F.struct(F.lit(0).alias("all"))).alias("__q_k"), x.alias("__q_v")) \
        .where(F.col("__q_v").isNotNull() & ~F.isnan("__q_v"))
    # several passes read the counts; what they come from runs once
    cells = cut_lineage(rows.groupBy("__q_k", "__q_v").agg(F.count(F.lit(1)).alias("__q_c")))
    large = cells.groupBy("__q_k").agg(F.count(F.lit(1)).alias("__q_d"), F.sum("__q_c").alias("__q_n")).where(F.col("__q_d") > TOGETHER)
    if large.isEmpty():
        found = _ranked(cells, probs)
    else:
        small = cells.join(large.select("__q_k"), "__q_k", "left_anti")
        found = _ranked(small, probs).unionByName(_opened(cells, large.select("__q_k", "__q_n"), probs))
    out = found.groupBy("__q_k", "q_index").agg(F.max("__q_a").alias("__q_a"), F.max("__q_b").alias("__q_b"), F.first("__q_f").alias("__q_f"))
    between = F.col("__q_a") + (F.col("__q_b") - F.col("__q_a")) * F.col("__q_f")
    return out.select(*[F.col("__q_k")[p].alias(p) for p in part], F.col("q_index").cast("int").alias("q_index"),
                      F.when(F.col("__q_a") == F.col("__q_b"), F.col("__q_a")).otherwise(between).alias("quantile"))


def _positions(probs: list[float]) -> tuple[Column, Column, Column, Column]:
    """Probabilities to explode, and of each the lower and upper rank wanted of ``__q_n`` and the share of the upper."""
    at = (F.col("__q_n") - 1) * F.col("__q_p")
    low = F.floor(at).cast("long")
    return F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("q_index", "__q_p"), low, F.least(low + 1, F.col("__q_n") - 1), at - low


def _ranked(cells: DataFrame, probs: list[float]) -> DataFrame:
    """(__q_k, q_index, __q_a, __q_b, __q_f): the values at the wanted ranks, by running sums over each part's values."""
    each, low, high, share = _positions(probs)
    whole = Window.partitionBy("__q_k")
    run = cells.select("*", F.sum("__q_c").over(whole.orderBy("__q_v").rowsBetween(Window.unboundedPreceding, 0)).alias("__q_to"),
                       F.sum("__q_c").over(whole.orderBy("__q_v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__q_n"))
    covers = lambda r: (F.col("__q_to") - F.col("__q_c") <= r) & (r < F.col("__q_to"))
    rows = run.select("__q_k", "__q_v", "__q_c", "__q_to", "__q_n", each).where(covers(low) | covers(high))
    return rows.select("__q_k", "q_index", F.when(covers(low), F.col("__q_v")).alias("__q_a"), F.when(covers(high), F.col("__q_v")).alias("__q_b"),
                       share.alias("__q_f"))


def _opened(cells: DataFrame, large: DataFrame, probs: list[float]) -> DataFrame:
    """The same for large parts, by radix selection."""
    each, low, high, share = _positions(probs)
    cells = cells.withColumn("__q_bits", ordered_bits(F.col("__q_v")))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("__q_s"), low.alias("__q_r")), F.struct(F.lit(1).alias("__q_s"), high.alias("__q_r"))))
    wanted = (large.select("__q_k", "__q_n", each).select("__q_k", "q_index", share.alias("__q_f"), sides.alias("__q_t"), F.lit(0).cast("long").alias("__q_x"))
              .select("__q_k", "q_index", "__q_f", "__q_t.__q_s", "__q_t.__q_r", "__q_x"))
    for shift in SHIFTS:
        before = F.shiftright("__q_bits", shift + SLICE) if shift < SHIFTS[0] else F.lit(0).cast("long")
        open_ = wanted.select("__q_k", "__q_x").distinct()
        slices = (cells.withColumn("__q_x", before).join(open_, ["__q_k", "__q_x"], "left_semi")
                  .groupBy("__q_k", "__q_x", F.shiftright("__q_bits", shift).alias("__q_y"))
                  .agg(F.sum("__q_c").alias("__q_m"), F.max("__q_v").alias("__q_v")))
        run = Window.partitionBy("__q_k", "__q_x").orderBy("__q_y")
        slices = slices.withColumn("__q_to", F.sum("__q_m").over(run))
        hit = (F.col("__q_to") - F.col("__q_m") <= F.col("__q_r")) & (F.col("__q_r") < F.col("__q_to"))
        wanted = wanted.join(slices, ["__q_k", "__q_x"]).where(hit).select(
            "__q_k", "q_index", "__q_f", "__q_s", (F.col("__q_r") - F.col("__q_to") + F.col("__q_m")).alias("__q_r"),
            F.col("__q_y").alias("__q_x"), *(["__q_v"] if shift == 0 else []))          # the last slice leaves one value
    return wanted.select("__q_k", "q_index", F.when(F.col("__q_s") == 0, F.col("__q_v")).alias("__q_a"),
                         F.when(F.col("__q_s") == 1, F.col("__q_v")).alias("__q_b"), "__q_f")


def quantile_values(long: DataFrame, part: list[str], value: str, probs: list[float]) -> dict:
    """Collect ``exact_quantiles`` (a few numbers per part) as ``{part_tuple: [q0, q1, ...]}``."""
    out: dict = {}
    for r in exact_quantiles(long, part, value, probs).collect():
        k = tuple(r[p] for p in part)
        out.setdefault(k, [None] * len(probs))[r["q_index"]] = r["quantile"]
    return out
