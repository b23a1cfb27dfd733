"""Mixing sources to target weights by the cube method.

Each source gets a target number of words. A document is taken
``floor(target / source size)`` times, and once more with the fraction that is
left as its inclusion probability. The cube method turns these probabilities
into 0 or 1: its flight phase moves the open probabilities of a group along
the null space of the balancing constraints (words and documents) until one of
them lands, again and again, so both totals stay exact; at most two documents of a group remain
open. Groups are buckets of a source, so a hot source is many groups; what
remains open in them flies again together, level by level, until a source fits
one group, whose last two documents land by giving up first the document total
and then the word total. The heaviest open document steers each step, so small ones land last.

Defined results: a null or empty text has size 0; null sources form one source,
last in order; rows equal in doc_id, source and text are one unit and share its
fate; all sizes 0: all targets 0 and nothing is taken; an empty table gives an
empty result; further columns are ignored. The result depends on the rows
alone, not on their order or partitions.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2.0
#: Units of one flight.
BUCKET = 2000
EPS = 1e-9


def targets(sizes: dict, weights: dict, total: float, max_repeat: float = MAX_REPEAT) -> dict:
    """Words per source: ``total`` shared by weight, none above ``max_repeat`` times
    its source; the excess is shared again by weight among the others."""
    out, open_, left = {}, set(sizes), total
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if unit * weights[s] > max_repeat * sizes[s]}
        if not full:
            out.update({s: unit * weights[s] for s in open_})
            break
        out.update({s: max_repeat * sizes[s] for s in full})
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def _flight(p: np.ndarray, a: np.ndarray, rng: random.Random) -> np.ndarray:
    """Move p inside the cube along the null space of ``a`` (constraints x units,
    heaviest unit first) until at most as many units as constraints stay open.

    Each step moves the heaviest open unit that can move: its unit vector is
    projected on the null space, and p goes along that or against it to the next
    face, the two with chances that leave every expectation as it is."""
    p = p.copy()
    open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    while len(open_):
        m = a[:, open_]
        inv = np.linalg.pinv(m @ m.T, hermitian=True)
        for t in range(min(len(open_), len(a) + 1)):
            u = -(m.T @ (inv @ m[:, t]))
            u[t] += 1.0
            if u[t] > EPS:
                break
        else:
            break
        u[np.abs(u) < 1e-12] = 0.0
        q = p[open_]
        with np.errstate(divide="ignore", invalid="ignore"):
            ahead = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
            back = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf)).min()
        q = q + u * (ahead if rng.random() * (ahead + back) < back else -back)
        q = np.where(q < EPS, 0.0, np.where(q > 1 - EPS, 1.0, q))
        p[open_] = q
        open_ = open_[(q > 0) & (q < 1)]
    return p


def fly(p, x, m, rng: random.Random, land: bool) -> np.ndarray:
    """Flight phase over units of mass ``x`` and ``m`` rows; with ``land`` no unit stays open."""
    p, x, m = (np.asarray(v, float) for v in (p, x, m))
    a = np.stack([x / (x.max() or 1.0), m / (m.max() or 1.0)])
    p = _flight(p, a, rng)
    if land:
        p = _flight(p, a[:1], rng)         # the document total is given up, the word total is kept
        p = np.where((p > 0) & (p < 1), [float(rng.random() < q) for q in p], p)
    return np.where(p <= EPS, 0.0, np.where(p >= 1 - EPS, 1.0, p))


COLUMNS = "source string, doc_id long, th long, rows long, size long, p double, buckets int"


def _fly_group(seed: int):
    def run(key: tuple[pa.Scalar, ...], units: pa.Table) -> pa.Table:
        units = units.append_column("mass", pc.multiply(units.column("rows"), units.column("size"))) \
            .sort_by([("mass", "descending"), ("th", "ascending"), ("doc_id", "ascending")])
        rng = random.Random(f"{seed}/{key[0].as_py()}/{key[1].as_py()}/{len(units)}")
        p = fly(units.column("p").to_numpy(), units.column("mass").to_numpy(), units.column("rows").to_numpy(), rng,
                units.column("buckets")[0].as_py() == 1)
        units = units.drop_columns(["bucket", "mass"])
        return units.set_column(units.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))
    return run


def units_of(docs: DataFrame) -> DataFrame:
    """(source, doc_id, th, rows, size): rows equal in doc_id, source and text are one unit."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("th"),
                       F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"))
    return rows.groupBy("source", "doc_id", "th").agg(F.count(F.lit(1)).alias("rows"), F.first("size").alias("size"))


def source_table(spark: SparkSession, units: DataFrame, weights=WEIGHTS, share: float = SHARE,
                 max_repeat: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target, units): one row per source. The mix is stated per
    source, so this table (and only this one) is made on the driver."""
    got = units.groupBy("source").agg(F.sum(F.col("rows") * F.col("size")).alias("size"), F.count(F.lit(1)).alias("units")).collect()
    got.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    weight = {r["source"]: weights[i % len(weights)] for i, r in enumerate(got)}
    size = {r["source"]: r["size"] for r in got}
    goal = targets(size, weight, share * sum(size.values()), max_repeat)
    return spark.createDataFrame([(r["source"], r["size"], float(goal[r["source"]]), r["units"]) for r in got],
                                 "s string, source_size long, target double, units long")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: float = MAX_REPEAT, seed: int = 0) -> DataFrame:
    """source, doc_id, th, rows, size, source_size, target, copies: how often each unit's rows are taken."""
    spark = docs.sparkSession
    units = stored(units_of(docs), "mix-units")
    sources = source_table(spark, units, weights, share, max_repeat)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + EPS)
    frac = F.greatest(ratio - whole, F.lit(0.0))
    rated = units.join(sources, F.col("source").eqNullSafe(F.col("s")))
    open_ = rated.select("source", "doc_id", "th", "rows", "size", F.when(frac < EPS, 0.0).otherwise(frac).alias("p"),
                         F.ceil(F.col("units") / BUCKET).cast("int").alias("buckets"))
    flown = []
    level = 0
    while True:
        dealt = open_.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "th", F.lit(level)), F.col("buckets")).cast("int"))
        out = stored(dealt.groupBy("source", "bucket").applyInArrow(_fly_group(seed + level), COLUMNS), "mix-flown")
        landed = (F.col("p") <= 0) | (F.col("p") >= 1)
        flown.append(out.where(landed))
        rest = out.where(~landed)
        counts = rest.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        level += 1
        if rest.isEmpty():
            break
        open_ = rest.join(counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))) \
            .select("source", "doc_id", "th", "rows", "size", "p", F.ceil(F.col("n") / BUCKET).cast("int").alias("buckets"))
    decided = flown[0]
    for x in flown[1:]:
        decided = decided.unionByName(x)
    return decided.join(sources, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "doc_id", "th", "rows", "size", "source_size", "target", (whole + F.col("p")).cast("long").alias("copies"))


def taken(mixed: DataFrame) -> DataFrame:
    """One row per document row: doc_id, size, source_size, target, taken."""
    each = mixed.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def take(docs: DataFrame) -> DataFrame:
    """``docs`` with every row repeated (or left out) as :func:`mix` says, columns as they were."""
    mixed = mix(docs).where("copies > 0").select(F.col("source").alias("__s"), F.col("doc_id").alias("__id"),
                                                 F.col("th").alias("__th"), F.col("copies").alias("__copies"))
    mixed = stored(mixed, "mix-taken")
    keyed = docs.withColumns({"__key": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    hit = (F.col("__key") == F.col("__th")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) \
        & F.col("source").cast("string").eqNullSafe(F.col("__s"))
    return keyed.join(mixed, hit).withColumns({"__n": F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))}) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
