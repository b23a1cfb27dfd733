"""URL filter: rules first, then the log-likelihood ratio of two character models.

Two smoothed variable-order Markov models, one of accepted and one of rejected
urls, learn from the urls that the rules decide. A character's probability
backs off through the orders: ``P_k = (n(context, c) + BACK * P_(k-1)) /
(n(context) + BACK)``. Counts of contexts and of context with character lie in
hashed tables of fixed size, summed over all labelled urls, so what is broadcast
doesn't grow. A url that no rule decides is allowed if its log-likelihood
difference per character reaches the threshold that separates the labelled urls
of a fold left out of the counts best (balanced accuracy).

Defined results: a null url or one without ``://`` has empty host and path, fits
no rule and is judged by its text (null: empty; an empty text scores 0); without
labelled urls of both kinds every score is 0 and the threshold 0; repeated rows
count as often as they come; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import ascii_lower, stored
from lathe.llm.language import MIX, id_hash

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
ORDERS = 5
TABLE = 1 << 16
BACK = 2.0
#: Every so-many-th labelled url calibrates the threshold and isn't counted.
FOLDS = 5
BINS = 400


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def decide(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: len(r[0])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def places(urls: list[str]):
    """(start of each url, and per order the buckets of (context, character) and of the context)."""
    raw = [u.encode() for u in urls]
    size = np.array([len(r) for r in raw], np.int64)
    pad = b"\x00" * (ORDERS - 1)
    code = np.frombuffer(b"".join(pad + r for r in raw), np.uint8).astype(np.uint64) + np.uint64(1)
    starts = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat((np.arange(len(raw)) + 1) * (ORDERS - 1), size)
    out, h = [], np.zeros(len(at), np.uint64)
    for k in range(ORDERS):
        context = h
        full = context * MIX + code[at]
        out.append((_bucket(full, k), _bucket(context, k + ORDERS)))
        h = np.zeros(len(at), np.uint64)
        for back in range(k + 1, 0, -1):           # the next context is one character longer
            if k + 1 < ORDERS:
                h = h * MIX + code[at - back]
    return starts, size, out


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    x = (h + np.uint64(salt + 1)) * MIX
    return ((x ^ (x >> np.uint64(29))) * MIX >> np.uint64(48)).astype(np.int64) % TABLE


def learn(labelled: DataFrame) -> np.ndarray:
    """Counts [accepted or rejected, joint or context, order, bucket] of (url, verdict) rows."""
    def count(batches):
        sums = np.zeros((2, 2, ORDERS, TABLE), np.int64)
        for b in batches:
            for cls, what in enumerate(("allow", "block")):
                urls = [u for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if v == what]
                if urls:
                    for k, pair in enumerate(places(urls)[2]):
                        for kind, ids in enumerate(pair):
                            sums[cls, kind, k] += np.bincount(ids, minlength=TABLE)
        flat = sums.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["at", "n"])

    got = labelled.select("url", "verdict").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(4 * ORDERS * TABLE)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(2, 2, ORDERS, TABLE).astype(np.float32)


def ratio(urls: list[str], counts: np.ndarray) -> np.ndarray:
    """Log-likelihood difference per character, accepted minus rejected."""
    starts, size, ids = places(urls)
    if not counts[0, 0, 0].sum() or not counts[1, 0, 0].sum() or not size.sum():
        return np.zeros(len(urls))
    logp = []
    for joint, context in counts:
        p = np.full(size.sum(), 1 / 256)
        for k, (full, ctx) in enumerate(ids):
            p = (joint[k][full] + BACK * p) / (np.maximum(context[k][ctx], joint[k][full]) + BACK)
        logp.append(np.log(p))
    sums = np.concatenate(([0.0], np.cumsum(logp[0] - logp[1])))
    return np.where(size > 0, (sums[starts + size] - sums[starts]) / np.maximum(size, 1), 0.0)


def scored(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """``rows`` (url last) with a score in place of the url."""
    shared = rows.sparkSession.sparkContext.broadcast(counts)
    names = rows.columns

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(ratio([u or "" for u in b.column(b.num_columns - 1).to_pylist()], shared.value))],
                names=[*names[:-1], "score"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, score double")


def threshold(labelled: DataFrame, counts: np.ndarray) -> float:
    """The score that separates (url, verdict) rows best by balanced accuracy; from a histogram of ``BINS`` bins."""
    bins = scored(labelled.select("verdict", "url"), counts).groupBy(
        "verdict", F.least(F.greatest(F.floor(F.col("score") * BINS / 8 + BINS / 2), F.lit(0)), F.lit(BINS)).alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n")).collect()
    n = np.zeros((2, BINS + 2))
    for r in bins:
        n[int(r["verdict"] == "block"), r["bin"]] += r["n"]
    if not n[0].sum() or not n[1].sum():
        return 0.0
    allowed_above = 1 - np.concatenate(([0], np.cumsum(n[0])[:-1])) / n[0].sum()
    blocked_below = np.concatenate(([0], np.cumsum(n[1])[:-1])) / n[1].sum()
    good = allowed_above + blocked_below
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return float((best.mean() - BINS / 2) * 8 / BINS)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row of ``pages``."""
    url = F.col("url").cast("string")
    host, path = host_path(url)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), id_hash("page_id").alias("h"), host.alias("host"),
                        path.alias("path"), F.coalesce(url, F.lit("")).alias("url"))
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    rows = stored(rows.select("page_id", "h", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "url"), "url-rows")
    labelled = rows.where("verdict IS NOT NULL")
    counts = learn(labelled.where(F.col("h") % FOLDS != 0))
    cut = threshold(labelled.where(F.col("h") % FOLDS == 0), counts)
    out = scored(rows.select("page_id", "host", "path", "rule", "verdict", "url"), counts)
    model = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", model).alias("verdict"), "score")
