"""Quality rules with cross-document line frequency (native: DataFrame functions only).

One pass over the texts computes the base statistics and, for each line with a
word, the hash of its normalised form (white space stripped, A-Z lower-cased).
A line found in more than ``max_docs`` distinct documents of one host (the
``source`` column stands for the host) is removed; a document that passes the
base rules but keeps less than ``min_left`` of its line characters is depleted
and rejected too.

Defined results: a null text has no words and fails the base rules; null hosts
form one host; repeated rows count as documents of their own; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import SPACE, ascii_lower, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
#: A line in more documents of a host than this is removed.
MAX_DOCS = 50
#: A document that keeps less than this share of its line characters is depleted.
MIN_LEFT = 0.3


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeat_words(ws: Column, window: int = WINDOW) -> Column:
    """Number of words inside ``window``-word runs found twice or more."""
    def runs(h):
        return F.when(F.size(h) >= window, F.transform(
            F.sequence(F.lit(0), F.size(h) - window),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))).otherwise(F.array().cast("array<bigint>"))

    def covered(r):
        order = F.array_sort(F.transform(r, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = let(order, lambda s: F.filter(s, lambda x, i: F.coalesce(
            (F.get(s, i + 1)["h"] == x["h"]) | ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"])), F.lit(False))))
        places = F.array_sort(F.transform(found, lambda x: x["i"]))
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-window).alias("last"))
        return F.aggregate(places, start, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(window), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    hashes = F.transform(ws, lambda w: F.xxhash64(w))
    return let(let(hashes, runs), lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), F.lit(0).cast("bigint"))
               .otherwise(covered(r)))


def statistics(docs: DataFrame) -> DataFrame:
    """Base statistics and line hashes, one row per row of ``docs``; the only pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    chars = F.length(text)
    stripped = F.transform(lines, lambda x: ascii_lower(F.btrim(x, F.lit(SPACE))))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"),
                       let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                           repeat_words(w).alias("n_repeat_words"))).alias("w"),
                       F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
                       (chars - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                       let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                       F.transform(stripped, lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("n"))).alias("lines"),
                       F.xxhash64(text).alias("th"))
    return base.select("doc_id", "host", "th", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words",
                       "lines").withColumn("rid", F.monotonically_increasing_id())


def judged(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """The columns of :func:`quality_rules`, host, th (hash of the text) and removed (hashes of the
    lines that go, null: none) for every row."""
    stats = stored(statistics(docs), "quality-stats")
    lines = stats.select("rid", "host", "lines")
    once = lines.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    common = stored(once.groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > max_docs)
                    .select(F.col("host").alias("c_host"), F.col("h").alias("c_h")), "quality-common")
    each = lines.select("rid", "host", F.explode("lines").alias("x")).select("rid", "host", "x.h", "x.n")
    hits = each.join(common, (F.col("h") == F.col("c_h")) & F.col("host").eqNullSafe(F.col("c_host")), "left_semi")
    removed = stored(hits.groupBy("rid").agg(
        F.sum("n").alias("removed_chars"), F.sort_array(F.collect_set("h")).alias("removed")), "quality-removed")
    out = stats.withColumn("line_chars", F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])) \
        .drop("lines").join(removed, "rid", "left").fillna(0, ["removed_chars"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    depleted = F.col("line_chars") - F.col("removed_chars") < min_left * F.col("line_chars")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "line_chars", "removed_chars",
                      "host", "th", "removed")


def quality_rules(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, line_chars and removed_chars for every row."""
    return judged(docs, max_docs, min_left).drop("host", "th", "removed")


def clean(docs: DataFrame, max_docs: int = MAX_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """The rows of ``docs`` that pass, without their removed lines; columns as they were."""
    stay = judged(docs, max_docs, min_left).where("kept").select(
        F.col("doc_id").alias("__q_id"), F.col("host").alias("__q_host"), F.col("th").alias("__q_th"),
        F.col("removed").alias("__q_removed")).distinct()          # equal rows lose equal lines
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("__q_id"))
                     & F.col("source").cast("string").eqNullSafe(F.col("__q_host")) & (F.xxhash64(text) == F.col("__q_th")))
    goes = lambda x: (F.btrim(x, F.lit(SPACE)) != "") & F.array_contains(
        "__q_removed", F.xxhash64(ascii_lower(F.btrim(x, F.lit(SPACE)))))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~goes(x)), "\n")
    return rows.withColumn("text", F.when(F.col("__q_removed").isNull(), F.col("text")).otherwise(left)).select(*[f"`{c}`" for c in docs.columns])
