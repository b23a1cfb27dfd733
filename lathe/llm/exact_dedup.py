"""Exact dedup with a heavy-hitter split (native: DataFrame functions only).

Texts are equal when they are identical after lower-casing A-Z; the SHA-256 of
that form stands for the text. A Misra-Gries summary over the digests names
every digest that may hold more than ``1 / HEAVY`` of the rows. Those few
candidates are counted exactly (the verified winners) and broadcast, at most
``2 * HEAVY`` rows, so their rows are decided in the map tasks and never shuffled.
All other digests take one ordinary shuffle.

Defined results: a null text counts as empty; a null doc_id is below every
other; of rows equal in digest and doc_id (repeated rows) one stays; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import ascii_lower, stored

#: Entries of the summary: every digest above 1/HEAVY of the rows is in it.
HEAVY = 256
#: Summaries of map partitions are merged in so many tasks before the last merge.
MERGE = 64


def digest_rows(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text_sha256) for each row; rid tells repeated rows apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.sha2(F.encode(ascii_lower(text), "UTF-8"), 256).alias("text_sha256"))
    return rows.withColumn("rid", F.monotonically_increasing_id())


def frequent(rows: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """At most ``2 * heavy`` candidate digests, among them all above 1/heavy of
    the rows. Each map partition keeps a Misra-Gries summary (the frequent-items
    sketch, ``4 * heavy`` counters, error below 1/(3 * heavy)); summaries merge in
    two levels, so no task sees them all."""
    part = rows.select("text_sha256", (F.spark_partition_id() % MERGE).alias("g"))
    level1 = part.groupBy("g").agg(F.expr(f"approx_top_k_accumulate(text_sha256, {heavy * 4})").alias("s"))
    # grouped by a constant: a global aggregate would also make summaries of empty partitions, which can't be merged
    top = level1.groupBy(F.col("g") * 0).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {heavy * 4}), {heavy * 2})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias("text_sha256"))


def winners(rows: DataFrame) -> DataFrame:
    """Exact group size and the row that stays, per digest."""
    return rows.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "rid")).alias("stay"))


def exact_dedup(docs: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    rows = stored(digest_rows(docs), "exact-rows")
    candidates = stored(frequent(rows, heavy), "exact-frequent")
    hot = stored(winners(rows.join(F.broadcast(candidates), "text_sha256", "left_semi")), "exact-hot")
    is_hot = hot.select("text_sha256")
    rest = rows.join(F.broadcast(is_hot), "text_sha256", "left_anti")
    cold = stored(winners(rest), "exact-cold")   # stored: both join sides get a shuffle of their own, which can be split
    decided = rows.join(F.broadcast(hot), "text_sha256").unionByName(rest.join(cold, "text_sha256"))
    return decided.select("doc_id", F.col("stay.doc_id").alias("keep_id"), "group_size",
                          (F.col("rid") == F.col("stay.rid")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops, columns as they were."""
    decided = exact_dedup(docs)
    kept = decided.where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"),
                                        (F.col("group_size") > 1).alias("__copies"))
    kept = stored(kept, "exact-kept")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns({"__key": F.sha2(F.encode(ascii_lower(text), "UTF-8"), 256)})
    out = keyed.join(kept, (F.col("__key") == F.col("__sha")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")))
    # repeated rows (same doc_id and text) all match their keeper: one stays
    alone = out.where(~F.col("__copies"))
    again = out.where(F.col("__copies")).dropDuplicates(["__key"])
    return alone.unionByName(again).select(*[F.col(f"`{c}`") for c in docs.columns])
