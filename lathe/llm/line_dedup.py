"""Line dedup: keys are range-partitioned and streamed in (key, document) order.

The key of a line is the line stripped of white space and with A-Z lower-cased;
only keys of at least ``MIN_CHARS`` code points count. Rows (key hash, document,
position) are range-partitioned by (hash, document) and sorted inside each
partition by hash, document descending and position, so a stream meets the document that keeps its lines first.
A hash that may go on in a neighbouring range (the first and last of a
partition) stays undecided there; its per-range document counts are added up,
at most two rows a range, and decide it everywhere. A key that fills many ranges
is therefore never gathered in one task. The result is one compressed keep
bitmap per document that loses a line.

Defined results: a null or empty text is one empty line; null doc_ids are one
document below all others; repeated rows of a document get equal bitmaps; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathe.llm.common import SPACE, ascii_lower, pieces, stored

MIN_CHARS = 40
MIN_DOCS = 5
#: Stands for a null doc_id: below every other.
NO_ID = -(1 << 63)

SCHEMA = pa.schema([("key", pa.binary()), ("doc", pa.int64()), ("th", pa.int64()), ("pos", pa.int32()),
                    ("state", pa.int32()), ("docs", pa.int64())])
STREAMED = "key binary, doc bigint, th bigint, pos int, state int, docs bigint"
#: States of a streamed row: the line goes; its key touches the edge of the range; document count of such a key.
GOES, EDGE, COUNT = 1, 2, 3


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc, th, pos) per line that has a key; ``th`` tells texts of one doc_id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("th"),
                       F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    key = ascii_lower(F.btrim("line", F.lit(SPACE)))
    return rows.select("doc", "th", "pos", key.alias("line")).where(F.length("line") >= min_chars) \
        .select(F.unhex(F.md5("line")).alias("key"), "doc", "th", "pos")


def stream_ranges(min_docs: int):
    """mapInArrow function over sorted ranges of (key, doc descending, pos).

    Holds the rows of at most ``min_docs - 1`` documents at a time. Of a key that goes, the rows
    of the range's largest document are held until the next key: at the range's end, a later
    range may have a larger document, so they are edge rows as well."""
    def run(batches):
        key, top, docs, last, first = None, None, 0, None, True
        held: list = []

        for b in batches:
            out: list = []
            for k, d, t, p in zip(*(b.column(i).to_pylist() for i in range(4))):
                if k != key:
                    if key is not None and first:      # the range's first key: earlier ranges may hold more of it
                        out.append((key, top, 0, 0, COUNT, docs))
                        first = False
                    elif key is None:
                        first = True
                    key, top, docs, last, held = k, d, 0, None, []
                if d != last:
                    docs, last = docs + 1, d
                if first:
                    out.append((k, d, t, p, EDGE, 0))
                elif docs < min_docs or d == top:
                    held.append((k, d, t, p))
                else:
                    if held[-1][1] != top:             # top's rows come first
                        out += [(*x, GOES, 0) for x in held if x[1] != top]
                        held = [x for x in held if x[1] == top]
                    out.append((k, d, t, p, GOES, 0))
            if out:
                yield _batch(out)
        if key is not None:                            # the range's last key: later ranges may hold more of it
            yield _batch([(*x, EDGE, 0) for x in held] + [(key, top, 0, 0, COUNT, docs)])

    return run


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SCHEMA.types)], schema=SCHEMA)


@F.pandas_udf(T.BinaryType())
def _bitmap(dropped: pd.Series) -> pd.Series:
    """Compressed keep bitmap from dropped positions: bit i is line i; lines past its end stay."""
    def one(places):
        keep = np.ones(int(max(places)) // 8 * 8 + 8, bool)
        keep[np.asarray(places)] = False
        return zlib.compress(np.packbits(keep).tobytes())
    return dropped.map(one)


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, th, n_dropped, keep) for each document text that loses a line."""
    rows = stored(line_rows(docs, min_chars), "line-keys")
    ranges = rows.repartitionByRange("key", "doc").sortWithinPartitions("key", F.desc("doc"), "pos")
    streamed = stored(ranges.mapInArrow(stream_ranges(min_docs), STREAMED), "line-streamed")
    edges = streamed.where(F.col("state") == COUNT).groupBy("key").agg(
        F.sum("docs").alias("all_docs"), F.max("doc").alias("top")).where(F.col("all_docs") >= min_docs)
    late = streamed.where(F.col("state") == EDGE).join(F.broadcast(edges), "key").where(F.col("doc") < F.col("top"))
    gone = streamed.where(F.col("state") == GOES).select("doc", "th", "pos").unionByName(late.select("doc", "th", "pos"))
    places = gone.groupBy("doc", "th").agg(F.collect_set("pos").alias("places"))
    return places.select("doc", "th", F.size("places").cast("long").alias("n_dropped"), _bitmap("places").alias("keep"))


def apply_bitmap(text: str, keep: bytes | None) -> tuple[int, str]:
    """(number of lines, text that stays)."""
    lines = text.split("\n")
    if keep is None:
        return len(lines), text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
    return len(lines), "\n".join(x for i, x in enumerate(lines) if i >= len(bits) or bits[i])


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, text, n_dropped and keep (null: every line stays) for every row of ``docs``."""
    bitmaps = stored(keep_bitmaps(docs, min_chars, min_docs), "line-bitmaps")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("th"),
                       F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # the same plan at every size: how many documents lose a line does not say how many there are
    return rows.join(bitmaps.hint("merge"), ["doc", "th"], "left").select(
        "doc_id", "text", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), "keep")


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 from :func:`line_dedup`'s rows."""
    def run(batches):
        for b in pieces(batches):
            got = [apply_bitmap(t, k) for t, k in zip(b.column(1).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _ in got], pa.int64()), b.column(2),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for _, t in got], pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])
    return rows.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
