"""Substring dedup: bytes covered by a long string that a smaller document has too.

Inserting one symbol of every whole document a round would take as many rounds
(and passes over files) as the longest document has bytes. So the collection is
first cut into short fragments in which every repeat is still whole: a window
of ``LENGTH`` bytes belongs to its minimizer, the k-byte string inside it with
the least hash (leftmost of equals), and consecutive windows of one minimizer
make a fragment. Equal windows have equal minimizers at equal places, so
fragments are only compared with fragments of the same minimizer, aligned at it.

On such a group the column-wise construction runs as it does on documents: from
the last column to the first, one symbol of every fragment is inserted a round.
The state is the order of all suffixes with the common prefix of each and the one
above it. A round takes that column's symbols in this order (the column of the
Burrows-Wheeler transform), sorts them stably, which is the new order, and the
new common prefix of two neighbours with one symbol is one more than the least of
the old ones between their old places. Neighbours with a common prefix of
``LENGTH`` bytes begin with equal windows. Rounds are as many as columns, 80 for
50 bytes. Between the steps the fragments and their order are written tables,
read in sequence.

Before that, minimizers that only one document has are dropped, and equal
fragments become one with the least doc_id that has them. A minimizer with more
than ``GROUP`` different fragments is cut: its windows, each a fragment of its
own, are dealt by their hash and go through the same rounds, so no task holds an
unbounded group.

Defined results: a null text is empty; a null doc_id is below every other; rows
of one doc_id are never smaller than each other, so repeated rows stay; texts
under ``LENGTH`` bytes lose nothing; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import gc

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import discard, pieces, stored
from lathe.llm.language import MIX
from lathe.llm.line_dedup import NO_ID

LENGTH = 50
K = 20
#: k-byte strings of a window.
SPAN = LENGTH - K + 1
COLUMNS = 2 * (SPAN - 1) + K
#: Windows that are looked at together; fragments of a minimizer that stay together; fragments of a chunk.
PIECE = 1 << 22
GROUP = 1 << 14
CHUNK = 1 << 18


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def _strings(code: np.ndarray) -> np.ndarray:
    """Hash of the K bytes from each place, by doubling."""
    def join(a, la, b, lb):
        n = min(len(a), len(b) - la)
        return a[:n] * np.uint64(pow(int(MIX), lb, 1 << 64)) + b[la:la + n]

    one = (code.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    two = join(one, 1, one, 1)
    four = join(two, 2, two, 2)
    eight = join(four, 4, four, 4)
    return _mixed(join(join(eight, 8, eight, 8), 16, four, 4))


def fragments(data: bytes):
    """Yield (first window, windows, minimizer place, minimizer hash) arrays of a text, piece by piece."""
    for base in range(0, len(data) - LENGTH + 1, PIECE):
        code = np.frombuffer(data, np.uint8, min(PIECE + LENGTH - 1, len(data) - base), base)
        x = _strings(code)
        low = (x & ~np.uint64((1 << 23) - 1)) | np.arange(len(x), dtype=np.uint64)     # ties: leftmost
        size = 1
        while size * 2 <= SPAN:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[:len(low) - (SPAN - size)], low[SPAN - size:])
        place = (low & np.uint64((1 << 23) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        count = np.diff(np.r_[first, len(place)])
        yield first + base, count, place[first] + base, x[place[first]]


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, th, data): doc_id with a stand-in for null, a hash of the text, the text's bytes."""
    data = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(data).alias("th"),
                       data.alias("data"))


def shared_minimizers(rows: DataFrame) -> DataFrame:
    """A written table (th, h): a text's minimizers that some other document has too (and few more).

    A task names what its own batch shares; only one row per minimizer and batch is shuffled."""
    def look(batches):
        for b in batches:
            hs, at = [], []
            for i, data in enumerate(b.column(2).to_pylist()):
                found = [h for _, _, _, h in fragments(data)]
                if found:
                    hs.append(np.unique(np.concatenate(found)))
                    at.append(np.full(len(hs[-1]), i))
            if not hs:
                continue
            h, at = np.concatenate(hs), np.concatenate(at)
            order = np.lexsort((at, h))
            h, at = h[order], at[order]
            new = np.r_[True, h[1:] != h[:-1]]
            many = ~(new & np.r_[new[1:], True])           # more than one document of the batch has it
            th = b.column(1).to_numpy()[at]
            kind = np.where(many, np.where(new, 2, 1), 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(th), pa.array(kind)],
                                             names=["h", "th", "kind"])

    # hashes: neither a codec nor a dictionary makes them shorter
    plain = {"compression": "snappy", "parquet.enable.dictionary": "false"}
    seen = stored(rows.mapInArrow(look, "h long, th long, kind int"), "sub-seen", **plain)
    # kind 0: alone in its batch; 2: first of several in its batch; 1: further ones, known to be shared

    def match(batches):
        rest = None
        for b in batches:
            cols = [b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False), b.column(1).is_valid().to_numpy(zero_copy_only=False)]
            if b.column(1).null_count:
                cols[1] = b.column(1).fill_null(0).to_numpy()
            if rest is not None:
                cols = [np.concatenate(c) for c in zip(rest, cols)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            rest = [c[cut:] for c in cols]
            yield from _shared([c[:cut] for c in cols])
        if rest is not None:
            yield from _shared(rest)

    # without its text where the answer is known: the row only tells other batches
    asked = seen.where("kind <> 1").select("h", F.when(F.col("kind") == 0, F.col("th")).alias("th")) \
        .repartition("h").sortWithinPartitions("h")
    out = stored(seen.where("kind > 0").select("th", "h").unionByName(asked.mapInArrow(match, "th long, h long")), "sub-shared")
    discard(seen)
    return out


def _shared(cols):
    h, th, open_ = cols
    if not len(h):
        return
    new = np.r_[True, h[1:] != h[:-1]]
    ok = ~(new & np.r_[new[1:], True]) & open_             # several batches have it
    if ok.any():
        yield pa.RecordBatch.from_arrays([pa.array(th[ok]), pa.array(h[ok])], names=["th", "h"])


def occurrences(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """A written table (doc, th, first, n, at, h, s, sid): fragments of shared minimizers; windows first .. first + n - 1,
    minimizer ``at`` bytes into the fragment's bytes ``s``."""
    lists = stored(shared.groupBy("th").agg(F.collect_set("h").alias("hs")), "sub-lists")
    _release(rows)

    def cut(batches):
        for b in pieces(batches):
            cols = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
            for i, (doc, th, data) in enumerate(zip(*cols)):
                wanted = np.sort(b.column(3)[i].values.to_numpy(zero_copy_only=False).view(np.uint64))
                for first, n, place, h in fragments(data):
                    hit = wanted[np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)] == h
                    if not hit.any():
                        continue
                    first, n, place, h = first[hit], n[hit], place[hit], h[hit]
                    s = [data[a:e] for a, e in zip(first.tolist(), (first + n + LENGTH - 1).tolist())]
                    k = len(s)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, doc)), pa.array(np.full(k, th)), pa.array(first), pa.array(n.astype(np.int32)),
                         pa.array((place - first).astype(np.int32)), pa.array(h.view(np.int64)), pa.array(s, pa.binary()),
                         pa.array([xxhash.xxh3_128_digest(x) for x in s], pa.binary())],
                        names=["doc", "th", "first", "n", "at", "h", "s", "sid"])

    cutout = rows.join(lists, "th").select("doc", "th", "data", "hs").mapInArrow(
        cut, "doc long, th long, first long, n int, at int, h long, s binary, sid binary")
    out = stored(cutout, "sub-fragments")
    discard(lists)
    return out


def column_rounds(s: list[bytes], at: np.ndarray, n: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Per fragment a mask of its windows that a fragment with a smaller ``least`` has too.

    Fragments are aligned at their minimizer; each round inserts one more column on the left."""
    count = len(s)
    size = np.fromiter(map(len, s), np.int64, count)
    m = np.zeros((count, COLUMNS), np.uint8)
    left = (SPAN - 1) - at.astype(np.int64)                # the fragment's first column, also its first window's
    flat = np.frombuffer(b"".join(s), np.uint8)
    row = np.repeat(np.arange(count), size)
    m[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + left[row]] = flat
    by_column = np.ascontiguousarray(m.T)
    mask = np.zeros(count, np.int64)
    order, prefix = np.arange(count), np.zeros(count, np.int32)
    for c in range(COLUMNS - 1, -1, -1):
        symbol = by_column[c][order]                       # the column of the transform
        to = np.argsort(symbol, kind="stable")
        order, prefix = order[to], extended(prefix, symbol, to)
        if c > SPAN - 1 or not (prefix == LENGTH).any():
            continue
        live = (left[order] <= c) & (c < left[order] + n[order])
        start = np.flatnonzero(prefix < LENGTH)            # a run of equal windows begins
        mine = np.where(live, least[order], np.iinfo(np.int64).max)
        low = np.repeat(np.minimum.reduceat(mine, start), np.diff(np.r_[start, count]))
        hit = order[live & (low < mine)]
        mask[hit] |= np.int64(1) << (c - left[hit])
    return mask


def extended(prefix: np.ndarray, symbol: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Common prefixes (up to ``LENGTH``) of neighbours after ``symbol`` was put before the suffixes and ``to`` sorted them.

    Range minima of the old ones, by doubling."""
    out = np.zeros(len(to), np.int32)
    at = np.flatnonzero(np.diff(symbol[to]) == 0) + 1       # neighbours that begin with one symbol
    low, high = to[at - 1] + 1, to[at]
    level = np.frexp((high - low + 1).astype(float))[1].astype(np.int8) - 1
    least = prefix
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            least = np.minimum(least[:len(least) - (1 << k - 1)], least[1 << k - 1:])         # of 2^k from each place on
        mine = np.flatnonzero(level == k)
        out[at[mine]] = np.minimum(least[low[mine]], least[high[mine] - (1 << k) + 1])
    out[at] = np.minimum(out[at] + 1, LENGTH)
    return out


def window_masks(distinct: DataFrame) -> DataFrame:
    """(sid, mask) for the fragments (h, s, sid, at, n, least) that share windows with a smaller document's."""
    large = stored(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > GROUP).select("h"), "sub-large")

    def rounds(batches):
        rest = None

        def solve(t):
            if not len(t):
                return
            mask = column_rounds(t.column("s").to_pylist(), t.column("at").to_numpy(), t.column("n").to_numpy(),
                                 t.column("least").to_numpy())
            hit = mask != 0
            if hit.any():
                some = t.filter(pa.array(hit))
                whole = mask[hit] << some.column("shift").to_numpy().astype(np.int64)
                yield from pa.Table.from_arrays([some.column("sid").combine_chunks(), pa.array(whole)], names=["sid", "mask"]).to_batches()

        for b in batches:
            t = pa.Table.from_batches([b])
            rest = t if rest is None else pa.concat_tables([rest, t])
            if len(rest) < CHUNK:
                continue
            h = rest.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))           # the last minimizer may go on
            yield from solve(rest.slice(0, cut))
            rest = rest.slice(cut)
        if rest is not None:
            yield from solve(rest)

    # large minimizers are few (each has over GROUP fragments); the join marks them without a second pass over the others
    marked = distinct.join(large.withColumn("cut", F.lit(True)), "h", "left")
    window = F.expr(f"substring(s, shift + 1, {LENGTH})")
    cut = marked.where("cut").withColumn("shift", F.explode(F.sequence(F.lit(0), F.col("n") - 1))) \
        .select(F.xxhash64(window).alias("h"), "sid", window.alias("s"), (F.col("at") - F.col("shift")).alias("at"), F.lit(1).alias("n"), "least", "shift")
    whole = marked.where("cut IS NULL").select("h", "sid", "s", "at", "n", "least", F.lit(0).alias("shift"))
    dealt = whole.unionByName(cut).repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(rounds, "sid binary, mask long").groupBy("sid").agg(F.bit_or("mask").alias("mask"))


def _release(df: DataFrame) -> None:
    """Let Spark delete the shuffle files of finished steps: the plans that own them are garbage
    after one more (empty) job, but the driver's JVM would collect them only when its heap is full."""
    spark = df.sparkSession
    for _ in range(2):
        spark.range(1).count()
        gc.collect()
        spark._jvm.System.gc()


def covered_windows(docs: DataFrame) -> DataFrame:
    """A written table (doc, th, hits): window starts (first + set bits of mask) that a smaller document has too."""
    rows = keyed(docs)
    shared = shared_minimizers(rows)
    _release(docs)
    found = occurrences(rows, shared)
    discard(shared)
    _release(docs)
    distinct = stored(found.groupBy("sid", "s", "h", "n", "at").agg(F.min("doc").alias("least")), "sub-distinct")
    _release(docs)
    masks = stored(window_masks(distinct), "sub-masks")
    _release(docs)
    known = stored(distinct.select("sid", "least").join(masks, "sid", "left"), "sub-known")
    discard(distinct, masks)
    _release(docs)
    every = F.expr("shiftleft(1L, n) - 1")
    hits = found.select("doc", "th", "first", "n", "sid").join(known, "sid") \
        .withColumn("mask", F.when(F.col("doc") > F.col("least"), every).otherwise(F.coalesce("mask", F.lit(0).cast("long")))) \
        .where("mask <> 0")
    out = stored(hits.groupBy("doc", "th").agg(F.collect_set(F.struct("first", "mask")).alias("hits")), "sub-hits")
    discard(found, known)
    return out


def removed_runs(size: int, firsts: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Boolean array of the bytes covered by the windows."""
    bits = np.arange(SPAN)
    starts = (firsts[:, None] + bits)[(masks[:, None] >> bits) & 1 == 1]
    edge = np.bincount(starts, minlength=size + 1)
    edge -= np.bincount(starts + LENGTH, minlength=size + 1)
    return np.cumsum(edge[:-1]) > 0


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, kept (the bytes that stay), starts and ends of the removed runs, for every row."""
    hits = covered_windows(docs)
    _release(docs)
    rows = keyed(docs).withColumn("doc_id", F.when(F.col("doc") != NO_ID, F.col("doc")))

    def cut(batches):
        for b in pieces(batches):
            out = []
            for i, data in enumerate(b.column(1).to_pylist()):
                own = b.column(2)[i]
                if not own.is_valid:
                    out.append((data, [], []))
                    continue
                pairs = own.values
                gone = removed_runs(len(data), pairs.field(0).to_numpy(zero_copy_only=False), pairs.field(1).to_numpy(zero_copy_only=False))
                edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
                out.append((np.frombuffer(data, np.uint8)[~gone].tobytes(), edge[0::2].tolist(), edge[1::2].tolist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) for x in b.column(1).to_pylist()], pa.int64()),
                 pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.list_(pa.int64())),
                 pa.array([x[2] for x in out], pa.list_(pa.int64()))], names=["doc_id", "n_bytes", "kept", "starts", "ends"])

    return rows.join(hits, ["doc", "th"], "left").select("doc_id", "data", "hits").mapInArrow(
        cut, "doc_id long, n_bytes long, kept binary, starts array<long>, ends array<long>")


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 from :func:`substring_dedup`'s rows."""
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                       F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
