"""SimHash near-dedup: 64-bit fingerprints linked within a Hamming distance.

The self-join walks a binary trie of the distinct fingerprints in pairs of
nodes, adds up the bits in which their paths differ and drops a pair as soon as
the sum exceeds the budget. To deal the walk out, the trie is built once for
each of ``max_bits + 1`` rotations, with one block of bits on top: two
fingerprints within the budget agree in at least one block, so in one of the
rotations their paths stay together through the block and the walk can start
below it, inside one (rotation, block value) subtree. A subtree above ``UNIT``
fingerprints is cut into shards whose pairs are walked as units of their own,
so no task holds more than two shards of it. A unit returns a spanning forest
of its links, never all pairs. Components of the forest edges come from
alternating large-star and small-star rounds.

Defined results: null and empty texts have no words and fingerprint zero, linked
like any other; a null doc_id is below every other and gives a null component;
repeated rows get equal results; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import pieces, stored

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of a subtree that are walked in one shard.
UNIT = 4096
#: Node pairs with at most so many fingerprint pairs are compared directly.
LEAF = 64
CHUNK = 1 << 16


def fingerprint(text: str | None, n: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the hashes of all ``n``-word shingles."""
    ws = (text or "").encode().lower().split()     # bytes: A-Z and ASCII white space only
    if not ws:
        return 0
    buf = b" ".join(ws)
    if len(ws) <= n:
        return xxhash.xxh64_intdigest(buf, SEED)
    ends = np.cumsum([len(w) + 1 for w in ws])
    starts = np.concatenate(([0], ends[:-1]))
    total, ones = len(ws) - n + 1, np.zeros(64, np.int64)
    spans = zip(starts[:total].tolist(), (ends[n - 1:] - 1).tolist())
    hashes = np.fromiter((xxhash.xxh64_intdigest(buf[a:b], SEED) for a, b in spans), np.uint64, total)
    for at in range(0, total, CHUNK):
        bits = np.unpackbits(hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, th) for every row: the fingerprint as a signed 64-bit number and a hash of the text."""
    def run(batches):
        for b in pieces(batches):
            fps = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), b.column(2)], names=["doc_id", "fp", "th"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       text_hash().alias("th")).mapInArrow(run, "doc_id long, fp long, th long")


def text_hash():
    """Tells texts of one doc_id apart (a null text is empty)."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ``max_bits + 1`` blocks."""
    cuts = np.linspace(0, 64, max_bits + 2).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(cuts, cuts[1:])]


def units(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(unit, side, fp): each subtree, or each pair of shards of a large subtree.

    ``unit`` names rotation, block value and the two shards; side is the shard's
    place in the pair (0 and 1; 2: the unit joins one shard with itself)."""
    rows = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("rot"), F.shiftrightunsigned(F.col("fp"), a).bitwiseAND((1 << w) - 1).alias("value"))
        for i, (a, w) in enumerate(_blocks(max_bits))])).alias("x")).select("fp", "x.rot", "x.value")
    sizes = stored(rows.groupBy("rot", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select(F.col("rot").alias("r"), F.col("value").alias("v"),
                           F.ceil(F.col("n") / UNIT).cast("int").alias("shards")), "simhash-subtrees")
    sized = rows.join(sizes, (F.col("rot") == F.col("r")) & (F.col("value") == F.col("v")))
    own = sized.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int"))
    pairs = own.select("fp", "rot", "value", "own", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return pairs.select(F.xxhash64("rot", "value", low, high).alias("unit"), "rot", "value", low.alias("i"), high.alias("j"),
                        F.when(low == high, 2).when(F.col("own") == low, 0).otherwise(1).alias("side"), "fp")


def rotate(fps: np.ndarray, first: int, width: int) -> np.ndarray:
    """Bits of the block on top, the others below it in their order."""
    shift = np.uint64((first + width) % 64)
    return fps if shift == 0 else (fps >> shift) | (fps << (np.uint64(64) - shift))


def walk(keys: np.ndarray, a: np.ndarray, b: np.ndarray, max_bits: int):
    """Yield arrays (i, j) of places in ``keys`` that are within ``max_bits``.

    ``a`` and ``b`` are (lo, hi, ...) node ranges of sorted tries inside ``keys``;
    row k of both is a root pair. A pair whose accumulated error passes the budget
    is dropped; a small pair is compared key by key."""
    stack = [(a[:, 0], a[:, 1], b[:, 0], b[:, 1], np.zeros(len(a), np.int64), 63)]
    while stack:
        lo, hi, lo2, hi2, err, bit = stack.pop()
        if len(lo) > CHUNK:
            for at in range(0, len(lo), CHUNK):
                stack.append(tuple(x[at:at + CHUNK] for x in (lo, hi, lo2, hi2, err)) + (bit,))
            continue
        size = (hi - lo) * (hi2 - lo2)
        small = (size <= LEAF) if bit >= 0 else np.ones(len(lo), bool)
        for i, j in _compare(lo[small], hi[small], lo2[small], hi2[small]):
            near = np.bitwise_count(keys[i] ^ keys[j]) <= max_bits
            near &= i < j
            if near.any():
                yield i[near], j[near]
        if small.all():
            continue
        lo, hi, lo2, hi2, err = (x[~small] for x in (lo, hi, lo2, hi2, err))
        mid, mid2 = _split(keys, lo, hi, bit), _split(keys, lo2, hi2, bit)
        same = (lo == lo2) & (hi == hi2)
        parts = [(lo, mid, lo2, mid2, err, None), (mid, hi, mid2, hi2, err, None),
                 (lo, mid, mid2, hi2, err + 1, None), (mid, hi, lo2, mid2, err + 1, ~same)]
        new = []
        for x in parts:
            ok = (x[0] < x[1]) & (x[2] < x[3]) & (x[4] <= max_bits)
            if x[5] is not None:
                ok &= x[5]                 # inside one node the mirrored pair is the same pair
            new.append([y[ok] for y in x[:5]])
        nxt = tuple(np.concatenate(c) for c in zip(*new))
        if len(nxt[0]):
            stack.append(nxt + (bit - 1,))


def _split(keys, lo, hi, bit):
    """First place in each sorted range [lo, hi) whose ``bit`` is 1 (all higher bits agree)."""
    want = np.uint64(1 << bit)
    a, b = lo.copy(), hi.copy()
    while True:
        open_ = a < b
        if not open_.any():
            return a
        m = (a + b) >> 1
        one = (keys[np.minimum(m, len(keys) - 1)] & want) != 0
        b = np.where(open_ & one, m, b)
        a = np.where(open_ & ~one, m + 1, a)


def _compare(lo, hi, lo2, hi2):
    """All key pairs of the given small node pairs, in chunks."""
    at, n = 0, (hi - lo) * (hi2 - lo2)
    while at < len(lo):
        end = at + max(1, int(np.searchsorted(np.cumsum(n[at:]), CHUNK * 4, side="right")))
        c = n[at:end]
        row = np.repeat(np.arange(at, end), c)
        k = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        w = (hi2 - lo2)[row]
        yield lo[row] + k // w, lo2[row] + k % w
        at = end


class Forest:
    """Union-find over places of one chunk, fed with arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        r = self.root
        while True:
            a, b = r[i], r[j]
            differ = a != b
            if not differ.any():
                return
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(r, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = r[r]
                if (up == r).all():
                    break
                r[:] = up


def _unit_links(keys, fps, unit, side, max_bits):
    """Forest edges (fp, fp) of a chunk of whole units; rows sorted by (unit, side, key)."""
    n = len(keys)
    change = np.flatnonzero(np.r_[True, (unit[1:] != unit[:-1]) | (side[1:] != side[:-1]), ])
    lo, hi = change, np.r_[change[1:], n]
    u, s = unit[lo], side[lo]
    self_join = s == 2
    a, b = [np.c_[lo[self_join], hi[self_join]]], [np.c_[lo[self_join], hi[self_join]]]
    cross = np.flatnonzero((s[:-1] == 0) & (s[1:] == 1) & (u[:-1] == u[1:])) if len(s) > 1 else np.array([], int)
    a.append(np.c_[lo[cross], hi[cross]])
    b.append(np.c_[lo[cross + 1], hi[cross + 1]])
    forest = Forest(n)
    for i, j in walk(keys, np.concatenate(a), np.concatenate(b), max_bits):
        forest.add(i, j)
    child = np.flatnonzero(forest.root != np.arange(n))
    return fps[child], fps[forest.root[child]]


def link_forest(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a > b: forest edges that connect exactly the linked distinct fingerprints."""
    blocks = _blocks(max_bits)

    def run(batches):
        waiting: list = []

        def links(cols):
            unit, rot, side, fp = cols
            keys = np.empty(len(fp), np.uint64)
            for r, (first, width) in enumerate(blocks):
                keys[rot == r] = rotate(fp.view(np.uint64)[rot == r], first, width)
            order = np.lexsort((keys, side, unit))
            x, y = _unit_links(keys[order], fp[order], unit[order], side[order], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"])

        for batch in batches:
            waiting.append([batch.column(i).to_numpy() for i in range(4)])
            if sum(len(w[0]) for w in waiting) < CHUNK:
                continue
            cols = [np.concatenate(c) for c in zip(*waiting)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))      # the last unit may go on
            if cut:
                yield links([c[:cut] for c in cols])
            waiting = [[c[cut:] for c in cols]]
        if waiting and len(cols := [np.concatenate(c) for c in zip(*waiting)]) and len(cols[0]):
            yield links(cols)

    dealt = units(fps, max_bits).repartition("unit").sortWithinPartitions("unit").select("unit", "rot", "side", "fp")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component, for nodes with an edge.

    Alternating large-star and small-star rounds; each round is a written table."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "cc-edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "cc-large")
        large = both.where(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("n")) \
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "cc-large-star")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m"), "cc-small")
        small = large.join(least, F.col("a") == F.col("n"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "cc-small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = now


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, class_id, class_size, component_id for every row of ``docs``.

    A class holds the rows of one fingerprint (class_id: its least doc_id); component_id is the least doc_id of all classes connected by links."""
    return named_rows(docs, shingle, max_bits).select("doc_id", "fp", "class_id", "class_size", "component_id")


def named_rows(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The columns of :func:`near_dedup`, th (hash of the text) and root, which names the component."""
    fps = stored(fingerprints(docs, shingle), "simhash-fps")
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "simhash-classes")
    roots = components(link_forest(classes.select("fp"), max_bits))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left") \
        .select("fp", "class_id", "class_size", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "simhash-rooted")
    least = stored(rooted.groupBy("root").agg(F.min("class_id").alias("component_id")), "simhash-components")
    named = stored(rooted.join(least, "root").select(F.col("fp").alias("c_fp"), "class_id", "class_size", "component_id", "root"), "simhash-named")
    return fps.join(named, F.col("fp") == F.col("c_fp")).select("doc_id", "fp", "class_id", "class_size", "component_id", "th", "root")


def hexadecimal(fp):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document (the least doc_id) of each component, columns as they were.

    A doc_id may stand on several rows: what stays is one row of one text, not all rows of the id."""
    first = named_rows(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    texts = first.groupBy("root", "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
    stay = stored(texts.groupBy("root").agg(F.min(F.struct("th", "doc_id", "n")).alias("x")).select(
        F.col("x.doc_id").alias("__id"), F.col("x.th").alias("__th"), (F.col("x.n") > 1).alias("__copies")), "simhash-stay")
    out = docs.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (text_hash() == F.col("__th")))
    # repeated rows (same doc_id and text) all match their keeper: one stays
    alone = out.where(~F.col("__copies"))
    again = out.where(F.col("__copies")).dropDuplicates(["__id", "__th"])
    return alone.unionByName(again).select(*[F.col(f"`{c}`") for c in docs.columns])
