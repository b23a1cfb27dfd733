"""Mixture-controlled packing by deficit round-robin over source queues.

Documents become token ids and are dealt to lanes of about ``LANE`` tokens.
Inside a lane every source is a queue. Each window of ``WINDOW`` sequences adds
every source's target share of the window to its deficit counter and serves the
queues from their counters; what an exhausted queue leaves unfilled goes to the
open queue with the largest deficit. Counters carry over from window to window,
and from lane to lane: a lane starts with the deficits that all lanes before it
leave, which follow from the lanes' token counts per source (prefix sums).
Documents are cut freely, so only the last sequence of a lane is padded.

Defined results: a null text is empty and has only the end token; null sources
form one source; repeated rows are packed each; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lathe.llm.common import pieces, stored

SEQUENCE = 2048
#: Sequences of a window.
WINDOW = 16
#: Tokens of a lane.
LANE = 4 << 20
END = 1
BLOCK = 1024
#: Words whose ids a worker remembers, in each of two generations.
REMEMBER = 400_000

_WORKER: dict = {}


class Ids:
    """Token ids of texts, by white-space separated word: the pre-tokenizer never
    joins across white space, so a word has the same ids in every text. Words of
    plain Latin letters with closing marks (but no apostrophe, which may open a suffix),
    nearly all, go to the BPE model many at a time as letter run and marks; any other word
    goes through the whole tokenizer."""

    PLAIN = re.compile(r"^(?:([a-z\xdf-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)|.*)$", re.M)

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        n = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(n, bool)
        for t, i in self.tok.get_vocab().items():
            self.ends[i] = t.endswith("</w>")
        self.memory: dict[bytes, bytes] = {}                     # two generations: words in use move to the young one
        self.older: dict[bytes, bytes] = {}
        self.runs = Tokenizer(self.tok.model)                    # takes runs as the pre-tokenizer would hand them over
        self.runs.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        byte = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.table = {c: byte.pre_tokenize_str(chr(c))[0][0] for c in range(0xdf, 0x100)}
        # does this tokenizer work that way at all?
        probe = "na\xefve the o\xf9r caf\xe9. a!\"#$%& b()*+,-./ c:;<=>?@ d[\\]^_` e{|}~ f_ g$$$ h.%%%"
        words = probe.encode().split()
        self.plain = True
        self.plain = b"".join(self.learn(set(words))[w] for w in words) == self._encode([probe])[0]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _runs(self, runs: list[str]) -> dict[str, bytes]:
        """Ids of letter runs: many at once, cut after each end-of-word id."""
        out = {}
        parts = [some[at:at + 256] for some in ([w for w in runs if w.isascii()], [w for w in runs if not w.isascii()])
                 for at in range(0, len(some), 256)]
        joined = [" ".join(p) if p[0].isascii() else " ".join(p).translate(self.table) for p in parts]
        for part, e in zip(parts, self.runs.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(e.ids, self.dtype)
            data, size = ids.tobytes(), self.dtype.itemsize
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * size).tolist()
            if len(cuts) != len(part):
                out.update(zip(part, self._encode(part)))
                continue
            out.update(zip(part, [data[a:b] for a, b in zip([0, *cuts], cuts)]))
        return out

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        words = list(words)
        if not self.plain:
            return dict(zip(words, self._encode([w.decode() for w in words])))
        found = self.PLAIN.findall(b"\n".join(words).decode().lower()) if words else []
        runs = self._runs(list({c for c, _ in found if c}))
        marks = list({m for _, m in found if m})
        tails = {"": b"", **dict(zip(marks, self._encode(marks)))}
        new = {w: runs[c] + tails[m] for w, (c, m) in zip(words, found) if c}
        odd = [w for w, (c, _) in zip(words, found) if not c]
        new.update(zip(odd, self._encode([w.decode() for w in odd])))
        return new

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian numbers of ``dtype``."""
        words, cuts = [], [0]
        for t in texts:
            words += t.encode().split()
            cuts.append(len(words))
        got = list(map(self.memory.get, words))                  # the only look at the memory, which no cache holds
        gaps = [i for i, x in enumerate(got) if x is None]
        if gaps:
            missing = {words[i] for i in gaps}
            if len(self.memory) + len(missing) > REMEMBER:
                self.older, self.memory = self.memory, {w: x for w, x in zip(words, got) if x is not None}
            new = {w: self.older[w] for w in missing if w in self.older}
            new.update(self.learn(missing.difference(new)))
            self.memory.update(new)
            for i in gaps:
                got[i] = new[words[i]]
        return [b"".join(got[a:b]) for a, b in pairwise(cuts)]


def worker_ids(path: str) -> Ids:
    """This worker process's Ids, kept from task to task."""
    return _WORKER.get(path) or _WORKER.setdefault(path, Ids(path))


def tokenize(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """(doc_id, source, n, ids) per row; ids: little-endian, 2 bytes each (4 for a vocabulary above 65,536)."""
    def run(batches):
        ids = worker_ids(path)
        tail = np.array([end], ids.dtype).tobytes()
        for part in pieces(batches):
            got = [x + tail for x in ids.of(part.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([len(x) // ids.dtype.itemsize for x in got], pa.int64()),
                 pa.array(got, pa.binary())], names=["doc_id", "source", "n", "ids"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       text.alias("text")).mapInArrow(run, "doc_id long, source string, n long, ids binary")


def round_robin(queues: dict, deficit: dict, share: dict, window: int):
    """Yield (source, place, start, length) in packing order.

    ``queues``: per source a deque of [place, start, tokens left]."""
    left = sum(n for q in queues.values() for _, _, n in q)
    have = {s: sum(n for _, _, n in q) for s, q in queues.items()}
    while left:
        room = min(window, left)
        for s in deficit:
            deficit[s] += share.get(s, 0.0) * room
        order = sorted((s for s in queues if have[s]), key=lambda s: (-deficit[s], s is None, s or ""))
        give = {}
        for s in order:                              # each queue is served from its counter
            give[s] = min(have[s], max(0, int(deficit[s])), room)
            room -= give[s]
        for s in sorted(order, key=lambda s: (give[s] - deficit[s], s is None, s or "")):
            more = min(have[s] - give[s], room)      # what is unfilled goes to the largest deficits
            give[s] += more
            room -= more
        for s in order:
            want = give[s]
            deficit[s] -= want
            have[s] -= want
            left -= want
            while want:
                head = queues[s][0]
                n = min(want, head[2])
                yield s, head[0], head[1], n
                want -= n
                head[1] += n
                head[2] -= n
                if not head[2]:
                    queues[s].popleft()


SCHEMA = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), *[(c, pa.int64()) for c in (
    "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32")], ("ids", pa.binary())])
PIECES = ("doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long, ids binary")


def _pack_lane(share: dict, sequence: int, window: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, carry: pa.Table) -> pa.Table:
        docs = docs.sort_by([("order", "ascending"), ("doc_id", "ascending")])
        doc_id, source, n, ids = (docs.column(c).to_pylist() for c in ("doc_id", "source", "n", "ids"))
        queues: dict = {}
        for i, s in enumerate(source):
            queues.setdefault(s, deque()).append([i, 0, n[i]])
        deficit = dict.fromkeys(share, 0.0)
        deficit.update(zip(carry.column("source").to_pylist(), carry.column("deficit").to_pylist()))
        width = len(ids[0]) // n[0] if n else 2
        narrow = np.dtype(f"<u{width}")

        def wide(x: bytes) -> bytes:
            return np.frombuffer(x, narrow).astype("<u4").tobytes()

        out, at = [], 0
        base = key[0].as_py() << 32
        for s, i, start, length in round_robin(queues, deficit, share, sequence * window):
            while length:                            # cut at the ends of sequences
                m = min(length, sequence - at % sequence)
                out.append((doc_id[i], s, start, m, n[i], base + at // sequence, at % sequence,
                            zlib.crc32(wide(ids[i][start * width:(start + m) * width])), ids[i][start * width:(start + m) * width]))
                start, length, at = start + m, length - m, at + m
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), SCHEMA.types)], schema=SCHEMA) if out \
            else SCHEMA.empty_table()
    return run


def deficits(cells: DataFrame, share: dict) -> DataFrame:
    """(lane, source, deficit) that all earlier lanes leave: target minus packed tokens of the source."""
    totals = cells.groupBy("lane").agg(F.sum("n").alias("lane_n"))
    owing = F.array(*[F.struct(F.lit(s).cast("string").alias("source"), F.lit(x).alias("share")) for s, x in share.items()])
    grid = totals.select("lane", "lane_n", F.inline(owing))      # every lane owes every source
    full = grid.join(cells.withColumnRenamed("lane", "l").withColumnRenamed("source", "s"),
                     (F.col("lane") == F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    owed = full.select("lane", "source", (F.col("share") * F.col("lane_n") - F.coalesce("n", F.lit(0))).alias("owed"),
                       F.floor(F.col("lane") / BLOCK).alias("block"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = owed.groupBy("block", "source").agg(F.sum("owed").alias("o")) \
        .select(F.col("block").alias("b"), F.col("source").alias("s"), F.coalesce(F.sum("o").over(before), F.lit(0.0)).alias("base"))
    inside = Window.partitionBy("source", "block").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    own = owed.withColumn("own", F.coalesce(F.sum("owed").over(inside), F.lit(0.0)))
    return own.join(blocks, (F.col("block") == F.col("b")) & F.col("source").eqNullSafe(F.col("s"))) \
        .select("lane", "source", (F.col("own") + F.col("base")).alias("deficit"))


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, window: int = WINDOW, lane_tokens: int = LANE,
         weights: dict | None = None) -> DataFrame:
    """Pieces (see ``PIECES``) of all documents. ``weights``: target share per source;
    by default each source's share of all tokens, so every window mirrors the whole."""
    tokens = stored(tokenize(docs, path).withColumn("order", F.xxhash64("doc_id", "ids")), "pack-tokens")
    per_source = {r["source"]: r["n"] for r in tokens.groupBy("source").agg(F.sum("n").alias("n")).collect()}   # a row per source
    lanes = max(1, -(-sum(per_source.values()) // lane_tokens))
    mass = weights or per_source
    every = sum(mass.get(s, 0) for s in per_source) or 1
    share = {s: mass.get(s, 0) / every for s in per_source} or {None: 0.0}
    dealt = tokens.withColumn("lane", F.pmod("order", F.lit(lanes)))
    cells = stored(dealt.groupBy("lane", "source").agg(F.sum("n").alias("n")), "pack-cells")
    return dealt.groupBy("lane").cogroup(deficits(cells, share).groupBy("lane")).applyInArrow(
        _pack_lane(share, sequence, window), PIECES)


def digest(pieces_: DataFrame) -> DataFrame:
    """The pieces with ids_crc32 (over little-endian unsigned 32-bit ids) in place of their ids."""
    return pieces_.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")
