"""Cross-tokenizer alignment: groups and links of two tokenizers' tokens over the same bytes.

Both tokenizers' tokens are laid over the bytes of a text. The ends of each
side's tokens become a dictionary from end to index; the ends that both have
(an intersection of hash sets), sorted, slice both id lists into groups, and
inside a slice the overlapping tokens are linked.

Neither tokenizer reaches across the cuts of a text before white space and
between a word and a punctuation mark, so both have an end there, and a text's
alignment is that of its parts one after another. A block of documents keeps a
list of its different parts, each aligned once; a document is the list of its
parts' places. Corpus-wide, a block hands up each id pair once with its count:
pairs are summed by an aggregate, the highest count of each B id (at most its
vocabulary) is broadcast, and the sums come back to the blocks by a join on the
pair, which holds a pair at most once a block, so no key is hot.

Defined results: a null or empty text, or one whose tokens' bytes differ from the
text, has no tokens: zeros and an empty ``groups``; null doc_ids and repeated rows
are rows like any other and all count; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import string
from array import array
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import partitions, pieces, stored
from lathe.llm.piece_codec import MARK, PieceEncoder

#: Characters of text in a block.
BLOCK = 8 << 20
#: Parts whose alignment a worker remembers, in each of two generations, and the longest one remembered.
REMEMBER, LONGEST = 200_000, 48

ROWS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, parts binary, "
        "pairs array<long>, counts array<long>, starts binary, links binary")
SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, groups_sha256 string"
ARROW = pa.schema([("block", pa.int64()), *[(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                   ("groups", pa.string()), ("groups_sha256", pa.string()), ("parts", pa.binary()), ("pairs", pa.list_(pa.int64())),
                   ("counts", pa.list_(pa.int64())), ("starts", pa.binary()), ("links", pa.binary())])

_WORKER: dict = {}


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters stand
    for themselves, the other bytes for the characters from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def slices(a_ends: list[int], b_ends: list[int]):
    """(from, to) in A's and in B's tokens of each group: the tokens between two ends that both sides have."""
    at_a, at_b = dict(zip(a_ends, range(1, len(a_ends) + 1))), dict(zip(b_ends, range(1, len(b_ends) + 1)))
    i = j = 0
    for end in sorted(at_a.keys() & at_b.keys()):
        k, m = at_a[end], at_b[end]
        yield i, k, j, m
        i, j = k, m


def linked(i: int, k: int, j: int, m: int, a_ends: list[int], b_ends: list[int]):
    """Index pairs of the tokens of one group that overlap: a[i:k] and b[j:m]."""
    while i < k and j < m:
        yield i, j
        over = a_ends[i] - b_ends[j]
        i += over <= 0
        j += over >= 0


class Aligner:
    """Groups and links of texts' parts under a byte-level BPE (A) and a SentencePiece model (B)."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        byte = byte_of_char()
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        #: Bytes of each id's token; a token with a character that stands for no byte never comes out of a text.
        self.a_size = [len(names[i]) if i in names and all(c in byte for c in names[i]) else 1 << 40 for i in range(max(names) + 1)]
        self.b = PieceEncoder(piece_bpe)
        self.b_size = [1] * self.b.sp.get_piece_size()
        for p, i in self.b.ids.items():
            self.b_size[i] = len(p.replace(MARK, " ").encode())
        self.say = list(map(str, range(max(len(self.a_size), len(self.b_size)))))
        long = [p for p in self.b.ids if len(p) > 1]
        letters = f"A-Za-z{chr(0xc0)}-{chr(0xd6)}{chr(0xd8)}-{chr(0xf6)}{chr(0xf8)}-{chr(0xff)}"
        own_words = not any(re.search(f"[{letters}][{re.escape(string.punctuation)}]", p) for p in long)
        can_cut = not any(re.search(f"[^{MARK}]{MARK}|[\n\t]", p) for p in long)
        word = f"[ \n\t]*[{letters}]+(?=[{re.escape(string.punctuation)} \n\t]|\\Z)|" if own_words else ""
        self.cuts = re.compile(f"{word}[ \n\t]*[^ \n\t]+|[ \n\t]+")
        # white space that the two tokenizers or this pattern take differently: such a text is one part
        self.whole = re.compile("[^\\S \n\t]|[\x1c-\x1f\x85]" if can_cut else "(?s:.)")
        self.young: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def parts(self, text: str) -> list[str]:
        """Parts of space + text; none if text is empty or B's bytes must differ from it."""
        full = " " + text
        if not text or self.b.sp.normalize(text).replace(MARK, " ") != full:
            return []
        return [full] if self.whole.search(text) else self.cuts.findall(full)

    def align(self, part: str, a: list[int]) -> tuple:
        """(tokens of A, tokens of B, groups, groups as text, linked id pairs) of a part; None for the text if the bytes differ.

        Both sides' tokens are consecutive pieces of the part's bytes, so they are all of them if they are as many."""
        b = self.b.token_ids(part.replace(" ", MARK))
        a_ends, b_ends = list(accumulate([self.a_size[i] for i in a])), list(accumulate([self.b_size[i] for i in b]))
        if not a or not b or not a_ends[-1] == b_ends[-1] == len(part.encode()):
            return (0, 0, 0, None, b"")
        say, groups, pairs = self.say, [], []
        for i, k, j, m in slices(a_ends, b_ends):
            if k - i == 1 == m - j:
                groups.append(f"{say[a[i]]}|{say[b[j]]}")
                pairs.append(b[j] << 32 | a[i])
            else:
                groups.append(f"{','.join([say[x] for x in a[i:k]])}|{','.join([say[x] for x in b[j:m]])}")
                pairs += [b[y] << 32 | a[x] for x, y in linked(i, k, j, m, a_ends, b_ends)]
        return len(a), len(b), len(groups), ";".join(groups), array("q", pairs).tobytes()

    def learn(self, parts: list[str]) -> list[tuple]:
        young, older = self.young, self.older
        out = [young.get(p) or older.get(p) for p in parts]
        new = [i for i, x in enumerate(out) if x is None]
        for at in range(0, len(new), 1024):
            some = new[at:at + 1024]
            for i, e in zip(some, self.a.encode_batch_fast([parts[i] for i in some], add_special_tokens=False)):
                out[i] = self.align(parts[i], e.ids)
        if len(young) > REMEMBER:
            self.older, self.young = young, {}
        self.young.update((p, x) for p, x in zip(parts, out) if len(p) <= LONGEST)
        return out


def aligner(byte_bpe: str, piece_bpe: str) -> Aligner:
    """This worker's aligner."""
    if (byte_bpe, piece_bpe) not in _WORKER:
        _WORKER[byte_bpe, piece_bpe] = Aligner(byte_bpe, piece_bpe)
    return _WORKER[byte_bpe, piece_bpe]


def _block(number: int, ids: list, docs: list[list[int]], learned: list[tuple], keep_groups: bool) -> pa.RecordBatch:
    """A block's documents and, in its last row, its id pairs with their counts and its parts' links (starts and places among the pairs)."""
    sizes = np.array([x[:3] for x in learned], np.int64).reshape(-1, 3)
    texts = [x[3] for x in learned]
    lengths = np.array([len(x[4]) // 8 for x in learned], np.int64)
    pairs, links = np.unique(np.frombuffer(b"".join(x[4] for x in learned), np.int64), return_inverse=True)
    times = np.zeros(len(learned), np.int64)
    rows = []
    for doc_id, places in zip(ids, docs):
        places = np.array(places, np.int32)
        said = [texts[i] for i in places.tolist()]
        if not said or None in said:
            rows.append((number, doc_id, 0, 0, 0, 0, "" if keep_groups else None, "", b"", None, None, None, None))
            continue
        np.add.at(times, places, 1)
        n_a, n_b, n_groups = sizes[places].sum(0).tolist()
        groups = ";".join(said)
        rows.append((number, doc_id, n_a, n_b, n_groups, int(lengths[places].sum()), groups if keep_groups else None,
                     hashlib.sha256(groups.encode()).hexdigest(), places.tobytes(), None, None, None, None))
    counts = np.bincount(links, np.repeat(times, lengths), len(pairs)).astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    rows.append((number, None, None, None, None, None, None, None, None, pairs.tolist(), counts.tolist(),
                 starts.astype(np.int32).tobytes(), links.astype(np.int32).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ARROW.types)], schema=ARROW)


def aligned_blocks(docs: DataFrame, byte_bpe: str, piece_bpe: str, keep_groups: bool = False) -> DataFrame:
    def run(batches):
        al = aligner(byte_bpe, piece_bpe)
        number = TaskContext.get().partitionId() << 32
        ids, places, local, size = [], [], {}, 0
        for b in pieces(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(doc_id)
                places.append([local.setdefault(p, len(local)) for p in al.parts(text)])
                size += len(text)
                if size >= BLOCK:
                    yield _block(number, ids, places, al.learn(list(local)), keep_groups)
                    ids, places, local, size, number = [], [], {}, 0, number + 1
        if ids:
            yield _block(number, ids, places, al.learn(list(local)), keep_groups)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, ROWS)


def pair_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, pair) rows, and (pair, n, best): links that hold the pair, and whether no pair of its B id has more."""
    held = blocks.where(F.col("pairs").isNotNull()).select("block", F.inline(F.arrays_zip("pairs", "counts"))) \
        .where(F.col("counts") > 0)
    counts = stored(held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("n")), "align-pairs")
    b = F.shiftright("pair", 32).alias("b")
    most = counts.groupBy(b).agg(F.max("n").alias("most"))          # one row per B id: at most its vocabulary
    return held.select("block", F.col("pairs").alias("pair")), counts.withColumn("b", b).join(F.broadcast(most), "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_bpe: str, piece_bpe: str, keep_groups: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, with
    ``keep_groups``, the groups as text (``a1,a2|b1;a3|b2,b3``; else null)."""
    spark = docs.sparkSession
    blocks = stored(aligned_blocks(docs, byte_bpe, piece_bpe, keep_groups), "align-blocks")
    held, counts = pair_counts(blocks)
    scores = held.join(counts, "pair").select("block", F.lit(0).alias("kind"), "pair", F.col("n"), F.col("best").cast("long").alias("best"))
    rest = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "parts", "pairs", "starts", "links"]
    kind = F.when(F.col("pairs").isNotNull(), 1).otherwise(2)
    rows = scores.unionByName(blocks.select("block", kind.alias("kind"), *rest), allowMissingColumns=True)
    dealt = rows.repartition(partitions(spark), "block").sortWithinPartitions("block", "kind", "pair")
    return dealt.select("kind", "pair", "n", "best", *rest).mapInArrow(_score, SCORED)


def _score(batches):
    """Scored documents from a stream of each block's pair scores, its parts' links, and its documents."""
    pair, n, best, part_n, part_best = [], [], [], None, None
    for b in pieces(batches, 8192):
        kind = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(kind)) + 1).tolist(), len(kind)]
        for at, to in zip(cuts, cuts[1:]):
            rows = b.slice(at, to - at)
            if kind[at] == 0:
                for store, c in zip((pair, n, best), (1, 2, 3)):
                    store.append(rows.column(c).to_numpy())
            elif kind[at] == 1:
                for r in rows.select(["pairs", "starts", "links"]).to_pylist():
                    part_n, part_best = _of_parts(r, pair, n, best)
                    pair, n, best = [], [], []
            else:
                places = [np.frombuffer(x, np.int32) for x in rows.column("parts").to_pylist()]
                out = {c: rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
                out["n_best"] = pa.array([int(part_best[x].sum()) for x in places], pa.int64())
                out["count_sum"] = pa.array([int(part_n[x].sum()) for x in places], pa.int64())
                yield pa.RecordBatch.from_pydict(out | {c: rows.column(c) for c in ("groups", "groups_sha256")})


def _of_parts(block: dict, pair: list, n: list, best: list) -> tuple[np.ndarray, np.ndarray]:
    """Sums over each part's links of the pairs' counts and of the pairs that are best."""
    every = np.array(block["pairs"], np.int64)
    starts, links = (np.frombuffer(block[c], np.int32) for c in ("starts", "links"))
    if not pair:
        return np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    at = np.searchsorted(every, np.concatenate(pair))              # pairs without a link in use score nothing
    out = []
    for x in (n, best):
        value = np.zeros(len(every), np.int64)
        value[at] = np.concatenate(x)
        total = np.concatenate([[0], np.cumsum(value[links])])
        out.append(np.diff(total[np.append(starts, len(links))]))
    return out[0], out[1]


def digest(rows: DataFrame) -> DataFrame:
    """The query's columns of :func:`align`'s rows."""
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
