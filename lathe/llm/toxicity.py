"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

Channel: writers hide words by look-alike symbols (1d10t), by repeating letters
(idiooot) and by spacing letters out (i d i o t). Spans that look so become
character lattices: an input character stands for one of its look-alikes, for
nothing (a separator, or a repeat), or for itself, each at a cost. Viterbi finds
the best path under a character trigram model of the corpus; all documents teach
it (counts only), the table's size is fixed. Spans of any length are decoded whole, and
the words found are read beside them.

Score: documents are seen as sets of hashed byte n-grams inside words. Labelled
rows give each n-gram's log-odds of a toxic document; those with strong and
frequent evidence are kept, and a document's evidence is the sum over its
distinct ones. A logistic curve fitted on labelled rows left out of the
log-odds maps the evidence to a probability.

Defined results: a null or empty text has no evidence; rows without a label (or
with a null one) teach only the character model; without labelled rows of both
kinds every score is the share of toxic rows (0 without any); repeated rows get
equal results; an empty table gives an empty result; further columns are
ignored. The whole text counts.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import pieces, stored
from lathe.llm.language import MIX, id_hash

#: Look-alikes (fixed values).
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "aeiou", "%": "aeiou", "€": "e", "£": "l",
}
SEPARATORS = " .-_*~'\"`,/"
#: Symbols that may also just open a word.
OPENING = "(<"
SWAP, DROP, REPEAT = 1.0, 0.3, 0.7
#: Words with a symbol or digit inside letters; with a letter three times running; single characters spaced out.
ODD = re.compile(
    r"(?<!\S)(?=\S*[a-z])(?=\S*(?:[0-9@$!|+(<*#%€£]\S*[a-z]|[a-z]([a-z])\1\1|([a-z])\2\2))[a-z0-9@$!|+(<*#%€£]{3,}(?!\w)"
    r"|(?<!\S)[a-z0-9@$!*](?:[ .\-_*~]{1,2}[a-z0-9@$!*]){3,}(?!\w)", re.I)

STARTS = (3, 4, 5, 6, 7, 8, 9)
INNER = (5, 6)
TABLE = 1 << 19
#: Labelled documents of a class that are learned from (about; a bound of the sample).
TRAIN = 20_000
LEAST_DOCS = 5
LEAST_ODDS = 2.0
BINS = 256

_FOLD = np.full(256, 0, np.int64)               # 0: boundary; 1-26: letters; 27: any other byte
_FOLD[ord("a"):ord("z") + 1] = np.arange(1, 27)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_FOLD[128:] = 27
_LETTERS = 28


def trigram_counts(text: str) -> np.ndarray:
    """Counts of [28 x 28 x 28] symbol trigrams."""
    code = _FOLD[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    code = np.concatenate(([0, 0], code, [0]))
    return np.bincount((code[:-2] * _LETTERS + code[1:-1]) * _LETTERS + code[2:], minlength=_LETTERS ** 3)


def learn_letters(docs: DataFrame) -> np.ndarray:
    """-log P(symbol | two before) from all texts."""
    def count(batches):
        sums = np.zeros(_LETTERS ** 3, np.int64)
        for b in pieces(batches):
            for t in b.column(0).to_pylist():
                sums += trigram_counts(t or "")
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "n"])

    got = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "at long, n long") \
        .groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(_LETTERS ** 3)
    n[got.column("at").to_numpy()] = got.column("n").to_numpy()
    n = n.reshape(_LETTERS, _LETTERS, _LETTERS)
    low = (n.sum(0) + 0.5) / (n.sum(0).sum(1, keepdims=True) + 0.5 * _LETTERS)      # bigrams
    p = (n + 2.0 * low[None]) / (n.sum(2, keepdims=True) + 2.0)
    return -np.log(p)


def decode(span: str, cost: list) -> str:
    """The most likely word behind an odd span (Viterbi over (two letters before) states; a path is a chain of letters)."""
    beams: dict = {(0, 0): (0.0, None)}
    last = ""
    for ch in span.lower():
        new: dict = {}
        options = []
        if "a" <= ch <= "z":
            options.append((ch, 0.0))
        for x in LOOKALIKES.get(ch, ""):
            options.append((x, SWAP))
        separator = ch in SEPARATORS
        for (a, b), (c, path) in beams.items():
            for x, extra in options:
                k = ord(x) - 96
                total = c + extra + cost[a][b][k]
                key = (b, k)
                if key not in new or total < new[key][0]:
                    new[key] = (total, (path, x))
            opening = path is None and ch in OPENING
            silent = DROP if separator or opening else REPEAT if ch == last or (path and ch == path[1]) else None
            if silent is not None and ((a, b) not in new or c + silent < new[a, b][0]):
                new[a, b] = (c + silent, path)
        if new:
            beams = new
        last = ch
    path = min(((c + cost[a][b][0], path) for (a, b), (c, path) in beams.items()), key=lambda t: t[0])[1]
    out = []
    while path:
        path, x = path
        out.append(x)
    return "".join(reversed(out))


#: Longest span remembered.
SHORT = 64


class Restorer:
    """Restores odd spans of texts; remembers short spans it has seen (a bounded memory)."""

    def __init__(self, cost: np.ndarray):
        self.cost = cost.tolist()
        self.known = lru_cache(1 << 15)(lambda span: decode(span, self.cost))

    def word(self, span: str) -> str:
        return self.known(span) if len(span) <= SHORT else decode(span, self.cost)

    def __call__(self, text: str) -> str:
        return ODD.sub(lambda m: f"{m[0]} {self.word(m[0])} ", text)


def buckets(text: str) -> np.ndarray:
    """Distinct hashed byte n-grams of the words: beginnings of ``STARTS`` bytes, and ``INNER`` bytes anywhere."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    word = (code >= 128) | ((code >= 97) & (code <= 122))
    letter = np.where(word, code, 1).astype(np.uint64)
    gaps = np.concatenate(([0], np.cumsum(~word)))
    out, h = [], letter
    for n in range(2, max(STARTS) + 2):
        h = h[:len(letter) - n + 1] * MIX + letter[n - 1:]
        if not len(h):
            break
        rest = (gaps[n:] - gaps[1:len(gaps) - n + 1]) == 0            # all but the first character are letters
        whole = np.zeros(len(h), bool)
        if n - 1 in STARTS:
            whole |= rest & ~word[:len(h)]
        if n in INNER:
            whole |= rest & word[:len(h)]
        x = (h[whole] ^ (h[whole] >> np.uint64(31))) * MIX
        out.append((x >> np.uint64(32)).astype(np.int64) % TABLE)
    return np.unique(np.concatenate(out))


def learn_grams(rows: DataFrame, cost: np.ndarray) -> np.ndarray:
    """Log-odds of a toxic document per bucket, 0 where the evidence is weak; rows: (text, toxic)."""
    shared = rows.sparkSession.sparkContext.broadcast(cost)

    def count(batches):
        restore, sums = Restorer(shared.value), np.zeros((2, TABLE + 1), np.int64)
        for b in pieces(batches):
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[int(toxic), buckets(restore(text or ""))] += 1
                sums[int(toxic), TABLE] += 1
        flat = sums.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["at", "n"])

    got = rows.select("text", "toxic").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(2 * (TABLE + 1))
    n[got.column("at").to_numpy()] = got.column("n").to_numpy()
    clean, toxic = n.reshape(2, TABLE + 1)
    if not clean[-1] or not toxic[-1]:
        return np.zeros(TABLE, np.float32)
    odds = np.log((toxic[:-1] + 0.5) / (toxic[-1] + 1)) - np.log((clean[:-1] + 0.5) / (clean[-1] + 1))
    return np.where((toxic[:-1] >= LEAST_DOCS) & (odds >= LEAST_ODDS), odds, 0.0).astype(np.float32)


def evidence(rows: DataFrame, cost: np.ndarray, odds: np.ndarray) -> DataFrame:
    """``rows`` (text last) with the summed log-odds of the restored text in place of the text."""
    shared = rows.sparkSession.sparkContext.broadcast((cost, odds))
    names = rows.columns

    def run(batches):
        restore = Restorer(shared.value[0])
        for b in pieces(batches):
            got = [float(shared.value[1][buckets(restore(t or ""))].sum()) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.float64())], names=[*names[:-1], "evidence"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, evidence double")


def calibrate(found: DataFrame) -> tuple[float, float]:
    """Logistic curve (at, slope) over log(1 + evidence) of (toxic, evidence) rows, from a histogram."""
    x = F.least(F.floor(F.log1p("evidence") * BINS / 12), F.lit(BINS - 1))
    got = found.groupBy("toxic", x.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    xs = np.array([(r["bin"] + 0.5) * 12 / BINS for r in got])
    y, w = np.array([float(r["toxic"]) for r in got]), np.array([float(r["n"]) for r in got])
    if not len(got) or not (y * w).sum() or not ((1 - y) * w).sum():
        share = float((y * w).sum() / w.sum()) if len(got) else 0.0
        return (math.log(share / (1 - share)) if 0 < share < 1 else 40.0 * (1 if share else -1)), 0.0
    a = np.stack([np.ones_like(xs), xs])
    beta = np.zeros(2)
    for _ in range(50):                       # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a.T @ beta, -40, 40)))
        step = np.linalg.solve((a * (w * p * (1 - p))) @ a.T + 0.1 * np.eye(2), a @ (w * (y - p)) - 0.1 * beta)
        beta = beta + np.clip(step, -2, 2)
    return float(beta[0]), float(beta[1])


def toxicity(docs: DataFrame, labels: DataFrame, at: float = 0.7, train: int = TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_hash().alias("h"), F.col("text").cast("string").alias("text"))
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")) \
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(id_hash("id") % 3 != 1)
    known = stored(known, "toxic-labels")
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chance = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000)) / 1e6
    chosen = known.where(chance < F.when(F.col("toxic") == 1, min(1.0, train / max(1, sizes.get(1, 0)))).otherwise(
        min(1.0, train / max(1, sizes.get(0, 0)))))
    chosen = stored(chosen, "toxic-sample")     # about 2 * train ids at most: that bound lets it be broadcast
    cost = learn_letters(docs)
    taught = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "toxic", "text")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(4))
    odds = learn_grams(taught.where(fold != 0), cost)
    shift, slope = calibrate(evidence(taught.where(fold == 0).select("toxic", "text"), cost, odds))
    found = evidence(rows.select("doc_id", "h", "text"), cost, odds)
    z = F.lit(shift) + F.lit(slope) * F.log1p("evidence")
    score = 1 / (1 + F.exp(-z))
    return found.select("doc_id", (F.col("h") % 3 == 1).alias("held_out"), score.alias("score"),
                        (score >= at).cast("int").alias("predicted"), "evidence")
