"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed 1- to 4-grams per language are summed over a bounded sample of
the labelled documents, at most about ``TRAIN`` of each language (chosen by a
hash of the id). The log-probability matrix, languages x ``BUCKETS``, is
broadcast, and batches of documents are scored in numpy by gathering its rows.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text when there is no labelled document; null langs teach
nothing; repeated rows get equal results; an empty table gives an empty result;
further columns are ignored. The whole text counts, in bounded pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import pieces

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
#: Documents of a language that are learned from (about; a bound of the sample).
TRAIN = 4000
#: Added to every count.
SMOOTH = 0.5
PIECE = 1 << 17
MIX = np.uint64(0x9E3779B97F4A7C15)


def id_hash(col: str = "doc_id") -> Column:
    """crc32 of the id as text (null: of the empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def grams(text: str):
    """Yield arrays of n-gram buckets of the lower-cased text, piece by piece."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    for at in range(0, len(code), PIECE):
        piece = code[at:at + PIECE + max(ORDERS) - 1]
        h = np.zeros(len(piece), np.uint64)
        for n in ORDERS:
            h = h[:len(piece) - n + 1] * MIX + piece[n - 1:]
            if not len(h):
                break
            mixed = (h ^ (h >> np.uint64(31))) * MIX
            yield (mixed >> np.uint64(48)).astype(np.int64)[:PIECE] % BUCKETS


def learn(docs: DataFrame, train: int = TRAIN) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [BUCKETS x languages]) from the rows given."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, train / sizes[k]))])
    chance = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1_000_000)) / 1e6
    sample = rows.where(chance < F.element_at(share, F.col("lang"))).select("lang", "text")

    def count(batches):
        sums = {}
        for b in pieces(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for ids in grams(text):
                    own += np.bincount(ids, minlength=BUCKETS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])],
                                             names=["lang", "bucket", "n"])

    counts = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    n = np.full((BUCKETS, len(langs)), SMOOTH)
    place = {k: i for i, k in enumerate(langs)}
    n[counts.column("bucket").to_numpy(), [place[k] for k in counts.column("lang").to_pylist()]] += counts.column("n").to_numpy()
    return langs, np.log(n / n.sum(axis=0)).astype(np.float32)


def score(text: str | None, langs: list[str], logp: np.ndarray) -> tuple[str, float]:
    """Language and its posterior."""
    if not langs or text is None or not any(map(str.isalpha, text)):
        return "und", 0.0
    total = np.zeros(len(langs))
    for ids in grams(text):
        total += logp[ids].sum(axis=0, dtype=np.float64)
    p = np.exp((total - total.max()) / sum(ORDERS))      # a character lies in so many n-grams: it counts once
    best = int(total.argmax())
    return langs[best], float(p[best] / p.sum())


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """(doc_id, h, lang_pred, score), one row per row of ``docs``; h: hash of the id."""
    langs, logp = model
    shared = docs.sparkSession.sparkContext.broadcast(logp)

    def run(batches):
        for b in pieces(batches):
            got = [score(t, langs, shared.value) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())],
                names=["doc_id", "h", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), id_hash().alias("h"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, h long, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 5, train: int = TRAIN) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that aren't held out."""
    model = learn(docs.where(id_hash() % folds != 0), train)
    return predict(docs, model).select("doc_id", (F.col("h") % folds == 0).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.3, train: int = TRAIN) -> DataFrame:
    """``docs`` without the rows whose language can't be told (``und``, or a score below ``least``)."""
    langs, logp = learn(docs.where(id_hash() % 5 != 0), train)
    shared = docs.sparkSession.sparkContext.broadcast(logp)

    place = docs.columns.index("text")

    def told(batches):
        for b in pieces(batches):
            keep = [score(t, langs, shared.value)[1] >= least for t in b.column(place).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(told, docs.schema)
