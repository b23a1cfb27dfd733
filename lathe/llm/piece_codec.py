"""SentencePiece encoding by a merge-type prefix table, and decoding.

A merge-type (BPE) model never merges across the seam of two tokens that end up
side by side, so the tokens of a text's prefix are those of a shorter prefix and
one more: each prefix has one last token. An Aho-Corasick automaton gives the
pieces that end at a place; the last token is the one that comes out whole when
encoded alone and that is compatible with the last token of the prefix before
it. The table is filled from left to right, the ids are read from its end
backwards: linear in the text, however long its words are.

Two tokens are compatible if no merge across their seam gets its turn: the
merges of each, encoded alone, are replayed side by side, best score first and
leftmost on ties, and at each step the pair at the seam must have to wait.

Texts are cut where no piece of the vocabulary reaches across (before a space
mark, and between a word and a punctuation mark, as far as the vocabulary has it
so), and a worker remembers the ids of the parts it has met.

Defined results: a null or empty text has no ids and decodes to an empty text;
characters without a piece become their bytes' pieces; null doc_ids and repeated
rows are rows like any other; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathe.llm.common import pieces

#: The mark that stands for a space in a piece.
MARK = "▁"
#: Parts that a worker remembers, in each of two generations, and the longest one remembered.
REMEMBER, LONGEST = 400_000, 48
#: Pairs whose compatibility a worker remembers.
PAIRS = 1_000_000

_WORKER: dict = {}


class PieceEncoder:
    """Ids of texts under a merge-type SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.sp.get_piece_size())
        plain = [i for i in ids if not (self.sp.is_unknown(i) or self.sp.is_control(i) or self.sp.is_byte(i) or self.sp.is_unused(i))]
        self.ids = {self.sp.id_to_piece(i): i for i in plain}
        #: Of a merge's result: less is merged sooner.
        self.turn = {p: -self.sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = {self.sp.id_to_piece(i): i for i in ids if self.sp.is_byte(i)}
        if len(self.bytes) != 256:
            raise ValueError("a model with byte fallback is needed")
        self.replays: dict[str, list] = {}
        self.agree: dict[tuple[str, str], bool] = {}
        self.found = ahocorasick.Automaton()
        for p in self.ids:
            if len(p) > 1 and self._alone(p):
                self.found.add_word(p, p)
        self.found.make_automaton()
        self.cuts = re.compile(self._cuts())
        self.young: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _cuts(self) -> str:
        """Pattern of the parts that no piece reaches across: words and marks between spaces."""
        long = [p for p in self.ids if len(p) > 1]
        if any(MARK in p.lstrip(MARK) for p in long):
            return "(?s:.+)"
        single = "".join(c for c in "\n\t" if not any(c in p for p in long))
        pairs = {(a, b) for p in long for a, b in zip(p, p[1:]) if b in string.punctuation}
        bad = "".join(re.escape(a) for a in sorted({a for a, _ in pairs}) if re.match(r"[^\W\d_]", a))
        ends = re.escape(string.punctuation) + MARK + single
        return f"{MARK}*[^\\W\\d_{bad}]+(?=[{ends}]|\\Z)|{MARK}*[^{MARK}{single}]+|{MARK}+" + (f"|[{single}]" if single else "")

    # -------------------------------------------------------------- merges of one token, and of two
    def _replay(self, piece: str) -> list[tuple[float, str, str]]:
        """The merges that encode ``piece`` alone: (turn, first symbol after it, last symbol after it)."""
        symbols, out = list(piece), []
        while len(symbols) > 1:
            turn, at = min((self.turn.get(a + b, np.inf), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
            if turn == np.inf:
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            out.append((turn, symbols[0], symbols[-1]))
        self.replays[piece] = out
        return out

    def _alone(self, piece: str) -> bool:
        """Whether encoding ``piece`` alone gives ``piece``."""
        return len(self._replay(piece)) == len(piece) - 1

    def compatible(self, left: str, right: str) -> bool:
        """Whether no merge crosses the seam of ``left`` and ``right``, two pieces that come out whole alone."""
        if len(self.agree) >= PAIRS:
            self.agree.clear()
        mine, theirs = self.replays.get(left, ()), self.replays.get(right, ())
        i = j = 0
        a, b, fits = left[-1], right[0], True
        while True:
            seam = self.turn.get(a + b, np.inf)
            l_turn = mine[i][0] if i < len(mine) else np.inf
            r_turn = theirs[j][0] if j < len(theirs) else np.inf
            if seam != np.inf and seam < l_turn and seam <= r_turn:
                fits = False
                break
            if l_turn == r_turn == np.inf:
                break
            if l_turn <= r_turn:
                a, i = mine[i][2], i + 1
            else:
                b, j = theirs[j][1], j + 1
        self.agree[left, right] = fits
        return fits

    # -------------------------------------------------------------- the prefix table
    def tokens(self, text: str) -> list[str]:
        """Tokens of a normalised text, by the prefix table."""
        last, done, agree = ["", *text], 0, self.agree        # last[i]: last token of the first i characters
        for end, p in self.found.iter(text):
            if end >= done:                             # the pieces that end at a place come one after another
                at = end + 1 - len(p)
                fits = at == 0 or agree.get((last[at], p))
                if fits is None:
                    fits = self.compatible(last[at], p)
                if fits:
                    last[end + 1], done = p, end + 1
        out, n = [], len(text)
        while n:
            out.append(last[n])
            n -= len(last[n])
        out.reverse()
        return out

    def token_ids(self, text: str) -> list[int]:
        """Ids of a normalised text."""
        found = self.tokens(text)
        out = [self.ids.get(p) for p in found]
        if None in out:
            out = [x for p, i in zip(found, out) for x in ([i] if i is not None else [self.bytes[f"<0x{b:02X}>"] for b in p.encode()])]
        return out

    def of(self, text: str) -> bytes:
        """Ids of a raw text as 32-bit numbers."""
        young, older, out = self.young, self.older, []
        for c in self.cuts.findall(self.sp.normalize(text)):
            got = young.get(c)
            if got is None:
                got = older.get(c)
                if got is None:
                    got = np.array(self.token_ids(c), np.int32).tobytes()
                if len(c) <= LONGEST:
                    young[c] = got
            out.append(got)
        if len(young) > REMEMBER:
            self.older, self.young = young, {}
        return b"".join(out)


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder."""
    if path not in _WORKER:
        _WORKER[path] = PieceEncoder(path)
    return _WORKER[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text decoded from them, for every row of ``docs``."""
    def run(batches):
        e = encoder(path)
        for b in pieces(batches):
            ids = [e.of(t) for t in b.column(1).to_pylist()]
            numbers = [np.frombuffer(x, np.int32) for x in ids]
            ends = np.cumsum([0, *map(len, numbers)], dtype=np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
            decoded = pa.array([e.sp.decode(x.tolist()) if len(x) else "" for x in numbers], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), flat), decoded],
                                             names=["doc_id", "ids", "decoded"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 from :func:`encode`'s rows."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
