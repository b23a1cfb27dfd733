"""Conversation repair, cross-tokenizer alignment and SentencePiece coding against brute force."""
import hashlib
import random
import zlib
from collections import Counter
from functools import cache

import public_tokenizers
import pytest
import sentencepiece

from lathe.llm import alignment, conversation_repair, piece_codec

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SPACES = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ texts
@pytest.fixture(scope="module")
def texts(spark, odd):
    r = random.Random(5)
    hard = ["<s> </s><unk><0x41> <|endoftext|>", "a▁b", "na\xefve é \U0001f642\U0001f642 中文 ퟿", "tab\there\r\nand  two   spaces \n\n end \n ",
            "x y　z\x1cw", "it's we'll (foo.bar), \"q\"!? a1b2 m².", "=" * 300 + "-" * 77, "aaaa" * 400, "  lead", " ", "\n", "\x00z", "don't.'s"]
    alphabet = "  \n\tabcdeABz'.,;!\r▁\xe9ß中09<>"
    hard += ["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(150)]
    rows = [(1000 + i, t, "x") for i, t in enumerate(hard)]
    return odd.select("doc_id", "text", "source").unionByName(spark.createDataFrame(rows, "doc_id long, text string, source string")) \
        .selectExpr("*", "1 AS block", "2 AS n_a", "3 AS pairs", "4 AS ids").repartition(3)


def test_pieces_equal_the_library(texts, corpus):
    sp = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    for docs in (texts, corpus):
        want = Counter()
        for r in docs.select("doc_id", "text").collect():
            ids = sp.encode(r.text or "")
            want[r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids) if ids else "")] += 1
        assert Counter(map(tuple, piece_codec.digest(piece_codec.encode(docs, B_PATH)).collect())) == want


def test_pieces_of_an_empty_table(empty):
    assert piece_codec.digest(piece_codec.encode(empty, B_PATH)).collect() == []


def test_memory_of_parts_turns_over(corpus, monkeypatch):
    monkeypatch.setattr(piece_codec, "REMEMBER", 50)
    e = piece_codec.PieceEncoder(B_PATH)
    for r in corpus.select("text").limit(30).collect():
        assert e.of(r.text or "") == b"".join(i.to_bytes(4, "little") for i in e.sp.encode(r.text or ""))


# ------------------------------------------------------------------ alignment
def brute_alignment(rows):
    from tokenizers import Tokenizer
    a_tok = Tokenizer.from_file(A_PATH)
    a_tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    byte = alignment.byte_of_char()
    a_bytes = {i: bytes(byte[c] for c in t) for t, i in a_tok.get_vocab(with_added_tokens=False).items()}

    def b_bytes(i):
        return bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()

    docs, count = [], Counter()
    for doc_id, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        data = (" " + (text or "")).encode()
        if not text or b"".join(map(a_bytes.get, a)) != data or b"".join(map(b_bytes, b)) != data:
            docs.append((doc_id, [], [], [], []))
            continue
        spans = []
        for ids, of in ((a, a_bytes.get), (b, b_bytes)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(of(i)), i))
                at += len(of(i))
            spans.append(out)
        links, start = [], 0
        for lo, hi, i in spans[0]:
            while start < len(spans[1]) and spans[1][start][1] <= lo:
                start += 1
            j = start
            while j < len(spans[1]) and spans[1][j][0] < hi:
                links.append((i, spans[1][j][2]))
                j += 1
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, lo = [], 0
        for hi in common:
            groups.append("|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= hi) for side in spans) if len(common) < 400 else None)
            lo = hi
        docs.append((doc_id, a, b, groups, links))
        count.update(links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return Counter((d, len(a), len(b), len(g), len(x), sum(count[p] == most[p[1]] for p in x), sum(count[p] for p in x),
                    None if None in g else sha(";".join(g)) if a else "") for d, a, b, g, x in docs)


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_alignment_equals_brute_force(texts, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    want = brute_alignment([(r.doc_id, r.text) for r in texts.select("doc_id", "text").collect()])
    long = {x[:7] for x in want if x[7] is None}                # groups of the longest texts are counted, not spelt out
    got = Counter(tuple(r)[:7] + (None,) if tuple(r)[:7] in long else tuple(r)
                  for r in alignment.digest(alignment.align(texts, A_PATH, B_PATH)).collect())
    assert got == want


def test_alignment_keeps_groups_and_takes_an_empty_table(spark, empty):
    one = spark.createDataFrame([(1, "Hello, world")], "doc_id long, text string")
    r = alignment.align(one, A_PATH, B_PATH, keep_groups=True).first()
    assert sha(r.groups) == r.groups_sha256 and r.groups.count(";") == r.n_groups - 1
    assert alignment.digest(alignment.align(empty, A_PATH, B_PATH)).collect() == []


# ------------------------------------------------------------------ conversations
def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute_repair(rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.strip(SPACES)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        turn = STEP.get((state, "u")) or STEP.get((state, "a"))
        full = {"u": "user", "a": "assistant"}[turn]
        if inserted < 2:
            c, a, t = best(i, turn, inserted + 1) or (None, 0, 0)
            ways += [] if c is None else [(c + 2, "I" + a, (full + ":", *t))]
        if i < len(rows):
            role, text = rows[i][2:]
            late = faults[i] == "truncated"
            for cost, mark, to, line in ((3, "D", state, ()), (0 + late, "K", STEP.get((state, role[:1])), (f"{role}:{text}",)),
                                         (2 + late, "R", turn, (f"{full}:{text}",))):
                if to is None or mark != "D" and faults[i] in ("blank", "duplicate"):
                    continue
                rest = best(i + 1, to, 0)
                if rest:
                    ways.append((cost + rest[0], mark + rest[1], (*line, *rest[2])))
        return min(ways, default=None)

    for i in range(len(rows), -1, -1):
        for s in ("", "s", "u", "a"):
            best(i, s, 2), best(i, s, 1), best(i, s, 0)
    cost, audit, lines = best(0, "", 0)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines))), lines


def talks():
    r = random.Random(11)
    said = ["Yes.", "No!", "why", " ", "", "So it is. ", "\t\n", "And then?", None, "\xa0", "fin.\n"]
    role = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher", "S"]
    rows = [(c, t if r.random() > .05 else r.choice([None, t - 1]), r.choice(role[:5] if c % 3 else role), r.choice(said) if r.random() < .5 else f"{r.random()}.")
            for c in range(120) for t in range(r.randint(1, 9))]
    rows += [(None, t, "user", "of nobody.") for t in range(5)] + [(None, None, "user", None)] + [(500, None, "assistant", "x.")] * 3
    rows += [(501, 3, "user", "w " * 100_000 + ".")] + [(502, t, r.choice(["user", "assistant"]), r.choice(["a.", "b.", "c", f"{t}."])) for t in range(300)]
    return rows + [(503, 2 ** 40, "user", "far."), (503, -5, "assistant", "before.")]


TALKS = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def talk_table(spark):
    return spark.createDataFrame(talks(), TALKS).selectExpr("*", "1 AS at", "2 AS key", "3 AS n", "4 AS fault", "5 AS head", "6 AS s", "7 AS kind")


@pytest.mark.parametrize("stretch", [512, 4])
def test_repair_equals_brute_force(talk_table, monkeypatch, stretch):
    monkeypatch.setattr(conversation_repair, "STRETCH", stretch)
    groups = {c: [] for c, *_ in talks()}
    for row in brute_damage(talks()):
        groups[row[0]].append(row)
    want = {c: brute_repair(rows)[0] for c, rows in groups.items()}
    got = conversation_repair.repair(conversation_repair.damage(talk_table), talk_table).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id


def test_repaired_rows(talk_table):
    groups = {}
    for c, *row in talks():
        groups.setdefault(c, []).append((c, row[0], *(" " if x is None else x for x in row[1:])))
    got = {}
    for r in conversation_repair.repaired(talk_table).orderBy("position").collect():
        got.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for c, rows in groups.items():
        assert tuple(got.get(c, ())) == brute_repair(rows)[1]


def test_stretches_join_to_the_same_audit():
    r = random.Random(2)
    for _ in range(200):
        rows = [(r.choice("suax"), r.randrange(4), r.choice([0, 0, 2])) for _ in range(r.randint(1, 12))]
        whole = min(conversation_repair.lightest(rows, conversation_repair.COMPLETE, (0,)).values())
        value = {0: (0, "")}
        while rows:
            n = r.randint(1, len(rows))
            value = conversation_repair.joined(value, {q: conversation_repair.lightest(rows[:n], (q,), (0, 1, 2, 3)) for q in range(4)})
            rows = rows[n:]
        assert min(value[q] for q in conversation_repair.COMPLETE if q in value) == whole


def test_repair_of_an_empty_table(spark):
    none = spark.createDataFrame([], TALKS)
    assert conversation_repair.repair(conversation_repair.damage(none), none).collect() == []
    assert conversation_repair.repaired(none).collect() == []
