"""Each dealt operator against a brute-force version, on odd rows and on an empty table."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lathe.llm import exact_dedup, language, line_dedup, mixing, packing, quality, simhash, substring_dedup, toxicity, url_filter
from lathe.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def low(x):
    return -1 if x is None else x


@pytest.mark.parametrize("name", ["odd", "corpus", "empty"])
def test_exact_dedup(name, request):
    docs = request.getfixturevalue(name)
    groups = defaultdict(list)
    for i, t, _ in rows_of(docs):
        groups[(t or "").translate(LOWER)].append(i)
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == sum(map(len, groups.values()))
    by = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in got:
        ids = by[r["text_sha256"]]
        assert r["group_size"] == len(ids) and low(r["keep_id"]) == max(map(low, ids))
        if r["kept"]:
            assert r["doc_id"] == r["keep_id"]
            kept[r["text_sha256"]] += 1
    assert set(kept) == set(by) and set(kept.values()) <= {1}
    left = exact_dedup.drop_duplicates(docs)
    assert left.count() == len(by) and left.columns == docs.columns


def line_brute(rows):
    docs = defaultdict(set)
    key = lambda x: x.strip(SPACE).translate(LOWER)
    for i, t, _ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                docs[key(x)].add(low(i))
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (len(docs.get(key(x), ())) >= 5 and max(docs[key(x)]) != low(i))]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("name", ["odd", "corpus", "empty"])
def test_line_dedup(name, request):
    docs = request.getfixturevalue(name)
    got = line_dedup.digest(line_dedup.line_dedup(docs))
    assert sorted(map(tuple, got.collect()), key=str) == line_brute(rows_of(docs))


def test_line_dedup_hot_key_over_many_ranges(spark):
    line = "the very same line, which is found in every document of all"
    docs = spark.range(3000).selectExpr("id AS doc_id", f"concat('{line}', '\n', id, '\n', '{line}') AS text", "'s' AS source")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = line_dedup.digest(line_dedup.line_dedup(docs)).collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r["doc_id"]: r["n_dropped"] for r in got} == {i: 0 if i == 2999 else 2 for i in range(3000)}


def streamed(rows, min_docs=5):
    """Rows of each key and state from one range of (key, doc descending)."""
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), line_dedup.SCHEMA.types)],
                                       names=["key", "doc", "th", "pos"])
    got = defaultdict(list)
    for b in line_dedup.stream_ranges(min_docs)(iter([batch.slice(0, 5), batch.slice(5)])):
        for k, d, _, p, state, n in zip(*(c.to_pylist() for c in b.columns)):
            got[k, state].append((d, n) if state == line_dedup.COUNT else (d, p))
    return got


def test_line_dedup_key_cut_by_a_range_end():
    rows = [(b"A", 3, 0, 0), (b"B", 9, 0, 0), *[(b"B", d, 0, 0) for d in (8, 7, 6, 5)],
            (b"K", 90, 0, 0), (b"K", 90, 0, 2), *[(b"K", d, 0, 0) for d in (80, 70, 60, 50, 40)]]
    got = streamed(rows)
    assert got[b"K", line_dedup.EDGE] == [(90, 0), (90, 2)]           # a larger document may follow
    assert got[b"K", line_dedup.GOES] == [(d, 0) for d in (80, 70, 60, 50, 40)]
    assert got[b"K", line_dedup.COUNT] == [(90, 6)]
    assert got[b"B", line_dedup.GOES] == [(d, 0) for d in (8, 7, 6, 5)] and not got[b"B", line_dedup.EDGE]


@pytest.mark.parametrize("ranges", [2, 3, 5, 8, 13])
def test_line_dedup_hot_key_that_starts_in_mid_range(spark, ranges):
    lines = [f"line number {i} that many of the documents have in common" for i in range(12)]
    rows = [(d, "\n".join([x for i, x in enumerate(lines) if i == 6 or d % (i + 2) == 0] + [f"own {d}"]), "s") for d in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    got = line_dedup.digest(line_dedup.line_dedup(docs)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(tuple, got), key=str) == line_brute(rows)


def quality_brute(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    hit = {i + k for i in range(len(ws) - 7) if runs[tuple(ws[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if x.strip(SPACE)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


@pytest.mark.parametrize("name", ["odd", "corpus", "empty"])
def test_quality_rules(name, request):
    docs = request.getfixturevalue(name)
    got = quality.quality_rules(docs, max_docs=5).collect()
    want = sorted([(i, *quality_brute(t)) for i, t, _ in rows_of(docs)], key=str)
    assert sorted([(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got], key=str) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    if name == "odd":
        assert all(r["removed_chars"] == 55 for r in got if r["doc_id"] and r["doc_id"] >= 10)


@pytest.mark.parametrize("name", ["odd", "corpus", "empty"])
def test_quality_clean(name, request):
    docs = request.getfixturevalue(name)
    key = lambda x: x.strip(SPACE).translate(LOWER)
    found = Counter((s, k) for _, t, s in rows_of(docs) for k in {key(x) for x in (t or "").split("\n")} if k)
    want = []
    kept = Counter(r["doc_id"] for r in quality.quality_rules(docs, max_docs=5, min_left=0.0).collect() if r["kept"])
    for i, t, s in rows_of(docs):
        if i in kept:
            want.append((i, "\n".join(x for x in (t or "").split("\n") if found[s, key(x)] <= 5), s))
    got = quality.clean(docs, max_docs=5, min_left=0.0)
    assert got.columns == docs.columns
    assert sorted(rows_of(got), key=str) == sorted(want, key=str)


def test_quality_clean_removes_common_lines_only(spark):
    own = " ".join(f"word{i}" for i in range(30))
    rows = [(i, f" Shared LINE\n\n{own} {i}\nshared line", "a") for i in range(7)] + [(7, f"shared line\n{own}", "b"), (7, f"shared line\n{own}", "b")]
    got = quality.clean(spark.createDataFrame(rows, "doc_id long, text string, source string"), max_docs=6)
    assert sorted(rows_of(got)) == [(i, f"\n{own} {i}", "a") for i in range(7)] + [(7, f"shared line\n{own}", "b")] * 2


@pytest.mark.parametrize("name", ["odd", "corpus", "empty"])
def test_simhash(name, request):
    docs = request.getfixturevalue(name)
    got = simhash.near_dedup(docs).collect()
    assert len(got) == docs.count()
    texts = rows_of(docs)
    fps = [(i, simhash.fingerprint(t)) for i, t, _ in texts]
    assert Counter((r["doc_id"], r["fp"] % (1 << 64)) for r in got) == Counter(fps)
    distinct = sorted({f for _, f in fps})
    root = {f: f for f in distinct}
    changed = True
    while changed:
        changed = False
        for a in distinct:
            for b in distinct:
                if (a ^ b).bit_count() <= 4 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    least = {}
    for i, f in fps:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    for r in got:
        assert r["component_id"] == least.get(root[r["fp"] % (1 << 64)])


def test_near_copies_with_repeated_doc_ids(spark):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(60)) for w in ("pear", "rock", "lamp", "fish"))
    rows = [(1, a), (5, a), (5, b), (3, b), (7, c), (7, c), (7, c.upper()), (None, d), (None, d), (None, a), (9, None), (9, "")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(((i, (t or "").lower()) for i, t, _ in rows_of(got)), key=str) == \
        sorted([(1, a), (3, b), (7, c), (None, d), (9, "")], key=str)


def test_simhash_links_of_a_dense_group(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    fps = {int(b) for b in base}
    for b in base[:4]:
        for _ in range(300):
            f = int(b)
            for bit in rng.integers(0, 63, 3):
                f ^= 1 << int(bit)
            fps.add(f)
    fps = sorted(fps)
    old, simhash.UNIT = simhash.UNIT, 50                  # many shards
    try:
        got = simhash.components(simhash.link_forest(spark.createDataFrame([(f,) for f in fps], "fp long")))
        root = {r["node"]: r["root"] for r in got.collect()}
    finally:
        simhash.UNIT = old
    a = np.array(fps, np.uint64)
    f = simhash.Forest(len(a))
    for i in range(len(a)):
        j = np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4)
        f.add(np.full(len(j), i), j)
    assert {x: fps[f.root[i]] for i, x in enumerate(fps)} == {x: root.get(x, x) for x in fps}


def substring_brute(rows):
    out, seen = [], set()
    for k in sorted({low(i) for i, _, _ in rows}):
        own = [(i, (t or "").encode()) for i, t, _ in rows if low(i) == k]
        for i, b in own:
            gone = np.zeros(len(b), bool)
            for p in range(len(b) - 49):
                if b[p:p + 50] in seen:
                    gone[p:p + 50] = True
            kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
            runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
            out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
        seen.update(b[p:p + 50] for _, b in own for p in range(len(b) - 49))
    return sorted(out, key=str)


@pytest.mark.parametrize("name", ["odd", "corpus", "empty"])
def test_substring_dedup(name, request):
    docs = request.getfixturevalue(name)
    got = substring_dedup.digest(substring_dedup.substring_dedup(docs))
    assert sorted(map(tuple, got.collect()), key=str) == substring_brute(rows_of(docs))


def test_substring_rounds_keep_order_and_common_prefixes():
    r = np.random.default_rng(4)
    for n, width, letters in ((1, 5, 2), (60, 70, 2), (200, 64, 3), (90, 60, 1)):
        columns = r.integers(0, letters, (width, n)).astype(np.uint8)
        order, prefix = np.arange(n), np.zeros(n, np.int32)
        for c in range(width - 1, -1, -1):
            symbol = columns[c][order]
            to = np.argsort(symbol, kind="stable")
            order, prefix = order[to], substring_dedup.extended(prefix, symbol, to)
            suffixes = [columns[c:, i].tobytes() for i in order]
            assert suffixes == sorted(suffixes)
            for i in range(1, n):
                same = next((k for k, (x, y) in enumerate(zip(suffixes[i - 1], suffixes[i])) if x != y), width - c)
                assert prefix[i] == min(same, substring_dedup.LENGTH)
            assert prefix[0] == 0


def test_substring_dedup_cuts_large_groups(spark, corpus):
    old, substring_dedup.GROUP = substring_dedup.GROUP, 1
    try:
        got = substring_dedup.digest(substring_dedup.substring_dedup(corpus)).collect()
    finally:
        substring_dedup.GROUP = old
    assert sorted(map(tuple, got), key=str) == substring_brute(rows_of(corpus))


def test_mixing_targets():
    got = mixing.targets({"a": 10, "b": 100, "c": 100}, {"a": 5, "b": 2, "c": 1}, 315)
    assert got["a"] == 20 and got["b"] == pytest.approx(295 * 2 / 3) and got["c"] == pytest.approx(295 / 3)


@pytest.mark.parametrize("name", ["odd", "corpus", "empty"])
def test_mixing(name, request):
    docs = request.getfixturevalue(name)
    got = mixing.taken(mixing.mix(docs)).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, size(t)) for i, t, _ in rows_of(docs))
    assert sorted(map(str, mixing.taken(mixing.mix(docs)).collect())) == sorted(map(str, got))
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    if name == "corpus":
        for s in {r["source"] for r in got}:
            own = [r for r in got if r["source"] == s]
            assert own[0]["source_size"] == sum(r["size"] for r in own)
            assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)   # ten documents: one lands
    assert mixing.take(docs).columns == docs.columns


def test_mixing_comes_near_every_target(spark):
    got = QUERIES["op1_cube_mix"](spark, "/root/testdata/sf0.1").groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 0.002 * r["max(target)"] for r in got)


@pytest.mark.parametrize("name", ["odd", "corpus", "empty"])
def test_packing(name, request):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    docs = request.getfixturevalue(name)
    got = packing.pack(docs, tokenizer_path(), lane_tokens=1 << 16).collect()
    want = Counter()
    for i, t, _ in rows_of(docs):
        want[(i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [1]))] += 1
    joined, fill = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u2")
        assert r["length"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes())
        joined[r["doc_id"]].append((r["start"], tuple(ids.tolist()), r["doc_tokens"]))
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(r["length"] for r in got) == sum(len(k[1]) * n for k, n in want.items())
    for pieces in fill.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 2048
    for (i, ids), n in want.items():
        if n == 1 and sum(k[0] == i for k in want) == 1:
            pieces = sorted(joined[i])
            assert sum((p for _, p, _ in pieces), ()) == ids and all(p[2] == len(ids) for p in pieces)
    if name == "corpus":
        assert sum(sum(n for _, n in p) != 2048 for p in fill.values()) <= 1 + len({s >> 32 for s in fill})


def test_round_robin_keeps_to_the_shares():
    from collections import deque
    queues = {"a": deque([[0, 0, 6000]]), "b": deque([[1, 0, 3000]]), "c": deque([[2, 0, 1000]])}
    took, n = Counter(), 0
    for s, _, _, length in packing.round_robin(queues, dict.fromkeys("abc", 0.0), {"a": .6, "b": .3, "c": .1}, 500):
        took[s] += length
        n += length
        if n % 500 == 0:
            assert all(abs(took[s] - x * n) <= 3 for s, x in (("a", .6), ("b", .3), ("c", .1)))
    assert n == 10000


@pytest.mark.parametrize("name", ["odd", "empty"])
def test_language_odd_rows(name, request):
    docs = request.getfixturevalue(name)
    got = language.identify(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["lang_pred"] in ("en", "de", "und") and 0 <= r["score"] <= 1
    if name == "odd":
        assert [r["lang_pred"] for r in got if r["doc_id"] in (3, 4, 5, 7)] == ["und"] * 4
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = [r for r in QUERIES["op8_language"](spark, sf).collect() if r["held_out"]]
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in got) > 0.97 * len(got)


def test_toxicity_restores_hidden_words(corpus):
    restore = toxicity.Restorer(toxicity.learn_letters(corpus))
    for hidden, word in (("m0r0n", "moron"), ("tr@sh", "trash"), ("t h e n", "then"), ("thaaat", "that")):
        assert word in restore(f"so {hidden} it is")
    assert restore("the clean text stays") == "the clean text stays"


@pytest.mark.parametrize("name", ["odd", "empty"])
def test_toxicity_odd_rows(name, spark, request):
    docs = request.getfixturevalue(name)
    for labels in ([], [(1, 1, 0), (4, 1, 1), (6, 0, None), (None, 0, 1)]):
        got = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len(got) == docs.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(truth[r["doc_id"]], r["predicted"]) for r in QUERIES["op6_toxicity"](spark, sf).collect() if r["held_out"] and r["doc_id"] in truth]
    c = Counter(got)
    assert c[1, 1] / (c[1, 0] + c[1, 1]) > 0.6 and c[0, 1] / (c[0, 0] + c[0, 1]) < 0.01


def rule_brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0].translate(LOWER)
        path = re.match(r"[^?#]*", rest[len(re.match(r"[^/?#]*", rest)[0]):])[0]
    best = None
    for text, what in url_filter.RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[0])):
            best = (text, what)
    return host, path, *(best or (None, None))


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/1?x#y", "https://b.example.net/de/", "http://example.com/de/x", "http://x.org/fr/", "http://net/", "http://a.net",
            "a.net/x", None, "", "ftp://u@h:1?q/://", "http://notexample.com/de/1", "http://a.org/en/://b", "http://ÄB.org/fr/\n2"]
    df = spark.createDataFrame([(i if i % 5 else None, u, "h", "host") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = url_filter.judge(df).collect()
    assert len(got) == len(urls)
    want = Counter(rule_brute(u)[:3] for u in urls)
    assert Counter((r["host"], r["path"], r["rule"]) for r in got) == want
    verdict = dict(url_filter.RULES)
    assert all(r["verdict"] == verdict.get(r["rule"], r["verdict"]) and r["verdict"] in ("allow", "block") for r in got)
    assert url_filter.judge(df.limit(0)).count() == 0


def test_url_model_separates_labelled_urls(spark):
    got = QUERIES["op7_url_filter"](spark, "/root/testdata/sf0.01").collect()
    known = [r for r in got if r["rule"]]
    mean = lambda v: np.mean([r["score"] for r in known if r["verdict"] == v])
    assert mean("allow") > 0 > mean("block")


def test_pipeline_stages(spark, odd, empty):
    import corpus_pipeline
    for docs in (odd.select("doc_id", "text", "lang", "source", "n_chars"), empty.select("doc_id", "text", "lang", "source", "n_chars")):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).count()
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_toxicity_decodes_long_spans_whole(corpus):
    restore = toxicity.Restorer(toxicity.learn_letters(corpus))
    spaced = " ".join("idiotstupidmoron" * 3)
    assert restore(f"so {spaced} he said").split(spaced)[1].split()[0] == toxicity.decode(spaced, restore.cost)
    assert toxicity.decode(spaced, restore.cost) == "idiotstupidmoron" * 3
    mixed = "1d10t" * 12
    assert len(mixed) > 40 and toxicity.decode(mixed, restore.cost) in restore(f"an {mixed} here").split()
    assert "stupid" in restore("he is (stup1d) really").split()
    assert len(toxicity.decode("a1" * 20_000, restore.cost)) > 10_000
