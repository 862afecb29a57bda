"""Corpus operators against brute force, on a table with null, empty, long, tied and repeated rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

from .corpus import AKIA, DOCS, documents, frame, lower

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\r\x0b\x0c"
ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def order(i):
    return -(1 << 63) if i is None else i


def check_substrings(frame_, rows, **options):
    from pyspark.sql import functions as F

    from quillstack.llm.substring_dedup import substring_dedup

    low = {(r[0], r[1]): r[2] & 0x7FFFFFFF for r in frame_.select("doc_id", "text", F.xxhash64("doc_id", "text")).distinct().collect()}
    first, words = {}, [(r[0], (order(r[0]), low[r[0], r[1]]), (r[1] or "").encode().split()) for r in rows]
    for _, place, ws in words:
        for k in range(len(ws) - 19):
            key, at = tuple(ws[k : k + 20]), (place, k)
            first[key] = min(first.get(key, at), at)
    want = Counter()
    for i, place, ws in words:
        gone = [False] * len(ws)
        for k in range(len(ws) - 19):
            if first[tuple(ws[k : k + 20])] < (place, k):
                gone[k : k + 20] = [True] * 20
        kept = b" ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        want[i, len(ws), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()] += 1
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in substring_dedup(frame_, **options).collect())
    assert got == want
    return want


def test_substring_dedup(docs, none):
    from quillstack.llm.substring_dedup import substring_dedup

    assert sum(w[2] for w in check_substrings(docs, ROWS)) > 100
    assert substring_dedup(none).count() == 0


def test_substrings_of_long_texts_and_shared_ids(spark, monkeypatch):
    """Many groups for few partitions, null and shared ids, more copies of a row than go in one task, a text far above a group's size."""
    import random

    r = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    passage = " ".join(r.choice(vocab) for _ in range(70))
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    rows = [(r.choice((None, 7, i)), text(r.randint(0, 80)) + " " + passage * r.randint(0, 2) + " " + text(5), "en", "s", "", 0) for i in range(150)]
    rows += [(i, "a a a " * r.randint(5, 20) + passage, "en", "s", "", 0) for i in range(300, 320)]
    rows += [(500, text(400_000) + " " + passage, "en", "s", "", 0)] + [(600, passage + " end", "en", "s", "", 0)] * 45
    monkeypatch.setattr("quillstack.llm.common.COPIES", 20)
    monkeypatch.setattr("quillstack.llm.common.MOST_PARTITIONS", 4)
    frame_ = spark.createDataFrame(rows, DOCS).repartition(5).cache()
    check_substrings(frame_, rows, per_group=200_000)


@pytest.mark.parametrize("seed", range(3))
def test_forward_of_frame_of_reference(seed):
    from quillstack.llm.token_binary import pack, read_shard, shard_bytes, unpack

    r = np.random.default_rng(seed)
    for n in (0, 1, 127, 128, 129, 1000):
        ids = r.integers(0, (10, 50_000, 2**32)[seed], n, dtype=np.uint64).astype(np.uint32)
        if n > 200:
            ids[::50] = 2**32 - 1
        offsets, body = pack(ids)
        assert np.array_equal(unpack(offsets, body, n), ids)
    counts = np.array([3, 0, 997])
    assert read_shard(shard_bytes(7, [1, None, -5], counts, ids))[:2] == (7, [1, None, -5])


@pytest.mark.parametrize("copies", (1000, 3))
def test_token_output(docs, none, monkeypatch, copies):
    from pyspark.sql import functions as F

    from quillstack.llm.token_binary import token_output
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr("quillstack.llm.common.COPIES", copies)
    frame_, rows = docs.unionByName(docs.where("doc_id = 1005").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(10)))).drop("n")), [*ROWS, *[r for r in ROWS if r[0] == 1005] * 10]
    rk = {(r[0], r[1]): r[2] for r in frame_.select("doc_id", "text", F.xxhash64("doc_id", "text")).distinct().collect()}
    of, want, start = Tokenizer.from_file(path), [], 0
    for r in sorted(rows, key=lambda r: (order(r[0]), rk[r[0], r[1]])):
        ids = np.array(of.encode(r[1] or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(map(tuple, token_output(frame_, path).collect()), key=lambda r: r[1])
    assert got == want
    assert token_output(none, path).count() == 0


def test_line_dedup(docs, none):
    from quillstack.llm.line_dedup import line_dedup

    key = lambda x: lower(x.strip(SPACE))
    seen = Counter(k for r in ROWS for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    want = Counter()
    for r in ROWS:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < 10]
        want[r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    assert Counter(map(tuple, line_dedup(docs).drop("kept").collect())) == want and any(w[2] for w in want)
    assert line_dedup(none).count() == 0


def test_line_filters_do_not_fill_up(docs):
    from quillstack.llm.line_dedup import repeated_lines, suspected

    r = np.random.default_rng(3)
    once, shared = r.integers(0, 2**64, (50, 4000), dtype=np.uint64), r.integers(0, 2**64, 500, dtype=np.uint64)
    packs = [np.unique(np.concatenate((x, shared[i % 2 :: 2]))) for i, x in enumerate(once)]
    again = [np.zeros(len(p), bool) for p in packs]
    again[0][7] = True
    got = suspected(packs, again)
    assert all(g[np.isin(p, shared)].all() for p, g in zip(packs, got, strict=True)) and got[0][7]
    assert sum(g[~np.isin(p, shared)].sum() for p, g in zip(packs, got, strict=True)) < 0.01 * once.size
    # More lines make more buckets, not fuller ones: the result does not depend on their number.
    lists = [sorted((str(x.doc_id), x.rk, sorted(x.lines)) for x in repeated_lines(docs, per_bucket=n).collect()) for n in (7, 100, 10**6)]
    assert lists[0] == lists[1] == lists[2] and lists[0]


def test_simhash(docs, none):
    from quillstack.llm.simhash import near_duplicates

    fps = []
    for r in ROWS:
        ws = lower(r[1] or "").encode().split()
        grams = [b" ".join(ws[k : k + 4]) for k in range(max(1, len(ws) - 3))] if ws else []
        hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fps.append(sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs)))
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    low = {}
    for i, r in enumerate(ROWS):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    want = Counter((r[0], f"{f:016x}", low.get(find(i))) for i, (r, f) in enumerate(zip(ROWS, fps, strict=True)))
    got = near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert Counter(map(tuple, got)) == want
    assert near_duplicates(none).count() == 0


def test_gray_forest_spans_all_links():
    from quillstack.llm.simhash import block_masks, forest_links, mixed

    r = np.random.default_rng(5)
    fps = r.integers(0, 2**64, 60, dtype=np.uint64)[r.integers(0, 60, 900)]
    for _ in range(4):
        fps = fps ^ (np.uint64(1) << r.integers(0, 64, 900).astype(np.uint64))
    fps = np.unique(fps)
    found = fps[np.concatenate([forest_links(fps, mixed(fps & m)) for m in block_masks()])]
    assert (np.bitwise_count(found[:, 0] ^ found[:, 1]) <= 4).all()
    at, root, brute = {int(x): i for i, x in enumerate(fps)}, list(range(len(fps))), list(range(len(fps)))

    def find(p, x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in found:
        x, y = find(root, at[int(a)]), find(root, at[int(b)])
        root[max(x, y)] = min(x, y)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[:i] ^ fps[i]) <= 4):
            x, y = find(brute, i), find(brute, int(j))
            brute[max(x, y)] = min(x, y)
    assert [find(root, i) for i in range(len(fps))] == [find(brute, i) for i in range(len(fps))]


def test_guarded_links_equal_brute_force(spark):
    from quillstack.llm.simhash import best_agree, majorities, mixed, near_duplicates, shingle_hashes

    import random

    r = random.Random(12)
    base = [[f"w{r.randint(0, 5000)}" for _ in range(r.choice((12, 60, 150)))] for _ in range(25)]
    texts = []
    for ws in base:
        for _ in range(6):
            texts.append(" ".join(w if r.random() > 0.015 else f"z{r.randint(0, 99)}" for w in ws))
    rows = [(i, t, "en", "s", "", 0) for i, t in enumerate(texts)]
    one, two = [], []
    for t in texts:
        h = np.array(shingle_hashes(t.encode(), 5), np.uint64)
        one.append(int(majorities(h, np.array([len(h)]))[0]))
        two.append(int(majorities(mixed(h), np.array([len(h)]))[0]))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    alone = 0
    for a in range(len(texts)):
        for b in range(a):
            bits, more = (one[a] ^ one[b]).bit_count(), (two[a] ^ two[b]).bit_count()
            if min(bits, more) <= 6 and bits + more <= 14:
                root[max(find(a), find(b))] = min(find(a), find(b))
            alone += (min(bits, more) <= 6 < bits + more - 8) + (bits + more <= 14 and bits > 6)
    for agree in (None, 3):  # the links don't depend on it
        got = {x.doc_id: x.component_id for x in near_duplicates(frame(spark, rows), shingle=5, limit=6, agree=agree, guard=14).collect()}
        assert got == {i: find(i) for i in range(len(texts))} and alone and 25 < len(set(got.values())) < 150
    assert [best_agree(n, 8) for n in (10**5, 10**8, 10**10)] == sorted(best_agree(n, 8) for n in (10**5, 10**8, 10**10)) and best_agree(10**5, 4) == 2 < best_agree(10**10, 8)


def test_components_of_long_chains(spark):
    from quillstack.llm.components import components

    links = [(i, i + 1) for i in range(0, 40)] + [(100 - i, 99 - i) for i in range(20)] + [(7, 7), (3, 2)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[i] for i in range(41)}) == 1 and len({got[i] for i in range(80, 101)}) == 1 and got[0] != got[100]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language_id(docs, none, spark):
    from quillstack.llm.language import identify

    path = public_tokenizers.path("piece_bpe_32k.model")
    say = {"en": "the house and the garden were near the old town", "fr": "la maison et le jardin sont dans la vieille ville", "de": "das haus und der garten sind in der alten stadt"}
    rows = [(i, say[lang] if i % 3 else say[lang].upper(), lang, "s", "x", 1) for i in range(60) for lang in [("en", "fr", "de")[i % 3]]]
    rows.append((200, say["en"] + " x" * 100_000 + " " + "garden" * 5000, "en", "s", "x", 1))  # a very long text with a very long word may teach, too
    rows += [(100, None, "en", "s", "x", 1), (101, "12 34 !", "fr", "s", "x", 1), (102, "", None, "s", "x", 1), (103, "x" * 3000, None, "s", "x", 1), (None, "le jardin", "fr", "s", "x", 1)]
    got = {r.doc_id: r for r in identify(frame(spark, rows), path).collect()}
    assert all(got[i].lang_pred == ("en", "fr", "de")[i % 3] and 0 <= got[i].score <= 1 for i in range(60))
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[103].lang_pred in say and got[None].lang_pred == "fr"
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(60))
    spaceless = {"zh": "这是一个关于房子和花园的很长的句子没有空格", "ja": "これは家と庭についてのとても長い文章です空白はありません"}
    rows = [(i, say_[(k := i % 7) :] + say_[:k], lang, "s", "x", 1) for i in range(40) for lang in [("zh", "ja")[i % 2]] for say_ in [spaceless[lang] * 9]]
    got = [(r.doc_id, r.lang_pred, r.score) for r in identify(frame(spark, rows), path).collect()]
    assert all(lang == ("zh", "ja")[i % 2] for i, lang, _ in got)  # one word of hundreds of characters each
    assert sorted(got) == sorted((r.doc_id, r.lang_pred, r.score) for r in identify(frame(spark, rows).repartition(2), path).collect())
    assert identify(docs, path).count() == len(ROWS)
    assert identify(none, path).count() == 0
    assert {r.lang_pred for r in identify(frame(spark, [(1, "a b", None, "s", "x", 1)]), path).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    from quillstack.llm.language import Unigrams

    pieces = ["▁", "a", "b", "ab", "▁a", "aba"]
    p = np.array([0.1, 0.2, 0.1, 0.3, 0.05, 0.25, 1e-7])[:, None] * np.ones(2)
    u = Unigrams(pieces, p)

    def brute(s):
        return 1.0 if not s else sum(p[pieces.index(s[:k]) if s[:k] in pieces else -1, 0] * brute(s[k:]) for k in range(1, len(s) + 1) if s[:k] in pieces or k == 1)

    words = ["a", "ab", "aba", "abab", "xa", "babab"]
    assert np.allclose(u.score(words)[:, 0], [np.log(brute("▁" + w)) for w in words])
    from quillstack.llm import language

    def scaled(w):
        codes = language.codes_of(["▁" + w])
        return u.scaled(codes, u.arcs(codes))[-1, 0, 0]

    assert np.allclose([scaled(w) for w in words], u.score(words)[:, 0])
    # Long words teach as short ones do, and their runs add up.
    counts = np.arange(1, 13, dtype=float).reshape(6, 2)
    short, monkey = u.expected(words, counts), language.SHORT
    language.SHORT = 0
    try:
        assert np.allclose(u.expected(words, counts), short) and short.sum() > 0
    finally:
        language.SHORT = monkey
    long = "ab" * 400
    parts = [("▁" + long)[k : k + language.RUN] for k in range(0, 801, language.RUN)]
    assert np.allclose(u.score([long])[0, 0], sum(u.scaled(c, u.arcs(c))[-1, 0, 0] for c in map(language.codes_of, ([x] for x in parts))))
    assert u.expected([long], np.ones((1, 2)))[:, 0].sum() > 100


def test_language_id_equals_brute_force(spark, monkeypatch):
    """Training and scoring by listing every segmentation."""
    import random

    from quillstack.llm import language

    pieces = ["▁", "a", "b", "c", "ab", "▁a", "bc", "cab"]
    monkeypatch.setattr(language, "pieces_of", lambda path: pieces)
    r = random.Random(6)
    rows = [(i, " ".join("".join(r.choice("aabc" if i % 2 else "abccx") for _ in range(r.randint(1, 6))) for _ in range(r.randint(1, 8))), ("p", "q")[i % 2], "s", "x", 1) for i in range(60)]
    rows += [(100, None, "p", "s", "x", 1), (101, "12", "q", "s", "x", 1), (102, "AB ab", None, "s", "x", 1)]

    def ways(w):
        if not w:
            yield []
        for k in range(1, len(w) + 1):
            if w[:k] in pieces or k == 1:
                yield from ([pieces.index(w[:k]) if w[:k] in pieces else len(pieces), *rest] for rest in ways(w[k:]))

    start = np.array([0.2 ** len(x) for x in pieces])
    probs = np.append(start / start.sum(), 1e-7)[:, None] * np.ones(2)
    spoken = lambda text: ["▁" + w.lower() for w in (text or "").split() if any(map(str.isalpha, w))]
    teach = [(w, "pq".index(x[2])) for x in rows if x[2] and zlib.crc32(str(x[0]).encode()) % 4 != 2 for w in spoken(x[1])]
    for _ in range(3):
        used = np.zeros_like(probs)
        for w, lang in teach:
            each = [(s, np.prod(probs[s, lang])) for s in ways(w)]
            for s, x in each:
                np.add.at(used[:, lang], s, x / sum(y for _, y in each))
        used = used[:-1] + 0.1
        probs = np.vstack((used / used.sum(0), np.full((1, 2), 1e-7)))
    got = {x.doc_id: x for x in language.identify(frame(spark, rows), "unused").collect()}
    for x in rows:
        logs = np.array([sum(np.log(sum(np.prod(probs[s, lang]) for s in ways(w))) for w in spoken(x[1])) for lang in range(2)])
        if not spoken(x[1]):
            assert (got[x[0]].lang_pred, got[x[0]].score) == ("und", 0.0)
        else:
            assert got[x[0]].lang_pred == "pq"[int(logs.argmax())] and abs(got[x[0]].score - 1 / np.exp(logs - logs.max()).sum()) < 1e-4


def test_mix(docs, none):
    from quillstack.llm.mixing import mix

    got = [r.asDict() for r in mix(docs).collect()]
    assert sorted(map(str, got)) == sorted(str(r.asDict()) for r in mix(docs.repartition(5)).collect())
    size = Counter()
    for r in ROWS:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    names = sorted(k for k in size if k is not None) + [None]
    weight, capped, total = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}, set(), 1.5 * sum(size.values())
    while True:
        level = (total - sum(2 * size[k] for k in capped)) / max(1, sum(weight[k] for k in names if k not in capped))
        new = {k for k in names if k not in capped and weight[k] * level > 2 * size[k]}
        if not new:
            break
        capped |= new
    for k in names:
        own = [r for r in got if r["source"] == k]
        goal = 2 * size[k] if k in capped else weight[k] * level
        assert all(abs(r["target"] - goal) < 1e-6 and r["source_size"] == size[k] for r in own)
        lumps = Counter()  # what enters in one step: rows of one id and text
        for r in own:
            lumps[r["rk"]] += r["size"] * (r["p"] > 0)
        assert abs(sum(r["taken"] for r in own) - goal) <= max(lumps.values()) / 2 + 1e-6
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got) and len(got) == len(ROWS)
    assert mix(none).count() == 0


def test_mix_of_sources_without_words(spark):
    from quillstack.llm.mixing import mix

    rows = [(1, None, None, "empty", "", 0), (2, "", None, "empty", "", 0), (3, "a b c d e", None, "some", "", 0), (4, None, None, "some", "", 0), (5, "a", None, None, "", 0)]
    got = {r.doc_id: (r.size, r.source_size, r.target, r.taken) for r in mix(frame(spark, rows)).collect()}
    # All can't take more than twice their size: six words, nine wanted, empty takes none, null (weight 1) is filled up last.
    assert {k: v[:2] for k, v in got.items()} == {1: (0, 0), 2: (0, 0), 3: (5, 5), 4: (0, 5), 5: (1, 1)}
    assert got[1][2:] == got[2][2:] == (0.0, 0) and got[3][3] in (5, 10) and got[4][3] == 0 and sum({got[3][2], got[5][2]}) == 9.0
    assert all(v[3] == 0 for v in ((r.size, r.source_size, r.target, r.taken) for r in mix(frame(spark, rows[:2])).collect()))


def test_mix_includes_documents_at_their_odds(spark):
    from pyspark.sql import functions as F

    from quillstack.llm.mixing import mix

    rows = [(i, " ".join(["w"] * 10), None, f"s{i % 2}", None, 0) for i in range(12000)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("x", (F.col("doc_id") % 5 + 1).cast("double"))
    got = mix(docs, seed=3, weight=F.col("x")).select("doc_id", "source", "p", "copies", "target").collect()
    by = {}
    for r in got:
        by.setdefault((r.source, r.doc_id % 10 // 2 if r.source == "s0" else r.doc_id % 5), []).append(r)
    odds = {}
    for (source, _), own in by.items():
        x, whole = own[0].doc_id % 5 + 1, min(r.copies for r in own)
        p, n = own[0].p, len(own)
        assert all(r.p == p and r.copies - whole in (0, 1) and r.copies <= 2 for r in own)
        if p > 0:
            rate = sum(r.copies - whole for r in own) / n
            assert abs(rate - p) < 4 * (p * (1 - p) / n) ** 0.5 + 1 / n
            odds.setdefault(source, set()).add(round((whole + p) / x, 9))
    assert all(len(v) == 1 for v in odds.values()) and max(len(by), 0) == 10  # copies go with the weight below the cap
    for source in ("s0", "s1"):
        own = [r for r in got if r.source == source]
        assert abs(10 * sum(r.copies for r in own) - own[0].target) <= 5


def test_secrets(docs, none, spark):
    from quillstack.llm.secrets import find_secrets

    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    rows = ROWS + [(3000, "🙂 Token: short secret : abcdefghijkl API_KEY='x1234567890123' AKIAX " + AKIA, "en", "s0", "", 0), (3001, "passwordſ=aaaaaaaaaaaaaa toKen=toKen=abcdefghijklm", "en", "s1", "", 0)]
    rows += [(3002 + i, f"shared Ab3Ab3Ab3Ab3Ab3Ab3Ab3Ab3 own{i} Zz9Zz9Zz9Zz9Zz9Zz9Zz{i}", "en", f"s{i}", "", 0) for i in range(3)]
    got = {r.doc_id: r for r in find_secrets(frame(spark, rows)).collect()}
    for r in rows:
        t = r[1] or ""
        found = sorted([(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12] + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16])
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in found)
        x = got[r[0]]
        assert (x.n_assign, x.n_access, x.n_hex) == tuple(sum(f[1] == k for f in found) for k in range(3))
        assert x.base_sha256 == hashlib.sha256(said.encode()).hexdigest() and set(filter(None, said.split(","))) <= set(x.spans.split(","))
    assert all("owned" in got[3002 + i].spans and got[3002 + i].spans.count("owned") == 1 and got[3002 + i].n_example == 1 for i in range(3))
    assert find_secrets(none).count() == 0


def brute_secrets(rows):
    """{(doc_id, text): (base spans, all spans, n_live, n_example)}"""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    token, found, repos = re.compile("[A-Za-z0-9+/_=-]{20,}"), {}, {}
    for i, text, source in {(r[0], r[1], r[3]) for r in rows}:
        t = text or ""
        base = [(m.start(), 0, m.end(), m[2]) for m in assign.finditer(t) if len(m[2]) >= 12] + [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]{14,}", t)] + [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]{16,}", t)]
        more = [(m.start(), 3, m.end(), m[0]) for m in token.finditer(t) if all(re.search(c, m[0]) for c in ("[0-9]", "[a-z]", "[A-Z]"))]
        more = [x for x in more if not any(y[0] < x[2] and x[0] < y[2] for y in base)]
        found[i, text] = base, more
        for x in base + more:
            repos.setdefault(x[3], set()).add((i, text, source))
    owners = {v: len({s for _, _, s in rs}) for v, rs in repos.items()}
    copied = {v for v in repos if owners[v] >= 3 or len(repos[v]) >= 20}
    live = {v for v in repos if owners[v] == 1} - copied
    say = lambda xs: ",".join(f"{('assign', 'access', 'hex', 'owned')[k]}:{a}:{b}" for a, k, b, _ in sorted(xs))
    return {key: (say(base), say(base + [x for x in more if x[3] in live]), len({x[3] for x in base + more} & live), len({x[3] for x in base + more} & copied)) for key, (base, more) in found.items()}


def test_secrets_equal_brute_force(spark):
    from quillstack.llm.secrets import find_secrets

    import random

    r = random.Random(4)
    parts = ["deadbeef" * 2, AKIA, "Zz9" * 8, "Qx7-" * 6, "secret: ", "token=", "é🙂", "word", "password = 'abcdefgh1234'", "0123456789abcdef0", "Aa1" * 7 + "deadbeefdeadbeef", ".", "\n", "ToKeN"]
    rows = [*ROWS] + [(5000 + i, "".join(r.choice(parts) + r.choice(("", " ", " ")) + str(r.choice(("", i, 7))) for _ in range(r.randint(1, 60))), "en", f"s{r.randint(0, 5)}", "", 0) for i in range(150)]
    want = brute_secrets(rows)
    got = find_secrets(frame(spark, rows)).collect()
    by_id = Counter((x.doc_id, x.base_sha256, x.spans, x.n_live, x.n_example) for x in got)
    assert by_id == Counter((r[0], hashlib.sha256(w[0].encode()).hexdigest(), *w[1:]) for r in rows for w in [want[r[0], r[1]]])
    assert sum(x.spans.count("owned") for x in got) > 50


def test_secrets_of_a_text_with_very_many(spark):
    import time

    from quillstack.llm.secrets import find_secrets

    text = " ".join(f"{i:020x} Tok{i:08d}Zyxwvuts{i:05d}" for i in range(16000))
    began = time.time()
    (got,) = find_secrets(frame(spark, [(1, text, "en", "s", "", 0)])).collect()
    assert got.n_hex == got.spans.count("hex") == 16000 == got.spans.count("owned") and got.spans.endswith(f":{len(text)}") and time.time() - began < 60


def test_secrets_in_many_documents_of_one_source_are_copied(spark):
    from quillstack.llm.secrets import find_secrets

    copied, few, repeated = "Qw7" * 9, "Er8" * 9, "Ty9" * 9
    rows = [(i, f"{i} {copied} " + few * (i < 19), "en", "s0", "", 0) for i in range(20)] + [(50, repeated, "en", "s0", "", 0)] * 25
    got = {(r.doc_id, r.n_live, r.n_example, r.n_repos, r.spans.count("owned")) for r in find_secrets(frame(spark, rows)).collect()}
    assert got == {(i, int(i < 19), 1, 20, int(i < 19)) for i in range(20)} | {(50, 1, 0, 1, 1)}


def test_jpeg_round_trip_and_features(docs, none):
    from quillstack.llm.media import padded, read_payloads, store

    got = read_payloads(store(docs), with_tensor=True).collect()
    by_text = {}
    for r in got:
        text = next(x[1] for x in ROWS if x[0] == r.doc_id and (r.doc_id is not None or x[0] is None))
        data = padded((text or "").encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((text or "").encode()), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
        w, h = map(int, r.feature.split(" ")[0].split("x"))
        assert len(r.tensor) == 3 * w * h and by_text.setdefault(text or "", (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)
    assert len(got) == len(ROWS) and read_payloads(store(none)).count() == 0


def slow_decode(data):
    """Another progressive decoder, a bit and a block at a time: (width, height, {component: (h, v, table, blocks by row)})."""
    zigzag = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))
    quant, codes, comps, every, at = {}, {}, {}, 0, 2
    while data[at + 1] != 0xD9:
        marker, n = data[at + 1], int.from_bytes(data[at + 2 : at + 4])
        body, at = data[at + 4 : at + 2 + n], at + 2 + n
        if marker == 0xDB:
            quant[body[0] & 15] = list(body[1:65])
        elif marker == 0xDD:
            every = int.from_bytes(body)
        elif marker == 0xC4:
            while body:
                code, k, table = 0, 17, {}
                for length in range(1, 17):
                    for _ in range(body[length]):
                        table[length, code] = body[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                codes[body[0]], body = table, body[k:]
        elif marker == 0xC2:
            high, wide = int.from_bytes(body[1:3]), int.from_bytes(body[3:5])
            for k in range(body[5]):
                i, hv, q = body[6 + 3 * k : 9 + 3 * k]
                comps[i] = [hv >> 4, hv & 15, q, None]
            hm, vm = max(c[0] for c in comps.values()), max(c[1] for c in comps.values())
            across, down = -(-wide // (8 * hm)), -(-high // (8 * vm))
            for c in comps.values():
                c[3] = [[[0] * 64 for _ in range(across * c[0])] for _ in range(down * c[1])]
        elif marker == 0xDA:
            own = [(body[1 + 2 * k], body[2 + 2 * k]) for k in range(body[0])]
            first, last, approx = body[-3:]
            ah, al, bits = approx >> 4, approx & 15, []
            parts = [b""]
            while not (data[at] == 0xFF and data[at + 1] not in (0, *range(0xD0, 0xD8))):
                if data[at] == 0xFF and data[at + 1]:
                    parts.append(b"")
                    at += 2
                else:
                    parts[-1] += data[at : at + 1]
                    at += 1 + (data[at] == 0xFF)
            if len(own) > 1:
                units = [[(i, t, comps[i][1] * y + v, comps[i][0] * x + h) for i, t in own for v in range(comps[i][1]) for h in range(comps[i][0])] for y in range(down) for x in range(across)]
            else:
                (i, t) = own[0]
                units = [[(i, t, y, x)] for y in range(-(-(-(-high * comps[i][1] // vm)) // 8)) for x in range(-(-(-(-wide * comps[i][0] // hm)) // 8))]
            for p, part in enumerate(parts):
                bits = iter("".join(f"{b:08b}" for b in part))
                take = lambda n, bits=bits: int("0" + "".join(next(bits) for _ in range(n)), 2)

                def symbol(table, take=take):
                    code = length = 0
                    while (length, code) not in table:
                        code, length = code << 1 | take(1), length + 1
                    return table[length, code]

                signed = lambda n, take=take: (lambda v: v if n == 0 or v >> (n - 1) else v - (1 << n) + 1)(take(n))
                before, run = dict.fromkeys(comps, 0), 0
                for unit in units[p * (every or len(units)) : (p + 1) * (every or len(units))]:
                    for i, t, y, x in unit:
                        block = comps[i][3][y][x]
                        if first == 0:
                            if ah:
                                block[0] |= take(1) << al
                            else:
                                before[i] += signed(symbol(codes[t >> 4]))
                                block[0] = before[i] << al
                            continue
                        k = first
                        while k <= last:
                            if run:
                                zeros, value = 64, 0
                            else:
                                s = symbol(codes[16 + (t & 15)])
                                zeros, size = s >> 4, s & 15
                                if size == 0 and zeros < 15:
                                    run = (1 << zeros) + take(zeros)
                                    zeros, value = 64, 0
                                else:
                                    value = 0 if size == 0 else (1 if take(1) else -1) if ah else signed(size)
                            while k <= last:
                                if ah and block[k]:
                                    if take(1):
                                        block[k] += (1 << al) if block[k] > 0 else -(1 << al)
                                elif zeros == 0:
                                    if value:
                                        block[k] = value << al if value > 0 else -(-value << al)
                                    k += 1
                                    break
                                else:
                                    zeros -= 1
                                k += 1
                        run -= run > 0
    return wide, high, {i: (h, v, [[(zigzag, [a * b for a, b in zip(block, quant[q], strict=True)]) for block in row] for row in rows]) for i, (h, v, q, rows) in comps.items()}


def test_jpeg_tensors_equal_another_decoder():
    from quillstack.llm.jpeg import encode, tensors
    from quillstack.llm.media import padded

    u, x = np.arange(8)[:, None], np.arange(8)[None, :]
    c = np.where(u == 0, np.sqrt(1 / 8), 0.5) * np.cos((2 * x + 1) * u * np.pi / 16)
    texts = [(r[1] or "").encode() for r in ROWS[:6]] + [bytes(range(256)) * 9, b"", b"x"]
    files = encode([(padded(t), len(t)) for t in texts])
    for data, (im, _, tensor) in zip(files, tensors(files), strict=True):
        wide, high, comps = slow_decode(data)
        planes = []
        for h, v, rows in comps.values():
            grid = np.zeros((8 * len(rows), 8 * len(rows[0])))
            for y, row in enumerate(rows):
                for k, (zigzag, block) in enumerate(row):
                    freq = np.zeros((8, 8))
                    for p, value in zip(zigzag, block, strict=True):
                        freq[p] = value
                    grid[8 * y : 8 * y + 8, 8 * k : 8 * k + 8] = np.clip(np.rint(c.T @ freq @ c + 128), 0, 255)
            planes.append(grid.repeat(2 // v, 0).repeat(2 // h, 1)[:high, :wide])
        luma, cb, cr = planes
        want = np.stack([luma + 1.402 * (cr - 128), luma - 0.344136 * (cb - 128) - 0.714136 * (cr - 128), luma + 1.772 * (cb - 128)], 2).clip(0, 255)
        assert tensor.shape == (high, wide, 3) and np.abs(tensor - want).max() <= 3.5 and np.abs(tensor - want).mean() < 0.6


def test_stored_tensors_give_the_features(docs):
    from quillstack.llm.media import read_payloads, store, store_tensors

    media = store(docs)
    kept = {(r.doc_id, r.rk): r for r in store_tensors(media).collect()}
    for r in read_payloads(media).collect():
        t = kept[r.doc_id, r.rk]
        rgb = np.frombuffer(t.tensor, np.uint8).reshape(t.height, t.width, 3)
        assert r.feature == f"{t.width}x{t.height} " + ",".join(map(str, rgb.sum((0, 1), dtype=np.int64)))


def test_jpeg_decodes_bands_runs_and_refinement():
    """A file written by hand: two bands, end-of-block runs, zero runs, new coefficients in a refining scan."""
    from quillstack.llm.jpeg import DQT, EOI, SOF2, SOI, DHT, decode, samples, scan_head, segment, table

    import struct

    def scan(head, bits):
        bits += "1" * (-len(bits) % 8)
        return head + bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")

    frame_ = segment(SOF2, struct.pack(">BHHB", 8, 8, 16, 1) + bytes([1, 0x11, 0]))
    tables = segment(DHT, table(0, 0, {2: [0, 3]}) + table(1, 0, {2: [0x10, 0x02, 0x21]}) + table(1, 1, {2: [0x00, 0x11, 0xF0]}))
    body = [
        scan(scan_head([(1, 0)], 0, 0, 0, 1), "01" + "101" + "00"),  # DC 5 << 1, then no difference
        scan(scan_head([(1, 0)], 0, 0, 1, 0), "01"),  # second DC gets a low bit
        scan(scan_head([(1, 0)], 1, 5, 0, 1), "01" + "10" + "00" + "0"),  # coefficient 1 = 2 << 1, then a run of two blocks' ends
        scan(scan_head([(1, 0)], 6, 63, 0, 0), "10" + "0" + "00" + "0"),  # after two zeros, -1; ends of two blocks
        scan(scan_head([(1, 1)], 1, 5, 1, 0), "01" + "1" + "1" + "00" + "00"),  # after coefficient 1's bit and a zero, +1; both blocks end
    ]
    data = bytes([0xFF, SOI]) + segment(DQT, bytes([0]) + bytes([1] * 64)) + frame_ + tables + b"".join(body) + bytes([0xFF, EOI])
    _, _, coef = decode([data])
    want = np.zeros((2, 64), int)
    want[0, [0, 1, 3, 8]] = 10, 5, 1, -1
    want[1, 0] = 11
    assert np.array_equal(coef, want)
    flat = samples(np.eye(1, 64, dtype=int) * 80)
    assert (flat == 138).all()


def test_decontamination(docs, none, spark, monkeypatch):
    from quillstack.llm.decontamination import decontaminate

    term = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = (ROWS[0][1] or "").split()
    items = [(1, " ".join(words[3:30]).upper()), (10, "One"), (2, None), (3, ""), (4, "never seen words here"), (5, " ".join(words[3:30])), (6, "a A a a a a a a a a a a a a"), (None, words[0]), (7, "é ß ½ never"), (8, " ".join(words[3:9] + ["zzz"] + words[10:13] + ["yyy"] + words[13:17]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, t in items:
        ws = term.findall(lower(t or ""))
        for k in range(max(1, len(ws) - 12) if ws else 0):
            windows.setdefault(tuple(ws[k : k + 13]), set()).add(i)
    seen = Counter(w for r in ROWS for w in term.findall(lower(r[1] or "")))
    pairs = {}
    for w in windows:
        by = sorted((seen[x], x) for x in set(w) if seen[x])
        if len(set(w)) >= 5 and len(by) > 1:
            pairs[w] = by[0][1], by[1][1]
    want = Counter()
    for r in ROWS:
        ws, hit, ids, near = term.findall(lower(r[1] or "")), set(), set(), set()
        for k in range(len(ws)):
            around = set(ws[max(0, k - 12) : k + 13])
            for w, i in windows.items():
                if tuple(ws[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
                    ids |= i
                if w in pairs and ws[k] == pairs[w][0] and pairs[w][1] in around and len(around & set(w)) >= 0.8 * len(set(w)):
                    near |= i
        named = sorted(str(i) for i in ids if i is not None)
        want[r[0], len(ws), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), len({i for i in near if i is not None} - ids), bool(hit) and 20 * len(hit) >= len(ws)] += 1
    got = Counter(map(tuple, decontaminate(docs, bench).drop("rk").collect()))
    assert got == want and any(w[2] for w in want) and any(w[5] for w in want)
    assert decontaminate(none, bench).count() == 0
    assert {r.n_hit for r in decontaminate(docs, bench.limit(0)).collect()} == {0}
    monkeypatch.setattr("quillstack.llm.decontamination.SMALL", 0)  # test sides too large to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert Counter(map(tuple, decontaminate(docs, bench).drop("rk").collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_warc(spark):
    from quillstack.llm.warc import lookup, read_archive, write_archive

    rows = [(1, "http://a.b.org/x", "x" * 200), (2, "http://a.b.org/y", "x" * 200), (3, None, None), (None, "odd é url\n", "x" * 200), (2, "http://a.b.org/y", "x" * 200), (1, "http://a.b.org/x", "x" * 200), (5, "http://a.b.org/x?q=1", "short"), (6, "http://c", "short")]
    rows += [(100 + i, f"https://h{i % 7}.net/p/{i}", f"é{i}" * 60) for i in range(900)]
    files = write_archive(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, key int"))
    want = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        low = min(p for p, _, h in rows if h == html and p is not None) if page is None or html else page
        again = len(data) >= 100 and page != low
        want[page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", low if again else None] += 1
    whole = read_archive(files).collect()
    assert len({r.record_id for r in whole}) == len(rows)
    assert Counter((r.page_id, r.url) for r in whole) == Counter(r[:2] for r in rows)
    assert all(r.payload == next((h or "").encode() for p, u, h in rows if (p, u) == (r.page_id, r.url)) for r in whole if r.record_type == "response")
    got = read_archive(files, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(map(tuple, got)) == want
    assert [r.page_id for r in lookup(files, "https://h3.net/p/10").collect()] == [110]
    assert [r.page_id for r in lookup(files, "http://a.b.org/x").collect()] == [1, 1]
    assert lookup(files, "http://nowhere").count() == 0
    assert read_archive(write_archive(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


@pytest.mark.parametrize("copies", (1000, 5000))
def test_warc_records_and_many_copies(spark, monkeypatch, copies):
    import gzip

    from quillstack.llm.warc import read_archive, write_archive

    monkeypatch.setattr("quillstack.llm.common.COPIES", copies)
    # Incompressible pages, so that there are many chunks and files; one row 2,500 times; one page of 3 MB.
    r = np.random.default_rng(2)
    rows = [(i, f"http://x{i % 5}.org/{i}", r.bytes(30_000).hex()) for i in range(400)] + [(7000, "http://x1.org/copy", "copied")] * 2500 + [(None, None, r.bytes(1_500_000).hex())]
    files = write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), date="2020-02-02T00:00:00Z").cache()
    got = read_archive(files, with_payload=False).collect()
    assert Counter((x.page_id, x.url, x.payload_bytes) for x in got) == Counter((p, u, len(h)) for p, u, h in rows) and len({x.record_id for x in got}) == len(rows)
    names = Counter(f.file for f in files.where("kind = 'warc'").collect())
    assert len(names) > 1 and max(names.values()) > 10
    for name in list(names)[:2]:  # the chunks of a file are one file of gzip members, the directory lists them
        chunks = files.where((files["file"] == name) & (files["kind"] == "warc")).orderBy("at").collect()
        whole = gzip.decompress(b"".join(c.content for c in chunks))
        assert whole.startswith(b"WARC/1.1\r\n") and b"WARC-Date: 2020-02-02T00:00:00Z\r\n" in whole
        listed = files.where((files["file"] == name) & (files["kind"] == "directory")).collect()[0].content.decode().split("\n")
        assert [tuple(map(int, x.split(" ")[1:])) for x in listed] == [(c.at, len(c.content), len(c.block)) for c in chunks]
