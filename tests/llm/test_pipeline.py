"""The pipeline against the operators' brute-force meaning: null and shared ids, repeated rows, ties, clashing column names."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from .corpus import lower

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "_rk", "rk", "copies", "_source", "row", "_copy", "_doc", "key"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _rk string, rk long, copies string, _source string, row int, _copy string, _doc long, key string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def corpus():
    r = random.Random(17)
    vocab = {"en": "the of and house garden near old town walk with from they".split(), "fr": "le la et maison jardin dans ville avec sont nous vous pour".split()}
    text = lambda lang, n: " ".join(r.choice(vocab[lang]) + str(r.choice(("", "", r.randint(1, 999)))) for _ in range(n))
    bench = [" ".join(f"test{k}" for k in range(20)), "tiny item", " ".join(f"exam{k}" for k in range(13))]
    rows = [(i, text(("en", "fr")[i % 2], r.randint(40, 160)), ("en", "fr")[i % 2], f"s{i % 4}" if i % 9 else None) for i in range(120)]
    rows += [(None, text("en", 70), "en", "s0") for _ in range(12)] + [(7, text("fr", 60), "fr", "s1") for _ in range(12)]
    rows += [(1000, None, "en", "s0"), (1001, "12 34 !", "en", "s0"), (1002, "", "fr", "s1"), (None, None, None, None)]
    for i in range(30):  # near copies: a word or two changed in the middle
        words = rows[i][1].split()
        words[len(words) // 2] = "changed"
        rows.append((2000 + i, " ".join(words), rows[i][2], f"s{i % 3}"))
    rows += [(3000 + i, rows[i][1], "en", "s2") for i in range(10)]  # exact copies
    rows += [rows[40]] * 5 + [(None, rows[41][1], "fr", "s3")] * 3 + [(42, rows[42][1], "en", "other"), rows[125], rows[125]]
    rows += [(4000, text("en", 900) + " " + bench[0].upper() + " " + text("en", 900), "en", "s0"), (4001, text("en", 50) + " " + bench[2], "en", "s1"), (4002, "tiny item " + text("fr", 300), "fr", "s1"), (4003, "one tiny item here", "en", "s2")]
    rows.append((5000, text("en", 6000), "en", "s0"))
    extra = lambda i: (str(i), -i, "c", None, i % 3, "x", i, "k")
    return [(*x, i, *extra(i)) for i, x in enumerate(rows)], bench


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    rows, bench = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(d + "/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(d + "/benchmark.parquet")
    return d


def near(rows):
    """Groups of the SimHash stage, by listing all pairs."""
    import corpus_pipeline as p
    from quillstack.llm.simhash import majorities, mixed, shingle_hashes

    prints = {}
    for _, t in rows:
        h = np.array(shingle_hashes((t or "").encode(), p.SHINGLE), np.uint64)
        prints[t] = tuple(int(majorities(x, np.array([len(h)]))[0]) for x in (h, mixed(h)))
    nodes = sorted(set(prints.values()))
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(nodes)):
        for b in range(a):
            one, two = ((x ^ y).bit_count() for x, y in zip(nodes[a], nodes[b], strict=True))
            if min(one, two) <= p.NEAR and one + two <= p.GUARD:
                root[find(a)] = find(b)
    return {t: find(nodes.index(x)) for t, x in prints.items()}


def test_every_stage_equals_brute_force(spark, folder):
    import corpus_pipeline
    from quillstack.llm.oracles import OP6
    from tokenizers import Tokenizer

    docs, (rows, bench) = spark.read.parquet(folder + "/documents.parquet"), corpus()
    stages = dict(corpus_pipeline.STAGES)
    at = lambda df: Counter(tuple(r) for r in df.collect())

    docs = stages["language ID"](spark, docs, folder).cache()
    assert docs.columns == COLUMNS
    kept = [r for r in rows if r[1] and any(map(str.isalpha, r[1]))]
    assert at(docs) == Counter(kept)  # all of these are plainly one of the two languages

    docs = stages["SimHash near-dedup"](spark, docs, folder).cache()
    assert docs.columns == COLUMNS
    group, rk = near([r[:2] for r in kept]), {(r.doc_id, r.text): r.h for r in spark.createDataFrame(kept, SCHEMA).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h")).collect()}
    first = {}
    for r in kept:
        place = (r[0] is None, r[0] or 0, rk[r[0], r[1]])
        first[group[r[1]]] = min(first.get(group[r[1]], (place, r[:2])), (place, r[:2]), key=lambda x: x[0])
    got = at(docs)
    assert Counter(r[:2] for r in got) == Counter(x for _, x in first.values()) and max(got.values()) == 1 and set(got) <= set(kept)
    assert len(first) < len({r[1] for r in kept}) - 10  # near copies went

    kept, docs = list(got), stages["benchmark decontamination"](spark, docs, folder).cache()
    assert docs.columns == COLUMNS
    windows = {tuple(w[k : k + 13]) for t in bench for w in [TERM.findall(lower(t))] for k in range(max(1, len(w) - 12))}

    def dirty(text):
        ws, hit = TERM.findall(lower(text or "")), set()
        for k in range(len(ws)):
            for w in windows:
                if tuple(ws[k : k + len(w)]) == w:
                    hit |= set(range(k, k + len(w)))
        return len(hit) >= 13 or (hit and 20 * len(hit) >= len(ws))

    kept = [r for r in kept if not dirty(r[1])]
    ids = {r[0] for r in kept}
    assert at(docs) == Counter(kept) and not {4000, 4001, 4003} & ids and 4002 in ids

    docs = stages["mixing sources to target weights"](spark, docs, folder).cache()
    assert docs.columns == COLUMNS
    con = duckdb.connect()
    con.execute("create table t (n int, doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into t values (?, ?, ?, ?)", [(n, r[0], r[1], r[3]) for n, r in enumerate(kept)])
    # The oracle joins nothing by doc_id; row numbers come along to tell null and shared ids apart.
    sql = OP6.replace("select doc_id, source, cast(len(", "select n, doc_id, source, cast(len(", 1).replace("from documents", "from t", 1).replace("select d.doc_id, d.source", "select d.n, d.doc_id, d.source").replace("select doc_id, size, source_size", "select n, size, source_size")
    taken = {n: took // size if size else 0 for n, size, _, _, took in con.execute(sql).fetchall()}
    want = Counter({r: taken[n] for n, r in enumerate(kept) if taken[n]})
    assert at(docs) == want and {1, 2} <= set(want.values())

    of, want, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter(), 0
    tokens = sorted(map(tuple, stages["token-ID / binary output"](spark, docs, folder).collect()), key=lambda r: r[1])
    for r in docs.collect():
        ids = np.array(of.encode(r[1], add_special_tokens=False).ids + [2], "<u4")
        want[r[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r[0], r[2], r[3]) for r in tokens) == want
    assert [r[0] for r in tokens] == sorted((r[0] for r in tokens), key=lambda x: (x is not None, x))
    for _, s, n, _ in tokens:
        assert s == start
        start += n
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=lambda r: r[1]) == tokens


def test_empty_table(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_deletes_the_tables_of_done_stages(spark, folder):
    import corpus_pipeline
    from quillstack.plans.barrier import _written, mark

    before = mark()
    corpus_pipeline.run(spark, folder)
    names = Counter(x.rsplit("/", 1)[-1].rsplit("-", 1)[0] for x in _written[before:])
    assert names["mix-sizes"] == names["postings"] == names["simhash"] == 0 and names["stage-language-ID"] == 1
