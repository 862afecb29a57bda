"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

Frequencies of the test terms are counted over all training text. For each test window the two rarest
terms are index terms; the postings (document, position, neighbouring words) of index terms are stored, in
one pass that also stores every text's number of words. The rarest term's list, shifted by its offset in
the window, gives candidate starts; for exact phrases these are intersected with the second rarest term's
list shifted by its own offset, and what is left is compared word by word. Where the second term is
anywhere among the neighbours of the first, and ``NEAR_SHARE`` of the window's different terms are, it is a
proximity match (of windows of ``NEAR_TERMS`` different terms at least). A window with a term that no
document has can have no exact match and is dropped at once for those.

Null text has no words. Windows with the same words are looked for once. Repeated rows get equal results.
Test sides are broadcast only if their measured size is below ``SMALL``; beyond it the joins shuffle, the
postings of one term over ``SALTS`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, lower_ascii, same_row, written

#: Words of lower-cased text: what is not in \x00-\x2F, \x3A-\x60, \x7B-\x7F. Said by what is in it, common letters first, it is found six times as fast.
TERM = r"[a-z0-9\x80-\x{10FFFF}]+"
WINDOW, PER_HIT = 13, 20
NEAR_SHARE, NEAR_TERMS = 0.8, 5
SMALL, CHUNK, SALTS = 16 << 20, 64, 16
PIECES = "array<struct<from:int,near_at:int,near:array<string>>>"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(TERM), F.lit(0))


def sendable(df: DataFrame, bytes_of: Column) -> bool:
    """Do the rows' measured bytes allow to send the table to every executor?"""
    return (df.agg(F.sum(bytes_of + 64)).first()[0] or 0) <= SMALL


def small(df: DataFrame, bytes_of: Column) -> DataFrame:
    """The table with a broadcast hint if it is small enough."""
    return F.broadcast(df) if sendable(df, bytes_of) else df


def with_tests(postings: DataFrame, tests: DataFrame) -> DataFrame:
    """Postings joined to the windows whose rarest term they are of. Tests that are not broadcast come in SALTS copies, over which each term's postings are dealt."""
    if sendable(tests, F.octet_length("win") * 4):
        return postings.join(F.broadcast(tests), postings["term"] == tests["a"])
    left = postings.withColumn("_salt", F.pmod("rk", F.lit(SALTS)).cast("int"))
    right = tests.withColumn("_own", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, (F.col("term") == F.col("a")) & (F.col("_salt") == F.col("_own"))).drop("_salt", "_own")


def test_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item_id, win, terms): every run of n words; shorter items are one window."""
    words = benchmark.select("item_id", terms(F.col("text")).alias("w")).where(F.size("w") > 0)
    at = words.select("item_id", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))).alias("i"))
    return at.select("item_id", F.slice("w", F.col("i"), n).alias("terms")).withColumn("win", F.array_join("terms", " ")).distinct()


def anchored(windows: DataFrame, seen: DataFrame) -> DataFrame:
    """(win, terms, length, kinds, a, a_at, n, b, b_at, every) of each different window: its rarest term a, which n postings have, the next b, and whether all terms occur."""
    every = windows.select("win", "terms").dropDuplicates(["win"])
    ranked = every.select("win", F.posexplode("terms").alias("at", "term")).join(seen, "term", "left")
    ranked = ranked.groupBy("win").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("term").alias("term"), F.col("at").alias("at")))).alias("all"))
    # Proximity looks for the rarest terms that do occur.
    ranked = ranked.withColumn("by", F.filter("all", lambda x: x["n"] > 0)).where(F.size("by") > 0)
    other = F.try_element_at(F.filter("by", lambda x: x["term"] != F.col("by")[0]["term"]), F.lit(1))
    ranked = ranked.select("win", F.col("by")[0].alias("a"), other.alias("b"), (F.size("by") == F.size("all")).alias("every"))
    out = ranked.join(every, "win").withColumn("kinds", F.array_distinct("terms"))
    out = out.where(F.col("every") | (F.size("kinds") >= NEAR_TERMS) & F.col("b").isNotNull())
    return out.select("win", "terms", F.size("terms").alias("length"), "kinds", F.col("a.term").alias("a"), F.col("a.at").alias("a_at"), F.col("b.term").alias("b"), F.col("b.at").alias("b_at"), "every")


def occurrences(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(texts(doc_id, rk, n_words), exact(doc_id, rk, start, length, win), near(doc_id, rk, at, win), windows(item_id, win, terms))"""
    rows = keyed(docs)
    windows = written(test_windows(benchmark, n), "test-windows")
    vocabulary = small(windows.select(F.explode("terms").alias("term")).distinct(), F.octet_length("term"))
    seen = rows.select(F.explode(terms(F.col("text"))).alias("term")).join(vocabulary, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    anchors = written(anchored(windows, written(seen, "test-terms")), "test-anchors")

    index = small(anchors.select(F.explode(F.array_compact(F.array("a", "b"))).alias("_term")).distinct(), F.octet_length("_term"))
    # Texts go through in pieces of CHUNK words with n-1 neighbours on both sides: what each posting
    # carries along is short however long its document is. One more piece, without words, says how many words there are.
    around = lambda i: F.greatest(i - (n - 1), F.lit(0))
    piece = lambda i: F.struct(i.alias("from"), around(i).alias("near_at"), F.slice("w", around(i) + 1, CHUNK + 2 * (n - 1)).alias("near"))
    words = rows.select("doc_id", "rk", F.coalesce(terms(F.col("text")), F.array().cast("array<string>")).alias("w"))
    size = F.array(F.struct(F.size("w").alias("from"), F.lit(0).alias("near_at"), F.lit(None).cast("array<string>").alias("near")))
    split = F.when(F.size("w") > 0, F.transform(F.sequence(F.lit(0), F.size("w") - 1, F.lit(CHUNK)), piece)).otherwise(F.array().cast(PIECES))
    pieces = words.select("doc_id", "rk", F.explode(F.concat(size, split)).alias("p"))
    centre = F.slice("p.near", F.col("p.from") - F.col("p.near_at") + 1, CHUNK)
    posted = pieces.select("doc_id", "rk", "p", F.posexplode_outer(centre).alias("k", "term")).join(index, F.col("term") == F.col("_term"), "left").where("_term is not null or p.near is null")
    posted = posted.withColumn("at", F.col("p.from") + F.coalesce("k", F.lit(0)))
    shift = around(F.col("at")) - F.col("p.near_at")
    stored = written(posted.select("term", "doc_id", "rk", "at", around(F.col("at")).alias("near_at"), F.slice("p.near", shift + 1, 2 * n - 1).alias("near")), "postings")
    texts, postings = stored.where("term is null").select("doc_id", "rk", F.col("at").cast("long").alias("n_words")), stored.where("term is not null")

    hits = with_tests(postings, anchors).withColumn("start", F.col("at") - F.col("a_at"))
    around_a = F.array_contains("near", F.col("b")) & (F.size("kinds") >= NEAR_TERMS)
    close = F.when(around_a, F.size(F.array_intersect("near", "kinds")) >= F.ceil(F.size("kinds") * NEAR_SHARE)).otherwise(F.lit(False))
    fits = F.col("every") & (F.col("start") >= 0) & (F.slice("near", F.greatest(F.col("start") - F.col("near_at") + 1, F.lit(1)), F.col("length")) == F.col("terms"))
    second = postings.select(F.col("rk").alias("rk2"), F.col("doc_id").alias("doc2"), F.col("term").alias("term2"), F.col("at").alias("at2")).distinct()
    candidates = hits.where(F.col("every") & (F.col("start") >= 0)).select("doc_id", "rk", "start", "length", "win", "terms", "near_at", "near", "b", "b_at")
    both = candidates.where("b is not null").join(second, (F.col("rk") == F.col("rk2")) & F.col("doc_id").eqNullSafe(F.col("doc2")) & (F.col("b") == F.col("term2")) & (F.col("start") + F.col("b_at") == F.col("at2")), "left_semi")
    exact = both.unionByName(candidates.where("b is null")).where(F.slice("near", F.greatest(F.col("start") - F.col("near_at") + 1, F.lit(1)), F.col("length")) == F.col("terms"))
    near = hits.where(~fits & close).select("doc_id", "rk", "at", "win").distinct()
    return texts, exact.select("doc_id", "rk", "start", "length", "win").distinct(), near, windows


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, per_hit: int = PER_HIT) -> DataFrame:
    """(doc_id, rk, n_words, n_hit, n_items, items_sha256, contaminated, n_near); n_near: items near, but nowhere exactly, in the document."""
    texts, found, near, windows = occurrences(docs, benchmark, n)
    found, near = written(found, "test-hits"), written(near, "test-near")
    runs = found.groupBy("doc_id", "rk").agg(F.array_sort(F.collect_set(F.struct(F.col("start").cast("long").alias("s"), (F.col("start") + F.col("length")).cast("long").alias("e")))).alias("runs"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate("runs", zero, lambda s, x: F.struct((s["n"] + F.greatest(x["e"] - F.greatest(x["s"], s["end"]), F.lit(0).cast("long"))).alias("n"), F.greatest(s["end"], x["e"]).alias("end")))["n"]
    names = small(windows.select("win", F.col("item_id").cast("string").alias("item")), F.octet_length("win"))
    # Both kinds of matches by item: an item that is near and exact somewhere counts as exact.
    each = found.select("doc_id", "rk", "win", F.lit(True).alias("exact")).unionByName(near.select("doc_id", "rk", "win", F.lit(False).alias("exact"))).distinct()
    each = each.join(names, "win").groupBy("doc_id", "rk", "item").agg(F.max("exact").alias("exact"))
    items = each.groupBy("doc_id", "rk").agg(F.array_sort(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"), F.count(F.when(~F.col("exact"), F.col("item"))).alias("n_near"))
    same = (F.col("rk") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("d"))
    hits = items.join(runs.select(F.col("doc_id").alias("d"), F.col("rk").alias("r"), covered.alias("n_hit")), same, "left")
    hits = written(hits.select("doc_id", "rk", "n_hit", F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items"), "n_near"), "test-documents")
    none = F.lit(0).cast("long")
    joined = texts.join(hits, same_row(texts, hits), "left").select(texts["doc_id"], texts["rk"], "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"), F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), F.coalesce("n_near", none).alias("n_near"))
    return joined.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * per_hit >= F.col("n_words")))
