"""Secret scans with corpus-wide ownership frequency, in DataFrame operations only.

Candidates are found by fixed patterns with their positions. Every candidate's hash is aggregated over
the corpus: in how many repositories (documents) and under how many owners (sources) does it occur? One
that many owners hold, or that is in many repositories whatever the number of owners, is a copied example;
any other that a single owner holds looks live. Beside the base kinds, any long mixed live token is added as a span of kind ``owned``, unless it
overlaps a base span.

Null text is empty; null source is an owner of its own. Rows that repeat id, text and source are one repository.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# The patterns of the base kinds. Letters of the names match in either case.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
ASSIGN_MIN, EXAMPLE_OWNERS, EXAMPLE_REPOS = 12, 3, 20
SPAN = "array<struct<start:bigint,kind:int,end:bigint,hash:binary>>"


def running(a: Column) -> Column:
    """Sums of an array up to each element, in blocks of about the root of its size: appending to one long array would copy it each time."""
    zero = F.lit(0).cast("long")
    step = F.greatest(F.ceil(F.sqrt(F.size(a))).cast("int"), F.lit(1))
    none = F.struct(zero.alias("sum"), F.array().cast("array<bigint>").alias("out"))

    def sums(xs: Column, with_own: bool) -> Column:
        def add(s: Column, x: Column) -> Column:
            total = s["sum"] + x
            return F.struct(total.alias("sum"), F.concat(s["out"], F.array(total if with_own else s["sum"])).alias("out"))

        return F.aggregate(xs, none, add)["out"]

    blocks = F.transform(F.sequence(F.lit(1), F.size(a), step), lambda s: sums(F.slice(a, s, step), True))
    joined = F.transform(F.array(blocks), lambda bs: F.zip_with(bs, sums(F.transform(bs, lambda x: F.element_at(x, -1)), False), lambda x, before: F.transform(x, lambda v: v + before)))
    return F.when(F.size(a) == 0, F.array().cast("array<bigint>")).otherwise(F.flatten(joined[0]))


def matches(text: Column, pattern: str, group: int, keep) -> Column:
    """Matches in order: (gap, size) with the code points before it since the last one and its own, (keep, hash) of its value."""
    p = F.lit(pattern)
    match = F.regexp_extract_all(text, p, F.lit(0))
    parts = F.arrays_zip(match.alias("match"), F.regexp_extract_all(text, p, F.lit(group)).alias("value"), F.split(text, pattern, -1).alias("gap"))
    long = lambda c: F.length(c).cast("long")
    made = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda x: F.struct(long(x["gap"]).alias("gap"), long(x["match"]).alias("size"), keep(x["value"]).alias("keep"), F.when(keep(x["value"]), F.unhex(F.sha2(x["value"], 256))).alias("hash")))
    return F.when(text.rlike(pattern), made).otherwise(F.array().cast("array<struct<gap:bigint,size:bigint,keep:boolean,hash:binary>>"))


def placed(df: DataFrame, name: str, kind: int) -> DataFrame:
    """The column of matches as spans."""
    df = df.withColumn("_ends", running(F.transform(name, lambda x: x["gap"] + x["size"])))
    both = F.filter(F.arrays_zip(F.col(name).alias("m"), F.col("_ends").alias("end")), lambda x: x["m"]["keep"])
    made = F.transform(both, lambda x: F.struct((x["end"] - x["m"]["size"]).alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["m"]["hash"].alias("hash")))
    return df.withColumn(name, made.cast(SPAN)).drop("_ends")


def said(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def apart(df: DataFrame) -> DataFrame:
    """``more`` without spans that overlap a base span.

    A span overlaps as many base spans as begin before its end less those that end at its start or before.
    Both are counted in one sorted list of places: its own ends (0) and starts (3), starts (1) and ends (2) of base spans.
    """
    event = lambda at, what: F.struct(at.alias("at"), F.lit(what).alias("what"))
    every = F.concat(F.transform("base", lambda x: event(x["start"], 1)), F.transform("base", lambda x: event(x["end"], 2)), F.transform("more", lambda x: event(x["end"], 0)), F.transform("more", lambda x: event(x["start"], 3)))
    both = (F.size("base") > 0) & (F.size("more") > 0)
    df = df.withColumn("_e", F.when(both, F.array_sort(every)))
    flags = lambda what: running(F.transform("_e", lambda x: (x["what"] == what).cast("long")))
    df = df.withColumn("_begun", F.when(both, flags(1))).withColumn("_done", F.when(both, flags(2)))
    at = lambda name, what: F.transform(F.filter(F.arrays_zip(F.col("_e").alias("e"), F.col(name).alias("n")), lambda x: x["e"]["what"] == what), lambda x: x["n"])
    free = F.filter(F.arrays_zip(F.col("more").alias("m"), at("_begun", 0).alias("begun"), at("_done", 3).alias("done")), lambda x: x["begun"] == x["done"])
    return df.withColumn("more", F.when(both, F.transform(free, lambda x: x["m"])).otherwise(F.col("more"))).drop("_e", "_begun", "_done")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, rk, source, base, more): candidate spans of every text, in order."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rk"), "source", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    always = lambda v: F.lit(True)
    mixed = lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")
    found = rows.select(
        "doc_id", "rk", "source", matches(text, ASSIGN, 2, lambda v: F.length(v) >= ASSIGN_MIN).alias("assign"),
        matches(text, ACCESS, 0, always).alias("access"), matches(text, HEX, 0, always).alias("hex"), matches(text, TOKEN, 0, mixed).alias("more"),
    )
    for kind, name in enumerate(("assign", "access", "hex", "more")):
        found = placed(found, name, kind)
    return apart(found.select("doc_id", "rk", "source", F.array_sort(F.concat("assign", "access", "hex")).alias("base"), "more"))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_repos, n_owners) over candidates(doc_id, rk, source, hash), one row a document and hash."""
    per_owner = candidates.select("hash", "source", "doc_id", "rk").distinct().groupBy("hash", "source").agg(F.count(F.lit(1)).alias("repos"))
    return per_owner.groupBy("hash").agg(F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))


def find_secrets(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """(doc_id, rk, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, n_repos); n_repos: of the row's candidate in most repositories."""
    found = written(scan(docs), "secrets")
    places = found.select("doc_id", "rk", "source", F.explode(F.concat("base", "more")).alias("s")).select("doc_id", "rk", "source", "s.*").distinct()
    each = written(places, "secret-places")
    known = written(ownership(each.select("doc_id", "rk", "source", "hash").distinct()), "secret-owners")
    copied = (F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos)
    live = (F.col("n_owners") == 1) & ~copied
    verdict = each.join(known, "hash").groupBy("doc_id", "rk").agg(
        F.count_distinct(F.when(live, F.col("hash"))).alias("n_live"), F.count_distinct(F.when(copied, F.col("hash"))).alias("n_example"), F.max("n_repos").alias("n_repos"),
        F.collect_set(F.when(live & (F.col("kind") == KINDS.index("owned")), F.struct("start", "kind", "end"))).alias("owned"),
    )
    verdict = written(verdict, "secret-verdicts").withColumnsRenamed({"doc_id": "_doc", "rk": "_rk"})
    out = found.join(verdict, (found["rk"] == verdict["_rk"]) & found["doc_id"].eqNullSafe(verdict["_doc"]), "left")
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    number = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    every = F.when(F.size("owned") > 0, F.array_sort(F.concat(base, "owned"))).otherwise(base)
    return out.select("doc_id", "rk", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(said(base), 256).alias("base_sha256"), said(every).alias("spans"), number("n_live"), number("n_example"), number("n_repos"))
