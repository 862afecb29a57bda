"""Mixing sources to target weights by Pareto order sampling.

A document's expected copies are proportional to its weight in its source, never above ``MOST``, and add
up to the source's target. Whole copies are certain. The remainder is the document's inclusion probability
p in a sample of fixed size: it draws a uniform number u from its id and text and is ranked by its odds
u/(1-u) over its inclusion odds p/(1-p); documents enter in rank order until their words come nearest to
what the target still lacks. The cut is found from histograms of the rank, refined where the target falls,
so no source is ever gathered or sorted in one task.

Weights count in steps of 1/64 up to 1024, so that a source has a bounded number of weight classes; the
default weight is the number of binary digits of the document's size: long documents are likelier.
Null text has no words, null source is a source of its own and comes last. Rows that repeat id and text
share one draw and are taken together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
BINS, ROUNDS = 512, 4
STEPS, MOST_WEIGHT = 64, 1024


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target): weights in source order, capped at MOST times the size, excess reshared.

    The fixed point has a closed form: in order of cap/weight, a source is capped while its cap per
    weight is at most the level (share left) / (weight left) before it; the level only falls after that.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("w", weight.cast("long")).withColumn("cap", (F.col("source_size") * MOST).cast("long"))
    every = Window.partitionBy()
    up = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every) * F.lit(SHARE)
    per = per.withColumn("level", (total - F.coalesce(F.sum("cap").over(up), F.lit(0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(up), F.lit(0))))
    free = F.col("cap") / F.col("w") > F.col("level")
    level = F.max(F.when(free, F.col("level"))).over(every)
    return per.select("source", "source_size", F.when(free, F.col("w") * level).otherwise(F.col("cap").cast("double")).alias("target"))


def class_copies(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, x, whole, f, need, source_size, target) of each weight class (source, x, size).

    Expected copies are level * x, at most MOST. Classes reach MOST in falling order of x, so the level is
    that of the first class, in this order, that stays below MOST by the level of what is left.
    """
    falling = Window.partitionBy("source").orderBy(F.desc("x")).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("source").orderBy(F.desc("x")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    own = Window.partitionBy("source")
    known = classes.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    known = known.withColumn("level", F.try_divide(F.col("target") - F.coalesce(F.sum("size").over(falling), F.lit(0)) * MOST, F.sum(F.col("x") * F.col("size")).over(rest)))
    free = F.coalesce(F.col("level") * F.col("x") < MOST, F.lit(False))
    known = known.withColumn("free", free).withColumn("level", F.max(F.when(free, F.struct("x", "level"))).over(own)["level"])
    copies = F.when(F.col("target") <= 0, F.lit(0.0)).when(F.col("free"), F.col("level") * F.col("x")).otherwise(F.lit(float(MOST)))
    known = known.withColumn("copies", copies).withColumn("whole", F.floor("copies").cast("long"))
    need = F.col("target") - F.sum(F.col("whole") * F.col("size")).over(own)
    return known.select("source", "x", "whole", (F.col("copies") - F.col("whole")).alias("f"), need.alias("need"), "source_size", "target")


def mix(docs: DataFrame, seed: int = 0, weight: Column | None = None) -> DataFrame:
    """(doc_id, rk, source, size, source_size, target, p, copies, taken); p: inclusion probability beside the whole copies."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"/{seed}/"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    u = (F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    given = [] if weight is None else [weight.cast("double").alias("given")]
    raw = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rk"), "source", size.alias("size"), u.alias("u"), *given)
    x = F.length(F.bin("size")) if weight is None else F.coalesce("given", F.lit(1.0))
    x = F.least(F.greatest(F.round(x * STEPS), F.lit(1)), F.lit(MOST_WEIGHT * STEPS)).cast("long")
    sized = written(raw.withColumn("x", x).drop("given"), "mix-sizes")
    targets = written(source_targets(sized), "mix-targets")
    classes = written(class_copies(sized.groupBy("source", "x").agg(F.sum("size").alias("size")), targets), "mix-classes")

    # One row a source (or a source and weight class): broadcast by its measured size, shuffled beyond Spark's threshold.
    def by_source(a: DataFrame, b: DataFrame, how: str = "left", on: tuple[str, ...] = ("source",)) -> DataFrame:
        b = b.withColumnsRenamed({c: f"_{c}" for c in on})
        return a.join(b, reduce(Column.__and__, [a[c].eqNullSafe(b[f"_{c}"]) for c in on]), how).drop(*[f"_{c}" for c in on])

    p = F.least(F.greatest("f", F.lit(1e-12)), F.lit(1 - 1e-12))
    q = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    # In (0, 1) and of the same order as q: histograms need a bounded range.
    ranked = by_source(sized, classes, "left", ("source", "x")).withColumn("z", q / (1 + q))
    drawn = ranked.where("f > 0").select("source", "z", "size")

    cut = written(classes.select("source", "need", F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"), F.lit(0).cast("long").alias("done")).distinct(), "mix-cut")
    for _ in range(ROUNDS):
        at = by_source(drawn, cut, "inner").where((F.col("z") >= F.col("lo")) & (F.col("z") < F.col("hi")))
        step = (F.col("hi") - F.col("lo")) / BINS
        bins = at.withColumn("bin", F.least(F.floor((F.col("z") - F.col("lo")) / step), F.lit(BINS - 1))).groupBy("source", "bin").agg(F.sum("size").alias("s"))
        run = by_source(bins, cut, "inner").withColumn("to", F.col("done") + F.sum("s").over(Window.partitionBy("source").orderBy("bin")))  # BINS rows a source
        first = run.where(F.col("to") >= F.col("need")).groupBy("source").agg(F.min_by(F.struct("bin", (F.col("to") - F.col("s")).alias("done")), "bin").alias("b"))
        past = by_source(cut, first).withColumn("step", step)
        cut = written(
            past.select(
                "source", "need",
                F.when(F.col("b").isNull(), F.col("lo")).otherwise(F.col("lo") + F.col("b.bin") * F.col("step")).alias("lo"),
                F.when(F.col("b").isNull(), F.col("hi")).when(F.col("b.bin") == BINS - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("b.bin") + 1) * F.col("step")).alias("hi"),
                F.coalesce(F.col("b.done"), F.col("done")).alias("done"),
            ), "mix-cut",
        )
    # What is left lies within 512**-4 of the rank's range: rows with (nearly) the same draw. One step decides.
    last = by_source(drawn, cut, "inner").where((F.col("z") >= F.col("lo")) & (F.col("z") < F.col("hi"))).groupBy("source").agg(F.sum("size").alias("tail"))
    edge = by_source(cut, last)
    both = F.col("done") + F.coalesce(F.col("tail"), F.lit(0))
    # Written, so that its size is known: one row a source is broadcast, not joined by the documents' sources.
    edge = written(edge.select("source", F.when(F.abs(both - F.col("need")) <= F.abs(F.col("done") - F.col("need")), F.col("hi")).otherwise(F.col("lo")).alias("edge")), "mix-edge")
    taken = by_source(ranked, edge).withColumn("copies", F.col("whole") + F.when((F.col("f") > 0) & (F.col("z") < F.col("edge")), 1).otherwise(0))
    return taken.select("doc_id", "rk", "source", "size", "source_size", "target", F.col("f").alias("p"), "copies", (F.col("copies") * F.col("size")).alias("taken"))
