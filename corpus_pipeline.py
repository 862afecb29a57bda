"""A training-data pipeline over ``documents``: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. The first four
return the columns of ``documents``; mixing repeats a document's row for each copy that it takes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.llm.common import table, written
from quillstack.llm.decontamination import WINDOW, decontaminate
from quillstack.llm.language import identify
from quillstack.llm.mixing import mix
from quillstack.llm.simhash import near_duplicates
from quillstack.llm.token_binary import token_output
from quillstack.plans.barrier import drop_tables, last_table, mark

#: Some stages can't be said in SQL (language model, tokens); the tests hold run() against brute force.
ORACLE_SQL = None


#: A near-duplicate pair: of two SimHash fingerprints of five-word shingles one differs in at most NEAR of 64 bits, both together in
#: at most GUARD of 128 (a similarity of 0.8).
SHINGLE, NEAR, GUARD = 5, 8, 26
#: A language is identified if its posterior is over this.
SURE = 0.5


def matched(docs: DataFrame, verdicts: DataFrame, how: str, *given: str) -> DataFrame:
    """(row struct, given columns) of docs joined to verdicts(doc_id, rk, ...) that are unique by row key.

    The document's columns travel in one struct, so that no name of theirs meets one of ours.
    """
    left = docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row"), F.xxhash64("doc_id", "text").alias("key"))
    right = verdicts.select(F.col("doc_id").alias("_doc"), "rk", *given)
    return left.join(right, (left["key"] == right["rk"]) & left["row.doc_id"].eqNullSafe(right["_doc"]), how).select("row", *(given if how == "inner" else ()))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose language is identified: one learned language has more than SURE of the posterior.

    Null texts and texts without a letter have no language. Rows that repeat id and text share a verdict. Nothing stays of a
    table without a labelled text to learn from.
    """
    found = identify(docs, public_tokenizers.path("piece_bpe_32k.model"))
    rejected = written(found.where((F.col("lang_pred") == "und") | (F.col("score") <= SURE)).select("doc_id", "rk").distinct(), "rejected")
    return matched(docs, rejected, "left_anti").select("row.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest doc_id (null is the largest), then of the smallest row key; one row of it."""
    found = written(near_duplicates(docs, SHINGLE, NEAR, guard=GUARD).select("doc_id", "rk", "root"), "duplicates")
    rows = found.groupBy("root", "doc_id", "rk").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rk", "n")).alias("first"))
    kept = written(first.select("first.doc_id", "first.rk", "first.n"), "kept")
    # Rows that agree in id and text are told apart by nothing but their other columns; one of them stays.
    once = matched(docs, kept, "left_semi")
    again = kept.where("n > 1")
    if again.isEmpty():
        return once.select("row.*")
    once = once.select("row.*")
    one = matched(once, again, "left_semi").groupBy("row.doc_id", F.xxhash64("row.doc_id", "row.text")).agg(F.first("row").alias("row"))
    return matched(once, again, "left_anti").unionByName(one.select("row")).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a whole window of a benchmark item, however long they are, or short items in a twentieth of their words.

    Null texts hold nothing and stay. Rows that repeat id and text share a verdict. An empty benchmark lets all stay.
    """
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    dirty = written(found.where((F.col("n_hit") >= WINDOW) | F.col("contaminated")).select("doc_id", "rk").distinct(), "dirty")
    return matched(docs, dirty, "left_anti").select("row.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's row once for each copy that the mix takes.

    Null texts have no words and weigh the least. Rows that repeat id and text are taken together, each by its own source.
    """
    # The source belongs to the decision: rows that share id and text may come from several sources.
    taken = written(mix(docs).where("copies > 0").select("doc_id", "rk", "source", "copies").distinct(), "copies")
    found = matched(docs, taken.groupBy("doc_id", "rk").agg(F.collect_set(F.struct("source", "copies")).alias("by_source")), "inner", "by_source")
    own = F.filter("by_source", lambda x: x["source"].eqNullSafe(F.col("row.source")))
    times = F.when(F.size(own) > 0, own[0]["copies"].cast("int")).otherwise(F.lit(0))
    return found.withColumn("times", times).where("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every copy, in ascending doc_id order. Null texts are an end id alone."""
    return token_output(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language_id), ("SimHash near-dedup", simhash_dedup), ("benchmark decontamination", decontamination), ("mixing sources to target weights", mixing), ("token-ID / binary output", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. The tables that a stage made on its way are deleted once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = mark()
        docs = written(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name))
        drop_tables(spark, before, keep=last_table())
    return STAGES[-1][1](spark, docs, sf_dir)
