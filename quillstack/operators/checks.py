"""Checks and differences between builds: anti joins and outer joins."""

from __future__ import annotations

import pandas as pd
import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import SNAKE, links_in, resolved, without_stamp
from ..plans.shipping import ship

RESERVED = ("index.md", "log.md")


def dangling_links(texts: DataFrame, existing: DataFrame) -> DataFrame:
    """(path, raw) of links in texts(path, content) whose target is not in existing(path)."""
    found = texts.select("path", F.explode(links_in(F.col("content"))).alias("raw"))
    aimed = found.withColumn("_target", resolved(F.col("raw"), F.col("path"))).where("_target is not null")
    return aimed.join(existing.select(F.col("path").alias("_target")), "_target", "left_anti").select("path", "raw")


def missing_anchors(files: DataFrame) -> DataFrame:
    """(path, target): jumps in files(path, content) to an anchor that the same file lacks."""
    aims = files.select("path", F.explode(F.regexp_extract_all("content", F.lit(r"\]\(#([^)\s]+)\)"), F.lit(1))).alias("target")).distinct()
    have = files.select("path", F.explode(F.regexp_extract_all("content", F.lit('<a id="([^"]+)"></a>'), F.lit(1))).alias("target"))
    return aims.join(have, ["path", "target"], "left_anti")


def duplicate_paths(files: DataFrame) -> DataFrame:
    return files.groupBy("path").count().where("count > 1")


def nested_keys(texts: DataFrame) -> DataFrame:
    """(path, dotted, name, value): every key of the YAML in texts(path, yaml); lists add no part to the path."""
    ship(texts.sparkSession)

    def walk(value, prefix=""):
        if isinstance(value, dict):
            for key, inner in value.items():
                yield f"{prefix}{key}", str(key), inner if isinstance(inner, str) else None if inner in (None, [], {}) else str(inner)
                yield from walk(inner, f"{prefix}{key}.")
        elif isinstance(value, list):
            for one in value:
                yield from walk(one, prefix)

    def run(batches):
        for batch in batches:
            rows = [(p, *x) for p, y in zip(batch["path"], batch["yaml"], strict=True) for x in walk(yaml.safe_load(y or "") or {})]
            yield pd.DataFrame(rows, columns=["path", "dotted", "name", "value"])

    return texts.select("path", "yaml").mapInPandas(run, "path string, dotted string, name string, value string")


def schema_problems(texts: DataFrame, existing: DataFrame) -> DataFrame:
    """(path, problem) for texts(path, yaml, has_frontmatter): required fields, snake_case names, resources in the bundle."""
    own = texts.where(F.col("path").endswith(".md") & ~F.substring_index("path", "/", -1).isin(*RESERVED))
    bare = own.where(~F.col("has_frontmatter")).select("path", F.lit("no frontmatter").alias("problem"))
    with_yaml = own.where("has_frontmatter")
    keys = nested_keys(with_yaml)
    given = keys.where("value is not null and value not in ('', '0', 'False') and dotted in ('type', 'title')").select("path", F.col("dotted").alias("key"))
    wanted = with_yaml.select("path", F.explode(F.array(F.lit("type"), F.lit("title"))).alias("key"))
    lacking = wanted.join(given, ["path", "key"], "left_anti").select("path", F.concat(F.lit("missing "), "key").alias("problem"))
    odd = keys.where(~F.col("name").rlike(SNAKE)).select("path", F.concat(F.lit("field "), "dotted", F.lit(" is not snake_case")).alias("problem"))
    aims = keys.where("dotted = 'resource' and startswith(value, '/')").select("path", "value", F.regexp_replace("value", "^/+", "").alias("_at"))
    lost = aims.join(existing.select(F.col("path").alias("_at")), "_at", "left_anti").select("path", F.concat(F.lit("resource "), "value", F.lit(" not found in the bundle")).alias("problem"))
    return bare.unionByName(lacking).unionByName(odd).unionByName(lost)


def tree_diff(new: DataFrame, old: DataFrame, key: str = "path", value: str = "content") -> DataFrame:
    """(key, change): added, removed or changed."""
    a = new.select(key, F.col(value).alias("_new"), F.lit(True).alias("_n"))
    b = old.select(key, F.col(value).alias("_old"), F.lit(True).alias("_o"))
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(~F.col("_new").eqNullSafe(F.col("_old")), "changed")
    return a.join(b, key, "full_outer").select(key, change.alias("change")).where("change is not null")


def change_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("change").count()


def retained(new: DataFrame, old: DataFrame, now: str, stamp: str) -> DataFrame:
    """(path, content) of new with its stamp filled: the old time where nothing else changed, else now."""
    was = old.select("path", F.col("content").alias("_old"))
    at = F.regexp_extract("_old", r"(?m)^\s+at: (.*)$", 1)
    same = F.coalesce(without_stamp(F.col("_old")) == without_stamp(F.col("content")), F.lit(False)) & (at != "")
    return new.join(was, "path", "left").select("path", F.replace("content", F.lit(stamp), F.when(same, at).otherwise(F.lit(f"'{now}'"))).alias("content"))


def shape_diff(real: DataFrame, copy: DataFrame) -> DataFrame:
    """(doc_id, name, problem) between two sets of concepts: missing, extra, title or position changed."""
    side = lambda df, s: df.select("doc_id", "name", F.col("title").alias(f"_title{s}"), F.filter("position", lambda f: F.coalesce(f["v"], F.lit("")) != "").alias(f"_place{s}"), F.lit(True).alias(f"_has{s}"))
    both = side(real, 1).join(side(copy, 2), ["doc_id", "name"], "full_outer")
    fields = F.array_join(F.array_sort(F.array_distinct(F.transform(F.concat(F.array_except("_place1", "_place2"), F.array_except("_place2", "_place1")), lambda f: f["k"]))), ", ")
    problems = F.array_compact(F.array(
        F.when(F.col("_has2").isNull(), F.lit("missing")), F.when(F.col("_has1").isNull(), F.lit("extra")),
        F.when(F.col("_has1") & F.col("_has2") & ~F.col("_title1").eqNullSafe(F.col("_title2")), F.lit("title changed")), F.when(F.col("_has1") & F.col("_has2") & (fields != ""), F.concat(F.lit("position changed: "), fields)),
    ))
    return both.select("doc_id", "name", F.explode(problems).alias("problem"))
