"""Transcripts and file trees as tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.patterns import strip

FRONT = r"(?s)\A---\r?\n(.*?)\r?\n---\r?\n?(.*)\z"
PAGE = r"^<!--\s*page\s+(\d+)\s*-->$"
BOLD = r"^\*\*(.+)\*\*$"


def frontmatter(content: Column) -> tuple[Column, Column]:
    """(YAML text or null, body). Text without frontmatter is all body."""
    has = content.rlike(FRONT)
    return F.when(has, F.regexp_extract(content, FRONT, 1)), F.when(has, F.regexp_extract(content, FRONT, 2)).otherwise(content)


def transcript_lines(bodies: DataFrame) -> DataFrame:
    """bodies(doc_id, body) -> lines. Page marks set the page of what follows; other comments and blanks go."""
    raw = bodies.select("doc_id", F.posexplode(F.split("body", r"\r\n|\r|\n")).alias("raw_pos", "raw")).select("doc_id", "raw_pos", strip(F.col("raw")).alias("t")).where("t != ''")
    by = Window.partitionBy("doc_id").orderBy("raw_pos")
    mark = F.when(F.col("t").rlike(PAGE), F.regexp_extract("t", PAGE, 1).cast("int"))
    paged = raw.withColumn("page", F.last(mark, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    inner = F.regexp_extract("t", BOLD, 1)
    bold = (inner != "") & ~inner.contains("**")
    kept = paged.where(~F.col("t").startswith("<!--"))
    return kept.select(
        "doc_id", (F.row_number().over(by) - 1).alias("pos"), F.when(bold, strip(inner)).otherwise(F.col("t")).alias("text"), bold.alias("bold"), "page",
        F.lit(None).cast("int").alias("size"), F.lit(None).cast("double").alias("x0"), F.lit(None).cast("string").alias("style"),
    )


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, yaml, body) of the transcript files at a path; the id is the file's name."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.md)?$", 1).alias("doc_id"), F.col("value").alias("content"))
    yaml_text, body = frontmatter(F.col("content"))
    return files.select("doc_id", yaml_text.alias("yaml"), body.alias("body"))


def stale(transcripts: DataFrame, sources: DataFrame) -> DataFrame:
    """doc_ids whose source's SHA-256 is not the recorded one. transcripts(doc_id, source_sha256), sources(doc_id, content)."""
    now = sources.select("doc_id", F.sha2("content", 256).alias("now"))
    return transcripts.join(now, "doc_id").where(~F.col("source_sha256").eqNullSafe(F.col("now"))).select("doc_id")


def read_tree(spark: SparkSession, path: str, recursive: bool = True, pattern: str | None = None) -> DataFrame:
    """(path, content) of a folder; markdown with plain line ends, other files as they are (binary)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    root = re.sub("^[a-z]+:/*", "/", path.rstrip("/") + "/")
    rel = F.substring_index(F.regexp_replace("path", "^[a-z]+:/*", "/"), root, -1)
    text = F.replace(F.decode("content", "utf-8"), F.lit("\r\n"), F.lit("\n"))
    return reader.load(path).select(rel.alias("path"), F.when(F.col("path").endswith(".md"), text).alias("text"), F.when(~F.col("path").endswith(".md"), F.col("content")).alias("bytes"))


def authored_files(tree: DataFrame) -> DataFrame:
    """Hand-written files as they go into the bundle: all but the folder's own README.md."""
    return tree.where("path <> 'README.md'")


def choose_source(manifest: list[dict], have_transcript: set[str], have_source: set[str], rules: dict[str, dict] | None = None) -> list[dict]:
    """For each document the reader to use, or why there is none. Config-sized. Rules by document may name the engine."""
    out = []
    for doc in manifest:
        name, file = doc["id"], str(doc.get("source", "")).rpartition("/")[2]
        ending = "." + file.rpartition(".")[2].lower()
        engine = ((rules or {}).get(name, doc).get("extract") or {}).get("engine")
        if name in have_transcript:
            kind, why = "transcript", None
        elif name not in have_source:
            kind, why = None, f"source not found: {file}"
        elif (engine, ending) in (("pdf-layout", ".pdf"), ("docx", ".docx")):
            kind, why = engine, None
        else:
            kind, why = None, f"no reader for {ending} without a transcript"
        out.append({"doc_id": name, "reader": kind, "reason": why})
    return out
