"""Concepts to files: one file a concept, one file a document, indexes, authored text."""

from __future__ import annotations

from functools import reduce

import yaml
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import __version__
from ..functions.patterns import strip
from ..functions.text import REFERENCE
from ..functions.yaml_text import to_yaml
from .assemble import item

STAMP = "__BUILT_AT__"
TOOL = f"quillstack {__version__}"
#: The position fields that name a concept's place, and those that group an index.
PLACE_FIELDS = ("article_number", "article_numbers", "clause_number", "clause_numbers", "paragraph_number", "section_number", "register")
GROUP_FIELDS = ("part", "chapter", "section")
FIELDS = "array<struct<k:string,v:string,kind:string>>"
IMAGE = r"^!\[[^\]]*\]\([^)]*\)$"


def kept(fields: Column) -> Column:
    """Fields that have a value."""
    return F.filter(fields, lambda f: F.coalesce(f["v"], F.lit("")) != "")


def rendered(fields: Column, body: Column) -> Column:
    head = F.when(F.size(fields) > 0, F.concat(F.lit("---\n"), to_yaml(fields), F.lit("---\n\n"))).otherwise(F.lit(""))
    return F.concat(head, strip(body), F.lit("\n"))


def source_entry(doc: dict) -> dict:
    last = doc.get("last-modified")
    entry = {"id": doc["id"], "title": doc.get("description"), "author": doc.get("author"), "last_modified": str(last) if last else None, "resource": doc.get("resource")}
    return {k: v for k, v in entry.items() if v is not None}


def dumped(value) -> str:
    return yaml.safe_dump(value, sort_keys=False, allow_unicode=True, width=10_000)


def raw(name: str, value) -> Column:
    return item(name, value if isinstance(value, Column) else F.lit(dumped(value)), "raw")


DOCUMENTS = "doc_id string, base string, concept_type string, resource string, sources string, title string"


def document_rows(spark: SparkSession, docs: list[dict]) -> DataFrame:
    """Manifest entries as rows: what their concepts' files say about the document."""
    rows = [(d["id"], (d.get("bundle-path") or "").strip("/") or None, d.get("concept-type"), d.get("resource"), dumped([source_entry(d)]), d.get("description") or d["id"]) for d in docs]
    return spark.createDataFrame(rows, DOCUMENTS)


def frontmatter() -> Column:
    """Ordered fields of a concept's file: type, title, description, resource, position, sources, generated, status."""
    head = [item("type", F.coalesce("type", "concept_type"), "str"), item("title", F.col("title"), "str"), item("description", strip(F.col("description")), "str"), item("resource", F.col("_resource"), "str")]
    tail = [raw("sources", F.col("sources")), raw("generated", {"by": TOOL, "at": STAMP}), item("status", F.col("status"), "str")]
    return kept(F.concat(F.array(*head), F.col("position").cast(FIELDS), F.array(*tail)))


def blocks(title: Column, body: Column) -> Column:
    return F.array_join(F.concat(F.array(F.concat(F.lit("# "), title)), body), "\n\n")


def concept_files(concepts: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, path, content, ord, fields) of concepts in documents with a place in the bundle: references become paths from its top."""
    of = docs.where("base is not null").select("doc_id", "base", "concept_type", F.col("resource").alias("_resource"), "sources")
    made = concepts.join(of, "doc_id").withColumn("fields", frontmatter())
    safe = F.regexp_replace("base", r"([\\\\$])", r"\\$1")
    body = F.regexp_replace(blocks(F.col("title"), F.col("body")), F.lit(REFERENCE), F.concat(F.lit("](/"), safe, F.lit("/$1.md)")))
    return made.select("doc_id", F.concat("base", F.lit("/"), "name", F.lit(".md")).alias("path"), rendered(F.col("fields"), body).alias("content"), "ord", "fields")


def legislation_files(concepts: DataFrame) -> DataFrame:
    tags = item("tags", F.array_join("tags", "\n"), "list")
    fields = kept(F.array(item("type", F.col("type"), "str"), item("title", F.col("title"), "str"), item("description", F.col("description"), "str"), item("resource", F.col("resource"), "str"), tags, raw("generated", {"by": TOOL, "at": STAMP}), item("status", F.col("status"), "str")))
    return concepts.withColumn("fields", fields).select(F.concat(F.lit("legislation/"), "name", F.lit(".md")).alias("path"), rendered(F.col("fields"), blocks(F.col("title"), F.col("body"))).alias("content"), F.lit(None).cast("int").alias("ord"), "fields")


def value_of(fields: Column, name: str) -> Column:
    return F.get(F.filter(fields, lambda f: f["k"] == name), F.lit(0))["v"]


def sections(concepts: DataFrame) -> DataFrame:
    """(doc_id, seq, anchor, content): a concept as part of a single file."""
    place = F.filter(F.transform(F.array(*map(F.lit, PLACE_FIELDS)), lambda n: F.get(F.filter("position", lambda f: (f["k"] == n) & (F.coalesce(f["v"], F.lit("")) != "")), F.lit(0))), lambda f: f.isNotNull())
    refs = F.transform(place, lambda f: F.concat(F.lit("- "), f["k"], F.lit(": "), F.replace(f["v"], F.lit("\n"), F.lit(", "))))
    about = F.array_compact(F.array(F.concat(F.lit("- title: "), "title"), F.when(F.coalesce("description", F.lit("")) != "", F.concat(F.lit("- description: "), strip(F.col("description"))))))
    body = F.regexp_replace(F.array_join("body", "\n\n"), REFERENCE, "](#$1)")
    parts = F.array(F.concat(F.lit('<a id="'), "name", F.lit('"></a>')), F.concat(F.lit("# "), "title"), F.array_join(F.concat(about, refs), "\n"), body)
    return concepts.select("doc_id", "seq", F.col("name").alias("anchor"), F.array_join(F.filter(parts, lambda p: p != ""), "\n\n").alias("content"))


def single_files(made: DataFrame, heads: DataFrame, order: str = "seq") -> DataFrame:
    """(doc_id, content): a document's sections in assembly order under its frontmatter; heads(doc_id, title, description, sources as YAML or null)."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), "anchor", "content"))), lambda x: x["content"]), "\n\n")
    fields = kept(F.array(item("title", F.col("title"), "str"), item("description", F.col("description"), "str"), raw("sources", F.col("sources")), item("generated_by", F.lit(TOOL), "str")))
    head = F.when(F.col("title").isNotNull(), fields).otherwise(F.array().cast(FIELDS))
    return made.groupBy("doc_id").agg(text.alias("body")).join(heads, "doc_id", "left").withColumn("fields", head).select("doc_id", rendered(F.col("fields"), F.col("body")).alias("content"))


def authored_sections(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """files(path, body) of hand-written text -> ((path, body), warnings(path, message)).

    The first heading goes; a second-level section with an image goes whole; before the first such
    section only the image lines go. Links into the bundle become jumps.
    """
    lines = files.select("path", F.posexplode(F.split(strip(F.col("body")), "\n")).alias("pos", "line")).where("not (pos = 0 and startswith(line, '# '))")
    by = Window.partitionBy("path").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("part", F.sum(F.col("line").startswith("## ").cast("int")).over(by)).withColumn("_image", strip(F.col("line")).rlike(IMAGE))
    lines = lines.withColumn("_any", F.max(F.col("_image").cast("int")).over(Window.partitionBy("path", "part")) == 1)
    warned = lines.where("_any").groupBy("path", "part").agg(F.min_by("line", "pos").alias("line")).select("path", F.concat("path", F.lit(": left out "), F.when(F.col("part") > 0, F.col("line")).otherwise("image")).alias("message"))
    text = lines.where("not (_any and part > 0) and not (_image and part = 0)").groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("b"))
    body = strip(F.regexp_replace("b", r"\]\(/[^)\s]*?/([^/)\s]+)\.md\)", "](#$1)"))
    return text.select("path", F.regexp_replace(body, "\n{3,}", "\n\n").alias("body")), warned


def indexes(files: DataFrame, titles: dict[str, str], top_title: str = "Bundle", version: str = "0.2", version_field: str = "version", description: str | None = None) -> DataFrame:
    """(path, content) of one index a folder: subfolders, then concepts by (ord, path) under group headings.

    files(path, title, description, ord, levels array<string>): levels are the first two group fields that
    a concept has. titles: folder -> shown name.
    """
    name = lambda d: F.coalesce(F.try_element_at(F.create_map(*[x for k, v in titles.items() if v for x in (F.lit(k), F.lit(v))]), d), F.substring_index(d, "/", -1)) if any(titles.values()) else F.substring_index(d, "/", -1)
    parts = F.split("path", "/")
    dirs = files.select(F.explode(F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("dir")).distinct()
    parent = F.when(F.col("dir").contains("/"), F.regexp_replace("dir", "/[^/]*$", "")).otherwise(F.lit(""))
    subs = dirs.where("dir != ''").select(parent.alias("dir"), F.col("dir").alias("sub")).groupBy("dir").agg(F.array_sort(F.collect_list("sub")).alias("subs"))
    own = F.when(F.col("path").contains("/"), F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.lit(""))
    by = Window.partitionBy("dir").orderBy(F.col("ord").asc_nulls_last(), "path")
    listed = files.withColumn("dir", own).withColumn("_n", F.row_number().over(by)).withColumn("_was", F.lag("levels").over(by))
    # A heading for each level whose value, or a level above it, changed.
    same = lambda i: F.coalesce(F.get("_was", F.lit(i)) == F.get("levels", F.lit(i)), F.lit(False))
    one = F.when((F.size("levels") > 0) & ~same(0), F.array(F.lit(""), F.concat(F.lit("## "), F.get("levels", F.lit(0))), F.lit(""))).otherwise(F.array().cast("array<string>"))
    two = F.when((F.size("levels") > 1) & ~(same(0) & same(1)), F.array(F.lit(""), F.concat(F.lit("### "), F.get("levels", F.lit(1))), F.lit(""))).otherwise(F.array().cast("array<string>"))
    entry = F.concat(F.lit("- ["), F.coalesce(F.when(F.col("title") != "", F.col("title")), F.substring_index("path", "/", -1)), F.lit("](/"), "path", F.lit(")"), F.when(F.coalesce("description", F.lit("")) != "", F.concat(F.lit(": "), "description")).otherwise(F.lit("")))
    entries = listed.groupBy("dir").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_n", F.concat(one, two, F.array(entry)).alias("l")))), lambda x: x["l"])).alias("files"))
    out = dirs.join(subs, "dir", "left").join(entries, "dir", "left")
    title = F.when(F.col("dir") == "", F.lit(top_title)).otherwise(name(F.col("dir")))
    none = F.array().cast("array<string>")
    lines = F.concat(
        F.array(F.concat(F.lit("# "), title), F.lit("")),
        F.when(F.col("subs").isNotNull(), F.concat(F.transform("subs", lambda s: F.concat(F.lit("- ["), name(s), F.lit("](/"), s, F.lit("/index.md)"))), F.array(F.lit("")))).otherwise(none),
        F.when(F.col("files").isNotNull(), F.concat("files", F.array(F.lit("")))).otherwise(none),
        F.array(F.lit("<!-- Generated. Do not edit by hand. -->")),
    )
    # Headings put a blank line before them only where there is none.
    body = F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n")
    fields = F.when(F.col("dir") == "", kept(F.array(item(version_field, F.lit(version), "str"), item("title", F.lit(top_title), "str"), item("description", F.lit(description), "str")))).otherwise(F.array().cast(FIELDS))
    return out.withColumn("_f", fields).select(F.concat(F.when(F.col("dir") != "", F.concat("dir", F.lit("/"))).otherwise(F.lit("")), F.lit("index.md")).alias("path"), rendered(F.col("_f"), body).alias("content"))


def index_rows(files: DataFrame) -> DataFrame:
    """What indexes() needs from files(path, ord, fields)."""
    levels = F.slice(F.array_compact(F.array(*[value_of(F.col("fields"), f) for f in GROUP_FIELDS])), 1, 2)
    return files.select("path", value_of(F.col("fields"), "title").alias("title"), value_of(F.col("fields"), "description").alias("description"), "ord", levels.alias("levels"))


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
