"""Whole builds: a workspace of tables to concepts, and these to a bundle of files or to one file a document.

Documents that share rules, overrides and status go through one plan, however many they are. What is looked at
on the driver is the configuration: the manifest's entries and their rules.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators import checks, definitions, registers, render
from ..operators.assemble import CONCEPT, Assembler, legislation
from ..operators.segments import parse_units
from ..sources import docx, layout
from ..sources.transcripts import authored_files, choose_source, frontmatter, read_tree, transcript_lines
from .barrier import held
from .rules import Overrides, Rules, TitleRegister

#: Fixed value: what the file of reference concepts says about itself.
ACTS_ABOUT = "Acts referred to by the governing documents."
MESSAGES = "doc_id string, message string"
STALE = "the transcript does not match its source (source-sha256 differs); check it against the source, then record the new hash"


@dataclass
class Workspace:
    """What a build reads. ``raw``, ``tables`` and ``words`` are what a reader gives of PDF files (see ``sources.layout``).

    transcripts(doc_id, yaml, body); sources(doc_id, name, content) of the source files that exist; authored(path, text, bytes).
    """

    spark: SparkSession
    manifest: dict
    rules: dict[str, dict]
    overrides: dict[str, dict]
    transcripts: DataFrame
    sources: DataFrame
    authored: DataFrame
    raw: DataFrame | None = None
    tables: DataFrame | None = None
    words: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, root: str, **given: DataFrame) -> Workspace:
        """From a folder with config/, transcripts/, sources/ and authored/."""
        root = root.rstrip("/")
        files = {r["path"]: r["text"] if r["text"] is not None else bytes(r["bytes"]).decode() for r in tree(spark, f"{root}/config").collect()}  # configuration
        manifest = yaml.safe_load(files["manifest.yml"]) or {}
        head = lambda text: text.split("\n---", 1)[0].removeprefix("---") if text.startswith("---") else ""
        rules = {p: yaml.safe_load(t) or {} for p, t in files.items() if p.endswith(".yml")}
        overrides = {p: yaml.safe_load(head(t)) or {} for p, t in files.items() if p.endswith(".md")}
        text = tree(spark, f"{root}/transcripts").where("text is not null")
        head_text, body = frontmatter(F.col("text"))
        transcripts = text.select(F.regexp_replace("path", r"\.md$", "").alias("doc_id"), head_text.alias("yaml"), body.alias("body"))
        names = spark.createDataFrame([(d["id"], d["source"].removeprefix("sources/")) for d in manifest.get("documents") or [] if d.get("source")], "doc_id string, path string")
        sources = tree(spark, f"{root}/sources").join(names, "path").select("doc_id", F.substring_index("path", "/", -1).alias("name"), F.coalesce("bytes", F.col("text").cast("binary")).alias("content"))
        return cls(spark, manifest, rules, overrides, transcripts, sources, authored_files(tree(spark, f"{root}/authored")), **given)

    @property
    def documents(self) -> list[dict]:
        return self.manifest.get("documents") or []


def tree(spark: SparkSession, path: str) -> DataFrame:
    """read_tree, or no rows where there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "path string, text string, bytes binary")
    return read_tree(spark, path)


@dataclass
class Assembly:
    """concepts and warnings of all documents; why others were skipped; errors."""

    concepts: DataFrame
    warnings: DataFrame
    legislation: DataFrame
    skipped: dict[str, str] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)


def unread(doc: dict, ws: Workspace) -> str | None:
    """Why a document's configuration does not allow a build."""
    for key in ("source", "parse-rules"):
        if not doc.get(key):
            return f"no {key} in the manifest"
    for key, have in (("parse-rules", ws.rules), ("overrides", ws.overrides)):
        if doc.get(key) and doc[key] not in have:
            return f"config/{doc[key]} does not exist yet"
    rules = ws.rules[doc["parse-rules"]]
    return None if rules.get("kind") == TitleRegister.KIND or "units" in rules else f"config/{doc['parse-rules']} has no 'units' section yet"


def plan(ws: Workspace) -> tuple[dict[tuple, list[str]], dict[str, str], list[str]]:
    """(documents by (rules, overrides, status, reader), skipped with reasons, errors)."""
    skipped, errors, groups = {}, [], defaultdict(list)
    docs = {}
    for doc in ws.documents:
        if why := unread(doc, ws):
            skipped[doc["id"]] = why
        else:
            docs[doc["id"]] = doc
    ids = ws.spark.createDataFrame([(d,) for d in docs], "doc_id string")
    heads = {r["doc_id"]: yaml.safe_load(r["yaml"] or "") or {} for r in ws.transcripts.join(ids, "doc_id").select("doc_id", "yaml").collect()}
    hashes = {r["doc_id"]: r["sha"] for r in ws.sources.join(ids, "doc_id").select("doc_id", F.sha2("content", 256).alias("sha")).collect()}
    registers_ = {d for d in docs if ws.rules[docs[d]["parse-rules"]].get("kind") == TitleRegister.KIND}
    # Positioned tables stand for the source of a document that has no file here.
    positioned = {r["doc_id"] for t in (ws.raw, ws.words) if t is not None for r in t.join(ids, "doc_id").select("doc_id").distinct().collect()}
    chosen = choose_source(list(docs.values()), set(heads) - registers_, set(hashes) | positioned, {d: ws.rules[docs[d]["parse-rules"]] for d in docs})
    for c in chosen:
        name, doc = c["doc_id"], docs[c["doc_id"]]
        reader = c["reader"]
        if name in registers_:
            reader = "register" if name in positioned else None
            reason = None if reader else f"source not found: {doc['source'].rpartition('/')[2]}" if name not in hashes else "no positioned words of the source"
        elif reader == "pdf-layout" and name not in positioned:
            reader, reason = None, "no positioned lines of the source"
        else:
            reason = c["reason"]
        if reader is None:
            skipped[name] = reason
        elif reader == "transcript" and name in hashes and heads[name].get("source-sha256") != hashes[name]:
            errors.append(f"{name}: {STALE}")
        else:
            groups[doc["parse-rules"], doc.get("overrides"), doc.get("status", "draft"), reader].append(name)
    return groups, skipped, errors


def lines_of(ws: Workspace, reader: str, ids: DataFrame, extract: dict) -> DataFrame:
    only = lambda df: df.join(ids, "doc_id", "left_semi")
    if reader == "transcript":
        return transcript_lines(only(ws.transcripts).select("doc_id", "body"))
    if reader == "docx":
        return docx.docx_lines(only(ws.sources).select("doc_id", "content"))
    return layout.pdf_lines(only(ws.raw), extract, None if ws.tables is None else only(ws.tables))


def definition_rows(ws: Workspace, ids: DataFrame, d: dict) -> DataFrame:
    """Rows of a definitions table (doc_id, row, cells): of Word files beside a text, of PDF pages between headings."""
    in_word = docx.table_after(docx.docx_tables(ws.sources.where(F.lower("name").endswith(".docx")).join(ids, "doc_id", "left_semi").select("doc_id", "content")), d.get("after-text"), d.get("first-cell"))
    rows = in_word.select("doc_id", F.posexplode("rows").alias("row", "cells"))
    if ws.tables is not None and ws.raw is not None and d.get("from-heading"):
        own = lambda df: df.join(ids, "doc_id", "left_semi")
        pages = layout.tables_between(own(ws.tables), own(ws.raw), d["from-heading"], d.get("to-heading"), d.get("heading-size"))
        flat = pages.select("doc_id", "page", "t", F.posexplode("rows").alias("i", "cells"))
        number = F.row_number().over(layout.Window.partitionBy("doc_id").orderBy("page", "t", "i")) - 1
        rows = rows.unionByName(flat.select("doc_id", number.alias("row"), "cells"))
    return held(definitions.table_definitions(rows, d.get("skip-terms") or [], d.get("term-cell")))


def assemble_all(ws: Workspace) -> Assembly:
    """Every manifest document's concepts and the reference concepts."""
    groups, skipped, errors = plan(ws)
    concepts, warnings = [], []
    for (rules_at, overrides_at, status, reader), names in groups.items():
        ids, text = ws.spark.createDataFrame([(n,) for n in names], "doc_id string"), ws.rules[rules_at]
        if reader == "register":
            rules = TitleRegister.of(text)
            found = registers.parse_registers(layout.word_rows(ws.words.join(ids, "doc_id", "left_semi")), *rules.columns)
            concepts.append(registers.register_concepts(found, rules.title, rules.schedule, status))
            warnings.append(found.warnings.select("doc_id", "message"))
            continue
        rules, overrides = Rules.of(text), Overrides.of(ws.overrides.get(overrides_at) if overrides_at else None)
        tables = {d["file"]: definition_rows(ws, ids, d) for d in rules.definitions if d.get("form") == "table"}
        made = Assembler(parse_units(held(lines_of(ws, reader, ids, rules.extract)), rules), rules, overrides, status, tables)
        concepts.append(made.assembled())
        warnings.append(made.diagnostics().select("doc_id", "message"))
    spark, acts = ws.spark, legislation(ws.spark, ws.manifest.get("legislation") or [])
    none = spark.createDataFrame([], acts.schema).select(*CONCEPT)
    every = held(reduce(DataFrame.unionByName, concepts, none))
    return Assembly(every, held(reduce(DataFrame.unionByName, warnings, spark.createDataFrame([], MESSAGES))), acts, skipped, errors)


@dataclass
class Build:
    """files(path, content, bytes); counts(doc_id, n) of concepts or sections; warnings(doc_id, message); errors(message)."""

    files: DataFrame
    counts: DataFrame
    warnings: DataFrame
    errors: DataFrame
    skipped: dict[str, str]


def said(spark: SparkSession, errors: list[str], *more: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, more, spark.createDataFrame([(e,) for e in errors], "message string"))


def concept_counts(concepts: DataFrame) -> DataFrame:
    """(doc_id, n)"""
    return concepts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


def authored_rows(files: DataFrame) -> DataFrame:
    """What an index needs of hand-written files(path, text): their own title, description and group fields."""
    head, _ = frontmatter(F.col("text"))
    keys = checks.nested_keys(files.where(F.col("path").endswith(".md")).select("path", head.alias("yaml"))).where(F.col("dotted").isin("title", "description", *render.GROUP_FIELDS))
    value = lambda k: F.max(F.when(F.col("dotted") == k, F.col("value")))
    made = keys.groupBy("path").agg(value("title").alias("title"), value("description").alias("description"), F.slice(F.array_compact(F.array(*map(value, render.GROUP_FIELDS))), 1, 2).alias("levels"))
    out = files.where(F.col("path").endswith(".md")).select("path").join(made, "path", "left")
    return out.select("path", "title", "description", F.lit(None).cast("int").alias("ord"), F.coalesce("levels", F.array().cast("array<string>")).alias("levels"))


def bundle_build(ws: Workspace) -> Build:
    """One file a concept, reference concepts, hand-written files, an index a folder; checked for paths, links and fields."""
    spark, made = ws.spark, assemble_all(ws)
    homeless = {d["id"]: "no bundle-path in the manifest" for d in ws.documents if not d.get("bundle-path") and d["id"] not in made.skipped and not any(e.startswith(d["id"] + ": ") for e in made.errors)}
    docs = render.document_rows(spark, ws.documents)
    own = held(render.concept_files(made.concepts, docs))
    acts = render.legislation_files(made.legislation)
    hand = ws.authored
    bundle = ws.manifest.get("bundle") or {}
    titles = {d["bundle-path"].strip("/"): d.get("description") for d in reversed(ws.documents) if d.get("bundle-path")} | dict(bundle.get("groups") or {})
    rows = render.index_rows(own.select("path", "ord", "fields").unionByName(acts.select("path", "ord", "fields")))
    rows = rows.unionByName(authored_rows(hand)).where(~F.substring_index("path", "/", -1).isin(*checks.RESERVED))
    listed = render.indexes(rows.dropDuplicates(["path"]), titles, bundle.get("title", "Bundle"), description=bundle.get("description"))
    text = lambda df: df.select("path", "content", F.lit(None).cast("binary").alias("bytes"))
    outputs = text(own).unionByName(text(acts)).unionByName(hand.select("path", F.col("text").alias("content"), "bytes"))
    files = held(outputs.unionByName(text(listed)))
    twice = checks.duplicate_paths(outputs.select("path")).select(F.concat(F.lit("two concepts would be written to "), "path").alias("message"))
    texts = files.where("content is not null").select("path", "content")
    broken = checks.dangling_links(texts, files.select("path")).select(F.concat("path", F.lit(": broken link "), "raw").alias("message"))
    head, _ = frontmatter(F.col("content"))
    odd = checks.schema_problems(texts.select("path", head.alias("yaml"), head.isNotNull().alias("has_frontmatter")), files.select("path")).select(F.concat("path", F.lit(": "), "problem").alias("message"))
    counts = concept_counts(made.concepts.join(docs.where("base is not null"), "doc_id", "left_semi"))
    return Build(files, counts, made.warnings, said(spark, made.errors, twice, broken, odd), made.skipped | homeless)


def sources_of(heads: pd.Series) -> pd.Series:
    """The ``sources`` of frontmatters as YAML list items; empty without any."""
    lists = heads.map(lambda t: (yaml.safe_load(t or "") or {}).get("sources") or [])
    return lists.map(lambda x: render.dumped(x) if x else "")


def single_build(ws: Workspace) -> Build:
    """One file a document, one for the reference concepts, one for each folder of hand-written text; jumps are checked."""
    spark, made = ws.spark, assemble_all(ws)
    groups = (ws.manifest.get("bundle") or {}).get("groups") or {}
    parts = [render.sections(made.concepts)]
    heads = [render.document_rows(spark, ws.documents).select("doc_id", "title", F.lit(None).cast("string").alias("description"), "sources")]
    acts = made.legislation.withColumn("body", F.filter("body", lambda b: ~b.eqNullSafe(F.col("description"))))
    parts.append(render.sections(acts))
    heads.append(spark.createDataFrame([("legislation", groups.get("legislation", "Legislation"), ACTS_ABOUT, None)], "doc_id string, title string, description string, sources string"))

    hand = ws.authored.where(F.col("path").rlike(r"^[^/]+/[^/]+\.md$")).withColumn("doc_id", F.substring_index("path", "/", 1))
    head, body = frontmatter(F.col("text"))
    hand = held(hand.select("doc_id", "path", head.alias("yaml"), body.alias("body")))
    own = hand.join(authored_rows(ws.authored).select("path", "title", "description"), "path", "left")
    cleaned, left_out = render.authored_sections(hand.select("path", "body"))
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.md$", "")
    written = hand.select("path").join(cleaned, "path", "left").join(own.select("path", "doc_id", "title", "description"), "path")
    number = F.row_number().over(layout.Window.partitionBy("doc_id").orderBy("path")) - 1
    parts.append(render.sections(written.select("doc_id", number.alias("seq"), stem.alias("name"), F.coalesce("title", stem).alias("title"), F.array(F.coalesce("body", F.lit(""))).alias("body"), "description", F.array().cast(render.FIELDS).alias("position"))))
    said_of = F.pandas_udf(sources_of, StringType())(F.col("yaml"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "s"))), lambda x: x["s"]), "")
    folders = hand.select("doc_id", "path", said_of.alias("s")).groupBy("doc_id").agg(joined.alias("sources"))
    named = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for k, v in groups.items() for x in (k, v)]), F.col("doc_id")), F.col("doc_id")) if groups else F.col("doc_id")
    heads.append(folders.select("doc_id", named.alias("title"), F.lit(None).cast("string").alias("description"), F.when(F.col("sources") == "", F.lit("[]\n")).otherwise(F.col("sources")).alias("sources")))

    sections = held(reduce(DataFrame.unionByName, [p.select("doc_id", "seq", "anchor", "content") for p in parts]))
    made_files = render.single_files(sections, reduce(DataFrame.unionByName, heads))
    files = held(made_files.select(F.concat("doc_id", F.lit(".md")).alias("path"), "content", F.lit(None).cast("binary").alias("bytes")))
    lost = checks.missing_anchors(files.select("path", "content")).select(F.concat("path", F.lit(": link to #"), "target", F.lit(", which is not in the file")).alias("message"))
    warnings = made.warnings.unionByName(left_out.select(F.substring_index("path", "/", 1).alias("doc_id"), "message"))
    return Build(files, concept_counts(sections), warnings, said(spark, made.errors, lost), made.skipped)
