"""Registered queries of whole builds, printed registers and line scans, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .operators import registers, render, segments
from .operators.assemble import Assembler
from .plans import build
from .plans.barrier import held
from .plans.rules import Overrides, Rules
from .plans.synthetic import RULES
from .queries import LINES, PART, STATE, parsed, query, synthetic, table
from .sources import layout
from .sources.transcripts import frontmatter, stale

TOOL, STAMP = render.TOOL, render.STAMP


# ---------------------------------------------------------------- builds
def workspace(spark, sf_dir) -> build.Workspace:
    """The synthesised documents as transcripts of a manifest, one of them without a place in the bundle, and one without a source."""
    lines = synthetic(spark, sf_dir)
    shown = F.when(F.col("bold"), F.concat(F.lit("**"), "text", F.lit("**"))).otherwise(F.col("text"))
    mark = F.concat(F.lit("<!-- page "), F.col("page").cast("string"), F.lit(" -->\n"), shown)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", mark.alias("t")))), lambda x: x["t"]), "\n")
    transcripts = held(lines.groupBy("doc_id").agg(body.alias("body")).select("doc_id", F.lit("source: x").alias("yaml"), "body"))
    names = sorted(r["doc_id"] for r in transcripts.select("doc_id").collect())  # the manifest
    docs = [{"id": d, "source": f"sources/{d}.pdf", "parse-rules": "rules.yml", "concept-type": "article", "description": f"Document {d}"} | ({} if d == "doc1" else {"bundle-path": f"docs/{d}"}) for d in names]
    docs.append({"id": "lost", "source": "sources/lost.pdf", "parse-rules": "rules.yml", "bundle-path": "lost"})
    manifest = {"bundle": {"groups": {"docs": "Documents"}}, "documents": docs, "legislation": [{"reference": "Acts Act 1999", "description": "About acts."}]}
    none = spark.createDataFrame([], "doc_id string, name string, content binary")
    note = "---\ntype: note\ntitle: A note\n---\n# A note\n\nSee [one](/docs/doc0/article-01.md).\n\n## Picture\n\n![x](p.png)\n"
    authored = spark.createDataFrame([("notes/a.md", note, None)], "path string, text string, bytes binary")
    return build.Workspace(spark, manifest, {"rules.yml": RULES}, {}, transcripts, none, authored)


#: The articles with their titles, names, pages, texts and the name of the article that each refers to.
ARTICLES = f"""{STATE},
u as (select doc_id, text, pos, sum(case when regexp_matches(text, '^[0-9]+[.] ') then 1 else 0 end) over (partition by doc_id order by pos) as n from lines where not bold),
w as (select doc_id, n, string_agg(case when regexp_matches(text, '^[0-9]+[.] ') then regexp_replace(text, '^[0-9]+[.] ', '') else text end, chr(10) || chr(10) order by pos) as body from u group by doc_id, n),
x as (select a.doc_id, cast(key as int) as k, heading, section, page, body, 'Article ' || key || coalesce(' – ' || heading, '') as title, 'article-' || lpad(key, cast(greatest(2, length(key)) as int), '0') as name,
      'article-' || lpad(cast(cast(key as int) // 2 + 1 as varchar), cast(greatest(2, length(cast(cast(key as int) // 2 + 1 as varchar))) as int), '0') as goal, {PART.replace("doc_id", "a.doc_id")} as part
      from a join w on a.doc_id = w.doc_id and cast(a.key as int) = w.n)
"""


def linked(before: str, after: str) -> str:
    """The text of an article with its reference as a link; before and after are SQL around the goal's name."""
    return f"regexp_replace(body, 'article ([0-9]+)', case when k // 2 + 1 = k then 'article \\1' else '[article \\1](' || {before} || goal || {after} || ')' end)"


def lines_sql(*parts: str) -> str:
    """SQL of a text of lines, each an expression."""
    return " || chr(10) || ".join(parts)


MADE = "'<!-- Generated. Do not edit by hand. -->'"
ARTICLE_FILE = lines_sql(
    "'---'", "'type: article'", "'title: ' || title", "'part: ' || part", "'section: ' || section", "'article_number: ' || cast(k as varchar)", "'source_pages:'", "'- ' || cast(page as varchar)", "'sources:'",
    "'- id: ' || doc_id", "'  title: Document ' || doc_id", "'generated:'", f"'  by: {TOOL}'", f"'  at: {STAMP}'", "'status: draft'", "'---'", "''", "'# ' || title", "''", linked("'/docs/' || doc_id || '/'", "'.md'"), "''",
)
ENTRY = "case when fresh then case when k = 1 then '' else chr(10) end || '### ' || section || chr(10) || chr(10) else '' end || '- [' || title || '](/docs/' || doc_id || '/' || name || '.md)'"
DOC_INDEX = lines_sql("'# Document ' || doc_id", "''", "'## ' || any_value(part)", "''", f"string_agg({ENTRY}, chr(10) order by k)", "''", MADE, "''")
DOCS_INDEX = lines_sql("'# Documents'", "''", "string_agg('- [Document ' || doc_id || '](/docs/' || doc_id || '/index.md)', chr(10) order by doc_id)", "''", MADE, "''")
NOTES_INDEX = lines_sql("'# notes'", "''", "'- [A note](/notes/a.md)'", "''", MADE, "''")
ACTS_INDEX = lines_sql("'# legislation'", "''", "'- [Acts Act 1999](/legislation/acts-act-1999.md): About acts.'", "''", MADE, "''")
TOP_INDEX = lines_sql("'---'", "'version: ''0.2'''", "'title: Bundle'", "'---'", "''", "'# Bundle'", "''", "'- [Documents](/docs/index.md)'", "'- [legislation](/legislation/index.md)'", "'- [notes](/notes/index.md)'", "''", MADE, "''")
NOTE = lines_sql("'---'", "'type: note'", "'title: A note'", "'---'", "'# A note'", "''", "'See [one](/docs/doc0/article-01.md).'", "''", "'## Picture'", "''", "'![x](p.png)'", "''")
ACT = lines_sql("'---'", "'type: legislation'", "'title: Acts Act 1999'", "'description: About acts.'", "'generated:'", f"'  by: {TOOL}'", f"'  at: {STAMP}'", "'status: draft'", "'---'", "''", "'# Acts Act 1999'", "''", "'About acts.'", "''")


@query(f"""{ARTICLES}
 select 'docs/' || doc_id || '/' || name || '.md' as path, {ARTICLE_FILE} as content from x where doc_id <> 'doc1'
 union all select 'docs/' || doc_id || '/index.md', {DOC_INDEX} from (select *, section is distinct from lag(section) over (partition by doc_id order by k) as fresh from x where doc_id <> 'doc1') group by doc_id
 union all select 'docs/index.md', {DOCS_INDEX} from (select distinct doc_id from x where doc_id <> 'doc1')
 union all select 'notes/index.md', {NOTES_INDEX} union all select 'legislation/index.md', {ACTS_INDEX} union all select 'index.md', {TOP_INDEX}
 union all select 'notes/a.md', {NOTE} union all select 'legislation/acts-act-1999.md', {ACT}""")
def bundle_build(spark, sf_dir):
    """The whole bundle: concept files, reference concepts, hand-written text and indexes with titles and group headings."""
    return build.bundle_build(workspace(spark, sf_dir)).files.select("path", "content")


SECTION = lines_sql("'<a id=\"' || name || '\"></a>'", "''", "'# ' || title", "''", "'- title: ' || title", "'- article_number: ' || cast(k as varchar)", "''", linked("'#'", "''"))
DOC_FILE = lines_sql("'---'", "'title: Document ' || doc_id", "'sources:'", "'- id: ' || doc_id", "'  title: Document ' || doc_id", f"'generated_by: {TOOL}'", "'---'", "''", f"string_agg({SECTION}, chr(10) || chr(10) order by k)", "''")
NOTES_FILE = lines_sql("'---'", "'title: notes'", "'sources: []'", f"'generated_by: {TOOL}'", "'---'", "''", "'<a id=\"a\"></a>'", "''", "'# A note'", "''", "'- title: A note'", "''", "'See [one](#article-01).'", "''")
ACTS_FILE = lines_sql("'---'", "'title: Legislation'", "'description: Acts referred to by the governing documents.'", f"'generated_by: {TOOL}'", "'---'", "''", "'<a id=\"acts-act-1999\"></a>'", "''", "'# Acts Act 1999'", "''", "'- title: Acts Act 1999'", "'- description: About acts.'", "''")


@query(f"{ARTICLES} select doc_id || '.md' as path, {DOC_FILE} as content from x group by doc_id union all select 'notes.md', {NOTES_FILE} union all select 'legislation.md', {ACTS_FILE}")
def single_build(spark, sf_dir):
    """One file a document, one of hand-written text without its picture, one of reference concepts."""
    return build.single_build(workspace(spark, sf_dir)).files.select("path", "content")


@query(f"""{ARTICLES} select doc_id, count(*) as n, cast(null as varchar) as reason from x where doc_id <> 'doc1' group by doc_id
 union all select 'doc1', null, 'no bundle-path in the manifest' union all select 'lost', null, 'source not found: lost.pdf' union all select 'errors', 1, 'notes/a.md: broken link p.png'""")
def build_report(spark, sf_dir):
    """Concepts of each built document, why others are skipped, and the errors."""
    made = build.bundle_build(workspace(spark, sf_dir))
    skipped = spark.createDataFrame([(k, None, v) for k, v in made.skipped.items()], "doc_id string, n long, reason string")
    errors = made.errors.select(F.lit("errors").alias("doc_id"), F.lit(1).cast("long").alias("n"), F.col("message").alias("reason"))
    return made.counts.select("doc_id", "n", F.lit(None).cast("string").alias("reason")).unionByName(skipped).unionByName(errors)


OVERRIDES = {
    "groups": [{"file": "opening", "title": "Opening", "units": [2, 1], "type": "group", "include-front-matter": True}], "headings": {3: "Named"},
    "descriptions": {"opening": "The first two.", 3: "The third."}, "status": {3: "stable"},
}


@query(f"""{ARTICLES} select doc_id, 'opening' as name, 'Opening' as title, string_agg('## Article ' || cast(k as varchar) || chr(10) || chr(10) || body, chr(10) || chr(10) order by k) as body, '2,1' as numbers, 0 as ord, 'The first two.' as description, 'draft' as status
 from x where k <= 2 group by doc_id
 union all select doc_id, name, 'Article 3 – Named', regexp_replace(body, 'article ([0-9]+)', '[article \\1](ref:opening)'), '3', 2, 'The third.', 'stable' from x where k = 3""")
def group_concepts(spark, sf_dir):
    """Units merged by an override, in document order, and one whose heading, description and status are overridden."""
    made = Assembler(parsed(spark, sf_dir), Rules.of(RULES), Overrides.of(OVERRIDES)).assembled().where("name in ('opening', 'article-03')")
    numbers = F.get(F.filter("position", lambda f: f["k"].isin("article_numbers", "article_number")), F.lit(0))["v"]
    return made.select("doc_id", "name", "title", F.array_join("body", "\n\n").alias("body"), F.replace(numbers, F.lit("\n"), F.lit(",")).alias("numbers"), "ord", "description", "status")


ZONED = {k: v for k, v in RULES.items() if k != "units"} | {
    "front-matter": {"ends-at": "section"}, "back-matter": {"starts-at": r"^\(3\)"},
    "units": {
        "key": ["number"], "fields": ["section"], "patterns": [{"match": r"^(?P<number>\d*[02468])\.\s+", "filename": "article-{number}", "title": "Article {number}", "requires-heading": "section"}],
        "heading-fallback": [{"level": "section", "filename": "loose-{slug}", "title": "{section}", "key": "loose.{slug}"}],
    },
}


@query(LINES + r""", z as (select *, min(case when text like 'SECTION %' then pos end) over (partition by doc_id) as opens, min(case when text like '(3)%' then pos end) over (partition by doc_id) as closes,
  last_value(case when text like 'SECTION %' then lower(substr(text, 9)) end ignore nulls) over w as section, max(case when regexp_matches(text, '^[0-9]*[02468][.] ') then pos end) over w as unit, max(case when bold then pos end) over w as head
  from lines window w as (partition by doc_id order by pos rows unbounded preceding)),
 c as (select *, case when pos >= opens and not bold and (closes is null or pos < closes) then case when unit is not null and unit > head then 'unit' else 'loose' end end as zone from z)
 select doc_id, case when zone = 'unit' then regexp_extract(text, '^([0-9]+)', 1) else 'loose.section-' || regexp_replace(section, '[^a-z0-9]+', '-', 'g') end as key, count(*) as n from c where zone = 'loose' or (zone = 'unit' and pos = unit) group by 1, 2""")
def zones_and_fallbacks(spark, sf_dir):
    """Front and back matter left out, gated units, and text that only a heading takes in."""
    p = segments.parse_units(synthetic(spark, sf_dir), Rules.of(ZONED))
    own = p.unit_lines.join(p.units.select("doc_id", "idx", "key", "at"), ["doc_id", "idx"])
    return own.where("key like 'loose%' or pos = at").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- printed registers
def words(x0: float, *cells) -> F.Column:
    return F.array(*[F.struct((c if isinstance(c, F.Column) else F.lit(c)).cast("string").alias("text"), F.lit(x0 + i).alias("x0")) for i, c in enumerate(cells)])


def register_rows(spark, sf_dir) -> DataFrame:
    """A register for each customer with orders: facts, a heading, an introduction, then an entry of two rows for each order."""
    orders = table(spark, sf_dir, "orders")
    doc, k = F.col("o_custkey").cast("string").alias("doc_id"), F.col("o_orderkey")
    heads = [
        words(300.0, "Orders", "(Leasehold)"), words(300.0, F.concat(F.lit("CU"), F.col("o_custkey").cast("string"))), words(300.0, "Accessed", "on", "7", "May", "2024", "at", "08:09:10"),
        words(20.0, "A:", "Order", "Register"), words(300.0, "Orders", "of", "a", "customer."), words(20.0, "Entry", "number"),
    ]
    made = F.array(*[F.struct(F.lit(n).cast("long").alias("row"), F.lit(float(n)).alias("top"), F.lit(16 if n == 3 else 10).alias("size"), w.alias("words")) for n, w in enumerate(heads)])
    fixed = orders.select("o_custkey").distinct().select(doc, F.explode(made).alias("r"))
    listed = k % 5 == 0
    first = F.when(listed, F.concat(words(20.0, k), words(300.0, "Status", ":", F.col("o_orderstatus")))).otherwise(F.concat(words(20.0, k, F.date_format("o_orderdate", "yyyy-MM-dd")), words(300.0, "Order", "in", "state", F.col("o_orderstatus"))))
    second = F.when(listed, words(300.0, "NOTE:", "priority", F.col("o_orderpriority"))).otherwise(words(300.0, "with", "priority", F.col("o_orderpriority")))
    row = lambda n, top, w: F.struct((n + 2 * k).alias("row"), top.alias("top"), F.lit(10).alias("size"), w.alias("words"))
    both = F.array(row(10, k * 100.0, first), row(11, k * 100.0 + F.when(k % 2 == 0, 40.0).otherwise(10.0), second))
    return fixed.unionByName(orders.select(doc, F.explode(both).alias("r"))).select("doc_id", F.lit(1).alias("page"), F.col("r.row").cast("int").alias("row"), "r.top", "r.size", "r.words")


ENTRIES = """with e as (select cast(o_custkey as varchar) as doc_id, cast(row_number() over (partition by o_custkey order by o_orderkey) - 1 as int) as entry, o_orderkey as number, o_orderkey % 5 = 0 as listed, strftime(o_orderdate, '%Y-%m-%d') as date, o_orderstatus as status, o_orderpriority as priority from orders),
t as (select *, case when listed then 'Status : ' || status || '<br>NOTE: priority ' || priority else 'Order in state ' || status || case when number % 2 = 0 then '<br>' else ' ' end || 'with priority ' || priority end as paragraphs from e)
"""


@query(ENTRIES + "select doc_id, entry, cast(number as int) as number, case when not listed then date end as date, paragraphs, case when listed then 'Status=' || status || ';Note=NOTE: priority ' || priority end as fields, 1 as first_page from t")
def register_entries(spark, sf_dir):
    """Entries of printed registers, read from positioned words: numbers and dates by column, paragraphs by gaps, fields and notes."""
    e = registers.parse_registers(register_rows(spark, sf_dir)).entries
    fields = F.array_join(F.transform("fields", lambda f: F.concat(f["k"], F.lit("="), f["v"])), ";")
    return e.select("doc_id", F.col("entry").cast("int").alias("entry"), "number", "date", F.array_join("paragraphs", "<br>").alias("paragraphs"), fields.alias("fields"), F.get("pages", F.lit(0)).alias("first_page"))


@query(ENTRIES + """select doc_id, 'a-order-register' as name, 'A: Order Register – Leasehold title CU' || doc_id as title, 'The order register of leasehold title CU' || doc_id || '. Orders of a customer.' as description, cast(count(*) as varchar) as entry_count, '2024-05-07T08:09:10' as accessed,
 'Orders of a customer.' || coalesce(chr(10) || '| Entry | Date | Description |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || number || ' | ' || date || ' | ' || paragraphs || ' |', chr(10) order by entry) filter (where not listed), '')
 || coalesce(chr(10) || '## Schedule' || chr(10) || '| Entry | Status | Note |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || number || ' | ' || status || ' | NOTE: priority ' || priority || ' |', chr(10) order by entry) filter (where listed), '') as body from t group by doc_id""")
def register_concepts(spark, sf_dir):
    """Registers as concepts: facts, introduction, entry table, schedule table."""
    made = registers.register_concepts(registers.parse_registers(register_rows(spark, sf_dir)))
    fact = lambda k: F.get(F.filter("position", lambda f: f["k"] == k), F.lit(0))["v"].alias(k)
    return made.select("doc_id", "name", "title", "description", fact("entry_count"), fact("accessed"), F.array_join("body", "\n").alias("body"))


# ---------------------------------------------------------------- positioned lines
@query("""with r as (select l_orderkey as o, l_linenumber as page, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity) as ln, l_partkey as p, l_quantity as q from lineitem)
 select cast(o as varchar) as doc_id, cast(row_number() over (partition by o order by page, ln) - 1 as int) as pos, page, p % 10 = 7 as in_table,
 case when p % 10 = 7 then '| part | ' || cast(p as varchar) || ' |' || chr(10) || '|---|---|' || chr(10) || '| a' || chr(92) || '|b |  |' else 'part ' || cast(p as varchar) end as text
 from r where page <> 3 and q between 5 and 40 and p % 10 <> 3""")
def page_lines(spark, sf_dir):
    """A whole line scan: a page skipped, margins clipped, lines dropped, tables put in place. An order is a document, its quantities are heights."""
    li = table(spark, sf_dir, "lineitem").withColumn("ln", F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity")))
    doc, p, top = F.col("l_orderkey").cast("string").alias("doc_id"), F.col("l_partkey"), F.col("l_quantity") + F.col("ln") / 100
    text = F.concat(F.when(p % 10 == 3, "drop ").otherwise("part "), p.cast("string"))
    # A break prefix keeps lines of one page apart, tables lie beside their own line only.
    raw = li.select(doc, F.col("l_linenumber").alias("page"), "ln", text.alias("text"), top.alias("top"), F.lit(10.0).alias("size"), F.lit(1.0).alias("x0"), F.lit(0.0).alias("bold_share"))
    cells = F.array(F.array(F.lit("part"), p.cast("string")), F.array(F.lit(None).cast("string"), F.lit("")), F.array(F.lit("a|b"), F.lit("")))
    tables = li.where(p % 10 == 7).select(doc, F.col("l_linenumber").alias("page"), F.col("ln").cast("int").alias("t"), top.alias("top"), top.alias("bottom"), F.lit(0.0).alias("x0"), cells.alias("rows"))
    config = {"skip-pages": [3], "top-margin": 5, "bottom-margin": 40.5, "tables": "markdown", "drop": ["^drop"], "break-prefixes": ["part"]}
    return layout.pdf_lines(raw, config, tables).select("doc_id", F.col("pos").cast("int").alias("pos"), "text", "page", F.col("size").isNull().alias("in_table"))


@query("""select cast(p_size as varchar) as doc_id, cast(p_partkey as int) as line, s as piece, s as segment, s > 0 as spaced, t as text from
 (select *, 0 as s, substr(replace(p_name, ' ', ''), 1, 4) as t from part union all select *, 1, substr(replace(p_name, ' ', ''), 5) from part) where t <> ''""")
def glyph_pieces(spark, sf_dir):
    """Glyphs of part names as pieces: a wide gap after the fourth, the last one drawn twice."""
    part = table(spark, sf_dir, "part").withColumn("p_name", F.replace("p_name", F.lit(" "), F.lit(""))).withColumn("n", F.length("p_name"))
    glyph = part.select(F.col("p_size").cast("string").alias("doc_id"), F.lit(1).alias("page"), F.col("p_partkey").cast("int").alias("line"), "n", F.posexplode(F.split("p_name", "")).alias("i", "text")).where("text <> ''")
    x0 = F.col("i") * 5.0 + F.when(F.col("i") >= 4, 20.0).otherwise(0.0)
    once = glyph.select("doc_id", "page", "line", F.col("i").alias("ix"), "text", x0.alias("x0"), (x0 + 5.0).alias("x1"), F.lit(10.0).alias("size"), F.lit("f").alias("fontname"), "n")
    twice = once.where("ix = n - 1").withColumn("ix", F.col("ix") + 1000)
    return layout.glyph_pieces(once.unionByName(twice).drop("n")).select("doc_id", "line", F.col("piece").cast("int").alias("piece"), F.col("segment").cast("int").alias("segment"), "spaced", "text")


@query("""with s as (select *, min(case when o_orderstatus = 'O' then o_orderkey end) over (partition by o_custkey) as a from orders), e as (select o_custkey, min(o_orderkey) as z from s where o_orderkey > a and o_orderstatus = 'F' group by o_custkey)
 select cast(s.o_custkey as varchar) as doc_id, o_orderkey as page from s left join e on s.o_custkey = e.o_custkey where o_orderkey >= a and o_orderkey <= coalesce(z, o_orderkey)""")
def tables_between(spark, sf_dir):
    """Tables on the pages from one heading through another: an order is a page with a table, its status the heading."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("doc_id"), F.col("o_orderkey").alias("page"), F.concat(F.lit("Status "), "o_orderstatus").alias("text"))
    own = orders.join(orders.where("text = 'Status O'").select("doc_id").distinct(), "doc_id", "left_semi")
    raw = own.select("doc_id", "page", F.lit(1).alias("ln"), "text", F.lit(14.2).alias("size"))
    return layout.tables_between(own.select("doc_id", "page"), raw, "^Status O", "^Status F", 14).select("doc_id", "page")


# ---------------------------------------------------------------- transcripts and hand-written text
@query("select 'd' || cast(doc_id as varchar) as doc_id, case when doc_id % 3 = 0 then 'stale' when doc_id % 3 = 1 then 'fresh' else 'no source' end as state, text as body, 'source-sha256: ' || case when doc_id % 3 = 1 then sha256(text) else 'old' end as yaml from documents")
def stale_transcripts(spark, sf_dir):
    """Transcripts split into frontmatter and body, and held against the hash of their source."""
    docs = table(spark, sf_dir, "documents").withColumn("name", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    sha = F.when(F.col("doc_id") % 3 == 1, F.sha2("text", 256)).otherwise("old")
    head, body = frontmatter(F.col("content"))
    made = docs.select(F.col("name").alias("doc_id"), F.concat(F.lit("---\nsource-sha256: "), sha, F.lit("\n---\n"), "text").alias("content")).select("doc_id", head.alias("yaml"), body.alias("body"))
    sources = docs.where("doc_id % 3 < 2").select(F.col("name").alias("doc_id"), F.col("text").cast("binary").alias("content"))
    old = stale(made.select("doc_id", F.regexp_extract("yaml", "source-sha256: (.*)", 1).alias("source_sha256")), sources).withColumn("old", F.lit(True))
    state = F.when(F.col("there").isNull(), "no source").when(F.col("old").isNotNull(), "stale").otherwise("fresh")
    return made.join(sources.select("doc_id", F.lit(True).alias("there")), "doc_id", "left").join(old, "doc_id", "left").select("doc_id", state.alias("state"), "body", "yaml")


@query("""select 'notes/' || cast(conv_id as varchar) || '.md' as path, string_agg('## ' || role || chr(10) || 'turn ' || cast(turn as varchar), chr(10) order by turn) as body from conversations where role <> 'user' group by conv_id""")
def authored_parts(spark, sf_dir):
    """Hand-written text without the sections that hold a picture: here those of users."""
    c = table(spark, sf_dir, "conversations")
    part = F.concat(F.lit("## "), "role", F.lit("\n"), F.when(F.col("role") == "user", "![a picture](x.png)").otherwise(F.concat(F.lit("turn "), F.col("turn").cast("string"))))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", part.alias("t")))), lambda x: x["t"]), "\n")
    files = c.groupBy(F.concat(F.lit("notes/"), F.col("conv_id").cast("string"), F.lit(".md")).alias("path")).agg(F.concat(F.lit("# Title\n"), body).alias("body"))
    return render.authored_sections(files)[0].where("body <> ''")


# ---------------------------------------------------------------- further operators
DEFINED = RULES | {"definitions": {"unit": 1, "file": "words", "title": "Words", "type": "definitions", "term": r"^\((?P<term>\d)\)"}}


@query(f"{ARTICLES} select doc_id, 'words' as name, 'Words' as title, 'definitions' as type, -1 as ord, '## 1' || chr(10) || chr(10) || replace(body, chr(10) || chr(10) || '(2)', chr(10) || chr(10) || '## 2' || chr(10) || chr(10) || '(2)') as body, page as first_page from x where k = 1")
def definition_concepts(spark, sf_dir):
    """A clause of definitions as a concept: a heading for each term, a place of its own."""
    rules = Rules.of(DEFINED)
    made = Assembler(segments.parse_units(synthetic(spark, sf_dir), rules), rules).assembled().where("name = 'words'")
    pages = F.get(F.filter("position", lambda f: f["k"] == "source_pages"), F.lit(0))["v"]
    return made.select("doc_id", "name", "title", "type", "ord", F.array_join("body", "\n\n").alias("body"), pages.cast("int").alias("first_page"))


@query(f"{ARTICLES} select doc_id, 'term ' || cast(k as varchar) as term from x where k % 7 = 0 and k % 2 = 0")
def defined_terms(spark, sf_dir):
    """Terms that redaction keeps: second-level headings of definitions, here each seventh article's."""
    from .operators.redact import defined_terms as found

    units = Assembler(parsed(spark, sf_dir), Rules.of(RULES)).units
    k = F.col("key").cast("int")
    body = F.array(F.lit("Intro"), F.concat(F.lit("## term "), "key", F.lit("\n\ntext ## not a heading")))
    return found(units.where(k % 7 == 0).select("doc_id", F.when(k % 2 == 0, "definitions").alias("type"), body.alias("body")))


@query("""select case when n.k is null then 'removed' when o.k is null then 'added' else 'changed' end as change, count(*) as n from (select event_id as k, event_type as c from events where event_id % 10 <> 0) n
 full outer join (select event_id as k, case when event_id % 7 = 0 then 'x' else event_type end as c from events where event_id % 11 <> 0) o on n.k = o.k where n.k is null or o.k is null or n.c <> o.c group by 1""")
def change_report(spark, sf_dir):
    """Changes between two trees, counted by kind."""
    from .operators import checks

    ev = table(spark, sf_dir, "events").select("event_id", F.col("event_id").cast("string").alias("path"), F.col("event_type").alias("content"))
    old = ev.where("event_id % 11 <> 0").withColumn("content", F.when(F.col("event_id") % 7 == 0, "x").otherwise(F.col("content")))
    return checks.change_counts(checks.tree_diff(ev.where("event_id % 10 <> 0"), old)).select("change", F.col("count").alias("n"))


@query("""select cast(l_orderkey as varchar) as doc_id, l_linenumber as line, string_agg('p' || cast(l_partkey as varchar), ' ' order by l_suppkey, l_partkey, l_quantity) as text, 12 as size from lineitem group by l_orderkey, l_linenumber""")
def word_rows(spark, sf_dir):
    """Words of a page in rows: heights within three points belong together, words go from left to right."""
    li = table(spark, sf_dir, "lineitem").withColumn("word_ix", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_suppkey", "l_partkey", "l_quantity")))
    x0, top = F.col("l_suppkey") + F.col("word_ix") / 1000, F.col("l_linenumber") * 10.0 + F.col("l_partkey") % 3
    words_ = li.select(F.col("l_orderkey").cast("string").alias("doc_id"), F.lit(1).alias("page"), "word_ix", F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("text"), x0.alias("x0"), (x0 + 1).alias("x1"), top.alias("top"), F.lit(11.6).alias("size"), F.lit("f").alias("fontname"))
    rows = layout.word_rows(words_)
    return rows.select("doc_id", F.floor(F.col("top") / 10).cast("int").alias("line"), layout.row_text(F.col("words")).alias("text"), "size")
