"""Registered queries of the structure engine and their ANSI SQL equivalents.

Each query runs an operator over whole tables; its SQL says the same by other means. Lists that an
engine would order its own way are ordered explicitly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import first_sentence, is_upper, markdown_table, padded, sentence_case, slug
from .operators import checks, definitions, redact, registers, render, segments
from .operators.assemble import Assembler, item
from .plans.rules import Rules
from .plans.synthetic import LINES_SQL, RULES, duck_sql, spark_sql
from .sources import layout
from .sources.transcripts import transcript_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the synthesised documents."""
    for name in ("customer", "nation"):
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    lines = spark.sql(spark_sql(LINES_SQL))
    return lines.select("doc_id", "pos", "text", "bold", "page", F.lit(None).cast("int").alias("size"), F.lit(None).cast("double").alias("x0"), F.lit(None).cast("string").alias("style"))


def parsed(spark: SparkSession, sf_dir: str) -> segments.Parsed:
    return segments.parse_units(synthetic(spark, sf_dir), Rules.of(RULES))


LINES = f"with lines as ({duck_sql()})"
#: The state of each article line: part, section and the heading right before it.
STATE = LINES + r""",
s as (
  select doc_id, pos, text, page,
         last_value(case when text like 'SECTION %' then 'Section ' || lower(substr(text, 9)) end ignore nulls) over w as section,
         lag(case when text like 'Duty of %' then text end) over (partition by doc_id order by pos) as heading,
         row_number() over (partition by doc_id order by pos) as rn
  from lines window w as (partition by doc_id order by pos rows unbounded preceding)
), a as (
  select *, regexp_extract(text, '^([0-9]+)[.] ', 1) as key from s where regexp_matches(text, '^[0-9]+[.] ')
)
"""
PART = "'Part ' || cast(cast(substr(doc_id, 4) as int) + 1 as varchar) || ' – Rules of ' || substr(doc_id, 4) || ' title'"


@query(STATE + f"select doc_id, cast(row_number() over (partition by doc_id order by pos) - 1 as int) as idx, key, {PART} as part, section, heading, page as first_page, 'article-' || lpad(key, cast(greatest(2, length(key)) as int), '0') as name from a")
def unit_segments(spark, sf_dir):
    """Units with the headings in force, their pages and names."""
    p, rules = parsed(spark, sf_dir), Rules.of(RULES)
    at = lambda k: F.try_element_at("headings", F.lit(k))
    return Assembler(p, rules).units.select("doc_id", F.col("idx").cast("int").alias("idx"), "key", at("part").alias("part"), at("section").alias("section"), at("heading").alias("heading"), F.get("pages", F.lit(0)).alias("first_page"), "name")


@query(LINES + """, u as (select doc_id, pos, text, sum(case when regexp_matches(text, '^[0-9]+[.] ') then 1 else 0 end) over (partition by doc_id order by pos) as n from lines where not bold)
select doc_id, cast(n - 1 as int) as idx, count(*) as n_lines, string_agg(case when regexp_matches(text, '^[0-9]+[.] ') then regexp_replace(text, '^[0-9]+[.] ', '') else text end, chr(10) order by pos) as body from u group by doc_id, n""")
def unit_lines(spark, sf_dir):
    """The text of each unit, without its number."""
    lines = parsed(spark, sf_dir).unit_lines
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n")
    return lines.groupBy("doc_id", F.col("idx").cast("int").alias("idx")).agg(F.count(F.lit(1)).alias("n_lines"), text.alias("body"))


@query(LINES + f"""select doc_id, pos, case when text like 'PART %' then 'part' when text like 'SECTION %' then 'section' else 'heading' end as level,
 case when text like 'PART %' then {PART} when text like 'SECTION %' then 'Section ' || lower(substr(text, 9)) else text end as value from lines where bold and not (text like 'RULES OF %')""")
def heading_state(spark, sf_dir):
    """Headings in force, their titles taken from the next line where a rule says so."""
    z = segments.zoned(synthetic(spark, sf_dir), Rules.of(RULES)).where("heading is not null")
    return z.select("doc_id", "pos", F.col("heading.level").alias("level"), F.col("heading.value").alias("value"))


@query(LINES + "select doc_id, count(*) as n_lines, cast(sum(case when text like 'RULES OF %' then 1 else 0 end) as bigint) as n_taken from lines group by doc_id")
def title_lookahead(spark, sf_dir):
    z = segments.zoned(synthetic(spark, sf_dir), Rules.of(RULES))
    return z.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum((F.col("zone") == "skipped").cast("int")).alias("n_taken"))


@query(STATE + """select doc_id, key, regexp_replace(regexp_replace(text, '^[0-9]+[.] ', ''), 'article ([0-9]+)', case when cast(key as int) // 2 + 1 = cast(key as int) then 'article \\1' else '[article \\1](ref:article-' || lpad(cast(cast(key as int) // 2 + 1 as varchar), cast(greatest(2, length(cast(cast(key as int) // 2 + 1 as varchar))) as int), '0') || ')' end) as md from a""")
def cross_reference_links(spark, sf_dir):
    """First lines of units with their references as links."""
    a = Assembler(parsed(spark, sf_dir), Rules.of(RULES))
    return a.with_links(a.texts).where("text like '(1)%'").select("doc_id", "key", "md")


@query("""select 'conv' || cast(conv_id as varchar) as doc_id, cast(row_number() over (partition by conv_id order by turn, i) - 1 as int) as pos, trim(t, ' ' || chr(9) || chr(13)) as text, cast(turn as int) as page
 from (select conv_id, turn, unnest(string_split(text, chr(10))) as t, generate_subscripts(string_split(text, chr(10)), 1) as i from conversations) where trim(t, ' ' || chr(9) || chr(13)) <> ''""")
def lines_scan(spark, sf_dir):
    """Conversations as transcripts, a turn as a page."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: F.concat(F.lit("<!-- page "), x["turn"].cast("string"), F.lit(" -->\n"), x["text"])), "\n")
    bodies = table(spark, sf_dir, "conversations").groupBy(F.concat(F.lit("conv"), F.col("conv_id").cast("string")).alias("doc_id")).agg(body.alias("body"))
    return transcript_lines(bodies).select("doc_id", F.col("pos").cast("int").alias("pos"), "text", "page")


@query("""with r as (select l_orderkey as o, l_linenumber as n, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) as ln, l_partkey, l_returnflag, l_linestatus from lineitem),
 b as (select *, case when ln = 1 or lag(l_returnflag) over w <> l_returnflag or l_linestatus = 'F' then 1 else 0 end as cut from r window w as (partition by o order by ln)),
 g as (select *, sum(cut) over (partition by o order by ln) as line from b)
 select cast(o as varchar) as doc_id, cast(line - 1 as int) as pos, string_agg('p' || cast(l_partkey as varchar), ' ' order by ln) as text from g group by o, line""")
def wrapped_join(spark, sf_dir):
    """Raw lines joined: an order is a page, the return flag the font size, status F a wide gap."""
    from pyspark.sql import Window

    li = table(spark, sf_dir, "lineitem").withColumn("ln", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")))
    gap = F.sum(F.when(F.col("l_linestatus") == "F", 100.0).otherwise(10.0)).over(Window.partitionBy("l_orderkey").orderBy("ln"))
    raw = li.select(F.col("l_orderkey").cast("string").alias("doc_id"), F.lit(1).alias("page"), "ln", F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("text"), gap.alias("top"), F.when(F.col("l_returnflag") == "A", 10).when(F.col("l_returnflag") == "N", 11).otherwise(12).alias("size"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("bold_share"))
    return layout.joined_lines(raw).select("doc_id", F.col("pos").cast("int").alias("pos"), "text")


@query("""with l as (select s_nationkey as n, s_suppkey as s, case when s_suppkey % 4 = 0 then '"term ' || cast(s_suppkey as varchar) || '" means' when s_suppkey % 31 = 30 then '(2) Other words' else 'more' end as text from supplier),
 k as (select *, sum(case when text like '"term%' then 1 else 0 end) over (partition by n order by s) as t from l),
 z as (select *, max(case when text like '(2)%' and t > 0 then 1 else 0 end) over (partition by n order by s) as notes from k)
 select cast(n as varchar) as doc_id, cast(s as int) as pos, case when notes = 1 then 'notes' when t > 0 then 'def' else 'intro' end as zone,
 case when notes = 0 and t > 0 then 'term ' || cast(max(case when text like '"term%' then s end) over (partition by n order by s) as varchar) end as term from z""")
def definitions_split(spark, sf_dir):
    s = F.col("s_suppkey")
    text = F.when(s % 4 == 0, F.concat(F.lit('"term '), s.cast("string"), F.lit('" means'))).when(s % 31 == 30, F.lit("(2) Other words")).otherwise("more")
    lines = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("doc_id"), s.cast("int").alias("pos"), text.alias("text"))
    return definitions.split_definitions(lines, r'^"(?P<term>[^"]+)"', r"^\(\d+\)\s").select("doc_id", "pos", "zone", "term")


@query("""with r as (select p_size as d, p_partkey as k, case when p_partkey % 3 = 0 then p_name else '' end as t, p_type as v from part),
 g as (select *, sum(case when t <> '' then 1 else 0 end) over (partition by d order by k) as n from r)
 select cast(d as varchar) as doc_id, cast(n as int) as def_idx, cast(k as int) as row, max(case when t <> '' then t end) over (partition by d, n) as term, v as text from g where n > 0""")
def definition_table(spark, sf_dir):
    """Two-column rows: an empty term cell continues the definition above."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("doc_id"), k.cast("int").alias("row"), F.array(F.when(k % 3 == 0, F.concat(F.lit("“"), "p_name", F.lit("”"))).otherwise(""), "p_type").alias("cells"))
    return definitions.table_definitions(rows, term_cell="^“(?P<term>[^”]+)”$").select("doc_id", "def_idx", "row", "term", "text")


@query("""with l as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as h from pages)
 select 'p/' || cast(page_id as varchar) || '.md' as path, h as raw from l where substr(h, 2) not in (select p_name from part union all select substr(h, 2) from l where page_id % 2 = 0)""")
def dangling_links(spark, sf_dir):
    """Links of pages as markdown; the targets of even pages' links exist."""
    pages = table(spark, sf_dir, "pages").withColumn("h", F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)))
    texts = pages.select(F.concat(F.lit("p/"), F.col("page_id").cast("string"), F.lit(".md")).alias("path"), F.array_join(F.transform("h", lambda h: F.concat(F.lit("[x]("), h, F.lit(")"))), " ").alias("content"))
    have = table(spark, sf_dir, "part").select(F.col("p_name").alias("path")).unionByName(pages.where("page_id % 2 = 0").select(F.explode("h").alias("h")).select(F.substring("h", 2, 1 << 20).alias("path"))).distinct()
    return checks.dangling_links(texts, have)


@query("select cast(o_orderkey as varchar) as path, 'o' || cast(o_custkey as varchar) as target from orders where o_custkey % 5 = 0 and o_orderkey % 3 <> 0")
def anchor_check(spark, sf_dir):
    to = F.concat(F.lit("o"), F.col("o_custkey").cast("string"))
    own = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit('<a id="'), to, F.lit('"></a> '))).otherwise("")
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("path"), F.concat(own, F.when(F.col("o_custkey") % 5 == 0, F.concat(F.lit("see [it](#"), to, F.lit(")"))).otherwise("none")).alias("content"))
    return checks.missing_anchors(files)


@query("""with n as (select o_orderkey as k, o_orderpriority as c from orders where o_orderkey % 10 <> 0), o as (select o_orderkey as k, case when o_orderkey % 7 = 0 then 'x' else o_orderpriority end as c from orders where o_orderkey % 11 <> 0)
 select cast(coalesce(n.k, o.k) as varchar) as path, case when o.k is null then 'added' when n.k is null then 'removed' else 'changed' end as change from n full outer join o on n.k = o.k where o.k is null or n.k is null or n.c <> o.c""")
def tree_diff(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("path"), F.col("o_orderpriority").alias("content"))
    return checks.tree_diff(orders.where("o_orderkey % 10 <> 0"), orders.where("o_orderkey % 11 <> 0").withColumn("content", F.when(F.col("o_orderkey") % 7 == 0, "x").otherwise(F.col("content"))))


@query("""with n as (select s_suppkey as k, s_name as t, s_nationkey as p from supplier where s_suppkey % 9 <> 0), o as (select s_suppkey as k, case when s_suppkey % 4 = 0 then 'x' else s_name end as t, case when s_suppkey % 5 = 0 then -1 else s_nationkey end as p from supplier where s_suppkey % 8 <> 0), j as (select coalesce(n.k, o.k) as k, n.k as a, o.k as b, n.t as t1, o.t as t2, n.p as p1, o.p as p2 from n full outer join o on n.k = o.k)
 select cast(k as varchar) as name, 'missing' as problem from j where b is null union all select cast(k as varchar), 'extra' from j where a is null union all select cast(k as varchar), 'title changed' from j where t1 <> t2 union all select cast(k as varchar), 'position changed: nation' from j where p1 <> p2""")
def shape_diff(spark, sf_dir):
    base = table(spark, sf_dir, "supplier").select(F.lit("d").alias("doc_id"), "s_suppkey", F.col("s_suppkey").cast("string").alias("name"), F.col("s_name").alias("title"), F.col("s_nationkey").alias("n"))
    place = lambda d: d.withColumn("position", F.array(item("nation", F.col("n"), "num")))
    copy = base.where("s_suppkey % 8 <> 0").withColumns({"title": F.when(F.col("s_suppkey") % 4 == 0, "x").otherwise(F.col("title")), "n": F.when(F.col("s_suppkey") % 5 == 0, -1).otherwise(F.col("n"))})
    return checks.shape_diff(place(base.where("s_suppkey % 9 <> 0")), place(copy)).select("name", "problem")


@query("""select cast(event_id as varchar) as path, 'type: ' || event_type || chr(10) || '  at: ' || case when event_id % 3 = 0 then '''now''' when event_id % 4 = 0 then '''now''' else '''t' || cast(user_id as varchar) || '''' end as content from events""")
def timestamp_retention(spark, sf_dir):
    """A third of the events is new, a quarter changed; the others keep their time."""
    ev = table(spark, sf_dir, "events").withColumn("path", F.col("event_id").cast("string"))
    text = lambda kind, at: F.concat(F.lit("type: "), kind, F.lit("\n  at: "), at)
    new = ev.select("path", text(F.col("event_type"), F.lit(render.STAMP)).alias("content"))
    old = ev.where("event_id % 3 <> 0").select("path", text(F.when(F.col("event_id") % 4 == 0, "old").otherwise(F.col("event_type")), F.concat(F.lit("'t"), F.col("user_id").cast("string"), F.lit("'"))).alias("content"))
    return checks.retained(new, old, "now", render.STAMP)


@query("""with f as (select 'r' || cast(n_regionkey as varchar) as dir, n_nationkey as ord, '/r' || cast(n_regionkey as varchar) || '/n' || cast(n_nationkey as varchar) || '.md' as p, n_name as t from nation)
 select dir || '/index.md' as path, '# ' || dir || chr(10) || chr(10) || string_agg('- [' || t || '](' || p || '): about ' || t, chr(10) order by ord) || chr(10) || chr(10) || '<!-- Generated. Do not edit by hand. -->' || chr(10) as content from f group by dir""")
def bundle_index(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    files = n.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string"), F.lit("/n"), F.col("n_nationkey").cast("string"), F.lit(".md")).alias("path"), F.col("n_name").alias("title"), F.concat(F.lit("about "), "n_name").alias("description"), F.col("n_nationkey").cast("int").alias("ord"), F.array().cast("array<string>").alias("levels"))
    return render.indexes(files, {}).where("path <> 'index.md'")


@query("""select o_custkey, o_orderpriority, count(*) as n from orders group by 1, 2 having count(*) > 1""")
def duplicate_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("path", F.concat_ws("/", F.col("o_custkey").cast("string"), "o_orderpriority"))
    twice = checks.duplicate_paths(orders.select("path"))
    return twice.select(F.substring_index("path", "/", 1).cast("long").alias("o_custkey"), F.regexp_replace("path", "^[^/]*/", "").alias("o_orderpriority"), F.col("count").alias("n"))


NUMBERED = "select l_orderkey as o, l_linenumber as num, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) as e, l_returnflag as f, l_shipdate as d, l_partkey as p from lineitem"


def numbered(spark, sf_dir) -> DataFrame:
    table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem")
    return spark.sql(NUMBERED)


@query(f"select o, was, num from (select *, lag(num) over (partition by o order by e) as was from ({NUMBERED})) where num <> was + 1")
def register_gaps(spark, sf_dir):
    """Orders as registers, their lines as entries: where the numbers jump."""
    return registers.number_gaps(numbered(spark, sf_dir), by=("o",), order="e", number="num").drop("e")


@query(f"""select cast(o as varchar) as o, count(*) as n_entries, '| Entry | Date | Description |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || cast(num as varchar) || ' | ' || strftime(d, '%Y-%m-%d') || ' | part ' || cast(p as varchar) || ' |', chr(10) order by e) as entry_table from ({NUMBERED}) group by o""")
def register_tables(spark, sf_dir):
    e = numbered(spark, sf_dir).select(F.col("o").cast("string").alias("o"), "e", F.array(F.col("num").cast("string"), F.date_format("d", "yyyy-MM-dd"), F.concat(F.lit("part "), F.col("p").cast("string"))).alias("cells"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("e", "cells"))), lambda x: x["cells"])
    head = F.array(F.array(F.lit("Entry"), F.lit("Date"), F.lit("Description")))
    return e.groupBy("o").agg(F.count(F.lit(1)).alias("n_entries"), rows.alias("r")).select("o", "n_entries", markdown_table(F.concat(head, F.col("r"))).alias("entry_table"))


@query(f"select o, string_agg(k, ',' order by k = 'Note', seen) as columns from (select o, k, min(e) as seen from (select o, e, case f when 'A' then 'Note' when 'N' then 'Term' else 'Date' end as k from ({NUMBERED})) group by o, k) group by o")
def schedule_columns(spark, sf_dir):
    """Keys in order of first sight, notes last."""
    k = F.when(F.col("f") == "A", "Note").when(F.col("f") == "N", "Term").otherwise("Date")
    cols = registers.schedule_columns(numbered(spark, sf_dir).select("o", F.col("e").alias("entry"), F.lit(0).alias("at"), k.alias("k")), by=("o",))
    return cols.select("o", F.array_join("columns", ",").alias("columns"))


@query("""select cast(event_id as varchar) || '.md' as path, 'missing title' as problem from events union all select cast(event_id as varchar) || '.md', 'missing type' from events where event_id % 2 = 1 union all select cast(event_id as varchar) || '.md', 'field Bad-Name is not snake_case' from events where event_id % 5 = 0""")
def schema_check(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    text = F.concat(F.lit("props: "), "props", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("\ntype: "), "event_type")).otherwise(""), F.when(F.col("event_id") % 5 == 0, "\nBad-Name: 1").otherwise(""))
    texts = ev.select(F.concat(F.col("event_id").cast("string"), F.lit(".md")).alias("path"), text.alias("yaml"), F.lit(True).alias("has_frontmatter"))
    return checks.schema_problems(texts, texts.select("path"))


@query(r"""with l as (select doc_id, trim(t, ' ' || chr(9) || chr(13)) as t, i from (select doc_id, unnest(string_split(text, chr(10))) as t, generate_subscripts(string_split(text, chr(10)), 1) as i from documents)),
 r as (select doc_id, t, i, length(t) >= 40 as long from l where t <> '' and not regexp_matches(t, '^[•#|]')),
 b as (select doc_id, arg_min(t, i) filter (where long) as big, arg_min(t, i) as small from r group by doc_id)
 select d.doc_id, case when big is null then small when regexp_matches(big, '(?s)^.{59,}?[.!?]\s') then regexp_extract(big, '(?s)^(.{59,}?[.!?])\s', 1) when length(big) <= 240 then big when substr(big, 1, 239) like '% %' then regexp_replace(substr(big, 1, 239), '(?s) [^ ]*$', '') || '…' else substr(big, 1, 239) || '…' end as sentence from documents d left join b on d.doc_id = b.doc_id""")
def first_sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", first_sentence(F.split("text", "\n")).alias("sentence"))


@query("select p_partkey, trim(regexp_replace(lower(p_name || '  & ' || p_type), '[^a-z0-9]+', '-', 'g'), '-') as slug from part")
def slug_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", slug(F.concat("p_name", F.lit("  & "), "p_type")).alias("slug"))


@query("select s_suppkey, case when length(cast(s_suppkey as varchar)) < 2 then lpad(cast(s_suppkey as varchar), 2, '0') else cast(s_suppkey as varchar) end as padded from supplier")
def padded_names(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", padded(F.concat(F.lit("00"), F.col("s_suppkey").cast("string"))).alias("padded"))


@query("""select c_custkey, upper(substr(lower(t), 1, 1)) || replace(substr(lower(t), 2), 'rtm', 'RTM') as shown, t = upper(t) as capitals from (select c_custkey, case when c_custkey % 2 = 0 then c_mktsegment || ' RTM RULES' else lower(c_mktsegment) || ' rtm Rules' end as t from customer)""")
def sentence_cases(spark, sf_dir):
    t = F.when(F.col("c_custkey") % 2 == 0, F.concat("c_mktsegment", F.lit(" RTM RULES"))).otherwise(F.concat(F.lower("c_mktsegment"), F.lit(" rtm Rules")))
    return table(spark, sf_dir, "customer").select("c_custkey", sentence_case(t, ["RTM"]).alias("shown"), is_upper(t).alias("capitals"))


@query("select doc_id, regexp_extract(text, '^[0-9]{1,3}[.] ', 0) || regexp_replace(substr(text, length(regexp_extract(text, '^[0-9]{1,3}[.] ', 0)) + 1), '[0-9]', '0', 'g') as text from (select doc_id, cast(doc_id % 1000 as varchar) || '. ' || text as text from documents)")
def redact_zero_digits(spark, sf_dir):
    """Digits of numbered texts as zeros; the numbering stays."""
    return table(spark, sf_dir, "documents").select("doc_id", redact.zero_digits(F.concat((F.col("doc_id") % 1000).cast("string"), F.lit(". "), "text")).alias("text"))


@query()
def redact_words(spark, sf_dir):
    """Words replaced by a counter that runs through a document: sequential, so without SQL."""
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    return redact.redact_lines(lines, terms=["the"])


@query(f"""select cast(n_regionkey as varchar) as doc_id, '---' || chr(10) || 'title: Region ' || cast(n_regionkey as varchar) || chr(10) || 'sources:' || chr(10) || '- id: r' || cast(n_regionkey as varchar) || chr(10) || 'generated_by: {render.TOOL}' || chr(10) || '---' || chr(10) || chr(10) ||
 string_agg('<a id="n' || cast(n_nationkey as varchar) || '"></a>' || chr(10) || chr(10) || '# ' || n_name || chr(10) || chr(10) || '- title: ' || n_name || chr(10) || '- article_number: ' || cast(n_nationkey as varchar) || chr(10) || chr(10) || 'See [next](#n' || cast(n_nationkey + 1 as varchar) || ').', chr(10) || chr(10) order by n_nationkey) || chr(10) as content from nation group by n_regionkey""")
def single_file(spark, sf_dir):
    """Sections of one file a region under its frontmatter, references as jumps."""
    k, r = F.col("n_nationkey"), F.col("n_regionkey").cast("string")
    nation, none = table(spark, sf_dir, "nation"), F.lit(None).cast("string")
    made = nation.select(r.alias("doc_id"), k.cast("int").alias("seq"), F.concat(F.lit("n"), k.cast("string")).alias("name"), F.col("n_name").alias("title"), F.array(F.concat(F.lit("See [next](ref:n"), (k + 1).cast("string"), F.lit(")."))).alias("body"), none.alias("description"), F.array(item("article_number", k, "num")).alias("position"))
    heads = nation.select(r.alias("doc_id"), F.concat(F.lit("Region "), r).alias("title"), none.alias("description"), F.concat(F.lit("- id: r"), r, F.lit("\n")).alias("sources")).distinct()
    return render.single_files(render.sections(made), heads)


@query("select s_suppkey, 'type: supplier' || chr(10) || 'title: ' || s_name || chr(10) || 'number: ' || cast(s_suppkey as varchar) || chr(10) as yaml from supplier")
def frontmatter_yaml(spark, sf_dir):
    """Fields of every supplier as YAML, byte for byte."""
    fields = F.array(item("type", F.lit("supplier"), "str"), item("title", F.col("s_name"), "str"), item("number", F.col("s_suppkey"), "num"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", render.to_yaml(fields).alias("yaml"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import build_queries  # noqa: F401  (registers its queries, which use this module)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLES)
