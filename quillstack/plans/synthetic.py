"""Governing documents made from the star schema, in SQL that Spark and other engines read alike.

The customers of a region are the articles of its documents, DOC_SIZE customer keys a document, so documents
grow in number with the data: ``PART n`` and its title, then for each nation a heading in capitals, and for each
customer a numbered article that refers to another article of the document; every seventh article has a
heading of its own. Lines carry page, bold and size.
"""

from __future__ import annotations

DOC_SIZE = 300

LINES_SQL = f"""
with placed as (
  select n_regionkey + 5 * (c_custkey / {DOC_SIZE}) as n_regionkey, n_nationkey, n_name, c_custkey, c_mktsegment from customer join nation on c_nationkey = n_nationkey
), article as (
  select n_regionkey as region, n_nationkey as nation, n_name, c_custkey as c, c_mktsegment as seg,
         cast(row_number() over (partition by n_regionkey order by n_nationkey, c_custkey) as int) as k,
         row_number() over (partition by n_regionkey, n_nationkey order by c_custkey) as in_nation
  from placed
), line as (
  select region, k, 0 as part, 'PART ' || cast(region + 1 as varchar(9)) as text, true as bold from article where k = 1
  union all select region, k, 1, 'RULES OF ' || cast(region as varchar(9)) || ' TITLE', true from article where k = 1
  union all select region, k, 2, 'SECTION ' || upper(n_name), true from article where in_nation = 1
  union all select region, k, 3, 'Duty of ' || lower(seg), true from article where k % 7 = 0
  union all select region, k, 4, cast(k as varchar(9)) || '. (1) The member ' || cast(c as varchar(9)) || ' pays under article ' || cast(k / 2 + 1 as varchar(9)) || ' of these rules.', false from article
  union all select region, k, 5, '(2) The ' || lower(seg) || ' fee is due each year.', false from article
  union all select region, k, 6, '(3) Nothing else applies.', false from article where k % 3 = 0
)
select 'doc' || cast(region as varchar(9)) as doc_id,
       cast(row_number() over (partition by region order by k, part) as int) - 1 as pos,
       text, bold, cast((k - 1) / 5 + 1 as int) as page
from line
"""


def spark_sql(text: str) -> str:
    """Whole-number division as Spark spells it."""
    return text.replace("k / 2 + 1", "k div 2 + 1").replace("(k - 1) / 5 + 1", "(k - 1) div 5 + 1").replace(f"c_custkey / {DOC_SIZE}", f"c_custkey div {DOC_SIZE}").replace("varchar(9)", "string")


def duck_sql(text: str = LINES_SQL) -> str:
    return text.replace("k / 2 + 1", "k // 2 + 1").replace("(k - 1) / 5 + 1", "(k - 1) // 5 + 1").replace(f"c_custkey / {DOC_SIZE}", f"c_custkey // {DOC_SIZE}")


RULES = {
    "headings": [
        {"level": "part", "match": r"^PART\s+(?P<number>\d+)\b\s*(?P<title>.*)$", "bold": True, "title-from-next-line": True, "display": "Part {number} – {title}"},
        {"level": "section", "bold": True, "case": "upper", "max-words": 15},
        {"level": "heading", "bold": True, "case": "mixed", "max-words": 15, "scope": "next-unit"},
    ],
    "display-case": "sentence",
    "units": {
        "key": ["number"],
        "patterns": [{"match": r"^(?P<number>\d{1,6})\.\s+", "filename": "article-{number}", "title": "Article {number} – {heading}", "title-without-heading": "Article {number}"}],
        "heading-level": "heading", "fields": ["part", "section"], "number-field": "article_number",
    },
    "cross-references": [r"\barticle\s+(?P<number>\d+)"],
}
