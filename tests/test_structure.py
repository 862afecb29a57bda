"""Structure operators on hand-made lines, and against a line-by-line reading."""

import random

import pytest
from pyspark.sql import functions as F

from quillstack.functions import text as T
from quillstack.functions.patterns import Pattern, template
from quillstack.operators import assemble, checks, definitions, redact, render, segments
from quillstack.plans.rules import Overrides, Rules
from quillstack.sources import layout
from quillstack.sources.docx import Counting, Document
from quillstack.sources.transcripts import choose_source, read_transcripts, transcript_lines

LINES = segments.LINES


def lines(spark, rows, doc="d"):
    """rows: (text, bold[, style[, size]])"""
    made = [(doc, i, r[0], r[1], 1 + i // 3, r[3] if len(r) > 3 else None, None, r[2] if len(r) > 2 else None) for i, r in enumerate(rows)]
    return spark.createDataFrame(made, LINES)


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


def test_patterns_keep_their_meaning(spark):
    p = Pattern.of(r"^(?P<number>\d+)\.(?P<rest_part>[^]\[x]+)(?P=number)\Z")
    assert one(spark, p.matches(F.col("t")), t="12.ab12") and not one(spark, p.matches(F.col("t")), t="12.ab13")
    assert one(spark, p.group(F.col("t"), "rest_part"), t="12.ab 12") == "ab"
    assert one(spark, template("a {x} {y}!", lambda n: F.col(n) if n == "x" else F.lit(None)), x="1") == "a 1 !"
    with pytest.raises(ValueError):
        Pattern.of("(?(1)a|b)")


def test_text_functions(spark):
    c = F.col("t")
    assert one(spark, T.slug(c), t="--A b/C9--") == "a-b-c9"
    assert one(spark, T.sentence_case(c, ["RTM"]), t="THE RTM COMPANY") == "The RTM company"
    assert one(spark, T.title_case(c), t="o'neil JR. x2y") == "O'Neil Jr. X2Y"
    assert [one(spark, T.padded(c), t=x) for x in ("7", "007", "117", "a1")] == ["07", "07", "117", "a1"]
    assert [one(spark, T.is_upper(c), t=x) for x in ("ÀB 1", "Ab", "12", "ǅ")] == [True, False, False, False]
    long = "This first sentence is meant to be quite a bit longer than sixty characters. Then more."
    assert one(spark, T.first_sentence(F.split(c, "\n")), t="• no\n# no\nshort\n" + long) == long[: long.index(". ") + 1]
    assert one(spark, T.first_sentence(F.split(c, "\n")), t="• no\nshort") == "short"
    assert one(spark, T.first_sentence(F.split(c, "\n")), t="word " * 60) == ("word " * 47).strip() + "…"
    paths = {"/a/b.md#x": "a/b.md", "c.md": "d/c.md", "../c.md": "c.md", "../../c.md": "../c.md", "http://x": None, "#x": None, "./e/": "d/e"}
    assert {k: one(spark, T.resolved(c, F.lit("d/f.md")), t=k) for k in paths} == paths
    table = F.array(F.array(F.lit("a|b"), F.lit("c\n d")), F.array(F.lit(None).cast("string"), F.lit("")), F.array(F.lit("e")))
    assert one(spark, T.markdown_table(table), t="") == "| a\\|b | c d |\n|---|---|\n| e |  |"


def test_transcript_lines(spark):
    body = "x\r\n<!-- page 3 -->\n\n **Bold one** \n**a** and **b**\n<!-- note -->\ny"
    got = transcript_lines(spark.createDataFrame([("d", body)], "doc_id string, body string")).orderBy("pos").collect()
    assert [(r.text, r.bold, r.page) for r in got] == [("x", False, None), ("Bold one", True, 3), ("**a** and **b**", False, 3), ("y", False, 3)]


RULES = {
    "front-matter": {"ends-at": "part"}, "back-matter": {"starts-at": "^IN WITNESS"}, "display-case": "sentence", "acronyms": ["RTM"],
    "headings": [
        {"level": "part", "match": r"^PART\s+(?P<number>\d+)\b\s*(?P<title>.*)$", "bold": True, "title-from-next-line": True, "display": "Part {number} – {title}"},
        {"level": "section", "bold": True, "case": "upper", "max-words": 6}, {"level": "head", "bold": True, "case": "mixed", "scope": "next-unit"},
    ],
    "units": {"key": ["number"], "patterns": [{"match": r"^(?P<number>\d+)\.\s+", "filename": "rule-{number}", "title": "Rule {number} – {heading}", "title-without-heading": "Rule {number}"}], "heading-level": "head", "fields": ["part", "section"], "number-field": "rule_number"},
    "definitions": {"unit": 1, "file": "words", "type": "definitions", "term": '^"(?P<term>[^"]+)"', "ends-at": r"^\(2\)"},
    "cross-references": [r"\brule\s+(?P<number>\d+)"],
}
TEXT = [("Title", False), ("PART 1", True), ("THE RTM RULES", True), ("Words used", True), ("1. Here:", False), ('"fee" means money;', False), ("and more", False), ("(2) Else", False), ("NAMES", True), ("2. Call rule 3 and rule 9.", False), ("Odd", True), ("3. Sum, see rule 3", False), ("4. Last", False), ("PART 2 End", True), ("stray", False), ("IN WITNESS whereof", False), ("5. Gone", False)]


def test_units_headings_and_scopes(spark):
    p = segments.parse_units(lines(spark, TEXT), Rules.of(RULES))
    got = {r.key: r for r in p.units.collect()}
    assert sorted(got) == ["1", "2", "3", "4"]
    assert [(got[k].headings["part"], got[k].headings["section"], got[k].headings["head"]) for k in "1234"] == [("Part 1 – The RTM rules", None, "Words used"), ("Part 1 – The RTM rules", "Names", None), ("Part 1 – The RTM rules", "Names", "Odd"), ("Part 1 – The RTM rules", "Names", None)]
    assert [r.text for r in p.unit_lines.where("idx = 0").orderBy("pos").collect()] == ["Here:", '"fee" means money;', "and more", "(2) Else"]
    assert got["1"].pages == [2, 3] and [r.text for r in p.front.collect()] == ["Title"]
    assert [r.message for r in p.diagnostics.collect()] == ["page 5: text outside any unit: stray"]


def test_concepts_links_and_files(spark):
    rules = Rules.of(RULES)
    over = Overrides.of({"groups": [{"file": "both", "title": "Both", "units": [3, 4, 8]}], "headings": {2: "Naming"}, "descriptions": {2: "About names."}, "definitions": {"notes-heading": "Notes", "defined-elsewhere": [{"term": "sum", "unit": 3, "ref": "rule 3"}]}})
    a = assemble.Assembler(segments.parse_units(lines(spark, TEXT), rules), rules, over)
    made = a.assembled().persist()
    got = {r.name: r for r in made.collect()}
    assert [r.name for r in sorted(got.values(), key=lambda r: r.seq)] == ["words", "both", "rule-02"]
    assert got["rule-02"].title == "Rule 2 – Naming" and got["rule-02"].body == ["Call [rule 3](ref:both) and rule 9."] and got["rule-02"].description == "About names."
    assert got["both"].body == ["## Rule 3", "Sum, see rule 3", "## Rule 4", "Last"] and got["both"].ord == 2
    assert got["words"].body == ["Here:", "## fee", '"fee" means money;\n\nand more', "## Notes", "(2) Else", "## sum", "Defined in [rule 3](ref:both)."]
    doc = {"id": "d", "bundle-path": "rules", "concept-type": "rule", "description": "The rules"}
    file = {r.path: r.content for r in render.concept_files(made, render.document_rows(spark, [doc])).collect()}["rules/rule-02.md"]
    assert file.startswith("---\ntype: rule\ntitle: Rule 2 – Naming\ndescription: About names.\npart: Part 1 – The RTM rules\nsection: Names\nrule_number: 2\nsource_pages:\n- 4\nsources:\n- id: d\n  title: The rules\n") and file.endswith("# Rule 2 – Naming\n\nCall [rule 3](/rules/both.md) and rule 9.\n")
    said = {r.message for r in a.diagnostics().collect()}
    assert "group both: unit 8 not found" in said


def test_fallback_units_resume(spark):
    rules = Rules.of({"headings": [{"level": "part", "bold": True, "match": "^(?P<name>[A-Z]+)$"}], "units": {"key": ["x"], "patterns": [], "heading-fallback": [{"level": "part", "filename": "{slug}", "title": "{part_name}", "key": "part.{part_name}"}]}})
    p = segments.parse_units(lines(spark, [("loose", False), ("ONE", True), ("a", False), ("TWO", True), ("b", False), ("ONE", True), ("c", False)]), rules)
    assert [(r.key, r.number) for r in p.units.orderBy("idx").collect()] == [("part.one", "part.one"), ("part.two", "part.two")]
    assert [r.text for r in p.unit_lines.where("idx = 0").orderBy("pos").collect()] == ["a", "c"]
    assert [r.message for r in p.diagnostics.collect()] == ["page 1: text outside any unit: loose"]


def test_gates_and_styles(spark):
    cfg = {"headings": [{"level": "annex", "bold": True, "case": "upper"}], "units": {"key": ["n"], "patterns": [{"match": r"^(?P<n>\d+)\)", "filename": "a{n}", "title": "A", "key": "annex.{n}", "requires-heading": "annex"}, {"match": r"^(?P<n>\d+)\)", "filename": "c{n}", "title": "C", "unless-heading": "annex", "continues-with-style": ["List"]}]}}
    p = segments.parse_units(lines(spark, [("1) x", False, "List"), ("y", False, "List"), ("z", False, "Body"), ("ANNEX", True), ("1) w", False, "List")]), Rules.of(cfg))
    assert [r.key for r in p.units.orderBy("idx").collect()] == ["1", "annex.1"]
    assert [r.text for r in p.unit_lines.orderBy("pos").collect()] == ["x", "y", "w"]
    cfg["headings"][0]["scope"] = "next-unit"
    with pytest.raises(ValueError):
        Rules.of(cfg)


@pytest.mark.parametrize("seed", range(2))
def test_windows_agree_with_reading_line_by_line(spark, seed):
    """Random streams of parts, sections, headings, units and text in several documents, in any partitioning."""
    r, docs = random.Random(seed), []
    kinds = [("PART {}", True), ("LOUD {}", True), ("Soft {}", True), ("{}. unit", False), ("text {}", False)]
    for d in range(4):
        docs += [(f"d{d}", i, k.format(r.randint(1, 9)), bold, 1, None, None, None) for i, (k, bold) in enumerate(r.choices(kinds, k=30))]
    rules = Rules.of({k: v for k, v in RULES.items() if k not in ("front-matter", "back-matter", "definitions")})
    want = []
    for d in range(4):
        own, state, i, n = [x for x in docs if x[0] == f"d{d}"], {}, 0, 0
        while i < len(own):
            text, bold = own[i][2], own[i][3]
            if text.startswith("PART"):
                step = 2 if i + 1 < len(own) and own[i + 1][3] else 1
                state = {"part": i}
                i += step
                continue
            if text.startswith("LOUD"):
                state = {k: v for k, v in state.items() if k == "part"} | {"section": text.capitalize()}
            elif bold:
                state["head"] = text
            elif text.endswith("unit"):
                want.append((f"d{d}", n, text.split(".")[0], state.get("section"), state.pop("head", None)))
                n += 1
            i += 1
    for parts in (1, 4):
        p = segments.parse_units(spark.createDataFrame(docs, LINES).repartition(parts), rules)
        got = sorted((x.doc_id, x.idx, x.key, x.headings["section"], x.headings["head"]) for x in p.units.collect())
        assert got == sorted(want)


def test_definitions_of_tables(spark):
    rows = [("d", i, c) for i, c in enumerate([["Term", "Meaning"], ["", "early"], ["“a”", "one\n two"], ["", "three"], ["b", ""], [None, None]])]
    got = definitions.table_definitions(spark.createDataFrame(rows, "doc_id string, row int, cells array<string>"), ["term"], "^“(?P<term>.+)”$")
    assert [(r.def_idx, r.term, r.text) for r in got.orderBy("row").collect()] == [(1, "a", "one two"), (1, "a", "three"), (2, "b", None)]


def test_checks_and_differences(spark):
    texts = spark.createDataFrame([("a/x.md", "[l](y.md) [m](/z.md#q) ![i](../p.png) [w](http://e)")], "path string, content string")
    have = spark.createDataFrame([("a/y.md",)], "path string")
    assert sorted(r.raw for r in checks.dangling_links(texts, have).collect()) == ["../p.png", "/z.md#q"]
    files = spark.createDataFrame([("s.md", '<a id="b"></a> [x](#b) [y](#c)')], "path string, content string")
    assert [r.target for r in checks.missing_anchors(files).collect()] == ["c"]
    yamls = [("x.md", "type: t\ntitle: ''\nok: [{Bad: 1}]\nresource: /no.md", True), ("y.md", None, False), ("index.md", None, False)]
    got = checks.schema_problems(spark.createDataFrame(yamls, "path string, yaml string, has_frontmatter boolean"), have)
    assert sorted((r.path, r.problem) for r in got.collect()) == [("x.md", "field ok.Bad is not snake_case"), ("x.md", "missing title"), ("x.md", "resource /no.md not found in the bundle"), ("y.md", "no frontmatter")]
    old = spark.createDataFrame([("a", "k: 1\n  at: 'old'\n"), ("b", "k: 1\n  at: 'old'\n")], "path string, content string")
    new = spark.createDataFrame([("a", "k: 1\n  at: S\n"), ("b", "k: 2\n  at: S\n"), ("c", "at S")], "path string, content string")
    assert {r.path: r.content for r in checks.retained(new, old, "now", "S").collect()} == {"a": "k: 1\n  at: 'old'\n", "b": "k: 2\n  at: 'now'\n", "c": "at 'now'"}


def test_layout(spark):
    raw = [("d", 1, i, t, float(top), 10.4, 1.0, 0.0) for i, (t, top) in enumerate([("One", 0), ("two", 12), ("drop me", 24), ("three", 36), ("• four", 48), ("far", 90)])]
    got = layout.joined_lines(spark.createDataFrame(raw, "doc_id string, page int, ln int, text string, top double, size double, x0 double, bold_share double"), drop=["^drop"], breaks=["•"])
    assert [r.text for r in got.orderBy("pos").collect()] == ["One two", "three", "• four", "far"]
    words = [("d", 1, i, t, x, x + 1, y, 10.0, "f") for i, (t, x, y) in enumerate([("b", 5.0, 1.0), ("a", 1.0, 2.5), ("c", 1.0, 4.5), ("d", 9.0, 5.0)])]
    rows = layout.word_rows(spark.createDataFrame(words, "doc_id string, page int, word_ix int, text string, x0 double, x1 double, top double, size double, fontname string"))
    assert [r.t for r in rows.select("row", layout.row_text(F.col("words")).alias("t")).orderBy("row").collect()] == ["a b", "c d"]
    assert [c["reason"] for c in choose_source([{"id": "a"}, {"id": "b", "source": "b.pdf"}, {"id": "c", "source": "c.txt"}], {"a"}, {"c"})] == [None, "source not found: b.pdf", "no reader for .txt without a transcript"]


def test_docx_numbers():
    import io
    import zipfile

    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    num = f'<w:numbering {ns}><w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:start w:val="1"/><w:lvlText w:val="%1."/></w:lvl><w:lvl w:ilvl="1"><w:start w:val="1"/><w:lvlText w:val="%1.%2"/></w:lvl></w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num><w:num w:numId="2"><w:abstractNumId w:val="0"/><w:lvlOverride w:ilvl="0"><w:startOverride w:val="7"/></w:lvlOverride></w:num></w:numbering>'
    p = lambda text, n, lvl, bold="": f'<w:p><w:pPr><w:numPr><w:ilvl w:val="{lvl}"/><w:numId w:val="{n}"/></w:numPr></w:pPr><w:r>{bold}<w:t>{text}</w:t></w:r></w:p>'
    body = p("a", 1, 0, "<w:rPr><w:b/></w:rPr>") + p("b", 1, 1) + p("", 1, 1) + p("c", 1, 1) + p("d", 1, 0) + p("e", 1, 1) + p("f", 2, 0) + p("g", 2, 0) + p("h", 0, 0)
    table = "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body>{body}{table}</w:body></w:document>")
        z.writestr("word/numbering.xml", num)
    doc = Document(data.getvalue())
    assert [x[:2] for x in doc.lines()] == [("1. a", True), ("1.1 b", False), ("1.3 c", False), ("2. d", False), ("2.1 e", False), ("7. f", False), ("8. g", False), ("h", False)]
    assert list(doc.tables()) == [("h", [["x"]])]
    assert Counting(None).next("1", 0) == ""


def test_zero_digits(spark):
    assert one(spark, redact.zero_digits(F.col("t")), t="12. pay 34") == "12. pay 00"


def test_list_counting():
    from xml.etree import ElementTree as ET

    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    level = lambda i, text, start=1, kind="decimal": f'<w:lvl w:ilvl="{i}"><w:start w:val="{start}"/><w:numFmt w:val="{kind}"/><w:lvlText w:val="{text}"/></w:lvl>'
    num = lambda n, a, *over: f'<w:num w:numId="{n}"><w:abstractNumId w:val="{a}"/>' + "".join(f'<w:lvlOverride w:ilvl="{k}"><w:startOverride w:val="{v}"/></w:lvlOverride>' for k, v in over) + "</w:num>"
    root = ET.fromstring(f'<w:numbering {ns}><w:abstractNum w:abstractNumId="0">{level(0, "%1.")}{level(1, "%1.%2", 3)}{level(2, "(%3) of %1, %9")}{level(3, "x", 1, "none")}</w:abstractNum>{num(1, 0)}{num(2, 0, (0, 7), (1, 5))}{num(3, 9)}</w:numbering>')
    c = Counting(root)
    got = [c.next(n, k) for n, k in (("1", 0), ("1", 1), ("1", 1), ("1", 2), ("1", 0), ("1", 2), ("1", 1), ("1", 3), ("2", 1), ("1", 1), ("2", 1), ("2", 0), ("1", 0), ("1", 8), ("3", 0), ("4", 0))]
    # Level 2 under an uncounted level 1; the second instance restarts the shared list once; an unknown level counts plainly.
    assert got == ["1.", "1.3", "1.4", "(1) of 1, 1", "2.", "(1) of 2, 1", "2.3", "", "6.5", "6.6", "6.7", "7.", "8.", "8", "", ""]


def test_word_documents_as_tables(spark):
    import io
    import zipfile

    from quillstack.sources.docx import docx_lines, docx_tables, table_after

    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    styles = f'<w:styles {ns}><w:style w:type="paragraph" w:default="1" w:styleId="N"><w:name w:val="Normal"/></w:style><w:style w:type="paragraph" w:styleId="H"><w:name w:val="Head"/><w:basedOn w:val="B"/></w:style><w:style w:type="paragraph" w:styleId="B"><w:name w:val="Base"/><w:pPr><w:numPr><w:ilvl w:val="0"/><w:numId w:val="1"/></w:numPr></w:pPr><w:rPr><w:b/></w:rPr></w:style></w:styles>'
    numbering = f'<w:numbering {ns}><w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:lvlText w:val="%1)"/></w:lvl></w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num></w:numbering>'
    cell = lambda *ps: "<w:tc>" + "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in ps) + "</w:tc>"
    table = f"<w:tbl><w:tr>{cell('Term')}{cell('one', 'two')}</w:tr></w:tbl>"
    body = f'<w:p><w:pPr><w:pStyle w:val="H"/></w:pPr><w:r><w:t>Styled</w:t></w:r></w:p><w:p><w:r><w:t>plain</w:t></w:r></w:p>{table}<w:p/>{table.replace("Term", "Other")}'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for name, text in (("document", f"<w:document {ns}><w:body>{body}</w:body></w:document>"), ("styles", styles), ("numbering", numbering)):
            z.writestr(f"word/{name}.xml", text)
    files = spark.createDataFrame([(d, data.getvalue()) for d in ("a", "b")], "doc_id string, content binary")
    got = sorted((r.doc_id, r.pos, r.text, r.bold, r["style"]) for r in docx_lines(files).collect())
    assert got == [(d, i, *x) for d in ("a", "b") for i, x in enumerate([("1) Styled", True, "Head"), ("plain", False, "Normal")])]
    tables = docx_tables(files)
    assert sorted((r.doc_id, r.t, r.before, r.rows) for r in tables.collect()) == [(d, t, "plain", [[c, "one\ntwo"]]) for d in ("a", "b") for t, c in ((0, "Term"), (1, "Other"))]
    assert [(r.t) for r in table_after(tables, None, "Oth").collect()] == [1, 1] and [r.t for r in table_after(tables, "plain").collect()] == [0, 0]


def test_skipped_pages_and_bold(spark):
    raw = [("d", p, i, f"page {p}", 10.0 * i, 10.0, 1.0, 0.0) for p in (1, 2) for i in range(2)]
    df = spark.createDataFrame(raw, "doc_id string, page int, ln int, text string, top double, size double, x0 double, bold_share double")
    assert {r.page for r in layout.without_pages(df, [1]).collect()} == {2}
    assert {r.page for r in layout.without_pages(df, [{"page": 2, "expect": "page 2"}, {"page": 9, "expect": "x"}]).collect()} == {1}
    with pytest.raises(Exception, match="was to be skipped"):
        layout.without_pages(df, [{"page": 2, "expect": "gone"}]).collect()
    with pytest.raises(Exception, match="not found"):
        layout.tables_between(df, df, "^nowhere").collect()
    chars = lambda fonts: F.array(*[F.struct(F.lit(t).alias("text"), F.lit(f).alias("fontname")) for t, f in fonts])
    cases = [([("a", "X-Bold")] * 9 + [("b", "X")], True), ([("a", "X-Bold")] * 8 + [("b", "X")] * 2, False), ([(" ", "X")] * 9 + [("a", "BOLD")], True), ([(" ", "X-Bold")], False)]
    assert [one(spark, layout.is_bold(chars(c)), t="") for c, _ in cases] == [want for _, want in cases]


def test_big_tables_are_linear(spark):
    import time

    cells = F.transform(F.sequence(F.lit(1), F.lit(20000)), lambda i: F.array(i.cast("string"), F.lit("a|b")))
    began = time.time()
    made = spark.range(1).select(T.markdown_table(cells).alias("t")).first().t
    assert made.count("\n") == 20000 and made.endswith("| 20000 | a\\|b |") and time.time() - began < 30


def test_stream_equals_batch(spark, tmp_path):
    from quillstack.streaming.ingest import build_units, transcript_stream

    src = tmp_path / "in"
    src.mkdir()
    for name in ("one", "two"):
        (src / f"{name}.md").write_text("---\nsource: x\n---\n**PART 1 A**\n1. first\n2. second\n", encoding="utf-8")
    rules, got = Rules.of({k: v for k, v in RULES.items() if k != "front-matter"}), []
    build_units(transcript_stream(spark, str(src)), rules, lambda units, _: got.extend((r.doc_id, r.key) for r in units.collect()), str(tmp_path / "cp")).awaitTermination()
    bodies = read_transcripts(spark, str(src))
    want = [(r.doc_id, r.key) for r in segments.parse_units(transcript_lines(bodies.select("doc_id", "body")), rules).units.collect()]
    assert sorted(got) == sorted(want) == [(d, k) for d in ("one", "two") for k in "12"]


def test_tree_sink(spark, tmp_path):
    from quillstack.sources.sinks import write_tree

    files = lambda *x: spark.createDataFrame(list(x), "path string, content string")
    out = str(tmp_path / "out")
    assert write_tree(files(("a/x.md", "k\n  at: __BUILT_AT__\n"), ("y.md", "z")), out, "t1")["added"] == 2
    assert write_tree(files(("a/x.md", "k\n  at: __BUILT_AT__\n")), out, "t2") == {"added": 0, "changed": 0, "removed": 1}
    assert (tmp_path / "out/a/x.md").read_text() == "k\n  at: 't1'\n" and not (tmp_path / "out/y.md").exists()


def test_lead_in_titles_shared_keys_and_missing_descriptions(spark):
    cfg = {"headings": [], "units": {"key": ["number"], "patterns": [{"match": r"^(?P<number>\d+(?:\.\d+)*)\s", "filename": "c-{number}", "title": "Clause {number}", "title-if-split": "Clause {number} – lead-in"}]}}
    rules = Rules.of(cfg)
    a = assemble.Assembler(segments.parse_units(lines(spark, [("1 a", False), ("1.1 b", False), ("11 c", False), ("2 d", False), ("2 e", False), ("3.1 f", False)]), rules), rules)
    got = {r.name: (r.title, r.body) for r in a.assembled().collect()}
    # 1 has a part of its own, 11 has not; of two units with one key the later counts.
    assert got == {"c-01": ("Clause 1 – lead-in", ["a"]), "c-1.1": ("Clause 1.1", ["b"]), "c-11": ("Clause 11", ["c"]), "c-02": ("Clause 2", ["e"]), "c-3.1": ("Clause 3.1", ["f"])}
    said = {r.message for r in a.diagnostics().collect()}
    assert "two units share the key 2" in said and "5 concepts have no description (first: c-01, c-1.1, c-11, c-02, c-3.1)" in said


def test_rows_of_words_across_batches(spark):
    r = random.Random(3)
    words = [(f"d{r.randint(0, 2)}", r.randint(1, 4), i, f"w{i}", float(r.randint(0, 9)), 0.0, r.randint(0, 60) / 2, r.choice((9.5, 10.5, 11.0)), "f") for i in range(600)]
    want = {}
    for w in sorted(words, key=lambda w: (w[0], w[1], w[6], w[4], w[2])):
        page = want.setdefault(w[:2], [])
        page[-1].append(w) if page and w[6] - page[-1][0][6] <= 3 else page.append([w])
    want = sorted((*key, i, g[0][6], round(max(w[7] for w in g)), [w[3] for w in sorted(g, key=lambda w: w[4])]) for key, page in want.items() for i, g in enumerate(page))
    df = spark.createDataFrame(words, "doc_id string, page int, word_ix int, text string, x0 double, x1 double, top double, size double, fontname string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((x.doc_id, x.page, x.row, x.top, x["size"], [w.text for w in x.words]) for x in layout.word_rows(df.repartition(5)).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want


def test_pages_of_a_single_row(spark):
    words = [("a", 1, 0, "x", 1.0, 2.0, 1.0, 9.0, "f"), ("b", 1, 0, "z", 3.0, 4.0, 2.0, 9.0, "f"), ("b", 1, 1, "y", 1.0, 2.0, 4.0, 9.5, "f"), ("b", 2, 0, "w", 1.0, 2.0, 1.0, 9.0, "f")]
    kind = "doc_id string, page int, word_ix int, text string, x0 double, x1 double, top double, size double, fontname string"
    want = [("a", 1, 0, 1.0, 9, ["x"]), ("b", 1, 0, 2.0, 10, ["y", "z"]), ("b", 2, 0, 1.0, 9, ["w"])]
    # The words of the first page, alone and then before others, in one batch and word by word.
    for n, batch in ((1, 100), (4, 100), (4, 1)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        try:
            got = sorted((x.doc_id, x.page, x.row, x.top, x["size"], [w.text for w in x.words]) for x in layout.word_rows(spark.createDataFrame(words[:n], kind)).collect())
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert got == [x for x in want if x[0] == "a" or n > 1]
