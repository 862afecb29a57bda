"""Whole builds of a small workspace on disk: every kind of document, skips, errors, indexes, single files and the checks on them."""

import hashlib
import io
import zipfile

import pytest
import yaml

from quillstack.operators import checks
from quillstack.plans.build import Workspace, bundle_build, concept_counts, single_build
from quillstack.sources.sinks import write_tree

RULES = {
    "headings": [{"level": "part", "bold": True, "case": "upper"}, {"level": "head", "bold": True, "case": "mixed", "scope": "next-unit"}],
    "units": {"key": ["number"], "patterns": [{"match": r"^(?P<number>\d+)\.\s+", "filename": "rule-{number}", "title": "Rule {number} – {heading}"}], "heading-level": "head", "fields": ["part"], "number-field": "clause_number", "description": "first-sentence"},
    "definitions": {"unit": 1, "file": "words", "title": "Words", "type": "definitions", "term": '^"(?P<term>[^"]+)"'},
    "cross-references": [r"\brule\s+(?P<number>\d+)"],
}
TABLED = {"extract": {"engine": "docx"}, "headings": [], "units": {"key": ["n"], "patterns": [{"match": r"^(?P<n>\d+)\)", "filename": "p{n}", "title": "P {n}"}]}, "definitions": [{"form": "table", "file": "terms", "title": "Terms", "after-text": "Definitions", "skip-terms": ["Term"]}, {"form": "table", "file": "none", "first-cell": "absent"}]}
PDF = {"extract": {"engine": "pdf-layout", "drop": ["^Page"]}, "headings": [{"level": "h", "size": 16}], "units": {"key": ["n"], "patterns": [{"match": r"^(?P<n>\d+)\.", "filename": "c{n}", "title": "C {n}"}]}}
REGISTER = {"kind": "title-register", "title": "{heading} of {title_number}", "schedule-heading": "## Leases"}
OVERRIDES = {"descriptions": {3: "Third."}, "definitions": {"defined-elsewhere": [{"term": "fee", "unit": 2}, {"term": "gone", "unit": 9}]}}
TEXT = '<!-- page 1 -->\n**PART ONE**\n**Words**\n1. Here:\n"fee" means money.\n**Naming**\n2. See rule 3 about names and the many things that have to be said of them.\n3. Last, see rule 2.\n'


def word_file():
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    cell = lambda t: f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    rows = "".join(f"<w:tr>{cell(a)}{cell(b)}</w:tr>" for a, b in (("Term", "Meaning"), ("sun", "a star"), ("", "near us")))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {ns}><w:body><w:p><w:r><w:t>1) one</w:t></w:r></w:p><w:p><w:r><w:t>Definitions</w:t></w:r></w:p><w:tbl>{rows}</w:tbl></w:body></w:document>")
    return out.getvalue()


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = tmp_path_factory.mktemp("work")
    put = lambda path, text: ((top / path).parent.mkdir(parents=True, exist_ok=True), (top / path).write_bytes(text if isinstance(text, bytes) else text.encode()))
    pdf = b"the pdf"
    sha = hashlib.sha256(pdf).hexdigest()
    doc = lambda name, source, rules, **more: {"id": name, "source": f"sources/{source}", "parse-rules": f"rules/{rules}.yml", "bundle-path": f"docs/{name}", "concept-type": "clause", "description": f"The {name}"} | more
    docs = [
        doc("good", "good.pdf", "main", overrides="over.md", author="Me", resource="http://x"), doc("also", "gone.pdf", "main", overrides="over.md"), doc("stale", "old.pdf", "main"), doc("word", "w.docx", "tabled", status="stable"), doc("lines", "l.pdf", "pdf"),
        doc("title", "t.pdf", "register"), doc("homeless", "h.pdf", "main", **{"bundle-path": None}), {"id": "bare"}, {"id": "ruleless", "source": "sources/x.pdf"}, doc("norules", "x.pdf", "absent"), doc("noover", "x.pdf", "main", overrides="absent.md"),
        doc("nounits", "x.pdf", "empty"), doc("missing", "missing.pdf", "main"), doc("text", "x.txt", "main"), doc("notitle", "nowhere.pdf", "register"),
    ]
    put("config/manifest.yml", yaml.safe_dump({"bundle": {"title": "All", "description": "Every one.", "groups": {"docs": "Documents", "notes": "Notes"}}, "documents": docs, "legislation": [{"reference": "The Act (1999)", "description": "An act.", "resource": "http://act", "tags": ["a", "b"]}]}))
    for name, rules in (("main", RULES), ("tabled", TABLED), ("pdf", PDF), ("register", REGISTER), ("empty", {"headings": []})):
        put(f"config/rules/{name}.yml", yaml.safe_dump(rules))
    put("config/over.md", f"---\n{yaml.safe_dump(OVERRIDES)}---\nnotes on this\n")
    for name, recorded in (("good", sha), ("also", "any"), ("stale", "other"), ("homeless", "any")):
        put(f"transcripts/{name}.md", f"---\nsource: x\nsource-sha256: {recorded}\n---\n{TEXT}")
    put("sources/good.pdf", pdf)
    put("sources/old.pdf", pdf)
    put("sources/w.docx", word_file())
    put("sources/x.txt", "text")
    put("sources/t.pdf", b"t")
    put("authored/README.md", "about this folder")
    put("authored/notes/site.md", "---\ntype: note\ntitle: The site\npart: One\nsources:\n- id: survey\n---\n# The site\r\n\nSee [two](/docs/good/rule-02.md).\n\n## Plan\n\n![p](plan.png)\n\n## After\n\nText.\n")
    put("authored/notes/plan.png", b"\x89PNG\x00")
    return str(top)


@pytest.fixture(scope="module")
def work(spark, root):
    raw = spark.createDataFrame([("lines", 1, i, t, float(top), s, 1.0, 0.0) for i, (t, top, s) in enumerate([("Head", 0, 16.0), ("1. first", 30, 10.0), ("goes on", 42, 10.0), ("Page 1", 60, 10.0)])], "doc_id string, page int, ln int, text string, top double, size double, x0 double, bold_share double")
    word = lambda i, t, x, top, size=10.0: ("title", 1, i, t, float(x), x + 5.0, float(top), size, "f")
    words = spark.createDataFrame([word(0, "AB1", 10, 0), word(1, "A:", 10, 20, 16.0), word(2, "Property", 20, 20, 16.0), word(3, "Register", 60, 20, 16.0), word(4, "Land.", 10, 40), word(5, "Entry", 10, 60), word(6, "number", 40, 60), word(7, "1", 10, 80), word(8, "Text", 210, 80)], "doc_id string, page int, word_ix int, text string, x0 double, x1 double, top double, size double, fontname string")
    return Workspace.read(spark, root, raw=raw, words=words)


@pytest.fixture(scope="module")
def bundle(work):
    return bundle_build(work)


def test_every_document_is_built_or_explained(bundle):
    assert {r.doc_id: r.n for r in bundle.counts.collect()} == {"good": 3, "also": 3, "word": 3, "lines": 1, "title": 1}
    assert bundle.skipped == {
        "homeless": "no bundle-path in the manifest", "bare": "no source in the manifest", "ruleless": "no parse-rules in the manifest", "norules": "config/rules/absent.yml does not exist yet", "noover": "config/absent.md does not exist yet",
        "nounits": "config/rules/empty.yml has no 'units' section yet", "missing": "source not found: missing.pdf", "text": "no reader for .txt without a transcript", "notitle": "source not found: nowhere.pdf",
    }
    errors = sorted(r.message for r in bundle.errors.collect())
    assert [e.split(":")[0] for e in errors] == ["stale"] and "source-sha256 differs" in errors[0]
    said = {(r.doc_id, r.message) for r in bundle.warnings.collect()}
    assert {("good", "unit 3 has no heading"), ("good", "defined-elsewhere: 'fee' is already in the definitions clause"), ("good", "defined-elsewhere: 'fee' does not appear in unit 2"), ("good", "defined-elsewhere: unit 9 for 'gone' not found"), ("word", "none: no table found")} <= said


def test_files(bundle, work):
    files = {r.path: r.content if r.content is not None else bytes(r.bytes) for r in bundle.files.collect()}
    assert {p for p in files if "index" not in p} == {f"docs/{d}/{n}.md" for d, ns in {"good": ("words", "rule-02", "rule-03"), "also": ("words", "rule-02", "rule-03"), "word": ("terms", "none", "p01"), "lines": ("c01",), "title": ("a-property-register",)}.items() for n in ns} | {"notes/site.md", "notes/plan.png", "legislation/the-act-1999.md"}
    two = files["docs/good/rule-02.md"]
    head = yaml.safe_load(two.split("---\n")[1])
    assert list(head) == ["type", "title", "description", "resource", "part", "clause_number", "source_pages", "sources", "generated", "status"]
    assert head["title"] == "Rule 2 – Naming" and head["resource"] == "http://x" and head["sources"] == [{"id": "good", "title": "The good", "author": "Me", "resource": "http://x"}]
    assert two.endswith("# Rule 2 – Naming\n\nSee [rule 3](/docs/good/rule-03.md) about names and the many things that have to be said of them.\n")
    assert "## fee\n\n\"fee\" means money.\n\n## fee\n\nDefined in [2](/docs/good/rule-02.md)." in files["docs/good/words.md"]
    assert "description: Third.\n" in files["docs/also/rule-03.md"] and "status: stable" in files["docs/word/p01.md"]
    assert files["docs/word/terms.md"].endswith("# Terms\n\n## sun\n\na star\n\nnear us\n") and files["docs/word/none.md"].endswith("# Definitions\n")
    assert files["docs/lines/c01.md"].endswith("# C 1\n\nfirst goes on\n") and "title: 'A: Property Register of AB1'" in files["docs/title/a-property-register.md"]
    assert files["notes/plan.png"] == b"\x89PNG\x00" and "\r" not in files["notes/site.md"]
    act = yaml.safe_load(files["legislation/the-act-1999.md"].split("---\n")[1])
    assert (act["type"], act["title"], act["tags"], act["resource"]) == ("legislation", "The Act (1999)", ["a", "b"], "http://act")
    assert files["index.md"] == "---\nversion: '0.2'\ntitle: All\ndescription: Every one.\n---\n\n# All\n\n- [Documents](/docs/index.md)\n- [legislation](/legislation/index.md)\n- [Notes](/notes/index.md)\n\n<!-- Generated. Do not edit by hand. -->\n"
    assert "- [The also](/docs/also/index.md)\n- [The good](/docs/good/index.md)" in files["docs/index.md"]
    assert files["docs/good/index.md"].startswith("# The good\n\n## PART ONE\n\n- [Words](/docs/good/words.md)\n- [Rule 2 – Naming](/docs/good/rule-02.md): See rule 3")
    assert "## One\n\n- [The site](/notes/site.md)\n" in files["notes/index.md"]


def test_writing_twice_changes_nothing(spark, bundle, tmp_path):
    out, text = str(tmp_path / "out"), bundle.files.where("content is not null").select("path", "content")
    assert write_tree(text, out, "t1")["changed"] == 0
    assert write_tree(text, out, "t2") == {"added": 0, "changed": 0, "removed": 0}
    assert "  at: 't1'\n" in (tmp_path / "out/docs/good/rule-02.md").read_text() and "t2" not in (tmp_path / "out/log.md").read_text()


def test_single_files(work):
    made = single_build(work)
    files = {r.path: r.content for r in made.files.collect()}
    assert set(files) == {"good.md", "also.md", "homeless.md", "word.md", "lines.md", "title.md", "legislation.md", "notes.md"}
    assert files["good.md"].startswith("---\ntitle: The good\nsources:\n- id: good\n")
    assert [x for x in files["good.md"].split("\n") if x.startswith("<a id")] == ['<a id="words"></a>', '<a id="rule-02"></a>', '<a id="rule-03"></a>']
    assert "# Rule 2 – Naming\n\n- title: Rule 2 – Naming\n- description: See rule 3 about" in files["good.md"] and "See [rule 3](#rule-03)" in files["good.md"]
    assert files["notes.md"].startswith("---\ntitle: Notes\nsources:\n- id: survey\n") and files["notes.md"].endswith('# The site\n\n- title: The site\n\nSee [two](#rule-02).\n\n## After\n\nText.\n')
    assert files["legislation.md"].endswith("# The Act (1999)\n\n- title: The Act (1999)\n- description: An act.\n\nFull text: [legislation.gov.uk](http://act)\n")
    assert sorted(r.message.split(":")[0] for r in made.errors.collect()) == ["notes.md", "stale"]
    assert ("notes", "notes/site.md: left out ## Plan") in {(r.doc_id, r.message) for r in made.warnings.collect()}
    assert {r.doc_id: r.n for r in made.counts.collect()}["notes"] == 1


def test_same_path_twice(spark, work):
    from dataclasses import replace

    docs = [d | {"bundle-path": "docs/one"} for d in work.manifest["documents"] if d["id"] in ("good", "also")]
    made = bundle_build(replace(work, manifest={"documents": docs}))
    assert "two concepts would be written to docs/one/words.md" in {r.message for r in made.errors.collect()}


def test_redacted_copy_keeps_its_shape(spark, work):
    """The copy of a transcript has the same names, titles and places."""
    from dataclasses import replace

    from quillstack.operators.redact import defined_terms
    from quillstack.plans.build import assemble_all
    from quillstack.plans.rules import Redaction, keep_patterns
    from quillstack.sources.redacted import redacted_copies
    from quillstack.sources.transcripts import frontmatter
    from pyspark.sql import functions as F

    only = replace(work, manifest={"documents": [d for d in work.manifest["documents"] if d["id"] == "also"]})
    real = assemble_all(only).concepts
    copies = redacted_copies(work.sources, work.transcripts, {"also": Redaction("transcript")}, defined_terms(real), {"also": keep_patterns(RULES)})
    head, body = frontmatter(F.decode("content", "utf-8"))
    copied = replace(only, transcripts=copies.where("kind = 'transcript'").select("doc_id", head.alias("yaml"), body.alias("body")))
    again = assemble_all(copied).concepts
    assert checks.shape_diff(real, again).count() == 0 and concept_counts(again).first().n == 3
    assert {r["name"]: r["body"] for r in real.collect()} != {r["name"]: r["body"] for r in again.collect()}


def test_redacting_a_workspace(spark, work, tmp_path):
    from dataclasses import replace

    from quillstack.plans.redaction import differences, redact
    from quillstack.sources.transcripts import frontmatter
    from pyspark.sql import functions as F

    docs = [d for d in work.manifest["documents"] if d["id"] in ("good", "word", "lines")]
    only = replace(work, manifest={"documents": docs})
    made = redact(only, {"documents": {"good": {"method": "transcript"}, "word": {"method": "docx", "titles-after": ["^X"], "keep": [r"^\d+\)"]}}})  # such numbers are no numbering by themselves
    assert made.skipped == {"lines": "no redaction settings"}
    copies = {r.path: bytes(r.content) for r in made.copies.collect()}
    assert set(copies) == {"sources/good.pdf", "transcripts/good.md", "sources/w.docx"}
    head, body = frontmatter(F.decode("content", "utf-8"))
    transcripts = made.copies.where("path like 'transcripts/%'").select("doc_id", head.alias("yaml"), body.alias("body"))
    sources = made.copies.where("path like 'sources/%'").select("doc_id", F.substring_index("path", "/", -1).alias("name"), "content")
    copied = replace(only, transcripts=transcripts, sources=sources, raw=None)
    got = {(r.doc_id, r.problem) for r in differences(only, copied).collect()}
    assert got == {("lines", "source not found: l.pdf")}  # the new hash is recorded, names, titles and places are the same
    stale = replace(copied, sources=sources.withColumn("content", F.lit(b"other")).where("doc_id = 'good'"))
    assert {r.doc_id for r in differences(only, stale).collect()} == {"good", "word", "lines"}
