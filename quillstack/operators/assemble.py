"""Units to concepts: names, titles, descriptions, merged groups, definitions and cross-references."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import template
from ..functions.text import DASHES, first_sentence, padded, slug
from ..plans.barrier import held
from ..plans.rules import Overrides, Rules
from .definitions import split_definitions
from .segments import Parsed, empty_map

PAGES = "source_pages"
POSITION = "array<struct<k:string,v:string,kind:string>>"
CONCEPT = ("doc_id", "seq", "name", "title", "body", "description", "status", "type", "position", "ord", "resource", "tags")


def key_of(value: object) -> str:
    return str(value).lower()


def lookup(values: dict, key: Column, default: Column) -> Column:
    """A small driver-side mapping as an expression."""
    table = [x for k, v in values.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*table), key), default) if table else default


def item(name: str, value: Column, kind: str) -> Column:
    """kind: str, num (digits are numbers in YAML), list, nums or raw."""
    return F.struct(F.lit(name).alias("k"), value.cast("string").alias("v"), F.lit(kind).alias("kind"))


def listed(values: Column) -> Column:
    """A list kept in one string; numbers and clause numbers hold no line breaks."""
    return F.array_join(values.cast("array<string>"), "\n")


@dataclass
class Assembled:
    concepts: DataFrame
    targets: DataFrame
    diagnostics: DataFrame


class Assembler:
    """One rule file with its overrides over the documents that follow it."""

    def __init__(self, parsed: Parsed, rules: Rules, overrides: Overrides | None = None, status: str = "draft", tables: dict[str, DataFrame] | None = None):
        """tables: rows of definition tables (doc_id, def_idx, term, row, text) by the definitions' file."""
        self.parsed, self.rules, self.over, self.status, self.tables = parsed, rules, overrides or Overrides(), status, tables or {}
        self._maps: DataFrame | None = None
        last = Window.partitionBy("doc_id", "key")
        # Of units that share a key the last one counts, in the place of the first.
        units = parsed.units.withColumn("_last", F.max("idx").over(last)).withColumn("_place", F.min("idx").over(last)).where("idx = _last")
        self.units = held(units.withColumn("name", self.by_pattern(lambda p: template(p.filename, lambda n: padded(F.try_element_at("fields", F.lit(n)))))))
        self.texts = held(parsed.unit_lines.join(self.units.select("doc_id", "idx", "key", "name"), ["doc_id", "idx"]))

    def by_pattern(self, made, default: Column | None = None) -> Column:
        out = F.lit(None) if default is None else default
        for i, p in reversed(list(enumerate(self.rules.patterns))):
            value = made(p)
            if value is not None:
                out = F.when(F.col("pattern_id") == i, value).otherwise(out)
        return out

    # ---- cross-references
    def targets(self) -> DataFrame:
        """(doc_id, key, name): the concept that each unit ends up in; groups win over definitions, those over units."""
        moved = {key_of(d["unit"]): d["file"] for d in self.rules.definitions if d.get("unit") is not None}
        moved |= {key_of(u): g["file"] for g in self.over.groups for u in g["units"]}
        known = self.units.select("doc_id", "key", lookup(moved, F.col("key"), F.col("name")).alias("name"))
        if not moved:
            return known
        # Overrides may also name keys that the document lacks.
        extra = known.select("doc_id").distinct().select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("name")) for k, v in moved.items()])).alias("m")).select("doc_id", "m.key", "m.name")
        return known.unionByName(extra.join(known, ["doc_id", "key"], "left_anti"))

    def linked(self, text: Column, targets: Column, current: Column) -> Column:
        """References replaced by links, one pattern after the other over the text so far."""
        for pattern, key in self.rules.references:
            found = self.references(text, pattern, key, targets, current)
            gaps = F.split(text, pattern.anywhere, -1)
            text = F.when(text.rlike(pattern.anywhere), F.array_join(F.zip_with(gaps, found, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")).otherwise(text)
        return text

    def references(self, text: Column, pattern, key: str | None, targets: Column, current: Column) -> Column:
        """Each match as it should read: a link if its key is known and leads elsewhere."""
        rx, names = F.lit(pattern.anywhere), dict(pattern.names)
        parts = [F.regexp_extract_all(text, rx, F.lit(i)).alias(n) for n, i in names.items()]

        def shown(m: Column) -> Column:
            part = lambda n: F.trim(m[n]) if n in names else F.lit("")
            made = F.lower(template(key, part)) if key else F.array_join(F.array(*[F.lower(part(f)) for f in self.rules.key]), ".")
            goal = F.try_element_at(targets, F.regexp_replace(made, "[.]+$", ""))
            return F.when(goal.isNull() | (goal == current), m["whole"]).otherwise(F.concat(F.lit("["), m["whole"], F.lit("](ref:"), goal, F.lit(")")))

        return F.transform(F.arrays_zip(F.regexp_extract_all(text, rx, F.lit(0)).alias("whole"), *parts), shown)

    def rendered(self, text: Column = None) -> Column:
        """A line's markdown: body headings by size or pattern, else bold."""
        text = F.col("text")
        out = F.when(F.col("bold"), F.concat(F.lit("**"), text, F.lit("**"))).otherwise(text)
        for pattern, size, mark in reversed(self.rules.body_headings):
            test = F.lit(True) if size is None else F.coalesce(F.col("size") == size, F.lit(False))
            out = F.when(test & (pattern.matches(text) if pattern else F.lit(True)), F.concat(F.lit(mark + " "), text)).otherwise(out)
        return out

    def target_maps(self) -> DataFrame:
        return self.targets().groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "name"))).alias("_targets"))

    def with_links(self, lines: DataFrame, raw: bool = False) -> DataFrame:
        """Adds ``md``: each line rendered and linked; lines(doc_id, name, text, bold, size)."""
        text = F.col("text") if raw else self.rendered()
        if not self.rules.references:
            return lines.withColumn("md", text)
        if self._maps is None:
            self._maps = held(self.target_maps())
        return lines.join(self._maps, "doc_id", "left").withColumn("md", self.linked(text, F.coalesce("_targets", empty_map()), F.col("name"))).drop("_targets")

    # ---- parts
    def description(self, key: Column, lines: Column | None = None) -> Column:
        auto = first_sentence(lines) if lines is not None and self.rules.describe == "first-sentence" else F.lit(None).cast("string")
        return lookup({k: v for k, v in self.over.descriptions.items() if v}, key, auto)

    def status_of(self, key: Column) -> Column:
        return lookup(self.over.status, key, F.lit(self.status))

    def heading(self) -> Column:
        own = F.try_element_at("headings", F.lit(self.rules.heading_level)) if self.rules.heading_level else F.lit(None).cast("string")
        return lookup({k: v for k, v in self.over.headings.items() if v}, F.col("key"), own)

    def place(self) -> list[Column]:
        return [item(f, F.try_element_at("headings", F.lit(f)), "str") for f in self.rules.fields]

    def position(self) -> Column:
        fields = self.by_pattern(lambda p: F.lit(p.number_field) if p.number_field else None, F.lit(self.rules.number_field))
        number = F.struct(fields.alias("k"), F.col("number").alias("v"), F.lit("num").alias("kind"))
        return F.array(*self.place(), number, item(PAGES, listed(F.col("pages")), "nums"))

    def plain_units(self) -> DataFrame:
        used = [key_of(d["unit"]) for d in self.rules.definitions if d.get("unit") is not None] + [key_of(u) for g in self.over.groups for u in g["units"]]
        units = self.units.where(~F.col("key").isin(used)) if used else self.units
        lines = held(self.with_links(self.texts)).groupBy("doc_id", "idx").agg(F.array_sort(F.collect_list(F.struct("pos", "text", "md"))).alias("l"))
        # Units that have units of their own: their key is a proper prefix of another one's.
        parts = F.split("key", "[.]")
        prefixes = self.units.select("doc_id", F.explode(F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), ".")))).alias("key")).distinct().withColumn("_split", F.lit(True))
        units = units.join(lines, ["doc_id", "idx"], "left").join(prefixes, ["doc_id", "key"], "left")
        heading = F.coalesce(self.heading(), F.lit(""))
        value = lambda n: heading if n == "heading" else F.try_element_at("fields", F.lit(n))

        def title(p):
            plain, full = template(p.plain_title or p.title, value), template(p.title, value)
            out = F.when(heading != "", full).otherwise(plain)
            return F.when(F.coalesce("_split", F.lit(False)), template(p.split_title, value)).otherwise(out) if p.split_title else out

        texts = F.transform(F.coalesce("l", F.array().cast("array<struct<pos:int,text:string,md:string>>")), lambda x: x["text"])
        body = F.array_join(F.transform(F.coalesce("l", F.array().cast("array<struct<pos:int,text:string,md:string>>")), lambda x: x["md"]), "\n\n")
        return units.select(
            "doc_id", F.col("_place").cast("long").alias("_rank"), "name", F.btrim(self.by_pattern(title), F.lit(DASHES)).alias("title"), F.array(body).alias("body"), self.description(F.col("key"), texts).alias("description"),
            self.status_of(F.col("key")).alias("status"), F.lit(None).cast("string").alias("type"), self.position().alias("position"), F.col("idx").cast("int").alias("ord"),
        )

    def group(self, g: dict, rank: int) -> DataFrame:
        """Units merged in document order; each one's sub-heading stands before its first line."""
        members = {key_of(k): n for n, k in enumerate(g["units"])}
        own = self.units.where(F.col("key").isin(list(members))).withColumn("n", lookup(members, F.col("key"), F.lit(-1)))
        plain = lambda p: template(p.group_heading if p.group_heading is not None else (p.plain_title or p.title), lambda n: F.lit("") if n == "heading" else F.try_element_at("fields", F.lit(n)))
        head = own.select("doc_id", "idx", "n", F.btrim(self.by_pattern(plain), F.lit(DASHES)).alias("head"))
        lines = self.texts.drop("name").join(head, ["doc_id", "idx"]).withColumn("name", F.lit(g["file"]))
        if g.get("include-front-matter"):
            lines = lines.unionByName(self.parsed.front.join(own.select("doc_id").distinct(), "doc_id", "left_semi").withColumns({"idx": F.lit(-1), "key": F.lit(""), "n": F.lit(-1), "head": F.lit(""), "name": F.lit(g["file"])}))
        lines = held(self.with_links(lines))
        order = Window.partitionBy("doc_id").orderBy(F.col("n") >= 0, "pos", "n")
        lines = lines.withColumn("_turn", F.sum((~F.col("n").eqNullSafe(F.lag("n").over(order))).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        lines = lines.withColumn("_first", (F.row_number().over(Window.partitionBy("doc_id", "n").orderBy("pos")) == 1) & (F.col("head") != "") & (F.col("n") >= 0))
        blocks = lines.groupBy("doc_id", "_turn").agg(F.array_sort(F.collect_list(F.struct("pos", "md"))).alias("l"), F.max(F.when(F.col("_first"), F.col("head"))).alias("head"))
        made = F.concat(F.when(F.col("head").isNotNull(), F.array(F.concat(F.lit("## "), "head"))).otherwise(F.array().cast("array<string>")), F.array(F.array_join(F.transform("l", lambda x: x["md"]), "\n\n")))
        body = blocks.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_turn", made.alias("b")))), lambda x: x["b"])).alias("body"))
        pages = lines.groupBy("doc_id").agg(F.sort_array(F.collect_set("page")).alias("pages"))
        meta = own.groupBy("doc_id").agg(F.min_by("headings", "n").alias("headings"), F.transform(F.array_sort(F.collect_list(F.struct("n", "number"))), lambda x: x["number"]).alias("numbers"), F.min("idx").alias("ord"))
        file = F.lit(g["file"])
        return meta.join(body, "doc_id", "left").join(pages, "doc_id", "left").select(
            "doc_id", F.lit(rank).cast("long").alias("_rank"), file.alias("name"), F.lit(g["title"]).alias("title"), F.coalesce("body", F.array().cast("array<string>")).alias("body"), self.description(file).alias("description"), self.status_of(file).alias("status"),
            F.lit(g.get("type")).cast("string").alias("type"), F.array(*self.place(), item(self.rules.numbers_field, listed(F.col("numbers")), "nums"), item(PAGES, listed(F.col("pages")), "nums")).alias("position"), F.coalesce("ord", F.lit(0)).cast("int").alias("ord"),
        )

    def definitions(self, d: dict, rank: int, rows: DataFrame | None = None) -> DataFrame:
        """A definitions concept from its unit, or from rows(doc_id, def_idx, term, row, text) of a table."""
        file = F.lit(d["file"])
        if rows is None:
            own = self.units.where(F.col("key") == key_of(d.get("unit")))
            lines = self.texts.join(own.select("doc_id", "idx"), ["doc_id", "idx"], "left_semi").withColumn("name", file)
            lines = held(self.with_links(held(split_definitions(lines, d["term"], d.get("ends-at"))), raw=True))
            docs = own.select("doc_id", self.position().alias("position"))
        else:
            lines = self.with_links(rows.where("text is not null").select("doc_id", "def_idx", "term", F.col("row").alias("pos"), "text", F.lit("def").alias("zone")).withColumn("name", file), raw=True)
            # A document without the table still has the concept.
            docs = rows.select("doc_id").unionByName(self.units.select("doc_id")).distinct().withColumn("position", F.array().cast(POSITION))
        blocks = lines.groupBy("doc_id", "zone", "def_idx").agg(F.max("term").alias("term"), F.array_sort(F.collect_list(F.struct("pos", "md"))).alias("l"))
        if rows is not None:  # terms without text still have a heading
            blocks = rows.groupBy("doc_id", "def_idx").agg(F.max("term").alias("term")).join(blocks.drop("term"), ["doc_id", "def_idx"], "left").withColumn("zone", F.lit("def"))
        text = F.array_join(F.transform(F.coalesce("l", F.array().cast("array<struct<pos:int,md:string>>")), lambda x: x["md"]), "\n\n")
        notes = self.over.definitions.get("notes-heading")
        head = F.when(F.col("zone") == "def", F.array(F.concat(F.lit("## "), "term")))
        if notes:
            head = head.when(F.col("zone") == "notes", F.array(F.lit(f"## {notes}")))
        made = F.concat(head.otherwise(F.array().cast("array<string>")), F.array(text))
        zone = F.when(F.col("zone") == "intro", 0).when(F.col("zone") == "def", 1).otherwise(2)
        body = blocks.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(zone.alias("z"), F.coalesce("def_idx", F.lit(0)).alias("i"), made.alias("b")))), lambda x: x["b"])).alias("body"))
        out = docs.join(body, "doc_id", "left").withColumn("body", F.coalesce("body", F.array().cast("array<string>")))
        if extra := self.over.definitions.get("defined-elsewhere"):
            out = out.join(self.target_maps(), "doc_id", "left")
            for e in extra:
                goal = F.try_element_at("_targets", F.lit(key_of(e["unit"])))
                out = out.withColumn("body", F.when(goal.isNotNull(), F.concat("body", F.array(F.lit(f"## {e['term']}"), F.concat(F.lit(f"Defined in [{e.get('ref', e['unit'])}](ref:"), goal, F.lit(")."))))).otherwise(F.col("body")))
        return out.select("doc_id", F.lit(rank).cast("long").alias("_rank"), file.alias("name"), F.lit(d.get("title", "Definitions")).alias("title"), "body", self.description(file).alias("description"), self.status_of(file).alias("status"), F.lit(d.get("type")).cast("string").alias("type"), "position", F.lit(-1).alias("ord"))

    # ---- all
    def diagnostics(self) -> DataFrame:
        """Warnings of the parse, of overrides that name no unit, and of concepts without a description or heading."""
        said = [self.parsed.diagnostics.select("doc_id", "stage", "message")]
        docs = self.units.select("doc_id").distinct()
        keyed = lambda rows: docs.select("doc_id", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(m).alias("message")) for k, m in rows])).alias("x")).select("doc_id", "x.key", "x.message")
        missing = [(key_of(k), f"heading override for unit {k}, which doesn't exist") for k in self.over.headings]
        missing += [(key_of(u), f"group {g['file']}: unit {u} not found") for g in self.over.groups for u in g["units"]]
        missing += [(key_of(d["unit"]), f"definitions unit {d['unit']} not found") for d in self.rules.definitions if d.get("unit") is not None and d.get("form") != "table"]
        if missing:
            said.append(keyed(missing).join(self.units, ["doc_id", "key"], "left_anti").select("doc_id", F.lit("assemble").alias("stage"), "message"))
        tables = [(d["file"], f"{d['file']}: no table found") for d in self.rules.definitions if d["file"] in self.tables]
        for file, message in tables:
            said.append(docs.join(self.tables[file], "doc_id", "left_anti").select("doc_id", F.lit("assemble").alias("stage"), F.lit(message).alias("message")))
        bare = [i for i, p in enumerate(self.rules.patterns) if p.plain_title is None and "{heading}" in p.title]
        if bare:
            used = [key_of(d["unit"]) for d in self.rules.definitions if d.get("unit") is not None] + [key_of(u) for g in self.over.groups for u in g["units"]]
            own = self.units.where(F.col("pattern_id").isin(bare) & ~F.col("key").isin(used or [""]) & (F.coalesce(self.heading(), F.lit("")) == ""))
            said.append(own.select("doc_id", F.lit("assemble").alias("stage"), F.concat(F.lit("unit "), "key", F.lit(" has no heading")).alias("message")))
        extra = self.over.definitions.get("defined-elsewhere") or []
        if extra:
            for d in self.rules.definitions:
                if d.get("unit") is None and d["file"] not in self.tables:
                    continue
                if d["file"] in self.tables:
                    known = self.tables[d["file"]].select("doc_id", F.lower("term").alias("term")).distinct()
                else:
                    own = self.units.where(F.col("key") == key_of(d["unit"])).select("doc_id", "idx")
                    known = split_definitions(self.texts.join(own, ["doc_id", "idx"], "left_semi"), d["term"], d.get("ends-at")).where("term is not null").select("doc_id", F.lower("term").alias("term")).distinct()
                twice = keyed([(e["term"].lower(), f"defined-elsewhere: {e['term']!r} is already in the definitions clause") for e in extra]).withColumnRenamed("key", "term")
                said.append(twice.join(known, ["doc_id", "term"], "left_semi").select("doc_id", F.lit("assemble").alias("stage"), "message"))
            lost = [(key_of(e["unit"]), f"defined-elsewhere: unit {e['unit']} for {e['term']!r} not found") for e in extra]
            said.append(keyed(lost).join(self.targets(), ["doc_id", "key"], "left_anti").select("doc_id", F.lit("assemble").alias("stage"), "message"))
            words = self.texts.groupBy("doc_id", "key").agg(F.lower(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ")).alias("all"))
            for e in extra:
                own = words.where((F.col("key") == key_of(e["unit"])) & ~F.col("all").contains(e["term"].lower()))
                said.append(own.select("doc_id", F.lit("assemble").alias("stage"), F.lit(f"defined-elsewhere: {e['term']!r} does not appear in unit {e['unit']}").alias("message")))
        blank = self.assembled().where(F.coalesce("description", F.lit("")) == "").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.slice(F.transform(F.array_sort(F.collect_list(F.struct("seq", "name"))), lambda x: x["name"]), 1, 5).alias("first"))
        said.append(blank.select("doc_id", F.lit("assemble").alias("stage"), F.concat("n", F.lit(" concepts have no description (first: "), F.array_join("first", ", "), F.lit(")")).alias("message")))
        return reduce(DataFrame.unionByName, said)

    def assembled(self) -> DataFrame:
        """All concepts; seq: definitions, then groups, then the units that are left."""
        parts, rank = [], -1_000_000
        for d in self.rules.definitions:
            rows = self.tables.get(d["file"])
            if d.get("form") == "table" and rows is None:
                continue
            parts.append(self.definitions(d, rank, rows))
            rank += 1
        for g in self.over.groups:
            parts.append(self.group(g, rank))
            rank += 1
        every = reduce(DataFrame.unionByName, [*parts, self.plain_units()])
        seq = F.row_number().over(Window.partitionBy("doc_id").orderBy("_rank")) - 1
        return every.withColumn("seq", seq).withColumn("resource", F.lit(None).cast("string")).withColumn("tags", F.lit(None).cast("array<string>")).select(*CONCEPT)


def legislation(spark, items: list[dict]) -> DataFrame:
    """Reference concepts straight from the manifest."""
    rows = []
    for i, x in enumerate(items):
        body = [x["description"]] if x.get("description") else []
        body += [f"Full text: [legislation.gov.uk]({x['resource']})"] if x.get("resource") else []
        rows.append(("legislation", i, x["reference"], x["reference"], body, x.get("description"), x.get("status", "draft"), "legislation", [], None, x.get("resource"), x.get("tags")))
    schema = f"doc_id string, seq int, name string, title string, body array<string>, description string, status string, type string, position {POSITION}, ord int, resource string, tags array<string>"
    return spark.createDataFrame(rows, schema).withColumn("name", slug(F.col("name")))
