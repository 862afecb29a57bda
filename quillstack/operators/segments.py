"""Lines to headings to units: classification, heading state and segmentation as window plans.

All windows share one partitioning and order, so a plan has one exchange and one sort by (doc_id, pos).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import from_map, strip, template
from ..functions.text import is_upper, shown, slug, title_case, whole_number
from ..plans.barrier import held
from ..plans.rules import HeadingRule, Rules

LINES = "doc_id string, pos int, text string, bold boolean, page int, size int, x0 double, style string"
HEADING = "struct<level:string,value:string,fields:map<string,string>,consumed:int>"

def by():
    return Window.partitionBy("doc_id").orderBy("pos")


def so_far():
    return by().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before():
    return by().rowsBetween(Window.unboundedPreceding, -1)


def doc():
    return Window.partitionBy("doc_id")


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def fits(rule: HeadingRule) -> Column:
    """Does a line have the rule's style? Unset attributes fit any line."""
    tests = [F.lit(True)]
    for name in ("bold", "size", "style"):
        if (wanted := getattr(rule, name)) is not None:
            tests.append(F.coalesce(F.col(name) == wanted, F.lit(False)))
    if rule.max_words:
        words = F.when(strip(F.col("text")) == "", 0).otherwise(F.size(F.split(strip(F.col("text")), r"(?U)\s+")))
        tests.append(words < rule.max_words)
    if rule.case:
        tests.append(is_upper(F.col("text")) if rule.case == "upper" else ~is_upper(F.col("text")))
    return reduce(Column.__and__, tests)


def next_fits(rule: HeadingRule) -> Column:
    if rule.next_line is True:
        return F.coalesce(F.col("_next.bold"), F.lit(False))
    if not rule.next_line:
        return F.lit(False)
    known = ("text", "bold", "page", "size", "x0", "style")
    tests = [F.col("_next").isNotNull()]
    for key, wanted in rule.next_line:
        name = key.replace("-", "_")
        tests.append(F.col(f"_next.{name}").eqNullSafe(F.lit(wanted)) if name in known else F.lit(wanted is None))
    return reduce(Column.__and__, tests)


def classified(lines: DataFrame, rules: Rules) -> DataFrame:
    """Adds ``heading``, the heading that each line would start, from the first rule that fits."""
    text = F.col("text")
    show = lambda x: shown(x, rules.display_case, rules.acronyms)
    found = None
    for rule in rules.headings:
        if not rule.patterns:
            cases = [(fits(rule), F.struct(F.lit(rule.level), show(text), empty_map(), F.lit(0)))]
        else:
            cases = []
            for pattern, display in rule.patterns:
                parts = {name: pattern.group(text, name) for name, _ in pattern.names}
                title = parts.get("title", F.lit(""))
                taken = F.lit(False)
                if rule.next_line:
                    taken = (title == "") & next_fits(rule)
                    title = F.when(taken, F.col("_next.text")).otherwise(title)
                if "title" in parts or rule.next_line:
                    parts["title"] = F.when(title != "", show(title)).otherwise(F.lit(""))
                value = show(text)
                if display:
                    filled = template(display, lambda n, parts=parts: parts.get(n.removesuffix("_lower").removesuffix("_title")) if n in parts else F.lower(parts[n[:-6]]) if n[:-6] in parts else title_case(parts[n[:-6]]) if n[:-6] in parts else F.lit(""))
                    value = F.when(filled != "", strip(F.rtrim(strip(filled), F.lit(" –-")))).otherwise(value)
                pairs = [x for n, v in parts.items() for x in (F.lit(n), v)]
                pairs += [x for n, v in parts.items() for form, made in (("_lower", F.lower), ("_title", title_case)) if form in rules.variants for x in (F.lit(n + form), made(v))]
                fields = F.create_map(*pairs) if pairs else empty_map()
                cases.append((fits(rule) & pattern.matches(text), F.struct(F.lit(rule.level), value, fields, taken.cast("int"))))
        for test, made in cases:
            made = made.cast(HEADING)
            found = F.when(test, made) if found is None else found.when(test, made)
    ahead = F.lead(F.struct("text", "bold", "page", "size", "x0", "style")).over(by())
    return lines.withColumn("_next", ahead).withColumn("heading", found if found is not None else F.lit(None).cast(HEADING)).drop("_next")


def zoned(lines: DataFrame, rules: Rules) -> DataFrame:
    """Classified lines with ``zone`` (front, body, skipped, back) and ``heading`` only where one is in force."""
    out = classified(lines, rules)
    if rules.front_ends:
        first = F.min(F.when(F.col("heading.level") == rules.front_ends, F.col("pos"))).over(doc())
        out = out.withColumn("_body", F.coalesce(F.col("pos") >= first, F.lit(False))).withColumn("_ends", first.isNotNull())
    else:
        out = out.withColumn("_body", F.lit(True)).withColumn("_ends", F.lit(True))
    # A heading may use up the next line, which then isn't looked at: in runs of such headings every other one counts.
    takes = F.col("_body") & (F.coalesce(F.col("heading.consumed"), F.lit(0)) > 0)
    out = held(out.withColumn("_rank", F.row_number().over(by())).withColumn("_takes", takes))
    out = out.withColumn("_free", F.coalesce(F.last(F.when(~F.col("_takes"), F.col("_rank")), ignorenulls=True).over(so_far()), F.lit(0)))
    live = F.col("_takes") & ((F.col("_rank") - F.col("_free")) % 2 == 1)
    out = out.withColumn("_live", live).withColumn("_skipped", F.coalesce(F.lag("_live").over(by()), F.lit(False)))
    if rules.back_starts:
        back = F.min(F.when(~F.col("_skipped") & rules.back_starts.matches(F.col("text")), F.col("pos"))).over(doc())
        ended = F.coalesce(F.col("pos") >= back, F.lit(False))
    else:
        ended = F.lit(False)
    zone = F.when(ended, "back").when(~F.col("_body"), "front").when(F.col("_skipped"), "skipped").otherwise("body")
    out = out.withColumn("zone", zone)
    return out.withColumn("heading", F.when(F.col("zone") == "body", F.col("heading"))).drop("_body", "_rank", "_takes", "_free", "_live", "_skipped")


def state_columns(rules: Rules) -> dict[str, Column]:
    """For each level the heading last seen (pos, value, fields); a higher one since then clears it."""
    last = {v: F.last(F.when(F.col("heading.level") == v, F.struct(F.col("pos").alias("at"), F.col("heading.value").alias("value"), F.col("heading.fields").alias("fields"))), ignorenulls=True).over(so_far()) for v in rules.levels}
    return {f"_last{i}": c for i, c in enumerate(last.values())}


def in_force(rules: Rules, i: int) -> Column:
    """The heading of level i unless a higher level was set after it."""
    own = F.col(f"_last{i}")
    above = [F.coalesce(F.col(f"_last{j}.at"), F.lit(-1)) for j in range(i)]
    return F.when(own["at"] > F.greatest(*above) if len(above) > 1 else own["at"] > above[0], own) if above else own


def flattened(level: str, fields: Column, rules: Rules) -> Column:
    """A heading's parts as seen by a unit below it: ``level_part``, and small letters of each."""
    plain = F.transform_keys(fields, lambda k, x: F.concat(F.lit(level + "_"), k))
    if "_lower" not in rules.variants:
        return plain
    small = F.map_filter(F.transform_values(plain, lambda k, x: F.lower(x)), lambda k, x: ~k.rlike("_(lower|title)$"))
    small = F.transform_keys(small, lambda k, x: F.concat(k, F.lit("_lower")))
    return F.map_concat(F.map_filter(plain, lambda k, x: ~F.map_contains_key(small, k)), small)


@dataclass
class Parsed:
    """units(doc_id, idx, key, pattern_id, fields, headings, number, pages), unit_lines(doc_id, idx, pos, ...),
    front(doc_id, pos, ...), diagnostics(doc_id, stage, pos, message)."""

    units: DataFrame
    unit_lines: DataFrame
    front: DataFrame
    diagnostics: DataFrame


def events(lines: DataFrame, rules: Rules) -> DataFrame:
    """Every body line with the state in force, its part in a unit, and the keys of units that start."""
    out = held(zoned(lines, rules)).withColumns(state_columns(rules))
    levels = rules.levels
    at = {v: i for i, v in enumerate(levels)}
    out = out.withColumns({f"_now{i}": in_force(rules, i) for i in range(len(levels))})
    body = (F.col("zone") == "body") & F.col("heading").isNull()
    value = lambda v: F.col(f"_now{at[v]}.value") if v in at else F.lit(None).cast("string")
    given = lambda v: F.coalesce(value(v) != "", F.lit(False))

    start = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(rules.starts))):
        test = body & p.match.matches(F.col("text"))
        if rules.unit_size is not None:
            test &= F.coalesce(F.col("size") == rules.unit_size, F.lit(False))
        if p.requires:
            test &= given(p.requires)
        if p.unless:
            test &= ~given(p.unless)
        start = F.when(test, F.lit(i)).otherwise(start)
    out = out.withColumn("start", start)
    event = F.when(F.col("heading").isNotNull() | F.col("start").isNotNull(), F.struct("pos", "start"))
    out = out.withColumn("_event", F.last(event, ignorenulls=True).over(so_far()))
    broken = F.lit(False)
    for i, p in enumerate(rules.starts):
        if p.continues is not None:
            broken |= (F.col("_event.start") == i) & (F.col("pos") > F.col("_event.pos")) & ~F.coalesce(F.col("style").isin(*p.continues), F.lit(False))
    out = out.withColumn("_broken", F.last(F.when(body & F.coalesce(broken, F.lit(False)), F.col("pos")), ignorenulls=True).over(so_far()))
    member = body & F.col("_event.start").isNotNull() & ~F.coalesce(F.col("_broken") > F.col("_event.pos"), F.lit(False))
    loose = body & ~member
    fallback = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(rules.fallbacks, len(rules.starts)))):
        fallback = F.when(given(p.level) & (p.when.matches(value(p.level)) if p.when else F.lit(True)), F.lit(i)).otherwise(fallback)
    out = out.withColumn("fallback", F.when(loose, fallback)).withColumn("member", member).withColumn("loose", loose)
    # A unit takes the state at its start, or at the first loose line after a heading or the end of a unit.
    prior = F.lag(F.struct("fallback", F.col("_event.pos").alias("e"))).over(by())
    first = F.col("fallback").isNotNull() & ~F.coalesce(prior["fallback"].eqNullSafe(F.col("fallback")) & (prior["e"].eqNullSafe(F.col("_event.pos"))), F.lit(False))
    out = out.withColumn("_takes", F.col("start").isNotNull() | first)
    out = out.withColumn("_taken", F.last(F.when(F.col("_takes"), F.col("pos")), ignorenulls=True).over(before()))
    for v in rules.brief_levels:
        now = F.col(f"_now{at[v]}")
        out = out.withColumn(f"_now{at[v]}", F.when(now["at"] > F.coalesce(F.col("_taken"), F.lit(-1)), now))

    headings = F.create_map(*[x for v in levels for x in (F.lit(v), value(v))]) if levels else empty_map()
    above = empty_map()
    for i, v in enumerate(levels):
        above = F.map_concat(above, flattened(v, F.coalesce(F.col(f"_now{i}.fields"), empty_map()), rules))
    own = empty_map()
    for i, p in reversed(list(enumerate(rules.starts))):
        pairs = []
        for name, _ in p.match.names:
            part = whole_number(p.match.group(F.col("text"), name))
            pairs += [F.lit(name), part]
            if "_lower" in rules.variants:
                pairs += [F.lit(name + "_lower"), F.when(~part.rlike("^[0-9]+$"), F.lower(part))]
        own = F.when(F.col("start") == i, F.create_map(*pairs) if pairs else empty_map()).otherwise(own)
    for i, p in enumerate(rules.fallbacks, len(rules.starts)):
        own = F.when(F.col("fallback") == i, F.create_map(F.lit(p.level), value(p.level), F.lit("slug"), slug(value(p.level)))).otherwise(own)
    out = out.withColumn("headings", headings).withColumn("_above", above).withColumn("_own", F.map_filter(own, lambda k, x: x.isNotNull()))
    merged = F.map_concat(F.map_filter("_above", lambda k, x: ~F.map_contains_key("_own", k)), "_own")
    out = out.withColumn("fields", F.when(F.col("start").isNotNull() | F.col("fallback").isNotNull(), merged))
    key = F.lit(None).cast("string")
    for i, p in reversed(list(enumerate(rules.patterns))):
        plain = F.array_join(F.array(*[F.coalesce(F.try_element_at("_own", F.lit(f)), F.lit("")) for f in rules.key]), ".") if i < len(rules.starts) else F.try_element_at("_own", F.lit("slug"))
        made = template(p.key, from_map(F.col("fields"))) if p.key else plain
        key = F.when(F.coalesce(F.col("start"), F.col("fallback")) == i, F.lower(made)).otherwise(key)
    return out.withColumn("key", key)


def parse_units(lines: DataFrame, rules: Rules) -> Parsed:
    e = held(events(lines, rules))
    starts = e.where(F.col("start").isNotNull()).select("doc_id", F.col("pos").alias("at"), "key", F.col("start").alias("pattern_id"), "fields", "headings")
    loose = e.where(F.col("fallback").isNotNull())
    first = loose.groupBy("doc_id", "key").agg(F.min_by(F.struct(F.col("pos").alias("at"), F.col("fallback").alias("pattern_id"), "fields", "headings"), "pos").alias("u"))
    # A fallback's text joins the earliest unit of its key, which may have started by a pattern.
    owner = starts.groupBy("doc_id", "key").agg(F.min("at").alias("pattern_at"))
    first = first.join(owner, ["doc_id", "key"], "left")
    own = first.where(F.coalesce(F.col("pattern_at") > F.col("u.at"), F.lit(True))).select("doc_id", F.col("u.at").alias("at"), "key", F.col("u.pattern_id").alias("pattern_id"), F.col("u.fields").alias("fields"), F.col("u.headings").alias("headings"))
    places = first.select("doc_id", "key", F.least("pattern_at", "u.at").alias("at"))

    columns = ("text", "bold", "page", "size", "x0", "style")
    rest = F.lit("")
    for i, p in reversed(list(enumerate(rules.starts))):
        rest = F.when(F.col("start") == i, strip(F.substr(F.col("text"), F.length(p.match.whole(F.col("text"))) + 1, F.length("text")))).otherwise(rest)
    heads = e.where(F.col("start").isNotNull()).select("doc_id", F.col("pos").alias("at"), "pos", rest.alias("text"), "bold", "page", "size", "x0", F.lit(None).cast("string").alias("style")).where("text != ''")
    members = e.where(F.col("member") & F.col("start").isNull()).select("doc_id", F.col("_event.pos").alias("at"), "pos", *columns)
    added = loose.select("doc_id", "key", "pos", *columns).join(places, ["doc_id", "key"]).select("doc_id", "at", "pos", *columns)
    number = F.array_join(F.split("key", "[.]"), ".")
    for i, p in reversed(list(enumerate(rules.patterns))):
        if p.number is not None:
            number = F.when(F.col("pattern_id") == i, template(p.number, from_map(F.col("fields")))).otherwise(number)
    units = starts.unionByName(own).withColumn("idx", F.row_number().over(Window.partitionBy("doc_id").orderBy("at")) - 1).withColumn("number", number)
    unit_lines = heads.unionByName(members).unionByName(added).join(units.select("doc_id", "at", "idx"), ["doc_id", "at"]).select("doc_id", "idx", "pos", *columns)
    pages = unit_lines.groupBy("doc_id", "idx").agg(F.sort_array(F.collect_set("page")).alias("pages"))
    units = units.join(pages, ["doc_id", "idx"], "left").select("doc_id", "idx", "at", "key", "pattern_id", "fields", "headings", "number", F.coalesce("pages", F.array().cast("array<int>")).alias("pages"))

    said = [
        e.where(F.col("loose") & F.col("fallback").isNull()).select(
            "doc_id", F.lit("segment").alias("stage"), "pos",
            F.when(reduce(Column.__or__, [F.coalesce(F.col(f"_now{i}.value") != "", F.lit(False)) for i, v in enumerate(rules.levels) if v in {f.level for f in rules.fallbacks}], F.lit(False)), F.concat(F.lit("page "), F.coalesce(F.col("page").cast("string"), F.lit("None")), F.lit(": no fallback matches the current headings")))
            .otherwise(F.concat(F.lit("page "), F.coalesce(F.col("page").cast("string"), F.lit("None")), F.lit(": text outside any unit: "), F.left("text", F.lit(60)))).alias("message"),
        ),
        units.withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("idx"))).where("n > 1").select("doc_id", F.lit("segment").alias("stage"), F.col("at").alias("pos"), F.concat(F.lit("two units share the key "), "key").alias("message")),
    ]
    if rules.front_ends:
        said.append(e.where(~F.col("_ends")).groupBy("doc_id").agg(F.max("pos").alias("pos")).select("doc_id", F.lit("segment").alias("stage"), "pos", F.lit(f"no '{rules.front_ends}' heading found; everything was treated as front matter").alias("message")))
    return Parsed(held(units), held(unit_lines), e.where("zone = 'front'").select("doc_id", "pos", *columns), reduce(DataFrame.unionByName, said))
