"""Scalar text functions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import strip

LINK = r"!?\[[^\]]*\]\(([^)\s]+)\)"
REFERENCE = r"\]\(ref:([^)\s]+)\)"
SNAKE = r"^[a-z][a-z0-9_]*$"
DASHES = " –-"


def slug(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))


def is_upper(text: Column) -> Column:
    """At least one letter, and no letter that isn't a capital."""
    return F.coalesce(text.rlike(r"\p{L}") & ~text.rlike(r"[\p{L}&&[^\p{Lu}]]"), F.lit(False))


def sentence_case(text: Column, acronyms: list[str] = ()) -> Column:
    out = F.lower(text)
    out = F.concat(F.upper(F.substring(out, 1, 1)), F.substring(out, 2, 1 << 30))
    for word in acronyms:
        out = F.regexp_replace(out, rf"(?iU)\b\Q{word}\E\b", word.replace("\\", "\\\\").replace("$", "\\$"))
    return out


def shown(text: Column, display_case: str | None, acronyms: list[str] = ()) -> Column:
    return F.when(is_upper(text), sentence_case(text, acronyms)).otherwise(text) if display_case == "sentence" else text


def title_case(text: Column) -> Column:
    """A capital after anything but a letter, small letters elsewhere."""
    def one(i: Column) -> Column:
        c = F.substr(text, i, F.lit(1))
        return F.when((i > 1) & F.substr(text, i - 1, F.lit(1)).rlike(r"\p{L}"), F.lower(c)).otherwise(F.upper(c))

    return F.when(F.length(text) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), one), "")).otherwise(F.lit(""))


def whole_number(text: Column) -> Column:
    """Digits without leading zeros; other text as it is."""
    return F.when(text.rlike("^[0-9]+$"), F.regexp_replace(text, "^0+(?=[0-9])", "")).otherwise(text)


def padded(text: Column) -> Column:
    """Digits to two places at least, so that names sort; longer numbers are never cut."""
    n = whole_number(text)
    return F.when(n.rlike("^[0-9]$"), F.concat(F.lit("0"), n)).otherwise(n)


def collapsed(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, SPACES_BOTH, ""), r"(?U)\s+", " ")


SPACES_BOTH = r"(?U)^\s+|\s+$"


def cut_at_word(text: Column, limit: int) -> Column:
    """The first limit-1 characters without the last, possibly partial, word, and an ellipsis."""
    head = F.substring(text, 1, limit - 1)
    return F.concat(F.when(head.contains(" "), F.regexp_replace(head, "(?s) [^ ]*$", "")).otherwise(head), F.lit("…"))


def sentence_of(text: Column, limit: int = 240) -> Column:
    """The text up to the first sentence end that is 60 characters in, or as much as fits."""
    head = F.regexp_extract(text, r"(?s)^(.{59,}?[.!?])(?U:\s)", 1)
    return F.when(head != "", head).when(F.length(text) <= limit, text).otherwise(cut_at_word(text, limit))


def first_sentence(lines: Column, limit: int = 240) -> Column:
    """Of an array of lines: bullets, headings and tables are passed over, short lines are a last resort."""
    real = F.filter(F.transform(lines, strip), lambda x: (x != "") & ~x.rlike("^[•#|]"))
    long = F.filter(real, lambda x: F.length(x) >= 40)
    return F.when(F.size(long) > 0, sentence_of(F.get(long, F.lit(0)), limit)).otherwise(F.get(real, F.lit(0)))


def resolved(target: Column, from_path: Column) -> Column:
    """Path that a link points at, from the top of the bundle; null for external and in-page links."""
    bare = F.regexp_extract(target, "(?s)^([^#]*)", 1)
    folder = F.regexp_extract(from_path, "(?s)^(.*)/[^/]*$", 1)
    joined = F.split(F.concat_ws("/", F.when(folder != "", folder), bare), "/")
    parts = F.aggregate(
        joined,
        F.array().cast("array<string>"),
        lambda s, x: F.when((x == "") | (x == "."), s)
        .when((x == "..") & (F.size(s) > 0) & (F.element_at(F.concat(F.array(F.lit("")), s), -1) != ".."), F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))))
        .otherwise(F.concat(s, F.array(x))),
    )
    path = F.array_join(parts, "/")
    return (
        F.when(target.rlike("(?i)^[a-z][a-z0-9+.-]*:") | target.startswith("#"), F.lit(None).cast("string"))
        .when(bare.startswith("/"), F.regexp_replace(bare, "^/+", ""))
        .otherwise(F.when(path == "", F.lit(".")).otherwise(path))
    )


def links_in(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(LINK), F.lit(1))


def without_stamp(text: Column) -> Column:
    """The content with every ``at:`` value blanked, for comparisons."""
    return F.regexp_replace(text, r"(?m)^(\s+at: ).*$", "$1X")


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def markdown_table(rows: Column) -> Column:
    """An array of rows of cells as a table: empty rows dropped, cells on one line, rows filled up."""
    full = F.filter(rows, lambda r: F.exists(r, lambda c: F.coalesce(c, F.lit("")) != ""))
    clean = F.transform(full, lambda r: F.transform(r, lambda c: F.replace(collapsed(F.coalesce(c, F.lit(""))), F.lit("|"), F.lit("\\|"))))

    def table(cells: Column, wide: Column) -> Column:
        filled = F.transform(cells, lambda r: F.concat(F.lit("| "), F.array_join(F.concat(r, F.array_repeat(F.lit(""), wide - F.size(r))), " | "), F.lit(" |")))
        rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), wide))
        return bound(filled, lambda text: F.array_join(F.concat(F.slice(text, 1, 1), F.array(rule), F.slice(text, F.lit(2), F.size(text))), "\n"))

    made = bound(clean, lambda cells: F.when(F.size(cells) > 0, bound(F.array_max(F.transform(cells, F.size)), lambda wide: table(cells, wide))))
    return F.coalesce(made, F.lit(""))
