"""Rule patterns (Python regular expressions) as Java ones, and templates, compiled to columns."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Groups that mean the same in both dialects.
SHARED = ("(?:", "(?=", "(?!", "(?<=", "(?<!", "(?>")
INLINE = re.compile(r"\(\?[aimsx]+(?:-[imsx]+)?[:)]")
PLACE = re.compile(r"\{(\w+)\}")
SPACES = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, "")


@dataclass(frozen=True)
class Pattern:
    """A translated pattern; ``names`` are the numbers of its named groups."""

    java: str
    names: tuple[tuple[str, int], ...]

    @classmethod
    def of(cls, source: str) -> Pattern:
        out, names, groups, at, in_class = [], {}, 0, 0, False
        while at < len(source):
            rest = source[at:]
            if rest[0] == "\\":
                out.append(r"\z" if rest[:2] == r"\Z" else rest[:2])
                at += 2
                continue
            if in_class:
                in_class = rest[0] != "]"
                out.append("\\[" if rest[0] == "[" else "\\&" if rest[0] == "&" else rest[0])  # Java nests classes
            elif rest[0] == "[":
                in_class = True
                head = re.match(r"\[\^?\]?", rest)[0]
                out.append(head.replace("]", "\\]"))
                at += len(head)
                continue
            elif m := re.match(r"\(\?P<(\w+)>", rest):
                groups += 1
                names[m[1]] = groups
                out.append("(")
                at += len(m[0])
                continue
            elif m := re.match(r"\(\?P=(\w+)\)", rest):
                out.append(f"(?:\\{names[m[1]]})")
                at += len(m[0])
                continue
            elif rest.startswith("(?"):
                head = next((s for s in SHARED if rest.startswith(s)), None) or (m[0] if (m := INLINE.match(rest)) else None)
                if head is None:
                    raise ValueError(f"no Java form for {rest[:6]!r} in {source!r}")
                out.append(head.replace("a", ""))
                at += len(head)
                continue
            else:
                groups += rest[0] == "("
                out.append(rest[0])
            at += 1
        return cls("".join(out), tuple(names.items()))

    @property
    def at_start(self) -> str:
        return f"(?U)^(?:{self.java})"

    @property
    def anywhere(self) -> str:
        return f"(?U)(?:{self.java})"

    def matches(self, text: Column) -> Column:
        return F.coalesce(text.rlike(self.at_start), F.lit(False))

    def found_in(self, text: Column) -> Column:
        return F.coalesce(text.rlike(self.anywhere), F.lit(False))

    def whole(self, text: Column) -> Column:
        return F.regexp_extract(text, self.at_start, 0)

    def group(self, text: Column, name: str) -> Column:
        """A named part, stripped; empty if the pattern has no such part or it took none."""
        number = dict(self.names).get(name)
        return F.lit("") if number is None else strip(F.regexp_extract(text, self.at_start, number))


def template(text: str, value: Callable[[str], Column]) -> Column:
    """``{name}`` parts filled in; a missing value is empty."""
    parts, at = [], 0
    for m in PLACE.finditer(text):
        parts += [F.lit(text[at : m.start()]), F.coalesce(value(m[1]), F.lit(""))]
        at = m.end()
    return F.concat(*parts, F.lit(text[at:]))


def from_map(fields: Column) -> Callable[[str], Column]:
    return lambda name: F.try_element_at(fields, F.lit(name))
