"""Definitions from clauses and from two-column tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.patterns import Pattern
from ..functions.text import collapsed

RUN = (Window.unboundedPreceding, Window.currentRow)


def split_definitions(lines: DataFrame, term: str, ends_at: str | None = None, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Lines(…, pos, text) with ``zone`` (intro, def, notes), ``def_idx`` and ``term``.

    A term's line opens its definition and is its first line; the first line after a term that matches
    ``ends_at`` opens the notes, for good.
    """
    term_rx, end_rx = Pattern.of(term), Pattern.of(ends_at) if ends_at else None
    order = Window.partitionBy(*by).orderBy("pos")
    text = F.col("text")
    out = lines.withColumn("_is", term_rx.matches(text))
    before = F.coalesce(F.max(F.col("_is").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    stop = before & end_rx.matches(text) if end_rx else F.lit(False)
    out = out.withColumn("_stop", stop).withColumn("_notes", F.max(F.col("_stop").cast("int")).over(order.rowsBetween(*RUN)) == 1)
    out = out.withColumn("_start", F.col("_is") & ~F.col("_notes"))
    out = out.withColumn("def_idx", F.sum(F.col("_start").cast("int")).over(order.rowsBetween(*RUN)))
    named = F.last(F.when(F.col("_start"), term_rx.group(text, "term")), ignorenulls=True).over(order.rowsBetween(*RUN))
    zone = F.when(F.col("_notes"), "notes").when(F.col("def_idx") > 0, "def").otherwise("intro")
    out = out.withColumn("zone", zone).withColumn("term", F.when(zone == "def", named))
    return out.withColumn("def_idx", F.when(F.col("zone") == "def", F.col("def_idx")).cast("int")).drop("_is", "_stop", "_notes", "_start")


def table_definitions(rows: DataFrame, skip_terms: list[str] = (), term_cell: str | None = None) -> DataFrame:
    """rows(doc_id, row, cells) -> (doc_id, def_idx, term, row, text): an empty term continues the one above.

    Skipped terms and empty rows go first, so what follows them continues the last kept term.
    """
    cell = lambda i: collapsed(F.coalesce(F.get("cells", F.lit(i)), F.lit("")))
    term = cell(0)
    if term_cell:
        p = Pattern.of(term_cell)
        term = F.when(p.matches(term), p.group(term, "term")).otherwise(term)
    out = rows.select("doc_id", "row", term.alias("_t"), cell(1).alias("text")).where("_t != '' or text != ''")
    if skip_terms:
        out = out.where(~F.lower("_t").isin([t.strip().lower() for t in skip_terms]))
    order = Window.partitionBy("doc_id").orderBy("row").rowsBetween(*RUN)
    out = out.withColumn("def_idx", F.sum((F.col("_t") != "").cast("int")).over(order).cast("int")).withColumn("term", F.last(F.when(F.col("_t") != "", F.col("_t")), ignorenulls=True).over(order))
    return out.where("def_idx > 0").select("doc_id", "def_idx", "term", "row", F.when((F.col("_t") != "") & (F.col("text") == ""), F.lit(None)).otherwise(F.col("text")).alias("text"))
