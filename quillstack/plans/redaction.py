"""Redacted copies of a workspace's documents, and the check that they keep the shape of the real ones."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import shape_diff
from ..operators.redact import defined_terms
from ..sources.redacted import redacted_copies
from .build import Workspace, assemble_all
from .rules import Redaction, keep_patterns


@dataclass
class Redacted:
    """copies(doc_id, path, content) under the paths that the real files have; why other documents have none."""

    copies: DataFrame
    skipped: dict[str, str]


def redact(ws: Workspace, settings: dict, only: list[str] | None = None) -> Redacted:
    """Copies of the manifest's documents by their settings (``documents``: id to method, keep, titles-after).

    What the rules look for in a text and the terms that its concepts define stay. Documents without settings are skipped.
    """
    listed, docs = settings.get("documents") or {}, {d["id"]: d for d in ws.documents if not only or d["id"] in only}
    chosen = {d: Redaction.of(listed[d]) for d in docs if listed.get(d)}
    skipped = {d: "no redaction settings" for d in docs if d not in chosen}
    patterns = {d: keep_patterns(ws.rules.get(docs[d].get("parse-rules"), {})) for d in chosen}
    terms = defined_terms(assemble_all(ws).concepts)
    made = redacted_copies(ws.sources, ws.transcripts, chosen, terms, patterns)
    paths = ws.spark.createDataFrame([(d, docs[d].get("source")) for d in chosen], "doc_id string, source string")
    path = F.when(F.col("kind") == "transcript", F.concat(F.lit("transcripts/"), "doc_id", F.lit(".md"))).otherwise(F.col("source"))
    return Redacted(made.join(paths, "doc_id").select("doc_id", path.alias("path"), "content"), skipped)


def differences(real: Workspace, copied: Workspace) -> DataFrame:
    """(doc_id, problem): documents that the copy does not build, and concepts that are missing, extra or changed in title or place."""
    a, b = assemble_all(real), assemble_all(copied)
    lost = {d: why for d, why in b.skipped.items() if d not in a.skipped}
    rows = [*lost.items(), *(tuple(e.split(": ", 1)) for e in b.errors if e not in a.errors)]
    unread = real.spark.createDataFrame(rows, "doc_id string, problem string")
    changed = shape_diff(a.concepts, b.concepts).join(unread.select("doc_id"), "doc_id", "left_anti")
    return unread.unionByName(changed.select("doc_id", F.concat("name", F.lit(": "), "problem").alias("problem")))
