"""Incremental builds: new transcripts arrive as a stream, each micro-batch goes through the batch operators.

A document lies whole in one file, so it lies whole in one micro-batch, and results equal a batch build's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.segments import parse_units
from ..plans.rules import Rules
from ..sources.transcripts import frontmatter, transcript_lines


def transcript_stream(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, yaml, body) of transcript files as they appear under a path."""
    files = spark.readStream.schema("value string").option("wholetext", "true").format("text").load(path)
    yaml_text, body = frontmatter(F.col("value"))
    return files.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.md)?$", 1).alias("doc_id"), yaml_text.alias("yaml"), body.alias("body"))


def build_units(stream: DataFrame, rules: Rules, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Parse each micro-batch of transcripts to units and hand them to ``sink(units, batch_id)``."""
    def batch(bodies: DataFrame, batch_id: int) -> None:
        sink(parse_units(transcript_lines(bodies.select("doc_id", "body")), rules).units, batch_id)
        bodies.sparkSession.catalog.clearCache()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stale_concepts(concepts: DataFrame, today: str | None = None) -> DataFrame:
    """Concepts past ``stale_after`` or never verified: (path, reason) of concepts(path, stale_after, verified)."""
    now = F.to_date(F.lit(today)) if today else F.current_date()
    reason = F.when(F.try_to_timestamp("stale_after").cast("date") < now, "stale").when(F.col("verified").isNull(), "not verified")
    return concepts.select("path", reason.alias("reason")).where("reason is not null")
