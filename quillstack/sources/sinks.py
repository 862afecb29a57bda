"""Build results as files: a tree of concept files with a log of changes."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.checks import change_counts, retained, tree_diff
from ..operators.render import STAMP
from ..plans.barrier import held
from .transcripts import read_tree

LOG = "log.md"


def old_tree(files: DataFrame, folder: str) -> DataFrame:
    """(path, content, bytes) of what the folder holds now, without the log."""
    root = Path(folder)
    if not root.exists() or not any(p.is_file() for p in root.rglob("*")):
        return files.sparkSession.createDataFrame([], "path string, content string, bytes binary")
    return read_tree(files.sparkSession, folder).where(F.col("path") != LOG).select("path", F.col("text").alias("content"), "bytes")


def put(folder: str):
    """Writes rows (path, content, bytes), each under a name of its own first: a task that runs twice leaves the same files."""

    def run(rows) -> None:
        for r in rows:
            target = os.path.join(folder, r["path"])
            os.makedirs(os.path.dirname(target), exist_ok=True)
            own = f"{target}.{os.getpid()}.tmp"
            with open(own, "wb") as f:
                f.write(r["content"].encode() if r["content"] is not None else bytes(r["bytes"]))
            os.replace(own, target)

    return run


def drop(folder: str):
    def run(rows) -> None:
        for r in rows:
            Path(folder, r["path"]).unlink(missing_ok=True)

    return run


def write_tree(files: DataFrame, folder: str, now: str) -> dict[str, int]:
    """Write files(path, content[, bytes]) under a folder that all tasks share, keeping old time stamps of unchanged files.

    Returns the counts of added, changed and removed files and appends them to ``log.md`` if there are any. What will be
    written and what changes is settled in tables first, so a lost executor never reads the tree that is being written.
    """
    none = F.lit(None).cast("binary").alias("bytes")
    new = files.select("path", "content", "bytes" if "bytes" in files.columns else none)
    was = old_tree(files, folder)
    texts = retained(new.where("content is not null").select("path", "content"), was.where("content is not null").select("path", "content"), now, STAMP)
    made = held(texts.select("path", "content", none).unionByName(new.where("content is null")), "tree")
    whole = lambda df: df.select("path", F.coalesce(F.encode("content", "utf-8"), "bytes").alias("content"))
    diff = held(tree_diff(whole(made), whole(was)), "tree-changes")
    counts = {k: 0 for k in ("added", "changed", "removed")} | {r["change"]: r["count"] for r in change_counts(diff).collect()}
    made.join(diff.where("change <> 'removed'").select("path"), "path", "left_semi").foreachPartition(put(folder))
    diff.where("change = 'removed'").select("path").foreachPartition(drop(folder))
    if any(counts.values()):
        log = Path(folder, LOG)
        log.parent.mkdir(parents=True, exist_ok=True)
        text = log.read_text(encoding="utf-8").rstrip() if log.exists() else "# Build log"
        log.write_text(f"{text}\n\n## {now}\n\n" + ", ".join(f"{v} {k}" for k, v in counts.items()) + "\n", encoding="utf-8", newline="\n")
    return counts
