"""What the corpus operators share: row keys, tables in the shared folder, partition counts.

A *row key* is (``doc_id``, ``rk``) where ``rk`` hashes id and text. Rows that agree on both are
copies of one row, get equal results and may be joined by that key without changing row counts;
null ids are ordinary values (joins are null-safe).
"""

from __future__ import annotations

import ctypes
import gc
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.barrier import held
from ..plans.shipping import ship  # noqa: F401  (for the operators)

SPACE = b" \t\n\r\x0b\x0c"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPIES, MOST_PARTITIONS = 1000, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Write a table to the shared folder and read it again.
written = held


def width(spark: SparkSession, df: DataFrame | None = None, per: int = 32 << 20) -> int:
    """Partitions for an exchange: the session's number, more if the input's files are large."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if df is not None:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size < 1 << 60:  # Spark's way to say that it does not know
            n = max(n, -(-size // per))
    return max(1, n)


def dealt(rows: DataFrame, groups: int) -> DataFrame:
    """Rows brought together by their group ``to`` (0 to groups - 1).

    With more groups than MOST_PARTITIONS, a task has several, one after the other, so groups keep their size.
    """
    n = min(groups, MOST_PARTITIONS)
    out = rows.repartitionById(n, F.pmod(F.col("to"), F.lit(n)).cast("int"))
    return out if groups == n else out.sortWithinPartitions("to")


def by_group(batches):
    """(group, its record batches) of rows sorted by ``to``."""
    to, held = None, []
    for batch in batches:
        own = batch.column("to").to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, own[1:] != own[:-1])), len(own)) if len(own) else []
        for s, e in zip(cuts, cuts[1:], strict=False):
            if own[s] != to:
                if held:
                    yield to, held
                to, held = int(own[s]), []
            held.append(batch.slice(s, e - s))
    if held:
        yield to, held


def crowded(rows: DataFrame, key: str) -> bool:
    """Does any value of the key (null too) stand in more than COPIES rows? Reads that column only."""
    return not rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > COPIES).isEmpty()


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with (copy, copies): one row stands for ``copies`` equal ones, the first of which has number ``copy``.

    Rows that agree in the keys are equal. Up to COPIES of them stay as they are; more become a row for each COPIES, so that they
    can be dealt to several tasks.
    """
    one = rows.withColumn("copy", F.lit(0).cast("long")).withColumn("copies", F.lit(1).cast("long"))
    if not crowded(rows, keys[0]):
        return one
    many = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > COPIES)
    many = written(many, "copies").withColumnsRenamed({k: f"_{k}" for k in keys})
    if many.isEmpty():
        return one
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    first = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long"))
    repeated = one.join(many, same).dropDuplicates(list(keys)).withColumn("copy", F.explode(first))
    repeated = repeated.withColumn("copies", F.least(F.col("_n") - F.col("copy"), F.lit(COPIES))).select(*one.columns)
    return one.join(many, same, "left_anti").unionByName(repeated)


_user: list = ["", lambda: None]


def take_over(name: str, forget=lambda: None) -> None:
    """A worker process serves one operator after another: what the one before keeps goes when another starts."""
    if _user[0] != name:
        _user[1]()
        gc.collect()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)
    _user[:] = name, forget


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, rk): only the columns needed, whatever else the table holds."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("rk", F.xxhash64("doc_id", "text"))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return (a["rk"] == b["rk"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def lower_ascii(c: Column) -> Column:
    """A-Z only. On ASCII text that is ``lower``, which is much faster than ``translate``."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def raw(batch: pa.RecordBatch | pa.Table, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(name).cast(pa.binary()).to_pylist()


@contextmanager
def batches_of(spark: SparkSession, rows: int = 1000):
    """Python workers get so many rows at once for what is run inside: texts are held in small lots on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def parts(batches, rows: int = 500):
    """Batches in smaller ones, so that only a part of the texts is held as Python objects."""
    for batch in batches:
        for s in range(0, batch.num_rows, rows):
            yield batch.slice(s, rows)


def slices(texts: list[bytes | None], most: int = 2_000_000):
    """Runs (from, to) of texts of about ``most`` bytes, so that working memory is bounded."""
    at, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or b"") + 64
        if held >= most:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
