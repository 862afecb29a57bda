"""Media columns: payloads as progressive JPEG files in a binary column, and tensors read from them.

Null text is an empty payload. Every payload has one block of 64 bytes at least. Equal texts have equal
files and features. Rows keep their ids, repeated or null. ``read_payloads`` computes features from tensors as
it decodes them; ``store_tensors`` keeps them (about 3.3 times the size of the documents' Parquet files).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, raw, ship, slices, written
from .jpeg import encode, payload, tensors

UNIT = 64


def padded(text: bytes | None) -> bytes:
    t = text or b""
    return t + bytes(-len(t) % UNIT if t else UNIT)


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, rk, media): every text as a JPEG file, written to the shared folder."""
    ship(docs.sparkSession)
    rows = keyed(docs)

    def run(batches):
        for batch in batches:
            texts = raw(batch, "text")
            for a, b in slices(texts, 1_000_000):
                media = encode([(padded(t), len(t or b"")) for t in texts[a:b]])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], batch.column("rk")[a:b], pa.array(media, pa.binary())], ["doc_id", "rk", "media"])

    return written(rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, rk long, media binary"), "media", codec="zstd")


def read_payloads(media: DataFrame, with_tensor: bool = False) -> DataFrame:
    """Payloads and features of stored files; ``tensor``: height x width x 3 bytes, row by row."""
    ship(media.sparkSession)
    kind = media.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            files = raw(batch, "media")
            for a, b in slices(files, 1_000_000):
                rows = []
                for (im, coef, tensor), file in zip(tensors(files[a:b]), files[a:b], strict=True):
                    n, data = payload(im, coef)
                    sums = tensor.sum((0, 1), dtype=np.int64)
                    rows.append((n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-UNIT:]), len(file), hashlib.sha256(file).hexdigest(), f"{im.width}x{im.height} " + ",".join(str(x) for x in sums), *((tensor.tobytes(),) if with_tensor else ())))
                cols = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), *([pa.binary()] if with_tensor else [])]
                names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", *(["tensor"] if with_tensor else [])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], batch.column("rk")[a:b], *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", "rk", *names])

    return media.mapInArrow(run, f"doc_id {kind}, rk long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + ", tensor binary" * with_tensor)


def store_tensors(media: DataFrame) -> DataFrame:
    """(doc_id, rk, height, width, tensor): full-resolution RGB tensors, written to the shared folder."""
    size = F.split(F.split("feature", " ")[0], "x")
    return written(read_payloads(media, with_tensor=True).select("doc_id", "rk", size[1].cast("int").alias("height"), size[0].cast("int").alias("width"), "tensor"), "tensors", codec="zstd")
