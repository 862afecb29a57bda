"""Line dedup with two Bloom filters.

One pass over the texts writes signatures: for every slice of documents the distinct line keys of each, as
64-bit hash and SHA-256, with their line numbers. Hashes are asked about in buckets of about ``PER_BUCKET``
lines, so that there are more buckets, never fuller ones, for more lines. A bucket folds its hashes into two
Bloom filters in packed bits, *once* and *twice*: a hash whose bits are all in *once* already goes to
*twice*. A bitmap of the hashes that *twice* may hold goes back to each slice. Only these suspects are
shuffled, as SHA-256 of their key, and counted exactly.

A question is a row for each slice and bucket that has a hash in it: no more rows than hashes. A line that a
third of all documents share is one hash a slice.

Null or empty text is one empty line. Empty keys are never dropped. Repeated rows count as documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, batches_of, keyed, parts, raw, same_row, ship, slices, take_over, width, written

BITS_PER_LINE, HASHES, PER_BUCKET, SLICE = 12, 4, 200_000, 8_000_000
U = np.uint64


def keys_of(text: bytes | None) -> list[bytes]:
    return [x.strip(SPACE).lower() for x in (text or b"").split(b"\n")]


class Bloom:
    """A Bloom filter in 64-bit words."""

    def __init__(self, lines: int, bits_per_line: float = BITS_PER_LINE):
        self.words = np.zeros(max(1, int(lines * bits_per_line) // 64 + 1), U)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """(n, HASHES) bit numbers."""
        step = (hashes >> U(31)) | U(1)
        return (hashes[:, None] + step[:, None] * np.arange(HASHES, dtype=U)) % U(64 * len(self.words))

    def add(self, hashes: np.ndarray) -> None:
        at = np.unique(self.places(hashes))
        if len(at):
            word, bit = (at >> U(6)).astype(np.int64), U(1) << (at & U(63))
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            self.words[word[first]] |= np.bitwise_or.reduceat(bit, first)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes)
        return (self.words[(at >> U(6)).astype(np.int64)] >> (at & U(63)) & U(1)).all(1)


def suspected(packs: list[np.ndarray], again: list[np.ndarray], bits_per_line: float = BITS_PER_LINE) -> list[np.ndarray]:
    """For packs of distinct hashes, with those that their slice has more than once: which may be repeats?"""
    n = sum(map(len, packs))
    once, twice = Bloom(n, bits_per_line), Bloom(n, bits_per_line)
    for hashes, many in zip(packs, again, strict=True):
        twice.add(hashes[many | once.has(hashes)])
        once.add(hashes)
    return [twice.has(hashes) for hashes in packs]


def in_buckets(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets that occur, where each begins in sorted order, the order of the hashes by bucket)."""
    bucket = ((hashes >> U(40)) % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return found, np.append(first, len(hashes)), order


def signatures(rows: DataFrame, min_chars: int) -> DataFrame:
    """One row a slice: its documents, and for each document and distinct key its hash, SHA-256 and line numbers."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        take_over("line_dedup")
        part, number = TaskContext.get().partitionId(), 0
        for batch in parts(batches, 2000):
            texts, names, rks = raw(batch, "text"), batch.column("doc_id"), batch.column("rk")
            for a, b in slices(texts, SLICE):
                doc, keys, lines = [], [], []
                for d, t in enumerate(texts[a:b]):
                    own: dict[bytes, list[int]] = {}
                    for i, k in enumerate(keys_of(t)):
                        own.setdefault(k, []).append(i)
                    for k, at in own.items():
                        if len(k) >= min_chars and (min_chars < 2 or len(k.decode()) >= min_chars):
                            doc.append(d)
                            keys.append(k)
                            lines.append(at)
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), U, len(keys))
                number += 1
                yield pa.RecordBatch.from_pydict({
                    "src": pa.array([(part << 32) + number], pa.int64()), "n": pa.array([len(np.unique(hashes))], pa.int64()),
                    "doc_id": pa.array([names[a:b].to_pylist()], pa.list_(names.type)), "rk": pa.array([rks[a:b].to_pylist()], pa.list_(pa.int64())),
                    "hashes": pa.array([hashes.tobytes()], pa.binary()), "sha": pa.array([b"".join(hashlib.sha256(k).digest() for k in keys)], pa.binary()),
                    "doc": pa.array([np.array(doc, np.int32).tobytes()], pa.binary()), "count": pa.array([np.array(list(map(len, lines)), np.int32).tobytes()], pa.binary()),
                    "line": pa.array([np.array([i for at in lines for i in at], np.int32).tobytes()], pa.binary()),
                })

    return rows.mapInArrow(run, f"src long, n long, doc_id array<{kind}>, rk array<long>, hashes binary, sha binary, doc binary, count binary, line binary")


def repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, per_bucket: int = PER_BUCKET) -> DataFrame:
    """(doc_id, rk, lines array<int>): positions of the lines whose key is in ``min_docs`` documents, a row for each different row."""
    ship(docs.sparkSession)
    rows = keyed(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    with batches_of(docs.sparkSession, 5000):
        signed = written(signatures(rows, min_chars), "line-signatures")
    total = signed.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // per_bucket))

    def ask(batches):
        for batch in batches:
            for src, data in zip(batch.column("src").to_pylist(), batch.column("hashes").to_pylist(), strict=True):
                hashes, times = np.unique(np.frombuffer(data, U), return_counts=True)
                found, first, order = in_buckets(hashes, buckets)
                hashes, many = hashes[order], times[order] > 1
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(found, pa.int64()), "src": pa.array([src] * len(found), pa.int64()),
                    "hashes": pa.array([hashes[s:e].tobytes() for s, e in zip(first, first[1:], strict=False)], pa.binary()),
                    "many": pa.array([np.packbits(many[s:e]).tobytes() for s, e in zip(first, first[1:], strict=False)], pa.binary()),
                })

    def answer(batches):
        asked: dict[int, list] = {}
        for batch in batches:
            for bucket, *q in zip(*(batch.column(c).to_pylist() for c in ("bucket", "src", "hashes", "many")), strict=True):
                asked.setdefault(bucket, []).append(q)
        for bucket, qs in asked.items():
            qs.sort(key=lambda q: q[0])
            packs = [np.frombuffer(q[1], U) for q in qs]
            bits = suspected(packs, [np.unpackbits(np.frombuffer(q[2], np.uint8), count=len(p)).view(bool) for q, p in zip(qs, packs, strict=True)])
            hit = [i for i, b in enumerate(bits) if b.any()]
            yield pa.RecordBatch.from_pydict({"src": pa.array([qs[i][0] for i in hit], pa.int64()), "bucket": pa.array([bucket] * len(hit), pa.int64()), "bits": pa.array([np.packbits(bits[i]).tobytes() for i in hit], pa.binary())})

    def suspects(batches):
        for batch in batches:
            for r in batch.to_pylist():
                hashes = np.frombuffer(r["hashes"], U)
                names = np.unique(hashes)
                found, first, order = in_buckets(names, buckets)
                at, told = {k: i for i, k in enumerate(found.tolist())}, np.zeros(len(names), bool)
                for x in r["told"]:
                    i = at[x["bucket"]]
                    told[first[i] : first[i + 1]] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=first[i + 1] - first[i])
                again = np.zeros(len(names), bool)
                again[order] = told
                pick = np.flatnonzero(again[np.searchsorted(names, hashes)])
                doc, line = np.frombuffer(r["doc"], np.int32)[pick], np.frombuffer(r["line"], np.int32)
                ends = np.cumsum(np.frombuffer(r["count"], np.int32))
                starts = ends - np.frombuffer(r["count"], np.int32)
                for s in range(0, len(pick), 20_000):
                    own, d = pick[s : s + 20_000].tolist(), doc[s : s + 20_000].tolist()
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([r["sha"][32 * k : 32 * k + 32] for k in own], pa.binary()), "doc_id": pa.array([r["doc_id"][i] for i in d], batch.schema.field("doc_id").type.value_type),
                        "rk": pa.array([r["rk"][i] for i in d], pa.int64()), "lines": pa.array([line[starts[k] : ends[k]] for k in own], pa.list_(pa.int32())),
                    })

    asked = signed.select("src", "hashes").mapInArrow(ask, "bucket long, src long, hashes binary, many binary")
    told = asked.repartition(min(buckets, width(docs.sparkSession, docs)), "bucket").mapInArrow(answer, "src long, bucket long, bits binary")
    told = written(told, "line-answers").groupBy("src").agg(F.collect_list(F.struct("bucket", "bits")).alias("told"))  # buckets of one slice
    found = signed.join(told, "src").drop("src", "n").mapInArrow(suspects, f"key binary, doc_id {kind}, rk long, lines array<int>")
    found = written(found, "line-suspects")
    hot = written(found.groupBy("key").count().where(F.col("count") >= min_docs).select("key"), "line-keys")
    # Copies of a row have the same lines: one row for each of them and key goes on.
    once = found.join(hot, "key").dropDuplicates(["doc_id", "rk", "key"])
    return once.groupBy("doc_id", "rk").agg(F.flatten(F.collect_list("lines")).alias("lines"))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256, kept): each text without the lines of frequent keys."""
    rows = keyed(docs)
    drops = repeated_lines(docs, min_docs, min_chars)
    # The lists are small beside the texts; written first, so that their size is known to the join.
    drops = written(drops, "line-drops")
    joined = rows.join(drops, same_row(rows, drops), "left").select(rows["doc_id"], rows["text"], drops["lines"])
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        take_over("line_dedup")
        for batch in parts(batches):
            texts, lines = raw(batch, "text"), batch.column("lines").to_pylist()
            n, gone, kept = [], [], []
            for t, drop in zip(texts, lines, strict=True):
                t = t or b""
                n.append(t.count(b"\n") + 1)
                gone.append(len(drop or ()))
                if drop:
                    out = set(drop)
                    t = b"\n".join(x for i, x in enumerate(t.split(b"\n")) if i not in out)
                kept.append(t)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_lines": pa.array(n, pa.int64()), "n_dropped": pa.array(gone, pa.int64()), "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in kept], pa.string()), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return joined.mapInArrow(cut, f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string, kept string")
