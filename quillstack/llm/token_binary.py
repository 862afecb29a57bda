"""Token-ID / binary output with patched frame-of-reference blocks.

Documents are dealt by ranges of doc_id, sorted, tokenised and written as shard files. A shard
holds whole documents: a document table, an index of block starts, and blocks of 128 ids. A block
keeps its minimum, packs the differences at the width that holds ``PERCENTILE`` of them, and lists
the rest as exceptions (position, high bits). Shards are rows of a Parquet table in the shared
folder, so any store that Spark can write serves.

Null text: no ids but the end id. Null doc_id sorts first. Rows with equal doc_id are ordered by a
hash of their text, so that ranges can part them; thousands of copies of one row are dealt to several tasks.
An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, crowded, parts, raw, ship, slices, spread, take_over, width, written

BLOCK, PERCENTILE, END_ID = 128, 0.9, 2
SHARD_TOKENS = 1 << 20
CACHE_WORDS = 250_000
MAGIC = b"QPFR"


# ---------------------------------------------------------------- blocks
def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Block offsets (one more than blocks) and the packed bytes of uint32 ids."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(1, np.uint64), b""
    full = np.full(n * BLOCK, ids[-1], np.uint32)
    full[: len(ids)] = ids
    full = full.reshape(n, BLOCK)
    low = full.min(1)
    diff = full - low[:, None]
    at = min(BLOCK - 1, int(np.ceil(PERCENTILE * BLOCK)) - 1)
    bits = np.ceil(np.log2(np.partition(diff, at, axis=1)[:, at].astype(np.float64) + 1)).astype(np.int64)
    over = (diff.astype(np.uint64) >> bits[:, None].astype(np.uint64)).astype(np.uint32)
    late = over > 0
    n_late = late.sum(1)
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(6 + BLOCK // 8 * bits + 5 * n_late, out=offsets[1:])
    out = np.zeros(offsets[-1], np.uint8)
    head = np.zeros((n, 6), np.uint8)
    head[:, :4] = low.astype("<u4").view(np.uint8).reshape(n, 4)
    head[:, 4], head[:, 5] = bits, n_late
    out[offsets[:-1, None] + np.arange(6)] = head
    for w in np.unique(bits):
        if w:
            every = np.flatnonzero(bits == w)
            for s in range(0, len(every), 2048):
                own = every[s : s + 2048]
                grid = np.unpackbits(diff[own].astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :w]
                out[offsets[own][:, None] + 6 + np.arange(BLOCK // 8 * w)] = np.packbits(grid.reshape(len(own), -1), axis=1, bitorder="little")
    if late.any():
        row, col = np.nonzero(late)
        first = np.zeros(n, np.int64)
        np.cumsum(n_late[:-1], out=first[1:])
        k = np.arange(len(row)) - first[row]
        base = offsets[row] + 6 + BLOCK // 8 * bits[row]
        out[base + k] = col
        high = over[row, col].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(base + n_late[row] + 4 * k)[:, None] + np.arange(4)] = high
    return offsets.astype(np.uint64), out.tobytes()


def unpack(offsets: np.ndarray, data: bytes, count: int) -> np.ndarray:
    n = len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint32)
    src, at = np.frombuffer(data, np.uint8), offsets[:-1].astype(np.int64)
    head = src[at[:, None] + np.arange(6)]
    low = head[:, :4].copy().view("<u4").ravel()
    bits, n_late = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    diff = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(bits):
        if w:
            own = np.flatnonzero(bits == w)
            packed = src[at[own][:, None] + 6 + np.arange(BLOCK // 8 * w)]
            grid = np.zeros((len(own) * BLOCK, 32), np.uint8)
            grid[:, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(-1, w)
            diff[own] = np.packbits(grid, axis=1, bitorder="little").view("<u4").reshape(-1, BLOCK)
    if total := int(n_late.sum()):
        row = np.repeat(np.arange(n), n_late)
        k = np.arange(total) - np.repeat(np.cumsum(n_late) - n_late, n_late)
        base = at[row] + 6 + BLOCK // 8 * bits[row]
        high = src[(base + n_late[row] + 4 * k)[:, None] + np.arange(4)].copy().view("<u4").ravel()
        diff[row, src[base + k]] |= high << bits[row].astype(np.uint32)
    return (diff + low[:, None]).ravel()[:count]


# ---------------------------------------------------------------- shards
def shard_bytes(base: int, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """base: ids before this shard in its range of documents."""
    offsets, body = pack(ids)
    head = MAGIC + struct.pack("<IQQI", len(doc_ids), len(ids), base, len(offsets) - 1)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    names = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join((head, names.tobytes(), known.tobytes(), counts.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(), body))


def read_shard(data: bytes) -> tuple[int, list[int | None], np.ndarray, np.ndarray]:
    """(base, doc ids, counts, ids) of a shard file."""
    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    docs, total, base, blocks = struct.unpack_from("<IQQI", data, 4)
    at = 4 + struct.calcsize("<IQQI")
    names = np.frombuffer(data, "<i8", docs, at)
    known = np.frombuffer(data, np.uint8, docs, at + 8 * docs)
    counts = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)
    offsets = np.frombuffer(data, "<u8", blocks + 1, at + 17 * docs)
    ids = unpack(offsets, data[at + 17 * docs + 8 * (blocks + 1) :], total)
    return base, [int(d) if k else None for d, k in zip(names, known, strict=True)], counts, ids


# ---------------------------------------------------------------- tokens
# Fixed values of the vocabulary file: which bytes stand for themselves, and (below) how text is split.
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: b for b in PLAIN} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(PLAIN)))}
#: Texts of ASCII and Latin-1 letters, whose lower-casing and splitting are plain.
EASY = re.compile("[\t-\r -~À-ÿ]*")
EASY_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\\[-`{-~×÷]+")


class Numbers(dict):
    """Numbers of parts, in the order of their first sight; ``new`` holds those that have no ids yet."""

    def __init__(self):
        self.new: list[str | bytes] = []

    def __missing__(self, part: str | bytes) -> int:
        self.new.append(part)
        self[part] = n = len(self)
        return n


class WordEncoder:
    """Ids of whole texts from the ids of their parts.

    The vocabulary's own splitting drops white space and never joins across it, so a text's ids are
    those of its parts in order. Parts repeat, so most come from a bounded cache. Plain texts are split
    into the vocabulary's pieces, which go straight to the library's BPE model; other texts are split
    into white-space words, which go through the whole tokenizer unless they are plain.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.of = Tokenizer.from_file(path)
        self.model = self.of.model
        self.clear()

    def clear(self) -> None:
        self.index = Numbers()
        self.start, self.length, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def parts(self, text: bytes | None) -> list[str | bytes]:
        if not text:
            return []
        plain = text.decode()
        return EASY_PIECE.findall(plain.lower()) if EASY.fullmatch(plain) and "<|" not in plain else text.split()

    def piece(self, piece: str) -> list[int]:
        return [t.id for t in self.model.tokenize(piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_CHARS))]

    def ids(self, part: str | bytes) -> list[int]:
        if isinstance(part, str):
            return self.piece(part)
        word = part.decode()
        if EASY.fullmatch(word) and "<|" not in word:
            return [i for p in EASY_PIECE.findall(word.lower()) for i in self.piece(p)]
        return self.of.encode(word, add_special_tokens=False).ids

    def learn(self, new: list[str | bytes]) -> None:
        rows = list(map(self.ids, new))
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
        self.length = np.concatenate((self.length, size))
        self.flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(rows), np.uint32, int(size.sum()))))

    def encode(self, texts: list[bytes | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end``; count of each)."""
        split = list(map(self.parts, texts))
        parts = list(chain.from_iterable(split))
        if len(self.index) > CACHE_WORDS:
            self.clear()
        at = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))
        if self.index.new:
            self.learn(self.index.new)
            self.index.new = []
        size = self.length[at]
        upto = np.concatenate(([0], np.cumsum(size)))
        per_doc = np.diff(upto[np.cumsum([0, *map(len, split)])])
        ids = self.flat[np.repeat(self.start[at] - upto[:-1], size) + np.arange(int(upto[-1]))]
        return np.insert(ids, np.cumsum(per_doc), end), per_doc + 1


_encoders: dict[str, WordEncoder] = {}


def forget() -> None:
    _encoders.clear()


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_shards(docs: DataFrame, vocabulary: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents in ascending id order; returns the shard table (part, shard, n_tokens, content)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = (F.col("doc_id").asc_nulls_first(), "rk", "copy")
    key, n = F.xxhash64("doc_id", "text"), width(spark, docs)
    if crowded(rows, "doc_id"):  # ranges of ids would keep very many rows together
        dealt = spread(rows.withColumn("rk", key), "doc_id", "rk").repartitionByRange(n, *order)
    else:
        dealt = rows.repartitionByRange(n, order[0]).withColumns({"rk": key, "copy": F.lit(0), "copies": F.lit(1)})
    dealt = dealt.sortWithinPartitions(*order).select("doc_id", "text", "copies")

    def run(batches):
        take_over("tokens", forget)
        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        names, counts, ids, held, base, shard = [], [], [], 0, 0, 0

        def close():
            nonlocal names, counts, ids, held, base, shard
            out = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "n_tokens": pa.array([held], pa.int64()), "content": pa.array([shard_bytes(base, names, np.concatenate(counts), np.concatenate(ids))], pa.binary())})
            base, shard = base + held, shard + 1
            names, counts, ids, held = [], [], [], 0
            return out

        for batch in parts(batches):
            texts, doc_ids = raw(batch, "text"), batch.column("doc_id").to_pylist()
            if max(copies := batch.column("copies").to_pylist(), default=1) > 1:
                texts, doc_ids = ([x for x, n in zip(xs, copies, strict=True) for _ in range(n)] for xs in (texts, doc_ids))
            for a, b in slices(texts, 1_000_000):
                got, n = enc.encode(texts[a:b], end_id)
                names += doc_ids[a:b]
                counts.append(n)
                ids.append(got)
                held += len(got)
                if held >= SHARD_TOKENS:
                    yield close()
        if names:
            yield close()

    with batches_of(spark):
        return written(dealt.mapInArrow(run, "part int, shard int, n_tokens long, content binary"), "token-shards")


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from shard files."""
    ship(shards.sparkSession)

    def run(batches):
        for batch in batches:
            for part, content in zip(batch.column("part").to_pylist(), batch.column("content").to_pylist(), strict=True):
                base, names, counts, ids = read_shard(content)
                data, ends = ids.astype("<u4"), np.cumsum(counts)
                crc = [zlib.crc32(data[e - n : e].tobytes()) for e, n in zip(ends, counts, strict=True)]
                yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(names), pa.int32()), "doc_id": pa.array(names, pa.int64()), "own": pa.array(base + ends - counts, pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    # One row for each range of documents: as many as the exchange had partitions, never more. Written, so that the join knows its size.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = written(totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")), "token-ranges")
    found = shards.select("part", "content").mapInArrow(run, "part int, doc_id long, own long, n_tokens long, ids_crc32 long")
    return found.join(before, "part").select("doc_id", (F.col("before") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    return read_tokens(write_shards(docs, vocabulary, end_id))
