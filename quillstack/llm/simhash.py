"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are 64-bit majorities of the XXH64 hashes of word shingles. Distinct fingerprints are
dealt to groups by sets of bit blocks: with six blocks, two fingerprints that differ in at most four
bits agree on two blocks; with more fingerprints more blocks have to agree, so that groups stay small. In a group the fingerprints of a key are sorted by Gray rank and indexed by a
tree: each node keeps the mask of bits that all below it share and their pattern. Pairs of nodes are
walked from the roots; bits that both nodes share and that differ add up on the way down, and a pair
is dropped with all below it when they exceed the limit, or when all below both is linked already. A
group returns a spanning forest of the links it finds, never all pairs.

Random fingerprints of a very large corpus come within a larger limit by chance, and similar texts miss a
limit by chance. With a *guard*, a document has a second fingerprint, from rehashed shingles: a link needs one
of the two within the limit, either is indexed, and no more than ``guard`` differing bits in both together.
Documents are then told apart by both fingerprints, as a 64-bit hash of them.

Null text and text without words have fingerprint zero, linked like any other. Short texts hash their
whole word sequence. Repeated rows share a fingerprint. A component's id is its smallest non-null doc_id.
"""

from __future__ import annotations

from itertools import accumulate, combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, by_group, dealt, keyed, parts, raw, ship, slices, take_over, width, written
from .components import components

SEED, SHINGLE, LIMIT = 42, 4, 4
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()
FAN, CHUNK, PER_GROUP = 16, 1 << 20, 400_000


# ---------------------------------------------------------------- fingerprints
def shingle_hashes(text: bytes | None, k: int = SHINGLE) -> list[int]:
    words = (text or b"").lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0] + [e + 1 for e in ends[:-1]]
    h = xxhash.xxh64_intdigest
    return [h(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1 :], strict=False)] if len(words) >= k else [h(joined, SEED)]


def majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``counts`` hashes; zero for an empty run."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    blocks = -(-n // 255)  # a lane of 8 bits holds 255 at most
    first = np.cumsum(blocks) - blocks
    inside = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    starts = np.repeat(np.cumsum(n) - n, blocks) + 255 * inside
    octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    for j in range(8):
        lanes = np.add.reduceat(LANES[octets[:, j]], starts).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        byte = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").ravel()
        out[full] |= byte.astype(np.uint64) << np.uint64(8 * j)
    return out


def node_of(fps: np.ndarray, second: np.ndarray | None) -> np.ndarray:
    return fps if second is None else mixed(fps + mixed(second ^ np.uint64(0xA0761D6478BD642F)))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, guarded: bool = False) -> DataFrame:
    """(doc_id, rk, fp long, second long, node long); second is null without a guard, node the fingerprint."""
    ship(docs.sparkSession)
    rows = keyed(docs)

    def run(batches):
        take_over("simhash")
        for batch in parts(batches, 2000):
            texts = raw(batch, "text")
            for a, b in slices(texts):
                own = [shingle_hashes(t, shingle) for t in texts[a:b]]
                counts = np.array([len(x) for x in own], np.int64)
                hashes = np.fromiter((h for x in own for h in x), np.uint64, int(counts.sum()))
                fps = majorities(hashes, counts)
                second = majorities(mixed(hashes), counts) if guarded else None
                more = pa.nulls(b - a, pa.int64()) if second is None else pa.array(second.view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], batch.column("rk")[a:b], pa.array(fps.view(np.int64)), more, pa.array(node_of(fps, second).view(np.int64))], ["doc_id", "rk", "fp", "second", "node"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, rk long, fp long, second long, node long")


# ---------------------------------------------------------------- keys
def block_masks(limit: int = LIMIT, agree: int = 2) -> list[np.uint64]:
    """Masks of all sets of ``agree`` out of limit + agree blocks: fingerprints within ``limit`` bits agree on one at least."""
    n = limit + agree
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [np.uint64(sum(x)) for x in combinations(blocks, agree)]


def best_agree(nodes: int, limit: int) -> int:
    """How many blocks should agree: finer groups cost more copies of each fingerprint, coarser ones more comparisons. The links are the same."""
    def cost(agree: int) -> float:
        return comb(limit + agree, agree) * (1000 + nodes / 2.0 ** (64 * agree / (limit + agree)))  # a copy costs as much as 1,000 comparisons

    return min(range(2, 7), key=cost)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def gray_rank(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


# ---------------------------------------------------------------- index
class GrayForest:
    """A tree for each group over fingerprints sorted by group and Gray rank."""

    def __init__(self, fps: np.ndarray, group: np.ndarray, limit: int, second: np.ndarray | None, guard: int):
        self.fps, self.limit, self.second, self.guard = fps, limit, second, guard
        n = len(fps)
        near = (group[1:] == group[:-1]) & self.linked(np.arange(1, n), np.arange(n - 1))
        at = np.flatnonzero(near)
        self.edges = [np.stack((at, at + 1), 1)]
        fresh = np.ones(n, bool)
        fresh[1:] = ~near
        self.label = np.cumsum(fresh) - 1  # by runs of linked neighbours
        self.parent = np.arange(self.label[-1] + 1)
        self.all, self.any, self.first = [fps], [fps], [np.arange(n + 1)]
        own = group
        while True:
            new = np.ones(len(own), bool)
            new[1:] = own[1:] != own[:-1]
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(own)))
            if size.max() == 1 and len(self.all) > 1:
                break
            inside = np.arange(len(own)) - np.repeat(head, size)
            cut = np.flatnonzero(inside % FAN == 0)
            self.all.append(np.bitwise_and.reduceat(self.all[-1], cut))
            self.any.append(np.bitwise_or.reduceat(self.any[-1], cut))
            self.first.append(np.append(cut, len(own)))
            own = own[cut]
        first = self.first[1]
        self.below = np.minimum(first[:-1, None] + np.arange(FAN), first[1:, None] - 1)
        self.relabel()

    def linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        bits = np.bitwise_count(self.fps[a] ^ self.fps[b])
        if self.second is None:
            return bits <= self.limit
        return (bits <= self.limit) & (bits + np.bitwise_count(self.second[a] ^ self.second[b]) <= self.guard)

    def relabel(self) -> None:
        """Each node's component if all below it is in one, else -1."""
        while not np.array_equal(up := self.parent[self.parent], self.parent):
            self.parent = up
        self.one = [self.parent[self.label]]
        for first in self.first[1:]:
            low, high = np.minimum.reduceat(self.one[-1], first[:-1]), np.maximum.reduceat(self.one[-1], first[:-1])
            self.one.append(np.where(low == high, low, -1))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links between fingerprints a and b; those that connect something new are kept."""
        la, lb = self.parent[self.label[a]], self.parent[self.label[b]]
        _, pick = np.unique(np.minimum(la, lb) * (len(self.parent) + 1) + np.maximum(la, lb), return_index=True)
        kept = []
        for i in pick.tolist():
            x, y = self.find(int(la[i])), self.find(int(lb[i]))
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                kept.append(i)
        if kept:
            self.edges.append(np.stack((a[kept], b[kept]), 1))
            self.relabel()

    def leaves(self, a: np.ndarray, b: np.ndarray) -> None:
        """Exact distances below pairs of lowest nodes, as squares of FAN x FAN (short nodes repeat their last)."""
        step = CHUNK // (FAN * FAN)
        for s in range(0, len(a), step):
            x, y = self.below[a[s : s + step]], self.below[b[s : s + step]]
            pair, i, j = np.nonzero(np.bitwise_count(self.fps[x][:, :, None] ^ self.fps[y][:, None, :]) <= self.limit)
            x, y = x[pair, i], y[pair, j]
            far = self.one[0][x] != self.one[0][y]
            if self.second is not None:
                far &= self.linked(x, y)
            if far.any():
                self.join(x[far], y[far])

    def walk(self) -> np.ndarray:
        top = len(self.all) - 1
        roots = np.arange(len(self.all[top]))
        stack = [(top, roots, roots)]
        while stack:
            level, a, b = stack.pop()
            one = self.one[level]
            open_ = (one[a] < 0) | (one[a] != one[b])
            a, b = a[open_], b[open_]
            if not len(a):
                continue
            if level == 1:
                self.leaves(a, b)
                continue
            first = self.first[level]
            na, nb = first[a + 1] - first[a], first[b + 1] - first[b]
            grown = np.cumsum(na * nb)
            if grown[-1] > CHUNK and len(a) > 1:
                cut = max(1, int(np.searchsorted(grown, CHUNK)))
                stack += [(level, a[cut:], b[cut:]), (level, a[:cut], b[:cut])]
                continue
            pair = np.repeat(np.arange(len(a)), na * nb)
            k = np.arange(int(grown[-1])) - (grown - na * nb)[pair]
            i, j = k // nb[pair], k % nb[pair]
            keep = (a[pair] != b[pair]) | (i <= j)
            pair, i, j = pair[keep], i[keep], j[keep]
            x, y = first[a[pair]] + i, first[b[pair]] + j
            down = level - 1
            shared = ~((self.all[down][x] ^ self.any[down][x]) | (self.all[down][y] ^ self.any[down][y]))
            near = np.bitwise_count((self.all[down][x] ^ self.all[down][y]) & shared) <= self.limit
            stack.append((down, x[near], y[near]))
        return np.concatenate(self.edges)


def forest_links(fps: np.ndarray, key: np.ndarray, limit: int = LIMIT, second: np.ndarray | None = None, guard: int = 0) -> np.ndarray:
    """Pairs of row numbers that span the links inside each key."""
    order = np.lexsort((gray_rank(fps), key))
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    group = np.cumsum(new) - 1
    crowd = np.bincount(group)[group] > 1
    if not crowd.any():
        return np.zeros((0, 2), np.int64)
    own, group = order[crowd], group[crowd]
    return own[GrayForest(fps[own], group, limit, None if second is None else second[own], guard).walk()]


def links(unique: DataFrame, limit: int = LIMIT, agree: int | None = None, guard: int | None = None) -> DataFrame:
    """(a, b): links that span all pairs of distinct nodes (fp, second, node) within ``limit`` bits (and the guard's)."""
    spark = unique.sparkSession
    ship(spark)
    nodes, sides = unique.count(), 1 if guard is None else 2
    masks = block_masks(limit, agree or best_agree(nodes, limit))
    n = max(width(spark), -(-nodes * sides * len(masks) // PER_GROUP))

    def deal(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                both = [part.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("fp", "second")[:sides]]
                for side in range(sides):
                    fps = both[side]
                    keys = np.concatenate([mixed((fps & m) ^ mixed(np.full(len(fps), c, np.uint64))) for c, m in enumerate(masks)])
                    to = (keys >> np.uint64(33)) % np.uint64(n)
                    order = np.argsort(to, kind="stable")
                    keys, to, row = keys[order], to[order], order % len(fps)
                    cuts = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), len(to)) if len(to) else np.zeros(1, np.int64)
                    cols = {"fps": fps[row], "keys": keys} | ({"more": both[1 - side][row]} if sides > 1 else {})
                    made = {c: pa.array([x[s:e].tobytes() for s, e in zip(cuts, cuts[1:], strict=False)], pa.binary()) for c, x in cols.items()}
                    yield pa.RecordBatch.from_pydict({"to": pa.array(to[cuts[:-1]].astype(np.int32), pa.int32()), "side": pa.array([side] * (len(cuts) - 1), pa.int32())} | made)

    def join(batches):
        for _, own in by_group(batches):
            rows = pa.Table.from_batches(own)
            own.clear()
            for side in range(sides):
                part = rows.filter(pc.equal(rows.column("side"), side))
                # Distinct (key, node) pairs by construction: the nodes are distinct.
                fps, keys, *more = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint64) for c in ("fps", "keys", *(("more",) if sides > 1 else ())))
                found = forest_links(fps, keys, limit, *((more[0], guard) if more else ()))
                nodes = (node_of(fps, None) if not more else node_of(more[0], fps) if side else node_of(fps, more[0]))[found].view(np.int64)
                yield pa.RecordBatch.from_pydict({"a": pa.array(np.ascontiguousarray(nodes[:, 0])), "b": pa.array(np.ascontiguousarray(nodes[:, 1]))})

    packs = unique.select("fp", "second").mapInArrow(deal, "to int, side int, fps binary, keys binary" + ", more binary" * (sides > 1))
    return dealt(packs, n).mapInArrow(join, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, limit: int = LIMIT, agree: int | None = None, guard: int | None = None) -> DataFrame:
    """(doc_id, rk, fp, fingerprint, component_id, root); root is a node of the component, its own even where all ids are null."""
    with batches_of(docs.sparkSession, 2000):
        prints = written(fingerprints(docs, shingle, guard is not None), "simhash")
    unique = written(prints.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("fp").alias("fp"), F.min("second").alias("second")), "simhash-unique")
    roots = components(links(unique, limit, agree, guard))
    named = written(unique.select("node", "first").join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "simhash-roots")
    lowest = written(named.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-lowest")
    by_node = written(named.join(lowest, "root").select("node", "component_id", "root"), "simhash-components")
    return prints.join(by_node, "node").select("doc_id", "rk", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")
