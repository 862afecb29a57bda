"""Substring dedup by recompression.

A text is a string of words, named by 128-bit hashes. A round of recompression names runs of one symbol,
then pairs: a hash bit makes each symbol left or right, and each left-right pair becomes one symbol whose
name is a hash of the pair. Names depend on content alone, so they are the same everywhere without a
dictionary, and equal substrings get equal symbols but for a few at their ends. For every word position
the parse tracks which symbols are certain whatever stands outside a window that starts or ends there.

1. Low symbols (``LOW`` rounds, about three words): which occur more than once in the corpus? A window can
   only be repeated if all its certain symbols are; a window without one stays.
2. High symbols (``HIGH`` rounds): equal names verify long repeats. All windows inside an occurrence that
   is not the first are repeats and are not looked at again.
3. The windows that are left are compared by their 128-bit names; the first (doc_id, text, position) stays.

Documents are dealt by hash to groups of bounded size in compressed packs. A group asks one row for each of
its distinct names, so a passage that a third of all documents share is one row a group; names are counted
and compared by one plain exchange on the name, and only what changes something goes back: low symbols that
do repeat, occurrences that are not the first. Rows grow with the number of words, nothing is broadcast or
collected. What a group knows after step 2 goes along as a bitmap of its words.

Null text has no words; texts of fewer words than a window lose none. Null doc_id comes first. Rows that
share a doc_id (or have none) are documents of their own, in the order of a hash of their text; equal rows
are one document and keep the same words.
"""

from __future__ import annotations

import hashlib
import io
import zlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_group, dealt, keyed, raw, ship, spread, width, written

WINDOW, LOW, HIGH = 20, 4, (12, 16)
PER_GROUP = 4 << 20  # bytes of input files for each group of documents
DOCS, LOWS, HIGHS, WINDOWS, STATE = range(5)
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0xA0761D6478BD642F)
    return x ^ (x >> U(32))


def named(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    return mix(a * U(0x9E3779B97F4A7C15) + mix(b ^ U(salt)))


# ---------------------------------------------------------------- parse
class Symbols:
    """Symbols of concatenated documents: two name lanes, document, first word, words."""

    def __init__(self, a, b, doc, start, length):
        self.a, self.b, self.doc, self.start, self.length = a, b, doc, start, length

    def merge(self, head: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[Symbols, np.ndarray]:
        """Symbols that begin at ``head`` and reach to the next; index of the new symbol of each old one."""
        at = np.flatnonzero(head)
        new = Symbols(a[at], b[at], self.doc[at], self.start[at], np.add.reduceat(self.length, at) if len(at) else self.length)
        return new, np.cumsum(head) - 1

    def runs(self, level: int) -> tuple[Symbols, np.ndarray]:
        head = np.ones(len(self.a), bool)
        head[1:] = (self.a[1:] != self.a[:-1]) | (self.b[1:] != self.b[:-1]) | (self.doc[1:] != self.doc[:-1])
        if head.all():
            return self, np.arange(len(head))
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, len(head))).astype(np.uint64)
        a, b = self.a.copy(), self.b.copy()
        many = size > 1
        a[at[many]] = named(a[at[many]], size[many], 2 * level)
        b[at[many]] = named(b[at[many]], size[many], 2 * level)
        return self.merge(head, a, b)

    def sides(self, level: int) -> np.ndarray:
        """True for left symbols."""
        return (mix(self.a + U(0x632BE59BD9B4E019 + level)) & U(1)) == 0

    def pairs(self, level: int, left: np.ndarray) -> tuple[Symbols, np.ndarray]:
        pair = left[:-1] & ~left[1:] & (self.doc[:-1] == self.doc[1:])
        at = np.flatnonzero(pair)
        head = np.ones(len(self.a), bool)
        head[at + 1] = False
        a, b = self.a.copy(), self.b.copy()
        a[at] = named(self.a[at], self.a[at + 1], 2 * level + 1)
        b[at] = named(self.b[at], self.b[at + 1], 2 * level + 1)
        return self.merge(head, a, b)


class Parse:
    """low: names of low symbols; first, last: the certain symbols of a window that starts / ends at a word.
    high: (a, b, start, length) of high symbols that hold a window."""

    def __init__(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray, window: int, edges: bool = True):
        n = len(a)
        s = Symbols(a, b, doc, np.arange(n), np.ones(n, np.int64))
        first = last = np.zeros(0, np.int32)
        if n:
            s, to = s.runs(0)
            if edges:
                first, last = to + 1, to - 1  # a run may go on outside
            for level in range(LOW):
                left = s.sides(level)
                k = len(left)
                if edges:
                    edge = np.append(left, True)
                    first = first + ~edge[np.minimum(first, k)]
                    last = last - (left[np.maximum(last, 0)] & (last >= 0))
                s, to = s.pairs(level, left)
                if edges:
                    first = np.append(to, len(s.a))[np.minimum(first, k)]
                    last = np.where(last >= 0, to[np.maximum(last, 0)], -1)
        self.low, self.first, self.last = s.a, first.astype(np.int32), last.astype(np.int32)
        found = []
        for level in range(LOW, max(HIGH)):
            if not n:
                break
            s, _ = s.runs(level)
            s, _ = s.pairs(level, s.sides(level))
            if level + 1 in HIGH:
                own = s.length >= window
                found.append((s.a[own], s.b[own], s.start[own], s.length[own]))
        self.high = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)]


def window_names(x: np.ndarray, window: int) -> np.ndarray:
    """Name of the window that starts at each word (of one lane), by doubling."""
    n = len(x) - window + 1
    if n <= 0:
        return np.zeros(0, U)
    out, at, size, power = None, 0, 1, x
    while True:
        if window & size:
            part = power[at : at + n]
            out = part if out is None else named(out, part, 1000 + size)
            at += size
        if 2 * size > window:
            return out
        power = named(power[:-size], power[size:], 2000 + size)
        size *= 2


# ---------------------------------------------------------------- groups
def word_names(words: list[bytes]) -> np.ndarray:
    """128-bit names of words. Hashing each is cheaper than looking most of them up."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)


class Texts:
    """The documents of a group, in an order that depends on them alone."""

    def __init__(self, packs: list[bytes]):
        docs = pa.concat_tables([pa.ipc.open_stream(p).read_all() for p in packs])
        docs = docs.take(np.lexsort((docs.column("rk").to_numpy(), docs.column("order").to_numpy())))
        self.ids, self.rks, self.copies = (docs.column(c).combine_chunks() for c in ("doc_id", "rk", "copies"))
        self.order, self.sub = docs.column("order").to_numpy(), (self.rks.to_numpy() & 0x7FFFFFFF) << 32
        self.texts = docs.column("text").to_pylist()

    def split(self):
        for t in self.texts:
            yield (t or b"").split()


class Group(Texts):
    """Documents, parsed."""

    def __init__(self, packs: list[bytes], window: int, edges: bool = True):
        super().__init__(packs)
        self.window = window
        names, counts, held = [np.zeros((0, 2), np.uint64)], [], []
        for words in self.split():
            counts.append(len(words))
            held += words
            if len(held) > 100_000:
                names.append(word_names(held))
                held = []
        names.append(word_names(held))
        self.counts = np.array(counts, np.int64)
        self.begin = np.cumsum(self.counts) - self.counts
        self.a, self.b = np.ascontiguousarray(np.concatenate(names).T)
        self.doc = np.repeat(np.arange(len(counts), dtype=np.int32), self.counts)
        self.parse = Parse(self.a, self.b, self.doc, window, edges)
        self.low, self.low_of, times = np.unique(self.parse.low, return_inverse=True, return_counts=True)
        self.low_many = times > 1

    def place(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document's order, text's hash and position)"""
        d = self.doc[word]
        return self.order[d], self.sub[d] + (word - self.begin[d])

    def firsts(self, a: np.ndarray, b: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Of occurrences of names: which are the first of their name in this group (equal rows have equal places)?"""
        if not len(a):
            return np.zeros(0, bool)
        order, sub = self.place(word)
        by = np.lexsort((sub, order, b, a))
        new = np.ones(len(by), bool)
        new[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
        lead = by[new][np.cumsum(new) - 1]
        out = np.zeros(len(a), bool)
        out[by] = (order[by] == order[lead]) & (sub[by] == sub[lead])
        return out

    def learn_symbols(self, repeated_low: np.ndarray, later_high: np.ndarray) -> None:
        """Answers: numbers of the low names that repeat, of the high occurrences that are not the corpus's first."""
        many = self.low_many.copy()
        many[repeated_low] = True
        self.again = many[self.low_of]
        a, b, start, length = self.parse.high
        later = ~self.firsts(a, b, start)
        later[later_high] = True
        self.gone = np.zeros(len(self.a) + 1, np.int32)
        np.add.at(self.gone, start[later], 1)
        np.add.at(self.gone, start[later] + length[later], -1)
        inside = np.zeros(len(self.a) + 1, np.int32)
        np.add.at(inside, start[later], 1)
        np.add.at(inside, start[later] + length[later] - self.window + 1, -1)
        self.inside = np.cumsum(inside)[:-1] > 0

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, a, b) of the windows that are open and the first here; the others of them are gone."""
        w, n = self.window, len(self.a)
        start = np.arange(max(0, n - w + 1))
        start = start[self.doc[start] == self.doc[start + w - 1]] if len(start) else start
        start = start[~self.inside[start]]
        a, b = self.parse.first[start].astype(np.int64), self.parse.last[start + w - 1].astype(np.int64)
        once, k = np.concatenate(([0], np.cumsum(~self.again))), len(self.again)
        start = start[(a > b) | (once[np.clip(b + 1, 0, k)] == once[np.clip(a, 0, k)])]
        x, y = window_names(self.a, w)[start], window_names(self.b, w)[start]
        first = self.firsts(x, y, start)
        np.add.at(self.gone, start[~first], 1)
        np.add.at(self.gone, start[~first] + w, -1)
        return start[first], x[first], y[first]

    def state(self) -> bytes:
        """A bitmap of the words that are gone by now."""
        return zlib.compress(np.packbits(np.cumsum(self.gone)[:-1] > 0).tobytes(), 1)


# ---------------------------------------------------------------- plan
# A question is a row: the bucket of the name it goes to, who asks (group and number there), 32 more bits of the name's
# first lane, and but for low symbols its second lane, document and place. Numbers of low names that the group has twice are
# inverted. Low names only rule windows out, so a rare meeting of two of them costs a comparison. A row with a null name is a
# group's own state on its way to the next pass.
QUESTION = pa.schema([("to", pa.int32()), ("who", pa.int64()), ("a", pa.int32()), ("more", pa.binary())])
QUESTIONS = "to int, who long, a int, more binary"
ROWS = "to int, kind int, at int, data binary"


def asked(src: int, buckets: int, a: np.ndarray, at: np.ndarray, b=None, place=None):
    """Questions as record batches."""
    more = None if b is None else np.stack([x.view(np.int64) for x in (b, *place)], 1)
    to, who = ((a >> U(33)) % U(buckets)).astype(np.int32), (src << 32) + (at.astype(np.int64) & 0xFFFFFFFF)
    a = a.astype(np.uint32).view(np.int32)
    for s in range(0, len(a), 50_000):
        n = len(to[s : s + 50_000])
        kept = pa.nulls(n, pa.binary()) if more is None else pa.FixedSizeBinaryArray.from_buffers(pa.binary(24), n, [None, pa.py_buffer(np.ascontiguousarray(more[s : s + 50_000]))]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(to[s : s + 50_000]), pa.array(who[s : s + 50_000]), pa.array(a[s : s + 50_000]), kept], schema=QUESTION)


def judged(kind: int):
    """What goes back to the groups, for the questions of a bucket: low names that another group has too, occurrences that are not the first."""

    def run(batches):
        for _, own in by_group(batches):
            low, high = ([], []), ([], [], [])
            for batch in own:
                if batch.column("a").null_count:
                    states = batch.filter(pc.is_null(batch.column("a")))
                    src = pc.shift_right(states.column("who"), 32).cast(pa.int32())
                    yield pa.RecordBatch.from_pydict({"to": src, "kind": pa.array([STATE] * len(states), pa.int32()), "at": pa.nulls(len(states), pa.int32()), "data": states.column("more")})
                    batch = batch.filter(pc.is_valid(batch.column("a")))
                some = pc.is_valid(batch.column("more")).to_numpy(zero_copy_only=False)
                who, a = batch.column("who").to_numpy(), batch.column("a").to_numpy()
                low[0].append(who[~some])
                low[1].append(a[~some])
                if some.any():
                    more = batch.column("more").filter(pa.array(some))
                    for x, y in zip(high, (who[some], a[some], np.frombuffer(more.buffers()[2], np.int64, 3 * len(more), 8 * 3 * more.offset).reshape(-1, 3)), strict=True):
                        x.append(y)
            own.clear()
            if low[0]:
                who, a = map(np.concatenate, low)
                low[0].clear()
                by = np.argsort(a, kind="stable")
                same = a[by][1:] == a[by][:-1]
                again = by[np.append(same, False) | np.append(False, same)] if len(by) else by
                again = who[again]
                yield from told(LOWS, again[again.astype(np.int32) >= 0])
            if high[0]:
                who, a, more = map(np.concatenate, high)
                b, order, sub = more.T
                by = np.lexsort((sub, order, b, a))
                new = np.ones(len(by), bool)
                new[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
                lead = by[new][np.cumsum(new) - 1]
                yield from told(kind, who[by[(order[by] != order[lead]) | (sub[by] != sub[lead])]])

    return run


def told(kind: int, who: np.ndarray):
    for s in range(0, len(who), 50_000):
        part = who[s : s + 50_000]
        yield pa.RecordBatch.from_pydict({"to": pa.array((part >> 32).astype(np.int32)), "kind": pa.array(np.full(len(part), kind, np.int32)), "at": pa.array(part.astype(np.int32)), "data": pa.nulls(len(part), pa.binary())})


def read(batches: list[pa.RecordBatch]) -> tuple[list[bytes], dict[int, np.ndarray], bytes | None]:
    """(packs, answers by kind, state) of one group."""
    table = pa.Table.from_batches(batches).combine_chunks()
    batches.clear()
    kind, at = table.column("kind").to_numpy(), table.column("at").fill_null(0).to_numpy()
    held = lambda k: table.column("data").filter(pc.equal(table.column("kind"), k)).to_pylist()
    return held(DOCS), {k: at[kind == k] for k in (LOWS, HIGHS, WINDOWS)}, next(iter(held(STATE)), None)


def substring_dedup(docs: DataFrame, window: int = WINDOW, with_text: bool = True, per_group: int = PER_GROUP) -> DataFrame:
    """(doc_id, rk, n_words, n_removed, kept_sha256, removed [, kept]); removed: word spans, end exclusive."""
    spark = docs.sparkSession
    ship(spark)
    n = width(spark, docs, per_group)
    rows = spread(keyed(docs).withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "rk")
    rows = rows.withColumn("to", F.pmod(F.xxhash64("doc_id", "rk", "copy"), F.lit(n)).cast("int")).drop("copy")

    def pack(batches):
        held, size = [], 0

        def flush():
            table = pa.Table.from_batches(held)
            to = table.column("to").to_numpy()
            by = np.argsort(to, kind="stable")
            table = table.take(by)
            cuts = np.append(np.flatnonzero(np.append(True, to[by][1:] != to[by][:-1])), len(by)).tolist()
            for s, e in zip(cuts, cuts[1:], strict=False):
                part = table.slice(s, e - s).drop_columns(["to"]).combine_chunks()
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_table(part)
                yield pa.RecordBatch.from_pydict({"to": pa.array([to[by[s]]], pa.int32()), "kind": pa.array([DOCS], pa.int32()), "at": pa.nulls(1, pa.int32()), "data": pa.array([sink.getvalue()], pa.binary())})

        for batch in batches:
            ids, texts = batch.column("doc_id"), pa.array(raw(batch, "text"), pa.large_binary())
            order = ids.fill_null(np.iinfo(np.int64).min)
            whole = pa.RecordBatch.from_arrays([batch.column("to"), ids, batch.column("rk"), order, texts, batch.column("copies")], ["to", "doc_id", "rk", "order", "text", "copies"])
            for s in range(0, len(ids), 1000):
                held.append(whole.slice(s, 1000))
                size += held[-1].nbytes
                if size > 24 << 20:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    def first_pass(batches):
        for me, own in by_group(batches):
            group = Group(read(own)[0], window, edges=False)
            at = np.arange(len(group.low))
            yield from asked(me, n, group.low, np.where(group.low_many, ~at, at))
            a, b, start, _ = group.parse.high
            at = np.flatnonzero(group.firsts(a, b, start))
            yield from asked(me, n, a[at], at, b[at], group.place(start[at]))

    def second_pass(batches):
        for me, own in by_group(batches):
            packs, told, _ = read(own)
            group = Group(packs, window)
            packs.clear()
            group.learn_symbols(told[LOWS], told[HIGHS])
            start, a, b = group.windows()
            yield from asked(me, n, a, start, b, group.place(start))
            yield pa.RecordBatch.from_pylist([{"to": me, "who": me << 32, "a": None, "more": group.state()}], QUESTION)

    def third_pass(batches):
        for _, own in by_group(batches):
            packs, told, state = read(own)
            group = Texts(packs)
            packs.clear()
            counts = np.fromiter(map(len, group.split()), np.int64, len(group.texts))
            total = int(counts.sum())
            gone = np.zeros(total + 1, np.int32)
            np.add.at(gone, told[WINDOWS], 1)
            np.add.at(gone, told[WINDOWS] + window, -1)
            removed = (np.cumsum(gone)[:-1] > 0) | np.unpackbits(np.frombuffer(zlib.decompress(state), np.uint8), count=total).view(bool)
            yield from cleaned(group, counts, np.cumsum(counts) - counts, removed)

    def cleaned(group, counts, begin, removed):
        for at in range(0, len(group.texts), 200):
            rows = []
            for d in range(at, min(at + 200, len(group.texts))):
                words, edge = (group.texts[d] or b"").split(), ()
                out = removed[begin[d] : begin[d] + counts[d]]
                if out.any():
                    words = list(compress(words, (~out).tolist()))
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], out.view(np.int8), [0])))).reshape(-1, 2).tolist()
                text = b" ".join(words)
                row = {"doc_id": group.ids[d].as_py(), "rk": group.rks[d].as_py(), "n_words": int(counts[d]), "n_removed": int(counts[d]) - len(words), "kept_sha256": hashlib.sha256(text).hexdigest(), "removed": [{"start": s, "end": e} for s, e in edge]}
                rows += [row | ({"kept": text} if with_text else {})] * group.copies[d].as_py()
            yield pa.RecordBatch.from_pylist(rows, RESULT if with_text else pa.schema(list(RESULT)[:-1]))

    def answered(questions, kind, name):
        return written(dealt(questions, n).mapInArrow(judged(kind), ROWS), name, release=True)

    packs = rows.mapInArrow(pack, ROWS)
    symbols = answered(dealt(packs, n).mapInArrow(first_pass, QUESTIONS), HIGHS, "substring-symbols")
    repeats = answered(dealt(packs.unionByName(symbols), n).mapInArrow(second_pass, QUESTIONS), WINDOWS, "substring-windows")
    schema = "doc_id long, rk long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:long,end:long>>" + ", kept string" * with_text
    return dealt(packs.unionByName(repeats), n).mapInArrow(third_pass, schema)


RESULT = pa.schema([("doc_id", pa.int64()), ("rk", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])
