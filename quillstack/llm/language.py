"""Language ID by segmentation-marginalised unigrams over a public vocabulary.

A language is a distribution over the pieces of a fixed public vocabulary. The probability of a word is the
sum over all its segmentations into pieces, from a forward algorithm; a text's is the product over its
words. Piece probabilities come from expectation-maximisation over the words of labelled documents, of
which about ``SAMPLE`` for each language are taken by a hash of their id; everything else covers all rows.
Expected counts are added up on the executors, in whole millionths, so that reruns agree; the driver sees one
row a piece and language.

Words are split at ASCII white space and lower-cased; words without a letter say nothing. A word of more than
``RUN`` characters is read as consecutive runs of so many, each by all its segmentations. Characters that
no piece covers cost the same in every language. Null text, or text without a letter, is ``und`` with
score 0; so is everything if nothing could be learned. The score is the posterior at equal priors. More
than ``MOST_LANGUAGES`` labels are refused: the model goes to every executor.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, parts, raw, ship, slices, take_over, width, written

SAMPLE, STEPS, SMOOTH = 1000, 3, 0.1
LONGEST, SHORT, RUN = 16, 33, 256
MOST_LANGUAGES, WHOLE = 500, 1_000_000
MARK = "▁"
CACHE_WORDS = 200_000
UNKNOWN = 1e-7
U = np.uint64


class Pieces:
    """Vectorised lookup of substrings among the pieces, by a rolling hash and a probed table."""

    SLOTS, BASE = 1 << 20, np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str]):
        self.index = {p: i for i, p in enumerate(pieces) if 0 < len(p) <= LONGEST}
        self.keys, self.ids = np.zeros(self.SLOTS, np.uint64), np.full(self.SLOTS, -1, np.int32)
        self.probes = 1
        for p, i in self.index.items():
            h = 0
            for c in p:
                h = (h * int(self.BASE) + ord(c)) & 0xFFFFFFFFFFFFFFFF
            slot, n = self.slot(np.array([h], np.uint64))[0], 1
            while self.ids[slot] >= 0:
                slot, n = (slot + 1) % self.SLOTS, n + 1
            self.keys[slot], self.ids[slot], self.probes = h, i, max(self.probes, n)
        # Bits of piece lengths that occur at all.
        self.longest = max(map(len, self.index), default=1)

    def slot(self, h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(44)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        slot = self.slot(h)
        found = np.where(self.keys[slot] == h, self.ids[slot], -1)
        for k in range(1, self.probes):
            at = (slot + k) % self.SLOTS
            found = np.where((found < 0) & (self.keys[at] == h), self.ids[at], found)
        return found


class Unigrams:
    """Probabilities (pieces + 1, languages); the last row is that of an unknown character."""

    def __init__(self, pieces: Pieces | list[str], probs: np.ndarray):
        self.pieces, self.p = pieces if isinstance(pieces, Pieces) else Pieces(pieces), probs
        self.unknown = len(probs) - 1

    def arcs(self, codes: np.ndarray):
        """(end, length, piece row of each word or the last row) for words of one length."""
        n = codes.shape[1]
        for i in range(1, n + 1):
            h, power = np.zeros(len(codes), np.uint64), np.uint64(1)
            for length in range(1, min(i, self.pieces.longest) + 1):
                h = h + codes[:, i - length].astype(np.uint64) * power
                power = U(int(power) * int(self.pieces.BASE) & 0xFFFFFFFFFFFFFFFF)
                at = self.pieces.find(h)
                if length == 1:
                    yield i, 1, np.where(at < 0, self.unknown, at), None
                else:
                    own = np.flatnonzero(at >= 0)
                    if len(own):
                        yield i, length, at[own], own

    def forward(self, codes: np.ndarray, arcs) -> np.ndarray:
        f = np.zeros((codes.shape[1] + 1, len(codes), self.p.shape[1]))
        f[0] = 1
        for i, length, at, own in arcs:
            if own is None:
                f[i] += f[i - length] * self.p[at]
            else:
                f[i, own] += f[i - length, own] * self.p[at]
        return f

    def scaled(self, codes: np.ndarray, arcs) -> np.ndarray:
        """Logs of the forward sums, rescaled at each character: no length runs out of range."""
        n = codes.shape[1]
        logs, new, done = np.zeros((n + 1, len(codes), self.p.shape[1])), None, 0
        for i, length, at, own in arcs:
            if i != done:
                if done:
                    logs[done] = logs[done - 1] + np.log(new)
                new, done = np.zeros(logs.shape[1:]), i
            k = slice(None) if own is None else own
            new[k] += self.p[at] * np.exp(logs[i - length, k] - logs[i - 1, k])
        if done:
            logs[done] = logs[done - 1] + np.log(new)
        return logs

    def score(self, words: list[str]) -> np.ndarray:
        """Log probabilities (words, languages)."""
        units, of = units_of(words)
        out = np.zeros((len(units), self.p.shape[1]))
        for n, part in by_length(units):
            codes = codes_of([units[u] for u in part])
            arcs = self.arcs(codes)
            out[part] = np.log(self.forward(codes, arcs)[-1]) if n <= SHORT else self.scaled(codes, arcs)[-1]
        return np.add.reduceat(out, of, axis=0) if len(of) else out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (pieces + 1, languages)."""
        out = np.zeros_like(self.p)
        units, of = units_of(words)
        counts = np.repeat(counts, np.diff(np.append(of, len(units))), axis=0)
        for n, part in by_length(units):
            codes = codes_of([units[u] for u in part])
            arcs = list(self.arcs(codes))
            logs = None if n <= SHORT else self.scaled(codes, arcs)
            f = self.forward(codes, arcs) if logs is None else None
            b = np.zeros((n + 1, len(part), self.p.shape[1]))
            b[n] = counts[part] if f is None else counts[part] / f[n]
            for i, length, at, own in reversed(arcs):
                k = slice(None) if own is None else own
                use = self.p[at] * b[i, k]
                if f is None:  # b is relative to the forward sum of its place
                    use = use * np.exp(logs[i - length, k] - logs[i, k])
                b[i - length, k] += use
                if f is not None:
                    use = use * f[i - length, k]
                for lang in range(self.p.shape[1]):
                    out[:, lang] += np.bincount(at, use[:, lang], len(out))
        return out


def units_of(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Marked words in runs of RUN characters at most, and where each word's begin."""
    units, of = [], []
    for w in words:
        w = MARK + w
        of.append(len(units))
        units += [w] if len(w) <= RUN else [w[k : k + RUN] for k in range(0, len(w), RUN)]
    return units, np.array(of, np.int64)


def by_length(units: list[str]):
    """(length, units of it): in lots that bound the working memory."""
    out: dict[int, list[int]] = {}
    for i, u in enumerate(units):
        out.setdefault(len(u), []).append(i)
    for n, own in out.items():
        most = max(1, 640_000 // n)
        yield from ((n, own[s : s + most]) for s in range(0, len(own), most))


def codes_of(units: list[str]) -> np.ndarray:
    return np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(units), -1)


def has_letter(word: str) -> bool:
    return any(map(str.isalpha, word))


def spoken(word: bytes) -> str:
    """The word as it is scored; empty without a letter."""
    w = word.decode("utf-8", "replace").lower()
    return w if has_letter(w) else ""


def pieces_of(model_file: str) -> list[str]:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [sp.id_to_piece(i) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)) else "" for i in range(sp.get_piece_size())]


# What a worker process keeps between its tasks. Functions of this module find it; closures would carry copies.
_pieces: dict[str, Pieces] = {}
_scorers: dict[str, Scorer] = {}


def forget() -> None:
    _pieces.clear()
    _scorers.clear()


def pieces_named(name: str, pieces: list[str]) -> Pieces:
    if name not in _pieces:
        _pieces.clear()
        _pieces[name] = Pieces(pieces)
    return _pieces[name]


def scorer_named(name: str, pieces: list[str], probs: np.ndarray) -> Scorer:
    if name not in _scorers:
        forget()
        _scorers[name] = Scorer(Unigrams(pieces, probs))
    return _scorers[name]


def train(rows: DataFrame, vocabulary: str, sample: int = SAMPLE) -> tuple[list[str], list[str], np.ndarray]:
    """rows(doc_id, text, lang) that may teach -> (languages, pieces, probabilities)."""
    spark = rows.sparkSession
    ship(spark)
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    n = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(n) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    langs, pieces, name = sorted(n), pieces_of(vocabulary), uuid.uuid4().hex
    if not langs:
        return [], pieces, np.zeros((len(pieces) + 1, 0))
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, sample / n[k]))])[F.col("lang")]
    drawn = (F.pmod(F.xxhash64(F.lit("sample"), F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(1 << 30)) / float(1 << 30)) < share
    known = np.array([0 < len(p) <= LONGEST for p in pieces] + [False])

    def count(batches):
        for batch in batches:
            texts, named = raw(batch, "text"), batch.column("lang").to_pylist()
            for a, b in slices(texts):
                own = Counter((lang, w) for t, lang in zip(texts[a:b], named[a:b], strict=True) for w in t.split())
                rows = Counter()
                for (lang, w), k in own.items():
                    if w := spoken(w):
                        rows[lang, w] += k
                yield pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in rows], pa.string()), "word": pa.array([k[1] for k in rows], pa.string()), "n": pa.array(list(rows.values()), pa.int64())})

    def uses(batches):
        take_over("language", forget)
        langs, pieces, probs = sent.value
        model, total, kept = Unigrams(pieces_named(name, pieces), probs), np.zeros(probs.shape, np.int64), {}
        at = {x: i for i, x in enumerate(langs)}

        def learn():
            counts = np.array(list(kept.values()), float)
            total[:] += np.rint(model.expected(list(kept), counts) * WHOLE).astype(np.int64)
            kept.clear()

        for batch in batches:
            for lang, word, k in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                kept.setdefault(word, [0] * len(langs))[at[lang]] += k
            if len(kept) > 50_000:
                learn()
        if kept:
            learn()
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(piece.astype(np.int32)), "lang": pa.array(lang.astype(np.int32)), "n": pa.array(total[piece, lang])})

    counted = rows.where(drawn).select("text", "lang").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = written(counted.repartition(width(spark), "word").sortWithinPartitions("word", "lang"), "language-words")
    probs = np.where(known, np.array([0.2 ** len(p) for p in pieces] + [0.0]), 0.0)[:, None] * np.ones(len(langs))
    probs = probs / probs.sum(0)
    probs[-1] = UNKNOWN
    for _ in range(STEPS):
        sent = spark.sparkContext.broadcast((langs, pieces, probs))  # bounded by the vocabulary and MOST_LANGUAGES
        got = words.mapInArrow(uses, "piece int, lang int, n long").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow()
        used = np.zeros_like(probs)
        used[got.column("piece").to_numpy(), got.column("lang").to_numpy()] = got.column("n").to_numpy() / WHOLE
        used[-1] = 0
        probs = np.where(known[:, None], used + SMOOTH, 0)
        probs = probs / probs.sum(0)
        probs[-1] = UNKNOWN
    return langs, pieces, probs


class Scorer:
    """Log probabilities of words, from a bounded cache."""

    def __init__(self, model: Unigrams):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.rows = np.zeros((0, self.model.p.shape[1] + 1))

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        """(texts, languages + 1): sums of log probabilities, and of words with a letter."""
        split = [(t or b"").split() for t in texts]
        words = [w for ws in split for w in ws]
        if len(self.index) > CACHE_WORDS:
            self.clear()
        new = list(set(words).difference(self.index))
        if new:
            said = [spoken(w) for w in new]
            own = [i for i, w in enumerate(said) if w]
            rows = np.zeros((len(new), self.rows.shape[1]))
            rows[own, :-1] = self.model.score([said[i] for i in own])
            rows[own, -1] = 1
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.rows = np.concatenate((self.rows, rows))
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        counts = np.array([len(ws) for ws in split], np.int64)
        out, full = np.zeros((len(texts), self.rows.shape[1])), np.flatnonzero(counts)
        if len(full):
            out[full] = np.add.reduceat(self.rows[at], (np.cumsum(counts) - counts)[full], axis=0)
        return out


def identify(docs: DataFrame, vocabulary: str, folds: int = 4, held: int = 2, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, rk, held_out, lang_pred, score); rows with crc32(doc_id) % folds = held never teach."""
    spark = docs.sparkSession
    fold = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == held, F.lit(False))
    langs, pieces, probs = train(docs.where(~fold).select("doc_id", "text", "lang"), vocabulary, sample)
    sent = spark.sparkContext.broadcast((langs, pieces, probs))  # bounded by the vocabulary and MOST_LANGUAGES
    rows, name = keyed(docs).withColumn("held_out", fold), uuid.uuid4().hex

    def run(batches):
        take_over("language", forget)
        langs, pieces, probs = sent.value
        scorer = scorer_named(name, pieces, probs) if langs else None
        for batch in parts(batches, 2000):
            texts = raw(batch, "text")
            for a, b in slices(texts):
                named, score = ["und"] * (b - a), np.zeros(b - a)
                if scorer:
                    got = scorer.score(texts[a:b])
                    logs = got[:, :-1]
                    best = logs.argmax(1)
                    odds = 1 / np.exp(np.minimum(logs - logs.max(1, keepdims=True), 0)).sum(1)
                    full = got[:, -1] > 0
                    score = np.where(full, odds, 0.0)
                    named = [langs[k] if x else "und" for k, x in zip(best.tolist(), full.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], batch.column("rk")[a:b], batch.column("held_out")[a:b], pa.array(named, pa.string()), pa.array(score, pa.float64())], ["doc_id", "rk", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, rk long, held_out boolean, lang_pred string, score double")
