"""Language identification by unigram pieces, summed over all segmentations.

A fixed public vocabulary gives the pieces. A language is a distribution over them; the
probability of a word is the sum, over all ways to cut it into pieces, of the product of the
pieces' probabilities, which a forward recursion finds without listing the ways. A text's
words are independent. The probabilities are fitted by expectation maximisation on word
counts of a sample of labelled documents, of at most PER_LANGUAGE documents a language.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import parts, small
from rivulet.llm.words import mix
from rivulet.util import stage

PER_LANGUAGE = 2000
ROUNDS = 3
_SMOOTH = 0.05
_LONG = 40
# Below this, what rounds to zero on the way could matter: such words take logarithms.
_LEAST = 1e-270
_TOGETHER = 8192
_CELLS = 1 << 18
_CACHE = 1 << 19


def pieces_of(model_file: str) -> list[str]:
    """The ordinary pieces of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))
    ]


def text_words(text: str) -> list[str]:
    """Lower-cased words, each with the mark that the vocabulary puts before a word."""
    return ["▁" + w for w in text.lower().split()]


class Prefixes:
    """Piece numbers by hash of a prefix of a piece: -1 for a mere prefix, -2 for neither."""

    BITS = 20

    def __init__(self, table: dict[int, int]):
        keys = np.array(sorted(table), np.uint64)
        self.keys = np.append(keys, np.uint64(0))
        self.pieces = np.array([*(table[int(k)] for k in keys), -2], np.int64)
        bucket = (keys >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.first = np.searchsorted(bucket, np.arange(1 << self.BITS))
        self.depth = int(np.bincount(bucket, minlength=1).max(initial=0))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = self.first[(hashes >> np.uint64(64 - self.BITS)).astype(np.int64)]
        found = np.full(len(hashes), -2, np.int64)
        for _ in range(self.depth):
            hit = self.keys[at] == hashes
            found[hit] = self.pieces[at[hit]]
            at = np.minimum(at + 1, len(self.keys) - 1)
        return found


_TIMES = np.uint64(0x9E3779B97F4A7C15)


class Lattice:
    """Pieces found in words. A character that is no piece counts as the last piece, `unk`."""

    def __init__(self, pieces: list[str]):
        self.index = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        self.unknown = len(self.index)
        self.longest = max(map(len, self.index), default=1)
        table: dict[int, int] = {}
        for length in range(1, self.longest + 1):
            parts = sorted({p[:length] for p in self.index if len(p) >= length})
            points = np.array([[ord(c) for c in p] for p in parts], np.uint64)
            sums = np.zeros(len(parts), np.uint64)
            for k in range(length):
                sums = (sums + points[:, k]) * _TIMES
            hashes = mix(sums + np.uint64(length)).tolist()
            table.update(zip(hashes, (self.index.get(p, -1) for p in parts), strict=True))
        self.prefixes = Prefixes(table)

    def steps(self, words: list[str]):
        """Hits of many words as arrays (word, start, piece), by end and then length."""
        sizes = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        owner = np.repeat(np.arange(len(words)), sizes)
        start = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at, sums = np.arange(len(points)), np.zeros(len(points), np.uint64)
        found: list[tuple[np.ndarray, ...]] = []
        for length in range(1, self.longest + 1):
            sums = (sums + points[at + length - 1]) * _TIMES
            piece = self.prefixes.find(mix(sums + np.uint64(length)))
            hit = piece >= 0
            ends, named = start[at] + length, piece
            if length == 1:
                named, hit = np.where(hit, piece, self.unknown), np.ones(len(at), bool)
            found.append(
                (ends[hit], np.full(hit.sum(), length), owner[at[hit]], start[at[hit]], named[hit])
            )
            more = (piece > -2) & (ends < sizes[owner[at]])
            at, sums = at[more], sums[more]
        end, length, word, begin, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((length, end))
        turns = np.flatnonzero(np.diff(end[order] * 1024 + length[order])) + 1
        parts = np.split(order, turns) if len(order) else []
        return [(int(end[p[0]]), (word[p], begin[p], piece[p])) for p in parts]

    def hits(self, word: str) -> Iterator[tuple[int, int, int]]:
        """(start, end, piece) of one word, ordered by start."""
        rows = [
            (int(a), end, int(k))
            for end, (_, starts, pieces) in self.steps([word])
            for a, k in zip(starts, pieces, strict=True)
        ]
        return iter(sorted(rows))

    def log_likelihood(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """Logarithm of the summed probability of each word (rows) in each language."""
        out = np.empty((len(words), probs.shape[1]))
        every = [i for i, w in enumerate(words) if len(w) <= _LONG]
        for low in range(0, len(every), _TOGETHER):
            short = every[low : low + _TOGETHER]
            picked = [words[i] for i in short]
            alpha = np.zeros((len(short), max(map(len, picked)) + 1, probs.shape[1]))
            alpha[:, 0] = 1
            for b, (w, a, piece) in self.steps(picked):
                alpha[w, b] += alpha[w, a] * probs[piece]
            ends = np.array([len(w) for w in picked])
            found = alpha[np.arange(len(short)), ends]
            tiny = np.flatnonzero((found < _LEAST).any(axis=1))
            found[tiny] = 1
            out[short] = np.log(found)
            if len(tiny):
                out[np.array(short)[tiny]] = self._logs([picked[i] for i in tiny], probs)
        for i, word in enumerate(words):
            if len(word) > _LONG:
                out[i] = self._long(word, probs)
        return out

    def _logs(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """The same in logarithms, for words of few characters with tiny probabilities."""
        logs = np.log(probs)
        alpha = np.full((len(words), max(map(len, words)) + 1, probs.shape[1]), -np.inf)
        alpha[:, 0] = 0
        for b, (w, a, piece) in self.steps(words):
            alpha[w, b] = np.logaddexp(alpha[w, b], alpha[w, a] + logs[piece])
        return alpha[np.arange(len(words)), [len(w) for w in words]]

    def _long(self, word: str, probs: np.ndarray) -> np.ndarray:
        """The same with scaling, for words whose probability would underflow."""
        alpha = {0: np.ones(probs.shape[1])}
        scale = np.zeros(probs.shape[1])
        for a, b, piece in self.hits(word):
            if a - 1 in alpha:  # all that ends at a is summed
                del alpha[a - 1]
                most = alpha[a]
                scale += np.log(most)
                for k in alpha:
                    alpha[k] = alpha[k] / most
                alpha[a] = np.ones(probs.shape[1])
            alpha[b] = alpha.get(b, 0) + alpha[a] * probs[piece]
        return scale + np.log(alpha[len(word)])

    def expected(self, words: list[str], weights: np.ndarray, probs: np.ndarray) -> np.ndarray:
        """Expected piece counts of weighted words in one language."""
        sizes = np.array([len(w) for w in words])
        counts = np.zeros(len(probs))
        short = np.flatnonzero(sizes <= _LONG)
        if len(short):
            counts += self._expected([words[i] for i in short], weights[short], probs)
        long = np.flatnonzero(sizes > _LONG)
        long = long[np.argsort(sizes[long], kind="stable")]
        while len(long):
            # words of like length together, as many as have _CELLS characters
            fit = sizes[long] * np.arange(1, len(long) + 1) <= _CELLS
            some = long[: max(1, int(fit.sum()))]
            long = long[len(some) :]
            counts += self._expected_logs([words[i] for i in some], weights[some], probs)
        return counts

    def _expected(self, words: list[str], weights: np.ndarray, probs: np.ndarray) -> np.ndarray:
        n = max(map(len, words)) + 1
        alpha, beta = np.zeros((len(words), n)), np.zeros((len(words), n))
        ends = np.array([len(w) for w in words])
        steps = self.steps(words)
        alpha[:, 0] = 1
        for b, (w, a, piece) in steps:
            alpha[w, b] += alpha[w, a] * probs[piece]
        rows = np.arange(len(words))
        counts = np.zeros(len(probs))
        tiny = np.flatnonzero(alpha[rows, ends] < _LEAST)
        if len(tiny):
            counts += self._expected_logs([words[i] for i in tiny], weights[tiny], probs)
            alpha[tiny, ends[tiny]], weights = 1, weights.copy()
            weights[tiny] = 0
        beta[rows, ends] = weights / alpha[rows, ends]
        for b, (w, a, piece) in reversed(steps):
            flow = probs[piece] * beta[w, b]
            np.add.at(counts, piece, alpha[w, a] * flow)
            beta[w, a] += flow
        return counts

    def _expected_logs(self, words: list[str], weights: np.ndarray, probs: np.ndarray) -> np.ndarray:
        """The same in logarithms, for words whose probability would underflow."""
        logs = np.log(probs)
        ends = np.array([len(w) for w in words])
        alpha = np.full((len(words), ends.max() + 1), -np.inf)
        beta = alpha.copy()
        steps = self.steps(words)
        alpha[:, 0] = 0
        for b, (w, a, piece) in steps:
            alpha[w, b] = np.logaddexp(alpha[w, b], alpha[w, a] + logs[piece])
        rows = np.arange(len(words))
        beta[rows, ends] = -alpha[rows, ends]
        counts = np.zeros(len(probs))
        for b, (w, a, piece) in reversed(steps):
            flow = logs[piece] + beta[w, b]
            np.add.at(counts, piece, weights[w] * np.exp(alpha[w, a] + flow))
            beta[w, a] = np.logaddexp(beta[w, a], flow)
        return counts


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_counts(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, word, n) over a sample of labelled documents that are not held out."""
    known = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    ).select("lang", "text", F.xxhash64("doc_id", "text").alias("draw"))
    sizes = small(stage(known.groupBy("lang").agg(F.count("*").alias("n")), "sizes"))
    share = F.lit(float(2 * per_language)) / F.col("n")
    drawn = known.join(sizes, "lang").where(
        F.abs(F.col("draw") / float(1 << 63)) < share
    )
    first = Window.partitionBy("lang").orderBy("draw", "text")
    sample = drawn.withColumn("k", F.row_number().over(first)).where(F.col("k") <= per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                found.setdefault(lang.as_py(), Counter()).update(text_words(text.as_py()))
            rows = [(a, w, n) for a, c in found.items() for w, n in c.items()]
            langs, words, n = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())],
                names=["lang", "word", "n"],
            )

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame, pieces: list[str], per_language: int = PER_LANGUAGE, rounds: int = ROUNDS
) -> tuple[list[str], np.ndarray]:
    """Languages, and the probability of every piece (rows, `unk` last) in each.

    What reaches the driver is one number per piece and language.
    """
    spark = docs.sparkSession
    counts = stage(word_counts(docs, per_language), "words")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    lattice = Lattice(pieces)
    probs = np.full((lattice.unknown + 1, len(langs)), 1 / (lattice.unknown + 1))
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast((pieces, langs, probs))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces, langs, probs = shared.value
            lattice, total = Lattice(pieces), np.zeros(probs.shape)
            for batch in batches:
                lang = np.array(batch.column("lang").to_pylist())
                words = np.array(batch.column("word").to_pylist(), object)
                n = batch.column("n").to_numpy().astype(float)
                for k, name in enumerate(langs):
                    own = np.flatnonzero(lang == name)
                    for at in range(0, len(own), _TOGETHER):
                        some = own[at : at + _TOGETHER]
                        total[:, k] += lattice.expected(list(words[some]), n[some], probs[:, k])
            piece, k = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(k), pa.array(total[piece, k])],
                names=["piece", "lang", "n"],
            )

        rows = (
            counts.mapInArrow(expect, "piece long, lang long, n double")
            .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        )
        total = np.full(probs.shape, _SMOOTH)
        total[rows["piece"], rows["lang"]] += rows["n"]
        probs = total / total.sum(axis=0)
    return langs, probs


def predict(docs: DataFrame, pieces: list[str], langs: list[str], probs: np.ndarray):
    """(doc_id, held_out, lang_pred, score) of every row, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast((pieces, langs, probs))

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, langs, probs = shared.value
        lattice = Lattice(pieces)
        rows: dict[str, int] = {}
        table = np.zeros((_CACHE, len(langs)))

        def known(words: list[str]) -> None:
            """Put words into the table, which is emptied when it is full."""
            new = [w for w in words if w not in rows]
            if len(rows) + len(new) > _CACHE:
                rows.clear()
                new = words
            if new:
                table[len(rows) : len(rows) + len(new)] = lattice.log_likelihood(new, probs)
                rows.update(zip(new, range(len(rows), len(rows) + len(new)), strict=True))

        def total(found: Counter) -> np.ndarray:
            out, words = np.zeros(len(langs)), list(found)
            for at in range(0, len(words), _CACHE // 4):
                part = words[at : at + _CACHE // 4]
                if not all(w in rows for w in part):
                    known(part)
                n = np.array([found[w] for w in part], float)
                out += n @ table[[rows[w] for w in part]]
            return out

        for batch in (part for whole in batches for part in parts(whole)):
            named, scores = [], []
            counts = []
            for value in batch.column("text"):
                text = value.as_py()
                plain = langs and text and any(map(str.isalpha, text))
                counts.append(Counter(text_words(text)) if plain else None)
            words = list({w for c in counts if c for w in c})
            if len(words) <= _CACHE // 4:
                known(words)
            for found in counts:
                if found is None:
                    named.append("und")
                    scores.append(0.0)
                    continue
                logs = total(found)
                best = int(np.argmax(logs))
                named.append(langs[best])
                scores.append(1 / math.fsum(np.exp(logs - logs[best])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(named, pa.string()),
                    pa.array(scores, pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )
    return rows.mapInArrow(
        guess, "doc_id long, held_out boolean, lang_pred string, score double"
    )


def identify(docs: DataFrame, model_file: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Fit on `docs` (doc_id, text, lang) and predict all of its rows.

    Of a document only the text enters its prediction. lang_pred is a learned language
    (ties go to the first by code point) and score its probability among the learned ones,
    all equally likely beforehand. A text that is null or has no letter gives `und` with
    score 0, as do all texts when nothing could be learned. Rows without doc_id count as
    not held out. Words are lower-cased and cut at white space; words of any length
    are learned from and scored. An empty table gives an empty result.
    """
    pieces = pieces_of(model_file)
    langs, probs = fit(docs, pieces, per_language)
    return predict(docs, pieces, langs, probs)
