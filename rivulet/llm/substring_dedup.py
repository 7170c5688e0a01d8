"""Removal of word passages that occur more than once, by anchors and suffix automata.

A window is `size` consecutive words of one document. A word goes if some window over it has
a word sequence that also starts anywhere else in the table. The decision is exact and made
on the input.

Every window has an anchor: of the runs of eight words in it, the one with the least hash.
Equal windows have equal anchors, so only windows whose anchor occurs twice can repeat, and
windows need only be compared below one anchor. About one word in fourteen is an anchor.

1. Documents of equal words become one node; a node with copies repeats as a whole.
2. Anchors are counted, combined before the shuffle.
3. Windows below an anchor with up to COLD occurrences meet in one sorted partition, where
   equal ones are flagged in a scan that holds one anchor's windows at a time.
4. Below more frequent anchors, the passages that occur most become reference shards: of at
   most SHARD_WORDS words each and SHARDS in number, so that the broadcast has a fixed
   bound. Each shard is a suffix automaton; the documents' passages stream through the
   automata, whose matching statistics give the spans of `size` words or more. Windows that
   no shard holds are counted by hash, combined before the shuffle, and joined back.

Streaming every document past automata of the whole corpus would be quadratic (documents
times shards), so the automata take the frequent passages and exact hashes the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_map, text_key
from rivulet.llm.words import Words, digest, grams, long_grams, mix, signed
from rivulet.util import stage

ANCHOR = 8
COLD = 256
SHARD_WORDS, SHARDS = 50_000, 4
_INDEX = np.uint64((1 << 26) - 1)


def anchors(hashes: np.ndarray, size: int, block: int = 1 << 24) -> tuple[np.ndarray, np.ndarray]:
    """For the window at every word: hash and place of its anchor (the first of equals).

    Windows are taken `block` at a time, so that places within a block fit the low bits."""
    runs = grams(hashes, ANCHOR)
    span = size - ANCHOR + 1
    count = len(runs) - span + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    places = np.empty(count, np.int64)
    for low in range(0, count, block):
        part = runs[low : low + min(block, count - low) + span - 1]
        least = (part & ~_INDEX) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        places[low : low + len(least)] = low + (least & _INDEX).astype(np.int64)
    return runs[places], places


def _runs(first: np.ndarray, places: np.ndarray, size: int):
    """Per document with a window: its index and bounds of runs of windows of one anchor."""
    for i in range(len(first) - 1):
        low, high = int(first[i]), int(first[i + 1]) - size + 1
        if high > low:
            turns = np.flatnonzero(np.diff(places[low:high])) + 1
            yield i, np.concatenate([[low], low + turns, [high]])


def facts(docs: DataFrame, size: int) -> DataFrame:
    """Per row: doc_id, text_key, node, n_words and the anchors of its windows."""

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Words(batch.column("text"))
        hashes, first = found.hashes(), found.first
        values, places = anchors(hashes, size)
        lists = [np.zeros(0, np.uint64)] * len(found)
        for i, bounds in _runs(first, places, size):
            lists[i] = values[bounds[:-1]]
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
        nodes = [digest(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(nodes, pa.binary()),
                pa.array(found.counts().astype(np.int64)),
                pa.ListArray.from_arrays(offsets, signed(np.concatenate(lists))),
            ],
            names=["doc_id", "text_key", "node", "n_words", "anchors"],
        )

    return arrow_map(
        docs,
        describe,
        "doc_id long, text_key string, node binary, n_words long, anchors array<long>",
    )


def windows(chosen: DataFrame, size: int) -> DataFrame:
    """Rows of (anchor, node, start): hashes of the windows, or the words if it is hot."""

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Words(batch.column("text"))
        hashes, first = found.hashes(), found.first
        values, places = anchors(hashes, size)
        whole = long_grams(hashes, size)[0]
        cold, hot = batch.column("cold"), batch.column("hot")
        nodes = batch.column("node")
        rows: dict[str, list] = {"anchor": [], "node": [], "start": [], "windows": [], "words": []}
        for i, bounds in _runs(first, places, size):
            own = values[bounds[:-1]]
            for wanted, column in ((cold[i].values, "windows"), (hot[i].values, "words")):
                if wanted is None or not len(wanted):
                    continue
                keep = np.isin(own, wanted.to_numpy(zero_copy_only=False).view(np.uint64))
                for r in np.flatnonzero(keep):
                    low, high = int(bounds[r]), int(bounds[r + 1])
                    rows["anchor"].append(own[r])
                    rows["node"].append(nodes[i].as_py())
                    rows["start"].append(low - int(first[i]))
                    rows["windows"].append(None)
                    rows["words"].append(None)
                    rows[column][-1] = (
                        whole[low:high] if column == "windows" else hashes[low : high + size - 1]
                    )
        return pa.RecordBatch.from_arrays(
            [
                pa.array(signed(np.array(rows["anchor"], np.uint64))),
                pa.array(rows["node"], pa.binary()),
                pa.array(rows["start"], pa.int64()),
                _lists(rows["windows"]),
                _lists(rows["words"]),
            ],
            names=list(rows),
        )

    return arrow_map(
        chosen,
        cut,
        "anchor long, node binary, start long, windows array<long>, words array<long>",
    )


def _lists(parts: list) -> pa.Array:
    """Arrays of longs with nulls."""
    sizes = [0 if x is None else len(x) for x in parts]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    full = [x for x in parts if x is not None]
    values = signed(np.concatenate(full)) if full else np.zeros(0, np.int64)
    mask = pa.array([x is None for x in parts], pa.bool_())
    return pa.ListArray.from_arrays(offsets, pa.array(values), mask=mask)


_SPANS = "node binary, low long, high long"


def _flagged(flags: np.ndarray, start: int, size: int) -> Iterator[tuple[int, int]]:
    """Word spans under runs of flagged windows."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    for low, high in zip(edges[::2], edges[1::2], strict=True):
        yield start + int(low), start + int(high) - 1 + size


def _spans(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    nodes, low, high = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.binary()), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
        names=["node", "low", "high"],
    )


def repeated_cold(runs: DataFrame, size: int) -> DataFrame:
    """Spans of windows that occur twice below their anchor."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        lists = table.column("windows").combine_chunks()
        starts = table.column("start").to_numpy()
        offsets = np.asarray(lists.offsets)
        values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
        anchor = table.column("anchor").to_numpy().view(np.uint64)
        owner = np.repeat(np.arange(len(starts)), np.diff(offsets))
        both = mix(mix(anchor)[owner] + values)
        _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        nodes, rows = table.column("node"), []
        for r in np.unique(owner[twice]):
            for span in _flagged(twice[offsets[r] : offsets[r + 1]], int(starts[r]), size):
                rows.append((nodes[int(r)].as_py(), *span))
        return _spans(rows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]) if kept is not None else table
            anchor = table.column("anchor").to_numpy()
            whole = int(np.searchsorted(anchor, anchor[-1]))
            if whole:
                yield settle(table.slice(0, whole).combine_chunks())
            kept = table.slice(whole).combine_chunks()
        if kept is not None:
            yield settle(kept)

    laid = runs.repartition("anchor").sortWithinPartitions("anchor")
    return laid.mapInArrow(scan, _SPANS)


class SuffixAutomaton:
    """All substrings of some word sequences; sequences are kept apart by marks."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for mark, sequence in enumerate(sequences):
            for word in (*sequence, ("end", mark)):
                last = self._add(last, word)

    def _add(self, last: int, word) -> int:
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at != -1:
            to = self.next[at][word]
            if self.length[to] == self.length[at] + 1:
                self.link[new] = to
            else:
                twin = len(self.next)
                self.next.append(dict(self.next[to]))
                self.link.append(self.link[to])
                self.length.append(self.length[at] + 1)
                while at != -1 and self.next[at].get(word) == to:
                    self.next[at][word] = twin
                    at = self.link[at]
                self.link[to] = self.link[new] = twin
        return new

    def matches(self, words: list[int]) -> list[int]:
        """Matching statistics: length of the longest match that ends at each word."""
        at, size, out = 0, 0, []
        for word in words:
            while at and word not in self.next[at]:
                at = self.link[at]
                size = self.length[at]
            if word in self.next[at]:
                at = self.next[at][word]
                size += 1
            out.append(size)
        return out


def shards(hot: DataFrame, size: int, n_words: int = SHARD_WORDS, n_shards: int = SHARDS):
    """The most frequent passages that occur twice or more, as lists of at most `n_words`."""
    top = (
        hot.groupBy("words").agg(F.count("*").alias("n")).where("n > 1")
        .orderBy(F.desc("n"), "words")
        .limit(n_words * n_shards // size)
        .collect()
    )
    out: list[list[list[int]]] = [[]]
    room = n_words
    for row in top:
        if len(row.words) > room:
            if len(out) == n_shards:
                break
            out.append([])
            room = n_words
        out[-1].append(row.words)
        room -= len(row.words)
    return [x for x in out if x]


def repeated_hot(hot: DataFrame, size: int) -> DataFrame:
    """Spans of repeated windows below frequent anchors."""
    spark = hot.sparkSession
    reference = spark.sparkContext.broadcast(shards(hot, size))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [SuffixAutomaton(x) for x in reference.value]
        for batch in batches:
            nodes, starts = batch.column("node"), batch.column("start").to_pylist()
            anchor = batch.column("anchor").to_pylist()
            known: dict[tuple, np.ndarray] = {}
            out: dict[str, list] = {x: [] for x in ("node", "low", "high", "anchor", "window")}

            def put(*row, out=out):
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)

            for r, words in enumerate(batch.column("words")):
                own = tuple(words.as_py())
                if own not in known:
                    ends = np.zeros(len(own), np.int64)
                    for automaton in automata:
                        ends = np.maximum(ends, automaton.matches(own))
                    known[own] = ends[size - 1 :] >= size
                flags, node = known[own], nodes[r].as_py()
                for low, high in _flagged(flags, starts[r], size):
                    put(node, low, high, None, None)
                if not flags.all():
                    rest = long_grams(np.array(own, np.int64).view(np.uint64), size)[0]
                    for j in np.flatnonzero(~flags):
                        low = starts[r] + int(j)
                        put(node, low, low + size, anchor[r], int(signed(rest[j : j + 1])[0]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["node"], pa.binary()),
                    *(pa.array(out[c], pa.int64()) for c in ("low", "high", "anchor", "window")),
                ],
                names=list(out),
            )

    streamed = stage(
        hot.mapInArrow(stream, _SPANS + ", anchor long, window long"), "streamed"
    )
    rest = streamed.where("window is not null")
    twice = rest.groupBy("anchor", "window").agg(F.count("*").alias("n")).where("n > 1")
    return (
        streamed.where("window is null")
        .select("node", "low", "high")
        .unionByName(
            rest.join(twice, ["anchor", "window"], "left_semi").select("node", "low", "high")
        )
    )


def repeated_passages(docs: DataFrame, size: int = 35) -> DataFrame:
    """(text_key, spans, whole): the word spans to remove, for texts that have any.

    `whole` marks texts of at least `size` words whose words are those of another row.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", text_key("text").alias("text_key")
    )
    seen = stage(facts(keyed, size), "facts").where(F.col("n_words") >= size)
    nodes = seen.groupBy("node").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_key")).alias("head")
    )
    nodes = stage(nodes.select("node", "copies", "head.doc_id", "head.text_key"), "nodes")
    held = stage(
        seen.select("node", "anchors").dropDuplicates(["node"])
        .select("node", F.explode("anchors").alias("anchor")),
        "anchors",
    )
    counted = held.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    lists = (
        held.join(counted, "anchor").groupBy("node")
        .agg(
            F.collect_set(F.when(F.col("n") <= COLD, F.col("anchor"))).alias("cold"),
            F.collect_set(F.when(F.col("n") > COLD, F.col("anchor"))).alias("hot"),
        )
    )
    wanted = stage(lists.join(nodes.drop("copies"), "node"), "wanted")
    chosen = keyed.alias("d").join(
        wanted.alias("w"),
        (F.col("d.text_key") == F.col("w.text_key"))
        & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")),
    )
    runs = stage(windows(chosen.select("d.text", "w.node", "w.cold", "w.hot"), size), "runs")
    spans = repeated_cold(
        runs.where("windows is not null").select("anchor", "node", "start", "windows"), size
    ).unionByName(
        repeated_hot(
            runs.where("words is not null").select("anchor", "node", "start", "words"), size
        )
    )
    spans = spans.groupBy("node").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    found = nodes.select("node", "copies").join(spans, "node", "left").where(
        "copies > 1 or spans is not null"
    )
    return (
        seen.select("text_key", "node").distinct().join(found, "node")
        .select("text_key", "spans", (F.col("copies") > 1).alias("whole"))
    )


_CLEAN = "doc_id long, n_words long, n_removed long, kept_sha256 string, text string"


def remove_repeated(docs: DataFrame, size: int = 35) -> DataFrame:
    """Documents without the words under windows of `size` words that occur elsewhere too.

    `docs` needs `doc_id` and `text`; other columns are not looked at. Returns a row per
    row: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)
    and text (those words). A null text has no words and counts as the empty text; texts
    shorter than a window are kept; rows repeated with the same doc_id are rows like any
    others, so each is the other's copy; an empty table gives an empty result.
    """
    found = stage(repeated_passages(docs, size), "spans")

    def strip(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(batch.column("text"))
        data = words.data.tobytes()
        removed, shas, texts = [], [], []
        spans, whole = batch.column("spans").to_pylist(), batch.column("whole").to_pylist()
        for i in range(len(words)):
            low, high = int(words.first[i]), int(words.first[i + 1])
            keep = np.full(high - low, not whole[i])
            for span in spans[i] or ():
                keep[span["low"] : span["high"]] = False
            starts, ends = words.starts[low:high][keep], words.ends[low:high][keep]
            kept = b" ".join(
                [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            )
            removed.append(high - low - len(starts))
            shas.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(words.counts().astype(np.int64)),
                pa.array(removed, pa.int64()),
                pa.array(shas, pa.string()),
                pa.array(texts, pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "text"],
        )

    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", text_key("text").alias("text_key")
    )
    return arrow_map(
        keyed.join(found, "text_key", "left").select(
            "doc_id", "text", "spans", F.coalesce("whole", F.lit(False)).alias("whole")
        ),
        strip,
        _CLEAN,
    )
