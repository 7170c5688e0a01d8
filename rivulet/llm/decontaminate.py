"""Benchmark passages in documents, by SimHash of item-sized windows.

A window is as many consecutive words of a document as an item has; a document with fewer
words is one window as a whole. Its fingerprint is the
SimHash of its shingles, each weighted by how often it occurs. Fingerprints are cut into
RADIUS + 1 blocks; two fingerprints within the radius agree on a whole block, so looking
every block up in a table of the items' blocks finds all of them. What is found is confirmed
by the exact similarity of the weighted shingles (sum of minima over sum of maxima).

Only windows that can reach the similarity are fingerprinted: such a window holds at least
`percent` of the item's shingles, which running counts over the places of item shingles
show. That skips no window that could be confirmed. For a pair at the limit of 0.8 the
expected distance is 10 bits with a deviation of 3, so a radius of 23 misses one in 10^5 of
those at the very limit, and none that are equal.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import parts, text_key, without_rows
from rivulet.llm.words import Words, grams, mix
from rivulet.util import stage

RADIUS = 23
# Text of items that one broadcast may hold; more are searched in several passes.
ITEM_BYTES = 8 << 20
_CUTS = [round(64 * k / (RADIUS + 1)) for k in range(RADIUS + 2)]
_MASK_BITS = 22


def simhash(shingles: np.ndarray, counts: np.ndarray | None = None) -> int:
    bits = ((mix(shingles)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(int)
    votes = (2 * bits - 1) * (1 if counts is None else counts[:, None])
    return int(((votes.sum(axis=0) > 0).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def blocks(fingerprint: int) -> Iterator[tuple[int, int]]:
    for k in range(RADIUS + 1):
        yield k, (fingerprint >> _CUTS[k]) & ((1 << (_CUTS[k + 1] - _CUTS[k])) - 1)


def similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """Shared and joint weight of two weighted shingle sets."""
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return shared, sum(a.values()) + sum(b.values()) - shared


class Items:
    """Benchmark items of equal shingle size, with their inverted shingles and blocks."""

    def __init__(self, ids: list[int], rows: list[np.ndarray], size: int):
        self.ids, self.size = ids, size
        self.lengths = [len(r) for r in rows]
        self.shingles = [grams(r, size) for r in rows]
        self.weights = [Counter(s.tolist()) for s in self.shingles]
        self.prints = [simhash(s) for s in self.shingles]
        self.table: dict[tuple[int, int, int], list[int]] = {}
        self.holders: dict[int, list[int]] = {}
        for k, fingerprint in enumerate(self.prints):
            for block in blocks(fingerprint):
                self.table.setdefault((self.lengths[k], *block), []).append(k)
            for s in self.weights[k]:
                self.holders.setdefault(s, []).append(k)
        known = np.array(sorted(self.holders), np.uint64)
        self.mask = np.zeros(1 << _MASK_BITS, bool)
        self.mask[known >> np.uint64(64 - _MASK_BITS)] = True

    def near(self, n_words: int, fingerprint: int) -> list[int]:
        """Items of `n_words` words within the radius, through their blocks."""
        found = {k for b in blocks(fingerprint) for k in self.table.get((n_words, *b), ())}
        return [k for k in found if (self.prints[k] ^ fingerprint).bit_count() <= RADIUS]

    def search(self, shingles: np.ndarray, percent: int):
        """(item, shared, joint, start, words) of the best window of each item in a document."""
        places: dict[int, list[int]] = {}
        for p in np.flatnonzero(self.mask[shingles >> np.uint64(64 - _MASK_BITS)]):
            for k in self.holders.get(int(shingles[p]), ()):
                places.setdefault(k, []).append(int(p))
        best: dict[int, tuple[int, int, int, int]] = {}
        done: set[tuple[int, int]] = set()
        for k, held in places.items():
            m = len(self.shingles[k])
            need = -(-percent * m // 100)
            if len(held) < need:
                continue
            at = np.array(held)
            # windows that begin where the needed hits fit in
            tail = at[need - 1 :]
            spans = np.stack([np.maximum(0, tail - m + 1), at[: len(tail)]], axis=1)
            spans = spans[spans[:, 0] <= spans[:, 1]]
            starts = np.unique(
                np.concatenate([np.arange(a, b + 1) for a, b in spans] or [np.zeros(0, int)])
            )
            # a document shorter than the item is its one window
            last = max(0, len(shingles) - m)
            for t in starts[starts <= last].tolist():
                if (t, m) in done:
                    continue
                done.add((t, m))
                own = shingles[t : t + m]
                weights = Counter(own.tolist())
                for j in self.near(m + self.size - 1, simhash(own)):
                    shared, joint = similarity(self.weights[j], weights)
                    if 100 * shared < percent * joint:
                        continue
                    old = best.get(j)
                    # the greatest similarity, then the first window
                    rank = shared * old[1] - old[0] * joint if old else 1
                    if rank > 0 or rank == 0 and t < old[2]:
                        best[j] = shared, joint, t, len(own) + self.size - 1
        for j in sorted(best):
            yield j, *best[j]


def item_groups(rows: list[tuple[int, str]], shingle: int) -> list[Items]:
    by_size: dict[int, tuple[list, list]] = {}
    for item_id, text in rows:
        hashes = Words(pa.array([text])).hashes(lower=True)
        if len(hashes):
            ids, words = by_size.setdefault(min(shingle, len(hashes)), ([], []))
            ids.append(item_id)
            words.append(hashes)
    return [Items(*by_size[size], size) for size in sorted(by_size)]


_FOUND = "doc_id long, text_key string, item_id long, similarity double, start long, n_words long"


def find_items(docs: DataFrame, items: DataFrame, shingle: int = 5, percent: int = 80):
    """Benchmark items found in documents: one row per row of `docs` and item.

    `docs` needs `doc_id` and `text`, `items` needs `item_id` and `text`; other columns are
    not looked at. Words are lower-cased in A-Z. An item with fewer words than a shingle is
    one shingle of its own length. Returns doc_id, text_key (md5 of the text), item_id,
    similarity, and start and n_words of the best window (the first of equals). A document
    shorter than an item is compared as a whole.

    Defined cases: items and documents that are null or have no words match nothing; a row
    without doc_id is searched like any other; repeated documents give repeated rows and
    repeated items (same id and text) give one; an empty table on either side gives an
    empty result. Items are broadcast in parts of at most ITEM_BYTES of text, with a pass
    over the documents for each part; a single item of more than that is a part alone.
    """
    spark = docs.sparkSession
    items = stage(
        items.where(F.col("text").isNotNull())
        .select(F.col("item_id").cast("long").alias("item_id"), "text")
        .distinct(),
        "items",
    )
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = -(-2 * volume // ITEM_BYTES) or 1
    share = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    found = None
    for k in range(passes):
        rows = [tuple(r) for r in items.where(share == k).collect()]
        one = _search(docs, spark.sparkContext.broadcast(rows), shingle, percent)
        found = one if found is None else found.unionByName(one)
    return found


def _search(docs: DataFrame, shared, shingle: int, percent: int) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = item_groups(shared.value, shingle)
        for batch in (part for whole in batches for part in parts(whole)):
            words = Words(batch.column("text"))
            hashes = words.hashes(lower=True)
            ids, keys = batch.column("doc_id"), batch.column("text_key")
            out: list[tuple] = []
            for items in groups:
                runs = grams(hashes, items.size)
                marked = np.concatenate(
                    [[0], np.cumsum(items.mask[runs >> np.uint64(64 - _MASK_BITS)])]
                )
                least = -(-percent * min(map(len, items.shingles)) // 100)
                first = np.minimum(words.first[:-1], len(runs))
                last = np.minimum(np.maximum(words.first[1:] - items.size + 1, first), len(runs))
                for i in np.flatnonzero(marked[last] - marked[first] >= least):
                    row = ids[i].as_py(), keys[i].as_py()
                    for j, n, joint, t, size in items.search(runs[first[i] : last[i]], percent):
                        out.append((*row, items.ids[j], n / joint, t, size))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["doc_id", "text_key", "item_id", "similarity", "start", "n_words"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", text_key("text").alias("text_key")
    )
    return rows.mapInArrow(search, _FOUND)


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`docs` without the rows in which an item is found; cases as for `find_items`."""
    found = stage(find_items(docs, items, **options).select("doc_id", "text_key").distinct(), "found")
    return without_rows(docs, found)
