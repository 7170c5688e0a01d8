"""Near-duplicate groups by b-bit MinHash.

Of every document's set of word shingles, 128 minima are taken. Runs of four minima hash to
32 band keys, and two low bits of every minimum are packed into four longs. Documents that
share a band key are candidates; counting equal bit pairs estimates their similarity,
corrected for the one in four that agree by chance; pairs not far below the limit are
confirmed on full shingle sets.

A bucket is never expanded into its pairs. Copies (equal word sequences) are one node from
the start. Each bucket's best-connected node is compared with the others; what that links
is contracted. Only in buckets that still hold several components are nodes of different
components compared, by longer signatures (1024 minima, four bits each) that are part of the
join, so that a pair leaves the join once and only if it is about to be confirmed. A link
whose ends are already in one component cannot change the result, so no component is lost.

A pair at the limit of 0.8 shares no band with probability (1 - 0.8^4)^32 = 5e-8; the
estimates' margins, six and 4.75 standard errors, lose one in 10^6 of such pairs at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import arrow_map, small, text_key, without_rows
from rivulet.llm.words import Words, digest, grams, mix, signed
from rivulet.operators.graph import components
from rivulet.util import stage

HASHES, ROWS, BITS = 128, 4, 2
BANDS = HASHES // ROWS
FINE_HASHES, FINE_BITS = 1024, 4
_FINE = [f"f{k}" for k in range(FINE_HASHES * FINE_BITS // 64)]
_SEEDS = mix(np.arange(1, 2 * FINE_HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TIMES, _PLUS = _SEEDS[:FINE_HASHES, None] | np.uint64(1), _SEEDS[FINE_HASHES:, None]
_BLOCK = 2048


def shingle_sets(texts: pa.Array, size: int):
    """Sorted distinct shingle hashes and the digest of the words, text by text."""
    found = Words(texts)
    hashes = found.hashes(lower=True)
    shingles = grams(hashes, size)
    for low, high in zip(found.first[:-1], found.first[1:], strict=True):
        own = digest(hashes[low:high])
        if high - low >= size:
            yield np.unique(shingles[low : high - size + 1]), own
        elif high > low:
            yield np.frombuffer(own[:8], np.uint64), own
        else:
            yield np.zeros(0, np.uint64), own


def minima(shingles: np.ndarray, hashes: int = HASHES) -> np.ndarray:
    least = np.full(hashes, np.iinfo(np.uint64).max, np.uint64)
    times, plus = _TIMES[:hashes], _PLUS[:hashes]
    for at in range(0, len(shingles), _BLOCK):
        part = (shingles[None, at : at + _BLOCK] * times + plus).min(axis=1)
        np.minimum(least, part, out=least)
    return least


def packed(least: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Rows of minima as rows of 64-bit lanes of low bits (taken above bit 20)."""
    low = (least >> np.uint64(20)) & np.uint64(2**bits - 1)
    shifts = np.arange(64 // bits, dtype=np.uint64) * np.uint64(bits)
    return (low.reshape(len(least), -1, 64 // bits) << shifts).sum(axis=2, dtype=np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(len(least), BANDS, ROWS)
    keys = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64)), rows.shape[:2]).copy()
    for r in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return keys


_SIGNED = "doc_id long, text_key string, node binary, n_shingles long, s0 long, s1 long, s2 long, s3 long, bands array<long>"


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """One row per document: its node (digest of the words), set size, lanes, band keys."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        nodes, sizes, least = [], [], []
        for shingles, own in shingle_sets(batch.column("text"), size):
            nodes.append(own)
            sizes.append(len(shingles))
            least.append(minima(shingles))
        least = np.stack(least)
        lanes, keys = packed(least), band_keys(least)
        offsets = np.arange(len(nodes) + 1, dtype=np.int32) * BANDS
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(nodes, pa.binary()),
                pa.array(sizes, pa.int64()),
                *(pa.array(signed(np.ascontiguousarray(lanes[:, k]))) for k in range(4)),
                pa.ListArray.from_arrays(offsets, signed(keys.reshape(-1))),
            ],
            names=["doc_id", "text_key", "node", "n_shingles", "s0", "s1", "s2", "s3", "bands"],
        )

    rows = docs.select(F.col("doc_id").cast("long"), "text", text_key("text").alias("text_key"))
    return arrow_map(rows, sign, _SIGNED)


def estimate(a: str, b: str, names: list[str], hashes: int, bits: int) -> Column:
    """Similarity from the share of equal low bits, corrected for chance."""
    ones = sum(1 << k for k in range(0, 64, bits))
    unequal = F.lit(0)
    for name in names:
        x = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
        either = x
        for k in range(1, bits):
            either = either.bitwiseOR(F.shiftrightunsigned(x, k))
        unequal = unequal + F.bit_count(either.bitwiseAND(F.lit(ones)))
    chance = 0.5**bits
    return (1 - unequal / hashes - chance) / (1 - chance)


def cut(percent: int, hashes: int, bits: int, errors: float) -> float:
    """The limit less some standard errors of the estimate."""
    limit, chance = percent / 100, 0.5**bits
    agree = limit + (1 - limit) * chance
    return limit - errors * (agree * (1 - agree) / hashes) ** 0.5 / (1 - chance)


def texts_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Texts of nodes; a text is there twice if its row is."""
    listed = stage(nodes.join(wanted, "node").select("doc_id", "text_key"), "wanted")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", text_key("text").alias("text_key")
    )
    return keyed.alias("d").join(
        small(listed).alias("w"),
        F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))
        & (F.col("d.text_key") == F.col("w.text_key")),
        "left_semi",
    ).select("text")


def confirm(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int):
    """Those of (x, y) whose full sets are similar enough; reads only the texts needed."""

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(shingle_sets(batch.column("text"), size))
        offsets = np.concatenate([[0], np.cumsum([len(s) for s, _ in found])]).astype(np.int32)
        values = np.concatenate([s for s, _ in found])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([own for _, own in found], pa.binary()),
                pa.ListArray.from_arrays(offsets, signed(values)),
            ],
            names=["node", "shingles"],
        )

    ends = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()
    texts = texts_of(ends, docs, nodes)
    own = stage(arrow_map(texts, sets, "node binary, shingles array<long>"), "sets")
    own = own.dropDuplicates(["node"])
    shared = F.size(F.array_intersect("sx", "sy"))
    return (
        pairs.select("x", "y")
        .join(own.select(F.col("node").alias("x"), F.col("shingles").alias("sx")), "x")
        .join(own.select(F.col("node").alias("y"), F.col("shingles").alias("sy")), "y")
        .where(100 * shared >= percent * (F.size("sx") + F.size("sy") - shared))
        .select("x", "y")
    )


def fine_lanes(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, f0, f1, ...): the longer signatures of some nodes."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(shingle_sets(batch.column("text"), size))
        least = np.stack([minima(s, FINE_HASHES) for s, _ in found])
        lanes = packed(least, FINE_BITS)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([own for _, own in found], pa.binary()),
                *(pa.array(signed(np.ascontiguousarray(x))) for x in lanes.T),
            ],
            names=["node", *_FINE],
        )

    schema = ", ".join(["node binary", *(f"{f} long" for f in _FINE)])
    return arrow_map(texts_of(wanted, docs, nodes), sign, schema).dropDuplicates(["node"])


def bridges(placed: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int):
    """Candidates (x, y) of different components, from rows of (key, node, root).

    Only buckets that hold several components count. A pair is made in the least of the
    buckets it shares, and only if the longer signatures leave it a chance.
    """
    keys = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    keys = stage(keys.where("lo <> hi").select("key"), "mixed-keys")
    mixed = stage(placed.join(small(keys), "key"), "mixed")
    per_node = mixed.groupBy("node").agg(F.collect_set("key").alias("keys"))
    fine = fine_lanes(per_node.select("node"), docs, nodes, size)
    full = stage(mixed.join(per_node.join(fine, "node"), "node"), "fine")
    similar = estimate("a", "b", _FINE, FINE_HASHES, FINE_BITS) >= cut(
        percent, FINE_HASHES, FINE_BITS, 4.75
    )
    return (
        full.alias("a")
        .join(
            full.alias("b"),
            (F.col("a.key") == F.col("b.key"))
            & (F.col("a.node") < F.col("b.node"))
            & (F.col("a.root") != F.col("b.root"))
            & similar
            & (F.array_min(F.array_intersect("a.keys", "b.keys")) == F.col("a.key")),
        )
        .select(F.col("a.node").alias("x"), F.col("b.node").alias("y"))
    )


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by 100 * |A and B| >= percent * |A or B|.

    `docs` needs `doc_id` and `text`; other columns are not looked at. Words are lower-cased
    in A-Z; a set holds the distinct runs of `shingle` words, of shorter texts the whole.
    Returns per row doc_id, text_key (md5 of the text), n_shingles, component_id, group_key
    (the chosen row's text_key, so a name of the group also where ids are null) and `chosen`: of each group the row with the least doc_id (then the least digest) is chosen.

    Defined cases: texts that are null or without words are linked with nothing and stay
    alone; rows without doc_id take part, and come after all others when a group's row is
    chosen; component_id is the least doc_id of the group and null only if it has none;
    rows repeated with the same doc_id and text get equal results. An empty table gives an
    empty result.
    """
    signs = stage(signatures(docs, shingle), "signatures")
    lanes = ["s0", "s1", "s2", "s3"]
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_key"))
    heads = (
        signs.where("n_shingles > 0").groupBy("node")
        .agg(least.alias("head"), *(F.first(c).alias(c) for c in lanes))
    )
    nodes = stage(
        heads.select("node", "head.doc_id", "head.text_key", *lanes), "nodes"
    )
    keys = (
        signs.where("n_shingles > 0").select("node", "bands").dropDuplicates(["node"])
        .select("node", F.explode("bands").alias("key"))
    )
    keys = stage(keys, "keys")
    # written down first, so that the join can broadcast it or split hot keys
    shared = stage(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    members = stage(keys.join(small(shared), "key"), "members")
    popular = members.groupBy("node").agg(F.sum("n").alias("weight"))
    members = stage(
        members.select("key", "node").join(popular, "node")
        .join(nodes.select("node", *lanes), "node"),
        "weighed",
    )
    best = members.groupBy("key").agg(
        F.max(F.struct("weight", "node", *lanes)).alias("best")
    )
    likely = estimate("a", "b", lanes, HASHES, BITS) >= cut(percent, HASHES, BITS, 6)
    stars = (
        members.alias("a")
        .join(best.select("key", F.col("best").alias("b")), "key")
        .where(F.col("a.node") != F.col("b.node"))
        .where(likely)
        .select(
            F.least("a.node", "b.node").alias("x"), F.greatest("a.node", "b.node").alias("y")
        )
        .distinct()
    )
    stars = stage(stars, "stars")
    linked = stage(confirm(stars, docs, nodes, shingle, percent), "links")
    roots = components(linked)
    placed = members.select("key", "node").join(roots, "node", "left")
    placed = stage(placed.withColumn("root", F.coalesce("root", "node")), "placed")
    rest = bridges(placed, docs, nodes, shingle, percent)
    rest = stage(rest.join(stars, ["x", "y"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = stage(confirm(rest, docs, nodes, shingle, percent), "links")
        if not more.isEmpty():
            roots = components(linked.unionByName(more))
    grouped = nodes.select(
        "node", F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_key").alias("head")
    ).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    top = grouped.groupBy("root").agg(F.min("head").alias("top"))
    label = stage(grouped.join(top, "root").select("node", "top"), "labels")
    alone = F.col("top").isNull()
    return (
        signs.select("doc_id", "text_key", "n_shingles", "node")
        .join(label, "node", "left")
        .select(
            "doc_id",
            "text_key",
            "n_shingles",
            F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("component_id"),
            F.when(alone, F.col("text_key")).otherwise(F.col("top.text_key")).alias("group_key"),
            (
                alone
                | (
                    F.col("doc_id").eqNullSafe(F.col("top.doc_id"))
                    & (F.col("text_key") == F.col("top.text_key"))
                )
            ).alias("chosen"),
        )
    )


def text_groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """(text_key, group_key) of the distinct texts that are not the chosen one of their group."""
    found = near_duplicates(docs, shingle, percent).select("text_key", "group_key")
    return stage(found.where("text_key <> group_key").distinct(), "groups")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one row of each group of near-duplicates, the one that is chosen.

    All columns are kept. Rows repeated with the same doc_id and text are one group too;
    which of them stays is left open. Texts without words all stay.
    """
    found = stage(near_duplicates(docs, shingle, percent), "decided")
    gone = stage(found.where("not chosen").select("doc_id", "text_key").distinct(), "gone")
    kept = without_rows(docs, gone)
    again = stage(
        found.where("chosen and n_shingles > 0").groupBy("doc_id", "text_key").count()
        .where("count > 1").drop("count"),
        "again",
    )
    if again.isEmpty():
        return kept
    marked = kept.withColumn("_text_key", text_key("text"))
    met = (
        marked.alias("d").join(
            small(again).alias("g"),
            F.col("d.doc_id").cast("long").eqNullSafe(F.col("g.doc_id"))
            & (F.col("d._text_key") == F.col("g.text_key")),
            "left_semi",
        )
    )
    return without_rows(kept, again).unionByName(
        met.dropDuplicates(["doc_id", "_text_key"]).drop("_text_key")
    )
