"""Merkle manifest: a hash tree over documents, with a proof for every document.

Leaves are digests of rows. They are laid out in one total order by a range shuffle, so
that a source may be of any size; a node is known by `at`, the place of its tree's first
leaf plus its index on its level. On every level each node computes the indices of its
siblings from its slot, an equijoin brings their digests, and the rows of slot zero emit
the parents. Paths come back down by joins on the parent's index: a level at a time, with
no tree, source or list of nodes in one task or on the driver. Every level is written to
the shared folder. All of it is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import in_order, small
from rivulet.util import stage

ARITY = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEP = "array<struct<slot:int,run:binary>>"


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def row_digest(*values: Column) -> Column:
    """Digest of values: `-` for a null, else the UTF-8 byte count, `:` and the value."""
    parts = [v.cast("string") for v in values]
    marked = [
        F.when(p.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p))
        for p in parts
    ]
    return F.unhex(F.sha2(F.concat(*marked), 256))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(source, doc_id, leaf, given): digests of the rows and of the rows as received."""
    fields = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars").cast("long")]
    leaf = row_digest(*fields, F.col("text"))
    changed = row_digest(*fields, F.translate("text", _UPPER, _LOWER))
    return docs.select(
        F.col("source").cast("string").alias("source"), fields[0].alias("doc_id"),
        leaf.alias("leaf"), F.when(tampered, changed).alias("given"),
    )


def placed(ordered: DataFrame) -> DataFrame:
    """Rows of `in_order` by source with `start`, the place of the source's first row, and
    `width`, its rows; `at` becomes the place in the whole order, without gaps.

    Rows meet their source's numbers by (partition, source), so no source is in one task.
    """
    part, place = F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    pairs = stage(
        ordered.groupBy(part, "source").agg(F.count("*").alias("n"), F.min(place).alias("first")),
        "pairs",
    )
    parts = pairs.groupBy("part").agg(F.sum("n").alias("m"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("m").over(upto), F.lit(0)).alias("before"))
    whole = Window.partitionBy("source")  # a row per range partition at most
    spans = pairs.join(F.broadcast(parts), "part").select(
        F.col("part").alias("p"), F.col("source").alias("s"), "before",
        F.min(F.col("before") + F.col("first")).over(whole).alias("start"),
        F.sum("n").over(whole).alias("width"),
    )
    spans = stage(spans, "spans")
    met = (F.shiftright("at", 33) == F.col("p")) & F.col("source").eqNullSafe(F.col("s"))
    return ordered.join(small(spans), met).withColumn("at", F.col("before") + place).drop("p", "s", "before")


def runs(nodes: DataFrame) -> DataFrame:
    """Nodes of a level with `run`, the digests of all nodes that share their parent.

    `nodes`: at, start, width, digest and `own`, a struct that stays with its node.
    """
    base = F.col("at") - (F.col("at") - F.col("start")) % ARITY
    last = F.least(base + (ARITY - 1), F.col("start") + F.col("width") - 1)
    wanted = nodes.select("at", "start", "width", "own", F.explode(F.sequence(base, last)).alias("sibling"))
    wanted = wanted.withColumn("own", F.when(F.col("sibling") == F.col("at"), F.col("own")))
    met = wanted.join(nodes.select(F.col("at").alias("sibling"), "digest"), "sibling")
    run = F.array_sort(F.collect_list(F.struct("sibling", "digest")))
    joined = F.aggregate(run, F.lit(b""), lambda a, x: F.concat(a, x["digest"]))
    return met.groupBy("at", "start", "width").agg(F.max("own").alias("own"), joined.alias("run"))


def tree(nodes: DataFrame, widest: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels of all trees below their roots, and (start, digest, level) of the roots.

    `nodes` are the leaves, `widest` the most leaves that a tree has.
    """
    levels: list[DataFrame] = []
    roots = []
    while True:
        roots.append(
            nodes.where("width = 1").select("start", "digest", F.lit(len(levels)).alias("level"))
        )
        if widest <= 1:
            break
        levels.append(stage(runs(nodes.where("width > 1")), "level"))
        widest = -(-widest // ARITY)
        index = (F.col("at") - F.col("start")) / ARITY
        nodes = levels[-1].where((F.col("at") - F.col("start")) % ARITY == 0).select(
            (F.col("start") + F.floor(index)).alias("at"), "start",
            F.ceil(F.col("width") / ARITY).alias("width"),
            F.unhex(F.sha2(_text(F.col("run")), 256)).alias("digest"),
            F.lit(None).cast("struct<doc_id:bigint>").alias("own"),
        )
    return levels, stage(reduce(DataFrame.unionByName, roots), "roots")


def descend(levels: list[DataFrame], tops: DataFrame, carried: list[str]) -> DataFrame:
    """(at, own, path, *carried) of the leaves below at least one parent.

    `tops`: start, level, path of every tree's root; `path` lists slot and run from a node
    up. `carried` columns of a root come down to its leaves.
    """
    above = None
    for level in reversed(range(len(levels))):
        ended = tops.where(F.col("level") == level + 1).select(F.col("start").alias("up"), "path", *carried)
        above = ended if above is None else ended.unionByName(above)
        index = F.col("at") - F.col("start")
        step = F.struct((index % ARITY).cast("int").alias("slot"), "run")
        below = levels[level].withColumn("up", F.col("start") + F.floor(index / ARITY))
        below = below.join(above, "up").select(
            "at", "own", F.concat(F.array(step), F.col("path")).alias("path"), *carried
        )
        above = below.select(F.col("at").alias("up"), "path", *carried) if level else below
    return above


def _left(step: Column) -> Column:
    return F.substring(_text(step["run"]), F.lit(1), 64 * step["slot"])


def _right(step: Column) -> Column:
    return F.substring(_text(step["run"]), 64 * step["slot"] + 65, F.lit(64 * ARITY))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level, left to right."""
    siblings = F.transform(path, lambda s: F.concat(_left(s), _right(s)))
    return F.sha2(F.array_join(siblings, ""), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(
        path, _text(digest), lambda a, s: F.sha2(F.concat(_left(s), a, _right(s)), 256)
    )


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """Leaf, subroot, root, proof and verification of every row.

    `docs` needs doc_id, source, lang, n_chars and text, and is read from storage; other
    columns are not looked at. `tampered` says of which rows the text arrives with A-Z in
    lower case. Per source, leaves ascend by doc_id (null first), equal ids by digest;
    runs of 16 nodes, the last one shorter, become their parent until one is left, the
    subroot. Subroots ascend by source (null first, bytewise) and give the root likewise.

    Returns doc_id, leaf, subroot, root, proof_sha256 (of the path's siblings), folded_root
    (from the row as received and the path) and verified (folded_root is root), digests as
    lower-case hex.

    Defined cases: nulls are `-` in a digest, unlike any text; null sources are one source;
    null doc_id are leaves like any other, and a null in `tampered` is no. Repeated rows
    are leaves each. A lone leaf is its subroot, with the proof of the levels above only; a
    lone row's proof is the digest of nothing. An empty table gives an empty result.
    """
    made = in_order(leaves(docs, tampered), "source", "doc_id", "leaf")
    nodes = stage(
        placed(made).select(
            "at", "start", "width", F.col("leaf").alias("digest"),
            F.struct("doc_id", "leaf", "given").alias("own"),
        ),
        "leaves",
    )
    levels, subroots = tree(nodes, nodes.agg(F.max("width")).first()[0] or 0)

    upper = in_order(subroots, "start").withColumn("source", F.lit(None).cast("string"))
    upper = stage(
        placed(upper.withColumnRenamed("start", "tree")).select(
            "at", "start", "width", "digest", F.struct("tree", "level", "digest").alias("own")
        ),
        "upper",
    )
    upper_levels, root = tree(upper, upper.agg(F.max("width")).first()[0] or 0)
    top = root.select("start", "level", F.array().cast(_STEP).alias("path"), _text(F.col("digest")).alias("root"))
    lone = upper.where("width = 1").select("own", F.array().cast(_STEP).alias("path"), _text(F.col("digest")).alias("root"))
    below = descend(upper_levels, top, ["root"]) if upper_levels else lone
    tops = stage(
        below.select(
            F.col("own.tree").alias("start"), "own.level", "path", "root",
            _text(F.col("own.digest")).alias("subroot"),
        ),
        "tops",
    )

    alone = nodes.where("width = 1").join(tops.where("level = 0"), "start")
    found = alone.select("own", "path", "root", "subroot")
    if levels:
        found = found.unionByName(descend(levels, tops, ["root", "subroot"]).drop("at"))
    given = F.coalesce(F.col("own.given"), F.col("own.leaf"))
    return found.select(
        F.col("own.doc_id").alias("doc_id"), _text(F.col("own.leaf")).alias("leaf"), "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"), fold(given, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
