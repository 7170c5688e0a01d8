"""Mixing sources to target weights by pivotal rounding of copy numbers.

A source's target over its size is the rate at which its documents are copied. The whole
part of a document's copies is fixed; its fraction is rounded to 0 or 1 by the pivotal
method: two units meet, and words move from one to the other, at random but with unchanged
expectations, until one unit's fraction is 0 or 1. The words of the two together stay the
same, so a source's words differ from its target by part of its last unit only. What is
left of the other unit meets the next.

Units meet in blocks of about BLOCK units of one source, the longest first, so that the
short ones are left; a block leaves one undecided unit at most. These meet in the next
round, until a source has one left, which is drawn. A round shuffles only what the one
before left undecided, and its decisions are final. Units are counted once: later rounds
go by the number of blocks before. Draws are hashes, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import _SPACE, WORD, let, small
from rivulet.util import stage

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
BLOCK = 64
_CLOSE = 1e-9
_DECIDED = "array<struct<uid:string,take:int>>"


def word_count(text: Column) -> Column:
    """Number of words; each becomes one character, so that no list of them is held."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.length(F.regexp_replace(bare, rf"{WORD}[\x20\x09-\x0D]*", "x")).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """`rank` (from 0) of every source by code point, null last, without a global sort."""
    order = [F.col("source").asc_nulls_last()]
    laid = stage(
        sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges"
    )
    sizes = laid.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inner = Window.partitionBy("part").orderBy(*order)
    return (
        laid.withColumn("at", F.row_number().over(inner)).join(offsets, "part")
        .select(*sources.columns, (F.col("at") - 1 + F.col("before")).alias("rank"))
    )


def targets(units: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST):
    """(source, rank, source_size, target): shares of all words, at most `most` times own."""
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    listed = F.array(*map(F.lit, weights))
    table = ranked(sizes).withColumn("weight", F.get(listed, F.col("rank") % len(weights)))
    table = stage(table, "sources")
    level, stopped = 0.0, -1
    while True:
        cap = most * F.col("source_size")
        full = cap <= level * F.col("weight")
        row = table.agg(
            F.count(F.when(full, 1)).alias("stopped"),
            F.sum("source_size").alias("total"),
            F.sum(F.when(full, cap)).alias("held"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if row.stopped == stopped or not row.open or not row.total:
            break
        stopped = row.stopped
        level = (row.total - (row.held or 0.0)) / row.open
    target = F.least(most * F.col("source_size"), level * F.col("weight"))
    return table.select("source", "rank", "source_size", target.alias("target"))


def _draw(uid: Column, salt: int) -> Column:
    """Uniform number in [0, 1) that depends on a unit and a round."""
    return F.shiftrightunsigned(F.xxhash64(uid, F.lit(salt)), 11) / F.lit(float(1 << 53))


def _meet(units: Column, salt: int) -> Column:
    """Units of a block, in order: struct(uid, p, size, out); uid is null if none is left."""
    none = F.struct(
        F.lit(None).cast("string").alias("uid"),
        F.lit(0.0).alias("p"),
        F.lit(0).cast("long").alias("size"),
        F.array().cast(_DECIDED).alias("out"),
    )

    def settled(p: Column) -> Column:
        return (p < _CLOSE) | (p > 1 - _CLOSE)

    def decided(uid: Column, p: Column) -> Column:
        taken = F.struct(uid.alias("uid"), F.when(p < 0.5, 0).otherwise(1).alias("take"))
        return F.when(settled(p), F.array(taken)).otherwise(F.array()).cast(_DECIDED)

    def step(acc: Column, u: Column) -> Column:
        rise = F.least((1 - acc["p"]) * acc["size"], u["p"] * u["size"])
        fall = F.least(acc["p"] * acc["size"], (1 - u["p"]) * u["size"])
        moved = F.when(_draw(u["uid"], salt) * (rise + fall) < fall, rise).otherwise(-fall)
        both = F.struct(
            (acc["p"] + moved / acc["size"]).alias("a"), (u["p"] - moved / u["size"]).alias("b")
        )

        def met(q: Column) -> Column:
            first, second = ~settled(q["a"]), ~settled(q["b"])
            return F.struct(
                F.when(first, acc["uid"]).when(second, u["uid"]).alias("uid"),
                F.when(first, q["a"]).when(second, q["b"]).otherwise(0.0).alias("p"),
                F.when(first, acc["size"]).otherwise(u["size"]).alias("size"),
                F.concat(acc["out"], decided(acc["uid"], q["a"]), decided(u["uid"], q["b"])).alias(
                    "out"
                ),
            )

        alone = F.struct(
            u["uid"].alias("uid"), u["p"].alias("p"), u["size"].alias("size"), acc["out"].alias("out")
        )
        return F.when(acc["uid"].isNull(), alone).otherwise(let(both, met))

    return F.aggregate(units, none, step)


def pivotal(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """(uid, take) of rows of (uid, group, size, p), 0 < p < 1, size > 0.

    `take` is 1 with chance p and else 0. Of every group, the sums of size * take and of
    size * p differ by less than the size of one unit, the group's last.
    """
    current = stage(units.select("uid", "group", "size", "p"), "units")
    counts = stage(current.groupBy("group").agg(F.count("*").alias("n")), "counts")
    most = counts.agg(F.max("n")).first()[0] or 0
    current = current.join(small(counts), "group")
    done, salt = None, 0
    while most > 1:
        salt += 1
        n_blocks = F.ceil(F.col("n") / block)
        chunk = F.pmod(F.xxhash64("uid", F.lit(salt)), n_blocks)
        blocks = current.groupBy("group", n_blocks.alias("n"), chunk.alias("chunk")).agg(
            F.sort_array(F.collect_list(F.struct("size", "uid", "p")), asc=False).alias("units")
        )
        met = stage(blocks.select("group", "n", _meet(F.col("units"), salt).alias("met")), "met")
        decided = met.select(F.explode("met.out").alias("d")).select("d.uid", "d.take")
        done = decided if done is None else done.unionByName(decided)
        current = met.where("met.uid is not null").select(
            "met.uid", "group", "met.size", "met.p", "n"
        )
        most = -(-most // block)
    drawn = current.select(
        "uid", F.when(_draw(F.col("uid"), 0) < F.col("p"), 1).otherwise(0).alias("take")
    )
    return drawn if done is None else done.unionByName(drawn)


def copies(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, block: int = BLOCK
) -> DataFrame:
    """Copies that a mix of all of `docs` takes of every distinct row.

    `docs` needs doc_id, text and source; other columns are not looked at. Returns, per
    distinct (doc_id, source, text_print, size): rows (how often it is there), source_size,
    target, and total, the copies of all these rows together. Of a row, the number of
    copies is total / rows rounded up or down, `most` at most.

    Defined cases: a null text has size 0; documents of size 0 are taken at their source's
    rate like others, which costs no words; a source whose size is 0 has target 0 and is
    left out; the null source is a source, last in order; rows without doc_id are units
    like others; repeated rows are rounded together; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.xxhash64("text").alias("text_print"),
        word_count(F.col("text")).alias("size"),
    )
    units = stage(
        rows.groupBy("doc_id", "source", "text_print", "size").agg(F.count("*").alias("rows")),
        "rows",
    )
    table = small(stage(targets(units, weights, most), "targets"))
    uid = F.md5(
        F.concat_ws(
            "|", "rank", "size", "text_print", F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
        ).cast("binary")
    )
    placed = units.alias("u").join(
        table.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    placed = stage(
        placed.select("u.*", "rank", "source_size", "target", uid.alias("uid"),
                      (rate * F.col("rows")).alias("due")),
        "placed",
    )
    base = F.floor(F.col("due") + _CLOSE)
    fraction = F.greatest(F.col("due") - base, F.lit(0.0))
    open_units = placed.select(
        "uid", F.col("rank").alias("group"), "size", fraction.alias("p")
    ).where(F.col("p") > _CLOSE)
    empty = open_units.where("size = 0").select(
        "uid", F.when(_draw(F.col("uid"), 0) < F.col("p"), 1).otherwise(0).alias("take")
    )
    taken = pivotal(open_units.where("size > 0"), block).unionByName(empty)
    return placed.join(taken, "uid", "left").select(
        "doc_id", "source", "text_print", "size", "rows", "source_size", "target",
        (base + F.coalesce("take", F.lit(0))).cast("long").alias("total"),
    )


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per row of `docs`: doc_id, size, source_size, target and taken words."""
    found = copies(docs, **options)
    row = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    each = F.floor(F.col("total") / F.col("rows")) + (
        F.col("row") <= F.col("total") % F.col("rows")
    ).cast("long")
    return found.withColumn("row", row).select(
        "doc_id", "size", "source_size", "target", (each * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: columns of `docs` and `copy`, numbered from 1 for equal rows.

    Rows with equal doc_id, source and text count as equal rows; one of them is repeated.
    """
    found = stage(copies(docs, **options).where("total > 0"), "copies")
    chosen = docs.alias("d").join(
        small(found).alias("c"),
        F.col("d.doc_id").cast("long").eqNullSafe(F.col("c.doc_id"))
        & F.col("d.source").eqNullSafe(F.col("c.source"))
        & (F.xxhash64("d.text") == F.col("c.text_print")),
    )
    own = [c for c in docs.columns if c != "copy"]
    chosen = chosen.select(
        *(F.col(f"d.`{c}`") for c in own), F.col("c.total").alias("copy"), F.col("c.rows").alias("_rows_of_unit")
    )
    if not found.where("rows > 1").isEmpty():
        many = chosen.where("_rows_of_unit > 1").dropDuplicates(["doc_id", "source", "text"])
        chosen = chosen.where("_rows_of_unit = 1").unionByName(many)
    number = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copy")))
    return chosen.select(*(F.col(f"`{c}`") for c in own), number.alias("copy"))
