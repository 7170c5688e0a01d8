"""Removal of lines that many sites share.

A HyperLogLog sketch of sites is kept per line hash; sketches merge by aggregation, before
the shuffle and after it. Lines whose estimate is near the threshold (between half and
twice of it, over ten standard errors) get an exact distinct count; the others are decided
by their estimate, which is then sure to be on the right side. Counted by text, a line needs
as many distinct texts too, so that copies of one text do not make its lines shared; given
groups of near copies, a group counts as one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import let, small, text_key
from rivulet.util import stage

MIN_SITES = 10
LG_K = 10
_BLANK = " \t\x0b\x0c\r"


def lines_of(text: Column) -> Column:
    """The lines of a text, split at newlines; of a null text, none."""
    return F.split(text, "\n", -1)


def _hashed(docs: DataFrame, site: str, groups: DataFrame | None = None) -> DataFrame:
    """(h1, h2, site, text_key, at) of every line with a visible character; with `groups`,
    text_key is that of the text's group."""
    named = F.coalesce(F.concat(F.lit("s"), F.col(site).cast("string")), F.lit("n"))
    bare = F.btrim("line", F.lit(_BLANK))
    texts = docs.select(named.alias("site"), text_key("text").alias("text_key"), "text")
    if groups is not None:
        texts = texts.join(small(groups), "text_key", "left").select(
            "site", F.coalesce("group_key", "text_key").alias("text_key"), "text"
        )
    return (
        texts.select(
            "site", "text_key", F.posexplode(lines_of(F.col("text"))).alias("at", "line")
        )
        .select("site", "text_key", "at", bare.alias("line"))
        .where("line <> ''")
        .select(
            "site", "text_key", "at",
            F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
        )
    )


def shared_lines(
    docs: DataFrame,
    site: str = "source",
    min_sites: int = MIN_SITES,
    by_text: bool = False,
    groups: DataFrame | None = None,
) -> DataFrame:
    """(h1, h2) of the lines that occur on `min_sites` sites or more, with `by_text` also in
    as many distinct texts."""
    lines = _hashed(docs, site, groups)
    counted = {"sites": "site", "texts": "text_key"} if by_text else {"sites": "site"}

    def least(n: int | float) -> Column:
        return F.least(*counted, F.lit(float("inf"))) >= n

    spread = lines.groupBy("h1", "h2").agg(
        *(F.hll_sketch_agg(c, LG_K).alias(name) for name, c in counted.items())
    )
    judged = stage(
        spread.select(
            "h1", "h2", *(F.hll_sketch_estimate(name).alias(name) for name in counted)
        ).where(least(min_sites / 2)),
        "spread",
    )
    near = small(judged.where(~least(2 * min_sites)).select("h1", "h2"))
    exact = None
    for c in counted.values():
        enough = (
            lines.join(near, ["h1", "h2"], "left_semi")
            .select("h1", "h2", c).distinct()
            .groupBy("h1", "h2").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_sites).select("h1", "h2")
        )
        exact = enough if exact is None else exact.join(enough, ["h1", "h2"], "left_semi")
    sure = judged.where(least(2 * min_sites))
    return sure.select("h1", "h2").unionByName(exact)


def drop_shared_lines(
    docs: DataFrame,
    site: str = "source",
    min_sites: int = MIN_SITES,
    by_text: bool = False,
    groups: DataFrame | None = None,
) -> DataFrame:
    """`docs` with `text` less the lines on `min_sites` sites or more, n_lines and n_removed.

    `docs` needs `text` and the site column; all columns are kept, n_lines and n_removed
    give way to the new ones. Lines are split at newlines and compared without white space
    at their ends; lines without a visible character are kept. Shared lines always go,
    whatever share of a document they are; with `by_text` they are those that `min_sites`
    distinct texts hold too, so that exact copies of a text do not make its lines shared.
    `groups` is a staged frame (text_key, group_key), a text_key once: texts of one group
    count as one text, so that near copies do not share away what only they hold.

    Defined cases: a null text stays null and has 0 lines; the null site is one site;
    repeated rows are rows like any others and do not add sites; an empty table gives an
    empty result.
    """
    shared = stage(shared_lines(docs, site, min_sites, by_text, groups), "shared")
    bad = (
        _hashed(docs, site).join(small(shared), ["h1", "h2"], "left_semi")
        .groupBy("text_key").agg(F.collect_set("at").alias("bad"))
    )
    bad = stage(bad, "bad")
    added = ["n_lines", "n_removed"]
    own = [c for c in docs.columns if c not in added]
    joined = docs.select(*(F.col(f"`{c}`") for c in own), text_key("text").alias("_key")).alias("d")
    joined = joined.join(small(bad).alias("b"), F.col("d._key") == F.col("b.text_key"), "left")
    lines = lines_of(F.col("d.text"))

    def strip(x: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("b.bad"))
        return let(kept, lambda k: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(k)).cast("long").alias("n_removed"),
            F.array_join(F.transform(k, lambda i: F.get(x, i)), "\n").alias("text"),
        ))

    whole = F.struct(
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_removed"),
        F.col("d.text").alias("text"),
    )
    stripped = F.when(F.col("b.bad").isNotNull(), let(lines, strip))
    done = let(
        stripped,
        lambda s: F.when(s.isNotNull(), s).otherwise(whole),
    )
    return joined.select(*(F.col(f"d.`{c}`") for c in own if c != "text"), done.alias("_done")).select(
        *(F.col("_done.text") if c == "text" else F.col(f"`{c}`") for c in own),
        "_done.n_lines", "_done.n_removed",
    )
