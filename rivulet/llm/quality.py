"""Quality rules: a log-likelihood ratio of hashed n-grams, and a few base counts.

Tokens are runs of letters, digits and underscores, or runs of other visible characters.
Unigrams and bigrams of tokens are hashed to BUCKETS buckets. Bucket counts of the trusted
documents and of all documents are two smoothed multinomials; a document's score is the mean
over its n-grams of the logarithm of their ratio. Each bucket's ratio is rounded to a fixed
point, so that sums do not depend on an order and a threshold decides alike in every run.
All of it is DataFrame expressions; what becomes a literal is one number per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import let, small, words
from rivulet.util import stage

BUCKETS = 1 << 15
SMOOTH = 1.0
THRESHOLD = -0.3
_POINT = 1 << 20
_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
_WINDOW = 5


def ngrams(text: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of the tokens and of each token with its successor (the last has none)."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0))

    def bucket(x: Column) -> Column:
        # of a power of two, the low bits are the remainder, and cheaper
        return x.bitwiseAND(F.lit(buckets - 1)) if buckets & (buckets - 1) == 0 else F.pmod(x, F.lit(buckets))

    def both(h: Column) -> Column:
        following = F.slice(h, 2, F.greatest(F.size(h), F.lit(1)))
        return F.concat(
            F.transform(h, lambda x: bucket(x).cast("int")),
            F.zip_with(h, following, lambda a, b: bucket(F.xxhash64(a, b)).cast("int")),
        )

    return let(F.transform(tokens, lambda x: F.xxhash64(x)), both)


def repeated_words(w: Column) -> Column:
    """Words under windows of five that occur twice or more in the same text."""

    def windows(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - _WINDOW),
            lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(_WINDOW))),
        )

    def covered(v: Column) -> Column:
        pairs = F.sort_array(F.transform(v, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def places(s: Column) -> Column:
            def twice(e: Column, j: Column) -> Column:
                return F.coalesce(e["x"] == F.get(s, j + 1)["x"], F.lit(False)) | F.coalesce(
                    (j > 0) & (e["x"] == F.get(s, F.greatest(j - 1, F.lit(0)))["x"]), F.lit(False)
                )

            return F.sort_array(F.transform(F.filter(s, twice), lambda e: e["i"]))

        def total(p: Column) -> Column:
            steps = F.transform(
                p,
                lambda e, j: F.least(F.lit(_WINDOW), F.coalesce(F.get(p, j + 1) - e, F.lit(_WINDOW))),
            )
            return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

        return let(pairs, lambda s: let(places(s), total))

    def count(v: Column) -> Column:
        return F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(covered(v))

    hashes = F.transform(w, lambda x: F.xxhash64(x))
    return F.when(F.size(w) < _WINDOW, F.lit(0)).otherwise(
        let(hashes, lambda h: let(windows(h), count))
    )


def base_counts(text: Column) -> list[Column]:
    """n_words, n_repeat_words and word_chars as struct `w`; n_symbols, n_dup_lines."""
    text = F.coalesce(text, F.lit(""))
    by_words = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        ),
    )
    lines = F.filter(
        F.split(text, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0
    )

    return [
        by_words.alias("w"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("long")
        .alias("n_dup_lines"),
    ]


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say good quality and not toxic."""
    return (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t"))
        .where("q >= 1 and t <= 0")
        .select("doc_id")
    )


def ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, ratio): of every bucket, the rounded log ratio of trusted to all n-grams."""
    trusted = small(stage(trusted_ids(labels), "trusted")).withColumn("good", F.lit(True))
    counted = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(trusted, "doc_id", "left")
        .select("good", F.explode(ngrams(F.col("text"), buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.count("good").alias("good"))
    )
    counted = stage(
        docs.sparkSession.range(buckets, numPartitions=1)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(counted, "bucket", "left")
        .select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("good", F.lit(0)).alias("good")),
        "buckets",
    )
    raw, good = counted.agg(F.sum("raw"), F.sum("good")).first()

    def log_share(column: str, total: int) -> Column:
        return F.log((F.col(column) + SMOOTH) / (total + SMOOTH * buckets))

    ratio = F.round((log_share("good", good) - log_share("raw", raw)) * _POINT).cast("long")
    return counted.select("bucket", (ratio if good else F.lit(0).cast("long")).alias("ratio"))


def score_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS
) -> DataFrame:
    """All columns of `docs` and n_words, n_repeat_words, word_chars, n_symbols,
    n_dup_lines, base_failed, score and kept; columns of `docs` with these names give way.

    `docs` needs doc_id and text, `labels` doc_id, quality and toxic; the trusted documents
    are those whose labels all have quality 1 and toxic 0. base_failed: fewer than 10 words,
    or over a fifth of the words under repeated five-word windows. kept: not base_failed,
    and score (a mean logarithm, rounded to 1/2**20 per n-gram) at least `threshold`.

    Defined cases: a null text counts as the empty one, has a null score and fails; rows
    without doc_id are scored but never trusted; repeated rows count as often as they occur
    and get equal results; labels without doc_id are left out and missing label values
    count as bad quality and not toxic; without trusted documents all scores are 0. An
    empty table gives an empty result.
    """
    found = dict(tuple(r) for r in ratios(docs, labels, buckets).collect())
    listed = F.lit(",".join(str(found[k]) for k in range(buckets)))
    weights = F.split(listed, ",").cast("array<bigint>")  # folded to one constant
    text = F.col("text")

    def mean(g: Column) -> Column:
        total = F.aggregate(g, F.lit(0).cast("long"), lambda a, b: a + F.get(weights, b))
        return F.when(F.size(g) > 0, total / F.size(g) / _POINT)

    added = ["n_words", "n_repeat_words", "word_chars", "n_symbols", "n_dup_lines", "base_failed", "score", "kept"]
    own = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    failed = (F.col("w.n_words") < 10) | (
        100 * F.col("w.n_repeat_words") > 20 * F.col("w.n_words")
    )
    scored = docs.select(
        F.struct(*own).alias("own"), *base_counts(text), let(ngrams(text, buckets), mean).alias("score")
    )
    return scored.select(
        "own.*", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words",
        failed.alias("base_failed"), "score",
        (~failed & F.coalesce(F.col("score") >= threshold, F.lit(False))).alias("kept"),
    )
