"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only.

Each source has a target number of words. Whole copies of the source fill it as far as they go; what is left is a budget
that a part of its documents meets: those whose hash lies below a threshold. The threshold is found without sorting
documents. Words are summed by source and the highest hash digit; the last digit whose cumulative sum still fits the
budget bounds the threshold, and only the documents of the next digit, the boundary bucket, are summed again by the next
digit. Every level refines the threshold, so thresholds for smaller budgets are always nested in those for larger ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved

HASH_BITS = 60


def document_hash(doc_id: Column) -> Column:
    """A hash of 60 bits: the first 15 hex digits of the MD5 of the id as text; a null id hashes as the empty text."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """(source, source_size, target): targets share `share` of all words by weight, none above `most` times its source.

    `sizes` is one row per source. The excess of a capped source goes to the others by weight until none is above. In
    order of cap per weight, a source is capped while the level that the rest would get lies above its cap.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(ordered) - 1) % len(weights) + 1
    )
    capped = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    later = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).partitionBy(F.lit(0))
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    ) / F.sum("weight").over(later)
    leveled = capped.withColumn("level", level).withColumn("free", F.col("cap") >= F.col("level") * F.col("weight"))
    chosen = leveled.withColumn("at", F.min(F.when(F.col("free"), F.col("cap") / F.col("weight"))).over(everything))
    chosen = chosen.withColumn(
        "final", F.max(F.when(F.col("free") & (F.col("cap") / F.col("weight") == F.col("at")), F.col("level"))).over(everything)
    )
    return chosen.select(
        "source", "source_size",
        F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("final") * F.col("weight"))).alias("target"),
    )


def thresholds(sized: DataFrame, budgets: DataFrame, digit_bits: int = 12) -> DataFrame:
    """(source_key, threshold): documents with a hash below it sum to at most the budget, and with the next hash to more.

    `sized` is (source_key, hash, size), `budgets` (source_key, budget). Without documents left over, the threshold is
    above all hashes; without budget it is below all, so that empty documents do not come once more.
    """
    state = budgets.select(
        "source_key", F.col("budget").alias("left"), F.lit(0).cast("long").alias("low"), F.lit(True).alias("open")
    )
    for level in range(HASH_BITS // digit_bits):
        rest = HASH_BITS - digit_bits * (level + 1)
        digit = F.shiftright("hash", rest)
        prefix = F.col("low") if not level else F.shiftright("low", rest + digit_bits)
        inside = sized.join(state.where("open"), "source_key")
        if level:
            inside = inside.where(F.shiftright("hash", rest + digit_bits) == prefix)
        histogram = inside.groupBy("source_key", digit.alias("digit")).agg(
            F.sum("size").alias("words"), F.first("left").alias("left")
        )
        by_digit = Window.partitionBy("source_key").orderBy("digit")
        over = histogram.withColumn("upto", F.sum("words").over(by_digit)).where(F.col("upto") > F.col("left"))
        boundary = over.groupBy("source_key").agg(
            F.min_by(F.struct("digit", (F.col("upto") - F.col("words")).alias("below")), "digit").alias("cut")
        )
        state = saved(
            state.join(boundary, "source_key", "left").select(
                "source_key",
                F.when(F.col("cut").isNotNull(), F.col("left") - F.col("cut.below")).otherwise(F.col("left")).alias("left"),
                F.when(F.col("cut").isNotNull(), F.shiftleft("cut.digit", rest)).otherwise(F.col("low")).alias("low"),
                (F.col("open") & F.col("cut").isNotNull()).alias("open"),
            ),
            "thresholds",
        )
    above = F.when(F.col("open"), F.col("low")).otherwise(F.lit(1 << HASH_BITS))
    spent = budgets.select("source_key", (F.col("budget") <= 0).alias("spent"))
    return state.join(spent, "source_key").select(
        "source_key", F.when(F.col("spent"), F.lit(0)).otherwise(above).cast("long").alias("threshold")
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """`docs` with __size, __hash and __source, which tells a null source from any text by its length."""
    return docs.withColumns(
        {
            "__size": word_count(F.col("text")),
            "__hash": document_hash(F.col("doc_id")),
            "__source": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")),
        }
    )


def plan(sized: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """(source_key, source_size, target, copies, threshold), one row per source, of (source_key, hash, size)."""
    totals = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    named = totals.select(
        F.when(F.col("source_key") != "", F.expr("substr(source_key, 2)")).alias("source"), "source_size"
    )
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = saved(
        source_targets(named, weights, share, most)
        .withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
        .withColumn("copies", copies)
        .withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size")),
        "targets",
    )
    cuts = thresholds(sized, targets.select("source_key", "budget"))
    joined = targets.join(cuts, "source_key")
    # written, its size is known: Spark broadcasts it while it is small, and documents are not shuffled by source
    return saved(joined.select("source_key", "source_size", "target", "copies", "threshold"), "plan")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of `docs` (doc_id, text, source).

    Sources in order of code points, null last, have the weights in turn. The mix takes each document in `copies` whole
    copies, `taken` words: the same number for all documents of a source, and one more below the source's hash threshold.
    A source's taken words fall short of its target by less than the words of the documents that share one hash.

    A null or empty text has size 0. Repeated rows and null ids share a hash and are taken together. Sources of size 0
    have target 0. Other columns are ignored; an empty table gives no rows.
    """
    sized = saved(
        _keyed(docs.select("doc_id", "text", "source")).select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            F.col("__size").alias("size"), F.col("__hash").alias("hash"), F.col("__source").alias("source_key"),
        ),
        "sizes",
    )
    planned = plan(sized.select("source_key", "hash", "size"), weights, share, most)
    copies = (F.col("copies") + (F.col("hash") < F.col("threshold")).cast("long")).cast("long")
    return sized.join(planned, "source_key").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).cast("long").alias("taken"),
    )


def repeated_docs(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """The rows of `docs`, each as often as `mix` takes it. The texts are not shuffled unless the sources are very many."""
    keyed = _keyed(docs)
    sized = keyed.select(F.col("__source").alias("source_key"), F.col("__hash").alias("hash"), F.col("__size").alias("size"))
    planned = plan(saved(sized, "sizes"), weights, share, most).select(
        F.col("source_key").alias("__source"), F.col("copies").alias("__copies"), F.col("threshold").alias("__threshold")
    )
    copies = F.col("__copies") + (F.col("__hash") < F.col("__threshold")).cast("long")
    taken = keyed.join(planned, "__source").withColumn("__times", copies).where("__times > 0")
    return taken.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__times").cast("int"))).alias("__turn")
    ).drop("__turn")
