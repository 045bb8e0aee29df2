"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, carried, cut

SPREAD = 64  # hash buckets of each source and size class, so that no window holds a whole source


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _hash_part(value: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")


def _targets(buckets: DataFrame, weights: Sequence[float], max_repeat: int) -> DataFrame:
    """One row per source with its size and target. This table and its windows are as long as the list of sources.

    With caps reached in the order of cap to weight, the level that the other sources share is the largest of
    the levels found after each number of capped sources.
    """
    sources = buckets.groupBy("_key").agg(F.first("_src").alias("_src"), F.sum("_words").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("_src").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("_w", F.get(cycle, place % len(weights)))
    sources = sources.withColumn("_cap", F.col("source_size") * max_repeat)
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_key")
    before = F.coalesce(F.sum("_cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_w").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = F.max((F.sum("source_size").over(everything) - F.col("_before")) / F.col("_rest")).over(everything)
    sources = sources.withColumns({"_before": before, "_rest": rest}).withColumn("_level", level)
    target = F.least(F.col("_cap").cast("double"), F.col("_w") * F.col("_level"))
    return sources.select("_key", "source_size", target.alias("target"))


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    max_repeat: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """Every input row with size, source_size, target, copies and taken added.

    Sources in code-point order, null last, get the weights in turn and share the words of the whole table; no
    source gets more than ``max_repeat`` times its own words, the excess goes to the others by weight. Within a
    source each document has the same expected number of copies. The rows are laid in order of size class, then
    hash bucket, then id; their expected copies are summed up along that order, one offset per source is
    added, and a document is taken once for each whole number crossed. As sizes rise along the order, the
    words taken stay within about the largest document of the target. Everything follows from ids and sizes,
    so reruns agree.

    Null texts and texts without words have size 0; a source without any word has target 0 and is not
    taken. Repeated rows count one by one. An empty table gives no rows. Input columns with the names of
    added ones are replaced.
    """
    return carried(docs, ["doc_id", "source", "text"], lambda rows: _planned(rows, weights, max_repeat, seed))


def _planned(docs: DataFrame, weights: Sequence[float], max_repeat: int, seed: str) -> DataFrame:
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    sized = docs.withColumn("size", n_words("text"))
    sized = sized.withColumns(
        {
            "_key": key,
            "_class": F.floor(4 * F.sqrt(F.col("size").cast("double"))),
            "_part": _hash_part(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 8) % SPREAD,
        }
    )
    place = ["_key", "_class", "_part"]
    # Only these small counts are kept; the texts are read a second time rather than stored.
    counts = [F.first("source").alias("_src"), F.count("*").alias("_n"), F.sum("size").alias("_words")]
    buckets = cut(sized.groupBy(*place).agg(*counts))

    in_class = Window.partitionBy("_key", "_class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    classes = buckets.groupBy("_key", "_class").agg(F.sum("_n").alias("_in_class"))
    in_source = Window.partitionBy("_key").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select(
        "_key", "_class", F.coalesce(F.sum("_in_class").over(in_source), F.lit(0)).alias("_class_at")
    )
    starts = buckets.select(*place, F.coalesce(F.sum("_n").over(in_class), F.lit(0)).alias("_at"))
    starts = starts.join(classes, ["_key", "_class"]).join(_targets(buckets, weights, max_repeat), "_key")
    starts = cut(
        starts.select(*place, (F.col("_at") + F.col("_class_at")).alias("_at"), "source_size", "target")
    )

    order = Window.partitionBy(*place).orderBy("doc_id", "size", F.xxhash64("text"))
    ranked = sized.withColumn("_rank", F.row_number().over(order)).join(starts, place)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = _hash_part(F.concat(F.lit(seed), F.col("_key")), 5) / (1 << 20)
    ranked = ranked.withColumns({"_rate": rate, "_off": offset, "_to": F.col("_at") + F.col("_rank")})
    upto = F.floor(F.col("_rate") * F.col("_to") + F.col("_off"))
    before = F.floor(F.col("_rate") * (F.col("_to") - 1) + F.col("_off"))
    ranked = ranked.withColumn("copies", upto - before).withColumn("taken", F.col("copies") * F.col("size"))
    return ranked.drop(*place, "_rank", "_at", "_rate", "_off", "_to")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row of ``mix_plan`` as often as it is taken, with ``copy_no`` from 1."""
    plan = mix_plan(docs.drop("copy_no"), **options).filter("copies > 0")
    return plan.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
