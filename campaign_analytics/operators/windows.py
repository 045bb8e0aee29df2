"""Window columns, and the same results as aggregates where a key can be very large.

A window puts all rows of its partition into one task. The functions in the first part are meant
for partitions whose size is bounded by dimensions. ``first_over`` and ``tail_marker`` give first-touch
and last-rank results with map-side combining, and ``spread_rank`` ranks facts in pieces of about equal
size, for keys of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import order_value


def _window(keys: list[str], order: list[Column] | None = None):
    window = Window.partitionBy(*keys)
    return window.orderBy(*order) if order else window


def max_over(keys: list[str], col: str) -> Column:
    return F.max(col).over(_window(keys))


def count_over(keys: list[str], col: str) -> Column:
    return F.count(col).over(_window(keys))


def rank_over(keys: list[str], order: list[Column]) -> Column:
    return F.rank().over(_window(keys, order)).cast("bigint")


def dense_rank_over(keys: list[str], order: list[Column]) -> Column:
    return F.dense_rank().over(_window(keys, order)).cast("bigint")


def last_rank_marker(count: Column, rank: Column, value: Column) -> Column:
    """``value`` on the row whose rank equals the row count, null elsewhere."""
    return F.when(count == rank, value)


def single_row_flag(keys: list[str], col: str) -> Column:
    """1 when the partition has exactly one row with a value, else null."""
    return F.when(count_over(keys, col) == 1, F.lit(1))


def qualify(df: DataFrame, condition: Column) -> DataFrame:
    """Keep rows by a condition on window columns; null counts as false."""
    return df.where(F.coalesce(condition, F.lit(False)))


def top1_ties(df: DataFrame, keys: list[str], order: str | list[str], nulls_first: bool = False) -> DataFrame:
    """Rows that come first in their key by descending ``order``, one column after the other, all ties kept.

    Rows whose first order column is null are left out, or with ``nulls_first`` come before all others. The maximum
    comes from a map-side combined aggregate that is joined back, so no key has to fit into one task.
    """
    columns = [order] if isinstance(order, str) else order
    rows = df.withColumn("_value", F.struct(*columns) if len(columns) > 1 else F.col(columns[0]))
    if nulls_first:  # a flag before the value: true sorts above false
        rest = F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(f"c{i}") for i, c in enumerate(columns)])
        rows = rows.withColumn("_value", rest)
    else:
        rows = rows.where(F.col(columns[0]).isNotNull())
    best = rows.groupBy(*keys).agg(F.max("_value").alias("_best"))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    first = F.col("l._value").eqNullSafe(F.col("r._best"))
    return rows.alias("l").join(best.alias("r"), [*same, first], "left_semi").select("l.*").drop("_value")


def first_over(df: DataFrame, keys: list[str], value: str | Column, order: list[str], out: str | None = None) -> DataFrame:
    """First non-null value per key in ``order``; keys without any value keep null.

    An order key and a hash of the row are reduced, on the map side first; the winning row is joined back, and only
    there is ``value`` computed again, which may be an expression. Of rows equal in order, one counts.
    """
    found = F.col(value) if isinstance(value, str) else value
    at = order_value(df, *order)
    mark = F.xxhash64(*df.columns)
    won = (
        df.select(*keys, F.when(found.isNotNull(), at).alias("_at"), mark.alias("_mark"))
        .groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
        .agg(F.min("_at").alias("_first"), F.min_by("_mark", "_at").alias("_mark"))
    )
    rows = df.withColumns({"_at": at, "_hash": mark})
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    back = won.join(rows, [*same, F.col("_first") == F.col("_at"), F.col("_mark") == F.col("_hash")], "left")
    named = F.when(F.col("_first").isNotNull(), found).alias(out or (value if isinstance(value, str) else "first"))
    return back.select(*[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)], named).distinct()


# A key with more rows than this is ranked in pieces, cut at this many quantiles of its order values.
PIECE_ROWS, PIECES = 200_000, 256


def spread_rank(
    df: DataFrame, keys: list[str], order: str, weight: str, out: str = "rnk", piece_rows: int | None = None
) -> DataFrame:
    """Rank of every row within its key by a numeric ``order`` column, least first; a row stands for ``weight`` rows.

    A key of up to ``piece_rows`` rows is one window. A larger one is cut at approximate quantiles of its order
    values, wherever they lie: a burst within one second makes as many pieces as a year does. A row's rank is its
    rank inside the piece plus the weight of the pieces before. Rows of equal order share a piece and a rank; bring
    them together by an aggregate first, as no cut can part them. ``order`` and ``keys`` are not null.
    """
    fractions = F.array(*[F.lit(i / PIECES) for i in range(1, PIECES)])
    named = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]
    at_key = [F.col(k) == F.col(f"_key{i}") for i, k in enumerate(keys)]
    large = (
        df.groupBy(*named)
        .agg(F.count("*").alias("_rows"), F.percentile_approx(order, fractions, F.lit(1000)).alias("_cuts"))
        .where(F.col("_rows") > (PIECE_ROWS if piece_rows is None else piece_rows))
        .drop("_rows")
    )
    piece = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(order))), F.lit(0))
    cut = df.join(large, at_key, "left").withColumn("_piece", F.when(F.col("_cuts").isNull(), 0).otherwise(piece))
    cut = cut.drop("_cuts", *[f"_key{i}" for i in range(len(keys))])
    in_piece = Window.partitionBy(*keys, "_piece")
    upto = F.sum(weight).over(in_piece.orderBy(order))  # with all rows of equal order
    same = F.sum(weight).over(in_piece.partitionBy(*keys, "_piece", order))
    before = Window.partitionBy(*[f"_key{i}" for i in range(len(keys))]).orderBy("_at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        cut.groupBy(*named, F.col("_piece").alias("_at"))
        .agg(F.sum(weight).alias("_n"))
        .select(*[f"_key{i}" for i in range(len(keys))], "_at", F.sum("_n").over(before).alias("_start"))
        .where("_start IS NOT NULL")
    )
    return (
        cut.withColumn("_inside", upto - same + 1)
        .join(starts, [*at_key, F.col("_piece") == F.col("_at")], "left")
        .withColumn(out, F.coalesce("_start", F.lit(0)) + F.col("_inside"))
        .drop("_piece", "_inside", "_at", "_start", *[f"_key{i}" for i in range(len(keys))])
    )


def tail_marker(rows: DataFrame, owner: list[str], group: list[str], order: str, stamp: str) -> DataFrame:
    """What ranking and counting all rows of an owner says about the last-ranked row.

    ``rows`` has one row per fact, and the fact ranked last has the greatest ``order``, a value of fixed
    width. Per owner and ``group`` tuple the result holds

    ``cnt``         facts of the owner
    ``group_cnt``   facts of this group tuple
    ``popularity``  dense rank of the tuple by ``group_cnt`` within the owner
    ``last_stamp``  greatest ``stamp`` of the owner
    ``is_tail``     this tuple holds the fact ranked last, and nothing ties with it
    ``single``      all facts of the owner are equal in group and order

    A rank equal to the row count exists only for an untied last row, which is why the two passes
    of aggregation below are enough. The first is keyed down to ``order`` and so spreads an
    owner of any size; the second leaves one row per group tuple, and only those meet in a window.
    """
    keys = [*owner, *group]
    per_key = rows.groupBy(*keys, order).agg(F.count("*").alias("n"), F.max(stamp).alias("stamp"))
    per_group = per_key.groupBy(*keys).agg(
        F.sum("n").alias("group_cnt"),
        F.max(order).alias("tail_key"),
        F.max_by("n", order).alias("tail_n"),
        F.min(order).alias("head"),
        F.max("stamp").alias("stamp"),
    )
    of_owner = Window.partitionBy(*owner)
    known = per_group.withColumns(
        {
            "cnt": F.sum("group_cnt").over(of_owner),
            "last_stamp": F.max("stamp").over(of_owner),
            "owner_key": F.max("tail_key").over(of_owner),
            "tuples": F.count("*").over(of_owner),
            "popularity": dense_rank_over(owner, [F.col("group_cnt").desc_nulls_first()]),
        }
    )
    at_tail = F.col("tail_key") == F.col("owner_key")
    ties = F.sum(F.when(at_tail, F.col("tail_n"))).over(of_owner)
    return known.select(
        *keys,
        "cnt",
        "group_cnt",
        "popularity",
        "last_stamp",
        (at_tail & (ties == 1)).alias("is_tail"),
        ((F.col("tuples") == 1) & (F.col("head") == F.col("tail_key"))).alias("single"),
    )
