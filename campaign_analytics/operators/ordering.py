"""Several order columns as one number of fixed width.

Spark keeps a maximum of fixed width in a hash aggregate; a maximum over a struct, or one that carries a row along,
is sorted by key first. An order key is a decimal that sorts as its columns do, nulls first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal digits of each type's values once they are counted from the least one, null being zero.
DIGITS = {
    T.ByteType: 10,
    T.ShortType: 10,
    T.IntegerType: 10,
    T.LongType: 20,
    T.DateType: 7,
    T.TimestampType: 18,
    T.TimestampNTZType: 18,
}


def _counted(name: str, kind: T.DataType, descending: bool) -> str:
    """SQL of a value as a whole number from 1 on; null is zero either way, and so comes first."""
    col, most = "`" + name.replace("`", "``") + "`", 10 ** DIGITS[type(kind)] - 1
    if isinstance(kind, T.LongType):
        sign = "-" if descending else ""
        return f"coalesce(CAST({sign}CAST({col} AS DECIMAL(20,0)) + {2**63 + 1}BD AS DECIMAL(20,0)), 0BD)"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        # By its calendar fields, since a time stamp without zone has no instant; 18 digits reach beyond year 9999.
        seconds = f"(hour({col}) * 3600 + minute({col}) * 60) * 1000000L"
        value = f"{_days(f'CAST({col} AS DATE)')} * 86400000000L + {seconds} + CAST(extract(SECOND FROM {col}) * 1000000 AS BIGINT) + 1L"
    elif isinstance(kind, T.DateType):
        value = f"{_days(col)} + 1L"
    else:
        value = f"CAST({col} AS BIGINT) + {2**31 + 1}L"
    return f"coalesce({f'{most}L - ({value})' if descending else value}, 0L)"


def _days(date: str) -> str:
    return f"CAST(datediff({date}, DATE'0001-01-01') AS BIGINT)"


def order_key(df: DataFrame, *columns: str) -> Column:
    """One decimal that sorts as ``columns`` do, one after the other; ``-name`` sorts that one descending.

    Nulls come first either way. Columns are whole numbers, dates and time stamps from year 1 on, and must fit 38
    digits together: a time stamp and a long do, two longs do not. The key is one SQL expression, as a plan with
    many small calls takes long to build.
    """
    schema, total, used = df.schema, "", 0
    for spec in columns:
        name = spec.removeprefix("-")
        kind = schema[name].dataType
        if type(kind) not in DIGITS:
            raise ValueError(f"no order key over {name}: {kind.simpleString()}")
        digits = DIGITS[type(kind)]
        used += digits
        value = _counted(name, kind, spec != name)
        if total:
            value = f"CAST(CAST({total} AS DECIMAL(38,0)) * {10**digits}BD AS DECIMAL(38,0)) + CAST({value} AS DECIMAL(20,0))"
        total = value
    if not total or used > 38:
        raise ValueError(f"order columns need {used} digits, 38 fit")
    return F.expr(f"CAST({total} AS DECIMAL(38,0))")


def order_value(df: DataFrame, *columns: str) -> Column:
    """The order key where there is one, else a struct of the columns: the same order, reduced by sorting."""
    try:
        return order_key(df, *columns)
    except ValueError:
        if any(c.startswith("-") for c in columns):
            raise
        return F.struct(*columns)


def latest_rows(df: DataFrame, keys: list[str], order: list[str], first: bool = False) -> DataFrame:
    """The row with the greatest (or least) ``order`` of every key; of rows equal in order, one.

    The order key and a hash of the row are reduced in a hash aggregate, on the map side first; only then is the
    winning row joined back. Long rows are therefore shuffled once, and never sorted by an aggregate. Null keys
    form a key of their own.
    """
    return winning_rows(df, keys, order, first).distinct()


def winning_rows(df: DataFrame, keys: list[str], order: list[str], first: bool = False) -> DataFrame:
    """As ``latest_rows``, but a winning row that the input repeats is repeated."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min if first else F.max
    pick = F.min_by if first else F.max_by
    marked = df.withColumns({"_order": order_value(df, *order), "_row": F.xxhash64(*rest)})
    won = marked.groupBy(*keys).agg(best("_order").alias("_won"), pick("_row", "_order").alias("_won_row"))
    won = won.withColumnsRenamed({k: f"_won_{i}" for i, k in enumerate(keys)})
    same = [F.col(k).eqNullSafe(F.col(f"_won_{i}")) for i, k in enumerate(keys)]
    back = marked.join(won, [*same, F.col("_order") == F.col("_won"), F.col("_row") == F.col("_won_row")])
    return back.select(*df.columns)
