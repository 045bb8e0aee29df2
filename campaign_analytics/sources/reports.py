"""Readers for exported and fetched reports, and date-bounded scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_date, compact_date


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType, n_cols: int | None = None) -> DataFrame:
    """CSV export with a header line; optionally only its first ``n_cols`` columns."""
    df = spark.read.csv(path, header=True, schema=schema, multiLine=False)
    return df.select(*df.columns[:n_cols]) if n_cols else df


def scan_between(df: DataFrame, date_col: str, start: Column | str, end: Column | str) -> DataFrame:
    """Rows of a closed range of days. The predicate reaches the file scan."""
    return df.where(F.col(date_col).between(as_date(start), as_date(end)))


def scan_jdbc_between(
    spark: SparkSession, url: str, table: str, date_col: str, start: str, end: str, parts: int, **options: str
) -> DataFrame:
    """The same range from a database table, read by ``parts`` tasks that share out the days."""
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=date_col,
        lowerBound=start,
        upperBound=end,
        numPartitions=str(parts),
        **options,
    )
    return scan_between(reader.load(), date_col, start, end)


def date_batches(bounds: DataFrame, days: int) -> DataFrame:
    """Calendar from ``start_date`` to ``end_date`` cut into runs of ``days`` days.

    ``bounds`` has one row per range; the last run of a range may be shorter.
    """
    start, end = F.col("start_date"), F.col("end_date")
    first = F.sequence(start, end, F.expr(f"interval {days} days"))
    return bounds.select("*", F.posexplode(first).alias("batch", "first_day")).select(
        *bounds.columns,
        "batch",
        "first_day",
        F.least(F.date_add("first_day", days - 1), end).alias("last_day"),
    )


def flatten_metrics_long(df: DataFrame, json_col: str) -> DataFrame:
    """``{date: {metric: value}}`` text to one row per date and metric."""
    days = F.from_json(F.col(json_col), "map<string,map<string,string>>")
    rest = [c for c in df.columns if c != json_col]
    return (
        df.select(*rest, F.explode(days).alias("date", "metrics"))
        .select(*rest, "date", F.explode("metrics").alias("metric", "value"))
        .withColumn("value", F.col("value").try_cast("double"))
    )


def flatten_metrics_by_date(df: DataFrame, json_col: str, metrics: list[str]) -> DataFrame:
    """``{date: {metric: value}}`` text to one row per date with the named metrics as columns."""
    days = F.from_json(F.col(json_col), "map<string,map<string,string>>")
    rest = [c for c in df.columns if c != json_col]
    return df.select(*rest, F.explode(days).alias("date", "_metrics")).select(
        *rest, "date", *[F.col("_metrics").getItem(m).try_cast("double").alias(m) for m in metrics]
    )


def flatten_report(df: DataFrame, dims: list[str], metrics: list[str]) -> DataFrame:
    """Report responses to rows: values are found by the position of their header name."""
    names = {kind: F.transform(f"{kind}_headers", lambda h: h["name"]) for kind in ("dimension", "metric")}
    rest = [c for c in df.columns if c not in ("dimension_headers", "metric_headers", "rows")]

    def value(kind: str, name: str) -> Column:
        at = F.array_position(F.col(f"_{kind}"), F.lit(name)).cast("int") - 1
        return F.get(F.col(f"_row.{kind}_values"), F.when(at >= 0, at))["value"].alias(name)

    return df.select(
        *rest, names["dimension"].alias("_dimension"), names["metric"].alias("_metric"), F.explode("rows").alias("_row")
    ).select(
        *rest, *[value("dimension", d) for d in dims], *[value("metric", m) for m in metrics]
    )


def typed_report(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Read ``yyyyMMdd`` dates where the report has a date, and metrics as numbers."""
    if "date" in df.columns:
        df = df.withColumn("date", compact_date(F.col("date")))
    return df.withColumns({m: F.col(m).try_cast("double") for m in metrics})


def read_report_pages(spark: SparkSession, paths: list[str] | str, dims: list[str], metrics: list[str]) -> DataFrame:
    """All result pages of a report as one table."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*dims, *metrics]])
    return typed_report(spark.read.schema(schema).json(paths), metrics)
