"""Writers. Each is one distributed write; nothing is cut into blocks by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Replace (or append to) a parquet table."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_table(df: DataFrame, name: str) -> None:
    """Replace the table ``name`` of the session's catalogue, whatever columns it had.

    The rows are written aside, as a new version under the shared folder, and the name is pointed at them by one
    change of the catalogue. A reader sees the old version or the new one, never a part; queries that have begun go on
    with theirs. If the write fails, nothing has changed. Old versions stay until they are deleted.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"table-{name.replace('.', '-').replace('`', '')}")
    write_table(df, path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table under the shared folder: computed once, however often it is used from here on."""
    path = shared_dir(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_extract(df: DataFrame, path: str) -> None:
    """CSV extract with a header line for people to open."""
    df.write.mode("overwrite").csv(path, header=True)


HEADER = ["publisher", "publisherurl", "lastbuilddate"]


def _xml_text(value: str) -> str:
    return value.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def write_job_xml(
    df: DataFrame,
    path: str,
    publisher: str,
    publisher_url: str,
    built_at: str,
    order: list[str] | None = None,
    jobs_per_document: int = 5_000,
) -> None:
    """Feed rows as XML documents ``source`` that hold the header values and then one ``job`` per row.

    A feed of up to ``jobs_per_document`` rows is one document, in the order of the columns ``order`` (else of the
    job's text). A larger one is split by a hash of the row into as many documents as it needs, every one complete
    with its header and in order; all of them are written at the same time, one per file.
    """
    header = dict(zip(HEADER, [publisher, publisher_url, built_at], strict=True))
    lines = "\n".join(f"  <{name}>{_xml_text(value)}</{name}>" for name, value in header.items())
    top = f'<?xml version="1.0" encoding="UTF-8"?>\n<source>\n{lines}\n'
    rows = df.count()
    documents = max(1, -(-rows // jobs_per_document))
    job = F.to_xml(F.struct(*df.columns), {"rowTag": "job"}).alias("_xml")
    number = F.pmod(F.xxhash64(*df.columns), F.lit(documents)).alias("_document")
    entry = F.struct(*(order or []), "_xml")
    bodies = (
        df.select(*(order or []), job, number)
        .groupBy("_document")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["_xml"]), "\n").alias("_body"))
    )
    if rows == 0:
        bodies = df.sparkSession.range(1).select(F.lit("").alias("_body"))
    text = bodies.select(F.concat(F.lit(top), "_body", F.lit("\n</source>")).alias("value"))
    text.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def read_published_xml(spark: SparkSession, path: str, fields: list[str], header: bool = False) -> DataFrame:
    """Jobs of a published feed, all fields as text; with ``header`` also the header values of each job's document."""
    job = T.ArrayType(T.StructType([T.StructField(name, T.StringType()) for name in fields]))
    schema = T.StructType([*[T.StructField(name, T.StringType()) for name in HEADER], T.StructField("job", job)])
    documents = spark.read.format("xml").option("rowTag", "source").schema(schema).load(path)
    return documents.select(*(HEADER if header else []), F.inline("job"))


def append_link_log(df: DataFrame, path: str) -> None:
    """Add generated links to the log."""
    df.select("seq", "link").write.mode("append").parquet(path)


def read_link_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(F.col("seq").cast("bigint"), "link")
