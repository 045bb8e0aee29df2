"""Rows of XML files that are read by several tasks each."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tags inside these are no tags.
_SECTIONS = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
_OPEN_SECTION = r"<!--|<!\[CDATA\[|<\?"
_BROKEN = "_broken"


def _well_formed(text: Column) -> Column:
    schema = T.StructType([T.StructField(_BROKEN, T.StringType())])
    return F.from_xml(text, schema, {"columnNameOfCorruptRecord": _BROKEN})[_BROKEN].isNull()


def _pieces(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """The texts up to each end tag of a row: what stands before the row (``gap``) and the row, empty behind the last."""
    text = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    row = F.regexp_extract("value", rf"(?s)<{re.escape(row_tag)}(?=[\s/>]).*", 0)
    cut = text.select(
        "value",
        row.alias("row"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    return cut.withColumn("gap", F.expr("left(value, length(value) - length(row))"))


def _irregular_files(pieces: DataFrame, row_tag: str) -> list[str]:
    """Files that must be read from start to end: cutting them at the end tags does not give one row per piece."""
    tag, row, gap = re.escape(row_tag), F.col("row"), F.col("gap")
    start = F.lit(rf"<{tag}(?=[\s/>])")
    value = F.col("value")
    bare = F.when(value.contains("<!") | value.contains("<?"), F.regexp_replace(value, _SECTIONS, "")).otherwise(value)
    is_row = row != ""
    one_row = (
        F.is_valid_utf8("value")
        & ~bare.rlike(_OPEN_SECTION)  # cut inside a comment or the like
        & ~bare.rlike(rf"</{tag}\s")
        & ~row.rlike(rf"^<{tag}[^<]*/>")
        & (F.regexp_count("value", start) == F.regexp_count(bare, start))
        & (F.regexp_count(bare, start) <= 1)
        & ~gap.rlike(r"""(?i)<\?xml[^>]*\sencoding\s*=\s*["'](?!utf-8["'])""")
        & (~is_row | _well_formed(F.concat(row, F.lit(f"</{row_tag}>"))))
    )
    # The root's start tag stands before the first row, its end tag behind the last; both must fit each other.
    closed = gap.rlike(r"^[ \t\r\n]*\z") | _well_formed(F.concat(F.lit("<gap>"), gap, F.lit("</gap>")))
    found = pieces.select(
        "file",
        F.struct("block", F.monotonically_increasing_id()).alias("place"),
        one_row.alias("one_row"),
        F.when(is_row & ~closed, F.regexp_replace("gap", "^\uFEFF", "")).alias("head"),
        F.when(~is_row, F.regexp_replace("gap", "^\uFEFF", "")).alias("tail"),
    )
    files = found.groupBy("file").agg(
        F.bool_and("one_row").alias("rows_fit"),
        F.count("head").alias("heads"),
        F.count("tail").alias("tails"),
        F.min_by(F.col("head").isNotNull(), "place").alias("head_first"),
        F.max_by(F.col("tail").isNotNull(), "place").alias("tail_last"),
        F.concat(F.coalesce(F.max("head"), F.lit("")), F.max("tail")).alias("rest"),
    )
    # Nothing may follow the root: without its last tag, the text is not complete.
    last_tag, bare_rest = r"</[^<>]+>[ \t\r\n]*\z", F.regexp_replace("rest", _SECTIONS, "")
    one_root = (
        _well_formed(F.col("rest"))
        & bare_rest.rlike(last_tag)
        & ~_well_formed(F.regexp_replace(bare_rest, last_tag, ""))
    )
    heads, tails = F.col("heads"), F.col("tails")
    in_place = (heads == 0) | ((heads == 1) & F.col("head_first"))
    regular = F.col("rows_fit") & in_place & (tails == 1) & F.col("tail_last") & one_root
    return [r.file for r in files.where(~F.coalesce(regular, F.lit(False))).select("file").collect()]


def read_xml_rows(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    """The rows that Spark's XML source gives, with large files read by as many tasks as a text file of their size.

    That source reads every file in one task. Here the files are read as texts that end with the row's end tag, and each
    text is parsed alone. All files are read once beforehand to check that this is the same: files for which it is not,
    like those with broken XML, an end tag in a comment, empty-element rows, rows in several groups or another encoding
    than UTF-8, go through the XML source, each in one task.
    """
    pieces = _pieces(spark, path, row_tag)
    irregular = _irregular_files(pieces, row_tag)
    rows = pieces.where(F.col("row") != "")
    if irregular:
        rows = rows.where(~F.col("file").isin(irregular))
    parsed = rows.select(F.from_xml(F.concat("row", F.lit(f"</{row_tag}>")), schema).alias("_row")).select("_row.*")
    if not irregular:
        return parsed
    whole = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    return parsed.unionByName(whole.where(F.col("_metadata.file_path").isin(irregular)))
