"""Rows of XML files read by several tasks: the same rows as the XML source, whatever a file looks like."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from campaign_analytics.sources import jobs
from campaign_analytics.sources.xml_rows import _irregular_files, _pieces
from registry import feeds

TAG, SCHEMA = jobs.LISTING_SCHEMAS["jobsora"]
FIELDS = "<name>N{0}</name><region>Ulm</region><jobtype>x</jobtype><salary>13</salary><description>D</description>"
ROW = '<job id="{0}">' + FIELDS + "</job>"
A, B, C = (ROW.format(i) for i in (1, 2, 3))

REGULAR = {
    "plain": f"<x>{A}\n{B}</x>",
    "header": f'\ufeff<?xml version="1.0" encoding="UTF-8"?>\n<x><publisher>P</publisher>{A}{B}</x>\n<!-- end -->',
    "between": f'<x>{A}<meta a="1">q</meta><!-- c -->{B}text{C}</x>',
    "deep": f"<a><b>{A}{B}</b></a>",
    "texts": f"<x>{A.replace('Ulm', 'a<![CDATA[<p>ü</p> & <!-- b]]>c &amp; &#252;<!-- no -->')}\r\n{B}</x>",
    "markup": f"<x>{A.replace('>D<', '><p>a</p> b <b>c</b><')}{B}</x>",
    "start_tags": f"<x><job\n id = 'a>b'\t>{FIELDS.format(1)}</job><job>text</job><job></job>{B}</x>",
    "namespaces": f'<x xmlns="http://p" xmlns:q="http://q">{A.replace("salary", "q:salary")}{B}</x>',
    "no_rows": "<x>\n</x>",
}
IRREGULAR = {
    "empty_element": f'<x>{A}<job id="2"/>{C}</x>',
    "end_tag_with_blank": f"<x>{A.replace('</job>', '</job >')}{B}</x>",
    "row_in_comment": f"<x>{A}<!-- {B} -->{C}</x>",
    "start_in_comment": f"<x>{A}<!-- <job> -->{C}</x>",
    "end_in_cdata": f"<x>{A.replace('Ulm', '<![CDATA[a </job> b]]>')}{B}</x>",
    "end_in_instruction": f"<x>{A}<?php </job> ?>{B}</x>",
    "nested": f"<x>{A}<job id='5'><name>n</name>{B}</job>{C}</x>",
    "groups": f"<x><c>{A}</c><c>{B}{C}</c></x>",
    "entity": f'<!DOCTYPE x [<!ENTITY co "Co">]><x>{A.replace("Ulm", "&co;")}{B}</x>',
    "latin": f'<?xml version="1.0" encoding="ISO-8859-1"?><x>{A.replace("Ulm", "Köln")}{B}</x>'.encode("latin-1"),
    "utf16": f'<?xml version="1.0" encoding="UTF-16"?><x>{A}{B}</x>'.encode("utf-16"),
    "truncated": f"<x>{A}{B[:-20]}",
    "no_end_tag": f"<x>{A}{B[:-6]}",
    "broken_row": f"<x>{A}{B.replace('</name>', '</nam>')}{C}</x>",
    "bare_ampersand": f"<x>{A}{B.replace('Ulm', 'Ulm & Co')}{C}</x>",
    "broken_between": f"<x>{A}a & b{C}</x>",
    "stray_end_tag": f"<x>{A}</job>{C}</x>",
    "no_root": A + B + C,
    "row_before_root": f"{A}<x>{B}{C}</x>",
    "two_roots": f"<x>{A}</x>\n<x>{C}</x>",
    "text_behind": f"<x>{A}{C}</x>text",
    "wrong_root": f"<x>{A}{C}</y>",
}


def _write(folder, name, text):
    path = folder / f"{name} 1.xml"
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def _plain(spark, path):
    return spark.read.format("xml").option("rowTag", TAG).schema(SCHEMA).load(path)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _flat(df):
    return df.select(
        F.col("_id").alias("referencenumber"), F.col("name").alias("title"), F.col("region").alias("city"), "salary", "description"
    )


def test_any_file_gives_the_rows_of_the_xml_source(spark, tmp_path):
    """All files at once and cut into small splits: those that cannot be cut are found, and only those."""
    for name, text in {**REGULAR, **IRREGULAR}.items():
        _write(tmp_path, name, text)
    expected = _rows(_flat(_plain(spark, str(tmp_path))))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("37", "1000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = _irregular_files(_pieces(spark, str(tmp_path), TAG), TAG)
            assert sorted(f.rsplit("/", 1)[1] for f in found) == sorted(f"{name}%201.xml" for name in IRREGULAR)
            assert _rows(jobs.read_job_xml(spark, str(tmp_path), "jobsora")) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("board", ["stepstone", "jobsora"])
def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, board):
    listing = (
        '<joblisting reference_id="{0}"><jobdetails><jobtitle>Bär {0}</jobtitle><joblocations><location><city>Köln</city></location>'
        "</joblocations><introduction><![CDATA[<div>I</div>]]></introduction><offer>{0}</offer></jobdetails></joblisting>"
    )
    row = listing if board == "stepstone" else ROW
    path = _write(tmp_path, "large", "<feed>\n" + "\n".join(row.format(i) for i in range(3000)) + "\n</feed>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
        read = jobs.read_job_xml(spark, path, board)
        assert read.rdd.getNumPartitions() > 10
        assert max(read.rdd.glom().map(len).collect()) < 300
        assert sorted(int(r.referencenumber) for r in read.collect()) == list(range(3000))
        titles = {r.title for r in read.collect()}
        assert titles == {("Bär %d" if board == "stepstone" else "N%d") % i for i in range(3000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_broken_file_leaves_the_others_to_many_tasks(spark, tmp_path):
    _write(tmp_path, "large", "<x>" + "\n".join(ROW.format(i) for i in range(1000)) + "</x>")
    _write(tmp_path, "broken", IRREGULAR["truncated"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        read = jobs.read_job_xml(spark, str(tmp_path), "jobsora")
        assert max(read.rdd.glom().map(len).collect()) < 200
        assert _rows(read) == _rows(_flat(_plain(spark, str(tmp_path))))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_listings_are_written_by_many_tasks(spark, tmp_path):
    """The part table lies in one row group; its listings are many times as large."""
    parts = spark.range(500).select(
        F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"),
        F.lit(1).alias("p_size"), F.lit(1.0).alias("p_retailprice"),
    )
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = feeds._listings(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    assert len(files) > 1 and max(f.length for f in files) < sum(f.length for f in files)
    assert jobs.read_job_xml(spark, path, "stepstone").count() == 500
