"""The operators of this subpackage applied to the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import decode, encode
from .decontaminate import contaminated_spans
from .fill_middle import fill_in_middle, restore
from .html_extract import extract_main_text
from .html_extract import train as train_extractor
from .language_id import held_out, identify, train
from .license_scan import license_matches
from .minhash_dedup import near_duplicates
from .mixing import mix_plan
from .near_vectors import near_vectors
from .oracle import ORACLE
from .pii import KINDS, base_spans, find_pii, span_list
from .spelling import spelling_variants, word_counts
from .substring_dedup import remove_repeats
from .url_filter import canonical_url, host_and_path, judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = remove_repeats(_table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()).select("doc_id", "lang", "text"))
    return identify(docs, model).withColumn("held_out", held_out())


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item, with their items and the longest overlap."""
    spans = contaminated_spans(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    longest = F.max(F.struct((F.col("end") - F.col("start")).alias("n"), "n_equal"))
    found = spans.groupBy("doc_id").agg(
        F.countDistinct("item_id").alias("n_items"), F.min("item_id").alias("item_id"), longest.alias("longest")
    )
    return found.select("doc_id", "n_items", "item_id", F.col("longest.n").alias("n_words"), F.col("longest.n_equal").alias("n_equal"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("pii", lambda x: x["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k.name))).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base
    ]
    return docs.select(
        "doc_id",
        *counts,
        F.sha2(span_list(base_spans(F.col("pii"))), 256).alias("base_sha256"),
        span_list(F.col("pii")).alias("spans"),
    )


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
SPAM_HOST = r"^([^.]*\.)?[a-z0-9]*(spam|cheap|casino|pills|free)[a-z0-9]*-[a-z0-9-]*\."


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed URLs are those of hosts whose name marks them as spam, in their canonical spelling."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(host_and_path("url")[0].rlike(SPAM_HOST)).select(canonical_url("url").alias("canonical"))
    return judge_urls(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return extract_main_text(pages, train_extractor(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # only this query needs the vocabulary files

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = decode(encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return docs.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = restore(fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text")))
    return docs.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(_table(spark, sf_dir, "documents"), slip_every=199))


QUERIES = {
    "op1_vectors": op1_vectors,
    "op2_substrings": op2_substrings,
    "op3_licenses": op3_licenses,
    "op4_language": op4_language,
    "op5_decontamination": op5_decontamination,
    "op6_minhash": op6_minhash,
    "op7_pii": op7_pii,
    "op8_urls": op8_urls,
    "op9_html": op9_html,
    "op10_mixing": op10_mixing,
    "op11_bpe": op11_bpe,
    "op12_fill_middle": op12_fill_middle,
    "op13_spelling": op13_spelling,
}

__all__ = ["ORACLE", "QUERIES"]
