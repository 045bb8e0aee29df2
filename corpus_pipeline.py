"""From raw documents to a mixed training corpus in five stages, each one operator of the subpackage ``llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaign_analytics.llm.common import carried, fresh, named, row_keys, stored, without
from campaign_analytics.llm.decontaminate import decontaminate
from campaign_analytics.llm.language_id import held_out, identify, train
from campaign_analytics.llm.minhash_dedup import near_duplicates
from campaign_analytics.llm.mixing import mix
from campaign_analytics.llm.pii import find_pii

HAS_WORDS = r"[^\x20\x09-\x0D]"


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those the models reject go.

    Texts that are null or have no letter are rejected. Every row is judged by its own text, also where ids are null
    or repeated; equal texts share their fate. An empty table stays empty; columns of any names are kept.
    """
    key = fresh(docs, "row_key")
    keyed, _ = row_keys(docs, key)
    model = train(docs.filter(~held_out()).select("doc_id", "lang", "text"))
    judged = identify(keyed.select(F.col(key).alias("doc_id"), "text"), model)
    return without(keyed, key, judged.filter("rejected").select("doc_id"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows with a null or repeated id count as documents of their own and come after all others; rows that agree in id
    and text are copies, of which one stays. Texts without words, null ones among them, are in no group and stay.
    An empty table stays empty; columns of any names are kept.
    """
    key = fresh(docs, "row_key")
    keyed, made_up = row_keys(docs, key)
    if made_up:
        worded = F.coalesce(F.col("text").rlike(HAS_WORDS), F.lit(False))
        keyed = keyed.filter(worded).dropDuplicates([key]).unionByName(keyed.filter(~worded))
    grouped = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), shingle=5, percent=80)
    return without(keyed, key, grouped.filter("not kept").select("doc_id"))


def drop_benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item.

    Null and empty texts have none and stay. Every row is judged by its own text, also where ids are null or repeated.
    An empty table of documents or items changes nothing else; columns of any names are kept.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars counts the new text.

    A null text stays null, with a null count. Rows are masked one by one, whatever their ids; repeated rows come out
    equal. An empty table stays empty; columns of any names are kept, one of the name n_chars is set.
    """

    def masked(rows: DataFrame) -> DataFrame:
        found = find_pii(rows).withColumn("text", F.col("pii_masked")).drop("pii", "pii_masked")
        return found.withColumn("n_chars", F.length("text").cast("long"))

    return carried(docs, ["text"], masked).select(*[named(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with the figures of the mix.

    Null texts and texts without words have size 0 and are taken by their source's rate like others; a null source is
    a source of its own. Repeated rows count one by one. An empty table stays empty; columns named like the figures
    are replaced, all others are kept.
    """
    return mix(docs)


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_benchmark_overlaps),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
]

# Language models and the verification of near duplicates cannot be written in SQL; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
