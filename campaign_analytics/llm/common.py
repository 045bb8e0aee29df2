"""What several operators share: durable cuts of lineage, blocked Bloom filters, connected components."""

from __future__ import annotations

import atexit
import functools
import pickle
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_root(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``; a temporary one only on a single machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="llm-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def clear_run(spark: SparkSession) -> None:
    """Delete what this application has stored, once none of its frames is used any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_root(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def named(name: str) -> Column:
    """A column by its whole name, whatever signs are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    while name in frame.columns:
        name = f"_{name}"
    return name


def carried(frame: DataFrame, needed: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``work`` makes of the needed columns, the others carried along under names that cannot clash with its own.

    Columns that ``work`` adds replace those of the same name and come last.
    """
    others = {f"carried_{i}": c for i, c in enumerate(c for c in frame.columns if c not in needed)}
    done = work(frame.select(*map(named, needed), *[named(c).alias(safe) for safe, c in others.items()]))
    added = [c for c in done.columns if c not in needed and c not in others]
    place = {c: safe for safe, c in others.items()} | {c: c for c in needed}
    kept = [named(place[c]).alias(c) for c in frame.columns if c not in added]
    return done.select(*kept, *map(named, added))


def row_keys(docs: DataFrame, key: str, id_column: str = "doc_id", text: str = "text") -> tuple[DataFrame, bool]:
    """Add a long that tells rows apart, and say whether any had to be made up.

    A row whose id no other row has keeps it as its key. Rows with a null or repeated id get a number above 2 ** 62
    from a hash of id and text, so that only rows equal in both share one. Ids lie below that.
    """
    ids = docs.select(named(id_column).cast("long").alias("id"))
    again = cut(ids.groupBy("id").count().filter("count > 1 or id is null").select(F.col("id").alias(fresh(docs, "again"))))
    own = named(id_column).cast("long")
    if again.isEmpty():
        return docs.withColumn(key, own), False
    beyond = F.lit(1 << 62).bitwiseOR(F.xxhash64(named(id_column), named(text)).bitwiseAND(F.lit((1 << 62) - 1)))
    mark = fresh(docs, "made_up")
    marked = docs.join(again.withColumn(mark, F.lit(True)), own.eqNullSafe(F.col(again.columns[0])), "left").drop(again.columns[0])
    return marked.withColumn(key, F.when(F.col(mark), beyond).otherwise(own)).drop(mark), True


def without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows whose key is not in the one column of ``gone``; the key is dropped."""
    out = fresh(docs, "gone")
    listed = gone.toDF(out).distinct()
    return docs.join(listed, F.col(key) == F.col(out), "left_anti").drop(key)


def cut(frame: DataFrame) -> DataFrame:
    """Write a small intermediate to the shared checkpoint folder and go on from there.

    A lost executor then costs a reread, and the input is not computed again for each use.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(frame.sparkSession))
    return frame.checkpoint()


def stored(frame: DataFrame, name: str) -> DataFrame:
    """As ``cut``, but columnar and compressed: for intermediates with wide rows."""
    path = f"{shared_root(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def shared_object(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast an object of bounded size with its class, and give what loads it inside a task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


# A filter has at most this many words of 64 bits, so that its table can be broadcast however long the list is.
# A list of more than a few million keys only makes the filter let more rows through to the exact join.
MAX_BLOOM_WORDS = 1 << 17


def _bloom_place(key: Column, words: int) -> tuple[Column, Column]:
    """The word of the filter that a key lives in, and its six bits there."""
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for i in range(6):
        bit = F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return F.pmod(first, F.lit(words)), mask


def bloom_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """A blocked Bloom filter of a column as a table of at most ``MAX_BLOOM_WORDS`` rows (word, bits).

    All bits of a key lie in one word, so that one lookup tests it. About 16 bits a key up to the bound.
    """
    n = keys.count()
    words = 64
    while words < MAX_BLOOM_WORDS and words * 64 < 16 * n:
        words *= 2
    at, mask = _bloom_place(F.col(key), words)
    table = keys.select(at.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))
    return cut(table), words


def might_hold(frame: DataFrame, key: str, bloom: tuple[DataFrame, int], flag: str) -> DataFrame:
    """Add a column that is false only where the key is surely not in the filter; null keys are not in it."""
    table, words = bloom
    word, bits, mask = (fresh(frame, f"bloom_{part}") for part in ("word", "bits", "mask"))
    at, mine = _bloom_place(F.col(key), words)
    tested = frame.withColumns({word: at, mask: mine}).join(F.broadcast(table.toDF(word, bits)), word, "left")
    held = F.col(key).isNotNull() & (F.col(bits).bitwiseAND(F.col(mask)) == F.col(mask))
    return tested.withColumn(flag, F.coalesce(held, F.lit(False))).drop(word, mask, bits)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every id that has an edge: columns id, component.

    ``edges`` has columns a and b (long). Large-star and small-star steps alternate until the edges no longer
    change; each step is a grouped minimum and a join, and each round is cut from its lineage. Ids without
    edges are left out; an empty table gives an empty table.
    """
    big, small = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    state = cut(edges.filter("a <> b").select(big, small).distinct())
    seen = None
    while True:
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = star.filter("u <> v").distinct()
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        joined = star.join(least, "u")
        state = joined.select("u", F.col("m").alias("v")).union(
            joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        state = cut(state.distinct())
        mark = state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            break
        seen = mark
    roots = state.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
