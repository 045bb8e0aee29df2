"""Near-duplicate documents by SetSketch registers, banded, compared by likelihood and verified on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bloom_filter, connected_components, cut, might_hold, stored
from .words import Words, binary_column, chunks, gram_hashes, mix64, run_hashes, sorted_groups

BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
# Registers hold floor(1 - log_b(minimum)) of exponential minima with rate RATE, truncated to 0..LIMIT + 1.
# With a base this near to 1 two registers are equal about as often as the sets' similarity says.
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
BLOCK = 256  # members of a bucket compared in one task at a time
MARGIN = 4.0  # standard deviations that an estimate may lie below the threshold before a pair is not verified

_ODD = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mix64(np.arange(7_001, 7_001 + REGISTERS, dtype=np.uint64))


def shingle_sets(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within the text, and where each text's begin."""
    n = np.diff(words.at)
    grams = gram_hashes(words.hashes, shingle)
    owner = words.text_of()
    whole = owner[: len(grams)] == owner[shingle - 1 :] if len(grams) else np.zeros(0, bool)
    values, text = grams[whole], owner[: len(grams)][whole]
    few = np.flatnonzero((n > 0) & (n < shingle))
    if len(few):  # the whole sequence as one shingle
        values = np.concatenate([values, run_hashes(words.hashes, words.at[few], words.at[few + 1])])
        text = np.concatenate([text, few])
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    values, text = values[new], text[new]
    return values, np.searchsorted(text, np.arange(words.texts + 1))


def registers(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SetSketch registers of each set, one row per set; rows of empty sets are 0.

    An exponential variable is an increasing function of its uniform hash, so the hashes are reduced to their
    minimum first and the logarithms taken once per register. Registers of a union are the maxima.
    """
    out = np.zeros((len(at) - 1, REGISTERS), np.uint16)
    filled = np.flatnonzero(np.diff(at))
    if not len(filled):
        return out
    for i in range(REGISTERS):
        least = np.minimum.reduceat((values * _ODD[i] + _ADD[i]) >> np.uint64(11), at[:-1][filled])
        uniform = (least.astype(np.float64) + 1.0) * 2.0**-53
        level = np.floor(1.0 - np.log(-np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE) / np.log(BASE))
        out[filled, i] = np.clip(level, 0, LIMIT + 1)
    return out


def estimate(first: np.ndarray, second: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity from the registers that are larger, equal and smaller, given the set sizes.

    With shares u and v of both sizes in their sum, the chance of one side being larger is near
    u - v J or v - u J, of both being equal near J; setting the derivative of the log-likelihood to zero is
    done by bisection on J in [0, min(u/v, v/u)].
    """
    more = (first > second).sum(-1).astype(np.float64)
    less = (first < second).sum(-1).astype(np.float64)
    same = REGISTERS - more - less
    u = size_a / (size_a + size_b)
    v = 1.0 - u
    low, high = np.zeros_like(u), np.minimum(u / v, v / u)
    for _ in range(30):
        j = (low + high) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = same / np.maximum(j, 1e-12) - more * v / np.maximum(u - v * j, 1e-12) - less * u / np.maximum(v - u * j, 1e-12)
        rising = slope > 0
        low, high = np.where(rising, j, low), np.where(rising, high, j)
    return (low + high) / 2


def least_estimate(percent: int) -> float:
    t = percent / 100
    return t - MARGIN * (t * (1 - t) / REGISTERS) ** 0.5


def sketch(docs: DataFrame, shingle: int, word_kind: str = "lower") -> DataFrame:
    """doc_id, n_shingles, two keys that equal sets share, and the registers as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for row, end, words in chunks(texts, word_kind):
                values, at = shingle_sets(words, shingle)
                sums = np.zeros((2, len(values) + 1), np.uint64)
                np.cumsum(mix64(values), out=sums[0, 1:])
                np.cumsum(mix64(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=sums[1, 1:])
                keys = (sums[:, at[1:]] - sums[:, at[:-1]]).view(np.int64)
                regs = registers(values, at)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, end - row),
                        pa.array(np.diff(at).astype(np.int64)),
                        pa.array(keys[0]),
                        pa.array(keys[1]),
                        binary_column(regs.reshape(-1), np.arange(end - row + 1) * REGISTERS),
                    ],
                    names=["doc_id", "n_shingles", "k1", "k2", "regs"],
                )

    schema = "doc_id long, n_shingles long, k1 long, k2 long, regs binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _bands(reps: DataFrame) -> DataFrame:
    """(band key, id) for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 2048):
                part = batch.slice(row, 2048)
                regs = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, ROWS)
                key = np.zeros(regs.shape[:2], np.uint64) + mix64(np.arange(1, BANDS + 1, dtype=np.uint64))
                for i in range(ROWS):
                    key = mix64(key ^ (regs[:, :, i].astype(np.uint64) + np.uint64(i << 32)))
                ids = np.repeat(part.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(ids)], names=["band", "rep"])

    return reps.select("rep", "regs").mapInArrow(run, "band long, rep long")


def _linked(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity, in whole numbers."""
    both = len(np.intersect1d(first, second, assume_unique=True))
    return 100 * both >= percent * (len(first) + len(second) - both)


def _sets_of(texts: pa.Array, shingle: int, word_kind: str) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, _, words in chunks(texts, word_kind):
        values, at = shingle_sets(words, shingle)
        out += np.split(values, at[1:-1])
    return out


def _verify_pairs(pairs: DataFrame, shingle: int, word_kind: str, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the similarity; rows carry both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                part = batch.slice(row, 64)
                one = _sets_of(part.column(2), shingle, word_kind)
                two = _sets_of(part.column(3), shingle, word_kind)
                keep = [i for i in range(part.num_rows) if _linked(one[i], two[i], percent)]
                if keep:
                    yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(keep)) for c in (0, 1)], names=["a", "b"])

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _promising(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose estimate does not rule them out."""
    least = least_estimate(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 4096):
                part = batch.slice(row, 4096)
                regs = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in (2, 3)]
                sizes = [part.column(c).to_numpy().astype(np.float64) for c in (4, 5)]
                keep = np.flatnonzero(estimate(*regs, *sizes) >= least)
                yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(keep)) for c in (0, 1)], names=["a", "b"])

    fits = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    return pairs.filter(fits).select("a", "b", "regs_a", "regs_b", "n_a", "n_b").mapInArrow(run, "a long, b long")


def _within_blocks(members: DataFrame, shingle: int, word_kind: str, percent: int) -> DataFrame:
    """Links between members of different components that meet in a bucket, verified where they meet.

    Each task holds two blocks of a bucket. A pair is verified if its estimate allows a link and nothing
    found so far joins the two, so that a task returns at most one link fewer than it has members.
    """
    least = least_estimate(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["band", "i", "j"]):
            ids = group.column("rep").to_numpy()
            block = group.column("block").to_numpy()
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            parts = [np.flatnonzero(block == i), np.flatnonzero(block == j)]
            regs = np.frombuffer(b"".join(group.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            sizes = group.column("n").to_numpy().astype(np.float64)
            _, label = np.unique(group.column("component").to_numpy(), return_inverse=True)
            texts = group.column("text").combine_chunks()
            sets: dict[int, np.ndarray] = {}
            links = []
            for x in parts[0]:
                others = parts[1][ids[parts[1]] > ids[x]] if i == j else parts[1]
                others = others[label[others] != label[x]]
                if not len(others):
                    continue
                guess = estimate(regs[x][None, :], regs[others], np.full(len(others), sizes[x]), sizes[others])
                for y in others[np.argsort(-guess)][: int((guess >= least).sum())]:
                    if label[x] == label[y]:
                        continue
                    for z in (x, y):
                        if z not in sets:
                            sets[z] = _sets_of(texts.slice(int(z), 1), shingle, word_kind)[0]
                    if _linked(sets[x], sets[y], percent):
                        links.append((int(ids[x]), int(ids[y])))
                        label[label == label[y]] = label[x]
            if links:
                a, b = np.array(links, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = members.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return dealt.select("band", "i", "j", "block", "rep", "n", "component", "regs", "text").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, word_kind: str = "lower") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text).

    A document's set is its distinct shingles of ``shingle`` words (A-Z lower-cased, cut at white space);
    with fewer words the whole sequence is one shingle, without words or with a null text the set is
    empty and the document is linked with nothing. Documents are linked where 100 * intersection >=
    percent * union. component_id is the smallest id reachable by links, kept tells whether it is the
    document's own.

    Equal sets become one class first, so copies cost one grouped minimum. Classes are banded: 32 bands of 5
    registers miss a pair at similarity 0.8 about three times in a million. In each bucket every
    class is compared with the smallest one; what that leaves in different components meets in blocks. Every
    candidate that the joint estimate does not rule out (4 standard deviations) is verified on the full sets
    of the whole texts.

    Ids should be unique; repeated rows each get their row, in one component. A null id stays null and is
    linked with nothing. An empty table gives no rows; other columns are ignored.
    """
    sketched = stored(sketch(docs, shingle, word_kind), "sketch")
    filled = sketched.filter("n_shingles > 0")
    classes = filled.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "classes")
    own = filled.select(F.col("doc_id").alias("rep"), "k1", "k2", "n_shingles", "regs")
    reps = classes.join(own, ["rep", "k1", "k2", "n_shingles"]).dropDuplicates(["rep", "k1", "k2"])
    reps = stored(reps.select("rep", F.col("n_shingles").alias("n"), "regs"), "reps")

    buckets = _bands(reps)
    several = buckets.groupBy("band").agg(F.count("*").alias("members"), F.min("rep").alias("centre"))
    members = stored(buckets.join(several.filter("members > 1"), "band"), "buckets")
    pairs = members.filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    side = [reps.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("regs").alias(f"regs_{x}")) for x in "ab"]
    pairs = cut(_promising(pairs.join(side[0], "a").join(side[1], "b"), percent))

    # Texts of documents that take part in a comparison; a filter of bounded size spares the others the shuffle.
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()

    def texts(ids: DataFrame, name: str) -> DataFrame:
        rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter("text is not null")
        maybe = might_hold(rows, "id", bloom_filter(ids, "id"), "_maybe").filter("_maybe").drop("_maybe")
        return maybe.join(ids, "id", "left_semi").dropDuplicates(["id"]).withColumnRenamed("text", name)

    with_texts = pairs.join(texts(needed, "text_a").withColumnRenamed("id", "a"), "a")
    with_texts = with_texts.join(texts(needed, "text_b").withColumnRenamed("id", "b"), "b")
    links = cut(_verify_pairs(with_texts, shingle, word_kind, percent))
    found = cut(connected_components(links))

    # Buckets of two were settled by their one pair. Of buckets with the same members one is enough. Members of a
    # bucket's largest component need not meet each other: its blocks, numbered after the others, only meet those.
    wide = members.filter("members > 2").join(found.withColumnRenamed("id", "rep"), "rep", "left")
    wide = cut(wide.select("band", "rep", F.coalesce("component", "rep").alias("component")))
    parts = wide.groupBy("band", "component").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("rep")).alias("who"))
    open_ = parts.groupBy("band").agg(
        F.max(F.struct("m", "component")).alias("core"), F.sum("m").alias("m"), F.bit_xor("who").alias("who"), F.count("*").alias("parts")
    )
    open_ = open_.filter("parts > 1").groupBy("who", "m").agg(F.min(F.struct("band", "core")).alias("first")).select("first.*", "m")
    open_ = open_.select(
        "band",
        F.col("core.component").alias("core"),
        F.ceil((F.col("m") - F.col("core.m")) / BLOCK).cast("int").alias("rest_blocks"),
        F.ceil(F.col("core.m") / BLOCK).cast("int").alias("core_blocks"),
    )
    at = F.xxhash64("rep")
    in_core = F.col("component") == F.col("core")
    left = wide.join(open_, "band").withColumns(
        {
            "block": F.when(in_core, F.col("rest_blocks") + F.pmod(at, F.col("core_blocks")))
            .otherwise(F.pmod(at, F.col("rest_blocks")))
            .cast("int"),
            "last": F.col("rest_blocks") - 1 + F.when(in_core, 0).otherwise(F.col("core_blocks")),
        }
    )
    left = cut(left.select("band", "rep", "component", "block", "last"))
    if not left.isEmpty():
        ids = left.select(F.col("rep").alias("id")).distinct()
        left = left.join(reps, "rep").join(texts(ids, "text").withColumnRenamed("id", "rep"), "rep")
        left = left.withColumn("other", F.explode(F.expr("sequence(0, last)")))
        left = left.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        links = cut(links.union(_within_blocks(left, shingle, word_kind, percent)))
        found = cut(connected_components(links))

    classes = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    classes = classes.select("k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    out = sketched.select("doc_id", "n_shingles", "k1", "k2").join(classes, ["k1", "k2", "n_shingles"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return out
