"""Near-duplicate vectors by p-stable hashing of normalised vectors and exact cosines inside buckets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut, stored
from .words import mix64, sorted_groups

WIDTH = 2.5  # width of a quantisation step on the unit sphere
MISS = 1e-3  # chance that a pair at the threshold shares no bucket
CROWD = 50  # vectors that unrelated data should leave in a bucket
BLOCK = 512  # members of a bucket held against each other at a time


def collision(distance: float) -> float:
    """Chance that one quantised projection is equal for two points at this distance."""
    r = WIDTH / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class Tables:
    """How many projections make a key, and how many keys a vector has."""

    projections: int
    tables: int


def plan_tables(n: int, threshold: float) -> Tables:
    """More projections the more vectors, so that buckets stay small; as many tables as the miss rate asks for."""
    near, far = collision(math.sqrt(2 - 2 * threshold)), collision(math.sqrt(2))
    k = max(4, math.ceil(math.log(max(n, 1) / CROWD) / -math.log(far)) if n > CROWD else 4)
    return Tables(k, math.ceil(math.log(MISS) / math.log1p(-(near**k))))


def projections(dim: int, plan: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions and offsets of every table; the same for the same plan and dimension.

    Directions are multiples of 2^-13 and vectors are rounded to multiples of 2^-20 before they are projected:
    sums of their products are exact, so that a vector has the same keys in every task.
    """
    draw = np.random.default_rng(20_240_917 + dim)
    count = plan.tables * plan.projections
    return np.rint(draw.standard_normal((dim, count)) * 2**13) / 2**13, draw.random(count) * WIDTH


def bucket_keys(unit: np.ndarray, plan: Tables, drawn: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One 64-bit key per vector and table."""
    cells = np.floor((np.rint(unit * 2**20) / 2**20 @ drawn[0] + drawn[1]) / WIDTH).astype(np.int64).view(np.uint64)
    cells = cells.reshape(len(unit), plan.tables, plan.projections)
    keys = np.zeros(cells.shape[:2], np.uint64) + mix64(np.arange(1, plan.tables + 1, dtype=np.uint64))
    for i in range(plan.projections):
        keys = mix64(keys ^ (cells[:, :, i] + np.uint64(0x9E3779B97F4A7C15)))
    return keys.view(np.int64)


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


TIE = 1e-9  # unit products this near to the threshold are decided exactly


def at_least(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether the cosine of two vectors reaches the threshold, in whole numbers.

    Doubles are whole numbers times a power of two, and the cosine is compared by its square. The threshold is the
    decimal that is written, so that a cosine of exactly nine tenths reaches 0.9.
    """

    def whole(x: np.ndarray) -> list[int]:
        parts = [Fraction(float(v)) for v in x]
        scale = max(p.denominator for p in parts)
        return [int(p * scale) for p in parts]

    x, y = whole(a), whole(b)
    dot = sum(p * q for p, q in zip(x, y, strict=True))
    limit = Fraction(repr(threshold))
    squares = sum(p * p for p in x) * sum(q * q for q in y)
    reached = Fraction(dot * dot) >= limit * limit * squares
    return dot >= 0 and reached if limit >= 0 else dot >= 0 or not Fraction(dot * dot) > limit * limit * squares


def _linked(raw: np.ndarray, unit: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``a`` and ``b`` whose cosine reaches the threshold."""
    product = unit[a] @ unit[b].T
    x, y = np.nonzero(product >= threshold - TIE)
    close = np.flatnonzero(product[x, y] < threshold + TIE)
    x, y = a[x], b[y]
    keep = x < y if a is b else np.ones(len(x), bool)
    for i in close[keep[close]]:
        keep[i] = at_least(raw[x[i]], raw[y[i]], threshold)
    return x[keep], y[keep]


def _usable(vectors: DataFrame, column: str) -> DataFrame:
    """id, dimension and bytes in double precision of vectors that can be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1)
            sizes = np.diff(rows.offsets.to_numpy())
            ids, dims, out = [], [], []
            for i in np.flatnonzero((sizes > 0) & ~rows.is_null().to_numpy(zero_copy_only=False)):
                row = rows[int(i)].values
                if row.null_count:
                    continue
                x = row.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(x).max()
                if not np.isfinite(top) or top == 0:
                    continue
                # scaled by a power of two, which changes no direction but keeps squares finite
                x = np.ldexp(x, -int(np.frexp(top)[1]))
                ids.append(int(i))
                dims.append(len(x))
                out.append((x + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                names=["id", "dim", "vec"],
            )

    plain = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col(column).cast("array<double>"))
    return plain.filter("id is not null").mapInArrow(run, "id long, dim int, vec binary")


def _keyed(classes: DataFrame, plan: Tables) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple] = {}
        for batch in batches:
            reps, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                if dim not in drawn:
                    drawn[dim] = projections(int(dim), plan)
                for part in np.array_split(rows, max(1, len(rows) // 1024)):
                    unit = _unit(batch.column(2).take(pa.array(part)).to_pylist())
                    keys = mix64(bucket_keys(unit, plan, drawn[dim]).view(np.uint64) ^ np.uint64(dim)).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.reshape(-1)), pa.array(np.repeat(reps[part], plan.tables))], names=["key", "rep"]
                    )

    return classes.select("rep", "dim", "vec").mapInArrow(run, "key long, rep long")


def _bucket_links(dealt: DataFrame, plan: Tables, threshold: float) -> DataFrame:
    """Per bucket: (rep, other, links). links counts partners met first in this table; other leads to the same component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, tuple] = {}
        for group in sorted_groups(batches, ["key", "i", "j"]):
            if group.num_rows < 2:
                continue
            ids, copies, block = (group.column(c).to_numpy() for c in ("rep", "copies", "block"))
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            order = np.lexsort((ids, block != i))
            ids, copies, block = ids[order], copies[order], block[order]
            vectors = group.column("vec").take(pa.array(order)).to_pylist()
            unit = _unit(vectors)
            raw = np.frombuffer(b"".join(vectors), np.float64).reshape(unit.shape)
            one = int((block == i).sum())
            a, b = (np.arange(len(ids)),) * 2 if i == j else (np.arange(one), np.arange(one, len(ids)))
            x, y = _linked(raw, unit, a, b, threshold)
            if not len(x):
                continue
            dim = unit.shape[1]
            if dim not in drawn:
                drawn[dim] = projections(dim, plan)
            who, place = np.unique(np.concatenate([x, y]), return_inverse=True)
            keys = mix64(bucket_keys(unit[who], plan, drawn[dim]).view(np.uint64) ^ np.uint64(dim)).view(np.int64)
            key = group.column("key")[0].as_py()
            links = np.zeros(len(ids), np.int64)
            for s in range(0, len(x), 8192):
                px, py = place[: len(x)][s : s + 8192], place[len(x) :][s : s + 8192]
                first = (keys[px] == keys[py]).argmax(1)  # the first table in which the two meet
                here = keys[px, first] == key
                np.add.at(links, x[s : s + 8192][here], copies[y[s : s + 8192][here]])
                np.add.at(links, y[s : s + 8192][here], copies[x[s : s + 8192][here]])
            root = np.arange(len(ids))
            while True:  # smallest member of each local component
                low = root.copy()
                np.minimum.at(low, x, root[y])
                np.minimum.at(low, y, root[x])
                low = low[low]
                if (low == root).all():
                    break
                root = low
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[who]), pa.array(ids[root[who]]), pa.array(links[who])], names=["rep", "other", "links"]
            )

    columns = dealt.select("key", "i", "j", "block", "rep", "copies", "vec")
    return columns.mapInArrow(run, "rep long, other long, links long")


def near_vectors(vectors: DataFrame, threshold: float = 0.9, column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors`` (vec_id and an array column).

    Vectors are linked where their cosine in double precision is at least ``threshold``, and exactly there: products
    that rounding could move across it are compared in whole numbers. n_links counts the
    other vectors linked directly, component_id is the smallest vec_id reachable, kept tells whether it is
    the vector's own. Equal vectors become one class first. Classes are bucketed by several quantised
    projections in each of several tables; the numbers follow from the count of vectors so that a pair at
    the threshold is missed once in a thousand and unrelated vectors leave small buckets. Every pair inside a
    bucket is compared exactly, block by block, and counted in the first table where it meets; a bucket
    returns counts and one link per member, not pairs. Large buckets are dealt out over pairs of blocks.

    Null, empty and zero vectors and those with null or non-finite components link with nothing, nor do
    vectors of different lengths. A null id keeps its row, with a null component. Ids should be unique;
    repeated rows count as several vectors. An empty table gives no rows; other columns are ignored.
    """
    usable = stored(_usable(vectors, column), "vectors")
    classes = usable.groupBy("dim", "vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes, "vector-classes")
    plan = plan_tables(classes.count(), threshold)

    keyed = stored(_keyed(classes, plan), "vector-keys")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    sizes = sizes.select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    rows = keyed.join(sizes, "key")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    rows = rows.join(classes.select("rep", "copies", "vec"), "rep")
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    met = cut(_bucket_links(dealt, plan, threshold).groupBy("rep", "other").agg(F.sum("links").alias("links")))

    component = connected_components(met.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = classes.join(links, "rep", "left").join(component.withColumnRenamed("id", "rep"), "rep", "left")
    classes = classes.select(
        "dim",
        "vec",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    found = usable.join(classes, ["dim", "vec"]).select("id", "n_links", "component_id").dropDuplicates(["id"])
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    out = ids.join(found, ids["vec_id"] == found["id"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
