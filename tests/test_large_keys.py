"""Order keys, ranks of hot keys, measured joins and pages against their plain definitions."""

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from campaign_analytics.operators import joins, ordering, sets, windows


def test_order_keys_sort_as_their_columns(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1, TIMESTAMP_NTZ'2024-01-01 00:00:00.000001', 9223372036854775807L, DATE'2024-01-01', 5),
        (2, TIMESTAMP_NTZ'2024-01-01 00:00:00.000001', -9223372036854775808L, DATE'0001-01-01', -2147483648),
        (3, TIMESTAMP_NTZ'2024-01-01 00:00:00.000001', NULL, NULL, NULL),
        (4, NULL, 1L, DATE'9999-12-31', 2147483647), (5, TIMESTAMP_NTZ'9999-12-31 23:59:59.999999', 5L, DATE'1970-01-01', 0),
        (6, TIMESTAMP_NTZ'0001-01-01 00:00:00', 5L, DATE'1969-12-31', -1) t(k, ts, n, d, i)""")
    for spec in (["ts", "n"], ["ts", "-n"], ["-ts", "n"], ["d", "i", "-i"], ["-d", "n"], ["i"], ["-n"]):
        want = [F.col(c[1:]).desc_nulls_first() if c[0] == "-" else F.col(c).asc_nulls_first() for c in spec]
        ranked = df.select(
            F.dense_rank().over(Window.orderBy(*want)).alias("a"),
            F.dense_rank().over(Window.orderBy(ordering.order_key(df, *spec))).alias("b"),
        )
        assert all(r.a == r.b for r in ranked.collect()), spec
    with pytest.raises(ValueError, match="40 digits"):
        ordering.order_key(df, "n", "n")
    with pytest.raises(ValueError, match="no order key"):
        ordering.order_key(df.withColumn("s", F.lit("x")), "s")


def test_latest_rows(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, "a", "b", "c"]), rng.choice([None, 1, 2, 3]), i, f"row {i}") for i in range(200)]
    rows += [("d", 1, 500, "same"), ("d", 1, 500, "same"), ("e", None, None, None)]
    df = spark.createDataFrame(rows, "k string, day int, seq long, text string")
    for first in (False, True):
        pick, low = (min, -10**20) if first else (max, -10**20)
        want = {}
        for r in rows:
            key = tuple(low if x is None else x for x in r[1:3])
            best = want.get(r[0])
            if best is None or pick(key, best[0]) == key:
                want[r[0]] = (key, r)
        got = ordering.latest_rows(df, ["k"], ["day", "seq"], first).collect()
        assert {r.k: tuple(r) for r in got} == {k: r for k, (_, r) in want.items()}
        assert len(got) == len(want)


@pytest.mark.parametrize("piece_rows", [10**6, 20])
def test_spread_rank_of_a_burst(spark, piece_rows):
    """One user has all rows within one hour; they are ranked in many pieces."""
    rng = random.Random(11)
    rows = [("hot", rng.randrange(3_600_000_000), rng.choice([1, 1, 2])) for _ in range(3000)]
    rows += [("hot", 77, 3)] + [(f"u{rng.randrange(40)}", rng.randrange(50), 1) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, at long, n long")
    df = df.groupBy("k", "at").agg(F.sum("n").alias("n"))
    out = windows.spread_rank(df, ["k"], "at", "n", piece_rows=piece_rows)
    weights = sorted((r.k, r.at, r.n) for r in df.collect())
    want, before = {}, {}
    for k, at, n in weights:
        want[k, at] = before.get(k, 0) + 1
        before[k] = before.get(k, 0) + n
    assert {(r.k, r.at): r.rnk for r in out.collect()} == want
    assert out.count() == len(weights)


def test_pieces_of_a_hot_key_are_many(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 1000).alias("at"), F.lit(1).alias("n"))
    out = windows.spread_rank(df, ["k"], "at", "n", piece_rows=100)
    assert out.where("rnk <> at / 1000 + 1").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    window = plan.index("Window [sum")
    assert "_piece" in plan[window : window + 400]


@pytest.mark.parametrize("rows", [100_000, 2])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_measured_join(spark, rows, how):
    big = spark.range(1000).select("id", F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.expr("'k' || id % 10")).alias("k"))
    big = big.unionByName(spark.range(1).select("id", F.lit(None).cast("string").alias("k")))
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k0", 3), ("k9", 4), (None, 5)], "k string, v int")
    want = sorted(map(tuple, big.join(small, "k", how).collect()), key=repr)
    assert sorted(map(tuple, joins.join_measured(big, small, "k", how, rows=rows, parts=4).collect()), key=repr) == want


def test_any_page_of_a_log(spark, monkeypatch):
    monkeypatch.setattr(sets, "RANGES", 60)
    rng = random.Random(2)
    values = [rng.choice([None, -(2**63), 2**63 - 1, 0, 5, 5, 5, *[rng.randrange(10**6) for _ in range(20)]]) for _ in range(200)]
    log = spark.createDataFrame([(v, f"link {i}") for i, v in enumerate(values)], "seq long, link string").repartition(3)
    log = log.cache()
    want = sorted(values, key=lambda v: (v is not None, v or 0), reverse=True)
    pages = {}
    for page in range(1, 22):
        got = sets.page_of(log, "seq", page).collect()
        assert [r.seq for r in got] == want[10 * page - 10 : 10 * page], page
        assert all((r.length, r.total_pages, r.page) == (200, 20, page) for r in got)
        pages[page] = got
    assert sorted(r.link for p in pages.values() for r in p) == sorted(f"link {i}" for i in range(200))
    for rows, some in [(5, (1, 4, 6, 20, 21)), (60, (3, 12, 20))]:
        for page in some:
            assert sets.page_of(log, "seq", page, rows=rows).collect() == pages[page], (rows, page)
    assert sets.page_of(log, "seq", 0).collect() == [] and sets.page_of(log.limit(0), "seq", 1).collect() == []
    log.unpersist()


def test_a_deep_page_sorts_few_rows(spark):
    log = spark.range(100_000).withColumnRenamed("id", "seq")
    page = sets.page_of(log, "seq", 9_000, rows=500)
    assert [r.seq for r in page.collect()] == list(range(10_009, 9_999, -1))
    limits = [int(n) for n in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", page._jdf.queryExecution().executedPlan().toString())]
    assert limits and max(limits) <= 510
