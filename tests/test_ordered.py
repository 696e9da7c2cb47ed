import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from clanweave.functions.ordered import bounded_quantiles, exact_quantiles, ordered_scan, rank_all, rank_within


def hot(spark, n=3000):
    """One group holds more than a third of the rows; some keys are NULL."""
    rng = random.Random(5)
    data = [("hot" if i % 5 < 2 else None if i % 50 == 3 else f"g{rng.randrange(40)}", i, rng.randrange(100), rng.choice([None, 1, 2, 3])) for i in range(n)]
    rng.shuffle(data)
    return spark.createDataFrame(data, "g string, o int, x int, y int").repartition(7)


def test_scan_equals_window(spark, rows):
    df = hot(spark)
    w = Window.partitionBy("g").orderBy(F.desc("o"))
    got = ordered_scan(df, ["g"], [F.desc("o")], rank="r", sums={"s": F.col("x")}, totals={"t": F.col("x")}, lags={"a": F.col("y")}, leads={"b": F.col("y")}, mins={"m": F.col("x")})
    want = df.select(
        "*", F.row_number().over(w).alias("r"), F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
        F.sum("x").over(Window.partitionBy("g")).alias("t"), F.lag("y").over(w).alias("a"), F.lead("y").over(w).alias("b"),
        F.min("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("m"),
    )
    assert rows(got, "o", "r", "s", "t", "a", "b", "m") == rows(want, "o", "r", "s", "t", "a", "b", "m")


def test_hot_group_is_spread(spark):
    df = hot(spark).where("g = 'hot'")
    parts = df.repartitionByRange("g", "o").select(F.spark_partition_id().alias("p"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert parts.distinct().count() > 1
        got = rank_all(df, ["o"], "r").agg(F.min("r"), F.max("r"), F.countDistinct("r"), F.count("r")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got[0] == 1 and got[1] == got[2] == got[3]


def test_quantiles(spark):
    df = hot(spark).where("g is not null")
    points = {"q1": 0.25, "m": 0.5, "q9": 0.9}
    values = {}
    for g, x in df.select("g", "x").collect():
        values.setdefault(g, []).append(x)
    for fn in (exact_quantiles, bounded_quantiles):
        for r in fn(df, ["g"], "x", points).collect():
            assert np.allclose([r["q1"], r["m"], r["q9"]], np.quantile(values[r["g"]], [0.25, 0.5, 0.9]))


def test_ranks_move_rows_once(spark):
    random.seed(3)
    data = [(random.choice([None, "", "a", "b", "b", "b"]), random.choice([None, 0, 1, 2]), i * 7 % 1000, "x" * (i % 5)) for i in range(1000)]
    df = spark.createDataFrame(data, "g string, h long, o int, p string").repartition(5)
    got = ordered_scan(df, ["g", "h"], ["o"], rank="r")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan
    want = {}
    for g, h, o, p in sorted(data, key=lambda t: t[2]):
        want.setdefault((g, h), []).append((o, p))
    assert sorted(map(repr, got.collect())) == sorted(f"Row(g={g!r}, h={h!r}, o={o}, p={p!r}, r={r})" for (g, h), v in want.items() for r, (o, p) in enumerate(v, 1))
    every = rank_all(df, [F.desc("o"), "p"], "r")
    assert [t.o for t in every.orderBy("r").collect()] == list(range(999, -1, -1)) and [t.r for t in every.orderBy("r").collect()] == list(range(1, 1001))
    assert rank_within(df.limit(0), ["g"], ["o"], "r").count() == 0
    odd = df.select(F.when(F.col("h") == 0, float("nan")).otherwise(F.col("h").cast("double")).alias("g"), "o")
    assert {tuple(r) for r in rank_within(odd, ["g"], ["o"], "r").groupBy("g").agg((F.max("r") - F.count("o")).alias("d")).select("d").collect()} == {(0,)}
