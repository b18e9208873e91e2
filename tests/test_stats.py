"""Statistics against plain definitions, on vectors with ties, zeros and few values."""

import math
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F
from tallyspark.operators import stats

VECTORS = [[], [5], [3, 3], [1, 2, 4], [7] * 6, [0, 0, 0], [1, 1, 2, 2, 2, 9, 30, 1000000], list(range(1, 60))]


def frame(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "v long")


def plain_gini(xs):
    xs, n, t = sorted(xs), len(xs), sum(xs)
    return 2 * sum(i * x for i, x in enumerate(xs, 1)) / (n * t) - (n + 1) / n if t else 0.0


@pytest.mark.parametrize("xs", VECTORS, ids=str)
def test_one_vector(spark, xs):
    df, n, t = frame(spark, xs), len(xs), sum(xs)
    down = sorted(xs, reverse=True)
    g = stats.gini(df, "v").first()
    assert math.isclose(g["gini"], plain_gini(xs), abs_tol=1e-12)
    o = stats.overview(df, "v").first()
    assert (o["n"], o["total"]) == (n, t)
    m = stats.moments(df, "v").first()
    s = stdev(xs) if n > 1 else 0.0
    if n >= 3 and s:
        assert math.isclose(m["skewness"], mean([((x - mean(xs)) / s) ** 3 for x in xs]), abs_tol=1e-9)
    if n >= 4 and s:
        assert math.isclose(m["kurtosis"], mean([((x - mean(xs)) / s) ** 4 for x in xs]) - 3, abs_tol=1e-9)
    assert (m["kurtosis"] is None) == (n < 4 or not s)
    if n:
        for r in stats.top_concentration(df, "v").collect():
            k = {"top_10": 10, "top_50": 50, "top_100": 100}.get(r["key"]) or max(1, round(n * int(r["key"][4:-3]) / 100))
            assert (r["count"], r["sum"]) == (min(k, n), sum(down[:k]))
        for r in stats.pareto(df, "v").collect():
            want = next((k for k in range(1, n + 1) if sum(down[:k]) >= r["target"] * t * (1 - 1e-12)), n) if t else n
            assert r["needed"] == want
        for r in stats.end_shares(df, "v").collect():
            k = max(1, math.ceil(n * r["p"]))
            part = sum(down[:k]) if r["side"] == "top" else sum(sorted(xs)[:k])
            assert math.isclose(r["share"], part / t if t else 0.0, abs_tol=1e-12)
        points = sorted((r["x"], r["y"]) for r in stats.lorenz(df, "v").collect())
        assert points[0] == (0.0, 0.0) and points == sorted(points, key=lambda p: p[1]) and (not t or math.isclose(points[-1][1], 1))
        assert stats.histogram(df, "v", 7).agg(F.sum("items")).first()[0] == n


def test_dagum_parts_add_up(spark):
    rows = [("a", x) for x in (1, 2, 3, 8)] + [("b", x) for x in (2, 2, 9, 40)] + [("c", 7)] + [("d", x) for x in (100, 120)]
    df = spark.createDataFrame(rows, "g string, v long")
    for method in ("reference", "textbook"):
        r = stats.dagum(df, "v", "g", method).first()
        assert math.isclose(r["within"] + r["net"] + r["transvariation"], r["gini"], abs_tol=1e-6)


def test_groups_are_independent(spark):
    df = spark.createDataFrame([("x", 1), ("x", 5), ("y", 3), (None, 2), (None, 4)], "g string, v long")
    got = {r["g"]: r["gini"] for r in stats.gini(df, "v", ["g"]).collect()}
    assert {k: round(v, 9) for k, v in got.items()} == {"x": round(plain_gini([1, 5]), 9), "y": 0.0, None: round(plain_gini([2, 4]), 9)}


def test_running_totals_in_many_buckets_equal_those_in_one(spark, monkeypatch):
    from tallyspark.operators import scan

    df = spark.range(500).select((F.col("id") * 7 % 501).alias("v"), (F.col("id") % 3).alias("g"))
    got = lambda: {tuple(r) for r in scan.running_totals(df, "v", {"c": F.lit(1), "t": F.col("v")}, ["g"]).collect()}
    one = got()
    monkeypatch.setattr(scan, "BUCKET_ROWS", 20)
    assert got() == one and len(one) == 500


def test_sources_are_read_twice_at_most(spark):
    """Once for plain aggregates and once for the runs that order statistics come from."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.range(200).select((F.col("id") % 90).alias("v"), (F.col("id") % 3).alias("g")).mapInArrow(counted, "v long, g long")
    for f in (stats.overview, stats.percentiles, stats.descriptive, stats.gini):
        for groups in (None, ["g"]):
            before = read.value
            f(df, "v", group_cols=groups).collect()
            assert read.value - before <= 400, (f.__name__, groups)
    before = read.value
    stats.quantile_ratios(df, "v").collect()
    assert read.value - before <= 400
