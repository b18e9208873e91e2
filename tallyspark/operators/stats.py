"""Distribution, concentration and inequality statistics; every operator works over all rows or by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Scratch
from .scan import running_totals, value_runs

PERCENTS = (0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
TOP_COUNTS, TOP_SHARES = (10, 50, 100), (0.01, 0.05, 0.10)
PARETO = (0.5, 0.8, 0.9)
THRESHOLDS = (100, 500, 1000, 5000, 10000)
BUCKETS = ((0, 99, "0_99"), (100, 999, "100_999"), (1000, 4999, "1000_4999"), (5000, 9999, "5000_9999"), (10000, 49999, "10000_49999"), (50000, None, "50000_plus"))


def totals(df: DataFrame, value: str, group_cols: list[str] | None = None) -> DataFrame:
    """(groups, v, c, t, c_before, c_all, t_before, t_all): each distinct value, its count and sum, and the totals of smaller
    values and of all. Order statistics are read off this table; a caller that wants several can save it and hand it to each.
    """
    return _running(value_runs(df, value, group_cols), group_cols)


def _running(runs: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    runs = runs.withColumn("t", F.col("v") * F.col("c"))
    return running_totals(runs, "v", {"c": F.col("c"), "t": F.col("t")}, group_cols)


def _from_top(known: DataFrame) -> DataFrame:
    """The same table with the totals of greater values instead of smaller ones."""
    return known.withColumns({f"{k}_before": F.col(f"{k}_all") - F.col(f"{k}_before") - F.col(k) for k in ("c", "t")})


def quantiles(df: DataFrame, value: str, percents, group_cols: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """(groups, p...): exact percentiles, linear between ranks, named p<percent>; read off the running counts of
    distinct values, so no task holds the values of a group. Groups without values have no row.
    """
    g = group_cols or []
    r = known or totals(df, value, g)
    place = [F.lit(p) * (F.col("c_all") - 1) for p in percents]
    at = lambda k: F.max(F.when(F.col("c_before") <= k, F.col("v"))).cast("double")
    got = r.groupBy(*g).agg(F.max("c_all").alias("c_all"), *[at(F.floor(k)).alias(f"_lo{i}") for i, k in enumerate(place)], *[at(F.ceil(k)).alias(f"_hi{i}") for i, k in enumerate(place)])
    between = lambda i, k: F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (k - F.floor(k))
    return got.select(*g, *[between(i, k).alias(f"p{round(100 * p)}") for i, (p, k) in enumerate(zip(percents, place, strict=True))])


def _beside(left: DataFrame, right: DataFrame, group_cols: list[str] | None) -> DataFrame:
    """Two tables of one row a group, or of one row each, side by side."""
    g = group_cols or ["_k"]
    a, b = (left, right) if group_cols else (left.withColumn("_k", F.lit(1)), right.withColumn("_k", F.lit(1)))
    b = b.withColumnsRenamed({c: f"_right_{c}" for c in g})
    on = F.lit(True)
    for c in g:
        on = on & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    return a.join(b, on, "left").drop("_k", *[f"_right_{c}" for c in g])


def overview(df: DataFrame, value: str, group_cols: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """n, total, mean, median, population deviation, least and largest; zeros for an empty table."""
    x = F.col(value)
    zero = lambda c: F.coalesce(c, F.lit(0))
    one = df.groupBy(*(group_cols or [])).agg(
        F.count(x).alias("n"), zero(F.sum(x)).alias("total"), zero(F.avg(x)).alias("mean"),
        zero(F.stddev_pop(x)).alias("std"), zero(F.min(x)).alias("least"), zero(F.max(x)).alias("most"))
    out = _beside(one, quantiles(df, value, (0.5,), group_cols, known), group_cols)
    return out.select(*(group_cols or []), "n", "total", "mean", zero(F.col("p50")).alias("median"), "std", "least", "most")


def percentiles(df: DataFrame, value: str, percents=PERCENTS, group_cols: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """One column a percent, linear interpolation between ranks; exact; zeros for an empty table."""
    got = quantiles(df, value, percents, group_cols, known)
    return got.select(*(group_cols or []), *[F.coalesce(F.col(f"p{round(100 * q)}"), F.lit(0.0)).alias(f"p{round(100 * q)}") for q in percents])


def _skew(x: Column, n: Column) -> Column:
    flat = F.var_pop(x) == 0
    return F.when(n < 3, F.lit(None)).when(flat, 0.0).otherwise(F.skewness(x) * F.pow((n - 1) / n, 1.5))


def _kurtosis(x: Column, n: Column) -> Column:
    return F.when((n < 4) | (F.var_pop(x) == 0), F.lit(None)).otherwise((F.kurtosis(x) + 3) * F.pow((n - 1) / n, 2) - 3)


def moments(df: DataFrame, value: str, group_cols: list[str] | None = None) -> DataFrame:
    """Sample deviation, coefficient of variation, skewness and excess kurtosis on the sample deviation."""
    x, n = F.col(value), F.count(F.col(value))
    std = F.coalesce(F.stddev_samp(x), F.lit(0.0))
    return df.groupBy(*(group_cols or [])).agg(
        n.alias("n"), F.avg(x).alias("mean"), std.alias("std"), F.when(F.avg(x) != 0, std / F.avg(x)).alias("cv"),
        _skew(x, n).alias("skewness"), _kurtosis(x, n).alias("kurtosis"))


def descriptive(df: DataFrame, value: str, group_cols: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """The 21 figures of a ratio: moments, range, counts above and at one, nine percentiles, quartile range.

    All are read off the running totals of distinct values, saved once, so the source is read once. Groups without values have no row.
    """
    g = group_cols or []
    scratch = Scratch(df.sparkSession, "descriptive")
    r = scratch.save(known if known is not None else totals(df, value, g))
    v, c, n = F.col("v").cast("double"), F.col("c"), F.col("n")
    away = v - F.col("t_all") / F.col("c_all")
    power = lambda k: F.sum(c * F.pow(away, F.lit(float(k)))).alias(f"_m{k}")
    one = r.groupBy(*g).agg(F.coalesce(F.sum(c), F.lit(0)).alias("n"), (F.sum(v * c) / F.sum(c)).alias("mean"), power(2), power(3), power(4), F.min("v").alias("least"), F.max("v").alias("most"),
                            F.coalesce(F.sum(F.when(v > 1, c)), F.lit(0)).alias("above_one"), F.coalesce(F.sum(F.when(v == 1, c)), F.lit(0)).alias("at_one"))
    std = F.when(n > 1, F.sqrt(F.col("_m2") / (n - 1))).when(n == 1, 0.0).otherwise(0.0)
    spread = F.col("most") > F.col("least")
    skew = F.when(n < 3, F.lit(None)).when(~spread, 0.0).otherwise(F.col("_m3") / n / F.pow(std, F.lit(3.0)))
    kurtosis = F.when((n < 4) | ~spread, F.lit(None)).otherwise(F.col("_m4") / n / F.pow(std, F.lit(4.0)) - 3)
    ps = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
    out = one.select(*g, "n", "mean", std.alias("std"), F.when(F.col("mean") != 0, std / F.col("mean")).alias("cv"), "least", "most", (F.col("most") - F.col("least")).alias("spread"),
                     skew.alias("skewness"), kurtosis.alias("kurtosis"), "above_one", "at_one")
    return _beside(out, quantiles(df, value, ps, g, r), group_cols).withColumn("iqr", F.col("p75") - F.col("p25"))


def gini(df: DataFrame, value: str, group_cols: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """2 sum(i x_i) / (n T) - (n + 1) / n over ascending values; 0 if there are none or they sum to 0.

    A value of count c that k smaller ones precede adds v (c k + c (c + 1) / 2) to the sum.
    """
    g = group_cols or []
    r = known or totals(df, value, g)
    v, c, k = F.col("v").cast("double"), F.col("c"), F.col("c_before")
    s = r.groupBy(*g).agg(F.sum(v * (c * k + c * (c + 1) / 2)).alias("s"), F.sum(v * c).alias("t"), F.sum("c").alias("n"))
    return s.select(*g, F.when((F.col("n") > 0) & (F.col("t") != 0), 2 * F.col("s") / (F.col("n") * F.col("t")) - (F.col("n") + 1) / F.col("n")).otherwise(0.0).alias("gini"))


def hhi(df: DataFrame, value: str, group_cols: list[str] | None = None) -> DataFrame:
    """Sum of squared shares; 0 if the total is 0."""
    x = F.col(value).cast("double")
    return df.groupBy(*(group_cols or [])).agg(F.when(F.sum(x) != 0, F.sum(x * x) / F.pow(F.sum(x), 2)).otherwise(0.0).alias("hhi"))


def _top_sum(k: Column) -> Column:
    """Of rows (v, c, c_before): the sum of the first k values in their order."""
    return F.sum(F.col("v") * F.greatest(F.lit(0), F.least(F.col("c"), k - F.col("c_before"))))


def top_concentration(df: DataFrame, value: str, known: DataFrame | None = None) -> DataFrame:
    """(key, count, share_items, sum, share_total) of the top 10, 50, 100 and 1, 5, 10 %; counts round half to even, at least 1."""
    r = _from_top(known or totals(df, value))
    n = F.col("c_all")
    keys = [(f"top_{k}", F.lit(k)) for k in TOP_COUNTS] + [(f"top_{round(100 * p)}pct", F.greatest(F.lit(1), F.bround(n * F.lit(p)))) for p in TOP_SHARES]
    some = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.least(n, c.cast("long")).alias("count")) for k, c in keys]))
    x = r.select("*", some.alias("k")).select("v", "c", "c_before", "c_all", "t_all", "k.key", "k.count")
    out = x.groupBy("key", "count", "c_all", "t_all").agg(_top_sum(F.col("count")).alias("sum"))
    return out.select("key", "count", (F.col("count") / F.col("c_all")).alias("share_items"), "sum",
                      F.when(F.col("t_all") != 0, F.col("sum") / F.col("t_all")).otherwise(0.0).alias("share_total"))


def pareto(df: DataFrame, value: str, targets=PARETO, known: DataFrame | None = None) -> DataFrame:
    """(target, needed, share): the least number of top items whose sum reaches each share of the total; all items if it is 0."""
    r = _from_top(known or totals(df, value))
    some = r.select("*", F.explode(F.array(*map(F.lit, targets))).alias("target"))
    v, goal = F.col("v").cast("double"), F.col("target") * F.col("t_all")
    own = F.greatest(F.lit(1), F.ceil((goal - F.col("t_before")) / v - 1e-9))
    reach = F.when((F.col("v") > 0) & (F.col("t_before") + v * F.col("c") >= goal - 1e-9 * F.abs(goal)), F.col("c_before") + F.least(F.col("c"), own))
    out = some.groupBy("target", "c_all").agg(F.min(reach).alias("k"), F.max("t_all").alias("t"))
    k = F.when(F.col("t") == 0, F.col("c_all")).otherwise(F.coalesce("k", "c_all")).cast("long")
    return out.select("target", k.alias("needed"), (k / F.col("c_all")).alias("share"))


def end_shares(df: DataFrame, value: str, tops=(0.01, 0.05, 0.10), bottoms=(0.10, 0.20, 0.40), known: DataFrame | None = None) -> DataFrame:
    """(side, p, share) of the top and bottom ceil(n p) items, at least one; shares are 0 if the total is 0."""
    known = known or totals(df, value)

    def side(name: str, ps, r: DataFrame) -> DataFrame:
        x = r.select("*", F.explode(F.array(*map(F.lit, ps))).alias("p"))
        k = F.greatest(F.lit(1), F.ceil(F.col("c_all") * F.col("p"))).cast("long")
        out = x.groupBy("p", "t_all").agg(_top_sum(k).alias("s"))
        return out.select(F.lit(name).alias("side"), "p", F.when(F.col("t_all") != 0, F.col("s") / F.col("t_all")).otherwise(0.0).alias("share"))

    return side("top", tops, _from_top(known)).unionByName(side("bottom", bottoms, known))


def quantile_ratios(df: DataFrame, value: str, known: DataFrame | None = None) -> DataFrame:
    """P90/P10, P99/P1 and the Palma ratio; infinite where the denominator is not positive."""
    known = known or totals(df, value)
    p = quantiles(df, value, (0.90, 0.10, 0.99, 0.01), known=known)
    s = end_shares(df, value, (0.10,), (0.40,), known).groupBy().agg(
        F.max(F.when(F.col("side") == "top", F.col("share"))).alias("top"), F.max(F.when(F.col("side") == "bottom", F.col("share"))).alias("bottom"))
    over = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(float("inf")))
    one = p.withColumn("_k", F.lit(1)).join(s.withColumn("_k", F.lit(1)), "_k")
    return one.select(over(F.col("p90"), F.col("p10")).alias("p90_p10"), over(F.col("p99"), F.col("p1")).alias("p99_p1"), over(F.col("top"), F.col("bottom")).alias("palma"))


def lorenz(df: DataFrame, value: str) -> DataFrame:
    """(x, y): the curve's corners, (0, 0) and one point after each distinct value in ascending order."""
    r = totals(df, value)
    n, t = F.col("c_all"), F.col("t_all")
    points = r.select(((F.col("c_before") + F.col("c")) / n).alias("x"), F.when(t != 0, (F.col("t_before") + F.col("v") * F.col("c")) / t).otherwise(0.0).alias("y"))
    return points.unionByName(df.sparkSession.range(1).select(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")))


def dagum(df: DataFrame, value: str, group: str, method: str = "reference") -> DataFrame:
    """Gini split into within, between (net) and transvariation parts: (gini, within, net, transvariation).

    Groups are paired by ascending mean; with prefix counts N and sums S of the lower group below each
    value v, the mean positive difference is sum(c (v N - S)) / (n_h n_k), so no pairs of rows are made.
    The tables of groups (one row each) are small and broadcast; each group's values meet each other group's,
    so this is meant for some dozens of groups. method 'reference' divides pair differences by twice the overall mean and puts what is then missing
    into transvariation; 'textbook' divides by the two groups' means.
    """
    runs = value_runs(df.where(F.col(group).isNotNull()), value, [group]).withColumnRenamed(group, "g")
    scratch = Scratch(df.sparkSession, "dagum")
    runs = scratch.save(runs)  # read by every part below, as are the groups' figures and their pairs' merged values
    sizes = runs.groupBy("g").agg(F.sum("c").alias("n"), (F.sum(F.col("v") * F.col("c")) / F.sum("c")).alias("m"))
    own = gini(df, value, ["g"], _running(runs, ["g"])).join(sizes, "g")
    total = sizes.agg(F.sum("n").alias("tn"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("tm")).withColumn("_k", F.lit(1))
    all_gini = gini(df, value, known=_running(runs.groupBy("v").agg(F.sum("c").alias("c")))).withColumn("_k", F.lit(1))
    p, s = F.col("n") / F.col("tn"), F.col("n") * F.col("m") / (F.col("tn") * F.col("tm"))
    parts = scratch.save(own.withColumn("_k", F.lit(1)).join(total, "_k").withColumns({"p": p, "s": s}))
    within = parts.agg(F.sum(F.col("gini") * F.col("p") * F.col("s")).alias("within")).withColumn("_k", F.lit(1))
    lo = parts.select(F.col("g").alias("h"), F.col("n").alias("nh"), F.col("m").alias("mh"), F.col("p").alias("ph"), F.col("s").alias("sh"), "_k", "tm")
    hi = parts.select(F.col("g").alias("k"), F.col("n").alias("nk"), F.col("m").alias("mk"), F.col("p").alias("pk"), F.col("s").alias("sk"), "_k")
    pairs = lo.join(F.broadcast(hi), "_k").where("mh < mk or (mh = mk and h < k)")  # as many rows as pairs of groups
    # Merge both groups' values: for each pair, running count and sum of the lower one by value.
    both = runs.withColumnRenamed("g", "h").join(F.broadcast(pairs.select("h", "k")), "h").select("h", "k", "v", F.col("c").alias("ch"), F.lit(0).cast("long").alias("ck")).unionByName(
        runs.withColumnRenamed("g", "k").join(F.broadcast(pairs.select("h", "k")), "k").select("h", "k", "v", F.lit(0).cast("long").alias("ch"), F.col("c").alias("ck")))
    both = scratch.save(both.groupBy("h", "k", "v").agg(F.sum("ch").alias("ch"), F.sum("ck").alias("ck")))
    r = running_totals(both, "v", {"a": F.col("ch"), "b": F.col("ch") * F.col("v"), "d": F.col("ck"), "e": F.col("ck") * F.col("v")}, ["h", "k"])
    d = r.groupBy("h", "k").agg(F.sum(F.col("ck") * (F.col("v") * F.col("a_before") - F.col("b_before"))).alias("up"), F.sum(F.col("ch") * (F.col("v") * F.col("d_before") - F.col("e_before"))).alias("down"))
    j = pairs.join(d, ["h", "k"]).join(all_gini, "_k")
    up, down = F.col("up") / (F.col("nh") * F.col("nk")), F.col("down") / (F.col("nh") * F.col("nk"))
    scale = 2 * F.col("tm") if method == "reference" else F.col("mh") + F.col("mk")
    ghk = (up + down) / scale
    dist = F.when(up + down > 0, (up - down) / (up + down)).otherwise(0.0)
    w = F.col("pk") * F.col("sh") + F.col("ph") * F.col("sk")
    net = j.agg(F.coalesce(F.sum(ghk * w * dist), F.lit(0.0)).alias("net"), F.coalesce(F.sum(ghk * w * (1 - dist)), F.lit(0.0)).alias("trans")).withColumn("_k", F.lit(1))
    out = all_gini.join(within, "_k").join(net, "_k")
    rest = F.col("gini") - F.col("within") - F.col("net") - F.col("trans")
    trans = F.col("trans") + (F.when(F.abs(rest) > 1e-6, rest).otherwise(0.0) if method == "reference" else F.lit(0.0))
    return out.select("gini", "within", "net", trans.alias("transvariation"))


def thresholds(df: DataFrame, value: str, at=THRESHOLDS) -> DataFrame:
    """(threshold, items, share) at or above each threshold, in one pass."""
    one = df.agg(F.count(value).alias("n"), *[F.count_if(F.col(value) >= t).alias(f"t{t}") for t in at])
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{t}").alias("items")) for t in at]))
    return one.select("n", rows.alias("r")).select("r.threshold", "r.items", F.when(F.col("n") > 0, F.col("r.items") / F.col("n")).otherwise(0.0).alias("share"))


def buckets(df: DataFrame, value: str, bounds=BUCKETS) -> DataFrame:
    """(bucket, items, share) of closed intervals; empty ones count 0, values in none count in the total only."""
    inside = lambda lo, hi: (F.col(value) >= lo) & (F.lit(True) if hi is None else F.col(value) <= hi)
    one = df.agg(F.count(value).alias("n"), *[F.count_if(inside(lo, hi)).alias(f"b{name}") for lo, hi, name in bounds])
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("bucket"), F.col(f"b{name}").alias("items")) for _, _, name in bounds]))
    return one.select("n", rows.alias("r")).select("r.bucket", "r.items", F.when(F.col("n") > 0, F.col("r.items") / F.col("n")).otherwise(0.0).alias("share"))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """(bin, lo, hi, items, density): equal bins over [min, max], the last one closed; all values equal fill bin 0."""
    x = F.col(value)
    b = df.agg(F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"), F.count(x).alias("n")).first()
    if not b["n"]:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, items long, density double")
    lo, hi = b["lo"], b["hi"]
    lo, hi = (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)  # a width of one around a single value
    w = (hi - lo) / bins
    counts = df.where(x.isNotNull()).groupBy(F.least(F.floor((x - lo) / w), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("items"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    items = F.coalesce("items", F.lit(0))
    return every.join(counts, "bin", "left").select("bin", (F.lit(lo) + F.col("bin") * w).alias("lo"), (F.lit(lo) + (F.col("bin") + 1) * w).alias("hi"), items.alias("items"), (items / (b["n"] * w)).alias("density"))


def auto_bins(n: int) -> int:
    """Bins for n values: round(sqrt(n)), at least 5, at most 60."""
    return max(1, min(60, max(5, round(n**0.5))))


def kde(df: DataFrame, value: str, points: int = 200, pad: float = 0.0, least_pad: float = 0.0) -> DataFrame:
    """(x, density): Gaussian kernel estimate on an even grid, bandwidth 1.06 s n^(-1/5); zeros if n < 2 or s = 0.

    Each distinct value meets the grid's ``points`` once, with its count.
    """
    x = F.col(value).cast("double")
    b = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"), F.stddev_samp(x).alias("s")).first()
    n, s = b["n"], b["s"] or 0.0
    if not n:
        return df.sparkSession.createDataFrame([], "x double, density double")
    margin = pad * (b["hi"] - b["lo"]) + least_pad
    lo, hi = b["lo"] - margin, b["hi"] + margin
    step = (hi - lo) / (points - 1) if points > 1 else 0.0
    grid = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.struct(i.alias("i"), (F.lit(lo) + i * step).alias("x")))
    if n < 2 or s <= 0:
        return df.sparkSession.range(1).select(F.inline(grid)).select("x", F.lit(0.0).alias("density"))
    width = 1.06 * s * n ** (-0.2)
    runs = value_runs(df.select(x.alias("_x")), "_x").select("v", "c", F.inline(grid))
    z = (F.col("x") - F.col("v")) / width
    return runs.groupBy("i", "x").agg((F.sum(F.col("c") * F.exp(-0.5 * z * z)) / (n * width * (2 * 3.141592653589793) ** 0.5)).alias("density")).select("x", "density")


def violins(df: DataFrame, value: str, group_cols: list[str], points: int = 100, factor: float = 1.0, tolerance: float = 1e-4, exact: bool = False) -> DataFrame:
    """(groups, i, x, density, bound): a Gaussian kernel estimate of each group on an even grid from its least to its largest value.

    The bandwidth is factor * s * n^(-1/5) of the group. Values are shared out to the two nearest of even bins by distance (linear binning), so
    narrow that the estimate is off by no more than ``bound``, ``tolerance`` times the height of one kernel; with ``exact`` they are taken as
    they are, and bound is 0. A bin meets the grid points within nine bandwidths only, so a group costs some hundred
    thousand kernel values whatever its size. Groups of fewer than two values or without spread have no estimate: density and bound are null.
    """
    x, h, lo = F.col(value).cast("double"), F.col("_h"), F.col("_lo")
    per = df.where(F.col(value).isNotNull()).groupBy(*group_cols).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"), F.count(x).alias("_n"), F.stddev_samp(x).alias("_s"))
    per = per.withColumn("_h", F.when((F.col("_n") > 1) & (F.col("_s") > 0), factor * F.col("_s") * F.pow("_n", F.lit(-0.2))))
    # Linear binning at width w changes a kernel sum by at most w^2 / 8 of the largest second derivative, which is the height over h^2.
    per = per.withColumn("_w", h * (8 * tolerance) ** 0.5).withColumn("_step", (F.col("_hi") - lo) / (points - 1))
    per = Scratch(df.sparkSession, "violins").save(per)  # one row a group
    grid = per.select(*group_cols, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"), "_lo", "_step", "_h", "_n")
    runs = _beside(value_runs(df.select(*group_cols, x.alias("_x")), "_x", group_cols), per, group_cols).where("_h is not null")
    if not exact:
        place = (F.col("v") - lo) / F.col("_w")
        part = place - F.floor(place)
        two = F.explode(F.array(F.struct(F.floor(place).alias("b"), (F.col("c") * (1 - part)).alias("c")), F.struct((F.floor(place) + 1).alias("b"), (F.col("c") * part).alias("c")))).alias("z")
        runs = runs.select(*group_cols, "_lo", "_step", "_h", "_w", two).groupBy(*group_cols, "_lo", "_step", "_h", "_w", "z.b").agg(F.sum("z.c").alias("c"))
        runs = runs.withColumn("v", lo + F.col("b") * F.col("_w"))
    at = lambda d: ((F.col("v") + d * h - lo) / F.col("_step"))
    first, last = F.greatest(F.lit(0), F.ceil(at(-9))).cast("int"), F.least(F.lit(points - 1), F.floor(at(9))).cast("int")
    near = runs.where(first <= last).select(*group_cols, "v", "c", "_lo", "_step", "_h", F.explode(F.sequence(first, last)).alias("i"))
    z = (lo + F.col("i") * F.col("_step") - F.col("v")) / h
    sums = near.groupBy(*group_cols, "i").agg(F.sum(F.col("c") * F.exp(-0.5 * z * z)).alias("_sum"))
    height = 1 / (h * (2 * 3.141592653589793) ** 0.5)
    out = _beside(grid, sums, [*group_cols, "i"])
    return out.select(*group_cols, "i", (lo + F.col("i") * F.coalesce("_step", F.lit(0.0))).alias("x"), (F.coalesce("_sum", F.lit(0.0)) * height / F.col("_n")).alias("density"),
                      F.when(h.isNotNull(), F.lit(0.0) if exact else height * tolerance).alias("bound"))


def box_stats(df: DataFrame, value: str, group_cols: list[str]) -> DataFrame:
    """Quartiles, whiskers (the last data within 1.5 quartile ranges), mean, n and number of outliers by group."""
    some = df.where(F.col(value).isNotNull())
    j = _beside(some, quantiles(some, value, (0.25, 0.5, 0.75), group_cols), group_cols)
    x, reach = F.col(value), 1.5 * (F.col("p75") - F.col("p25"))
    ok = (x >= F.col("p25") - reach) & (x <= F.col("p75") + reach)
    out = j.groupBy(*group_cols, "p25", "p50", "p75").agg(F.count("*").alias("n"), F.avg(x).alias("mean"), F.min(F.when(ok, x)).alias("whisker_lo"), F.max(F.when(ok, x)).alias("whisker_hi"), F.count_if(~ok).alias("outliers"))
    return out.select(*group_cols, "n", "mean", F.col("p25").alias("q1"), F.col("p50").alias("median"), F.col("p75").alias("q3"), "whisker_lo", "whisker_hi", "outliers")


#: Fixed values: (rank, multiple of the average, multiple of the top).
RANK_RULES = (("super_power", 30.0, 0.98), ("great_power", 5.0, 0.75), ("major_power", 2.5, 0.5), ("minor_power", 0.6, 0.15))


def rank_cutoffs(df: DataFrame, value: str, rules=RANK_RULES, least_items: int = 100, filler: float = 15.0, transform: str = "identity", top_too: bool = True) -> DataFrame:
    """(rank, cutoff): max(average * a, top * t) by rule; under ``least_items`` items the average counts fillers; the last rank has no bound."""
    x = F.log1p(F.col(value)) if transform == "log1p" else F.col(value).cast("double")
    one = df.agg(F.count(x).alias("n"), F.sum(x).alias("t"), F.max(x).alias("top"))
    avg = F.when(F.col("n") < least_items, (F.col("t") + filler * (least_items - F.col("n"))) / least_items).otherwise(F.col("t") / F.col("n"))
    by = lambda a, t: F.greatest(avg * a, F.col("top") * t) if top_too else avg * a
    rows = [F.struct(F.lit(r).alias("rank"), by(a, t).alias("cutoff")) for r, a, t in rules] + [F.struct(F.lit("insignificant_power").alias("rank"), F.lit(float("-inf")).alias("cutoff"))]
    return one.select(F.inline(F.array(*rows)))
