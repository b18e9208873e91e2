"""Reports by section: figures of the statistics operators as Markdown, each written as one file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import stats
from ..sources.onefile import write_lines
from ..sources.staging import Scratch


def number(x: float | None, places: int = 0) -> str:
    return "n/a" if x is None or x != x or abs(x) == float("inf") else f"{x:,.{places}f}"


def plain(x: float | None, places: int = 6) -> str:
    return "nan" if x is None or x != x else f"{x:.{places}f}"


def percent(x: float | None, places: int = 2) -> str:
    return "n/a" if x is None else f"{100 * x:.{places}f}%"


def bar(x: float | None) -> str:
    full = round(20 * min(1.0, max(0.0, x or 0.0)))
    return f"`{'█' * full}{'░' * (20 - full)}`"


def table(head: Iterable[str], rows: Iterable[Iterable[str]], numbers: Iterable[bool] | None = None) -> list[str]:
    head = list(head)
    right = list(numbers or [False] + [True] * (len(head) - 1))
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return [line(head), "|" + "|".join("---:" if r else "---" for r in right) + "|", *map(line, rows), ""]


def write_report(spark: SparkSession, lines: list[str], path: str) -> None:
    """A report has some hundred lines, one a statistic; they are written in order as one file."""
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "place int, line string")
    write_lines(rows.coalesce(1).sortWithinPartitions("place"), path)


def _first(df: DataFrame) -> Row:
    return df.first()


def dashboard(items: DataFrame, value: str, title: str, note: str) -> list[str]:
    """Key figures, percentiles, concentration, Pareto, thresholds and buckets of a measure."""
    scratch = Scratch(items.sparkSession, "dashboard")
    items = scratch.save(items.select(value))
    known = scratch.save(stats.totals(items, value))
    o, p = _first(stats.overview(items, value, known=known)), _first(stats.percentiles(items, value, known=known))
    top, hhi, gini = stats.top_concentration(items, value, known).collect(), _first(stats.hhi(items, value))["hhi"], _first(stats.gini(items, value, known=known))["gini"]
    need, at, among = stats.pareto(items, value, known=known).collect(), stats.thresholds(items, value).collect(), stats.buckets(items, value).collect()
    scratch.drop()
    out = [f"# {title}", "", "> Snapshot", f"> {note}", "", "---", "", "## Key figures", ""]
    out += table(["figure", "value"], [["items", f"**{number(o['n'])}**"], ["total", f"**{number(o['total'])}**"], ["mean", number(o["mean"], 2)], ["median", number(o["median"], 2)],
                                       ["deviation", number(o["std"], 2)], ["least / most", f"{number(o['least'])} / {number(o['most'])}"]])
    out += ["---", "", "## Percentiles", ""]
    most = max([1.0, *p.asDict().values()])
    out += table(["percentile", "value", "bar"], [[f"P{c[1:]}", number(x, 2), bar(x / most)] for c, x in p.asDict().items()], [False, True, False])
    out += ["---", "", "## Concentration", ""]
    order = [f"top_{k}" for k in stats.TOP_COUNTS] + [f"top_{round(100 * s)}pct" for s in stats.TOP_SHARES]
    by = {r["key"]: r for r in top}
    out += table(["group", "items", "share of items", "sum", "share of total", "bar"],
                 [[k.replace("_", " ").replace("pct", " %"), number(r["count"]), percent(r["share_items"]), number(r["sum"]), percent(r["share_total"]), bar(r["share_total"])] for k in order if (r := by.get(k))], [False, True, True, True, True, False])
    out += [f"- HHI: **{number(hhi, 6)}**", f"- Gini: **{number(gini, 6)}**", "", "---", "", "## Pareto", ""]
    out += table(["share of total", "items needed", "share of items", "bar"], [[percent(r["target"]), number(r["needed"]), percent(r["share"]), bar(r["share"])] for r in sorted(need, key=lambda r: r["target"])], [False, True, True, False])
    out += ["---", "", "## Thresholds", ""]
    out += table(["threshold", "items", "share of items", "bar"], [[f">= {number(r['threshold'])}", number(r["items"]), percent(r["share"]), bar(r["share"])] for r in sorted(at, key=lambda r: r["threshold"])], [False, True, True, False])
    out += ["---", "", "## Buckets", ""]
    named = {n: f"{lo:,}+" if hi is None else f"{lo:,}-{hi:,}" for lo, hi, n in stats.BUCKETS}
    b = {r["bucket"]: r for r in among}
    return out + table(["bucket", "items", "share of items", "bar"], [[named[n], number(b[n]["items"]), percent(b[n]["share"]), bar(b[n]["share"])] for _, _, n in stats.BUCKETS], [False, True, True, False])


def inequality(items: DataFrame, value: str, group: str, title: str, scope: str) -> list[str]:
    """Shares at both ends, percentile ratios, distribution, and the Gini split by group."""
    scratch = Scratch(items.sparkSession, "inequality")
    items = scratch.save(items.select(value, group))
    known = scratch.save(stats.totals(items, value))
    o = _first(stats.overview(items, value, known=known))
    p = _first(stats.quantiles(items, value, (0.01, 0.10, 0.50, 0.90, 0.99), known=known))
    ends = {(r["side"], r["p"]): r["share"] for r in stats.end_shares(items, value, known=known).collect()}
    ratio, gini, split = _first(stats.quantile_ratios(items, value, known)), _first(stats.gini(items, value, known=known))["gini"], _first(stats.dagum(items, value, group))
    scratch.drop()
    times = lambda x: "not defined (divisor 0)" if x is None or x == float("inf") else f"{x:.2f}"
    out = [f"# {title}", "", "## 1. Data", "", f"- {scope}", f"- Items: `{number(o['n'])}`.", f"- Total: `{number(o['total'])}`.", "", "## 2. Shares of the total", ""]
    out += table(["figure", "value"], [[f"{side} {round(100 * q)} %", percent(ends[side, q], 2 if side == "top" else 4)] for side, q in (("top", 0.01), ("top", 0.05), ("top", 0.10), ("bottom", 0.10), ("bottom", 0.20))])
    out += ["## 3. Percentile ratios", ""]
    out += table(["figure", "value", "meaning"], [["P90/P10", times(ratio["p90_p10"]), "how many times the 10th percentile the 90th is"], ["P99/P1", times(ratio["p99_p1"]), "distance of the extremes"],
                                                  ["Palma", times(ratio["palma"]), "share of the top 10 % over that of the bottom 40 %"]], [False, True, False])
    out += ["## 4. Distribution", ""]
    out += table(["figure", "value"], [["least", number(o["least"])], *[[f"P{c[1:]}" if c != "p50" else "median", number(p[c], 2)] for c in ("p1", "p10", "p50")], ["mean", number(o["mean"], 2)],
                                       ["P90", number(p["p90"], 2)], ["P99", number(p["p99"], 2)], ["most", number(o["most"])], ["Gini", plain(gini)]])
    out += ["## 5. Dagum's split of the Gini by group", ""]
    part = lambda x: percent(x / gini if gini else None)
    out += table(["part", "value", "share of the Gini"], [["within", plain(split["within"]), part(split["within"])], ["between, net", plain(split["net"]), part(split["net"])],
                                                          ["transvariation", plain(split["transvariation"]), part(split["transvariation"])], ["all", plain(gini), percent(1.0)]])
    return out


def _described(r: Row | None) -> list[str]:
    g = lambda c: r[c] if r is not None else None
    out = ["### Description", "", *table(["figure", "value"], [["n", number(g("n") or 0)], ["mean", plain(g("mean"))], ["deviation", plain(g("std"))], ["deviation / mean", plain(g("cv"))], ["least", plain(g("least"))], ["most", plain(g("most"))],
                                                                ["spread", plain(g("spread"))], ["skewness", plain(g("skewness"))], ["excess kurtosis", plain(g("kurtosis"))], ["above 1", str(g("above_one") or 0)], ["at 1", str(g("at_one") or 0)]])]
    named = {"p25": "Q1 (P25)", "p50": "median (P50)", "p75": "Q3 (P75)"}
    return [*out, "### Percentiles", "", *table(["percentile", "value"], [[named.get(c, c.upper()), plain(g(c))] for c in ("p1", "p5", "p10", "p25", "p50", "p75", "p90", "p95", "p99")] + [["IQR (Q3 - Q1)", plain(g("iqr"))]])]


#: Names of the tiers and the range of the measure of each.
TIERS = (("under 100", "[0, 100)"), ("100 to 1k", "[100, 1,000)"), ("1k to 10k", "[1,000, 10,000)"), ("10k and more", "[10,000, ...)"))


def ratio_report(ratios: DataFrame, title: str, scope: str) -> list[str]:
    """ratios(ratio, tier): figures of the ratio over all items and by tier."""
    scratch = Scratch(ratios.sparkSession, "ratio-report")
    ratios = scratch.save(ratios.select("ratio", "tier"))
    every, by = _first(stats.descriptive(ratios, "ratio")), {r["tier"]: r for r in stats.descriptive(ratios, "ratio", ["tier"]).collect()}
    scratch.drop()
    out = [f"# {title}", "", "## 1. Data", "", f"- {scope}", f"- Items: **{number(every['n'])}**.", "", "## 2. All items", "", *_described(every), "## 3. Tiers", ""]
    out += table(["tier", "range"], TIERS, [False, False])
    out += table(["tier", "n", "mean ratio", "median ratio"], [[name, number(by[i]["n"] if i in by else 0), plain(by[i]["mean"] if i in by else None), plain(by[i]["p50"] if i in by else None)] for i, (name, _) in enumerate(TIERS)])
    for i, (name, _) in enumerate(TIERS):
        out += [f"## {4 + i}. Tier: {name}", "", *_described(by.get(i))]
    return out


def lines_of(text: Column) -> Column:
    """The numbered lines of a whole text."""
    return F.posexplode(F.split(text, "\n", -1)).alias("place", "line")
