"""The resumable work queue as pure functions of state and results, health grades, consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import row_numbers
from .stats import quantiles


def start(urls: DataFrame, id_col: str, url: str) -> DataFrame:
    return urls.select(F.col(id_col).alias("id"), F.col(url).alias("url"), F.lit("pending").alias("status"), F.lit(0).alias("retry_count"))


def step(state: DataFrame, results: DataFrame, gap_phase: bool) -> DataFrame:
    """state(id, url, status, retry_count), results(id, ok, status_code) -> the next state.

    Success ends a row, 404 makes it invalid, anything else a failure: counted in the gap phase, counted
    anew from 0 in the full one.
    """
    j = state.join(results.select("id", "ok", "status_code"), "id", "left")
    status = F.when(F.col("ok").isNull(), F.col("status")).when(F.col("ok"), "success").when(F.col("status_code") == 404, "invalid").otherwise("fail")
    failed = F.col("ok").isNotNull() & ~F.col("ok") & ~F.coalesce(F.col("status_code") == 404, F.lit(False))
    retry = F.when(failed, F.col("retry_count") + 1 if gap_phase else F.lit(0)).otherwise(F.col("retry_count"))
    return j.select("id", "url", status.alias("status"), retry.alias("retry_count"))


def phase(state: DataFrame, most: int) -> DataFrame:
    """(phase, todo, least_retry): full while rows are pending, gap while failures may be retried, else terminal."""
    s, r = F.col("status"), F.col("retry_count")
    retry = (s == "fail") & (r < most)
    one = state.agg(F.count_if(s == "pending").alias("p"), F.count_if(retry).alias("g"), F.min(F.when(retry, r)).alias("m"))
    name = F.when(F.col("p") > 0, "full").when(F.col("g") > 0, "gap").otherwise("terminal")
    return one.select(name.alias("phase"), F.when(F.col("p") > 0, F.col("p")).otherwise(F.col("g")).alias("todo"), F.when(F.col("p") == 0, F.col("m")).alias("least_retry"))


def pick(state: DataFrame, most: int, k: int = 1) -> DataFrame:
    """The next k rows: pending ones by id; if there are none, failures to retry by (retry_count, id)."""
    s = F.col("status")
    first = F.when(s == "pending", 0).when((s == "fail") & (F.col("retry_count") < most), 1)
    lead = state.agg(F.min(first).alias("_lead")).withColumn("_k", F.lit(1))
    rows = state.withColumn("_p", first).where("_p is not null").withColumn("_k", F.lit(1)).join(F.broadcast(lead), "_k").where("_p = _lead")
    return rows.orderBy(F.when(F.col("_p") == 1, F.col("retry_count")).otherwise(0), "id").limit(k).select("id", "url", "status", "retry_count")


def sync_saved(state: DataFrame, saved: DataFrame) -> DataFrame:
    """Rows that wait or failed but whose page is saved become successes."""
    j = state.join(saved.select("id").distinct().withColumn("_s", F.lit(True)), "id", "left")
    return j.select("id", "url", F.when(F.col("_s") & F.col("status").isin("pending", "fail"), "success").otherwise(F.col("status")).alias("status"), "retry_count")


def checked_count(state: DataFrame, saved: int) -> DataFrame:
    """The state, or an error if the pages saved are neither as many as the successes nor one more."""
    one = state.agg(F.count_if(F.col("status") == "success").alias("_n")).withColumn("_k", F.lit(1))
    ok = F.when(F.lit(saved).isin(0) & (F.col("_n") == 0), True).when((F.lit(saved) - F.col("_n")).isin(0, 1), True).otherwise(F.raise_error("saved pages do not match the state").cast("boolean"))
    return state.withColumn("_k", F.lit(1)).join(F.broadcast(one), "_k").where(ok).drop("_k", "_n")


def runs(df: DataFrame, key: str, order: str, bad: Column) -> DataFrame:
    """(key, longest): longest run of consecutive rows for which bad holds."""
    w = Window.partitionBy(key).orderBy(order)
    x = df.select(key, order, F.coalesce(bad, F.lit(False)).alias("_bad"))
    x = x.withColumn("_island", F.row_number().over(w) - F.row_number().over(Window.partitionBy(key, "_bad").orderBy(order)))
    n = x.where("_bad").groupBy(key, "_island").agg(F.count("*").alias("n")).groupBy(key).agg(F.max("n").alias("longest"))
    return x.select(key).distinct().join(n, key, "left").select(key, F.coalesce("longest", F.lit(0)).alias("longest"))


def grades(df: DataFrame, key: str, order: str, ok: Column, transport: Column, limited: Column, latency: Column) -> DataFrame:
    """(key, attempts, ok_rate, transport_rate, limited_rate, p95, longest, grade): health A, B, C or F by rates, latency and runs of failures."""
    r = runs(df, key, order, transport)
    slow = quantiles(df.where(ok).select(key, latency.alias("_latency")), "_latency", (0.95,), [key])  # no task holds a key's latencies
    g = df.groupBy(key).agg(F.count("*").alias("attempts"), F.avg(ok.cast("double")).alias("ok_rate"), F.avg(transport.cast("double")).alias("transport_rate"),
                            F.avg(limited.cast("double")).alias("limited_rate")).join(slow, key, "left").join(r, key)
    c = F.col
    first = (F.when(c("ok_rate") == 0, "F")
             .when((c("ok_rate") >= 0.8) & (c("transport_rate") <= 0.2) & (c("limited_rate") <= 0.2), F.when(F.coalesce(c("p95") <= 30, F.lit(True)), "A").otherwise("B"))
             .when((c("ok_rate") >= 0.4) & (c("longest") < 5), "B").otherwise("C"))
    final = F.when((first == "B") & (c("ok_rate") < 0.8) & ((c("transport_rate") >= 0.6) | (c("longest") >= 3)), "C").otherwise(first)
    return g.select(key, "attempts", "ok_rate", "transport_rate", "limited_rate", "p95", "longest", final.alias("grade"))


def breaker(df: DataFrame, key: str, order: str, failed: Column, degrade: int = 2, quarantine: int = 5, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, order, carry..., failures, state) after each row: failures since the last success, and what they make of the key."""
    w = Window.partitionBy(key).orderBy(order)
    x = df.select(key, order, *carry, F.coalesce(failed, F.lit(False)).alias("_f"))
    x = x.withColumn("_since", F.sum((~F.col("_f")).cast("int")).over(w))
    n = F.sum(F.col("_f").cast("long")).over(Window.partitionBy(key, "_since").orderBy(order))
    state = F.when(n >= quarantine, "quarantined").when(n >= degrade, "degraded").otherwise("healthy")
    return x.select(key, order, *carry, n.alias("failures"), state.alias("state"))


def standing(df: DataFrame, key: str, order: str, at: str, failed: Column, now: Column, quarantine_s: float = 900.0) -> DataFrame:
    """(key, failures, state) at the time ``now``: the state after the last row, a quarantine that has run out being degraded.

    A quarantine lasts ``quarantine_s`` seconds from the failure that set or renewed it.
    """
    each = breaker(df, key, order, failed, carry=(at,))
    last = each.groupBy(key).agg(F.max_by(F.struct("failures", "state", at), F.col(order)).alias("z")).select(key, "z.*")
    over = F.col(at).cast("timestamp").cast("double") + quarantine_s <= now.cast("double")
    return last.select(key, "failures", F.when((F.col("state") == "quarantined") & over, "degraded").otherwise(F.col("state")).alias("state"))


def choose_egress(ports: DataFrame) -> DataFrame:
    """ports(port, state, busy, last_used) in the order to use them: healthy before degraded, idle, least recently used."""
    rank = F.when(F.col("state") == "healthy", 0).when(F.col("state") == "degraded", 1)
    able = ports.withColumn("_rank", rank).where("_rank is not null")
    return row_numbers(able, [F.col("_rank"), F.col("busy"), F.col("last_used").asc_nulls_first(), F.col("port")], "choice").drop("_rank")


def grade_counts(graded: DataFrame) -> DataFrame:
    """(grade, ports, pct) of A, B, C and F, empty ones too."""
    g = graded.groupBy("grade").agg(F.count("*").alias("ports"))
    every = graded.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, "ABCF"))).alias("grade"), F.lit(1).alias("_k"))
    total = graded.agg(F.count("*").alias("_t")).withColumn("_k", F.lit(1))
    n = F.coalesce("ports", F.lit(0))
    return every.join(g, "grade", "left").join(F.broadcast(total), "_k").select("grade", n.alias("ports"), F.when(F.col("_t") > 0, 100.0 * n / F.col("_t")).otherwise(0.0).alias("pct"))


def worst_first(graded: DataFrame, key: str) -> DataFrame:
    """Adds place: F before C, B and A, then by key."""
    order = F.when(F.col("grade") == "F", 0).when(F.col("grade") == "C", 1).when(F.col("grade") == "B", 2).otherwise(3)
    return row_numbers(graded.withColumn("_o", order), [F.col("_o"), F.col(key)], "place").drop("_o")


def to_review(state: DataFrame, most: int) -> DataFrame:
    """(why, id): rows out of retries, and rows that don't exist."""
    why = F.when((F.col("status") == "fail") & (F.col("retry_count") >= most), "exhausted").when(F.col("status") == "invalid", "invalid")
    return state.select(why.alias("why"), "id").where("why is not null")


def gap_sweeps(gaps: DataFrame, attempts: DataFrame, key: str, budget: int = 5) -> DataFrame:
    """gaps(key), attempts(key, seq, ok) -> (key, used, state): what sweeps of one attempt a gap make of each.

    The first good attempt within the budget fills a gap; without one it is exhausted once the budget is used,
    and open before. Attempts beyond the budget or after a good one are not made.
    """
    w = Window.partitionBy(key).orderBy("seq")
    made = attempts.join(gaps.select(key), key, "left_semi").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= budget)
    per = made.groupBy(key).agg(F.max("_n").alias("_made"), F.min(F.when(F.col("ok"), F.col("_n"))).alias("_good"))
    used = F.coalesce("_good", "_made", F.lit(0))
    state = F.when(F.col("_good").isNotNull(), "filled").when(used >= budget, "exhausted").otherwise("open")
    return gaps.select(key).distinct().join(per, key, "left").select(key, used.cast("int").alias("used"), state.alias("state"))


def consensus(first: Column, second: Column) -> Column:
    """Two votes of 0, 1 or 2 (unsure): the same is taken, a sure one beats unsure, 0 against 1 is unsure."""
    return F.when(first == second, first).when(first == 2, second).when(second == 2, first).otherwise(2)


def answer_class(text: Column) -> Column:
    """An answer's class: 0, 1 or 2 alone, else the first of them in the text; null asks for another try."""
    return F.nullif(F.regexp_extract(text, "[012]", 0), F.lit("")).cast("int")


def unfinished(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a checkpoint of finished keys leaves to do."""
    return items.join(done.select(key), key, "left_anti")


def valid_done(done: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """A checkpoint's rows whose key is still among the items."""
    return done.join(items.select(key), key, "left_semi")


def write_checkpoint(done: DataFrame, key: str, value: str, root: str) -> None:
    """Finished keys with their class as JSON lines, one folder a class, replacing what is there."""
    done.select(key, value).write.mode("overwrite").partitionBy(value).json(root)
