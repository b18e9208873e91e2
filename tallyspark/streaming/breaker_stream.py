"""The circuit breaker as keyed state over a stream of attempts, with quarantines that end by themselves."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

LOG = "port long, us long, seq long, failures long, state string"


class Breaker(StatefulProcessor):
    """Attempts wait until the watermark has passed them, so they count in order of time whatever order they come in.

    A port's first failures leave it healthy, ``degrade`` of them in a row degrade it, ``quarantine`` set it apart
    for ``quarantine_s`` seconds from each further failure. A timer ends that, as no attempt need come.
    """

    def __init__(self, degrade: int, quarantine: int, quarantine_s: float):
        self.degrade, self.quarantine, self.span = degrade, quarantine, round(quarantine_s * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, seq long, failed boolean")
        self.standing = handle.getValueState("standing", "failures long, state string, until long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows))
        came = came[came["failed"].notna()]  # the others only move the clock
        if len(came):
            self.waiting.appendList([(int(u), int(s), bool(f)) for u, s, f in zip(came["us"], came["seq"], came["failed"], strict=True)])
            self._wake(int(came["us"].min()))
        yield pd.DataFrame({c: pd.Series(dtype="object") for c in ("port", "us", "seq", "failures", "state")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted((r[0], r[1], r[2]) for r in self.waiting.get()) if self.waiting.exists() else []
        due, rest = [r for r in rows if r[0] <= now], [r for r in rows if r[0] > now]
        failures, state, until = self.standing.get() if self.standing.exists() else (0, "healthy", 0)
        log: list[tuple] = []

        def release(at: int) -> str:
            if state == "quarantined" and until <= at:
                log.append((key[0], until, None, failures, "degraded"))
                return "degraded"
            return state

        for us, seq, failed in due:
            state = release(us)
            failures = failures + 1 if failed else 0
            state = "quarantined" if failures >= self.quarantine else "degraded" if failures >= self.degrade else "healthy"
            until = us + self.span if state == "quarantined" else 0
            log.append((key[0], us, seq, failures, state))
        state = release(now)
        self.standing.update((failures, state, until))
        if due:
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
        if rest:
            self._wake(rest[0][0])
        if state == "quarantined":
            self._wake(until)
        yield pd.DataFrame(log, columns=["port", "us", "seq", "failures", "state"]).astype({"seq": "Int64"})

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))


def standings(attempts: DataFrame, port: str, at: str, seq: str, failed: Column, delay: str = "1 hour", degrade: int = 2, quarantine: int = 5, quarantine_s: float = 900.0) -> DataFrame:
    """A stream of attempts -> a stream (port, us, seq, failures, state): what each attempt makes of its port, and, with seq null,
    each end of a quarantine, in microseconds of the event time.

    Attempts count once the watermark, ``delay`` behind the newest, has passed them; later ones than that are left out. Rows whose ``failed``
    is null are clock ticks of no port.
    """
    rows = attempts.select(F.coalesce(F.col(port).cast("string"), F.lit("")).alias("port"), F.col(at).cast("timestamp").alias("at"), F.col(seq).cast("long").alias("seq"), failed.alias("failed"))
    rows = rows.withWatermark("at", delay).withColumn("us", F.unix_micros("at"))
    processor = Breaker(degrade, quarantine, quarantine_s)
    # The clock's key is an empty text, as a null key can be taken for another one in the workers.
    log = rows.groupBy("port").transformWithStateInPandas(statefulProcessor=processor, outputStructType=LOG.replace("port long", "port string"), outputMode="Append", timeMode="eventTime")
    return log.withColumn("port", F.col("port").cast("long"))


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """Keyed state with timers needs the RocksDB store; the setting is read when a query starts."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def follow(log: DataFrame, path: str, checkpoint: str):
    """Starts a query that appends the log to Parquet files; a query begun anew from its checkpoint goes on where it was."""
    with _state_store(log.sparkSession):
        return log.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def latest(log: DataFrame) -> DataFrame:
    """A log -> (port, failures, state): where each port stands after its last entry."""
    last = F.max_by(F.struct("failures", "state"), F.struct("us", F.coalesce("seq", F.lit(2**62))))
    return log.groupBy("port").agg(last.alias("z")).select("port", "z.failures", "z.state")
