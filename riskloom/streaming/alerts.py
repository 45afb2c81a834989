"""Alert rules: a condition that must hold for a while, and the absence of events.

The stream versions keep one small state per label; the batch versions give the same answer from
windows over per-minute rows (never over raw events, so a hot source stays small).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.streaming import monitor

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ALERT_SCHEMA = "label string, since timestamp, at timestamp"
COMPONENT_SCHEMA = "component string, state string, at timestamp"
ABSENCE_SCHEMA = "source string, last_seen timestamp, next_seen timestamp"


def use_state_store(spark: SparkSession) -> None:
    """Timers and value states need the RocksDB store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)


def millis(ts: pd.Timestamp) -> int:
    return int(pd.Timestamp(ts).value // 1_000_000)


class HeldCondition(StatefulProcessor):
    """Emits once per stretch, when the condition has held for the required time.

    Samples wait until the watermark has passed them and are then taken in the order of their own time, so files that
    arrive late or shuffled give the alerts of the whole history. What waits per label is what the watermark allows.
    """

    def __init__(self, hold_seconds: float):
        self.hold = pd.Timedelta(seconds=hold_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stretch = handle.getValueState("stretch", "since timestamp, fired boolean")
        self.waiting = handle.getListState("waiting", "ts timestamp, firing boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows))
        self.waiting.appendList(list(zip(frame["ts"], frame["firing"])))
        yield from self.settle(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.settle(key, timerValues.getCurrentWatermarkInMs())

    def settle(self, key, watermark: int) -> Iterator[pd.DataFrame]:
        """Take the samples at or before the watermark; a timer comes back for the next one."""
        samples = sorted((pd.Timestamp(ts), bool(firing)) for ts, firing in self.waiting.get()) if self.waiting.exists() else []
        ready = [s for s in samples if millis(s[0]) <= watermark]
        left = samples[len(ready) :]
        since, fired = self.stretch.get() if self.stretch.exists() else (None, False)
        out = []
        for ts, firing in ready:
            if not firing:
                since, fired = None, False
                continue
            if since is None:
                since = ts
            if not fired and ts - since >= self.hold:
                fired = True
                out.append((key[0], since, ts))
        if since is None:
            self.stretch.clear()
        else:
            self.stretch.update((since, fired))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if left:
            self.waiting.put(left)
            self.handle.registerTimer(max(millis(left[0][0]) - 1, watermark))
        else:
            self.waiting.clear()
        if out:
            yield pd.DataFrame(out, columns=["label", "since", "at"])

    def close(self) -> None:
        pass


class Absence(StatefulProcessor):
    """Emits a gap when a source is silent longer than allowed: open at the timer, closed at its next event."""

    def __init__(self, allowed_seconds: float):
        self.allowed = pd.Timedelta(seconds=allowed_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ts timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("first_ts")
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for first_ts, last_ts in zip(frame["first_ts"], frame["last_ts"]):
            if last is not None and first_ts - last > self.allowed:
                out.append((key[0], last, first_ts))
            last = last_ts if last is None else max(last, last_ts)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.last.update((last,))
        self.handle.registerTimer(millis(last + self.allowed) + 1)
        if out:
            yield pd.DataFrame(out, columns=["source", "last_seen", "next_seen"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            seen = self.last.get()[0]
            yield pd.DataFrame({"source": [key[0]], "last_seen": [seen], "next_seen": [pd.NaT]})

    def close(self) -> None:
        pass


class ComponentState(StatefulProcessor):
    """Follows one expected component: up or down as it reports, silent when it has not reported for the allowed time."""

    def __init__(self, allowed_seconds: float):
        self.allowed = pd.Timedelta(seconds=allowed_seconds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "ts timestamp, state string")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.remember(initialState["since"].iloc[0], None)

    def remember(self, last: pd.Timestamp, state: str | None) -> None:
        self.seen.update((last, state))
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(millis(last + self.allowed) + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values("first_ts")
        last, state = self.seen.get() if self.seen.exists() else (None, None)
        out = []
        for first_ts, last_ts, up in zip(frame["first_ts"], frame["last_ts"], frame["up"]):
            if last is not None and first_ts - last > self.allowed and state != "silent":
                out.append((key[0], "silent", last + self.allowed))
            new = "up" if up else "down"
            if new != state or (out and out[-1][1] == "silent"):
                out.append((key[0], new, first_ts))
            last, state = last_ts, new
        self.remember(last, state)
        if out:
            yield pd.DataFrame(out, columns=["component", "state", "at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, state = self.seen.get()
        if state != "silent":
            self.seen.update((last, "silent"))
            yield pd.DataFrame({"component": [key[0]], "state": ["silent"], "at": [last + self.allowed]})

    def close(self) -> None:
        pass


def component_states(
    reports: DataFrame, component: str, up: str, expected: DataFrame, allowed_seconds: float, ts: str = "ts"
) -> DataFrame:
    """Stream of reports -> changes (component, state, at) to ``up``, ``down`` or ``silent``.

    ``expected`` holds (component, since): a component is watched from ``since`` even if it never reports; one that is not
    listed is watched from its first report. Reports meet in one row per component and minute before they reach the
    state; a minute with one bad or null report is down.
    """
    use_state_store(reports.sparkSession)
    good = F.min(F.coalesce(F.col(up).cast("int"), F.lit(0))).alias("up")
    minutes = monitor.minute_summary(reports, component, ts, more=[good])
    named = minutes.select(F.col(component).cast("string").alias("component"), "event_time", "first_ts", "last_ts", "up")
    watched = expected.select(F.col("component").cast("string").alias("component"), F.col("since").cast("timestamp").alias("since"))
    return named.groupBy("component").transformWithStateInPandas(
        statefulProcessor=ComponentState(allowed_seconds), outputStructType=COMPONENT_SCHEMA,
        outputMode="Append", timeMode="EventTime", initialState=watched.groupBy("component"),
    )


def held_alerts(samples: DataFrame, label: str, hold_seconds: float, late_seconds: float = 60) -> DataFrame:
    """Stream of (label, ts, firing) samples -> one row per stretch that held long enough.

    Samples may come late by up to ``late_seconds`` and in any order within that time.
    """
    use_state_store(samples.sparkSession)
    shaped = samples.select(F.col(label).cast("string").alias("label"), F.col("ts").cast("timestamp").alias("ts"), "firing")
    shaped = shaped.withWatermark("ts", f"{int(late_seconds * 1000)} milliseconds")
    return shaped.groupBy("label").transformWithStateInPandas(
        statefulProcessor=HeldCondition(hold_seconds), outputStructType=ALERT_SCHEMA,
        outputMode="Append", timeMode="EventTime",
    )


def held_alerts_batch(samples: DataFrame, label: str, hold_seconds: float) -> DataFrame:
    """Gaps and islands over per-window samples of each label."""
    by_time = Window.partitionBy("label").orderBy("ts")
    shaped = samples.select(F.col(label).cast("string").alias("label"), "ts", "firing")
    starts = F.when(F.col("firing") & ~F.coalesce(F.lag("firing").over(by_time), F.lit(False)), 1).otherwise(0)
    islands = shaped.withColumn("_i", F.sum(starts).over(by_time)).filter("firing").withColumn(
        "since", F.min("ts").over(Window.partitionBy("label", "_i"))
    )
    held = F.unix_micros("ts") - F.unix_micros("since") >= int(hold_seconds * 1e6)
    return islands.filter(held).groupBy("label", "_i", "since").agg(F.min("ts").alias("at")).drop("_i")


def absence_alerts(events: DataFrame, source: str, allowed_seconds: float, ts: str = "ts") -> DataFrame:
    """Stream of raw events -> silent gaps per source, from per-minute summaries and event-time timers."""
    use_state_store(events.sparkSession)
    minutes = monitor.minute_summary(events, source, ts).withColumn(source, F.col(source).cast("string"))
    return minutes.select(F.col(source).alias("source"), "event_time", "first_ts", "last_ts").groupBy(
        "source"
    ).transformWithStateInPandas(
        statefulProcessor=Absence(allowed_seconds), outputStructType=ABSENCE_SCHEMA,
        outputMode="Append", timeMode="EventTime",
    )


def absence_gaps(events: DataFrame, source: str, allowed_seconds: float, ts: str = "ts") -> DataFrame:
    """The same gaps from a batch of events (allowed time at least one minute)."""
    minutes = monitor.minute_summary(events, source, ts)
    following = F.lead("first_ts").over(Window.partitionBy(source).orderBy("first_ts"))
    gap = F.unix_micros("next_seen") - F.unix_micros("last_seen") > int(allowed_seconds * 1e6)
    return minutes.select(
        F.col(source).cast("string").alias("source"), F.col("last_ts").alias("last_seen"), following.alias("next_seen")
    ).filter(gap)
