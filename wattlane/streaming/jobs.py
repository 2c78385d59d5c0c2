"""Streaming versions of the periodic work: hourly loads, KPI windows, rules, validation, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wattlane.functions.conditions import holds
from wattlane.operators import kpi, moments
from wattlane.session import materialize, scratch_path
from wattlane.sources import tabular


def read_parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, per_trigger: int | None = None
) -> DataFrame:
    """A table (one file, a folder of part files, or folders by batch) as a stream; ``per_trigger`` bounds its files."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def hourly_load(
    events: DataFrame, keys: Sequence[str], ts: str, value: str, late: str = "1 hour"
) -> DataFrame:
    """Tumbling hourly sums; rows later than ``late`` are ignored, closed hours are final.

    ``closed`` is the last instant of the hour; it carries the watermark on to further stateful steps.
    """
    hour = F.window(ts, "1 hour")
    grouped = events.withWatermark(ts, late).groupBy(hour.alias("_w"), *keys)
    return grouped.agg(F.sum(value).alias("load"), F.count(value).alias("n"), F.avg(value).alias("mean")).select(
        *keys, F.col("_w.start").alias(ts), "load", "n", "mean", F.window_time("_w").alias("closed")
    )


def sliding_kpis(
    pairs: DataFrame, ts: str, actual: str = "actual", predicted: str = "prediction",
    length: str = "24 hours", slide: str = "1 hour", late: str = "1 hour", price: float = kpi.PRICE,
) -> DataFrame:
    """Business figures over sliding windows of (actual, forecast) pairs.

    Two stateful steps: sums per ``slide``, then sums of those per window.  So a raw row is counted once, the state
    has a row per ``slide``, and only such rows are copied into the windows that hold them.
    """
    y, p = F.col(actual), F.col(predicted)
    error = y - p
    peak = F.hour(ts).isin(*kpi.PEAK_HOURS)
    parts = {
        "rows": F.count(F.lit(1)), "known": F.count(error), "absolute": F.sum(F.abs(error)), "signed": F.sum(error),
        "peak_known": F.count(F.when(peak, error)), "peak": F.sum(F.when(peak, F.abs(error))), "load": F.sum(y),
    }
    hours = pairs.withWatermark(ts, late).groupBy(F.window(ts, slide).alias("_hour")).agg(
        *[c.alias(n) for n, c in parts.items()])
    windows = hours.groupBy(F.window(F.window_time("_hour"), length, slide).alias("_w")).agg(
        *[F.sum(n).alias(n) for n in parts])
    cost = F.col("absolute") * price
    return windows.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "rows",
        (F.col("absolute") / F.nullif("known", F.lit(0))).alias("mae"),
        (F.col("peak") / F.nullif("peak_known", F.lit(0))).alias("peak_mae"),
        (F.col("signed") / F.nullif("known", F.lit(0))).alias("forecast_bias"),
        cost.alias("total_error_cost"),
        F.greatest(F.lit(0.0), (1 - cost / F.nullif(F.col("load") * price, F.lit(0.0))) * 100).alias("business_impact_score"),
    )


def first_seen(events: DataFrame, keys: Sequence[str], ts: str, late: str = "1 hour") -> DataFrame:
    """Drop repeated events; state is kept for ``late`` only."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def count_triggers(metrics: DataFrame, rules: DataFrame, ts: str) -> DataFrame:
    """Running number of alerts and last alert time per rule, for update output.

    The only state is one row per rule.
    """
    active = rules.filter("enabled").select(
        "metric", F.col("name").alias("rule_name"), "operator", "threshold", "severity"
    )
    fired = metrics.join(active, "metric").filter(holds(F.col("value"), F.col("operator"), F.col("threshold")))
    return fired.groupBy("rule_name", "severity").agg(
        F.count(F.lit(1)).alias("trigger_count"), F.max(ts).alias("last_triggered")
    )


def breaches(figures: DataFrame, rules: DataFrame, ts: str, slot: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Closed slots per rule: how many figures broke it, out of how many; any number of rows of one rule is summed up
    on all tasks."""
    active = rules.filter("enabled").select(
        "metric", F.col("name").alias("rule_name"), "operator", "threshold", "severity"
    )
    judged = figures.withWatermark(ts, late).join(active, "metric")
    broken = F.count_if(holds(F.col("value"), F.col("operator"), F.col("threshold")))
    return judged.groupBy(F.window(ts, slot).alias("_w"), "rule_name", "severity").agg(
        broken.alias("broken"), F.count(F.lit(1)).alias("seen")
    ).select("rule_name", "severity", F.window_time("_w").alias("closed"), F.col("_w.start").alias(ts), "broken", "seen")


class AlertStates(StatefulProcessor):
    """The alert of one rule: since when it is open, when it was last told, its last broken slot, figures that broke it."""

    def __init__(self, ts: str, cool_down_hours: int, silence_hours: int) -> None:
        self.ts, self.cool_down, self.silence = ts, cool_down_hours * 3_600_000, silence_hours * 3_600_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.alert = handle.getValueState("alert", "opened long, told long, last long, broken long")

    def _told(self, key: tuple, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        out = pd.DataFrame([(*key, *r) for r in rows],
                           columns=["rule_name", "severity", "event", self.ts, "opened", "broken"])
        for c in (self.ts, "opened"):
            out[c] = pd.to_datetime(out[c], unit="ms")
        yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = list(self.alert.get()) if self.alert.exists() else None
        if held:
            self.handle.deleteTimer(held[2] + self.silence)
        told: list[tuple] = []
        arrived = pd.concat(list(rows)).sort_values(self.ts)
        for at, broken in zip([int(t.timestamp() * 1000) for t in arrived[self.ts]], arrived["broken"].tolist(), strict=True):
            if held and at > held[2] + self.silence:
                told.append(("expired", held[2] + self.silence, held[0], held[3]))
                held = None
            if broken and held is None:
                held = [at, at, at, broken]
                told.append(("opened", at, at, broken))
            elif broken:
                held[2], held[3] = at, held[3] + broken
                if at - held[1] >= self.cool_down:
                    held[1] = at
                    told.append(("repeated", at, held[0], held[3]))
            elif held:
                told.append(("cleared", at, held[0], held[3]))
                held = None
        if held:
            self.alert.update(tuple(held))
            self.handle.registerTimer(held[2] + self.silence)
        else:
            self.alert.clear()
        return self._told(key, told)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        told = []
        if self.alert.exists():
            opened, _, last, broken = self.alert.get()
            if last + self.silence <= expiredTimerInfo.getExpiryTimeInMs():
                told.append(("expired", last + self.silence, opened, broken))
                self.alert.clear()
        return self._told(key, told)

    def close(self) -> None:
        pass


def alert_states(slots: DataFrame, ts: str, cool_down_hours: int = 6, silence_hours: int = 24) -> DataFrame:
    """What happens to each rule's alert as ``breaches`` closes slots, from keyed state and event-time timers.

    ``opened``: the first broken slot; ``repeated``: a broken slot at least ``cool_down_hours`` after the alert was
    last told; ``cleared``: the first slot without a break; ``expired``: no slot at all for ``silence_hours`` after
    the last broken one (told by a timer, or by the slot that ends the silence).  ``broken`` counts the figures that
    broke the rule since the alert opened.  Slots of a batch are taken in order of time.
    """
    schema = f"rule_name string, severity string, event string, {ts} timestamp, opened timestamp, broken long"
    return slots.groupBy("rule_name", "severity").transformWithStateInPandas(
        AlertStates(ts, cool_down_hours, silence_hours), T.StructType.fromDDL(schema), "Append", "EventTime")


# State that Python processors keep needs this store; it writes what a batch changed, not all files again.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _start(df: DataFrame, write: Callable[[DataFrame, int], None], label: str, mode: str = "append",
           checkpoint: str | None = None, processors: bool = False) -> StreamingQuery:
    spark = df.sparkSession
    place = checkpoint or scratch_path(spark, f"{label}-state")
    if not processors:
        return _started(df, write, place, mode)
    before = {k: spark.conf.get(k, None) for k in _STORE}
    # A query keeps the settings it starts with; the session gets its own back.
    try:
        for k, v in _STORE.items():
            spark.conf.set(k, v)
        return _started(df, write, place, mode)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _started(df: DataFrame, write: Callable[[DataFrame, int], None], place: str, mode: str) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
        .start()
    )


def batch_folder(path: str, batch_id: int) -> str:
    """A batch writes its own folder and replaces it when replayed, so results count once."""
    return f"{path}/batch_id={batch_id}"


def to_table(df: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None,
             processors: bool = False) -> StreamingQuery:
    """Write a stream; ``processors``: it keeps state in Python (``alert_states``, ``lagged_hours``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return _start(df, write, "table", mode, checkpoint, processors)


def quarantine(raw: DataFrame, schema: T.StructType, good_path: str, bad_path: str,
               checkpoint: str | None = None) -> StreamingQuery:
    """Rows that fit the declared schema to one table, the others as raw text to another."""
    cleaned = raw.select(*[tabular.known(F.col(c)).alias(c) for c in raw.columns])
    valid = F.coalesce(tabular.row_is_valid(cleaned, schema), F.lit(False))

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = batch.withColumn("_ok", valid).persist()
        try:
            judged.filter("_ok").select(*tabular.typed(judged, schema)).write.mode("overwrite").parquet(
                batch_folder(good_path, batch_id)
            )
            judged.filter(~F.col("_ok")).drop("_ok").write.mode("overwrite").parquet(batch_folder(bad_path, batch_id))
        finally:
            judged.unpersist()

    return _start(cleaned, write, "quarantine", "append", checkpoint)


def monitor(
    current: DataFrame, reference: DataFrame, columns: Sequence[str], path: str, checkpoint: str | None = None
) -> StreamingQuery:
    """Drift of everything that has arrived so far against a fixed reference, after every micro-batch.

    A batch writes its own moments (``path/parts``); they merge exactly, so the figures over all batches equal those
    of one pass, a replayed batch replaces its part, and a restart goes on from the parts that are there.  The
    reference is read once, for its moments.  Figures stand in ``path/figures`` by batch.
    """
    spark = current.sparkSession
    fixed = materialize(moments.of(reference, columns), "reference")
    schema = T.StructType([*fixed.schema.fields, T.StructField("batch_id", T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        moments.of(batch, columns).coalesce(1).write.mode("overwrite").parquet(batch_folder(f"{path}/parts", batch_id))
        parts = spark.read.schema(schema).parquet(f"{path}/parts").where(F.col("batch_id") <= batch_id)
        figures = moments.compare(fixed, moments.merged(parts))
        figures.write.mode("overwrite").parquet(batch_folder(f"{path}/figures", batch_id))

    return _start(current, write, "monitor", "append", checkpoint)


# Hours that a series remembers.
MEMORY_HOURS = 168


class LastHours(StatefulProcessor):
    """Lags of a series' closed hours from a ring of its last ``MEMORY_HOURS`` hours: slot = hour modulo the memory."""

    def __init__(self, keys: Sequence[str], ts: str, load: str, lags: Sequence[int]) -> None:
        self.keys, self.ts, self.load, self.lags = tuple(keys), ts, load, tuple(lags)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", "hours array<long>, loads array<double>")

    def _forgotten(self, hours: Sequence[int]) -> int:
        """When no later hour can reach back to any that is held."""
        return (max(hours) + MEMORY_HOURS + 1) * 3_600_000

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrived = pd.concat(list(rows)).sort_values(self.ts)
        if self.ring.exists():
            hours, loads = map(list, self.ring.get())
            self.handle.deleteTimer(self._forgotten(hours))
        else:
            hours, loads = [-1] * MEMORY_HOURS, [None] * MEMORY_HOURS
        numbers = [int(t.timestamp()) // 3600 for t in arrived[self.ts]]
        values = [None if pd.isna(v) else float(v) for v in arrived[self.load]]
        past: list[list] = [[] for _ in self.lags]
        for hour, value in zip(numbers, values, strict=True):
            for out, lag in zip(past, self.lags, strict=True):
                slot = (hour - lag) % MEMORY_HOURS
                out.append(loads[slot] if hours[slot] == hour - lag else None)
            slot = hour % MEMORY_HOURS
            hours[slot], loads[slot] = hour, value
        self.ring.update((hours, loads))
        self.handle.registerTimer(self._forgotten(hours))
        made = dict(zip(self.keys, ([v] * len(numbers) for v in key), strict=True))
        made |= {self.ts: arrived[self.ts].to_numpy(), self.load: pd.Series(values, dtype=float)}
        yield pd.DataFrame(made | {f"lag_{k}": pd.Series(v, dtype=float) for k, v in zip(self.lags, past, strict=True)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.ring.exists() and self._forgotten(self.ring.get()[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.ring.clear()
        yield pd.DataFrame(columns=[*self.keys, self.ts, self.load, *[f"lag_{k}" for k in self.lags]])

    def close(self) -> None:
        pass


def lagged_hours(
    hours: DataFrame, keys: Sequence[str], ts: str, load: str, lags: Sequence[int]
) -> DataFrame:
    """Lags (``lag_<k>``, NULL where that hour had no row) of the closed hours that ``hourly_load`` emits.

    The watermark closes hours in order, so an hour meets all earlier ones in its series' state; hours of one batch
    are taken in order of time.  The state is a ring of fixed size per series, sums of raw rows happen before it.  An
    event-time timer drops the state of a series that is silent for longer than the ring reaches back.
    """
    if not lags or max(lags) > MEMORY_HOURS or min(lags) < 1:
        raise ValueError(f"lags are 1 to {MEMORY_HOURS} hours")
    kinds = {f.name: f.dataType for f in hours.schema.fields}
    schema = T.StructType([*[T.StructField(k, kinds[k]) for k in keys], T.StructField(ts, T.TimestampType()),
                           T.StructField(load, T.DoubleType()), *[T.StructField(f"lag_{k}", T.DoubleType()) for k in lags]])
    return hours.select(*keys, ts, load, "closed").groupBy(*keys).transformWithStateInPandas(
        LastHours(keys, ts, load, lags), schema, "Append", "EventTime")


def score(rows: DataFrame, model: PipelineModel, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Apply a saved model to arriving feature rows, as ``lagged_hours`` makes them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        model.transform(batch).drop("features").write.mode("overwrite").parquet(batch_folder(path, batch_id))

    return _start(rows, write, "score", "append", checkpoint, processors=True)


def finish(query: StreamingQuery) -> None:
    """Wait until the available data is processed; errors of the stream surface here."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
